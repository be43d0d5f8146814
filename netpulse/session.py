"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from netpulse.sources import folders


def build_session(
    app: str = "netpulse", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings the engine relies on; ``conf`` entries win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


# Spark's own default, and the limit we set: see prepare().
_ANY_METHOD_SIZE, _COMPILED_METHOD_SIZE = "65535", "5000"


def prepare(spark: SparkSession) -> SparkSession:
    """A session setting that speed depends on; called by every entry point. The session's zone is left
    alone: dates and hours are UTC by their expressions.

    Projections as wide as Silver's become one long method under whole-stage code generation, which
    the JVM compiles late or not at all (measured: three times slower); above the limit Spark
    generates many small methods instead. A limit chosen by the user stays.
    """
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit") == _ANY_METHOD_SIZE:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", _COMPILED_METHOD_SIZE)
    return spark


def use_disk_state(spark: SparkSession) -> SparkSession:
    """Keep streaming state in RocksDB, so that it may exceed executor memory; a chosen store stays."""
    key = "spark.sql.streaming.stateStore.providerClass"
    rocks = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    if spark.conf.get(key).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(key, rocks)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session may fall back to a temporary folder of this machine, and it records
    the folder in the session so that later calls agree on it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("netpulse.shared.root", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by driver and executors")
    root = tempfile.mkdtemp(prefix="netpulse-")
    spark.conf.set("netpulse.shared.root", root)
    return root


_WORK = "netpulse.work.folder"


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new path (not yet created) below the shared root, in the work folder of the job if it has one."""
    root = spark.conf.get(_WORK, None) or f"{shared_root(spark)}/netpulse"
    return f"{root}/{label}-{uuid.uuid4().hex}"


@contextmanager
def work_folder(spark: SparkSession) -> Iterator[str]:
    """A folder that takes the intermediate tables of a job and goes with them at its end, failed or not.

    Results read those tables: write or collect them inside. A job inside a job has a folder of its own.
    """
    outer = spark.conf.get(_WORK, None)
    path = fresh_folder(spark, "job")
    spark.conf.set(_WORK, path)
    try:
        yield path
    finally:
        spark.conf.unset(_WORK) if outer is None else spark.conf.set(_WORK, outer)
        folders.remove(spark, path)
