"""Where the engine reads and writes, and how its streams are paced."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

from netpulse import domain
from netpulse.session import shared_root


@dataclass(frozen=True)
class EngineConfig:
    """Immutable settings. Derive variants with :meth:`but`.

    ``record_source`` is ``kafka`` (needs the connector package on the class path) or ``files``
    (a folder of Parquet files with the Kafka record layout). ``table_format`` is any Spark file
    format or table connector; ``parquet`` needs nothing beyond Spark, ``delta`` its package.
    ``min_partitions`` has Kafka's few topic partitions read as so many offset ranges at least, so that
    neither their number nor a chatty device bounds the tasks of a batch.
    ``bronze_files`` has a micro-batch leave at most so many Bronze files per event type, by a shuffle, where
    a task would else leave one each. ``cluster_order`` and ``row_group_bytes`` lay out the serving tables.
    ``payload`` is how Bronze holds it: a ``map`` of texts, or a ``variant`` with types, nesting and all keys.
    ``fan_out`` says how Silver and Alerts follow Bronze; one deployment keeps to one way, because a
    file table written by a stream lists its files in the stream's own log.
    """

    base_path: str
    checkpoint_path: str
    bootstrap_servers: str = "localhost:9092"
    topic: str = domain.TOPIC
    record_source: str = "kafka"
    records_path: str | None = None
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    max_files_per_trigger: int | None = None
    bronze_files: int | None = None
    payload: str = "map"
    cluster_order: str = "linear"
    row_group_bytes: int | None = None
    table_format: str = "parquet"
    bronze_every: str = "30 seconds"
    silver_every: str = "60 seconds"
    alerts_every: str = "10 seconds"
    available_now: bool = False
    alerts_from: str = "bronze"
    fan_out: str = "two_queries"
    alert_tier: str = "actionable"
    quarantine: bool = False
    sink_options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for name, allowed in (
            ("record_source", ("kafka", "files")),
            ("alerts_from", ("bronze", "source")),
            ("fan_out", ("two_queries", "single_scan")),
            ("alert_tier", ("actionable", "critical")),
            ("cluster_order", ("linear", "zorder")),
            ("payload", ("map", "variant")),
        ):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}")
        if self.record_source == "files" and not self.records_path:
            raise ValueError("record_source='files' needs records_path")

    @classmethod
    def detect(
        cls, spark: SparkSession, mount: str = "/mnt/delta", checkpoints: str = "/mnt/checkpoints", **overrides
    ) -> "EngineConfig":
        """Mounted cluster paths when ``mount`` exists; else local development paths.

        Off a local master there is no machine-local fallback: everything then goes below the shared
        folder of the session.
        """
        if os.path.exists(mount):
            defaults = dict(base_path=mount, checkpoint_path=checkpoints, bootstrap_servers="kafka-broker:9092")
        elif spark.sparkContext.master.startswith("local"):
            defaults = dict(base_path="/tmp/streaming", checkpoint_path="/tmp/streaming/checkpoints")
        else:
            return cls.under(f"{shared_root(spark)}/netpulse", **overrides)
        return cls(**{**defaults, **overrides})

    @classmethod
    def under(cls, root: str, **overrides) -> "EngineConfig":
        """Everything below one folder."""
        return cls(**{"base_path": f"{root}/tables", "checkpoint_path": f"{root}/checkpoints", **overrides})

    def but(self, **changes) -> "EngineConfig":
        return replace(self, **changes)

    def table(self, layer: str) -> str:
        return f"{self.base_path}/{layer}"

    def checkpoint(self, query: str) -> str:
        return f"{self.checkpoint_path}/{query}"

    @property
    def bronze(self) -> str:
        return self.table("bronze")

    @property
    def rejects(self) -> str:
        return self.table("rejects")

    @property
    def silver(self) -> str:
        return self.table("silver")

    @property
    def alerts(self) -> str:
        return self.table("alerts")

    def gold(self, name: str) -> str:
        return self.table(f"gold/{name}")

    def serving(self, name: str) -> str:
        return self.table(f"serving/{name}")

    @property
    def layout_options(self) -> dict[str, str]:
        """Writer options of batch tables: size of a row group, the unit that statistics skip."""
        if self.table_format != "parquet" or not self.row_group_bytes:
            return {}
        size = str(self.row_group_bytes)
        return {"parquet.block.size": size, "parquet.page.size": str(max(1024, self.row_group_bytes // 8))}

    def trigger(self, every: str) -> dict:
        """Keyword arguments of ``DataStreamWriter.trigger``."""
        return {"availableNow": True} if self.available_now else {"processingTime": every}
