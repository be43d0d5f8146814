"""Layer tables at rest: reading, streaming and existence."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from netpulse.config import EngineConfig


#: Files that a micro-batch over a layer table takes where the configuration does not say.
FILES_PER_BATCH = 1000


def read_table(spark: SparkSession, cfg: EngineConfig, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A layer table: the columns of ``schema``, with nothing inferred from files.

    Without ``schema`` the layouts of all files are merged, which opens every file footer.
    """
    reader = spark.read.format(cfg.table_format)
    if schema is None:
        return reader.option("mergeSchema", "true").load(path)
    if cfg.table_format != "delta":
        reader = reader.schema(schema)
    return reader.load(path).select(*schema.names)


def read_table_or_none(
    spark: SparkSession, cfg: EngineConfig, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The table, or None when nothing has been written there yet. Other failures propagate."""
    try:
        return read_table(spark, cfg, path, schema)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND"):
            return None
        raise


def stream_table(spark: SparkSession, cfg: EngineConfig, path: str, schema: T.StructType) -> DataFrame:
    """New rows of an append-only layer table as they are committed."""
    reader = spark.readStream.format(cfg.table_format)
    reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger or FILES_PER_BATCH)
    if cfg.table_format == "delta":
        reader = reader.option("ignoreChanges", "true")
    else:
        reader = reader.schema(schema)
    return reader.load(path).select(*schema.names)
