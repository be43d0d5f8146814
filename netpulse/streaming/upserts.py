"""Tables that follow a changing stream: every micro-batch replaces the rows whose keys it carries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netpulse.config import EngineConfig
from netpulse.functions.utc import utc_date, utc_hour
from netpulse.operators import gold
from netpulse.operators.silver import enriched
from netpulse.plans.writing import balanced, replace_partitions
from netpulse.schemas import bronze_schema
from netpulse.session import prepare, use_disk_state
from netpulse.sources import folders
from netpulse.sources.tables import read_table, read_table_or_none, stream_table
from netpulse.streaming import stateful

#: Stored state of the streamed rollup, and the partitions that a micro-batch rewrites.
LIVE_ROLLUP, LIVE_HEALTH = "live_rollup", "live_health"
HOURS = ("event_date", "event_hour")


def start_upserts(
    df: DataFrame, cfg: EngineConfig, name: str, keys: Sequence[str], partition_by: Sequence[str], every: str
) -> StreamingQuery:
    """Keep the table ``name`` at the latest row per key of an update-mode stream.

    A batch rewrites the partitions it touches: their stored rows and the batch's, of which the later
    row per key stays. ``keys`` must determine ``partition_by``. The new content is staged before it
    replaces the old, under the batch's number: a replay after a failure in the middle of the
    replacement takes it from there and not from what was left of the table.
    """
    path, staged = cfg.table(name), cfg.table(f"staged/{name}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, stage = batch.sparkSession, f"{staged}/batch_id={batch_id}"
        if not folders.exists(spark, f"{stage}/_SUCCESS"):
            held = batch.persist()  # state is updated once, however often the batch is read
            try:
                _merged(spark, cfg, held, path, keys, partition_by).write.mode("overwrite").parquet(stage)
            finally:
                held.unpersist()
        else:  # the stream's state has to reach this batch too
            batch.write.format("noop").mode("overwrite").save()
        replace_partitions(balanced(spark.read.schema(df.schema).parquet(stage), *partition_by), cfg, path, partition_by)
        for old in folders.children(spark, staged):
            if old != f"batch_id={batch_id}":
                folders.remove(spark, f"{staged}/{old}")

    stream = df.writeStream.outputMode("update").option("checkpointLocation", cfg.checkpoint(name))
    return stream.trigger(**cfg.trigger(every)).foreachBatch(write).start()


def _merged(
    spark: SparkSession, cfg: EngineConfig, batch: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str]
) -> DataFrame:
    stored = read_table_or_none(spark, cfg, path, batch.schema)
    if stored is None:
        return batch
    touched = [tuple(row) for row in batch.select(*partition_by).distinct().collect()]  # windows, not rows
    both = stored.filter(_in_partitions(partition_by, touched)).withColumn("_later", F.lit(0)).unionByName(
        batch.withColumn("_later", F.lit(1))
    )
    row = F.struct(*batch.columns)
    return both.groupBy(*keys).agg(F.max_by(row, "_later").alias("_row")).select("_row.*")


def _in_partitions(names: Sequence[str], values: list[tuple]) -> Column:
    """A filter that prunes partitions: per first value, the rest."""
    found = F.lit(False)
    for first in {value[0] for value in values}:
        rest = F.lit(False)
        for value in (v for v in values if v[0] == first):
            same = F.lit(True)
            for name, part in zip(names[1:], value[1:]):
                same = same & F.col(name).eqNullSafe(F.lit(part))
            rest = rest | same
        found = found | (F.col(names[0]).eqNullSafe(F.lit(first)) & rest)
    return found


def start_live_rollup(
    spark: SparkSession, cfg: EngineConfig, silver: DataFrame | None = None, delay: str = "1 hour"
) -> StreamingQuery:
    """Device rollup per hour that follows Bronze within a trigger; see :func:`read_live_gold`."""
    rollup = stateful.live_rollup(_silver_stream(spark, cfg) if silver is None else silver, delay)
    return start_upserts(rollup, cfg, LIVE_ROLLUP, gold.ROLLUP_KEYS, HOURS, cfg.silver_every)


def start_live_health(
    spark: SparkSession, cfg: EngineConfig, silver: DataFrame | None = None, delay: str = "1 hour"
) -> StreamingQuery:
    """Device health per hour window, each window current from its first event on."""
    windows = stateful.windowed_device_health(_silver_stream(spark, cfg) if silver is None else silver, delay)
    keys = ["window_start", "device_id", "device_type", "location", "location_type"]
    dated = windows.withColumns({"event_date": utc_date(F.col("window_start")), "event_hour": utc_hour(F.col("window_start"))})
    return start_upserts(dated, cfg, LIVE_HEALTH, keys, HOURS, cfg.silver_every)


def read_live_health(spark: SparkSession, cfg: EngineConfig) -> DataFrame:
    """Health per device and window as of the last micro-batch of :func:`start_live_health`."""
    return read_table(spark, cfg, cfg.table(LIVE_HEALTH))


def read_live_gold(spark: SparkSession, cfg: EngineConfig) -> dict[str, DataFrame]:
    """The four Gold tables as of the last micro-batch of :func:`start_live_rollup`."""
    rollup = read_live_rollup(spark, cfg)
    return {name: build(rollup) for name, build in gold.BUILDERS.items()}


def read_live_rollup(spark: SparkSession, cfg: EngineConfig) -> DataFrame:
    return read_table(spark, cfg, cfg.table(LIVE_ROLLUP), gold.rollup_schema())


def _silver_stream(spark: SparkSession, cfg: EngineConfig) -> DataFrame:
    return enriched(stream_table(use_disk_state(prepare(spark)), cfg, cfg.bronze, bronze_schema(cfg.payload)))
