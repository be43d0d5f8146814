"""Streams whose micro-batches are replaced as a whole when they are replayed, and recorded once written."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netpulse import domain
from netpulse.config import EngineConfig
from netpulse.plans.writing import balanced
from netpulse.sources import folders
from netpulse.streaming.ledger import ForeignWriterError, Ledger

BATCH = "_batch_id"


@dataclass(frozen=True)
class Output:
    """A table that a stream writes: its rows out of the batch, and its partition columns."""

    name: str
    path: str
    rows: Callable[[DataFrame], DataFrame]
    partition_by: Sequence[str]


def measures() -> dict[str, Column]:
    """What is counted while rows are written. Dates are one entry per day, however many rows."""
    severity = F.col("severity")
    return {
        "rows": F.count(F.lit(1)),
        "dates": F.collect_set(F.col("event_date").cast("string")),
        "undated": F.count_if(F.col("event_date").isNull()),
        "null_event_ids": F.count_if(F.col("event_id").isNull()),
        "invalid_severity": F.count_if(~severity.isin(*domain.SEVERITIES)),
        "null_severity": F.count_if(severity.isNull()),
        "latest_event_us": F.max(F.unix_micros("event_ts")),
    }


def start_committed(
    df: DataFrame, cfg: EngineConfig, name: str, every: str, outputs: Sequence[Output]
) -> StreamingQuery:
    """Start a query that writes every micro-batch to all ``outputs``.

    A batch's rows lie in partitions that carry its number, so a replay overwrites exactly those.
    Before the write an adaptive rebalance by the partition columns sizes the files: a batch leaves
    files by bytes and not one per task and partition. Rows are counted in the same job, after the
    shuffle, so that a map task that has to run again does not count twice; then the ledger gets
    the batch's record. With several outputs the batch is held (memory, then disk) so that its
    source is read once; ``cfg.max_files_per_trigger`` bounds it.
    """
    spark, checkpoint = df.sparkSession, cfg.checkpoint(name)
    for output in outputs:
        if folders.exists(spark, f"{output.path}/_spark_metadata"):
            raise ForeignWriterError(f"{output.path} is a table of a file sink, which lists its files in its own log")
    claimed: set[str] = set()

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        writer, bounds = query_id(session, checkpoint), source_bounds(session, checkpoint, batch_id)
        held = batch.persist() if len(outputs) > 1 else batch
        try:
            for output in outputs:
                ledger = Ledger(session, cfg, output.name)
                if output.name not in claimed:  # a replay can only be the first batch after a start
                    ledger.claim(writer, batch_id, bounds)
                    claimed.add(output.name)
                seen = Observation()
                sized = balanced(output.rows(held), *output.partition_by).observe(
                    seen, *[measure.alias(key) for key, measure in measures().items()]
                )
                _replace_batch(sized.withColumn(BATCH, F.lit(batch_id)), cfg, output)
                ledger.record(writer, batch_id, bounds, seen.get)
        finally:
            if held is not batch:
                held.unpersist()

    stream = df.writeStream.option("checkpointLocation", checkpoint)
    return stream.trigger(**cfg.trigger(every)).foreachBatch(write).start()


def query_id(spark, checkpoint: str) -> str:
    """The id that the checkpoint gives its query; another checkpoint is another query."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id


def source_bounds(spark, checkpoint: str, batch_id: int) -> str:
    """Where the batch ends in each source, from the checkpoint's plan of it (written before it runs)."""
    lines = [row.value for row in spark.read.text(f"{checkpoint}/offsets/{batch_id}", wholetext=True).collect()]
    return "\n".join(lines[0].splitlines()[2:]) if lines else ""  # a version and the batch's clock come first


def _replace_batch(df: DataFrame, cfg: EngineConfig, output: Output) -> None:
    (
        df.write.format(cfg.table_format)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**cfg.sink_options)
        .partitionBy(*output.partition_by, BATCH)
        .save(output.path)
    )
