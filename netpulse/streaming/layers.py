"""Streaming queries that keep Bronze, Silver and Alerts up to date.

Each query owns its checkpoint. All transformations are the batch functions of
``netpulse.operators``, so a stream and a batch over the same records give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netpulse.config import EngineConfig
from netpulse.operators.bronze import rejects, to_bronze
from netpulse.operators.silver import enriched, select_alerts
from netpulse.plans.writing import replace_table
from netpulse.schemas import ALERTS, SILVER, bronze_schema
from netpulse.session import prepare
from netpulse.sources import folders
from netpulse.sources.records import stream_records
from netpulse.sources.tables import stream_table
from netpulse.streaming.commits import BATCH, Output, start_committed

BRONZE_PARTITIONS = ("_batch_date", "event_type")
SILVER_PARTITIONS = ("event_date", "severity")
ALERT_PARTITIONS = ("event_date",)


#: The last query that this process started on each checkpoint.
_LIVE: dict[str, StreamingQuery] = {}


def start_bronze(spark: SparkSession, cfg: EngineConfig, records: DataFrame | None = None) -> StreamingQuery:
    """Records to Bronze. ``cfg.quarantine`` keeps unreadable records out (see :func:`start_rejects`)."""
    source = stream_records(prepare(spark), cfg) if records is None else records
    rows = to_bronze(source, drop_rejects=cfg.quarantine, payload=cfg.payload)
    if cfg.bronze_files:
        spread = F.pmod(F.xxhash64("kafka_partition", "kafka_offset"), F.lit(cfg.bronze_files))
        rows = rows.repartition(*BRONZE_PARTITIONS, spread)
    return append_stream(rows, cfg, "bronze", cfg.bronze, cfg.bronze_every, BRONZE_PARTITIONS)


def start_rejects(spark: SparkSession, cfg: EngineConfig, records: DataFrame | None = None) -> StreamingQuery:
    """Unreadable records, raw, to the rejects table."""
    source = stream_records(prepare(spark), cfg) if records is None else records
    return append_stream(rejects(source), cfg, "rejects", cfg.rejects, cfg.bronze_every)


def _silver(cfg: EngineConfig) -> Output:
    return Output("silver", cfg.silver, lambda batch: batch.select(*SILVER.names), SILVER_PARTITIONS)


def _alerts(cfg: EngineConfig) -> Output:
    def rows(batch: DataFrame) -> DataFrame:
        return select_alerts(batch, cfg.alert_tier).select(*ALERTS.names)

    return Output("alerts", cfg.alerts, rows, ALERT_PARTITIONS)


def start_silver(spark: SparkSession, cfg: EngineConfig) -> StreamingQuery:
    bronze = stream_table(prepare(spark), cfg, cfg.bronze, bronze_schema(cfg.payload))
    return _started(start_committed(enriched(bronze), cfg, "silver", cfg.silver_every, [_silver(cfg)]), cfg, "silver")


def start_alerts(spark: SparkSession, cfg: EngineConfig, records: DataFrame | None = None) -> StreamingQuery:
    """Alerts on their own, faster path.

    They follow Bronze commits, or, with ``cfg.alerts_from='source'``, the topic itself, which
    saves the wait for the Bronze trigger.
    """
    prepare(spark)
    if records is not None or cfg.alerts_from == "source":
        bronze = to_bronze(stream_records(spark, cfg) if records is None else records, drop_rejects=cfg.quarantine)
    else:
        bronze = stream_table(spark, cfg, cfg.bronze, bronze_schema(cfg.payload))
    return _started(start_committed(enriched(bronze), cfg, "alerts", cfg.alerts_every, [_alerts(cfg)]), cfg, "alerts")


def start_silver_and_alerts(spark: SparkSession, cfg: EngineConfig) -> StreamingQuery:
    """Both layers from one scan of Bronze, for loads where reading it twice costs more than latency."""
    bronze = stream_table(prepare(spark), cfg, cfg.bronze, bronze_schema(cfg.payload))
    name, outputs = "silver_and_alerts", [_silver(cfg), _alerts(cfg)]
    return _started(start_committed(enriched(bronze), cfg, name, cfg.alerts_every, outputs), cfg, name)


def clear_enriched(spark: SparkSession, cfg: EngineConfig) -> None:
    """Empty Silver and Alerts and forget their batches, so that a new checkpoint may fill them from Bronze.

    For a lost checkpoint: its batches cannot be told from those of a new one, so a query with a new
    checkpoint is refused until the tables are cleared.
    """
    for output, schema in ((_silver(cfg), SILVER), (_alerts(cfg), ALERTS)):
        if folders.exists(spark, output.path):
            empty = spark.createDataFrame([], schema).withColumn(BATCH, F.lit(0))
            replace_table(empty, cfg, output.path, (*output.partition_by, BATCH))
        folders.remove(spark, cfg.table(f"ledger/{output.name}"))


def start_enriched(spark: SparkSession, cfg: EngineConfig) -> list[StreamingQuery]:
    """Silver and Alerts in the way ``cfg.fan_out`` names."""
    return [start(spark, cfg) for start in _enriched_starts(cfg).values()]


def catch_up(spark: SparkSession, cfg: EngineConfig) -> None:
    """Bring Silver and Alerts up to what Bronze holds now, and leave running streams running.

    A layer with a live query of this process is waited for; starting another query on its checkpoint
    would stop it. The other layers are brought up by a query that ends by itself. A stream of another
    session holds its checkpoint, and Spark then refuses the second writer.
    """
    started = []
    for name, start in _enriched_starts(cfg).items():
        live = _LIVE.get(cfg.checkpoint(name))
        if live is not None and live.isActive:
            live.processAllAvailable()
        else:
            started.append(start(spark, cfg.but(available_now=True)))
    drain(*started)


def _enriched_starts(cfg: EngineConfig) -> dict[str, Callable[[SparkSession, EngineConfig], StreamingQuery]]:
    """Start functions by checkpoint name."""
    if cfg.fan_out == "single_scan":
        return {"silver_and_alerts": start_silver_and_alerts}
    return {"silver": start_silver, "alerts": start_alerts}


def append_stream(
    df: DataFrame,
    cfg: EngineConfig,
    name: str,
    path: str,
    every: str,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Start an append query into a layer table. Map-only: rows go from source task to file."""
    writer = (
        df.writeStream.format(cfg.table_format)
        .outputMode("append")
        .option("checkpointLocation", cfg.checkpoint(name))
        .options(**cfg.sink_options)
        .trigger(**cfg.trigger(every))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _started(writer.start(path), cfg, name)


def _started(query: StreamingQuery, cfg: EngineConfig, name: str) -> StreamingQuery:
    for checkpoint in [place for place, other in _LIVE.items() if not other.isActive]:
        del _LIVE[checkpoint]
    _LIVE[cfg.checkpoint(name)] = query
    return query


def drain(*queries: StreamingQuery) -> None:
    """Wait for ``available_now`` queries to finish; a failure of any is raised as soon as it happens."""
    waiting = list(queries)
    while waiting:
        waiting = [query for query in waiting if not query.awaitTermination(1)]
