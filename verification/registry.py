"""Every operator as a runnable query over the ``events`` table of a scale-factor folder.

A query goes through the public functions only: events -> topic records -> Bronze -> Silver -> ...
Clock columns are left out and event times are returned without zone, so results compare with SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netpulse import schemas
from netpulse.config import EngineConfig
from netpulse.functions.numeric import round_half_up
from netpulse.operators import bronze as B
from netpulse.operators import gold, loading, quality
from netpulse.operators import silver as S
from netpulse.operators import views as V
from netpulse.plans import build, hourly
from netpulse.plans.writing import replace_table
from netpulse.session import fresh_folder, use_disk_state, prepare
from netpulse.sources import records as R
from netpulse.sources.tables import read_table
from netpulse.streaming import layers, progress, stateful, upserts
from verification import telemetry as X
from verification.oracles import PAYLOAD

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")  # results are compared as UTC wall time
        return comparable(fn(prepare(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return run


# --- shared steps ----------------------------------------------------------------------------------


def comparable(df: DataFrame) -> DataFrame:
    """Without clock columns; zoned timestamps as UTC wall time."""
    kept = [f for f in df.schema.fields if f.name not in schemas.CLOCK_COLUMNS]
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in kept
        ]
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.telemetry_records(X.read_events(spark, sf_dir))


def record_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.telemetry_records(X.stream_events(spark, sf_dir))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.to_bronze(records(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.to_silver(bronze(spark, sf_dir))


def alerts(spark: SparkSession, sf_dir: str, tier: str = "actionable") -> DataFrame:
    return S.to_alerts(bronze(spark, sf_dir), tier)


def last_event(spark: SparkSession, sf_dir: str) -> datetime:
    """The moment the data ends, used as the run's ``as_of``. One value, from column statistics."""
    return X.read_events(spark, sf_dir).agg(F.max("ts")).first()[0]


def workspace(spark: SparkSession, label: str, **settings) -> EngineConfig:
    return EngineConfig.under(fresh_folder(spark, label), available_now=True, **settings)


def spread_payload(bronze_rows: DataFrame) -> DataFrame:
    """Bronze with the payload map as one text column per key, and its size (maps cannot be compared)."""
    return bronze_rows.select(
        *[name for name in bronze_rows.columns if name != "payload"],
        *[F.col("payload")[key].alias(f"payload_{key}") for key in PAYLOAD],
        F.size("payload").alias("payload_size"),
    )


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: round_half_up(F.col(name), 6) for name in columns})


def health_rounded(df: DataFrame) -> DataFrame:
    return rounded(df, "avg_cpu_pct", "avg_memory_pct", "avg_temp_celsius")


def reliability_rounded(df: DataFrame) -> DataFrame:
    return rounded(df, "avg_packet_loss", "avg_bandwidth_util")


def stored_silver(spark: SparkSession, sf_dir: str, label: str) -> EngineConfig:
    """A workspace holding the Silver table, written without a shuffle."""
    cfg = workspace(spark, label)
    replace_table(silver(spark, sf_dir), cfg, cfg.silver, layers.SILVER_PARTITIONS)
    return cfg


# --- Bronze ----------------------------------------------------------------------------------------


@query
def bronze_parse(spark, sf_dir):
    return spread_payload(bronze(spark, sf_dir))


def _variant_bronze(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """Bronze with variant payloads, written and read back."""
    cfg = workspace(spark, label, payload="variant")
    replace_table(B.to_bronze(records(spark, sf_dir), payload=cfg.payload), cfg, cfg.bronze, layers.BRONZE_PARTITIONS)
    return read_table(spark, cfg, cfg.bronze, schemas.bronze_schema(cfg.payload))


@query
def bronze_variant(spark, sf_dir):
    """All payload keys, the numbers with a fraction as numbers."""
    rows = _variant_bronze(spark, sf_dir, "variant")
    doubles = {key for key, _, kind in schemas.PAYLOAD_COLUMNS if kind == "double"}
    get = lambda key: F.try_variant_get("payload", f"$.{key}", "double" if key in doubles else "string")
    return rows.select(
        *[name for name in rows.columns if name != "payload"],
        *[get(key).cast("string").alias(f"payload_{key}") for key in PAYLOAD],
        F.size(F.from_json(F.to_json("payload"), "map<string,string>")).alias("payload_size"),
    )


@query
def silver_from_variant(spark, sf_dir):
    return S.to_silver(_variant_bronze(spark, sf_dir, "variant-silver"))


@query
def bronze_metadata(spark, sf_dir):
    return bronze(spark, sf_dir).select("event_id", "timestamp", "event_ts", "_source")


@query
def batch_scan_bronze(spark, sf_dir):
    cfg = workspace(spark, "scan")
    replace_table(bronze(spark, sf_dir), cfg, cfg.bronze, layers.BRONZE_PARTITIONS)
    return spread_payload(read_table(spark, cfg, cfg.bronze, schemas.BRONZE))


@query
def topk_latest_bronze(spark, sf_dir):
    columns = ["event_id", "event_type", "device_id", "severity", "event_ts", "kafka_timestamp"]
    return S.latest(bronze(spark, sf_dir), "kafka_timestamp", columns, 10)


@query
def encode_decode_roundtrip(spark, sf_dir):
    once = B.parse_records(records(spark, sf_dir))
    again = R.encode_events(
        once, partition=F.col("kafka_partition"), offset=F.col("kafka_offset"), timestamp=F.col("kafka_timestamp")
    )
    return spread_payload(B.to_bronze(again))


@query
def gate_recent_events(spark, sf_dir):
    return quality.recent_records(bronze(spark, sf_dir), last_event(spark, sf_dir))


# --- Silver ----------------------------------------------------------------------------------------


@query
def silver_flatten(spark, sf_dir):
    flat = S.flatten_payload(bronze(spark, sf_dir))
    return flat.select("event_id", "event_type", *[column for _, column, _ in schemas.PAYLOAD_COLUMNS])


@query
def silver_enrich(spark, sf_dir):
    return silver(spark, sf_dir)


@query
def classify_severity(spark, sf_dir):
    flat = S.flatten_payload(bronze(spark, sf_dir))
    return S.classify_severity(flat).select("event_id", "event_type", "severity", "expected_severity")


@query
def filter_alerts(spark, sf_dir):
    return alerts(spark, sf_dir)


@query
def silver_critical_sample(spark, sf_dir):
    return S.critical_sample(silver(spark, sf_dir))


# --- Gold ------------------------------------------------------------------------------------------


@query
def gold_device_health(spark, sf_dir):
    return health_rounded(gold.device_health(silver(spark, sf_dir)))


@query
def gold_alert_summary(spark, sf_dir):
    return gold.alert_summary(silver(spark, sf_dir))


@query
def gold_network_reliability(spark, sf_dir):
    return reliability_rounded(gold.network_reliability(silver(spark, sf_dir)))


@query
def gold_security_threats(spark, sf_dir):
    return gold.security_threats(silver(spark, sf_dir))


@query
def gold_write_roundtrip(spark, sf_dir):
    cfg = stored_silver(spark, sf_dir, "gold")
    return reliability_rounded(build.build_gold(spark, cfg)["network_reliability"])


def _built(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return build.build_gold(spark, stored_silver(spark, sf_dir, f"gold-{name}"))[name]


@query
def gold_write_health(spark, sf_dir):
    return health_rounded(_built(spark, sf_dir, "device_health_kpis"))


@query
def gold_write_alerts(spark, sf_dir):
    return _built(spark, sf_dir, "alert_summary")


@query
def gold_write_threats(spark, sf_dir):
    return _built(spark, sf_dir, "security_threats")


@query
def gold_reliability_monthly(spark, sf_dir):
    """Months from hourly sketches; so few devices are counted exactly."""
    return reliability_rounded(gold.reliability_by(gold.sketch_rollup(gold.contributions(silver(spark, sf_dir)))))


@query
def gold_audit(spark, sf_dir):
    cfg = stored_silver(spark, sf_dir, "audit")
    build.build_gold(spark, cfg)
    return build.audit_gold(spark, cfg)


@query
def gold_incremental_equals_full(spark, sf_dir):
    """One topic partition lags: its events of the second half of the month arrive after the first
    build. Only the dates they touch are rebuilt; the result must equal a full build."""
    cfg = workspace(spark, "incremental")
    rows = S.enriched(bronze(spark, sf_dir))
    late = (F.col("kafka_partition") == 2) & (F.dayofmonth("event_ts") >= 16)
    first, second = rows.filter(~late), rows.filter(late)
    replace_table(first.select(*schemas.SILVER.names), cfg, cfg.silver, layers.SILVER_PARTITIONS)
    build.build_gold(spark, cfg)
    started = spark.range(1).select(F.current_timestamp()).first()[0]
    second.select(*schemas.SILVER.names).write.mode("append").partitionBy(*layers.SILVER_PARTITIONS).parquet(cfg.silver)
    dates = build.touched_dates(build.read_silver(spark, cfg), started)
    return build.build_gold(spark, cfg, dates)["alert_summary"]


def _hourly(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Two hourly runs; between them a topic partition delivers what it held back, for many past dates.
    The second run finds the dates in the ledger of committed batches."""
    landing = fresh_folder(spark, "landing")
    cfg = workspace(spark, "hourly", record_source="files", records_path=landing)
    rows, held_back = records(spark, sf_dir), (F.col("partition") == 2) & (F.dayofmonth("timestamp") < 28)
    as_of = last_event(spark, sf_dir)
    for part in (rows.filter(~held_back), rows.filter(held_back)):
        part.write.mode("append").parquet(landing)
        layers.drain(layers.start_bronze(spark, cfg))
        report = hourly.run_hourly(spark, cfg, as_of)
    assert report.dates is not None
    return build.read_gold_table(spark, cfg, name)


@query
def hourly_incremental_reliability(spark, sf_dir):
    return reliability_rounded(_hourly(spark, sf_dir, "network_reliability"))


@query
def hourly_incremental_health(spark, sf_dir):
    return health_rounded(_hourly(spark, sf_dir, "device_health_kpis"))


# --- aggregate functions ----------------------------------------------------------------------------


@query
def agg_avg_max_min(spark, sf_dir):
    stats = silver(spark, sf_dir).groupBy("device_type").agg(
        F.avg("cpu_utilization_pct").alias("avg_cpu"),
        F.max("cpu_utilization_pct").alias("max_cpu"),
        F.min("cpu_utilization_pct").alias("min_cpu"),
        F.avg("packet_loss_pct").alias("avg_loss"),
        F.max("packet_loss_pct").alias("max_loss"),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
    )
    return rounded(stats, "avg_cpu", "avg_loss")


@query
def agg_count_nonnull(spark, sf_dir):
    return silver(spark, sf_dir).groupBy("event_type").agg(
        F.count("*").alias("all_rows"),
        F.count("event_id").alias("ids"),
        F.count("cpu_utilization_pct").alias("cpu_readings"),
        F.count("packet_count").alias("packet_readings"),
        F.count("link_state").alias("link_readings"),
    )


@query
def agg_count_distinct(spark, sf_dir):
    return silver(spark, sf_dir).groupBy("location", "event_date").agg(
        F.count_distinct("device_id").alias("devices"), F.count_distinct("event_type").alias("event_types")
    )


@query
def agg_conditional_sum(spark, sf_dir):
    critical = F.col("severity") == "CRITICAL"
    return silver(spark, sf_dir).groupBy("location").agg(
        F.count_if(F.col("severity").isin("CRITICAL", "ERROR")).alias("incidents"),
        F.sum(F.col("requires_action").cast("long")).alias("actionable"),
        F.sum(F.when(critical, F.col("packet_count"))).alias("critical_packets"),
    )


@query
def agg_mode(spark, sf_dir):
    return silver(spark, sf_dir).groupBy("location").agg(F.mode("severity", True).alias("typical_severity"))


# --- views and queries --------------------------------------------------------------------------------


@query
def vw_executive(spark, sf_dir):
    return V.executive(gold.network_reliability(silver(spark, sf_dir)))


@query
def vw_device_health_summary(spark, sf_dir):
    return V.device_health_summary(gold.device_health(silver(spark, sf_dir)))


@query
def vw_critical_alerts_24h(spark, sf_dir):
    return V.critical_alerts_24h(gold.alert_summary(silver(spark, sf_dir)), last_event(spark, sf_dir))


@query
def vw_sla_breaches(spark, sf_dir):
    return V.sla_breaches(gold.network_reliability(silver(spark, sf_dir)))


@query
def q1_sla_compliance(spark, sf_dir):
    return V.current_sla_compliance(gold.network_reliability(silver(spark, sf_dir)))


@query
def q2_problem_devices(spark, sf_dir):
    return V.problem_devices(gold.device_health(silver(spark, sf_dir)))


@query
def q3_alert_trend(spark, sf_dir):
    return V.alert_trend(gold.alert_summary(silver(spark, sf_dir)))


@query
def q4_threat_breakdown(spark, sf_dir):
    return V.threat_breakdown(gold.security_threats(silver(spark, sf_dir)))


@query
def q5_bandwidth_by_location(spark, sf_dir):
    return V.bandwidth_by_location(gold.network_reliability(silver(spark, sf_dir)))


@query
def topk_incident_locations(spark, sf_dir):
    return V.incident_hotspots(gold.network_reliability(silver(spark, sf_dir)))


# --- quality, gates, digest -----------------------------------------------------------------------------


@query
def dq_checks(spark, sf_dir):
    """Judged as of one day before the data ends, so the last day counts as future."""
    return quality.dq_checks(silver(spark, sf_dir), last_event(spark, sf_dir) - timedelta(days=1))


@query
def dq_checks_observed(spark, sf_dir):
    """:func:`dq_checks`, counted while Silver is written."""
    rows, seen = quality.watched(silver(spark, sf_dir), last_event(spark, sf_dir) - timedelta(days=1))
    cfg = workspace(spark, "watched")
    replace_table(rows, cfg, cfg.silver, layers.SILVER_PARTITIONS)
    return quality.watched_checks(spark, seen)


@query
def gate_critical_alerts(spark, sf_dir):
    return quality.recent_critical(alerts(spark, sf_dir), last_event(spark, sf_dir))


@query
def alert_digest(spark, sf_dir):
    return quality.alert_digest(alerts(spark, sf_dir), last_event(spark, sf_dir))


# --- serving load ------------------------------------------------------------------------------------------


def _loaded(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    cfg = workspace(spark, f"load-{name}")
    table = gold.BUILDERS[name](gold.contributions(silver(spark, sf_dir)))
    replace_table(table, cfg, cfg.gold(name))
    return build.load_serving(spark, cfg, tables=[name])[name]


@query
def load_serving_device_health(spark, sf_dir):
    return health_rounded(_loaded(spark, sf_dir, "device_health_kpis"))


@query
def load_serving_alert_summary(spark, sf_dir):
    return _loaded(spark, sf_dir, "alert_summary")


@query
def load_serving_reliability(spark, sf_dir):
    return reliability_rounded(_loaded(spark, sf_dir, "network_reliability"))


@query
def load_serving_security(spark, sf_dir):
    return _loaded(spark, sf_dir, "security_threats")


@query
def load_rejects(spark, sf_dir):
    """Reliability rows refused by a contract that allows eight characters for a location."""
    strict = schemas.NETWORK_RELIABILITY.with_limits(location=8)
    _, rejected = loading.split_by_contract(gold.network_reliability(silver(spark, sf_dir)), strict)
    listed = rejected.withColumn("violation", F.array_join("violations", "; ")).drop("violations")
    return reliability_rounded(listed)


# --- streams -------------------------------------------------------------------------------------------------


def _streamed_bronze(spark: SparkSession, sf_dir: str, label: str, **settings) -> EngineConfig:
    cfg = workspace(spark, label, **settings)
    layers.drain(layers.start_bronze(spark, cfg, record_stream(spark, sf_dir)))
    return cfg


@query
def stream_source_kafka_shape(spark, sf_dir):
    landing = fresh_folder(spark, "landing")
    records(spark, sf_dir).write.parquet(landing)
    cfg = workspace(spark, "source", record_source="files", records_path=landing)
    layers.drain(layers.append_stream(R.stream_records(spark, cfg), cfg, "copy", cfg.table("copy"), cfg.bronze_every))
    return spread_payload(B.to_bronze(read_table(spark, cfg, cfg.table("copy"), schemas.KAFKA_RECORD)))


@query
def stream_bronze(spark, sf_dir):
    cfg = _streamed_bronze(spark, sf_dir, "bronze")
    return spread_payload(read_table(spark, cfg, cfg.bronze, schemas.BRONZE))


@query
def stream_silver(spark, sf_dir):
    cfg = _streamed_bronze(spark, sf_dir, "silver")
    layers.drain(layers.start_silver(spark, cfg))
    return build.read_silver(spark, cfg)


@query
def stream_alerts(spark, sf_dir):
    cfg = _streamed_bronze(spark, sf_dir, "alerts")
    layers.drain(layers.start_silver(spark, cfg), layers.start_alerts(spark, cfg))
    return read_table(spark, cfg, cfg.alerts, schemas.ALERTS)


@query
def stream_restart_no_dup(spark, sf_dir):
    """Every query is started twice over the same input; the second start finds nothing new."""
    cfg = workspace(spark, "restart")
    for _ in range(2):
        layers.drain(layers.start_bronze(spark, cfg, record_stream(spark, sf_dir)))
        layers.drain(layers.start_silver(spark, cfg))
    return build.read_silver(spark, cfg)


@query
def stream_equals_batch(spark, sf_dir):
    """Row counts and content checksums per day and event type, stream against batch."""
    cfg = _streamed_bronze(spark, sf_dir, "equal")
    layers.drain(layers.start_silver(spark, cfg))
    stable = [name for name in schemas.SILVER.names if name not in schemas.CLOCK_COLUMNS]
    checksum = F.sum(F.xxhash64(*stable).cast("decimal(20,0)"))

    def digest(df: DataFrame, side: str) -> DataFrame:
        rows = F.count("*").alias(f"{side}_rows")
        return df.groupBy("event_date", "event_type").agg(rows, checksum.alias(f"{side}_sum"))

    streamed = digest(build.read_silver(spark, cfg), "stream")
    batched = digest(silver(spark, sf_dir), "batch")
    both = streamed.join(batched, ["event_date", "event_type"], "full_outer")
    same = F.col("stream_sum").eqNullSafe(F.col("batch_sum"))
    return both.select("event_date", "event_type", "stream_rows", "batch_rows", same.alias("same_rows"))


@query
def stream_progress(spark, sf_dir):
    cfg = workspace(spark, "progress")
    log = progress.ProgressTable(spark, cfg.table("progress"))
    spark.streams.addListener(log)
    try:
        running = layers.start_bronze(spark, cfg, record_stream(spark, sf_dir))
        layers.drain(running)
        log.settle()
    finally:
        spark.streams.removeListener(log)
    return log.rows(str(running.id)).select("batch_id", "input_rows")


# --- extensions ------------------------------------------------------------------------------------------------


@query
def ext_dedup_events(spark, sf_dir):
    """Every record delivered twice, the second time at a later offset."""
    once = records(spark, sf_dir)
    again = once.withColumns(
        {"offset": F.col("offset") + F.lit(1 << 40), "timestamp": F.col("timestamp") + F.expr("INTERVAL 1 SECOND")}
    )
    return S.to_silver(S.deduplicate(B.to_bronze(once.unionByName(again))))


@query
def ext_dedup_stream(spark, sf_dir):
    """Every record delivered twice, on a stream."""
    cfg = workspace(use_disk_state(spark), "dedup")
    twice = record_stream(spark, sf_dir).unionByName(record_stream(spark, sf_dir))
    unique = S.to_silver(stateful.deduplicate_stream(B.to_bronze(twice)))
    layers.drain(layers.append_stream(unique, cfg, "unique", cfg.silver, cfg.silver_every, layers.SILVER_PARTITIONS))
    return build.read_silver(spark, cfg)


@query
def ext_rejects(spark, sf_dir):
    """Security records cut in half, link records without value."""
    kind = F.get_json_object(F.col("value").cast("string"), "$.event_type")
    text = F.col("value").cast("string")
    cut = F.substring(text, F.lit(1), (F.length(text) / 2).cast("int")).cast("binary")
    damaged = F.when(kind == "security_alert", cut).when(kind != "link_state", F.col("value"))
    rejected = B.rejects(records(spark, sf_dir).withColumn("value", damaged))
    raw = F.col("raw_value").cast("string").alias("raw_value")
    return rejected.select("kafka_key", "kafka_partition", "kafka_offset", "reason", raw)


@query
def ext_critical_alerts(spark, sf_dir):
    return alerts(spark, sf_dir, tier="critical")


def _silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.to_silver(B.to_bronze(record_stream(use_disk_state(spark), sf_dir)))


@query
def ext_windowed_health(spark, sf_dir):
    cfg = workspace(spark, "windows")
    layers.drain(upserts.start_live_health(spark, cfg, _silver_stream(spark, sf_dir)))
    return health_rounded(upserts.read_live_health(spark, cfg)).drop("event_date", "event_hour")


def _live(spark: SparkSession, sf_dir: str, label: str) -> EngineConfig:
    cfg = workspace(spark, label)
    layers.drain(upserts.start_live_rollup(spark, cfg, _silver_stream(spark, sf_dir)))
    return cfg


@query
def ext_windowed_reliability(spark, sf_dir):
    rollup = upserts.read_live_rollup(spark, _live(spark, sf_dir, "live-hours"))
    return reliability_rounded(gold.hourly_reliability_from(rollup))


@query
def ext_live_gold_alerts(spark, sf_dir):
    return upserts.read_live_gold(spark, _live(spark, sf_dir, "live-alerts"))["alert_summary"]


@query
def ext_live_gold_threats(spark, sf_dir):
    return upserts.read_live_gold(spark, _live(spark, sf_dir, "live-threats"))["security_threats"]


@query
def ext_sla_by_location(spark, sf_dir):
    return V.sla_by_location(gold.network_reliability(silver(spark, sf_dir)))
