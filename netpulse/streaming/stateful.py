"""Stateful streaming operators: duplicate removal and windowed KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netpulse import domain
from netpulse.functions import events as E
from netpulse.functions import kpi
from netpulse.functions.numeric import ratio
from netpulse.operators.gold import ROLLUP_KEYS, contributions, merge
from netpulse.operators.silver import event_identity


def deduplicate_stream(events: DataFrame, delay: str = "1 hour", spread: int = 16) -> DataFrame:
    """One row per event id among copies that arrive within ``delay`` of the first.

    Ids are remembered by arrival, the clock of the micro-batch, which every row of a batch shares and
    which never goes back: so no row is late and none is lost, however old its event time or if it has
    none, and state is bounded by what arrives within ``delay``. Rows without id are told apart by
    their record coordinates. Copies are first reduced per (id, slice of the record offset) and then
    per id; an id repeated across much of the stream is thereby handled by ``spread`` tasks before
    it meets in one.
    """
    keyed = events.withColumns(
        {
            "_identity": event_identity(),
            "_slice": F.pmod(F.xxhash64("kafka_partition", "kafka_offset"), F.lit(spread)),
            "_arrival": F.current_timestamp(),
        }
    )
    sliced = keyed.withWatermark("_arrival", delay).dropDuplicatesWithinWatermark(["_identity", "_slice"])
    return sliced.dropDuplicatesWithinWatermark(["_identity"]).drop("_identity", "_slice", "_arrival")


def windowed_device_health(silver: DataFrame, delay: str = "1 hour", length: str = "1 hour") -> DataFrame:
    """Device health per tumbling window. In update mode a window comes out with every change, in append
    mode once the watermark has passed its end. Events beyond the watermark and undated ones are left
    to the batch tables."""
    readings = silver.filter(F.col("event_type") == domain.DEVICE_HEALTH)
    # An event's first_ts contribution is its own time, so it also places the event in a window.
    parts = contributions(readings.withWatermark("event_ts", delay)).withColumn("window", F.window("first_ts", length))
    keys = ["window", "device_id", "device_type", "location", "location_type"]
    means = {short: ratio(F.col(f"{short}_sum"), F.col(f"{short}_n")) for short in ("cpu", "memory", "temp")}
    scored = merge(parts, keys).withColumns(
        {**{f"mean_{k}": v for k, v in means.items()}, "health_score": kpi.health_score(*means.values())}
    )
    return scored.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "device_id",
        "device_type",
        "location",
        "location_type",
        F.col("mean_cpu").alias("avg_cpu_pct"),
        F.col("cpu_max").alias("max_cpu_pct"),
        F.col("mean_memory").alias("avg_memory_pct"),
        F.col("memory_max").alias("max_memory_pct"),
        F.col("mean_temp").alias("avg_temp_celsius"),
        F.col("temp_max").alias("max_temp_celsius"),
        F.col("events").alias("sample_count"),
        F.col("incidents").alias("critical_count"),
        "health_score",
        E.health_status(F.col("health_score")).alias("health_status"),
    )


def live_rollup(silver: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The device rollup of :mod:`netpulse.operators.gold` as a stream, for update mode: every row is the
    state of a device, hour and event class so far. All Gold tables follow from it in batch, with
    exact distinct counts. State is one row per key and hour until the watermark has passed the hour."""
    parts = contributions(silver.withWatermark("event_ts", delay))
    hours = parts.withColumn("window", F.window("first_ts", "1 hour"))
    return merge(hours, ["window", *ROLLUP_KEYS]).drop("window")


def windowed_reliability(silver: DataFrame, delay: str = "1 hour", length: str = "1 hour") -> DataFrame:
    """Incident rate and SLA verdict per tumbling window. ``device_count`` is approximate here: an
    exact distinct count is not available on a stream and stays with the batch tables."""
    keys = ["location", "location_type", "device_type"]
    counted = (
        silver.withWatermark("event_ts", delay)
        .groupBy(F.window("event_ts", length).alias("window"), *keys)
        .agg(
            F.count("event_id").alias("total_events"),
            F.count_if(E.is_incident(F.col("severity"))).alias("incident_count"),
            F.approx_count_distinct("device_id").alias("device_count"),
        )
    )
    rate = kpi.incident_rate_pct(F.col("incident_count"), F.col("total_events"))
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        "total_events",
        "incident_count",
        "device_count",
        rate.alias("incident_rate_pct"),
        kpi.availability_pct(rate).alias("availability_pct"),
        kpi.sla_met(kpi.availability_pct(rate)).alias("sla_met"),
    )
