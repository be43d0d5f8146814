"""Gold KPI tables as merges of per-event contributions.

Every measure the four tables need is additive or an extreme, so it is carried as a *contribution*:
an event contributes its reading, a 1 to a count, its timestamp to a minimum, and so on. Merging
contributions by any set of keys gives contributions again (:func:`merge`), so

* one scan of Silver can be reduced to a small rollup per device and hour (:func:`device_rollup`),
  from which all four tables follow, and
* a table computed straight from Silver and one computed from the rollup are the same table.

Distinct devices are counted by first merging to (keys, device): the shuffle moves one row per
device and task, however many events one location or device type holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netpulse import domain
from netpulse.functions import events as E
from netpulse.functions import kpi
from netpulse.functions.numeric import ratio, round_half_up
from netpulse.schemas import (
    ALERT_SUMMARY,
    DEVICE_HEALTH_KPIS,
    NETWORK_RELIABILITY,
    SECURITY_THREATS,
    SILVER,
    Contract,
)

ROLLUP_KEYS = (
    "event_date",
    "event_hour",
    "device_id",
    "device_type",
    "location",
    "location_type",
    "event_type",
    "severity",
    "requires_action",
    "alert_type",
    "protocol",
)

_AVERAGED = {
    "cpu": "cpu_utilization_pct",
    "memory": "memory_utilization_pct",
    "temp": "temperature_celsius",
    "loss": "packet_loss_pct",
    "bandwidth": "bandwidth_utilization",
}

_MERGES = {
    "events": F.sum,
    "incidents": F.sum,
    "criticals": F.sum,
    "actionable": F.sum,
    "packets": F.sum,
    "first_ts": F.min,
    "last_ts": F.max,
    **{f"{short}_sum": F.sum for short in _AVERAGED},
    **{f"{short}_n": F.sum for short in _AVERAGED},
    **{f"{short}_max": F.max for short in ("cpu", "memory", "temp", "loss")},
}


def _one_if(condition: Column) -> Column:
    return condition.cast("long")


def contributions(silver: DataFrame) -> DataFrame:
    """Each event's share of every measure, next to the rollup keys. No shuffle."""
    severity = F.col("severity")
    shares = {
        "events": _one_if(F.col("event_id").isNotNull()),
        "incidents": _one_if(E.is_incident(severity)),
        "criticals": _one_if(severity == domain.CRITICAL),
        "actionable": _one_if(F.col("requires_action")),
        "packets": F.col("packet_count"),
        "first_ts": F.col("event_ts"),
        "last_ts": F.col("event_ts"),
    }
    for short, column in _AVERAGED.items():
        shares[f"{short}_sum"] = F.col(column)
        shares[f"{short}_n"] = _one_if(F.col(column).isNotNull())
        if f"{short}_max" in _MERGES:
            shares[f"{short}_max"] = F.col(column)
    return silver.select(*ROLLUP_KEYS, *[share.alias(name) for name, share in shares.items()])


def merge(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Contributions of all rows that share ``keys``."""
    return parts.groupBy(*keys).agg(*[combine(name).alias(name) for name, combine in _MERGES.items()])


def device_rollup(silver: DataFrame) -> DataFrame:
    """Contributions per device, hour and event class: the single pass over Silver."""
    return merge(contributions(silver), ROLLUP_KEYS)


def rollup_schema() -> T.StructType:
    """Columns of :func:`device_rollup` for readers of a stored one."""
    kinds = {f.name: f.dataType for f in SILVER.fields}
    out = T.StructType([T.StructField(name, kinds[name]) for name in ROLLUP_KEYS])
    for name in _MERGES:
        kind = "timestamp" if name in ("first_ts", "last_ts") else "long"
        if name.endswith(("_sum", "_max")):
            kind = "double"
        out = out.add(name, kind)
    return out


# --- distinct counts that merge --------------------------------------------------------------------

#: Keys of the sketched rollup: those of the device rollup without the device.
SKETCH_KEYS = tuple(key for key in ROLLUP_KEYS if key != "device_id")
#: Logarithm of a sketch's buckets; the standard error of a count is about 1.04 / sqrt(2 ** LG_K).
LG_K = 12


def sketch_rollup(parts: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """Contributions per hour and event class with a sketch of the devices in place of a row per device.

    Its size does not depend on the number of devices, and hours merge to days, months or any
    coarser keys by :func:`merge_sketches`, where distinct counts cannot be added.
    """
    measures = [combine(name).alias(name) for name, combine in _MERGES.items()]
    return parts.groupBy(*SKETCH_KEYS).agg(*measures, F.hll_sketch_agg("device_id", lg_k).alias("device_sketch"))


def merge_sketches(sketched: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Sketched contributions merged by coarser ``keys``, with ``devices`` estimated from the union."""
    measures = [combine(name).alias(name) for name, combine in _MERGES.items()]
    union = F.hll_union_agg("device_sketch")
    return sketched.groupBy(*keys).agg(*measures, F.hll_sketch_estimate(union).alias("devices"))


def reliability_by(sketched: DataFrame, period: str = "month") -> DataFrame:
    """Incident rate, availability and SLA verdict per place, device type and calendar period.

    ``period`` is any unit of ``date_trunc``. ``device_count`` is an estimate; see :data:`LG_K`.
    """
    start = F.to_date(F.date_trunc(period, "event_date")).alias("period_start")
    return _rated_reliability(merge_sketches(sketched, [start, *_PLACE]), ["period_start", *_PLACE])


def _with_devices(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    per_device = merge(parts, [*keys, "device_id"])
    measures = [combine(name).alias(name) for name, combine in _MERGES.items()]
    return per_device.groupBy(*keys).agg(*measures, F.count("device_id").alias("devices"))


def _mean(short: str) -> Column:
    return ratio(F.col(f"{short}_sum"), F.col(f"{short}_n"))


def _finish(df: DataFrame, contract: Contract) -> DataFrame:
    columns = [f.name for f in contract.fields if f.name not in ("_gold_ts", "_sf_load_ts")]
    return df.select(*columns, F.current_timestamp().alias("_gold_ts"))


def device_health_from(parts: DataFrame) -> DataFrame:
    readings = parts.filter(F.col("event_type") == domain.DEVICE_HEALTH)
    hourly = merge(readings, DEVICE_HEALTH_KPIS.keys).select(
        *DEVICE_HEALTH_KPIS.keys,
        _mean("cpu").alias("avg_cpu_pct"),
        F.col("cpu_max").alias("max_cpu_pct"),
        _mean("memory").alias("avg_memory_pct"),
        F.col("memory_max").alias("max_memory_pct"),
        _mean("temp").alias("avg_temp_celsius"),
        F.col("temp_max").alias("max_temp_celsius"),
        F.col("events").alias("sample_count"),
        F.col("incidents").alias("critical_count"),
    )
    score = kpi.health_score(F.col("avg_cpu_pct"), F.col("avg_memory_pct"), F.col("avg_temp_celsius"))
    scored = hourly.withColumn("health_score", score)
    return _finish(scored.withColumn("health_status", E.health_status(F.col("health_score"))), DEVICE_HEALTH_KPIS)


def alert_summary_from(parts: DataFrame) -> DataFrame:
    daily = _with_devices(parts.filter("requires_action"), ALERT_SUMMARY.keys).select(
        *ALERT_SUMMARY.keys,
        F.col("events").alias("alert_count"),
        F.col("devices").alias("affected_devices"),
        round_half_up(ratio(F.col("events"), F.col("devices")), 2).alias("alerts_per_device"),
        F.col("first_ts").alias("first_alert_ts"),
        F.col("last_ts").alias("last_alert_ts"),
    )
    return _finish(daily, ALERT_SUMMARY)


def network_reliability_from(parts: DataFrame) -> DataFrame:
    daily = _with_devices(parts, NETWORK_RELIABILITY.keys)
    return _finish(_rated_reliability(daily, NETWORK_RELIABILITY.keys), NETWORK_RELIABILITY)


def hourly_reliability_from(parts: DataFrame) -> DataFrame:
    """:func:`network_reliability` per hour, with exact device counts."""
    keys = ["event_date", "event_hour", *_PLACE]
    return _rated_reliability(_with_devices(parts, keys), keys)


_PLACE = ("location", "location_type", "device_type")


def _rated_reliability(merged: DataFrame, keys: Sequence[str]) -> DataFrame:
    counted = merged.select(
        *keys,
        F.col("events").alias("total_events"),
        F.col("incidents").alias("incident_count"),
        _mean("loss").alias("avg_packet_loss"),
        F.col("loss_max").alias("max_packet_loss"),
        _mean("bandwidth").alias("avg_bandwidth_util"),
        F.col("devices").alias("device_count"),
        F.col("actionable").alias("actionable_alerts"),
        kpi.incident_rate_pct(F.col("incidents"), F.col("events")).alias("incident_rate_pct"),
    )
    rated = counted.withColumn("availability_pct", kpi.availability_pct(F.col("incident_rate_pct")))
    return rated.withColumn("sla_met", kpi.sla_met(F.col("availability_pct")))


def security_threats_from(parts: DataFrame) -> DataFrame:
    flagged = parts.filter(F.col("event_type") == domain.SECURITY_ALERT)
    daily = _with_devices(flagged, SECURITY_THREATS.keys).select(
        *SECURITY_THREATS.keys,
        F.col("events").alias("alert_count"),
        F.col("packets").alias("total_packets_flagged"),
        F.col("devices").alias("affected_devices"),
        F.col("criticals").alias("critical_count"),
        E.threat_level(F.col("criticals"), F.col("events")).alias("threat_level"),
    )
    return _finish(daily, SECURITY_THREATS)


# Table name -> builder over contributions (of events, or of a rollup).
BUILDERS = {
    DEVICE_HEALTH_KPIS.name: device_health_from,
    ALERT_SUMMARY.name: alert_summary_from,
    NETWORK_RELIABILITY.name: network_reliability_from,
    SECURITY_THREATS.name: security_threats_from,
}


def device_health(silver: DataFrame) -> DataFrame:
    """Hourly health per device: mean and peak readings, incident count, score and status."""
    return device_health_from(contributions(silver))


def alert_summary(silver: DataFrame) -> DataFrame:
    """Daily actionable events by type, severity and place, with the devices they touch."""
    return alert_summary_from(contributions(silver))


def network_reliability(silver: DataFrame) -> DataFrame:
    """Daily incident rate, availability and SLA verdict per place and device type."""
    return network_reliability_from(contributions(silver))


def security_threats(silver: DataFrame) -> DataFrame:
    """Daily security alerts by kind, place and protocol, graded by threat level."""
    return security_threats_from(contributions(silver))
