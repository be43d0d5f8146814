"""Serving views and analytics queries over the Gold / serving tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netpulse.functions import kpi
from netpulse.functions.events import is_incident
from netpulse.functions.numeric import percent, round_half_up
from netpulse.functions.utc import utc_date


def _as_date(as_of: Column | date | datetime | None) -> Column:
    if as_of is None:
        return utc_date(F.current_timestamp())
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return utc_date(F.lit(as_of)) if isinstance(as_of, datetime) else F.lit(as_of)


def _mean(name: str, digits: int) -> Column:
    return round_half_up(F.avg(name), digits)


# --- views ---------------------------------------------------------------------------------------


def executive(reliability: DataFrame) -> DataFrame:
    """One row per day. ``sla_compliance_pct`` relates compliant rows (location and device type) to
    distinct locations, so it can pass 100; :func:`sla_by_location` gives the location-level share."""
    met = F.count_if("sla_met")
    places = F.count_distinct("location")
    return (
        reliability.groupBy("event_date")
        .agg(
            F.sum("total_events").alias("total_events"),
            F.sum("incident_count").alias("total_incidents"),
            _mean("availability_pct", 2).alias("avg_availability_pct"),
            met.alias("locations_meeting_sla"),
            places.alias("total_locations"),
        )
        .withColumn(
            "sla_compliance_pct", percent(F.col("locations_meeting_sla"), F.col("total_locations"), 1)
        )
        .orderBy(F.desc("event_date"))
    )


def device_health_summary(health: DataFrame) -> DataFrame:
    """One row per device over all hours; the lowest label wins a tie for the typical status."""
    return health.groupBy("device_id", "device_type", "location", "location_type").agg(
        F.max("event_date").alias("latest_date"),
        _mean("avg_cpu_pct", 1).alias("avg_cpu"),
        round_half_up(F.max("max_cpu_pct"), 1).alias("peak_cpu"),
        _mean("avg_memory_pct", 1).alias("avg_memory"),
        _mean("health_score", 1).alias("avg_health_score"),
        F.sum("critical_count").alias("total_critical_events"),
        F.mode("health_status", True).alias("typical_health_status"),
    )


def critical_alerts_24h(summary: DataFrame, as_of: Column | date | datetime | None = None) -> DataFrame:
    """Incident-level alert groups of the day of ``as_of`` and the day before it."""
    recent = F.col("event_date") >= F.date_sub(_as_date(as_of), 1)
    return (
        summary.filter(is_incident(F.col("severity")) & recent)
        .select(
            "event_date",
            "event_type",
            "severity",
            "location",
            "device_type",
            "alert_count",
            "affected_devices",
            "first_alert_ts",
            "last_alert_ts",
        )
        .orderBy(F.desc("alert_count"))
    )


def sla_breaches(reliability: DataFrame) -> DataFrame:
    """Rows that miss the SLA, worst first, with the distance to the target."""
    return (
        reliability.filter(~F.col("sla_met"))
        .select(
            "location",
            "location_type",
            "event_date",
            "device_count",
            "incident_count",
            round_half_up(F.col("availability_pct"), 3).alias("availability_pct"),
            kpi.sla_gap_pct(F.col("availability_pct")).alias("sla_gap_pct"),
            "actionable_alerts",
        )
        .orderBy("availability_pct")
    )


def threat_breakdown(threats: DataFrame) -> DataFrame:
    """Alert, packet, device and critical totals by kind of alert and threat level."""
    totals = {
        "total_alerts": "alert_count",
        "packets_flagged": "total_packets_flagged",
        "devices_affected": "affected_devices",
        "critical_alerts": "critical_count",
    }
    return (
        threats.groupBy("alert_type", "threat_level")
        .agg(*[F.sum(source).alias(name) for name, source in totals.items()])
        .orderBy(F.desc("total_alerts"), "alert_type", "threat_level")
    )


def sla_by_location(reliability: DataFrame) -> DataFrame:
    """Daily share of locations all of whose rows meet the SLA; never above 100."""
    per_location = reliability.groupBy("event_date", "location").agg(
        F.coalesce(F.bool_and("sla_met"), F.lit(False)).alias("met")
    )
    return (
        per_location.groupBy("event_date")
        .agg(F.count_if("met").alias("locations_meeting_sla"), F.count("location").alias("total_locations"))
        .withColumn(
            "location_compliance_pct", percent(F.col("locations_meeting_sla"), F.col("total_locations"), 1)
        )
        .orderBy(F.desc("event_date"))
    )


# --- queries -------------------------------------------------------------------------------------


def current_sla_compliance(reliability: DataFrame, days: int = 7) -> DataFrame:
    return executive(reliability).orderBy(F.desc("event_date")).limit(days)


def problem_devices(health: DataFrame, n: int = 5) -> DataFrame:
    ranked = device_health_summary(health).orderBy(
        F.desc("total_critical_events"), "device_id", "device_type", "location", "location_type"
    )
    return ranked.limit(n).select(
        "device_id", "location", "total_critical_events", "avg_health_score", "typical_health_status"
    )


def alert_trend(summary: DataFrame) -> DataFrame:
    """Daily totals per severity with the preceding row's total and the relative change.

    The window runs over one row per day and severity, after aggregation.
    """
    daily = summary.groupBy("event_date", "severity").agg(
        F.sum("alert_count").alias("total_alerts"), F.sum("affected_devices").alias("devices_impacted")
    )
    history = Window.partitionBy("severity").orderBy("event_date")
    return (
        daily.withColumn("prev_day", F.lag("total_alerts").over(history))
        .withColumn("day_over_day_pct", kpi.change_pct(F.col("total_alerts"), F.col("prev_day")))
        .orderBy(F.desc("event_date"), "severity")
    )


def bandwidth_by_location(reliability: DataFrame) -> DataFrame:
    return (
        reliability.groupBy("location", "location_type")
        .agg(
            _mean("avg_bandwidth_util", 1).alias("avg_bandwidth_pct"),
            _mean("avg_packet_loss", 3).alias("avg_packet_loss_pct"),
            F.count_distinct("event_date").alias("days_monitored"),
        )
        .orderBy(F.desc("avg_bandwidth_pct"), "location", "location_type")
    )


def incident_hotspots(reliability: DataFrame, n: int = 5) -> DataFrame:
    """The rows of network_reliability with most incidents."""
    ranked = reliability.orderBy(
        F.desc("incident_count"), F.desc("event_date"), "location", "location_type", "device_type"
    )
    return ranked.limit(n).select(
        "location", "location_type", "device_count", "incident_count", "availability_pct", "sla_met"
    )


def register_views(spark: SparkSession, tables: dict[str, DataFrame], as_of: datetime | None = None) -> list[str]:
    """Temp views for the four tables (under their own names) and the views above, for ``spark.sql``."""
    reliability, health = tables["network_reliability"], tables["device_health_kpis"]
    views = {
        **tables,
        "vw_noc_executive": executive(reliability),
        "vw_device_health_summary": device_health_summary(health),
        "vw_critical_alerts_24h": critical_alerts_24h(tables["alert_summary"], as_of),
        "vw_sla_breaches": sla_breaches(reliability),
        "vw_threat_breakdown": threat_breakdown(tables["security_threats"]),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)

