"""Bronze to Silver: typed payload columns, derived columns, alert selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netpulse import domain
from netpulse.functions import events as E
from netpulse.functions.utc import utc_date, utc_hour, utc_weekday
from netpulse.schemas import ALERTS, PAYLOAD_COLUMNS, SILVER


def flatten_payload(df: DataFrame) -> DataFrame:
    """Replace the ``payload``, a map or a variant, by one typed, nullable column per known key."""
    kept = [name for name in df.columns if name != "payload"]
    if isinstance(df.schema["payload"].dataType, T.VariantType):
        text = lambda key: F.try_variant_get("payload", f"$.{key}", "string")
    else:
        text = lambda key: F.col("payload")[key]
    extracted = [E.as_type(text(key), kind).alias(column) for key, column, kind in PAYLOAD_COLUMNS]
    return df.select(*kept, *extracted)


def enrich(df: DataFrame) -> DataFrame:
    """Add scores, flags and calendar columns to flattened events."""
    col = F.col
    return df.withColumns(
        {
            "severity_score": E.severity_score(col("severity")),
            "requires_action": E.requires_action(col("severity"), col("event_type"), col("link_state")),
            "event_hour": utc_hour(col("event_ts")),
            "event_date": utc_date(col("event_ts")),
            "event_weekday": utc_weekday(col("event_ts")),
            "sla_breach_risk": E.sla_breach_risk(col("severity"), col("event_type")),
            "resource_anomaly": E.resource_anomaly(col("cpu_utilization_pct"), col("memory_utilization_pct")),
            "location_type": E.location_type(col("location")),
            "_silver_ts": F.current_timestamp(),
        }
    )


def classify_severity(flat: DataFrame, column: str = "expected_severity") -> DataFrame:
    """Add the severity the emitting rules assign to each flattened event."""
    metrics = {name: F.col(name) for limits in domain.METRIC_LIMITS.values() for name in limits}
    metrics.update(alert_type=F.col("alert_type"), link_state=F.col("link_state"))
    return flat.withColumn(column, E.classify_severity(F.col("event_type"), metrics))


def enriched(bronze: DataFrame) -> DataFrame:
    """Every Silver column plus the source columns that only Alerts keep."""
    return bronze.transform(flatten_payload).transform(enrich)


def to_silver(bronze: DataFrame) -> DataFrame:
    return enriched(bronze).select(*SILVER.names)


def select_alerts(df: DataFrame, tier: str = "actionable") -> DataFrame:
    """Rows that need attention: every actionable event, or the CRITICAL ones only."""
    if tier == "actionable":
        return df.filter("requires_action")
    if tier == "critical":
        return df.filter(F.col("severity") == domain.CRITICAL)
    raise ValueError(f"unknown alert tier: {tier}")


def to_alerts(bronze: DataFrame, tier: str = "actionable") -> DataFrame:
    return select_alerts(enriched(bronze), tier).select(*ALERTS.names)


def latest(df: DataFrame, by: str, columns: list[str], n: int) -> DataFrame:
    """The ``n`` rows with the greatest ``by``, ties resolved by event id. Plans as a bounded top-n."""
    return df.orderBy(F.desc(by), F.asc("event_id")).limit(n).select(*columns)


def critical_sample(silver: DataFrame, n: int = 5) -> DataFrame:
    columns = ["event_id", "event_type", "device_id", "location", "severity", "requires_action", "event_ts"]
    return latest(silver.filter(F.col("severity") == domain.CRITICAL), "event_ts", columns, n)


def deduplicate(df: DataFrame) -> DataFrame:
    """One row per event id: the one with the lowest record coordinates. Rows without id all stay.

    Copies are reduced on the map side before the shuffle, so an id repeated across a large share
    of the input costs each task one row.
    """
    identity = event_identity()
    order = F.struct("kafka_timestamp", "kafka_topic", "kafka_partition", "kafka_offset")
    row = F.struct(*df.columns)
    return df.groupBy(identity.alias("_identity")).agg(F.min_by(row, order).alias("row")).select("row.*")


def event_identity():
    """Event id, or the record coordinates for events that carry none."""
    coordinates = F.concat_ws("/", "kafka_topic", "kafka_partition", "kafka_offset")
    return F.coalesce(F.concat(F.lit("id:"), F.col("event_id")), F.concat(F.lit("at:"), coordinates))
