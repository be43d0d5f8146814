"""Data-quality counts, activity gates, audit and alert digest. Each is one pass over its input."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from netpulse import domain
from netpulse.functions.utc import utc_date


class DataQualityError(ValueError):
    """Raised when an enforced check counts failing rows."""

    def __init__(self, failed: dict[str, int]):
        super().__init__(f"data quality checks failed: {failed}")
        self.failed = failed


# Checks that must count zero; ``null_severity`` is reported only.
ENFORCED = ("null_event_ids", "future_events", "invalid_severity")


def _moment(as_of: Column | datetime | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def failing(as_of: Column | datetime | None = None) -> dict[str, Column]:
    """The number of rows that fail each check, as aggregates."""
    severity = F.col("severity")
    conditions = {
        "null_event_ids": F.col("event_id").isNull(),
        "future_events": F.col("event_ts") > _moment(as_of),
        "invalid_severity": ~severity.isin(*domain.SEVERITIES),
        "null_severity": severity.isNull(),
    }
    return {name: F.count_if(condition) for name, condition in conditions.items()}


def dq_checks(silver: DataFrame, as_of: Column | datetime | None = None) -> DataFrame:
    """Failing rows per check, as ``(check, failed_rows)``."""
    counts = failing(as_of)
    totals = silver.agg(*[count.alias(name) for name, count in counts.items()])
    return totals.unpivot([], list(counts), "check", "failed_rows")


def watched(silver: DataFrame, as_of: Column | datetime | None = None) -> tuple[DataFrame, Observation]:
    """``silver`` with its checks counted while it is written, instead of by a scan of their own.

    Write the result, then take the counts with :func:`watched_checks`. Watch rows after their last
    shuffle: a map task that runs again, for a lost executor, counts again.
    """
    seen = Observation()
    return silver.observe(seen, *[count.alias(name) for name, count in failing(as_of).items()]), seen


def watched_checks(spark: SparkSession, seen: Observation) -> DataFrame:
    """:func:`dq_checks` of a watched write; waits until the write has run."""
    return spark.createDataFrame(list(seen.get.items()), "check string, failed_rows bigint")


def enforce(checks: DataFrame, names: tuple[str, ...] = ENFORCED) -> dict[str, int]:
    """All counts; raises :class:`DataQualityError` if an enforced one is positive."""
    return enforced({row["check"]: row["failed_rows"] for row in checks.collect()}, names)


def enforced(counts: dict[str, int], names: tuple[str, ...] = ENFORCED) -> dict[str, int]:
    """``counts`` if no enforced one is positive; else raises :class:`DataQualityError`."""
    failed = {name: counts[name] for name in names if counts[name] > 0}
    if failed:
        raise DataQualityError(failed)
    return counts


def _start(as_of: Column | datetime | None, hours: float) -> Column:
    return _moment(as_of) - F.expr(f"INTERVAL '{int(timedelta(hours=hours).total_seconds())}' SECOND")


def within(column: str, as_of: Column | datetime | None, hours: float = 1) -> Column:
    """``column`` lies in the ``hours`` up to and including ``as_of``."""
    return (F.col(column) > _start(as_of, hours)) & (F.col(column) <= _moment(as_of))


def dated_within(as_of: Column | datetime | None, hours: float = 1) -> Column:
    """Silver's partitions that can hold events of the ``hours`` up to ``as_of``."""
    return F.col("event_date").between(utc_date(_start(as_of, hours)), utc_date(_moment(as_of)))


def ingested_since(as_of: Column | datetime | None, hours: float = 1, slack_days: int = 1) -> Column:
    """Bronze's partitions that can hold records which the topic received in the ``hours`` up to ``as_of``.

    A record is ingested after the topic received it; ``slack_days`` allows for clocks that disagree.
    """
    return F.col("_batch_date") >= F.date_sub(utc_date(_start(as_of, hours)), slack_days)


def recent_records(bronze: DataFrame, as_of: Column | datetime | None = None, hours: float = 1) -> DataFrame:
    """Number of records the topic received lately: ``(recent_events)``."""
    return bronze.filter(within("kafka_timestamp", as_of, hours)).agg(F.count("*").alias("recent_events"))


def has_recent_records(bronze: DataFrame, as_of: Column | datetime | None = None, hours: float = 1) -> bool:
    """Whether there is any recent record; stops at the first one found."""
    return not bronze.filter(within("kafka_timestamp", as_of, hours)).isEmpty()


def recent_critical(alerts: DataFrame, as_of: Column | datetime | None = None, hours: float = 1) -> DataFrame:
    """Number of CRITICAL alerts lately: ``(critical_alerts)``."""
    recent = alerts.filter((F.col("severity") == domain.CRITICAL) & within("event_ts", as_of, hours))
    return recent.agg(F.count("*").alias("critical_alerts"))


def alert_digest(alerts: DataFrame, as_of: Column | datetime | None = None, hours: float = 1) -> DataFrame:
    """What a notification reports: recent alerts per day and severity."""
    return (
        alerts.filter(within("event_ts", as_of, hours))
        .groupBy("event_date", "severity")
        .agg(
            F.count("*").alias("alerts"),
            F.min("event_ts").alias("first_event_ts"),
            F.max("event_ts").alias("last_event_ts"),
        )
    )


def audit(tables: dict[str, DataFrame | None], spark: SparkSession) -> DataFrame:
    """Row count per table, 0 where a table does not exist: ``(table_name, row_count)``."""
    present = {name: df for name, df in tables.items() if df is not None}
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in present.items()
    ]
    missing = [(name, 0) for name in tables if name not in present]
    if missing:
        counted.append(spark.createDataFrame(missing, "table_name string, row_count bigint"))
    result = counted[0]
    for part in counted[1:]:
        result = result.unionByName(part)
    return result
