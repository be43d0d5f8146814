"""Column expressions over one telemetry event.

All of them are built-ins with SQL's three-valued logic left intact: a flag is null when the
columns it depends on leave it undecided.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from netpulse import domain
from netpulse.functions.utc import utc_time

# A number written with a fraction, e.g. "12.5"; group 1 is the whole part.
_WHOLE_PART = r"^\s*([+-]?\d+)\.\d*\s*$"


def as_type(text: Column, kind: str) -> Column:
    """Text to ``kind``; unreadable text becomes null. Fractions are cut off for ``long``."""
    if kind == "string":
        return text
    if kind == "long":
        return F.coalesce(text.try_cast("long"), F.regexp_extract(text, _WHOLE_PART, 1).try_cast("long"))
    return text.try_cast(kind)


def event_time(text: Column) -> Column:
    """ISO-8601 text (with or without offset or fraction) to a timestamp; null if unreadable."""
    return utc_time(text)


def _choose(branches: list[tuple[Column, object]], otherwise: object) -> Column:
    head, *tail = [(cond, F.lit(value)) for cond, value in branches]
    chain = F.when(*head)
    for cond, value in tail:
        chain = chain.when(cond, value)
    return chain.otherwise(F.lit(otherwise))


def severity_score(severity: Column) -> Column:
    scores = [(severity == name, score) for name, score in domain.SEVERITY_SCORES.items()]
    return _choose(scores, domain.DEFAULT_SEVERITY_SCORE)


def is_incident(severity: Column) -> Column:
    return severity.isin(*domain.INCIDENT_SEVERITIES)


def requires_action(severity: Column, event_type: Column, link_state: Column) -> Column:
    link_lost = (event_type == domain.LINK_STATE) & (link_state == domain.LINK_DOWN)
    return is_incident(severity) | (event_type == domain.SECURITY_ALERT) | link_lost


def sla_breach_risk(severity: Column, event_type: Column) -> Column:
    return (severity == domain.CRITICAL) & event_type.isin(domain.DEVICE_HEALTH, domain.LINK_STATE)


def resource_anomaly(cpu: Column, memory: Column) -> Column:
    return (cpu > domain.ANOMALY_PCT) & (memory > domain.ANOMALY_PCT)


def location_type(location: Column) -> Column:
    return _choose([(location.startswith(domain.DATA_CENTER_PREFIX), domain.DATA_CENTER)], domain.BRANCH)


def classify_severity(event_type: Column, metrics: Mapping[str, Column]) -> Column:
    """Severity an emitting device assigns, from its readings.

    ``metrics`` maps Silver column names (cpu_utilization_pct, …, alert_type, link_state) to columns.
    """

    def beyond(kind: str, level: int) -> Column:
        limits = domain.METRIC_LIMITS[kind]
        over = reduce(or_, [metrics[name] > bounds[level] for name, bounds in limits.items()])
        return (event_type == kind) & over

    alert, link = metrics["alert_type"], metrics["link_state"]
    is_alert, is_link = event_type == domain.SECURITY_ALERT, event_type == domain.LINK_STATE
    metered = (domain.DEVICE_HEALTH, domain.INTERFACE_STATS)
    return _choose(
        [
            *[(beyond(kind, 1), domain.CRITICAL) for kind in metered],
            *[(beyond(kind, 0), domain.WARNING) for kind in metered],
            (is_alert & alert.isin(*domain.CRITICAL_ALERT_TYPES), domain.CRITICAL),
            (is_alert & alert.isin(*domain.ERROR_ALERT_TYPES), domain.ERROR),
            (is_alert, domain.WARNING),
            (is_link & (link == domain.LINK_DOWN), domain.CRITICAL),
            (is_link & (link == domain.LINK_FLAPPING), domain.WARNING),
        ],
        domain.INFO,
    )


def health_status(score: Column) -> Column:
    return _choose([(score >= floor, label) for floor, label in domain.HEALTH_BANDS], domain.HEALTH_FLOOR_LABEL)


def threat_level(critical: Column, alerts: Column) -> Column:
    return _choose(
        [(critical > domain.HIGH_THREAT_CRITICALS, "High"), (alerts > domain.MEDIUM_THREAT_ALERTS, "Medium")],
        "Low",
    )
