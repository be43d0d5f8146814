"""Gold tables, views and queries: edge cases, invariants, skew."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from conftest import SF_DIR, event, records_of
from pyspark.sql import functions as F

from netpulse.functions import kpi
from netpulse.functions.numeric import round_half_up
from netpulse.operators import bronze as B
from netpulse.operators import gold
from netpulse.operators import silver as S
from netpulse.operators import views as V
from verification import registry


def silver_of(spark, *values):
    return S.to_silver(B.to_bronze(records_of(spark, values)))


def health(cpu=None, mem=None, temp=None):
    values = {"cpu_utilization_pct": cpu, "memory_utilization_pct": mem, "temperature_celsius": temp}
    return {key: value for key, value in values.items() if value is not None}


@pytest.mark.parametrize(
    "payload, score, status",
    [
        (health(10, 10, 30), 93.0, "Healthy"),
        (health(50, 0, 30), 80.0, "Healthy"),
        (health(50.5, 0, 30), 79.8, "Degraded"),
        (health(100, 0, 30), 60.0, "Degraded"),
        (health(100, 100, 85), 0.0, "Critical"),
        (health(0, 0, 20), 106.0, "Healthy"),
        ({}, 0.0, "Critical"),
        (health(10, 10), 0.0, "Critical"),
    ],
)
def test_health_score(spark, payload, score, status):
    row = gold.device_health(silver_of(spark, event(payload=payload))).first()
    assert (row.health_score, row.health_status) == (score, status)


def test_counts_skip_null_ids_and_keep_nulls(spark):
    df = silver_of(
        spark,
        event("a", "interface_stats", severity=None),
        event(None, "interface_stats", severity=None),
        event("b", "interface_stats", severity=None, device_id=None),
    )
    row = gold.network_reliability(df).first()
    assert (row.total_events, row.device_count) == (2, 1)
    assert row.incident_count is None and row.actionable_alerts is None and row.sla_met is None


def test_group_without_any_id_has_no_rate(spark):
    row = gold.network_reliability(silver_of(spark, event(None, severity="CRITICAL"))).first()
    assert row.total_events == 0 and row.incident_rate_pct is None and row.sla_met is None


def test_threat_levels(spark):
    def alerts(n, severity, site):
        payload = {"alert_type": "x", "protocol": "TCP", "packet_count": 10}
        return [event(f"{site}{i}", "security_alert", severity, payload, location=site) for i in range(n)]

    df = silver_of(
        spark,
        *alerts(6, "CRITICAL", "A"),
        *alerts(5, "CRITICAL", "B"),
        *alerts(11, "WARNING", "C"),
        *alerts(10, "WARNING", "D"),
    )
    got = {r.location: (r.threat_level, r.alert_count, r.total_packets_flagged) for r in gold.security_threats(df).collect()}
    assert got == {"A": ("High", 6, 60), "B": ("Low", 5, 50), "C": ("Medium", 11, 110), "D": ("Low", 10, 100)}


@pytest.mark.parametrize("name", list(gold.BUILDERS))
def test_table_from_rollup_equals_table_from_silver(spark, name):
    silver = registry.silver(spark, SF_DIR)
    build = gold.BUILDERS[name]
    averaged = [c for c in build(gold.contributions(silver)).columns if c.startswith("avg_")]
    direct = registry.rounded(build(gold.contributions(silver)), *averaged).drop("_gold_ts")
    rolled = registry.rounded(build(gold.device_rollup(silver)), *averaged).drop("_gold_ts")
    assert direct.exceptAll(rolled).isEmpty() and rolled.exceptAll(direct).isEmpty()


def test_merging_twice_equals_merging_once(spark):
    parts = gold.contributions(registry.silver(spark, SF_DIR))
    keys = ["location", "event_date"]
    once = gold.merge(parts, keys)
    twice = gold.merge(gold.merge(parts, [*keys, "device_id", "event_type"]), keys)
    columns = ["location", "event_date", "events", "incidents", "packets", "first_ts", "last_ts", "loss_max", "loss_n"]
    assert once.select(columns).exceptAll(twice.select(columns)).isEmpty()


def test_invariants(spark):
    silver = registry.silver(spark, SF_DIR)
    rows = gold.network_reliability(silver).collect()
    assert sum(r.total_events for r in rows) == silver.filter("event_id IS NOT NULL").count()
    for r in rows:
        assert r.availability_pct == pytest.approx(100 - r.incident_rate_pct, abs=1e-9)
        assert r.sla_met == (r.availability_pct >= 99.9)


def test_skewed_input_against_brute_force(spark):
    """A third of all rows on one device, a third on one location, and shared devices."""
    rng = random.Random(7)
    values = []
    for n in range(900):
        hot = n % 3
        device = "SW-001" if hot == 0 else f"SW-{rng.randint(2, 40):03d}"
        site = "DC-East" if hot < 2 else rng.choice(["DC-West", "Branch-NY", "Branch-LA"])
        stamp = (datetime(2024, 3, 1) + timedelta(hours=rng.randint(0, 71))).isoformat()
        severity = rng.choice(["INFO", "WARNING", "ERROR", "CRITICAL"])
        loss = round(rng.uniform(0, 15), 3)
        values.append(
            event(f"e{n}", "interface_stats", severity, {"packet_loss_pct": loss}, device_id=device, location=site, timestamp=stamp)
        )
    groups = defaultdict(list)
    for v in values:
        groups[(v["location"], v["timestamp"][:10])].append(v)
    got = {(r.location, str(r.event_date)): r for r in gold.network_reliability(silver_of(spark, *values)).collect()}
    assert set(got) == set(groups)
    for key, members in groups.items():
        incidents = sum(m["severity"] in ("CRITICAL", "ERROR") for m in members)
        losses = [m["payload"]["packet_loss_pct"] for m in members]
        row = got[key]
        assert row.total_events == len(members) and row.incident_count == incidents
        assert row.device_count == len({m["device_id"] for m in members})
        assert row.avg_packet_loss == pytest.approx(sum(losses) / len(losses)) and row.max_packet_loss == max(losses)
        assert row.incident_rate_pct == pytest.approx(100 * incidents / len(members), abs=0.0051)


# --- views ---------------------------------------------------------------------------------------


def summary_of(spark, *rows):
    return spark.createDataFrame(list(rows), "event_date date, severity string, alert_count long, affected_devices long")


def test_trend_compares_with_the_previous_row_and_survives_zero(spark):
    df = summary_of(
        spark,
        (date(2024, 1, 1), "ERROR", 0, 0),
        (date(2024, 1, 2), "ERROR", 4, 1),
        (date(2024, 1, 5), "ERROR", 5, 2),
        (date(2024, 1, 5), "ERROR", 1, 1),
        (date(2024, 1, 1), "INFO", 3, 1),
    )
    got = [(str(r.event_date), r.severity, r.total_alerts, r.prev_day, r.day_over_day_pct) for r in V.alert_trend(df).collect()]
    assert got == [
        ("2024-01-05", "ERROR", 6, 4, 50.0),
        ("2024-01-02", "ERROR", 4, 0, None),
        ("2024-01-01", "ERROR", 0, None, None),
        ("2024-01-01", "INFO", 3, None, None),
    ]


def test_typical_status_takes_the_lowest_label_on_a_tie(spark):
    columns = (
        "device_id string, device_type string, location string, location_type string, event_date date, "
        "avg_cpu_pct double, max_cpu_pct double, avg_memory_pct double, health_score double, critical_count long, "
        "health_status string"
    )
    base = ("d", "Switch", "DC", "Data Center", date(2024, 1, 1), 1.0, 2.0, 3.0, 4.0, 1)
    df = spark.createDataFrame([(*base, "Healthy"), (*base, "Degraded")], columns)
    assert V.device_health_summary(df).first().typical_health_status == "Degraded"


def reliability_of(spark, *rows):
    columns = (
        "event_date date, location string, location_type string, device_type string, total_events long, "
        "incident_count long, device_count long, availability_pct double, sla_met boolean, actionable_alerts long"
    )
    return spark.createDataFrame(list(rows), columns)


def test_compliance_by_row_can_pass_100_but_by_location_cannot(spark):
    day = date(2024, 1, 7)
    df = reliability_of(
        spark,
        (day, "DC", "Data Center", "Switch", 1, 0, 1, 100.0, True, 0),
        (day, "DC", "Data Center", "Router", 1, 0, 1, 100.0, True, 0),
        (day, "NY", "Branch", "Switch", 1, 1, 1, 0.0, False, 1),
        (day, "LA", "Branch", "Switch", 0, 0, 0, None, None, None),
    )
    row = V.executive(df).first()
    assert (row.locations_meeting_sla, row.total_locations, row.sla_compliance_pct) == (2, 3, 66.7)
    fair = V.sla_by_location(df).first()
    assert (fair.locations_meeting_sla, fair.total_locations, fair.location_compliance_pct) == (1, 3, 33.3)
    breaches = V.sla_breaches(df).collect()
    assert [(r.location, r.sla_gap_pct) for r in breaches] == [("NY", 99.9)]


def test_registered_views_answer_sql(spark):
    silver = registry.silver(spark, SF_DIR)
    tables = {name: build(gold.contributions(silver)) for name, build in gold.BUILDERS.items()}
    names = V.register_views(spark, tables, as_of=datetime(2024, 1, 30))
    assert len(names) == 9
    top = spark.sql("SELECT * FROM VW_NOC_EXECUTIVE ORDER BY event_date DESC LIMIT 7").collect()
    assert [tuple(r) for r in top] == [tuple(r) for r in V.current_sla_compliance(tables["network_reliability"]).collect()]
    typical = spark.sql("SELECT mode(health_status) AS m FROM DEVICE_HEALTH_KPIS").first().m
    assert typical in ("Healthy", "Degraded", "Critical")
    recent = spark.sql("SELECT count(*) AS n FROM vw_critical_alerts_24h WHERE event_date < DATE'2024-01-29'").first().n
    assert recent == 0


def test_rounding_is_half_away_from_zero_and_total(spark):
    df = spark.createDataFrame([(1.005,), (-1.005,), (0.285,), (1e300,), (float("nan"),), (None,)], "x double")
    got = [r[0] for r in df.select(round_half_up(F.col("x"), 2)).collect()]
    assert got[:4] == [1.01, -1.01, 0.29, 1e300] and got[4] != got[4] and got[5] is None


def test_change_pct_needs_a_previous_value(spark):
    df = spark.createDataFrame([(3, 2), (3, 0), (3, None)], "a long, b long")
    assert [r[0] for r in df.select(kpi.change_pct(F.col("a"), F.col("b"))).collect()] == [50.0, None, None]
