"""Parsing, typing and enrichment on hand-written records."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import T0, event, records_of
from pyspark.sql import functions as F

from netpulse.operators import bronze as B
from netpulse.operators import silver as S
from netpulse.schemas import ALERTS, BRONZE, SILVER, SILVER_DROPS


def rows(df, key="event_id"):
    return {r[key]: r for r in df.collect()}


def silver_of(spark, *values):
    return S.to_silver(B.to_bronze(records_of(spark, values)))


BROKEN = ["{bad", "null", "[1, 2]", None, "{}"]


def test_broken_values_give_all_null_rows_by_default(spark):
    parsed = B.to_bronze(records_of(spark, [*BROKEN, event("ok")]))
    assert parsed.count() == 6
    assert parsed.filter("event_id IS NULL AND event_type IS NULL AND severity IS NULL").count() == 5


def test_rejects_keep_the_raw_value_and_a_reason(spark):
    records = records_of(spark, [*BROKEN, event("ok")])
    found = {r.kafka_offset: (r.raw_value and bytes(r.raw_value).decode(), r.reason) for r in B.rejects(records).collect()}
    assert found == {
        0: ("{bad", "malformed"),
        1: ("null", "malformed"),
        2: ("[1, 2]", "malformed"),
        3: (None, "tombstone"),
        4: ("{}", "malformed"),
    }
    assert [r.event_id for r in B.to_bronze(records, drop_rejects=True).collect()] == ["ok"]


def test_an_array_of_events_is_not_expanded(spark):
    assert B.to_bronze(records_of(spark, ['[{"event_id": "a"}, {"event_id": "b"}]'])).count() == 1


def test_bronze_layout_and_metadata(spark):
    df = B.to_bronze(records_of(spark, [event()]))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in BRONZE]
    row = df.first()
    assert row.kafka_key == "key" and row._source == "kafka" and row.kafka_timestamp == T0
    assert row._ingest_ts is not None and row._batch_date is not None


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-03-05T10:15:00.123456+00:00", datetime(2024, 3, 5, 10, 15, 0, 123456)),
        ("2024-03-05T10:15:00+05:30", datetime(2024, 3, 5, 4, 45)),
        ("2024-03-05 10:15:00", datetime(2024, 3, 5, 10, 15)),
        ("yesterday", None),
        (None, None),
    ],
)
def test_event_time(spark, text, expected):
    row = silver_of(spark, event(timestamp=text)).first()
    assert row.event_ts == expected and row.timestamp == text


def test_payload_typing(spark):
    payload = {
        "cpu_utilization_pct": "85.10",
        "memory_utilization_pct": 70,
        "temperature_celsius": "hot",
        "uptime_seconds": "12.5",
        "bytes_in": 5.0,
        "bytes_out": "many",
        "packet_count": 7,
        "state": "down",
        "reason": "auto",
        "interface": "Gi0/1",
        "port": 22,
    }
    row = silver_of(spark, event(payload=payload)).first()
    assert row.cpu_utilization_pct == 85.1 and row.memory_utilization_pct == 70.0
    assert row.temperature_celsius is None
    assert row.uptime_seconds == 12 and row.bytes_in == 5  # the fraction is cut off
    assert row.bytes_out is None and row.packet_count == 7
    assert (row.link_state, row.link_down_reason, row.interface_name) == ("down", "auto", "Gi0/1")
    assert "port" not in row.asDict()


@pytest.mark.parametrize("payload", [5, "text", None, [1]])
def test_payload_that_is_no_object_gives_null_metrics(spark, payload):
    value = {**event(), "payload": payload}
    row = silver_of(spark, value).first()
    assert row.event_id == "e1" and row.cpu_utilization_pct is None and row.link_state is None


def test_silver_and_alert_layout(spark):
    bronze = B.to_bronze(records_of(spark, [event()]))
    assert S.to_silver(bronze).columns == SILVER.names
    assert S.to_alerts(bronze).columns == ALERTS.names
    assert set(ALERTS.names) - set(SILVER.names) == set(SILVER_DROPS)


def test_flags_follow_three_valued_logic(spark):
    df = silver_of(
        spark,
        event("critical", severity="CRITICAL"),
        event("error", severity="ERROR", event_type="interface_stats"),
        event("security", severity=None, event_type="security_alert"),
        event("down", event_type="link_state", payload={"state": "down"}),
        event("unknown-link", event_type="link_state"),
        event("no-severity", severity=None),
        event("info"),
    )
    got = {key: (r.severity_score, r.requires_action, r.sla_breach_risk) for key, r in rows(df).items()}
    assert got == {
        "critical": (4, True, True),
        "error": (3, True, False),
        "security": (1, True, False),
        "down": (1, True, False),
        "unknown-link": (1, None, False),
        "no-severity": (1, None, None),
        "info": (1, False, False),
    }


@pytest.mark.parametrize(
    "cpu, memory, expected",
    [(90, 90, True), (85, 90, False), (90, None, None), (80, None, False), (None, None, None)],
)
def test_resource_anomaly(spark, cpu, memory, expected):
    payload = {"cpu_utilization_pct": cpu, "memory_utilization_pct": memory}
    payload = {key: value for key, value in payload.items() if value is not None}
    assert silver_of(spark, event(payload=payload)).first().resource_anomaly is expected


def test_location_type_and_calendar(spark):
    df = silver_of(spark, event("a"), event("b", location="Branch-NY"), event("c", location=None))
    got = rows(df)
    assert [got[k].location_type for k in "abc"] == ["Data Center", "Branch", "Branch"]
    assert (got["a"].event_hour, str(got["a"].event_date), got["a"].event_weekday) == (10, "2024-03-05", 3)


def test_alert_tiers(spark):
    bronze = B.to_bronze(
        records_of(
            spark,
            [
                event("c", severity="CRITICAL"),
                event("e", severity="ERROR"),
                event("s", severity="WARNING", event_type="security_alert"),
                event("n", severity=None),
                event("i"),
            ],
        )
    )
    assert set(rows(S.to_alerts(bronze))) == {"c", "e", "s"}
    assert set(rows(S.to_alerts(bronze, "critical"))) == {"c"}
    with pytest.raises(ValueError):
        S.to_alerts(bronze, "loud")


def expected_severity(kind, p):
    if kind == "device_health":
        cpu, mem, temp = p["cpu_utilization_pct"], p["memory_utilization_pct"], p["temperature_celsius"]
        if cpu > 90 or mem > 90 or temp > 80:
            return "CRITICAL"
        return "WARNING" if cpu > 75 or mem > 75 or temp > 70 else "INFO"
    loss, load = p["packet_loss_pct"], p["bandwidth_utilization"]
    if loss > 10 or load > 95:
        return "CRITICAL"
    return "WARNING" if loss > 5 or load > 80 else "INFO"


def test_severity_rules_at_their_limits(spark):
    values, want = [], {}
    for cpu in (75, 75.01, 90, 90.01):
        for mem in (75, 90.5):
            for temp in (70, 70.1, 80, 80.1):
                p = {"cpu_utilization_pct": cpu, "memory_utilization_pct": mem, "temperature_celsius": temp}
                key = f"h{len(values)}"
                values.append(event(key, payload=p))
                want[key] = expected_severity("device_health", p)
    for loss in (5, 5.001, 10, 10.001):
        for load in (80, 80.01, 95, 95.01):
            p = {"packet_loss_pct": loss, "bandwidth_utilization": load}
            key = f"i{len(values)}"
            values.append(event(key, "interface_stats", payload=p))
            want[key] = expected_severity("interface_stats", p)
    alert_types = {
        "ddos_signature_matched": "CRITICAL",
        "unauthorized_access_attempt": "CRITICAL",
        "port_scan_detected": "ERROR",
        "auth_failure_spike": "WARNING",
        "suspicious_traffic_pattern": "WARNING",
    }
    for kind, severity in alert_types.items():
        values.append(event(kind, "security_alert", payload={"alert_type": kind}))
        want[kind] = severity
    for state, severity in {"down": "CRITICAL", "flapping": "WARNING", "up": "INFO"}.items():
        values.append(event(state, "link_state", payload={"state": state}))
        want[state] = severity
    flat = S.flatten_payload(B.to_bronze(records_of(spark, values)))
    got = {r.event_id: r.expected_severity for r in S.classify_severity(flat).collect()}
    assert got == want


def test_deduplicate_keeps_the_earliest_copy_and_every_row_without_id(spark):
    values = [event("a", severity="INFO"), event("a", severity="ERROR"), event("b"), event(None), event(None)]
    kept = S.deduplicate(B.to_bronze(records_of(spark, values)))
    got = sorted((r.event_id or "-", r.kafka_offset) for r in kept.collect())
    assert got == [("-", 3), ("-", 4), ("a", 0), ("b", 2)]


def test_latest_breaks_ties_by_event_id(spark):
    df = silver_of(spark, *[event(f"e{n}", severity="CRITICAL") for n in (3, 1, 2)])
    assert [r.event_id for r in S.critical_sample(df, 2).collect()] == ["e1", "e2"]


def test_encoding_round_trip_keeps_every_field(spark):
    from netpulse.sources.records import encode_events

    values = [event("a", payload={"cpu_utilization_pct": "1.5", "note": None}), event("b", location=None)]
    once = B.parse_records(records_of(spark, values))
    again = B.parse_records(
        encode_events(
            once, partition=F.col("kafka_partition"), offset=F.col("kafka_offset"), timestamp=F.col("kafka_timestamp")
        )
    )
    fields = ["event_id", "location", "severity", "timestamp", "kafka_offset"]
    assert sorted(map(str, once.select(fields).collect())) == sorted(map(str, again.select(fields).collect()))
    assert rows(again)["a"].kafka_key == "SW-001" and rows(again)["a"].payload["cpu_utilization_pct"] == "1.5"


def test_variant_payload_keeps_nested_values_and_unknown_keys(spark, cfg):
    from netpulse.plans.writing import replace_table
    from netpulse.schemas import bronze_schema
    from netpulse.sources.tables import read_table

    nested = {"cpu_utilization_pct": 91.5, "uptime_seconds": "12.7", "probe": {"hops": [3, {"ms": 7.25}]}, "note": None}
    values = [event("a", payload=nested), event("b", payload={}), event(None, payload={"cpu_utilization_pct": 5}), "{broken", "17", None]
    records = records_of(spark, values)
    rows_of = B.to_bronze(records, payload="variant")
    replace_table(rows_of, cfg, cfg.bronze, ())
    stored = read_table(spark, cfg, cfg.bronze, bronze_schema("variant"))
    got = stored.filter("event_id = 'a'").select(
        F.variant_get("payload", "$.probe.hops[1].ms", "double").alias("ms"), F.variant_get("payload", "$.probe.hops[0]", "int").alias("hops")
    ).first()
    assert (got.ms, got.hops) == (7.25, 3)
    same = ["kafka_offset", "event_id", "location", "event_ts", "cpu_utilization_pct", "uptime_seconds", "severity_score"]
    a, b = S.to_silver(stored), S.to_silver(B.to_bronze(records))
    as_rows = lambda df: sorted(map(str, df.select(*same[1:]).collect()))
    assert as_rows(a) == as_rows(b) and a.filter("event_id = 'a'").first().uptime_seconds == 12
    assert {r.reason for r in B.rejects(records).collect()} == {"malformed", "tombstone"}
    assert B.to_bronze(records, drop_rejects=True, payload="variant").count() == B.to_bronze(records, drop_rejects=True).count()


def test_variant_layers_stream_like_map_layers(spark, cfg, tmp_path):
    from conftest import SF_DIR, land
    from netpulse.plans import build
    from netpulse.streaming import layers
    from verification import registry

    folder = land(registry.records(spark, SF_DIR), str(tmp_path / "landing"), files=2)
    live = cfg.but(record_source="files", records_path=folder, payload="variant")
    layers.drain(layers.start_bronze(spark, live))
    layers.drain(layers.start_silver(spark, live))
    stable = [name for name in build.read_silver(spark, live).columns if name not in ("_ingest_ts", "_silver_ts")]
    streamed, batch = build.read_silver(spark, live).select(stable), registry.silver(spark, SF_DIR).select(stable)
    assert streamed.exceptAll(batch).isEmpty() and batch.count() == streamed.count()
