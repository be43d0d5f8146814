"""Gold builds, serving loads, quality gates and the hourly run."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR, T0, event, records_of
from pyspark.sql import functions as F

from netpulse.operators import bronze as B
from netpulse.operators import gold, loading, quality
from netpulse.operators import silver as S
from netpulse.plans import build, hourly
from netpulse.plans.writing import clustered, on_dates, replace_table
from netpulse.schemas import ALERTS, BRONZE, CONTRACTS, DEVICE_HEALTH_KPIS, NETWORK_RELIABILITY, SILVER
from netpulse.sources.tables import read_table, stream_table
from netpulse.streaming import commits, layers
from netpulse.streaming.ledger import Ledger
from verification import registry


def silver_of(spark, *values):
    return S.to_silver(B.to_bronze(records_of(spark, values)))


def store_silver(df, cfg, mode="append"):
    df.write.mode(mode).partitionBy(*layers.SILVER_PARTITIONS).parquet(cfg.silver)


def on(day, key, **fields):
    return event(key, timestamp=f"2024-03-{day:02d}T08:00:00+00:00", **fields)


# --- Gold ------------------------------------------------------------------------------------------


def test_dates_that_are_not_touched_stay_as_they_are(spark, cfg):
    store_silver(silver_of(spark, on(1, "a"), on(2, "b"), event("undated", timestamp="?")), cfg)
    before = {r.event_date: r._gold_ts for r in build.build_gold(spark, cfg)["network_reliability"].collect()}
    since = spark.range(1).select(F.current_timestamp()).first()[0]
    store_silver(silver_of(spark, on(2, "c", severity="CRITICAL"), on(3, "d")), cfg)
    dates = build.touched_dates(build.read_silver(spark, cfg), since)
    assert set(dates) == {date(2024, 3, 2), date(2024, 3, 3)}
    after = {r.event_date: r for r in build.build_gold(spark, cfg, dates)["network_reliability"].collect()}
    assert {day: r.total_events for day, r in after.items()} == {
        date(2024, 3, 1): 1,
        date(2024, 3, 2): 2,
        date(2024, 3, 3): 1,
        None: 1,
    }
    assert after[date(2024, 3, 1)]._gold_ts == before[date(2024, 3, 1)]
    assert after[date(2024, 3, 2)]._gold_ts > before[date(2024, 3, 2)]


def test_rows_without_a_date_are_rebuilt_when_touched(spark, cfg):
    store_silver(silver_of(spark, event("x", timestamp="?")), cfg)
    build.build_gold(spark, cfg)
    since = spark.range(1).select(F.current_timestamp()).first()[0]
    store_silver(silver_of(spark, event("y", timestamp="?")), cfg)
    dates = build.touched_dates(build.read_silver(spark, cfg), since)
    assert dates == [None]
    rows = build.build_gold(spark, cfg, dates)["network_reliability"].collect()
    assert [(r.event_date, r.total_events) for r in rows] == [(None, 2)]


def test_any_number_of_dates_is_listed(spark):
    days = spark.range(450).selectExpr("date_add(date'2020-01-01', cast(id as int)) as event_date", "current_timestamp() as _silver_ts")
    dates = build.touched_dates(days, datetime(2020, 1, 1))
    assert len(dates) == 450 and None not in dates


def test_audit_reports_zero_for_tables_that_do_not_exist(spark, cfg):
    replace_table(gold.security_threats(silver_of(spark, event(event_type="security_alert"))), cfg, cfg.gold("security_threats"))
    counts = {r.table_name: r.row_count for r in build.audit_gold(spark, cfg).collect()}
    assert counts == {"device_health_kpis": 0, "alert_summary": 0, "network_reliability": 0, "security_threats": 1}


def test_gold_is_partitioned_by_date(spark, cfg):
    store_silver(silver_of(spark, on(1, "a"), on(2, "b")), cfg)
    table = build.build_gold(spark, cfg)["network_reliability"].filter(on_dates([date(2024, 3, 1)]))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


# --- serving ---------------------------------------------------------------------------------------


def test_contract_violations_are_kept_with_their_reasons(spark):
    df = silver_of(
        spark,
        event("a", payload={"cpu_utilization_pct": 1}),
        event("b", device_id=None),
        event("c", device_id="D" * 21, location="L" * 51),
    )
    valid, rejected = loading.split_by_contract(gold.device_health(df), DEVICE_HEALTH_KPIS)
    assert valid.columns == DEVICE_HEALTH_KPIS.schema.names and valid.count() == 1
    reasons = sorted(r.violations for r in rejected.collect())
    assert reasons == [["device_id: longer than 20", "location: longer than 50"], ["device_id: required"]]


def test_contract_limits_can_be_overridden_only_for_known_columns():
    assert NETWORK_RELIABILITY.with_limits(location=3).fields[0].max_length == 3
    with pytest.raises(KeyError):
        NETWORK_RELIABILITY.with_limits(nowhere=3)


def test_loading_twice_does_not_duplicate(spark, cfg):
    store_silver(silver_of(spark, *[on(day, f"e{day}", location=None if day == 3 else "DC-East") for day in (1, 2, 3)]), cfg)
    build.build_gold(spark, cfg)
    first = build.load_serving(spark, cfg)
    assert {name: df.count() for name, df in first.items()} == {
        "device_health_kpis": 3,
        "alert_summary": 0,
        "network_reliability": 2,
        "security_threats": 0,
    }
    again = build.load_serving(spark, cfg, dates=[date(2024, 3, 2)])
    assert again["network_reliability"].count() == 2 and again["device_health_kpis"].count() == 3
    rejects = build.read_rejects(spark, cfg, "network_reliability")
    assert [r.violations for r in rejects.collect()] == [["location: required"]]
    row = again["network_reliability"].first()
    assert row._sf_load_ts >= row._gold_ts


def test_a_row_that_changes_sides_is_in_one_table_and_an_empty_date_is_cleared(spark, cfg):
    name, days = "network_reliability", [date(2024, 3, d) for d in (1, 2, 3)]

    def load(*values):
        store_silver(silver_of(spark, *values), cfg, "overwrite")
        build.build_gold(spark, cfg, days)
        build.load_serving(spark, cfg, [*days, None])
        places = lambda df: sorted((str(r.event_date), r.location) for r in df.collect())
        return places(build.read_serving(spark, cfg, name)), places(build.read_rejects(spark, cfg, name))

    assert load(on(1, "a"), on(2, "b", location="L" * 51), on(3, "c")) == (
        [("2024-03-01", "DC-East"), ("2024-03-03", "DC-East")],
        [("2024-03-02", "L" * 51)],
    )
    assert load(on(1, "a", location="M" * 51), on(2, "b", location="DC-West")) == (
        [("2024-03-02", "DC-West")],
        [("2024-03-01", "M" * 51)],
    )


def row_groups_read(folder, **wanted):
    """Row groups whose statistics admit the wanted values, and all row groups."""
    met = total = 0
    for path in Path(folder).rglob("*.parquet"):
        meta = pq.ParquetFile(path).metadata
        for group in range(meta.num_row_groups):
            columns = {meta.row_group(group).column(i).path_in_schema: meta.row_group(group).column(i).statistics for i in range(meta.num_columns)}
            total += 1
            met += all(columns[name].min <= value <= columns[name].max for name, value in wanted.items())
    return met, total


def test_space_filling_order_skips_row_groups_of_two_column_filters(spark, cfg):
    rows = spark.range(40_000).selectExpr(
        "date'2024-03-01' as event_date",
        "concat('site-', lpad(cast(pmod(xxhash64(id, 1), 60) as string), 2, '0')) as location",
        "concat('sev-', lpad(cast(pmod(xxhash64(id, 2), 60) as string), 2, '0')) as severity",
        "id as alert_count",
    )
    contract = replace(CONTRACTS["alert_summary"], cluster_by=("event_date", "location", "severity"), keys=("event_date", "location", "severity"))
    met = {}
    for order in ("linear", "zorder"):
        laid_out = cfg.but(cluster_order=order, row_group_bytes=16_384)
        path = cfg.table(order)
        replace_table(clustered(rows, contract, order).coalesce(1), laid_out, path)
        both, total = row_groups_read(path, location="site-30", severity="sev-30")
        second, _ = row_groups_read(path, severity="sev-30")
        assert total > 12
        met[order] = (both / total, second / total)
        assert spark.read.parquet(path).count() == 40_000
    assert met["linear"][1] > 0.9  # every location has every severity
    assert met["zorder"][1] < 0.6 and met["zorder"][0] < 0.25


def test_catalog_tables_have_the_declared_columns(spark, cfg):
    store_silver(silver_of(spark, on(1, "a"), on(2, "b")), cfg)
    build.build_gold(spark, cfg)
    build.load_serving(spark, cfg)
    names = build.create_serving_tables(spark, cfg, "serving_test")
    try:
        for name in names:
            contract = CONTRACTS[name.split(".")[1]]
            declared = {f.name: f.dataType for f in spark.table(name).schema}
            assert declared == {f.name: f.dataType for f in contract.schema}
        assert spark.sql("SELECT count(*) AS n FROM serving_test.network_reliability WHERE event_date = DATE'2024-03-01'").first().n == 1
    finally:
        spark.sql("DROP DATABASE serving_test CASCADE")


# --- quality ---------------------------------------------------------------------------------------


def test_dq_counts_each_problem_once(spark):
    df = silver_of(
        spark,
        event(None),
        event("future", timestamp="2024-03-05T11:00:00Z"),
        event("odd", severity="FATAL"),
        event("none", severity=None),
        event("fine"),
    )
    checks = quality.dq_checks(df, T0)
    expected = {"null_event_ids": 1, "future_events": 1, "invalid_severity": 1, "null_severity": 1}
    assert {r["check"]: r.failed_rows for r in checks.collect()} == expected
    with pytest.raises(quality.DataQualityError) as caught:
        quality.enforce(checks)
    assert set(caught.value.failed) == set(quality.ENFORCED)
    assert quality.enforce(quality.dq_checks(silver_of(spark, event("a", severity=None)), T0))["null_severity"] == 1


def test_recent_window_is_open_at_the_start_and_closed_at_the_end(spark):
    def bronze(produced):
        return B.to_bronze(records_of(spark, [event()], produced=produced))

    assert quality.has_recent_records(bronze(T0), T0)
    assert not quality.has_recent_records(bronze(T0 - timedelta(hours=1)), T0)
    assert not quality.has_recent_records(bronze(T0 + timedelta(seconds=1)), T0)


# --- hourly ----------------------------------------------------------------------------------------


def ingest(spark, cfg, values, produced=T0):
    landing = f"{cfg.base_path}/landing"
    records_of(spark, values, produced).write.mode("append").parquet(landing)
    live = cfg.but(record_source="files", records_path=landing)
    layers.drain(layers.start_bronze(spark, live))
    return live


def test_hourly_run_skips_without_recent_records(spark, cfg):
    assert hourly.run_hourly(spark, cfg, T0).status == "skipped"
    live = ingest(spark, cfg, [event()], produced=T0 - timedelta(hours=3))
    assert hourly.run_hourly(spark, live, T0).status == "skipped"


@pytest.mark.parametrize("fan_out", ["two_queries", "single_scan"])
def test_hourly_run_builds_loads_and_reports(spark, cfg, fan_out):
    cfg = cfg.but(fan_out=fan_out)
    live = ingest(spark, cfg, [event("a", severity="CRITICAL"), on(4, "b"), event("c")])
    report = hourly.run_hourly(spark, live, T0)
    assert report.status == "completed" and report.dates is None and report.notify and report.critical_alerts == 1
    assert [(str(r.event_date), r.severity, r.alerts) for r in report.digest.collect()] == [("2024-03-05", "CRITICAL", 1)]
    assert build.read_serving(spark, live, "network_reliability").count() == 2

    since = spark.range(1).select(F.current_timestamp()).first()[0]
    ingest(spark, cfg, [event("d", event_type="interface_stats")])
    second = hourly.run_hourly(spark, live, T0, since=since)
    assert second.dates == [date(2024, 3, 5)]
    rows = {str(r.event_date): r.total_events for r in build.read_serving(spark, live, "network_reliability").collect()}
    assert rows == {"2024-03-04": 1, "2024-03-05": 3}


def stamped(spark, cfg, moment):
    """Silver's stream with rows stamped at ``moment``, whenever they are committed."""
    bronze = stream_table(spark, cfg, cfg.bronze, BRONZE)
    rows = S.enriched(bronze).withColumn("_silver_ts", F.lit(moment).cast("timestamp"))
    return commits.start_committed(rows, cfg, "silver", "1 second", [layers._silver(cfg)])


def test_a_batch_stamped_before_and_committed_after_a_run_is_found(spark, cfg):
    live = ingest(spark, cfg, [event("a"), on(1, "b"), on(2, "c")])
    assert hourly.run_hourly(spark, live, T0).dates is None
    ingest(spark, cfg, [on(1, "d"), event("e", timestamp="?")])
    layers.drain(stamped(spark, live, datetime(2020, 1, 1)))
    # No file of another date is opened: this one could not be.
    other = next(path for path in Path(live.silver, "event_date=2024-03-02").rglob("*.parquet"))
    other.write_bytes(b"not a table")
    other.with_name(f".{other.name}.crc").unlink(missing_ok=True)
    report = hourly.run_hourly(spark, live, T0)
    assert set(report.dates) == {date(2024, 3, 1), None}
    rows = {r.event_date: r.total_events for r in build.read_gold_table(spark, live, "network_reliability").collect()}
    assert rows == {date(2024, 3, 1): 2, date(2024, 3, 2): 1, date(2024, 3, 5): 1, None: 1}
    assert hourly.run_hourly(spark, live, T0).dates == []  # nothing new


def test_a_refused_batch_stays_uncovered(spark, cfg):
    live = ingest(spark, cfg, [event("a")])
    hourly.run_hourly(spark, live, T0)
    covered = hourly.covered_batches(spark, live)
    ingest(spark, cfg, [event("bad", severity="FATAL"), on(1, None)])
    for _ in range(2):
        with pytest.raises(quality.DataQualityError) as caught:
            hourly.run_hourly(spark, live, T0)
        assert caught.value.failed == {"null_event_ids": 1, "invalid_severity": 1}
        assert hourly.covered_batches(spark, live) == covered
    assert build.read_gold_table(spark, live, "network_reliability").count() == 1


def test_checks_from_the_ledger_equal_a_scan(spark, cfg):
    values = [event(None), event("odd", severity="FATAL"), event("none", severity=None), event("later", timestamp="2024-03-05T11:00:00Z")]
    live = ingest(spark, cfg, [event("fine"), *values, event("undated", timestamp="?")])
    layers.drain(layers.start_silver(spark, live))
    silver, ledger = build.read_silver(spark, live), Ledger(spark, live, "silver")
    for moment in (T0, T0 + timedelta(days=1)):
        scanned = {r["check"]: r.failed_rows for r in quality.dq_checks(silver, moment).collect()}
        assert hourly.new_batch_checks(silver, ledger, {}, ledger.reach(), moment) == scanned


def test_watched_write_counts_in_its_own_job(spark, cfg, tmp_path):
    silver = silver_of(spark, event(None), event("future", timestamp="2024-03-05T11:00:00Z"), event("odd", severity="FATAL"))
    rows, seen = quality.watched(silver, T0)
    assert plan_of(rows).count("CollectMetrics") == 1 and plan_of(rows).count("Scan") == plan_of(silver).count("Scan")
    replace_table(rows, cfg, cfg.silver, layers.SILVER_PARTITIONS)
    got = {r["check"]: r.failed_rows for r in quality.watched_checks(spark, seen).collect()}
    assert got == {r["check"]: r.failed_rows for r in quality.dq_checks(silver, T0).collect()}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dates_and_hours_do_not_follow_the_session(spark, cfg):
    stamps = ["2024-03-05T23:30:00+00:00", "2024-03-05T23:30:00", "2024-03-06T01:30:00+02:00", "2024-03-05 23:30:00.25Z", "2024-03-05", "1969-12-31T23:59:59.5Z", "2024-03-10T02:30:00", "nonsense", "24:99"]

    def seen():
        rows = silver_of(spark, *[event(str(n), timestamp=stamp) for n, stamp in enumerate(stamps)])
        names = ["event_id", "event_hour", "event_date", "event_weekday", F.unix_micros("event_ts")]
        return sorted(tuple(r) for r in rows.select(*names).collect())

    want = seen()
    assert [(r[1], str(r[2]), r[3]) for r in want[:6]] == [(23, "2024-03-05", 3)] * 4 + [(0, "2024-03-05", 3), (23, "1969-12-31", 4)]
    assert [r[1:] for r in want[7:]] == [(None,) * 4] * 2
    for zone in ("Asia/Tokyo", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert seen() == want
            assert spark.conf.get("spark.sql.session.timeZone") == zone
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


# --- sketches ---------------------------------------------------------------------------------------


def test_sketched_hours_merge_to_days_and_months_within_their_error(spark):
    rows = spark.range(300_000).selectExpr(
        "cast(id as string) as event_id", "'link_state' as event_type", "'INFO' as severity", "false as requires_action",
        "concat('D', pmod(xxhash64(id), 30000)) as device_id", "'Switch' as device_type", "'DC-East' as location",
        "'Data Center' as location_type", "date_add(date'2024-03-30', cast(id % 4 as int)) as event_date",
        "cast(id % 24 as int) as event_hour",
    )
    known = {f.name for f in rows.schema.fields}
    silver = rows.selectExpr("*", *[f"cast(null as {f.dataType.simpleString()}) as {f.name}" for f in SILVER.fields if f.name not in known])
    parts = gold.sketch_rollup(gold.device_rollup(silver))
    assert parts.count() == 4 * 6  # 24 hours, of which every fourth falls on a date
    months = {str(r.period_start): r for r in gold.reliability_by(parts).collect()}
    exact = rows.groupBy(F.date_trunc("month", "event_date").cast("date").alias("m")).agg(F.count_distinct("device_id").alias("n"), F.count("*").alias("e"))
    for row in exact.collect():
        found = months[str(row.m)]
        assert found.total_events == row.e
        assert abs(found.device_count - row.n) < 4 * 1.04 / (2 ** (gold.LG_K / 2)) * row.n  # four standard errors
    days = {str(r.period_start): r.device_count for r in gold.reliability_by(parts, "day").collect()}
    assert len(days) == 4 and all(n < months["2024-03-01"].device_count for n in days.values())


def test_stored_rollup_has_the_declared_schema(spark, cfg):
    rollup = gold.device_rollup(silver_of(spark, event("a")))
    assert [(f.name, f.dataType) for f in rollup.schema] == [(f.name, f.dataType) for f in gold.rollup_schema()]


def test_live_streams_survive_an_hourly_run(spark, cfg):
    live = ingest(spark, cfg, [event("a")]).but(available_now=False, silver_every="1 second", alerts_every="1 second")
    queries = layers.start_enriched(spark, live)
    try:
        report = hourly.run_hourly(spark, live, T0)
        assert report.status == "completed" and [q.isActive for q in queries] == [True, True]
        ingest(spark, cfg, [event("late", severity="CRITICAL")])
        for query in queries:
            query.processAllAvailable()
        alerts = read_table(spark, live, live.alerts, ALERTS)
        assert [r.event_id for r in alerts.collect()] == ["late"]
    finally:
        for query in queries:
            query.stop()


def test_failed_checks_stop_before_gold(spark, cfg):
    live = ingest(spark, cfg, [event("a", severity="FATAL")])
    with pytest.raises(quality.DataQualityError):
        hourly.run_hourly(spark, live, T0)
    assert {r.row_count for r in build.audit_gold(spark, live).collect()} == {0}


def test_full_month_through_stored_layers_equals_direct_computation(spark):
    cfg = registry.stored_silver(spark, SF_DIR, "month")
    stored = build.build_gold(spark, cfg)
    silver = registry.silver(spark, SF_DIR)
    for name, table in stored.items():
        direct = gold.BUILDERS[name](gold.contributions(silver)).drop("_gold_ts")
        averaged = [c for c in direct.columns if c.startswith("avg_")]
        a, b = registry.rounded(direct, *averaged), registry.rounded(table.drop("_gold_ts"), *averaged)
        assert a.exceptAll(b.select(a.columns)).isEmpty() and a.count() == b.count()
