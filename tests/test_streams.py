"""Streams: several micro-batches, restarts, fan-out, quarantine, state, monitoring."""

from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from conftest import SF_DIR, event, land, records_of
from pyspark.sql import functions as F

from netpulse.operators import bronze as B
from netpulse.operators import gold
from netpulse.operators import silver as S
from netpulse.plans import build
from netpulse.schemas import ALERTS, BRONZE, CLOCK_COLUMNS
from netpulse.sources import folders
from netpulse.sources.records import read_records, stream_records
from netpulse.sources.tables import read_table, read_table_or_none, stream_table
from netpulse.streaming import layers, progress, stateful, upserts
from netpulse.streaming.ledger import BatchLog, ForeignWriterError, Ledger
from verification import registry


@pytest.fixture
def landed(spark, cfg, tmp_path):
    """Telemetry of the small scale factor in eight files, two per micro-batch."""
    folder = land(registry.records(spark, SF_DIR), str(tmp_path / "landing"), files=8)
    return cfg.but(record_source="files", records_path=folder, max_files_per_trigger=2)


def stable(df):
    return df.select(*[name for name in df.columns if name not in CLOCK_COLUMNS])


def same_rows(a, b):
    a, b = stable(a), stable(b)
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_layers_in_small_batches_equal_the_batch_functions(spark, landed):
    bronze_query = layers.start_bronze(spark, landed)
    layers.drain(bronze_query)
    batches = [p for p in bronze_query.recentProgress if p.numInputRows]
    assert len(batches) == 4 and sum(p.numInputRows for p in batches) == 1000
    layers.drain(layers.start_silver(spark, landed), layers.start_alerts(spark, landed))
    batch = B.to_bronze(read_records(spark, landed))
    without_map = [name for name in BRONZE.names if name != "payload"]
    stored = read_table(spark, landed, landed.bronze, BRONZE)
    assert same_rows(stored.select(without_map), batch.select(without_map))
    assert same_rows(build.read_silver(spark, landed), S.to_silver(batch))
    assert same_rows(read_table(spark, landed, landed.alerts, ALERTS), S.to_alerts(batch))
    clocks = build.read_silver(spark, landed).agg(
        F.count_if(F.col("_silver_ts") < F.col("_ingest_ts")), F.count_if(F.col("_ingest_ts").isNull())
    )
    assert tuple(clocks.first()) == (0, 0)


def test_restart_adds_nothing_and_new_files_add_only_themselves(spark, landed):
    layers.drain(layers.start_bronze(spark, landed))
    layers.drain(layers.start_bronze(spark, landed))
    assert read_table(spark, landed, landed.bronze, BRONZE).count() == 1000
    records_of(spark, [event("late")]).write.mode("append").parquet(landed.records_path)
    layers.drain(layers.start_bronze(spark, landed))
    assert read_table(spark, landed, landed.bronze, BRONZE).count() == 1001


def test_single_scan_fan_out_equals_two_queries(spark, landed):
    layers.drain(layers.start_bronze(spark, landed))
    layers.drain(layers.start_silver_and_alerts(spark, landed))
    batch = B.to_bronze(read_records(spark, landed))
    assert same_rows(build.read_silver(spark, landed), S.to_silver(batch))
    assert same_rows(read_table(spark, landed, landed.alerts, ALERTS), S.to_alerts(batch))


def files_below(folder):
    return sorted(str(path) for path in Path(folder).rglob("part-*"))


def uncommitted(cfg, name):
    """As after a crash between the last batch's write and its commit."""
    commits = [path for path in Path(cfg.checkpoint(name), "commits").iterdir() if path.name.isdigit()]
    last = max(commits, key=lambda path: int(path.name))
    last.unlink()
    last.with_name(f".{last.name}.crc").unlink(missing_ok=True)
    return int(last.name)


@pytest.mark.parametrize("fan_out", ["two_queries", "single_scan"])
def test_a_batch_replayed_after_a_crash_replaces_its_rows_and_its_record(spark, landed, fan_out):
    cfg = landed.but(fan_out=fan_out)
    layers.drain(layers.start_bronze(spark, cfg))
    layers.drain(*layers.start_enriched(spark, cfg))
    batch = S.to_silver(B.to_bronze(read_records(spark, cfg)))
    ledger = Ledger(spark, cfg, "silver")
    before = {r.batch_id: r.rows for r in ledger.log.records().collect()}
    assert sum(before.values()) == 1000 and list(ledger.reach().values()) == [max(before)]
    replayed = uncommitted(cfg, "silver" if fan_out == "two_queries" else "silver_and_alerts")
    assert replayed == max(before)
    layers.drain(*layers.start_enriched(spark, cfg))
    assert same_rows(build.read_silver(spark, cfg), batch)
    assert {r.batch_id: r.rows for r in ledger.log.records().collect()} == before


def test_a_foreign_checkpoint_is_refused_until_the_tables_are_cleared(spark, landed):
    layers.drain(layers.start_bronze(spark, landed))
    layers.drain(layers.start_silver_and_alerts(spark, landed))
    batch = B.to_bronze(read_records(spark, landed))
    # A lost checkpoint, and other batch bounds than before: the old batch numbers mean nothing.
    lost = landed.but(checkpoint_path=f"{landed.checkpoint_path}-again", max_files_per_trigger=1)
    with pytest.raises(StreamingQueryException, match="holds batches of query"):
        layers.drain(layers.start_silver_and_alerts(spark, lost))
    assert same_rows(build.read_silver(spark, landed), S.to_silver(batch))
    layers.clear_enriched(spark, lost)
    assert build.read_silver(spark, lost).isEmpty() and read_table(spark, lost, lost.alerts, ALERTS).isEmpty()
    again = lost.but(checkpoint_path=f"{landed.checkpoint_path}-new")
    layers.drain(layers.start_silver_and_alerts(spark, again))
    assert same_rows(build.read_silver(spark, again), S.to_silver(batch))
    assert same_rows(read_table(spark, again, again.alerts, ALERTS), S.to_alerts(batch))


def test_other_bounds_for_a_known_batch_are_refused(spark, cfg):
    ledger = Ledger(spark, cfg, "silver")
    measured = dict(rows=1, dates=[], undated=1, null_event_ids=0, invalid_severity=0, null_severity=0, latest_event_us=None)
    ledger.record("q", 7, "offset 3", measured)
    ledger.claim("q", 7, "offset 3")
    ledger.claim("q", 8, "offset 9")
    with pytest.raises(ForeignWriterError):
        ledger.claim("q", 7, "offset 4")


def test_a_table_of_a_file_sink_is_not_written_beside_its_log(spark, landed):
    layers.drain(layers.start_bronze(spark, landed))
    bronze = stream_table(spark, landed, landed.bronze, BRONZE)
    layers.drain(layers.append_stream(S.to_silver(bronze), landed, "old", landed.silver, "1 second", layers.SILVER_PARTITIONS))
    with pytest.raises(ForeignWriterError, match="file sink"):
        layers.start_silver(spark, landed)


def test_ledger_finds_batches_beyond_a_block(spark, cfg):
    log = BatchLog(spark, cfg.table("log"), "writer string, batch_id bigint, n bigint")
    assert log.last("q") == -1 and log.records().count() == 0
    for number in (0, 998, 999, 1000, 2500):
        log.put("q", number, {"n": number * 2})
    log.put("q", 999, {"n": -1})
    assert log.last("q") == 2500 and log.reach() == {"q": 2500}
    found = lambda **k: sorted((r.batch_id, r.n) for r in log.records(**k).collect())
    assert found(after={"q": 998}) == [(999, -1), (1000, 2000), (2500, 5000)]
    assert found(after={"q": 999}, upto={"q": 1000}) == [(1000, 2000)]
    with pytest.raises(FileExistsError):
        log.put("q", 2500, {"n": 0}, replace=False)


def test_files_of_a_batch_follow_its_bytes_and_not_its_tasks(spark, landed):
    one = landed.but(max_files_per_trigger=8, bronze_files=1)
    layers.drain(layers.start_bronze(spark, one))
    assert len(files_below(one.bronze)) == 4  # eight source files, four event types
    layers.drain(*layers.start_enriched(spark, one))
    groups = build.read_silver(spark, one).select("event_date", "severity").distinct().count()
    dates = read_table(spark, one, one.alerts, ALERTS).select("event_date").distinct().count()
    assert len(files_below(one.silver)) == groups and len(files_below(one.alerts)) == dates


def test_alerts_can_follow_the_source_and_keep_criticals_only(spark, landed):
    direct = landed.but(alerts_from="source", alert_tier="critical")
    layers.drain(layers.start_alerts(spark, direct))
    assert read_table_or_none(spark, direct, direct.bronze, BRONZE) is None
    expected = S.to_alerts(B.to_bronze(read_records(spark, direct)), "critical")
    assert same_rows(read_table(spark, direct, direct.alerts, ALERTS), expected)


def test_quarantine_splits_the_topic_without_losing_records(spark, cfg, tmp_path):
    records = records_of(spark, ["{bad", None, event("a"), event("b")])
    folder = land(records, str(tmp_path / "landing"))
    strict = cfg.but(record_source="files", records_path=folder, quarantine=True)
    layers.drain(layers.start_bronze(spark, strict), layers.start_rejects(spark, strict))
    assert read_table(spark, strict, strict.bronze, BRONZE).count() == 2
    reasons = {r.reason for r in spark.read.parquet(strict.rejects).collect()}
    assert reasons == {"malformed", "tombstone"}


def test_processing_time_trigger_runs_until_stopped(spark, landed):
    live = landed.but(available_now=False, bronze_every="1 second")
    query = layers.start_bronze(spark, live)
    try:
        query.processAllAvailable()
        assert query.isActive and query.lastProgress is not None
    finally:
        query.stop()
    assert read_table(spark, live, live.bronze, BRONZE).count() == 1000


def test_kafka_options_reach_the_source(spark, cfg):
    """Without the connector on the class path the request must still name Kafka, not fall back."""
    with pytest.raises(Exception, match="(?i)kafka"):
        stream_records(spark, cfg.but(max_offsets_per_trigger=1000))


def test_stream_dedup_over_batches_with_hot_id(spark, cfg, tmp_path):
    """A third of all records repeat one id, in every file; null ids are all kept."""
    values = []
    for n in range(90):
        stamp = (datetime(2024, 3, 5) + timedelta(seconds=n)).isoformat()
        values.append(event("hot" if n % 3 == 0 else f"e{n // 2}", timestamp=stamp))
    values += [event(None), event(None)]
    folder = land(records_of(spark, values), str(tmp_path / "landing"), files=4)
    live = cfg.but(record_source="files", records_path=folder, max_files_per_trigger=1)
    unique = stateful.deduplicate_stream(B.to_bronze(stream_records(spark, live)), delay="1 day", spread=4)
    layers.drain(layers.append_stream(unique, live, "unique", live.table("unique"), "1 second"))
    ids = [r.event_id for r in spark.read.parquet(live.table("unique")).select("event_id").collect()]
    known = [i for i in ids if i is not None]
    assert len(known) == len(set(known)) and set(known) == {v["event_id"] for v in values} - {None}
    assert ids.count(None) == 2


def test_windowed_reliability_matches_batch_counts(spark, landed):
    # One micro-batch: across batches, files out of time order would be late for the watermark.
    silver_stream = S.to_silver(B.to_bronze(stream_records(spark, landed.but(max_files_per_trigger=None))))
    windows = stateful.windowed_reliability(silver_stream, delay="40 days", length="1 day")
    layers.drain(layers.append_stream(windows, landed, "w", landed.table("w"), "1 second"))
    # Nothing is older than the watermark, so nothing is emitted, and nothing is lost either.
    assert spark.read.schema(windows.schema).parquet(landed.table("w")).count() == 0
    short = stateful.windowed_reliability(silver_stream, delay="1 hour", length="1 day")
    layers.drain(layers.append_stream(short, landed, "s", landed.table("s"), "1 second"))
    got = spark.read.schema(short.schema).parquet(landed.table("s"))
    silver = S.to_silver(B.to_bronze(read_records(spark, landed)))
    closed = silver.filter(F.col("event_date") < F.lit("2024-01-30").cast("date"))
    assert got.agg(F.sum("total_events")).first()[0] == closed.count()
    assert got.filter("sla_met != (availability_pct >= 99.9)").isEmpty()


def test_progress_of_every_batch_outlives_the_driver(spark, cfg, tmp_path):
    """160 micro-batches of a query that is started twice, each time with another listener."""
    schema, found = "n bigint", []
    for start in (0, 80):
        spark.range(start, start + 80, 1, 80).select(F.col("id").alias("n")).write.mode("append").parquet(str(tmp_path / "in"))
        log = progress.ProgressTable(spark, cfg.table("progress"))
        spark.streams.addListener(log)
        try:
            rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
            query = rows.writeStream.format("noop").option("checkpointLocation", cfg.checkpoint("n")).trigger(availableNow=True).start()
            layers.drain(query)
            log.settle()
        finally:
            spark.streams.removeListener(log)
        found.append(str(query.id))
    assert found[0] == found[1]
    kept = progress.ProgressTable(spark, cfg.table("progress")).rows(found[0]).collect()
    assert sorted(r.batch_id for r in kept) == list(range(160)) and sum(r.input_rows for r in kept) == 160
    assert len(progress.progress_rows(spark, query).collect()) < 160


def test_progress_table_logs_failures(spark, landed):
    log = progress.ProgressTable(spark, landed.table("progress"))
    spark.streams.addListener(log)
    try:
        broken = stream_records(spark, landed).withColumn("n", F.raise_error(F.lit("no good")).cast("int"))
        with pytest.raises(StreamingQueryException):
            layers.drain(broken.writeStream.format("noop").option("checkpointLocation", landed.checkpoint("x")).trigger(availableNow=True).start())
        log.settle()
    finally:
        spark.streams.removeListener(log)
    assert "no good" in log.failures.records().first().exception


def test_stream_dedup_keeps_rows_whose_event_time_falls_or_is_missing(spark, cfg, tmp_path):
    """Arrival counts: each batch's events are older than all before, and an undated id comes in every batch."""
    values = []
    for batch in range(4):
        stamp = (datetime(2024, 3, 5) - timedelta(days=10 * batch)).isoformat()
        values += [event(f"b{batch}-{n}", timestamp=stamp) for n in range(3)] + [event("undated", timestamp="?")]
    folder = land(records_of(spark, values), str(tmp_path / "landing"), files=4)
    live = cfg.but(record_source="files", records_path=folder, max_files_per_trigger=1)
    unique = stateful.deduplicate_stream(B.to_bronze(stream_records(spark, live)), delay="1 hour")
    query = layers.append_stream(unique, live, "unique", live.table("unique"), "1 second")
    layers.drain(query)
    assert len([p for p in query.recentProgress if p.numInputRows]) == 4
    ids = sorted(r.event_id for r in spark.read.parquet(live.table("unique")).select("event_id").collect())
    assert ids == sorted({v["event_id"] for v in values})


def test_live_gold_follows_every_batch(spark, landed):
    """After each start the live tables hold what has come so far, open windows included."""
    half = landed.but(records_path=f"{landed.base_path}/half", max_files_per_trigger=1)
    rows = read_records(spark, landed)
    for later in (False, True):
        rows.filter((F.col("offset") % 2 == 1) == later).repartition(2).write.mode("append").parquet(half.records_path)
        layers.drain(layers.start_bronze(spark, half))
        layers.drain(
            upserts.start_live_rollup(spark, half, delay="60 days"), upserts.start_live_health(spark, half, delay="60 days")
        )
        silver = S.to_silver(B.to_bronze(read_records(spark, half)))
        live = upserts.read_live_gold(spark, half)
        for name in ("alert_summary", "security_threats"):
            assert same_rows(live[name], gold.BUILDERS[name](gold.contributions(silver)))
        health = registry.health_rounded(gold.device_health(silver)).drop("event_date", "event_hour", "_gold_ts")
        windows = registry.health_rounded(upserts.read_live_health(spark, half)).select(health.columns)
        assert windows.exceptAll(health).isEmpty() and health.count() == windows.count()


def test_an_upsert_broken_off_in_the_middle_is_taken_from_its_stage(spark, landed):
    layers.drain(layers.start_bronze(spark, landed))
    layers.drain(upserts.start_live_rollup(spark, landed, delay="60 days"))
    whole = upserts.read_live_rollup(spark, landed)
    before = [tuple(r) for r in whole.orderBy(*whole.columns).collect()]
    last = uncommitted(landed, upserts.LIVE_ROLLUP)
    stage = landed.table(f"staged/{upserts.LIVE_ROLLUP}/batch_id={last}")
    hour = spark.read.schema(gold.rollup_schema()).parquet(stage).first()
    broken = f"event_date={hour.event_date}/event_hour={hour.event_hour}"
    assert folders.exists(spark, landed.table(f"{upserts.LIVE_ROLLUP}/{broken}"))
    folders.remove(spark, landed.table(f"{upserts.LIVE_ROLLUP}/{broken}"))  # replaced, but not filled again
    layers.drain(upserts.start_live_rollup(spark, landed, delay="60 days"))
    whole = upserts.read_live_rollup(spark, landed)
    assert [tuple(r) for r in whole.orderBy(*whole.columns).collect()] == before


def test_chained_stream_reads_only_committed_bronze(spark, landed):
    layers.drain(layers.start_bronze(spark, landed))
    chained = stream_table(spark, landed, landed.bronze, BRONZE)
    assert chained.isStreaming and chained.columns == BRONZE.names
