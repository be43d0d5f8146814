"""Physical plans: what is read, parsed, shuffled and compiled."""

from __future__ import annotations

import contextlib
import io
import re
from datetime import date, datetime

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from netpulse.operators import gold
from netpulse.operators import silver as S
from netpulse.operators import views as V
from netpulse.operators import quality
from netpulse.plans import build, hourly
from netpulse.plans.writing import on_dates
from verification import registry


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    cfg = registry.stored_silver(spark, SF_DIR, "plans")
    return build.read_silver(spark, cfg), cfg


@pytest.mark.parametrize("name", list(gold.BUILDERS))
def test_json_is_parsed_once_per_record(spark, name):
    plan = plan_of(gold.BUILDERS[name](gold.contributions(registry.silver(spark, SF_DIR))))
    assert plan.count("from_json") == 1


def test_alert_filter_does_not_parse_again(spark):
    assert plan_of(registry.alerts(spark, SF_DIR)).count("from_json") == 1


@pytest.mark.parametrize("table", list(gold.BUILDERS))
def test_gold_aggregation_fits_compiled_methods(spark, stored, table):
    """Aggregation over stored Silver must stay in whole-stage code, below the session's limit."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        gold.BUILDERS[table](gold.contributions(stored[0])).explain("codegen")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    assert max(sizes, default=0) < int(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))


def test_gold_reads_only_the_columns_and_partitions_it_needs(stored):
    silver, _ = stored
    plan = plan_of(gold.device_health(silver.filter(on_dates([date(2024, 1, 3)]))))
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    columns = {part.split(":")[0] for part in schema.split(",")}
    assert "cpu_utilization_pct" in columns and "packet_loss_pct" not in columns and "source_ip" not in columns
    assert "EqualTo(event_type,device_health)" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan)


def test_device_health_from_silver_shuffles_once(stored):
    assert plan_of(gold.device_health(stored[0])).count("Exchange") == 1


@pytest.mark.parametrize("table", [gold.alert_summary, gold.network_reliability, gold.security_threats])
def test_distinct_devices_cost_two_preaggregated_shuffles(stored, table):
    plan = plan_of(table(stored[0]))
    assert plan.count("Exchange") == 2
    for exchange in re.findall(r"Exchange hashpartitioning.*\n.*", plan):
        assert "HashAggregate" in exchange and "partial_" in exchange


def test_alert_filter_reaches_the_scan(stored):
    plan = plan_of(S.select_alerts(stored[0]).select("event_id"))
    assert "EqualTo(requires_action,true)" in plan or "requires_action" in re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)


def test_severity_is_a_partition_filter(stored):
    plan = plan_of(stored[0].filter(F.col("severity") == "CRITICAL").select("event_id"))
    assert re.search(r"PartitionFilters: \[[^\]]*severity", plan)


def test_gates_of_the_last_hour_read_only_its_partitions(spark, stored, tmp_path):
    silver, cfg = stored
    noon = datetime(2024, 1, 3, 12)
    recent = quality.recent_critical(hourly.recent_alerts(silver, cfg, noon), noon)
    plan = plan_of(recent)
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan) and re.search(r"PartitionFilters: \[[^\]]*severity", plan)
    assert recent.collect() == quality.recent_critical(S.select_alerts(silver, cfg.alert_tier), noon).collect()
    path = str(tmp_path / "bronze")
    registry.bronze(spark, SF_DIR).write.partitionBy("_batch_date", "event_type").parquet(path)
    bronze = spark.read.parquet(path)
    gated = bronze.filter(quality.ingested_since(noon) & quality.within("kafka_timestamp", noon))
    assert re.search(r"PartitionFilters: \[[^\]]*_batch_date", plan_of(gated))
    assert gated.count() == bronze.filter(quality.within("kafka_timestamp", noon)).count()


def test_top_n_is_bounded_per_task(stored):
    assert "TakeOrderedAndProject" in plan_of(S.critical_sample(stored[0]))
    reliability = gold.network_reliability(stored[0])
    assert "TakeOrderedAndProject" in plan_of(V.incident_hotspots(reliability))
    assert "TakeOrderedAndProject" in plan_of(V.current_sla_compliance(reliability))


def test_no_plan_uses_python_or_a_cross_join(spark):
    for name in ("silver_enrich", "gold_alert_summary", "q2_problem_devices", "q3_alert_trend", "dq_checks"):
        plan = plan_of(registry.QUERIES[name](spark, SF_DIR))
        for word in ("Python", "Cartesian", "BroadcastNestedLoop"):
            assert word not in plan
