"""Time the headline queries, and stored layers on a larger input; prints one JSON line.

BENCH_SF_DIR  folder with the input tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_ONLY    comma-separated query names (default: the list below)
BENCH_COPIES  copies of the events for the stored layers, each 30 days later (default 2; 0 leaves that part out)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from netpulse import EngineConfig, build_session  # noqa: E402
from netpulse.operators import bronze, silver, views  # noqa: E402
from netpulse.plans import build  # noqa: E402
from netpulse.session import fresh_folder  # noqa: E402
from netpulse.streaming import layers  # noqa: E402
from verification import telemetry  # noqa: E402
from verification.registry import QUERIES  # noqa: E402

HEADLINE = (
    "bronze_parse",
    "silver_enrich",
    "filter_alerts",
    "dq_checks",
    "gold_device_health",
    "gold_alert_summary",
    "gold_network_reliability",
    "gold_security_threats",
    "gold_write_roundtrip",
    "gold_incremental_equals_full",
    "load_serving_device_health",
    "vw_executive",
    "vw_device_health_summary",
    "vw_critical_alerts_24h",
    "vw_sla_breaches",
    "q1_sla_compliance",
    "q2_problem_devices",
    "q3_alert_trend",
    "q4_threat_breakdown",
    "q5_bandwidth_by_location",
    "stream_bronze",
    "stream_silver",
    "stream_alerts",
)


def stored_layers(spark, sf_dir: str, copies: int, cpus: int) -> dict:
    """Seconds of the steps between stored layers, and of micro-batches, over several copies of the events."""
    root = fresh_folder(spark, "bench")
    events = telemetry.read_events(spark, sf_dir)
    n = events.count()
    many = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
        (F.col("event_id") + F.col("copy") * n).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(F.col("copy") * 30)).alias("ts"), "user_id", "event_type", "value", "props",
    )
    landing = f"{root}/landing"
    telemetry.telemetry_records(many).repartitionByRange(2 * cpus, "timestamp").write.parquet(landing)
    cfg = EngineConfig.under(root, available_now=True, record_source="files", records_path=landing, max_files_per_trigger=4)
    seconds = {}

    def timed(name: str, step):
        start = time.perf_counter()
        result = step()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    def consume(df):
        df.write.format("noop").mode("overwrite").save()

    timed("parse_and_enrich", lambda: consume(silver.to_silver(bronze.to_bronze(spark.read.parquet(landing)))))
    batches = {}
    for name, start in (("bronze", layers.start_bronze), ("silver", layers.start_silver), ("alerts", layers.start_alerts)):
        query = timed(f"{name}_stream", lambda start=start: _drained(start(spark, cfg)))
        took = [p.durationMs["triggerExecution"] / 1000 for p in query.recentProgress if p.numInputRows]
        batches[name] = {"batches": len(took), "p50": statistics.median(took), "p95": sorted(took)[int(0.95 * (len(took) - 1))]}
    timed("gold_full", lambda: build.build_gold(spark, cfg))
    timed("gold_one_date", lambda: build.build_gold(spark, cfg, [date(2024, 1, 10)]))
    timed("serving_load", lambda: build.load_serving(spark, cfg))
    gold = build.read_gold(spark, cfg)
    timed("vw_executive", lambda: consume(views.executive(gold["network_reliability"])))
    timed("vw_device_health_summary", lambda: consume(views.device_health_summary(gold["device_health_kpis"])))
    timed("q3_alert_trend", lambda: consume(views.alert_trend(gold["alert_summary"])))
    rate = round(n * copies / seconds["parse_and_enrich"])
    return {"events": n * copies, "seconds": seconds, "batch_seconds": batches, "enriched_per_second": rate}


def _drained(query):
    layers.drain(query)
    return query


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n] or HEADLINE
    spark = build_session(
        "netpulse-bench", f"local[{cpus}]", {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("silver_enrich")  # start-up cost of the JVM is not a query cost
    times = {name: round(run(name), 3) for name in names}
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    copies = int(os.environ.get("BENCH_COPIES", "2"))
    stored = stored_layers(spark, sf_dir, copies, int(cpus)) if copies else {}
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "events_per_second": {
                    name: round(events / times[name])
                    for name in ("bronze_parse", "silver_enrich", "stream_bronze", "stream_silver")
                    if name in times
                },
                "events": events,
                "stored_layers": stored,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
