"""The hourly run: gate, Silver, quality checks, Gold, serving load, critical gate."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netpulse.config import EngineConfig
from netpulse.functions.utc import utc_date
from netpulse.operators import quality
from netpulse.operators.silver import select_alerts
from netpulse.plans import build
from netpulse.plans.writing import on_dates
from netpulse.schemas import bronze_schema
from netpulse.session import prepare
from netpulse.sources.tables import read_table_or_none
from netpulse.streaming import layers
from netpulse.streaming.ledger import BatchLog, Ledger

RUN = "writer string, batch_id bigint, as_of string, covered map<string,bigint>"


@dataclass(frozen=True)
class HourlyReport:
    """What a run did. ``dates`` is None after a full rebuild."""

    status: str
    dq: dict[str, int] = field(default_factory=dict)
    dates: list[date | None] | None = None
    critical_alerts: int = 0
    digest: DataFrame | None = None

    @property
    def notify(self) -> bool:
        return self.critical_alerts > 0


def recent_alerts(silver: DataFrame, cfg: EngineConfig, as_of: datetime) -> DataFrame:
    """Alerts of the dates around the last hour.

    They are selected from Silver, whose partitions by date bound the scan; the Alerts table is not
    partitioned, and a look at its last hour would open its whole history.
    """
    return select_alerts(silver.filter(quality.dated_within(as_of)), cfg.alert_tier)


def completed_runs(spark: SparkSession, cfg: EngineConfig) -> BatchLog:
    """Completed runs by number; each says up to which batch of every Silver writer it went."""
    return BatchLog(spark, cfg.table("ledger/hourly"), RUN)


def covered_batches(spark: SparkSession, cfg: EngineConfig) -> dict[str, int] | None:
    """The last Silver batch per writer that a completed run covered, None if no run has completed."""
    runs = completed_runs(spark, cfg)
    last = runs.record("hourly", runs.last("hourly"))
    return None if last is None else dict(last["covered"] or {})


def new_batch_checks(
    silver: DataFrame, ledger: Ledger, after: dict[str, int], upto: dict[str, int], as_of: datetime
) -> dict[str, int]:
    """The checks of :func:`quality.dq_checks` over the batches between, from what their writes counted.

    Only whether an event lies in the future depends on when one asks. Where the latest event says
    that some do, the partitions from that day on are read for them.
    """
    counts, latest = ledger.counts(after, upto)
    future = 0
    if latest is not None and latest > as_of.timestamp() * 1e6:
        moment = F.lit(as_of)
        future = silver.filter((F.col("event_date") >= utc_date(moment)) & (F.col("event_ts") > moment)).count()
    return {**counts, "future_events": future}


def run_hourly(
    spark: SparkSession,
    cfg: EngineConfig,
    as_of: datetime | None = None,
    since: datetime | None = None,
    full: bool = False,
) -> HourlyReport:
    """One pass up to ``as_of`` (now by default).

    Without recent records nothing runs. The first run builds everything, as does ``full``. A later
    run takes the Silver batches that no completed run covered, whenever they were stamped and
    committed: their event dates are rebuilt, and their checks come from what was counted while they
    were written. ``since`` takes the dates with rows stamped from that moment on instead. A failed
    enforced check raises before Gold is touched, and the run's batches stay uncovered.
    """
    prepare(spark)
    as_of = as_of or datetime.now(timezone.utc)  # one moment for every gate, however long the run takes
    bronze = read_table_or_none(spark, cfg, cfg.bronze, bronze_schema(cfg.payload))
    if bronze is None or not quality.has_recent_records(bronze.filter(quality.ingested_since(as_of)), as_of):
        return HourlyReport("skipped")

    layers.catch_up(spark, cfg)

    ledger, runs = Ledger(spark, cfg, "silver"), completed_runs(spark, cfg)
    number, upto = runs.last("hourly") + 1, ledger.reach()  # before Silver is read: later batches are the next run's
    covered = None if full else covered_batches(spark, cfg)
    silver = build.read_silver(spark, cfg)
    if since is not None and not full:
        dates = build.touched_dates(silver, since)
    else:
        dates = None if covered is None else ledger.dates(covered, upto)
    if dates is None or since is not None:
        checked = silver if dates is None else silver.filter(on_dates(dates))
        dq = quality.enforce(quality.dq_checks(checked, as_of))
    else:
        dq = quality.enforced(new_batch_checks(silver, ledger, covered, upto, as_of))

    if dates is None or dates:
        build.build_gold(spark, cfg, dates)
        build.load_serving(spark, cfg, dates)

    alerts = recent_alerts(silver, cfg, as_of)
    critical = quality.recent_critical(alerts, as_of).first()["critical_alerts"]
    if since is None or full:
        # of two runs at a time, the later one to finish fails here and leaves its batches to the next
        runs.put("hourly", number, {"as_of": as_of.isoformat(), "covered": upto}, replace=False)
    return HourlyReport("completed", dq, dates, critical, quality.alert_digest(alerts, as_of))
