"""Batch builds: Silver to Gold, Gold to serving."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netpulse.config import EngineConfig
from netpulse.operators import gold, loading, quality
from netpulse.plans.writing import DATE, balanced, clustered, on_dates, replace_dates, replace_table
from netpulse.schemas import CONTRACTS, SILVER
from netpulse.sources.tables import read_table, read_table_or_none

ROLLUP = "device_rollup"

Dates = Sequence[date | None]


def read_silver(spark: SparkSession, cfg: EngineConfig) -> DataFrame:
    return read_table(spark, cfg, cfg.silver, SILVER)


def touched_dates(silver: DataFrame, since: datetime) -> list[date | None]:
    """Every event date that got Silver rows at or after ``since``: one entry per day, however many rows.

    Late events touch old dates, so this reads ``_silver_ts``, not the event time. Only that column
    and the partition value are read, and files written before ``since`` are skipped by statistics.
    """
    found = silver.filter(F.col("_silver_ts") >= F.lit(since)).select(DATE).distinct()
    return [row[0] for row in found.collect()]


def build_gold(spark: SparkSession, cfg: EngineConfig, dates: Dates | None = None) -> dict[str, DataFrame]:
    """Rebuild the four Gold tables, all of them or the given event dates only; returns them.

    Silver is scanned once, into a rollup table per device and hour. The four tables are derived
    from that table, so none of them touches Silver again and a lost executor costs at most a
    re-read of the rollup.
    """
    silver = read_silver(spark, cfg)
    if dates is not None:
        silver = silver.filter(on_dates(dates))
    reduced = gold.device_rollup(silver)
    _store(balanced(reduced, DATE), cfg, cfg.gold(ROLLUP), dates)
    rollup = _on(read_table(spark, cfg, cfg.gold(ROLLUP), reduced.schema), dates)
    for name, build in gold.BUILDERS.items():
        _store(balanced(build(rollup), DATE), cfg, cfg.gold(name), dates)
    return read_gold(spark, cfg)


def read_gold(spark: SparkSession, cfg: EngineConfig) -> dict[str, DataFrame]:
    return {name: read_gold_table(spark, cfg, name) for name in gold.BUILDERS}


def read_gold_table(spark: SparkSession, cfg: EngineConfig, name: str) -> DataFrame:
    return read_table(spark, cfg, cfg.gold(name), CONTRACTS[name].gold_schema)


def audit_gold(spark: SparkSession, cfg: EngineConfig) -> DataFrame:
    """Row counts of the Gold tables as stored, 0 for a table that was never built."""
    stored = {
        name: read_table_or_none(spark, cfg, cfg.gold(name), CONTRACTS[name].gold_schema) for name in gold.BUILDERS
    }
    return quality.audit(stored, spark)


def load_serving(
    spark: SparkSession,
    cfg: EngineConfig,
    dates: Dates | None = None,
    tables: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Load Gold into the serving tables by contract; rows that break it are kept apart with their reasons.

    Re-running a load replaces the dates it covers, so it never duplicates rows and leaves none behind.
    """
    for name in tables or CONTRACTS:
        contract = CONTRACTS[name]
        source = _on(read_gold_table(spark, cfg, name), dates)
        checked = loading.checked(source, contract)
        ordered = clustered(checked, contract, cfg.cluster_order, (loading.ACCEPTED,))
        _store(ordered, cfg, checked_path(cfg, name), dates)
    return {name: read_serving(spark, cfg, name) for name in tables or CONTRACTS}


def checked_path(cfg: EngineConfig, name: str) -> str:
    """Where the rows of a contract lie, valid and refused ones together.

    One write per date replaces both, so a row that changes sides is never on both or on none.
    """
    return cfg.serving(name)


def read_serving(spark: SparkSession, cfg: EngineConfig, name: str) -> DataFrame:
    rows = read_table(spark, cfg, checked_path(cfg, name), loading.checked_schema(CONTRACTS[name]))
    return loading.valid(rows)


def read_rejects(spark: SparkSession, cfg: EngineConfig, name: str) -> DataFrame:
    """Refused rows with a ``violations`` array."""
    rows = read_table(spark, cfg, checked_path(cfg, name), loading.checked_schema(CONTRACTS[name]))
    return loading.rejects(rows)


def create_serving_tables(spark: SparkSession, cfg: EngineConfig, database: str = "serving") -> list[str]:
    """Catalog views with the declared columns over the valid rows; returns their names.

    Below each lies a table ``<name>_checked`` over the folder, which also has the refused rows.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, contract in CONTRACTS.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in loading.checked_schema(contract))
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name}_checked ({columns}) USING {cfg.table_format} "
            f"PARTITIONED BY ({DATE}) LOCATION '{checked_path(cfg, name)}'"
        )
        declared = ", ".join(contract.schema.names)
        spark.sql(
            f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {declared} FROM {database}.{name}_checked "
            f"WHERE {loading.ACCEPTED}"
        )
        names.append(f"{database}.{name}")
    refresh_serving_tables(spark, names, cfg)
    return names


def refresh_serving_tables(spark: SparkSession, names: Sequence[str], cfg: EngineConfig) -> None:
    """Make partitions written by :func:`load_serving` visible in the catalog."""
    if cfg.table_format == "delta":
        return
    for name in names:
        spark.sql(f"MSCK REPAIR TABLE {name}_checked SYNC PARTITIONS")


def _on(df: DataFrame, dates: Dates | None) -> DataFrame:
    return df if dates is None else df.filter(on_dates(dates))


def _store(df: DataFrame, cfg: EngineConfig, path: str, dates: Dates | None) -> None:
    if dates is None:
        replace_table(df, cfg, path)
    else:
        replace_dates(df, cfg, path, dates)
