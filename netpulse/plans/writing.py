"""Batch table writes: partitioning, file layout, and which partitions a write replaces."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netpulse.config import EngineConfig
from netpulse.schemas import Contract
from netpulse.sources import folders

DATE = "event_date"
#: Bits per column of a space-filling order; a column is cut into 2 ** ORDER_BITS ranges of equal weight.
ORDER_BITS = 6
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def balanced(df: DataFrame, *keys: str) -> DataFrame:
    """Gather rows by ``keys`` into evenly sized files.

    The rebalance is sized at run time: a key holding a large share of the rows is split over
    several files, and keys with few rows share one.
    """
    return df.hint("rebalance", *[F.col(key) for key in keys])


def clustered(df: DataFrame, contract: Contract, order: str = "linear", first: Sequence[str] = ()) -> DataFrame:
    """Order rows by the clustering columns so that file and row-group statistics can skip data.

    ``linear`` serves filters on the leading columns. ``zorder`` interleaves the columns, so that a
    filter on any of them, or on several, meets few row groups. The rest of the row key follows in
    the range boundaries, so one heavy cluster value spreads over many ranges instead of filling one
    task. ``first`` goes before all.
    """
    rest = [key for key in contract.keys if key not in contract.cluster_by]
    if order == "zorder":
        place = z_value(df, [key for key in contract.cluster_by if key != DATE])
        keys = [*map(F.col, first), F.col(DATE), place, *map(F.col, (*contract.cluster_by, *rest))]
    else:
        keys = [F.col(key) for key in (*first, *contract.cluster_by, *rest)]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def z_value(df: DataFrame, names: Sequence[str]) -> Column:
    """Place of a row on a space-filling curve through ``names``: the interleaved bits of their ranges.

    The ranges are approximate quantiles from one aggregation, a bounded list per column; text counts
    by its first seven bytes. Nulls come first.
    """
    if not names:
        return F.lit(0)
    share = [i / 2**ORDER_BITS for i in range(1, 2**ORDER_BITS)]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    found = df.agg(
        *[F.percentile_approx(_measure(name, kinds[name]), share, 20 * 2**ORDER_BITS).alias(f"q{i}") for i, name in enumerate(names)]
    ).first()
    place = F.lit(0).cast("bigint")
    for i, name in enumerate(names):
        bounds = F.array(*[F.lit(bound).cast("bigint") for bound in sorted(set(found[i] or []))])
        value = _measure(name, kinds[name])
        rank = F.when(value.isNull(), 0).otherwise(F.size(F.filter(bounds, lambda bound: bound <= value)))
        for bit in range(ORDER_BITS):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint")
            place = place + F.shiftleft(one, bit * len(names) + len(names) - 1 - i)
    return place


def _measure(name: str, kind: T.DataType) -> Column:
    """A bigint in the order of the column."""
    if isinstance(kind, T.StringType):
        return F.conv(F.hex(F.rpad(F.substring(F.col(name).cast("binary"), 1, 7), 7, F.lit(b"\0"))), 16, 10).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, T.BooleanType):
        return F.col(name).cast("int").cast("bigint")
    return F.floor(F.col(name).cast("double") * 1000).cast("bigint")


def replace_table(df: DataFrame, cfg: EngineConfig, path: str, partition_by: Sequence[str] = (DATE,)) -> None:
    """Overwrite the whole table, schema included."""
    _writer(df, cfg, partition_by).option("partitionOverwriteMode", "static").option("overwriteSchema", "true").save(path)


def replace_partitions(
    df: DataFrame, cfg: EngineConfig, path: str, partition_by: Sequence[str] = (DATE,)
) -> None:
    """Overwrite only the partitions that ``df`` has rows for."""
    _writer(df, cfg, partition_by).option("partitionOverwriteMode", "dynamic").save(path)


def replace_dates(df: DataFrame, cfg: EngineConfig, path: str, dates: Sequence[date | None]) -> None:
    """Overwrite the given dates; one that has no rows any more is left without any.

    The dates that get rows are noted during the write. Those that get none lose their folder
    after it, so a reader never misses rows that still hold.
    """
    if cfg.table_format == "delta":
        days = ", ".join(f"DATE'{day}'" for day in dates if day is not None)
        parts = [f"{DATE} IN ({days})"] if days else []
        parts += [f"{DATE} IS NULL"] if None in dates else []
        _writer(df, cfg, (DATE,)).option("replaceWhere", " OR ".join(parts) or "false").save(path)
        return
    seen = Observation()
    noted = df.observe(seen, F.collect_set(F.col(DATE).cast("string")).alias("days"), F.count_if(F.col(DATE).isNull()).alias("undated"))
    replace_partitions(noted, cfg, path)
    written = seen.get
    kept = {*written["days"], *([_NO_DATE] if written["undated"] else [])}
    for day in {_NO_DATE if day is None else str(day) for day in dates} - kept:
        folders.remove(df.sparkSession, f"{path}/{DATE}={day}")


def on_dates(dates: Sequence[date | None], column: str = DATE) -> Column:
    """Partition filter for ``dates``; None stands for rows without a date."""
    known = [day for day in dates if day is not None]
    condition = F.col(column).isin(known) if known else F.lit(False)
    return (condition | F.col(column).isNull()) if None in dates else condition


def _writer(df: DataFrame, cfg: EngineConfig, partition_by: Sequence[str]):
    writer = df.write.format(cfg.table_format).mode("overwrite").options(**cfg.layout_options)
    return writer.partitionBy(*partition_by) if partition_by else writer
