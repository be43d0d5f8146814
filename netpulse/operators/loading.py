"""Contract checks between Gold and the serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netpulse.schemas import Contract


def conform(gold: DataFrame, contract: Contract) -> DataFrame:
    """Select the contract's columns by name, cast to their types, and stamp the load time.

    A value that cannot be cast becomes null and is then judged by the contract like any null.
    """
    now = F.current_timestamp()
    source = gold.withColumn("_sf_load_ts", now)
    return source.select(*[F.col(f.name).try_cast(f.kind).alias(f.name) for f in contract.fields])


def violations(contract: Contract) -> Column:
    """Array of the rules a conformed row breaks; empty for a valid row."""
    rules = []
    for f in contract.fields:
        if f.required:
            rules.append(F.when(F.col(f.name).isNull(), F.lit(f"{f.name}: required")))
        if f.max_length is not None:
            too_long = F.char_length(f.name) > f.max_length
            rules.append(F.when(too_long, F.lit(f"{f.name}: longer than {f.max_length}")))
    return F.array_compact(F.array(*rules))


#: Whether a checked row keeps its contract.
ACCEPTED = "_accepted"


def checked(gold: DataFrame, contract: Contract) -> DataFrame:
    """Conformed rows with a ``violations`` array, empty for a valid row, and whether it is."""
    judged = conform(gold, contract).withColumn("violations", violations(contract))
    return judged.withColumn(ACCEPTED, F.size("violations") == 0)


def checked_schema(contract: Contract) -> T.StructType:
    return T.StructType([*contract.schema.fields]).add("violations", T.ArrayType(T.StringType())).add(ACCEPTED, "boolean")


def valid(rows: DataFrame) -> DataFrame:
    return rows.filter(ACCEPTED).drop("violations", ACCEPTED)


def rejects(rows: DataFrame) -> DataFrame:
    return rows.filter(f"NOT {ACCEPTED}").drop(ACCEPTED)


def split_by_contract(gold: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejects)`` of a Gold table; rejects carry a ``violations`` array. No row is lost."""
    rows = checked(gold, contract)
    return valid(rows), rejects(rows)
