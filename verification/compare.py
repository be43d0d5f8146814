"""Side-by-side comparison of a query and its oracle."""

from __future__ import annotations

import glob
import math
import os
from datetime import datetime

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canonical(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, datetime):
        return value.isoformat(sep=" ", timespec="microseconds")
    return str(value)


def canonical_rows(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda position: columns[position])
    return sorted(tuple(_canonical(row[position]) for position in order) for row in rows)


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns and rows agree; otherwise what differs."""
    expected = con.execute(sql)
    expected_columns = [d[0] for d in expected.description]
    if sorted(result.columns) != sorted(expected_columns):
        return [f"columns: {sorted(result.columns)} vs {sorted(expected_columns)}"]
    want = canonical_rows(expected_columns, expected.fetchall())
    got = canonical_rows(result.columns, [tuple(row) for row in result.collect()])
    notes = []
    if len(got) != len(want):
        notes.append(f"rows: {len(got)} vs {len(want)}")
    missing, extra = sorted(set(want) - set(got)), sorted(set(got) - set(want))
    if missing or extra or got != want:
        notes.append(f"{len(extra)} unexpected, {len(missing)} missing; first: {extra[:1]} vs {missing[:1]}")
    return notes
