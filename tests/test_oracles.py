"""Every registered query against its independent DuckDB SQL."""

from __future__ import annotations

import __spark_entry__ as entry_module
import pytest
from conftest import SF_DIR

from verification.compare import connect, differences
from verification.oracles import ORACLES
from verification.registry import QUERIES


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, oracle, name):
    assert differences(QUERIES[name](spark, SF_DIR), oracle, ORACLES[name]) == []


def test_queries_without_oracle_are_the_expected_ones():
    assert set(QUERIES) == set(ORACLES)


def test_progress_counts_every_event(spark):
    rows = QUERIES["stream_progress"](spark, SF_DIR)
    total = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    assert sum(r.input_rows for r in rows.collect()) == total


def test_entry_returns_one_row_per_recent_day(spark):
    rows = entry_module.entry(spark).collect()
    days = [r.event_date for r in rows]
    assert len(rows) == 7 and days == sorted(days, reverse=True)


def test_outputs_are_not_trivially_empty(spark, oracle):
    empty = [name for name, sql in ORACLES.items() if not oracle.execute(sql).fetchall()]
    assert set(empty) <= {"alert_digest"}
