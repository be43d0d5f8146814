from __future__ import annotations

import re
from collections import defaultdict
from statistics import median

import pytest

from netpulse.llm import mixing
from netpulse.llm.queries import op1_mixing

from .conftest import SMALL


def water_filling(sizes: dict, max_epochs: int = 3) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(max_epochs * sizes[s] for s in capped)
        level = rest / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > max_epochs * sizes[s]}
        if not over:
            return {s: max_epochs * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= over


def check(rows):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        assert r.taken <= 3 * r["size"]
    want = water_filling(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
    return sizes, taken, want


def test_query_against_plain_water_filling(spark):
    rows = op1_mixing(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    size = {d.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for d in docs}
    assert {r.doc_id: r["size"] for r in rows} == size
    sizes, taken, want = check(rows)
    for s in sizes:  # ten documents a source here: whole ones come as near as half a typical document
        typical = median(size[r.doc_id] for r in rows if r.source == s)
        assert abs(taken[s] - want[s]) <= 0.02 * want[s] + typical / 2
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op1_mixing(spark, SMALL).collect()))


def test_targets_stop_at_the_cap_and_the_excess_is_reshared(spark):
    rows = [(i, "w " * 50, "a" if i < 200 else ("b" if i < 202 else "c")) for i in range(220)]
    found = mixing.mixed_sizes(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    _, taken, want = check(found)
    assert want["b"] == 300 and taken["b"] == 300
    assert sum(want.values()) == pytest.approx(220 * 50)


def test_empty_documents_keep_to_the_cap(spark):
    rows = [(1, "w " * 40, "a"), (2, "", "a"), (3, None, "a"), (4, "w " * 4000, "b"), (5, "", "b"), (6, "", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    times = {r.doc_id: r["count"] for r in mixing.mixed(docs).groupBy("doc_id").count().collect()}
    assert times[1] == 3 and times[2] == times[3] == 3
    assert max(times.values()) <= 3 and times[6] == 1


def test_odd_rows(odd):
    rows = mixing.mixed_sizes(odd).collect()
    assert len(rows) == odd.count()
    check(rows)
    mixed = mixing.mixed(odd)
    assert mixed.columns == odd.columns
    reps = {(r.doc_id, r.source): (r.taken, r["size"]) for r in rows if r["size"]}
    counts = {(r.doc_id, r.source): r["count"] for r in mixed.where("text is not null").groupBy("doc_id", "source").count().collect()}
    for key, (taken, size) in reps.items():
        copies = 2 if key[0] == 8 else 1
        assert counts.get(key, 0) == copies * taken // size


def test_no_rows(odd):
    assert mixing.mixed_sizes(odd.limit(0)).collect() == []
    assert mixing.mixed(odd.limit(0)).collect() == []
