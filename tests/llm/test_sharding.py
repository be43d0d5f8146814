from __future__ import annotations

import zlib
from collections import defaultdict

from netpulse.llm import sharding
from netpulse.llm.queries import op10_sharding
from netpulse.session import work_folder
from netpulse.sources import folders

from .conftest import SMALL


def check(docs, rows, shards=40):
    assert sorted(((r.doc_id, r.text_crc32, r["size"]) for r in rows), key=str) == sorted(
        ((d.doc_id, zlib.crc32((d.text or "").encode()), len((d.text or "").encode()) + 16) for d in docs), key=str
    )
    slots, weight = defaultdict(list), defaultdict(int)
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        weight[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return weight


def test_query(spark, tables):
    docs = tables("documents").collect()
    rows = op10_sharding(spark, SMALL).collect()
    weight = check(docs, rows)
    largest, ideal = max(r["size"] for r in rows), sum(weight.values()) / 40
    assert max(weight.values()) <= ideal + largest and (min(weight.values()) >= ideal - largest or largest > ideal)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, op10_sharding(spark, SMALL).collect()), key=str)


def test_equal_sizes_hot_group_and_small_groups(spark):
    rows = [(i, "copy " * 20 if i % 3 == 0 else f"text {i // 2 if i % 7 == 0 else i} " * 10) for i in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = sharding.sharded(df).collect()
    weight = check(df.collect(), found)
    ideal = sum(weight.values()) / 40
    assert all(abs(w - ideal) <= 0.02 * ideal for w in weight.values())
    homes = defaultdict(set)
    for r in found:
        homes[r.text_crc32].add(r.shard)
    assert sum(len(h) > 1 for h in homes.values()) == 1  # the group above a shard's size
    hot = max(homes.values(), key=len)
    assert max(hot) - min(hot) + 1 == len(hot)


def test_odd_rows(odd):
    check(odd.collect(), sharding.sharded(odd, 3).collect(), 3)
    assert sharding.sharded(odd.limit(0)).collect() == []


def test_repeated_rows_and_null_ids_spread_over_shards(spark):
    rows = [(5, "again " * 9)] * 9000 + [(None, "no id " * 9)] * 3000 + [(i, f"text {i} " * 6) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sharding.sharded(df, 20).collect()
    weight = check(df.collect(), found, 20)
    ideal = sum(weight.values()) / 20
    assert len(weight) == 20 and all(abs(w - ideal) <= 0.02 * ideal for w in weight.values())
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, sharding.sharded(df.repartition(7), 20).collect()), key=str)


def test_no_table_is_left_after_a_job(spark, odd):
    with work_folder(spark) as path:
        assert len(sharding.sharded(odd, 3).collect()) == odd.count()
        assert folders.children(spark, path)
    assert not folders.exists(spark, path)
