from __future__ import annotations

import itertools
import random
import re

import numpy as np
import xxhash

from netpulse.llm import simhash
from netpulse.llm.queries import op2_simhash

from .conftest import SMALL


def plain_fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def components(points: dict[int, set], near) -> dict:
    """least id per node over links, by brute force."""
    label = {p: p for p in points}
    root = lambda p: p if label[p] == p else root(label[p])
    for a, b in itertools.combinations(points, 2):
        if near(a, b):
            label[max(root(a), root(b))] = min(root(a), root(b))
    groups: dict = {}
    for p in points:
        groups.setdefault(root(p), []).append(p)
    return {p: min((i for q in g for i in points[q] if i is not None), default=None) for g in groups.values() for p in g}


def check(docs, rows):
    points: dict[int, set] = {}
    prints = [plain_fingerprint(d.text) for d in docs]
    for d, p in zip(docs, prints):
        points.setdefault(p, set()).add(d.doc_id)
    least = components(points, lambda a, b: (a ^ b).bit_count() <= 2)
    want = sorted(((d.doc_id, f"{p:016x}", least[p]) for d, p in zip(docs, prints)), key=str)
    assert sorted(map(tuple, rows), key=str) == want


def test_query_against_brute_force(spark, tables):
    check(tables("documents").collect(), op2_simhash(spark, SMALL).collect())


def test_odd_rows(odd):
    rows = simhash.near_duplicate_groups(odd).select("doc_id", simhash.fingerprint_text().alias("f"), "component_id")
    check(odd.collect(), rows.collect())
    kept = simhash.deduplicate(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [-9, 0, 1, 4, 5, 6, 7]


def test_no_rows(odd):
    assert simhash.near_duplicate_groups(odd.limit(0)).collect() == []
    assert simhash.deduplicate(odd.limit(0)).collect() == []


def test_masks_cover_every_pair_within_the_radius():
    tree = simhash.mask_tree()
    for level in range(simhash.LEVELS):
        for pair in itertools.combinations(range(64), 2):
            change = sum(1 << p for p in pair)
            parents = [()] if level == 0 else [p for p, m in tree[level - 1].items() if not m & change]
            for parent in parents:
                assert any(not m & change for p, m in tree[level].items() if p[:-1] == parent)
    assert max(64 - m.bit_count() for m in tree[-1].values()) <= 6


def test_large_buckets_are_split_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SPLIT_ABOVE", 20)
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(3)]
    prints = {b ^ sum(1 << p for p in rng.sample(range(64), rng.choice((1, 2, 3, 5)))) for b in base for _ in range(150)}
    prints |= {rng.getrandbits(64) for _ in range(200)}
    nodes = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    from netpulse.llm.common import connected_components

    roots = {r.node: r.root for r in connected_components(simhash.link_edges(nodes)).collect()}
    signed = {p: int(np.uint64(p).astype(np.int64)) for p in prints}
    want = components({p: {p} for p in prints}, lambda a, b: (a ^ b).bit_count() <= 2)
    got: dict = {}
    for p in prints:
        got.setdefault(roots.get(signed[p], signed[p]), set()).add(p)
    expected: dict = {}
    for p, c in want.items():
        expected.setdefault(c, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_deduplicate_keeps_the_least_of_each_group(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    groups = simhash.near_duplicate_groups(docs).select("doc_id", "component_id").collect()
    kept = [r.doc_id for r in simhash.deduplicate(docs).collect()]
    assert sorted(kept) == sorted({r.component_id for r in groups}) and len(kept) < len(groups)
