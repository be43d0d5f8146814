from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from netpulse.llm import syncmers
from netpulse.llm.queries import op8_syncmers

from .conftest import SMALL


def plain_anchors(words: list[str], hashes: dict) -> list[int]:
    """hashes: xxhash64 of a word, of a pair of hashes, and of a list of hashes, by Spark."""
    h = [hashes[w] for w in words]
    if len(h) < syncmers.K:
        return [tuple(h)] if h else []
    inner = [hashes[(h[i], h[i + 1])] for i in range(len(h) - 1)]
    n = syncmers.K - syncmers.S
    places = range(len(h) - syncmers.K + 1)
    picked = [i for i in places if min(inner[i : i + n + 1]) in (inner[i], inner[i + n])]
    runs = [tuple(h[i : i + syncmers.K]) for i in picked or places]
    return list(dict.fromkeys(runs)) if picked else [("least", *runs)]


def likeness(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def check(spark, docs, rows):
    docs = sorted(docs, key=lambda d: (d.doc_id is None, -(d.doc_id or 0), d.text or ""))
    texts = [d.text or "" for d in docs]
    follow = texts[1:] + texts[:1]
    edited = []
    for t, f in zip(texts, follow):
        half = len(t) // 2
        edited.append(t[: len(t) - half] + f[:half])
    split = {t: re.findall(r"[^\x20\x09-\x0D]+", t) for t in {*texts, *edited}}
    words = sorted({w for x in split.values() for w in x})
    one = {r.w: r.h for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    pairs = {(one[a], one[b]) for x in split.values() for a, b in zip(x, x[1:])}
    two = {(r.a, r.b): r.h for r in spark.createDataFrame(list(pairs) or [(0, 0)], "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("h")).collect()}
    found = {t: plain_anchors(x, one | two) for t, x in split.items()}
    runs = [(list(a),) for a in {a for x in found.values() for b in x for a in (b[1:] if b[0] == "least" else [b])}]
    digest = {tuple(r.a): r.h for r in spark.createDataFrame(runs, "a array<long>").select("a", F.shiftrightunsigned(F.xxhash64("a"), 32).alias("h")).collect()}
    hashed = lambda a: min(digest[run] for run in a[1:]) if a[0] == "least" else digest[a]
    prints = {t: list(dict.fromkeys(map(hashed, x))) for t, x in found.items()}
    want = [
        (d.doc_id, len(t), hashlib.sha256(e.encode()).hexdigest(), "".join(f"{a:08x}" for a in prints[t]),
         "".join(f"{a:08x}" for a in prints[e]), likeness(set(prints[t]), set(prints[e])), likeness(set(prints[t]), set(prints[f])))
        for d, t, e, f in zip(docs, texts, edited, follow)
    ]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def test_query_against_brute_force(spark, tables):
    check(spark, tables("documents").collect(), op8_syncmers(spark, SMALL).collect())


def test_odd_rows(spark, odd):
    rows = syncmers.fingerprinted(odd).collect()
    check(spark, odd.collect(), rows)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows(spark, tables, n):
    df = tables("documents").orderBy("doc_id").limit(n)
    check(spark, df.collect(), syncmers.fingerprinted(df).collect()) if n else None
    assert syncmers.fingerprinted(df).count() == n


def test_anchors_depend_on_their_own_words_only(spark):
    words = [f"w{i * 7919 % 1000}" for i in range(400)]
    moved = ["new", "words", "before", *words[:200], "inserted", *words[200:]]
    df = spark.createDataFrame([(" ".join(words), " ".join(moved))], "a string, b string")
    a, b = df.select(syncmers.anchors(F.col("a")), syncmers.anchors(F.col("b"))).first()
    assert len(set(a) - set(b)) <= syncmers.K


def test_unlike_short_texts_are_not_alike(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(8 + i % 4))) for i in range(60)]
    found = syncmers.fingerprinted(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.fingerprint and r.near_next == 0 for r in found)
