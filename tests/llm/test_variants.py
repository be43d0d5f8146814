"""Spelling variants: the scan against edit distances of all pairs, the query against plain loops and SQL."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np

from netpulse.llm import queries, variants
from verification.compare import connect, differences

SMALL = "/root/testdata/sf0.001"


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_vocabulary(rows) -> dict[str, int]:
    found: Counter[str] = Counter()
    for doc_id, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def plain_groups(rows) -> list[tuple]:
    vocab = plain_vocabulary(rows)
    by_length: dict[int, list[str]] = {}
    for word in vocab:
        by_length.setdefault(len(word), []).append(word)
    near, form = {}, {}
    for word, n in vocab.items():
        others = [o for k in (-1, 0, 1) for o in by_length.get(len(word) + k, ())]
        near[word] = [o for o in others if one_edit(word, o)]
        best = min(near[word], key=lambda o: (-vocab[o], o), default=None)
        form[word] = best if best is not None and vocab[best] >= 10 * n else None
    out = []
    for word, n in vocab.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, form[word], root, n, len(near[word]), vocab[form[word]] if form[word] else None))
    return sorted(out, key=repr)


def result(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def test_scan_against_all_pairs():
    rng = random.Random(3)
    for alphabet, longest in (("ab", 9), ("abcé", 7), ("a", 12)):
        lists = [sorted({"".join(rng.choices(alphabet, k=rng.randint(1, longest))) for _ in range(rng.randint(1, 90))}) for _ in range(8)]
        words = [w for own in lists for w in own]
        of = [k for k, own in enumerate(lists) for _ in own]
        first = np.flatnonzero([k == 0 or of[k] != of[k - 1] for k in range(len(of))])
        codes, lengths = variants.code_matrix([w.encode("latin-1") for w in words])
        i, j = variants.one_edit_pairs(variants.SortedList.of(codes, lengths, first))
        pairs = list(zip(i.tolist(), j.tolist()))
        want = {(a, b) for a in range(len(words)) for b in range(a + 1, len(words)) if of[a] == of[b] and one_edit(words[a], words[b])}
        assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_query_against_plain_loops(spark, tables):
    rows = [tuple(r) for r in tables("documents").select("doc_id", "text").collect()]
    got = result(variants.grouped(tables("documents")))
    assert got == plain_groups(rows) and any(r[4] for r in got)


def test_query_against_sql(spark):
    assert differences(queries.op13_variants(spark, SMALL), connect(SMALL), queries.ORACLES["op13_variants"]) == []


def variants_of(word: str, rng: random.Random, n: int) -> list[str]:
    """Words a few edits away."""
    out = []
    for _ in range(n):
        w = word
        for _ in range(rng.randint(1, 3)):
            at = rng.randrange(len(w))
            w = rng.choice((w[:at] + w[at + 1 :], w[:at] + rng.choice("abzéÿ") + w[at:], w[:at] + rng.choice("abzéÿ") + w[at + 1 :]))
        out.append(w)
    return out


def crowded(rng: random.Random) -> list[tuple[int, str]]:
    """Texts whose words crowd around a few, so that lists have to be split many times."""
    words = []
    for base in ("aaaaaaaa", "straßenbahn", "conversationalists", "ab" * 40):
        words += variants_of(base, rng, 260) + [base] * 40
    words += [w for w in words if rng.random() < 0.5]
    rng.shuffle(words)
    return [(n, " ".join(words[n * 20 : n * 20 + 20])) for n in range(len(words) // 20)]


def test_split_lists_lose_nothing_and_repeat_nothing(spark):
    rows = crowded(random.Random(11))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_groups(rows)
    assert sum(r[4] for r in want) > 1000 and any(r[1] for r in want)
    assert result(variants.grouped(df)) == want
    assert result(variants.grouped(df, split_words=6)) == want


def test_chains_are_followed_to_the_last(spark):
    words = ["chainedword"] * 300 + ["chainedwora"] * 25 + ["chainedworb"] * 2 + ["chainedworba"] * 2
    words += ["chainedxorb"] * 20 + ["cxainedxorb"] * 2
    text = " ".join(words)
    for doc_id in range(40):  # one in which the hash damages none of them
        rows = [(doc_id, text)]
        if len(plain_vocabulary(rows)) == 6:
            break
    got = result(variants.grouped(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == plain_groups(rows)
    assert any(r[1] and r[2] != r[1] for r in got)


def test_odd_rows(spark, odd, folder):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    rows += [(None, "ÀÉÎõü×÷ÿ Ärgernis ärgernis"), (None, None), (50, "Ärgernis ärgernisZ"), (51, "y" * 5000), (52, "y" * 5000), (53, "y" * 4999), (54, "y" * 4999)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    extra = df.selectExpr("*", "'mine' AS word", "'mine' AS n", "'mine' AS m", "'mine' AS root", "'mine' AS oriented")
    got = result(variants.grouped(extra))
    assert got == plain_groups(rows) and any(len(r[0]) > 4000 and r[4] for r in got)
    df = df.where("text IS NULL OR length(text) < 10000")  # the SQL hashes long runs too slowly
    where = folder("documents", df)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{where}/documents.parquet/*.parquet')")
    assert differences(variants.grouped(df), con, queries.ORACLES["op13_variants"]) == []


def test_empty_table(spark):
    assert variants.grouped(spark.createDataFrame([], "doc_id long, text string")).count() == 0
