from __future__ import annotations

import random

import numpy as np

from netpulse.llm import substrings
from netpulse.llm.queries import op4_substrings


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_planted_passages_stay_once_and_clean_documents_stay_whole(spark, folder):
    rng = random.Random(8)
    passages = [words(rng, rng.randint(55, 90)) for _ in range(30)]
    rows, planted = [], {}
    for i in range(300):
        text = words(rng, rng.randint(40, 400))
        if i % 3 == 0:
            p = passages[i // 3 % 30]
            cut = rng.randint(0, len(text))
            text = text[:cut] + " " + p + " " + text[cut:]
            planted[i] = p
        rows.append((i, text))
    where = folder("documents", spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    found = {r.doc_id: r for r in op4_substrings(spark, where).collect()}
    text_of, first, lost = dict(rows), {}, []
    for i, p in sorted(planted.items()):
        if p not in first:
            first[p] = i
            assert found[i].text == text_of[i]
        else:
            assert found[i].removed_runs == 1 and p not in found[i].text
            lost.append(found[i].removed_bytes / len(p))
    assert np.mean(lost) > 0.8 and max(lost) <= 1.05
    for i in range(300):
        if i not in planted:
            assert found[i].text == text_of[i] and found[i].removed_bytes == 0


def plain_duplicates(docs: dict[int, str]) -> dict[int, str]:
    """The same rule, passage by passage in order of id: a passage is the chunks from one on that are long enough."""
    seen: set[bytes] = set()
    out = {}
    for i in sorted(docs):
        data = docs[i].encode()
        cuts = substrings.cut_points(data).tolist()
        gone = np.zeros(len(data), bool)
        own = []
        for k, start in enumerate(cuts[:-1]):
            for end in cuts[k + 1 :]:
                words = sum(
                    not data[p : p + 1].isspace() and (p == 0 or data[p - 1 : p].isspace()) for p in range(start, end)
                )
                if words >= substrings.LEAST_WORDS or end - start >= substrings.LEAST_BYTES:
                    own.append(data[start:end])
                    start_of_last = start
                    if own[-1] in seen:
                        gone[start:end] = True
                    break
        if own:  # the last passage also up to the end
            own.append(data[start_of_last:])
            if own[-1] in seen:
                gone[start_of_last:] = True
        seen.update(own)
        out[i] = bytes(np.frombuffer(data, np.uint8)[~gone]).decode()
    return out


def test_query_against_a_plain_loop(spark, tables, folder):
    docs = {r.doc_id: r.text for r in tables("documents").collect()}
    found = {r.doc_id: r.text for r in op4_substrings(spark, "/root/testdata/sf0.001").collect()}
    assert found == plain_duplicates(docs)


def test_cuts_return_after_an_insertion():
    text = words(random.Random(3), 3000).encode()
    before = {text[a:b] for a, b in zip(*[substrings.cut_points(text)[k:] for k in (0, 1)])}
    moved = text[:500] + b"something new here " + text[500:]
    cuts = substrings.cut_points(moved)
    after = [moved[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    assert b"".join(after) == moved
    assert sum(c not in before for c in after) <= 4


def test_gear_hash_matches_its_definition():
    data = words(random.Random(1), 200).encode()
    want = [0]
    for i in range(1, len(data)):
        sums = 0
        for k in range(min(substrings.SPAN, i)):
            sums += int(substrings._GEAR[data[i - 1 - k]]) << k
        starts = data[i - 1 : i] == b" " and data[i : i + 1] != b" "
        if starts and (sums & 0xFFFFFFFF) >> 16 < 65536 // substrings.CUT_ONE_IN:
            want.append(i)
    assert [c for c in substrings.cut_points(data).tolist()[:-1] if c in want] == want


def test_odd_rows(odd):
    found = substrings.deduplicated(odd)
    assert found.columns == [*odd.columns, "_runs", "_removed"]
    rows = found.collect()
    assert len(rows) == odd.count()
    assert {(r.doc_id, r.text) for r in rows} == {(r.doc_id, r.text) for r in odd.collect()}


def test_long_copies_and_no_rows(spark):
    long = words(random.Random(5), 40_000)
    df = spark.createDataFrame([(2, long), (1, long), (None, long), (3, None)], "doc_id long, text string")
    found = {r.doc_id: r.text for r in substrings.deduplicated(df).collect()}
    assert found == {1: long, 2: "", None: "", 3: None}
    assert substrings.deduplicated(df.limit(0)).collect() == []


def test_passages_stand_in_one_earlier_document(spark):
    rng = random.Random(21)
    passage = words(rng, 120)
    parts = [words(rng, 60) for _ in range(6)]
    cuts = [substrings.cut_points((p + " ").encode()) for p in parts]
    pieces = [(p + " ").encode()[c[3] : c[4]].decode() for p, c in zip(parts, cuts)]
    patched = "".join(piece * 8 for piece in pieces)
    rows = [(i, p) for i, p in enumerate(parts)]
    rows += [(10, "pas " * 3), (11, "pas " * 200), (12, patched), (13, passage), (14, f"{words(rng, 30)} {passage} {words(rng, 30)}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in substrings.deduplicated(df).collect()}
    assert all(found[i].text == text for i, text in rows if i < 14)
    assert found[14]._runs == 1 and 0.8 * len(passage) < found[14]._removed <= len(passage) + 1


def test_pipeline_cuts_only_what_an_earlier_document_has(spark, tables):
    import corpus_pipeline

    docs = tables("documents").where("text IS NOT NULL")
    left = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, docs, "").collect()}
    before: set[tuple] = set()
    for r in docs.orderBy("doc_id").collect():
        split = r.text.split()
        runs = {tuple(split[i : i + 15]) for i in range(len(split) - 14)}
        if not runs & before:
            assert left[r.doc_id] == r.text
        before |= runs
