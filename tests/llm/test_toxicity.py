from __future__ import annotations

import zlib

import numpy as np

from netpulse.llm import toxicity
from netpulse.llm.queries import op5_toxicity


def area(score, label) -> float:
    """Chance that a toxic document scores above an ordinary one."""
    rank = np.argsort(np.argsort(score)) + 1
    n = (label == 1).sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (label == 0).sum())


def test_held_out_accuracy(spark):
    data = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in op5_toxicity(spark, data).collect()}
    labels = spark.read.parquet(f"{data}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{data}/documents.parquet").count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)
    held = [(rows[x.doc_id].score, x.toxic) for x in labels if rows[x.doc_id].held_out]
    score, label = np.array(held).T
    assert area(score, label) > 0.9


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    flipped = labels.selectExpr("doc_id", "if(pmod(crc32(cast(doc_id as string)), 4) = 2, 1 - toxic, toxic) as toxic")
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, flipped)


def test_odd_rows(spark, odd):
    docs = odd.select("doc_id", "text")
    label_rows = [(i, i % 2) for i in range(1, 9)] + [(None, 1), (3, None), (4, 7), (5, 1)]
    labels = spark.createDataFrame(label_rows, "doc_id long, toxic int")
    for given in (labels, labels.limit(0), labels.where("toxic = 0")):
        model = toxicity.fit(docs, given)
        rows = toxicity.scored(odd, model)
        assert rows.columns == [*odd.columns, "_score"]
        found = rows.collect()
        assert len(found) == odd.count() and all(0 <= r._score <= 1 for r in found)
        assert len({r._score for r in found if not (r.text or "").strip()}) == 1
        assert toxicity.without_toxic(odd, given).columns == odd.columns
    assert toxicity.scored(odd.limit(0), model).collect() == []


def test_windows_cover_text_without_spaces_and_short_words():
    text = "".join(chr(0x4E00 + i * 37 % 5000) for i in range(101))
    pieces = toxicity._split(f"ab {text} 12")
    assert pieces[0] == "ab" and pieces[-1] == "12" and set("".join(pieces[1:-1])) == set(text)
    scorer = toxicity.Scorer(toxicity.Model(b" some words of a dictionary ", b" other words in here "))
    bins = scorer.bins(["ab", "word", "12", "1234567"])
    assert bins[0] == bins[2] == bins[3] == toxicity._PLAIN and bins[1] != toxicity._PLAIN


def test_long_documents_stay_in_the_sample(spark):
    rows = [(i, f"w{i} " * (30_000 if i % 5 == 0 else 20)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    sample = {r.doc_id: r for r in toxicity.training_sample(docs, labels).collect()}
    expected = {i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert set(sample) == expected
    for i, r in sample.items():
        assert len(r.text) <= toxicity.SAMPLE_CHARS and abs(len(r.text) * r.longer - len(rows[i][1])) < 1
