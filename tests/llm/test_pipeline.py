from __future__ import annotations

import public_tokenizers

import corpus_pipeline
from netpulse.llm import bpe, queries

from .conftest import SMALL


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), f"test-{name}")
        counts.append(docs.count())
        if name != "bpe":
            assert docs.columns == columns
    assert counts[1] <= counts[0] and counts[2] < counts[1] and counts[3] == counts[2] and counts[5] == counts[4]
    rows = docs.collect()
    assert all(r.round_trip for r in rows) and len({r.doc_id for r in rows}) <= counts[3]
    words = bpe.vocabulary(public_tokenizers.path(queries.VOCABULARY))
    assert all(words.decode(bytes(r.ids)).decode() == (r.text or "") for r in rows)


def test_run_equals_its_stages_and_odd_rows_pass(spark, odd, folder):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    where = folder("documents", odd.select(*names))
    folder("labels", spark.createDataFrame([(1, 1, 0), (7, 1, 1), (8, 0, 0)], "doc_id long, quality int, toxic int"))
    rows = corpus_pipeline.run(spark, where).collect()
    assert all(r.round_trip for r in rows)
    folder("documents", odd.select(*names).limit(0))
    assert corpus_pipeline.run(spark, where).collect() == []


def test_every_query_is_registered():
    import __spark_entry__

    found = __spark_entry__.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(found)
