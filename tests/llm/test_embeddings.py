from __future__ import annotations

import numpy as np
import pytest

from netpulse.llm import embeddings
from netpulse.llm.queries import op3_embeddings

from .conftest import SMALL
from .test_simhash import components


def brute(rows, least=0.93):
    good = {}
    for r in rows:
        v = None if r.embedding is None or any(x is None for x in r.embedding) else np.array(r.embedding, float)
        if r.vec_id is not None and r.label is not None and v is not None and len(v) and np.isfinite(v).all() and v.any():
            good[r.vec_id] = (r.label, v / np.linalg.norm(v))
    near = lambda a, b: good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= least
    links = {a: sum(near(a, b) for b in good if b != a) for a in good}
    least_of = components({a: {a} for a in good}, near)
    out = []
    for r in rows:
        c = least_of.get(r.vec_id, r.vec_id)
        out.append((r.vec_id, links.get(r.vec_id, 0), c, r.vec_id is not None and c == r.vec_id))
    return sorted(out, key=str)


def test_query_against_brute_force(spark, tables):
    assert sorted(map(tuple, op3_embeddings(spark, SMALL).collect()), key=str) == brute(tables("embeddings").collect())


@pytest.mark.parametrize("block", [7, 64])
def test_small_blocks_and_close_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "LEAF", 4)
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(6, 16))
    rows = []
    for i in range(300):
        v = centers[i % 6] + rng.normal(size=16) * 0.25
        rows.append((i, v.astype("f4").tolist(), i % 2))
    rows += [(300 + i, rows[3][1], rows[3][2]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    assert sorted(map(tuple, embeddings.near_duplicate_vectors(df).collect()), key=str) == brute(df.collect())


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1),
        (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (11, [1.0, -0.0], 1),
        (12, [1.0, 0.0], 2),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "'x' as width", "1 as copies")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicate_vectors(df).collect()}
    assert found[1] == (2, 1, True) and found[2] == (2, 1, False) and found[11] == (2, 1, False)
    for alone in (3, 4, 5, 6, 7, 8, 9, 10, 12):
        assert found[alone] == (0, alone, True)
    assert found[None] == (0, None, False)


def test_no_rows(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embeddings.near_duplicate_vectors(df).collect() == []
