"""Top-k against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import queries, topk


def brute(rows, asks, k):
    good = [
        (n, i, [math.floor(1024 * x) for x in v]) for n, (i, v) in enumerate(rows)
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, q in good:
        if asks(i):
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j, m) for m, j, v in good if m != n)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j, _) in enumerate(scored)]
    return sorted(out)


def test_index_keeps_all_members_and_stops_early():
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(4000, 24)) * rng.gamma(0.5, 200, size=(4000, 24))).astype(np.int64)
    index = topk.ImpactIndex(vectors)
    early = 0
    for n in range(40):
        maybe = index.possible(vectors[n], 10, np.array([n]))
        scores = vectors @ vectors[n]
        scores[n] = scores.min() - 1
        bar = np.sort(scores)[-10]
        assert set(np.flatnonzero(scores >= bar)) <= set(maybe) and n not in maybe
        early += len(maybe) < 1000
    assert early > 20


@pytest.mark.parametrize("block", [8192, 7])
def test_operator_is_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = random.Random(1)
    vector = lambda: [rng.choice([-0.5, 0.25, 0.0, rng.gauss(0, 1)]) for _ in range(6)]
    rows = [(i, vector()) for i in range(60)] + [(10, vector()), (None, vector()), (70, None), (71, []), (72, [1.0, None] + [0.0] * 4)]
    rows += [(73, [float("nan")] * 6), (74, [float("inf")] * 6), (80, rows[20][1]), (80, rows[20][1]), (81, [0.5, -0.5])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, 5).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, lambda i: i % 10 == 0, 5)
    few = topk.top_k(df.filter("vec_id < 3"), F.col("vec_id") == 0, 5).collect()
    assert len(few) == 2 and topk.top_k(df.filter("vec_id < 0"), F.lit(True), 5).count() == 0


def test_query_is_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    ids, vectors = np.array([r[0] for r in rows]), np.floor(1024 * np.array([r[1] for r in rows])).astype(np.int64)
    want = []
    for n in np.flatnonzero(ids % 100 == 0):
        scores = vectors @ vectors[n]
        order = [m for m in np.lexsort((ids, -scores)) if m != n][:10]
        want += [(int(ids[n]), r + 1, int(ids[m]), int(scores[m])) for r, m in enumerate(order)]
    assert sorted(tuple(r) for r in queries.all_queries()["op3_top_k"](spark, folder).collect()) == sorted(want)


def test_components_out_of_range_raise(spark):
    df = spark.createDataFrame([(1, [3e6, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="out of range"):
        topk.top_k(df, F.lit(True)).collect()
