"""Hard negatives and their intervals against brute force."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mercato.llm import negatives, onebit, queries

KIND = "vec_id long, embedding array<float>, label int, row string, block string, score string"


def brute(rows):
    """Rows (id, vector or None, label) in order -> sorted result."""
    kept = []
    for i, v, label in rows:
        if label is None or v is None or None in v or not np.isfinite(np.array(v, float)).all():
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        kept.append((i, np.floor(256 * np.array(v, float)).astype(np.int64), label))
    out = []
    for a, (i, x, label) in enumerate(kept):
        if i is None or i % 100:
            continue
        scored = sorted(((-int(x @ y), j is None, j or 0, b, other) for b, (j, y, other) in enumerate(kept) if b != a))
        near = [s for s in scored if s[4] == label][:5]
        for s in near:
            top = -s[0]
            band = [n for n in scored if n[4] != label and 80 * top <= -100 * n[0] <= 100 * top][:5]
            for rank, n in enumerate(band, 1):
                out.append((i, None if s[1] else s[2], rank, None if n[1] else n[2], top, -n[0]))
    return sorted(out, key=str)


def test_query_against_brute_force(spark):
    for sf in ("0.001", "0.1"):
        folder = f"/root/testdata/sf{sf}"
        rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
        got = queries.all_queries()["op13_hard_negatives"](spark, folder)
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def run(spark, rows):
    frame = spark.createDataFrame([(i, v, label, "a", "b", "c") for i, v, label in rows], KIND)
    return sorted(map(tuple, queries.mine(frame).collect()), key=str)


@pytest.mark.parametrize("size", [8192, 40])
def test_odd_rows_and_several_blocks(spark, monkeypatch, size):
    monkeypatch.setattr(negatives, "BLOCK", size)
    draw = np.random.default_rng(2)
    rows = [(i, [float(np.float32(v)) for v in draw.normal(size=5)], int(draw.integers(3))) for i in range(0, 900, 5)]
    rows += [(100, rows[0][1], 1)] * 3 + [(7, rows[3][1], 2)] * 20  # ties, repeated rows
    rows += [(200, None, 1), (300, [1.0, None, 0.0, 0.0, 0.0], 1), (400, [float("nan")] * 5, 1), (500, rows[1][1], None)]
    rows += [(1000, [0.0] * 5, 1), (1100, [-1.0] * 5, 0)]
    assert run(spark, rows) == brute(rows)


def test_null_ids_short_vectors_and_no_rows(spark):
    assert run(spark, []) == [] and run(spark, [(1, [1.0], 1)]) == [] and run(spark, [(100, [], 1), (2, [], 1)]) == []
    got = run(spark, [(100, [1.0, 1.0], 1), (None, [1.0, 0.5], 1), (None, [1.0], 2), (3, [1.25, 0.25], 2)])
    assert got == sorted([(100, None, 1, 3, 98304, 98304)], key=str)


def test_out_of_range_raises(spark):
    with pytest.raises(Exception, match="out of range"):
        run(spark, [(100, [1e9], 1)])


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 130), st.integers(0, 2 ** 32 - 1), st.sampled_from([1, 300, 10 ** 6]))
def test_intervals_hold(wide, seed, size):
    draw = np.random.default_rng(seed)
    vectors = np.floor(draw.normal(size=(50, wide)) * size).astype(np.int64)
    vectors[3] = 0
    words, alignments = onebit.encode(vectors.astype(float))
    codes = onebit.Codes(words, alignments, np.linalg.norm(vectors.astype(float), axis=1))
    for vector in (vectors[0], -vectors[1], vectors[3], draw.integers(-size, size + 1, wide)):
        query, estimate, wider = onebit.Query(vector), np.zeros(50), np.inf
        for level in range(onebit.LEVELS):
            estimate, low, high = codes.narrow(query, np.arange(50), level, estimate)
            exact = vectors @ vector
            assert (low <= exact).all() and (exact <= high).all()
            assert (high - low).mean() < wider
            wider = (high - low).mean() + 1e-6


def test_intervals_leave_few_rows():
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(4000, 64))
    vectors = np.floor(256 * vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.int64)
    words, alignments = onebit.encode(vectors.astype(float))
    codes = onebit.Codes(words, alignments, np.linalg.norm(vectors.astype(float), axis=1))
    rows, estimate, query = np.arange(4000), np.zeros(4000), onebit.Query(vectors[0])
    bar = np.sort(vectors @ vectors[0])[-6]
    for level in range(onebit.LEVELS):
        estimate, low, high = codes.narrow(query, rows, level, estimate)
        rows, estimate = rows[high >= bar], estimate[high >= bar]
    assert len(rows) < 400


def test_plan_has_no_pairs(spark):
    plan = queries.all_queries()["op13_hard_negatives"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("size", [300, 10 ** 6])
def test_intervals_do_not_widen_where_nothing_is_left(size):
    """Two signs say all of a vector of two entries; later levels code what rounding leaves."""
    for seed in range(20):
        draw = np.random.default_rng(seed)
        vectors = np.floor(draw.normal(size=(50, 2)) * size).astype(np.int64)
        words, alignments = onebit.encode(vectors.astype(float))
        codes = onebit.Codes(words, alignments, np.linalg.norm(vectors.astype(float), axis=1))
        query, estimate, wider = onebit.Query(vectors[0]), np.zeros(50), np.inf
        for level in range(onebit.LEVELS):
            estimate, low, high = codes.narrow(query, np.arange(50), level, estimate)
            assert (low <= vectors @ vectors[0]).all() and (vectors @ vectors[0] <= high).all()
            assert (high - low).mean() <= wider + 1e-6
            wider = (high - low).mean()
