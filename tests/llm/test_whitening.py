"""Whitening against NumPy's eigenvectors and exact integers."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.llm import eigen, queries, whitening

SF = "/root/testdata/sf0.01"


def check_leading(matrix, wanted=4):
    values, vectors = eigen.leading(matrix, wanted)
    expected = np.linalg.eigvalsh(matrix)[::-1][:wanted]
    size = max(np.abs(matrix).max(initial=0), 1e-300)
    assert values == pytest.approx(expected, rel=1e-12, abs=1e-12 * size * len(matrix))
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max(initial=0) < 1e-10
    assert np.abs(vectors @ matrix - values[:, None] * vectors).max(initial=0) < 1e-11 * size * max(1, len(matrix))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 24), st.integers(0, 2 ** 32 - 1), st.integers(1, 24))
def test_leading_eigenvectors(size, seed, rank):
    x = np.random.default_rng(seed).standard_normal((size, min(rank, size)))
    check_leading(x @ x.T)


def test_repeated_and_zero_eigenvalues():
    turn = np.linalg.qr(np.random.default_rng(3).standard_normal((12, 12)))[0]
    for values in ([5] * 12, [7, 7, 7, 7, 7, 7, 1, 1, 1, 0, 0, 0], [9, 9 - 1e-9, 9 - 2e-9, 3] + [0] * 8, [1e12, 1, 1, 1] + [1e-9] * 8):
        check_leading((turn * values) @ turn.T)
        check_leading(np.diag(np.array(values, float)))
    check_leading(np.zeros((5, 5)))
    check_leading(np.diag([0.0, 2.0]))


def brute(rows):
    """(id, component) -> deviation, whitened up to sign, explained."""
    x = [(i, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, v in rows
         if v is not None and None not in v and np.isfinite(np.array(v, float)).all()]
    kinds = np.unique(np.array([v for _, v in x]), axis=0)
    sums, n = kinds.sum(axis=0), len(kinds)
    centred = kinds - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, v in x:
        deviation = sum(int(d) ** 2 for d in n * v.astype(object) - sums)
        for c in range(4):
            out.append((i, c + 1, n, deviation, (v - sums / n) @ vectors[:, c] / np.sqrt(values[c]), values[c] / values.sum()))
    return out


def compare(got, wanted):
    got = sorted(got, key=lambda r: (r["component"], r["vec_id"], r["whitened"] ** 2))
    wanted = sorted(wanted, key=lambda r: (r[1], r[0], r[4] ** 2))
    signs = {}
    for row, (i, component, n, deviation, whitened, explained) in zip(got, wanted, strict=True):
        assert (row["vec_id"], row["component"], row["n"], row["deviation"]) == (i, component, n, deviation)
        if abs(whitened) > 1e-3:
            signs.setdefault(component, np.sign(whitened * row["whitened"]))
        assert row["whitened"] * signs.get(component, 1) == pytest.approx(whitened, abs=1e-6)
        assert row["explained"] == pytest.approx(explained, rel=1e-9) and row["identity_error"] < 1e-9


def test_query_against_numpy(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compare(queries.all_queries()["op11_whitening"](spark, SF).collect(), brute(rows))


KIND = "vec_id long, embedding array<float>, whitened double, x string, row int"


def test_odd_rows(spark):
    draw = np.random.default_rng(5)
    rows = [(i, [float(v) for v in draw.normal(size=6).astype(np.float32)]) for i in range(40)]
    rows += [(100, rows[0][1])] * 30 + [(101, None), (102, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (103, [float("nan")] * 6), (104, [float("inf")] * 6)]
    given = spark.createDataFrame([(i, v, 1.0, "x", 2) for i, v in rows], KIND)
    compare(whitening.whiten(given).collect(), brute(rows))


def test_few_directions_and_no_rows(spark):
    def run(vectors):
        return whitening.whiten(spark.createDataFrame([(i, v, 0.0, "", 0) for i, v in enumerate(vectors)], KIND)).collect()

    assert run([]) == [] and run([[]]) == [] and run([[1.0, 2.0]]) == [] and run([None]) == []
    flat = run([[1.0, 2.0], [3.0, 4.0], [5.0, 6.0], [1.0, 2.0]])
    assert {r["component"] for r in flat} == {1} and len(flat) == 4 and flat[0]["explained"] == pytest.approx(1)
    short = run([[1.0], [3.0, 4.0], []])
    assert {r["n"] for r in short} == {3} and {r["component"] for r in short} == {1, 2}


def test_out_of_range_raises(spark):
    given = spark.createDataFrame([(1, [1e30], 0.0, "", 0)], KIND)
    with pytest.raises(Exception, match="out of range"):
        whitening.whiten(given).collect()


def test_exact_deviations():
    big = np.array([[2 ** 30, -(2 ** 30)]])
    sums = np.array([5, 7])
    assert whitening.deviations(big, 3, sums) == [(3 * 2 ** 30 - 5) ** 2 + (3 * 2 ** 30 + 7) ** 2]
    with pytest.raises(OverflowError):
        import pyarrow as pa

        pa.array(whitening.deviations(big, 1000, sums), pa.int64())


def test_null_ids_stay(spark):
    given = spark.createDataFrame([(None, [1.0, 0.0], 0.0, "", 0), (1, [0.0, 3.0], 0.0, "", 0)], KIND)
    assert {r["vec_id"] for r in whitening.whiten(given).collect()} == {None, 1}
    assert whitening.whiten(given).filter(F.col("vec_id").isNull()).count() == 1
