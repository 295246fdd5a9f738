import random

import pytest

from mercato.operators.upsert import (
    DuplicateKeyError,
    merge_into,
    merge_report,
    merge_reports,
    upsert,
    upsert_full_row,
    with_action,
)
from mercato.schemas import TABLES, TableSpec
from mercato.sources.tables import MergedTable
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = "k long, v string"
SPEC = TableSpec("kv", "kv", T.StructType([
    T.StructField("k", T.LongType()), T.StructField("v", T.StringType())]), ("k",))


def test_update_may_set_null_and_absent_rows_stay(spark, rows):
    target = spark.createDataFrame([(1, "x"), (2, "y")], SCHEMA)
    batch = spark.createDataFrame([(1, None), (3, "z")], SCHEMA)
    assert rows(upsert(target, batch, ["k"])) == [(1, None), (2, "y"), (3, "z")]


def test_repeated_key_in_batch_raises(spark):
    target = spark.createDataFrame([], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        upsert(target, spark.createDataFrame([(1, "a"), (1, "b")], SCHEMA), ["k"])


@pytest.mark.parametrize("seed", range(3))
def test_upsert_equals_dict_update_and_is_idempotent(spark, rows, seed):
    rng = random.Random(seed)
    old = {rng.randrange(30): rng.choice("abc") for _ in range(20)}
    new = {rng.randrange(30): rng.choice(["p", "q", None]) for _ in range(20)}
    target = spark.createDataFrame(list(old.items()), SCHEMA)
    batch = spark.createDataFrame(list(new.items()), SCHEMA)
    once = upsert(target, batch, ["k"])
    assert rows(once) == sorted({**old, **new}.items(), key=str)
    assert rows(upsert(once, batch, ["k"])) == rows(once)
    actions = {r["k"]: r["_action"] for r in with_action(target, batch, ["k"]).collect()}
    assert actions == {k: "update" if k in old else "insert" for k in new}


def test_full_row_rerun_inserts_nothing(spark, rows):
    empty = spark.createDataFrame([], SCHEMA)
    batch = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], SCHEMA)
    first = upsert_full_row(empty, batch)
    assert rows(first) == [(1, "a"), (1, "a"), (2, "b")]
    assert rows(upsert_full_row(first, batch)) == rows(first)


def test_merge_into_creates_the_table_and_skips_replays(spark, tmp_path, rows):
    table = MergedTable(spark, str(tmp_path / "kv"), SPEC, buckets=8)
    first = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    assert merge_into(table, first, "w", 0) == (1, 2, 2, 0)
    assert merge_into(table, spark.createDataFrame([(2, "B"), (3, "c")], SCHEMA), "w", 1) == (2, 2, 1, 1)
    assert merge_into(table, first, "w", 1) == (2, 0, 0, 0)
    assert merge_into(table, first.limit(0), "w", 2) == (3, 0, 0, 0)
    assert rows(table.read()) == [(1, "a"), (2, "B"), (3, "c")]


def test_failed_merge_leaves_the_table(spark, tmp_path, rows):
    table = MergedTable(spark, str(tmp_path / "kv"), SPEC, buckets=8)
    merge_into(table, spark.createDataFrame([(1, "a")], SCHEMA))
    with pytest.raises(DuplicateKeyError):
        merge_into(table, spark.createDataFrame([(2, "b"), (2, "c")], SCHEMA))
    assert rows(table.read()) == [(1, "a")] and table.version == 1


def test_report_counts(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    batch = spark.createDataFrame([(2, "x"), (3, "y"), (4, "z")], SCHEMA)
    row = merge_report(target, batch, SPEC).collect()[0]
    assert tuple(row) == ("kv", 3, 2, 1, 3)
    nothing = merge_report(target, batch.limit(0), SPEC).collect()[0]
    assert tuple(nothing) == ("kv", 0, 0, 0, 0)


def test_full_row_report_has_no_updates(spark, small):
    m = small(spark)
    places = m.raw["geolocation_raw"]
    row = merge_report(places, places, TABLES["geolocation_raw"]).collect()[0]
    assert row["rows_inserted"] == row["rows_updated"] == row["rows_merged"] == 0
    assert row["rows_staged"] == places.count()


def test_hot_full_row_stays_whole(spark):
    """A third of target and batch are copies of one row; none is lost and none is doubled."""
    target = spark.createDataFrame([(0, "hot")] * 300 + [(i, "t") for i in range(600)], SCHEMA)
    batch = spark.createDataFrame([(0, "hot")] * 300 + [(1, "new")] * 300, SCHEMA)
    merged = upsert_full_row(target, batch)
    counts = {(r["k"], r["v"]): r["count"] for r in merged.groupBy("k", "v").count().collect()}
    assert counts[(0, "hot")] == 300 and counts[(1, "new")] == 300 and merged.count() == 1200


def _times(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("part-*.parquet")}


def test_a_keyed_merge_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "kv"), SPEC, buckets=8)
    names = SPEC.schema.names
    many = spark.range(2000).select(F.col("id").cast(SPEC.schema[0].dataType).alias(names[0]), F.lit("a").alias(names[1]))
    assert merge_into(table, many) == (1, 2000, 2000, 0)
    before = _times(tmp_path)
    assert len({p.parent for p in before}) == 8
    assert merge_into(table, spark.createDataFrame([(5, "new"), (5000, "more")], SPEC.schema)) == (2, 2, 1, 1)
    after = _times(tmp_path)
    assert 1 <= len(before.items() - after.items()) <= 2
    got = {r[0]: r[1] for r in table.read().collect()}
    assert len(got) == 2001 and got[5] == "new" and got[5000] == "more" and got[6] == "a"


def test_a_full_row_merge_adds_a_folder(spark, tmp_path):
    spec = TABLES["geolocation_raw"]
    table = MergedTable(spark, str(tmp_path / "geo"), spec)
    row = lambda i: (i, 1.0 * i, 2.0, "c", "S")
    merge_into(table, spark.createDataFrame([row(i) for i in range(100)], spec.schema).repartition(4))
    before = _times(tmp_path)
    assert merge_into(table, spark.createDataFrame([row(5), row(500), row(500)], spec.schema)) == (2, 3, 2, 0)
    assert before.items() < _times(tmp_path).items() and table.read().count() == 102
    assert merge_into(table, spark.createDataFrame([row(5), row(500)], spec.schema)) == (3, 2, 0, 0)


@pytest.mark.parametrize("name", ["orders", "geolocation_raw"])
def test_a_merge_whose_pointer_failed_is_repeated(spark, tmp_path, small, rows, monkeypatch, name):
    m, spec = small(spark), TABLES[name]
    table = MergedTable(spark, str(tmp_path / name), spec, buckets=4)
    merge_into(table, m.raw[name], "w", 0)
    batch = m.adapter("orders_v2" if name == "orders" else "geolocation_v2")
    with monkeypatch.context() as broken:
        broken.setattr(table, "count_up", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            merge_into(table, batch, "w", 1)
    assert merge_into(table, batch, "w", 1).version == 2
    wanted = upsert(m.raw[name], batch, list(spec.keys)) if spec.keys else upsert_full_row(m.raw[name], batch)
    assert rows(table.read()) == rows(wanted.select(*spec.columns))


def test_counts_come_from_the_write(spark, tmp_path):
    """Beside the write: the batch's own files, the touched buckets, and footers. No join recounts what was merged."""
    table = MergedTable(spark, str(tmp_path / "kv"), SPEC, buckets=4)
    batch = spark.createDataFrame([(i, "a") for i in range(100)], SCHEMA)
    merge_into(table, batch)
    report = merge_reports(spark, {"kv": merge_into(table, spark.createDataFrame([(i, "b") for i in range(90, 130)], SCHEMA))})
    assert tuple(report.collect()[0]) == ("kv", 40, 30, 10, 40)
    assert "Scan parquet" not in report._jdf.queryExecution().executedPlan().toString()
