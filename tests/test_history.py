from datetime import datetime

import pytest
from pyspark.sql import functions as F

from mercato.operators.history import bucketed_sides, dim_scd2, first_snapshot, pit_join, pit_join_bucketed, snapshot_check
from mercato.operators.upsert import DuplicateKeyError

T1, T2, T3 = datetime(2020, 1, 1), datetime(2020, 2, 1), datetime(2020, 3, 1)
SELLERS = "id string, zip long, city string"


@pytest.fixture
def two_runs(spark):
    run1 = spark.createDataFrame([("same", 1, "a"), ("moved", 2, "b"), ("gone", 3, "c"), ("named", 4, None)], SELLERS)
    run2 = spark.createDataFrame([("same", 1, "a"), ("moved", 9, "b"), ("new", 5, "e"), ("named", 4, "x")], SELLERS)
    first = snapshot_check(None, run1, "id", ["zip", "city"], T1)
    return first, run2, snapshot_check(first, run2, "id", ["zip", "city"], T2)


def test_snapshot_cases(two_runs, rows):
    first, _, second = two_runs
    assert first.count() == 4
    assert rows(second) == sorted([
        ("same", 1, "a", T1, None),
        ("moved", 2, "b", T1, T2), ("moved", 9, "b", T2, None),
        ("gone", 3, "c", T1, None),
        ("new", 5, "e", T2, None),
        ("named", 4, None, T1, T2), ("named", 4, "x", T2, None),
    ], key=str)


def test_same_source_changes_nothing(two_runs, rows):
    _, run2, second = two_runs
    assert rows(snapshot_check(second, run2, "id", ["zip", "city"], T3)) == rows(second)


def test_unwatched_column_is_no_change(two_runs, rows):
    first, run2, _ = two_runs
    by_zip = snapshot_check(first, run2, "id", ["zip"], T2)
    assert rows(by_zip.filter("id = 'named'")) == [("named", 4, None, T1, None)]


def test_one_open_row_and_no_overlap(two_runs):
    dim = dim_scd2(two_runs[2])
    assert dim.filter("is_current").groupBy("id").count().filter("count <> 1").count() == 0
    a, b = dim.alias("a"), dim.alias("b")
    overlap = a.join(b, (F.col("a.id") == F.col("b.id")) & (F.col("a.valid_from") < F.col("b.valid_from"))
                     & (F.coalesce("a.valid_to", F.lit(datetime(9999, 1, 1)).cast("timestamp_ntz")) > F.col("b.valid_from")))
    assert overlap.count() == 0


def test_repeated_source_key_raises(spark, two_runs):
    twice = spark.createDataFrame([("same", 1, "a"), ("same", 2, "a")], SELLERS)
    with pytest.raises(DuplicateKeyError):
        snapshot_check(two_runs[0], twice, "id", ["zip"], T2)


FACTS = [("moved", "2020-01-15"), ("moved", "2020-02-01"), ("moved", "2020-02-15"), ("moved", "2019-06-01"), ("none", "2020-01-15")]


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(FACTS, "id string, day string").select("id", F.col("day").cast("timestamp_ntz").alias("ts"))


@pytest.mark.parametrize("options,expected", [
    ({}, [("2020-01-15", 2), ("2020-02-01", 2), ("2020-02-01", 9), ("2020-02-15", 9)]),
    ({"closed": "left"}, [("2020-01-15", 2), ("2020-02-01", 9), ("2020-02-15", 9)]),
    ({"closed": "left", "backfill_first": True},
     [("2019-06-01", 2), ("2020-01-15", 2), ("2020-02-01", 9), ("2020-02-15", 9)]),
    ({"closed": "left", "how": "left"},
     [("2019-06-01", None), ("2020-01-15", 2), ("2020-01-15", None), ("2020-02-01", 9), ("2020-02-15", 9)]),
])
def test_point_in_time(facts, two_runs, rows, options, expected):
    got = pit_join(facts, two_runs[2], "id", "ts", **options)
    assert rows(got.select(F.date_format("ts", "yyyy-MM-dd"), "zip")) == sorted(expected, key=str)


@pytest.fixture
def many_versions(spark):
    """Keys with one to 300 versions, changing hourly, daily or all at once, with gaps; facts before, between and after."""
    at = "TIMESTAMP_NTZ'2020-01-01 00:00:00'"
    dim = spark.range(0, 900).selectExpr(
        "CASE WHEN id < 300 THEN 'hourly' WHEN id < 600 THEN 'daily' WHEN id < 880 THEN 'at once' ELSE concat('few', id % 5) END AS k",
        "id AS version",
        f"""CASE WHEN id < 300 THEN {at} + make_dt_interval(0, id) WHEN id < 600 THEN {at} + make_dt_interval(id - 300)
             WHEN id < 880 THEN {at} + make_dt_interval(0, 0, 0, (id - 600) / 1000) ELSE {at} + make_dt_interval(id) END AS valid_from""")
    dim = dim.selectExpr("*", """CASE WHEN version % 50 = 49 THEN NULL WHEN version % 7 = 3 THEN valid_from
        ELSE valid_from + make_dt_interval(0, version % 30) END AS valid_to""")
    fact = spark.range(0, 3000).selectExpr(
        "element_at(array('hourly', 'daily', 'at once', 'few1', 'few2', 'unknown', NULL), CAST(id % 7 + 1 AS INT)) AS k",
        "id AS fact", f"CASE WHEN id % 11 = 5 THEN NULL ELSE {at} + make_dt_interval(-3, 0, id * 17) END AS ts")
    return fact, dim


@pytest.mark.parametrize("options", [
    {}, {"closed": "left"}, {"how": "left"}, {"closed": "left", "backfill_first": True, "how": "left"}])
def test_buckets_change_no_row(many_versions, rows, options):
    fact, dim = many_versions
    got = rows(pit_join_bucketed(fact, dim, "k", "ts", **options))
    assert got == rows(pit_join(fact, dim, "k", "ts", **options)) and len(got) > 1000


def test_no_versions_and_no_facts(many_versions):
    fact, dim = many_versions
    assert pit_join_bucketed(fact, dim.limit(0), "k", "ts").count() == 0
    assert pit_join_bucketed(fact, dim.limit(0), "k", "ts", how="left").count() == 3000
    assert pit_join_bucketed(fact.limit(0), dim, "k", "ts").count() == 0


@pytest.mark.parametrize("versions", [200, 2000])
def test_rows_compared_grow_with_the_facts(spark, versions):
    at = "TIMESTAMP_NTZ'2020-01-01 00:00:00'"
    dim = spark.range(0, versions).selectExpr(
        "'hot' AS k", "id", f"{at} + make_dt_interval(0, id) AS valid_from", f"{at} + make_dt_interval(0, id + 1) AS valid_to")
    fact = spark.range(0, 4000).selectExpr("'hot' AS k", f"{at} + make_dt_interval(0, 0, id * {versions * 60} div 4000) AS ts")
    facts, placed = bucketed_sides(fact, dim, "k", "ts")
    assert placed.count() <= 3 * versions and facts.count() == 4000
    assert facts.join(placed, ["k", "_bucket"]).count() <= 4 * 4000


def test_keys_that_change_alike_share_their_buckets(spark):
    """Neither side is sent to its key to learn its buckets, and three versions are placed for two; a hot key has its own."""
    at = "TIMESTAMP_NTZ'2020-01-01 00:00:00'"
    hours = "CASE WHEN k < 40 THEN n * 10 ELSE n END"
    dim = spark.sql(f"""SELECT k, n, {at} + make_dt_interval(0, {hours}) AS valid_from,
            CASE WHEN n < 29 OR k = 40 THEN {at} + make_dt_interval(0, {hours} + CASE WHEN k < 40 THEN 10 ELSE 1 END) END AS valid_to
        FROM (SELECT explode(sequence(0, 40)) AS k) LATERAL VIEW explode(sequence(0, CASE WHEN k < 40 THEN 29 ELSE 299 END)) AS n""")
    fact = spark.range(0, 8200).selectExpr("id % 41 AS k", f"{at} + make_dt_interval(0, 0, id * 2) AS ts")
    facts, placed = bucketed_sides(fact, dim, "k", "ts")
    assert placed.filter("k < 40").count() <= 1.6 * 1200 and placed.filter("k = 40").count() <= 2 * 300
    met = facts.join(placed, ["k", "_bucket"])
    assert met.filter("k < 40").count() <= 5 * 8000 and met.filter("k = 40").count() <= 4 * 200
    assert facts.filter("k < 40").select("_bucket").distinct().count() > 5
    assert pit_join_bucketed(fact, dim, "k", "ts").count() == pit_join(fact, dim, "k", "ts").count() > 8000


def test_unknown_interval_kind(facts, two_runs):
    with pytest.raises(ValueError):
        pit_join(facts, two_runs[2], "id", "ts", closed="right")


def test_known_answers(spark, small):
    m = small(spark, "0.01")
    history = m.sellers_history
    assert history.count() == 124 and history.filter("valid_to IS NULL").count() == 101
    items = m.raw["order_items"]
    assert pit_join(items, history, "seller_id", "shipping_limit_date").count() == 33524
    assert pit_join(items, history, "seller_id", "shipping_limit_date", closed="left").count() == 33514
    assert pit_join(items, history, "seller_id", "shipping_limit_date", closed="left", backfill_first=True).count() == 60000


def test_first_snapshot_is_open(spark):
    row = first_snapshot(spark.createDataFrame([("a", 1, "x")], SELLERS), T1).collect()[0]
    assert (row["valid_from"], row["valid_to"]) == (T1, None)
