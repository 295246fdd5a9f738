"""Joins on a hot key are split at run time, or stand on grouped rows."""

import pytest
from pyspark.sql import functions as F

from mercato.operators import history, quality, upsert
from mercato.session import materialise
from mercato.streaming import ingest
from mercato.schemas import TABLES

LOW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def low(spark):
    before = {k: spark.conf.get(k, None) for k in LOW}
    for k, v in LOW.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    plan = df._jdf.queryExecution()
    df.write.format("noop").mode("overwrite").save()
    out = df.select("*")
    out.collect()
    return out._jdf.queryExecution().executedPlan().toString()


def hot(spark, rows=40_000):
    """80 in 100 rows hold key 0."""
    return spark.range(0, rows, 1, 16).select(
        "id", F.when(F.col("id") % 5 == 0, F.col("id")).otherwise(F.lit(0)).alias("k"),
        F.concat(F.lit("text "), F.sha2(F.col("id").cast("string"), 256)).alias("wide"),
        F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("at"))


def test_point_in_time_with_backfill(low):
    dim = low.range(0, 40_000, 5).select(
        F.col("id").alias("k"), F.lit("2019-01-01 00:00:00").cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.sha2(F.col("id").cast("string"), 256).alias("name"))
    fact = materialise(hot(low), "fact")
    joined = history.pit_join(fact, materialise(dim, "dim"), "k", "at", backfill_first=True)
    assert "SortMergeJoin(skew=true)" in final_plan(joined)


def test_foreign_keys(low):
    parents = low.range(1, 40_000).select(F.col("id").alias("k"))
    marked = quality.with_violations(materialise(hot(low), "child"), {}, foreign={"k": (parents, "k")})
    assert "SortMergeJoin(skew=true)" in final_plan(marked)
    assert marked.filter(F.size("_violations") > 0).count() == 32_001


def test_repeated_keys(low):
    marked = quality.with_violations(materialise(hot(low), "batch"), {}, unique=["k"])
    assert "SortMergeJoin(skew=true)" in final_plan(marked)
    assert marked.filter(F.size("_violations") > 0).count() == 32_001


def test_orphan_categories(low):
    products = materialise(hot(low).select(
        F.col("id").alias("product_id"), F.col("k").cast("string").alias("product_category_name"), "wide"), "products")
    known = low.range(1, 40_000).select(F.col("id").cast("string").alias("product_category_name"))
    from datetime import datetime

    assert "SortMergeJoin(skew=true)" in final_plan(quality.orphan_category_log(products, known, datetime(2024, 1, 1)))


def test_full_rows(low):
    # copies of one row compress well, so there are many of them and few others
    same = low.range(0, 400_200, 1, 16).select(
        F.when(F.col("id") < 400_000, F.lit(0)).otherwise(F.col("id")).alias("k"), F.lit("x").alias("wide"))
    same = materialise(same, "batch")
    target = materialise(same.filter("k = 0").limit(5), "target")
    assert "SortMergeJoin(skew=true)" in final_plan(upsert.new_rows(target, same))


def test_first_arrivals(low):
    spec = TABLES["geolocation_raw"]
    rows = hot(low).select(
        F.col("k").cast(spec.schema[0].dataType).alias(spec.columns[0]), F.lit(1.0).alias(spec.columns[1]),
        F.lit(1.0).alias(spec.columns[2]), F.when(F.col("k") == 0, "x").otherwise(F.col("wide")).alias(spec.columns[3]),
        F.lit("s").alias(spec.columns[4]), F.struct(F.col("at"), F.lit("f").alias("file")).alias(ingest.ARRIVED))
    assert "SortMergeJoin(skew=true)" in final_plan(ingest.collapse_files(materialise(rows, "arrived"), spec))
