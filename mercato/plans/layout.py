"""Stored layouts of the facts: bucketed by order, so that joins on it need no shuffle, or by month, so that dates prune."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions.frames import union_all
from mercato.operators.filters import MONTH

BUCKET_ROWS = 1 << 20  # of a fact, in a bucket: some 70 MB of order lines
NO_MONTH = "0001-01-01"
FACTS = ("fct_orders", "fct_order_items", "fct_order_payments", "fct_order_reviews")


def store_bucketed(marts: Mapping[str, DataFrame], database: str, root: str, buckets: int) -> dict[str, DataFrame]:
    """Write the facts of ``marts`` as tables of ``database``, bucketed and sorted by ``order_id``; read them back.

    All have the same number of buckets, so orders meet their items, payments and reviews bucket by bucket: a join reads
    both sides in place, without a shuffle or a sort. There are ``buckets`` of them, or as many more as keep a bucket of the
    largest fact at ``BUCKET_ROWS`` rows in the mean, so that it fits a task at any size; the facts' rows are counted for
    that first. One order's rows share a bucket, and no order is large. Files are one per bucket: rows are dealt by order first.
    """
    spark = next(iter(marts.values())).sparkSession
    counts = union_all([marts[name].groupBy().count() for name in FACTS if name in marts])
    buckets = max(buckets, -(-counts.agg(F.max("count")).collect()[0][0] // BUCKET_ROWS))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in FACTS:
        if name in marts:
            (marts[name].repartition(buckets, "order_id").write.mode("overwrite").bucketBy(buckets, "order_id")
             .sortBy("order_id").option("path", f"{root.rstrip('/')}/{name}").saveAsTable(f"{database}.{name}"))
    return read_bucketed(spark, database, [name for name in FACTS if name in marts])


def read_bucketed(spark: SparkSession, database: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.table(f"{database}.{name}") for name in names}


def store_by_month(marts: Mapping[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Write the facts of ``marts`` in folders by the month of their order's purchase; read them back.

    Items, payments and reviews carry no order date, so they take the month from their order. The loaders join on order
    and month, and a date filter says its months (``filters``), so both sides of a join read the folders of these months
    alone. Rows of an unknown order or date share the folder of ``NO_MONTH``, and stay in results that filter no date.
    Months differ in size, and are dealt to tasks and files by size.
    """
    orders = marts["fct_orders"].withColumn(MONTH, F.coalesce(F.trunc("order_purchase_date", "month"), F.to_date(F.lit(NO_MONTH))))
    months = orders.select("order_id", MONTH)
    for name in FACTS:
        if name in marts:
            dated = orders if name == "fct_orders" else marts[name].join(months, "order_id", "left").withColumn(
                MONTH, F.coalesce(MONTH, F.to_date(F.lit(NO_MONTH))))
            dated.hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH).parquet(f"{root.rstrip('/')}/{name}")
    spark = orders.sparkSession
    return {name: spark.read.parquet(f"{root.rstrip('/')}/{name}") for name in FACTS if name in marts}
