"""Recency-frequency-value segmentation of persons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.constants import CANCELED, GOLD, LAPSED, REPEAT, SILVER, STANDARD, UNAVAILABLE
from mercato.operators.ranking import global_ntile
from mercato.session import materialise

QUARTILES = 4


def rfm_per_customer(fct_orders: DataFrame, dim_customers: DataFrame, fct_order_items: DataFrame) -> DataFrame:
    """Orders, value and last purchase of each person, without cancelled or unavailable orders.

    Orders and customers are unique in their tables. A person whose orders have no lines has a NULL value. Lines are summed per order before they join.
    """
    counted = fct_orders.filter(~F.col("order_status").isin(CANCELED, UNAVAILABLE)).select(
        "order_id", "customer_id", "order_purchase_date")
    persons = dim_customers.select("customer_id", "customer_unique_id")
    worth = fct_order_items.groupBy("order_id").agg(F.sum("total_item_value").alias("order_value"))
    return (
        counted.join(worth, "order_id", "left").join(persons, "customer_id")
        .groupBy("customer_unique_id")
        .agg(
            F.count("order_id").alias("order_count"),
            F.sum("order_value").alias("lifetime_value"),
            F.max("order_purchase_date").alias("last_purchase_date"),
        )
    )


def rfm_scored(per_customer: DataFrame) -> DataFrame:
    """Quartile scores: recency (4 = most recent), frequency and value (4 = highest).

    Ties are broken by the person's id. NULL value ranks lowest. The input is settled once, as the
    scoring reads it several times.
    """
    settled = materialise(per_customer, "per-customer")
    last_day = settled.agg(F.max("last_purchase_date")).scalar()
    ordered = settled.withColumns({
        # ascending over negated days: the longest absent come first
        "_recency": (-F.datediff(last_day, F.col("last_purchase_date"))).cast("decimal(38,9)"),
        "_frequency": F.col("order_count").cast("decimal(38,9)"),
        "_value": F.col("lifetime_value").cast("decimal(38,9)"),
    })
    scores = {"r_score": "_recency", "f_score": "_frequency", "m_score": "_value"}
    return global_ntile(ordered, QUARTILES, scores, "customer_unique_id").drop(*scores.values())


def rfm_segments(scored: DataFrame) -> DataFrame:
    """Name the segment; the first rule that fits wins."""
    r, m = F.col("r_score"), F.col("m_score")
    segment = (
        F.when((m == 4) & (r >= 3), GOLD)
        .when((m >= 3) & (r >= 2), SILVER)
        .when(F.col("order_count") > 1, REPEAT)
        .when(r == 1, LAPSED)
        .otherwise(STANDARD)
    )
    return scored.withColumn("customer_segment", segment)


def segment_summary(segments: DataFrame) -> DataFrame:
    """Size, revenue, means and shares per segment, by revenue."""
    summed = segments.groupBy("customer_segment").agg(
        F.count("*").alias("customers"),
        F.coalesce(F.sum("lifetime_value"), F.lit(0)).alias("revenue"),
        F.avg(F.col("lifetime_value").cast("double")).alias("avg_ltv"),
        F.avg("order_count").alias("avg_orders"),
    )
    totals = summed.agg(F.struct(F.sum("revenue").alias("revenue"), F.sum("customers").alias("customers")))
    return (
        summed.withColumn("_total", totals.scalar())
        .withColumns({
            "revenue_share": F.try_divide(F.col("revenue").cast("double"), F.col("_total.revenue").cast("double")),
            "customer_share": F.col("customers") / F.col("_total.customers"),
        })
        .drop("_total")
        .orderBy(F.desc("revenue"), "customer_segment")
    )


def kpi_segments(segments: DataFrame) -> DataFrame:
    """Persons, repeat-purchase rate, and gold's size and revenue share (NULL without gold).

    Segments hold one row per person, so persons are counted without a distinct.
    """
    gold = F.col("customer_segment") == GOLD
    return segments.agg(
        F.count("customer_unique_id").alias("total_customers"),
        F.avg((F.col("order_count") > 1).cast("double")).alias("repeat_rate"),
        F.nullif(F.count_if(gold), F.lit(0)).alias("gold_customers"),
        F.when(F.count_if(gold) > 0, F.try_divide(
            F.coalesce(F.sum(F.when(gold, F.col("lifetime_value"))), F.lit(0)).cast("double"),
            F.sum("lifetime_value").cast("double"),
        )).alias("gold_revenue_share"),
    )
