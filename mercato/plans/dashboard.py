"""Figures behind each dashboard page. Filters stay in the plan; only the small results leave Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.constants import CANCELED, DELIVERED
from mercato.functions.exprs import day_span, month_of, rate
from mercato.operators.filters import (
    Selection,
    filter_by_category,
    filter_by_date,
    filter_by_date_and_category,
    filter_by_date_and_state,
)
from mercato.plans.star import ORDER_FLAGS

EVERYTHING = Selection()
TOP = 15
CATEGORY = "product_category_name_english"


def _or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def _top(df: DataFrame, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(TOP)


# sales

def kpi_sales(payments: DataFrame, items: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    """Revenue collected, orders, and revenue per order; ``payments`` by payment or summed by order.

    The two scopes differ on purpose: revenue follows the dates only, orders the dates and categories.
    """
    orders = filter_by_date_and_category(items, selection).agg(F.countDistinct("order_id"))
    revenue = filter_by_date(payments, selection).agg(
        _or_zero(F.sum("payment_value")).alias("total_revenue"))
    return revenue.withColumn("total_orders", orders.scalar()).withColumn(
        "avg_order_value",
        F.when(F.col("total_orders") > 0, F.col("total_revenue").cast("double") / F.col("total_orders"))
        .otherwise(F.lit(0.0)),
    )


def monthly_revenue(payments: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    """Payments per month of purchase; months without any are absent. Takes payments as ``kpi_sales`` does."""
    return (
        filter_by_date(payments, selection)
        .groupBy(month_of("order_purchase_date").alias("month"))
        .agg(_or_zero(F.sum("payment_value")).alias("revenue"))
        .orderBy("month")
    )


def top_categories(by_product: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    """The 15 categories with the highest line value, from ``value_by_product`` in the date range.

    Lines without a category are left out.
    """
    named = by_product.filter(F.col(CATEGORY).isNotNull())
    totals = filter_by_category(named, selection).groupBy(CATEGORY).agg(F.sum("revenue").alias("revenue"))
    return _top(totals, [F.desc("revenue"), F.asc(CATEGORY)])


# delivery

def kpi_delivery(orders: DataFrame, legs: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    """Late share in percent and count over all chosen orders, and the plain mean of the state means."""
    mean_of_states = legs.agg(F.avg("avg_delivery_days"))
    late = filter_by_date_and_state(orders, selection).agg(
        _or_zero(rate(F.col("is_late_delivery")) * 100).alias("late_rate_all"),
        F.count_if("is_late_delivery").alias("late_orders"),
    )
    return late.withColumn("avg_state_delivery_days", mean_of_states.scalar())


def delivery_legs(fct_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Per state, over delivered orders: total days, late share, and days of each leg.

    Each mean skips its own missing dates, so the legs need not add up to the total.
    """
    delivered = fct_orders.filter(
        (F.col("order_status") == DELIVERED) & F.col("order_delivered_customer_date").isNotNull())
    return (
        delivered.join(dim_customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state")
        .agg(
            F.count("*").alias("delivered_orders"),
            F.avg(day_span("order_purchase_date", "order_delivered_customer_date")).alias("avg_delivery_days"),
            rate(F.col("is_late_delivery")).alias("late_rate_delivered"),
            F.avg(day_span("order_approved_at", "order_delivered_carrier_date")).alias("avg_seller_handling_days"),
            F.avg(day_span("order_delivered_carrier_date", "order_delivered_customer_date"))
            .alias("avg_carrier_transit_days"),
        )
        .orderBy(F.desc("avg_delivery_days"), "customer_state")
    )


def monthly_anomaly_rates(orders: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    """Three flags as percent of the month's orders, one row per month and flag."""
    flags = ORDER_FLAGS[:3]
    monthly = (
        filter_by_date_and_state(orders, selection)
        .groupBy(month_of("order_purchase_date").alias("month"))
        .agg(*[(rate(F.col(f)) * 100).alias(f) for f in flags])
    )
    return monthly.unpivot(["month"], flags, "flag", "rate_pct").orderBy("month", "flag")


def anomaly_counts(orders: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    """Number of orders per flag."""
    totals = filter_by_date_and_state(orders, selection).agg(*[F.count_if(f).alias(f) for f in ORDER_FLAGS])
    return totals.unpivot([], ORDER_FLAGS, "flag", "orders")


def monthly_volume_late(orders: DataFrame) -> DataFrame:
    """Orders and late share per month over the whole history."""
    return (
        orders.groupBy(month_of("order_purchase_date").alias("month"))
        .agg(F.count("order_id").alias("orders"), rate(F.col("is_late_delivery")).alias("late_rate_all"))
        .orderBy("month")
    )


# satisfaction: ``reviews`` carries a ``weight`` per row, see ``weighted_reviews``

def _mean_score(condition: Column | None = None) -> Column:
    points = F.col("review_score") * F.col("weight")
    weight = F.when(F.col("review_score").isNotNull(), F.col("weight"))  # a review without a score has no part in a mean
    if condition is not None:
        points, weight = F.when(condition, points), F.when(condition, weight)
    return F.sum(points).cast("double") / F.sum(weight)


def kpi_satisfaction(reviews: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    """Mean score, percent of scores up to 2, and the on-time minus late gap (NULL without both)."""
    late = F.col("is_late_delivery")
    low = F.sum(F.when(F.col("review_score") <= 2, F.col("weight")).otherwise(F.lit(0)))
    return filter_by_date_and_category(reviews, selection).agg(
        _mean_score().alias("avg_review_score"),
        _or_zero(low.cast("double") * 100 / F.sum("weight")).alias("low_score_pct"),
        (_mean_score(~late) - _mean_score(late)).alias("on_time_minus_late"),
    )


def review_histogram(reviews: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    return (
        filter_by_date_and_category(reviews, selection)
        .groupBy("review_score").agg(F.sum("weight").alias("reviews")).orderBy("review_score")
    )


def score_by_lateness(reviews: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    label = F.when(F.col("is_late_delivery"), "Late").otherwise("On time")
    return (
        filter_by_date_and_category(reviews, selection)
        .groupBy(label.alias("delivery")).agg(_mean_score().alias("avg_review_score")).orderBy("delivery")
    )


def lowest_rated_categories(reviews: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    """The 15 categories with the lowest mean score, however few reviews they have."""
    means = (
        filter_by_date_and_category(reviews, selection)
        .filter(F.col(CATEGORY).isNotNull())
        .groupBy(CATEGORY).agg(_mean_score().alias("avg_review_score"))
    )
    return _top(means, [F.asc("avg_review_score"), F.asc(CATEGORY)])


# marketplace

def kpi_marketplace(orders: DataFrame, items: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    """Sellers with a sale, and delivered and cancelled orders in percent."""
    sellers = filter_by_date_and_category(items, selection).agg(F.countDistinct("seller_id"))
    shares = filter_by_date_and_state(orders, selection).agg(
        _or_zero(rate(F.col("order_status") == DELIVERED) * 100).alias("delivered_pct"),
        _or_zero(rate(F.col("order_status") == CANCELED) * 100).alias("canceled_pct"),
    )
    return shares.withColumn("active_sellers", sellers.scalar())


def top_sellers(items: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    """The 15 sellers with the highest line value."""
    totals = (
        filter_by_date_and_category(items, selection)
        .groupBy("seller_id").agg(F.sum("total_item_value").alias("revenue"))
    )
    return _top(totals, [F.desc("revenue"), F.asc("seller_id")])


def orders_by_status(orders: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    return (
        filter_by_date_and_state(orders, selection).filter(F.col("order_status").isNotNull())
        .groupBy("order_status").agg(F.count("*").alias("orders"))
        .orderBy(F.desc("orders"), "order_status")
    )


def sellers_by_state(items: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    """Sellers with a sale per state; a current seller has one state, so each counts once."""
    return (
        filter_by_date_and_category(items, selection).filter(F.col("seller_state").isNotNull())
        .select("seller_state", "seller_id").distinct()
        .groupBy("seller_state").agg(F.count("*").alias("sellers"))
        .orderBy(F.desc("sellers"), "seller_state")
    )


def revenue_share_by_state(fct_orders: DataFrame, dim_customers: DataFrame, payments: DataFrame) -> DataFrame:
    """Payments by the customer's state and their share of the total; payments are summed per order first."""
    paid = payments.groupBy("order_id").agg(F.sum("payment_value").alias("paid"))
    by_state = (
        fct_orders.select("order_id", "customer_id").join(paid, "order_id")
        .join(dim_customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state").agg(F.sum("paid").alias("revenue"))
    )
    total = by_state.agg(F.sum("revenue")).scalar()
    return by_state.withColumn("revenue_share", F.col("revenue").cast("double") / total.cast("double"))


def headline_shares(fct_orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Late share of delivered orders and share of scores up to 2, reviews counted once (``review_grain``)."""
    low = F.sum(F.when(F.col("review_score") <= 2, F.col("weight")).otherwise(F.lit(0)))
    low_share = reviews.agg(low.cast("double") / F.sum("weight"))
    delivered = fct_orders.filter(
        (F.col("order_status") == DELIVERED) & F.col("order_delivered_customer_date").isNotNull())
    late = delivered.agg(rate(F.col("is_late_delivery")).alias("late_rate_delivered"))
    return late.withColumn("low_score_share", low_share.scalar())
