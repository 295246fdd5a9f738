"""Denormalised inputs of the dashboard pages, as lazy plans over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.operators.filters import MONTH, Selection, filter_by_date


def load_orders(fct_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Orders with their customer's state."""
    states = dim_customers.select("customer_id", "customer_state")
    return fct_orders.join(states, "customer_id").select(
        "order_id", "order_purchase_date", "order_status", "is_late_delivery", "is_carrier_before_approved",
        "is_delivered_missing_date", "has_no_line_items", "customer_id", "customer_state",
    )


def _with_order(fact: DataFrame, fct_orders: DataFrame, columns: list[str], order_columns: list[str]) -> DataFrame:
    """Some columns of a fact and of its order; facts stored by month meet by it too, and keep it."""
    by = ["order_id", MONTH] if MONTH in fact.columns and MONTH in fct_orders.columns else ["order_id"]
    columns = list(dict.fromkeys([*by, *columns]))
    return fact.select(*columns).join(fct_orders.select(*by, *order_columns), by)


def _month(df: DataFrame) -> list[str]:
    return [MONTH] if MONTH in df.columns else []


def _current_sellers(dim_sellers: DataFrame) -> DataFrame:
    return dim_sellers.filter("is_current").select("seller_id", "seller_state")


def _categories(dim_products: DataFrame) -> DataFrame:
    return dim_products.select("product_id", "product_category_name_english")


def load_order_items(
    fct_order_items: DataFrame, fct_orders: DataFrame, dim_products: DataFrame, dim_sellers: DataFrame,
) -> DataFrame:
    """Order lines with order date, category, and the seller's current state."""
    # orders first: a date filter on the result shrinks the lines before the other joins
    lines = _with_order(
        fct_order_items, fct_orders, ["order_id", "product_id", "seller_id", "total_item_value"], ["order_purchase_date"])
    return (
        lines.join(_current_sellers(dim_sellers), "seller_id")
        .join(_categories(dim_products), "product_id", "left")
        .select("order_id", "order_purchase_date", "total_item_value", "product_category_name_english",
                "seller_id", "seller_state", *_month(lines))
    )


def load_payments(fct_order_payments: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """Payments with their order's date."""
    paid = _with_order(fct_order_payments, fct_orders, ["order_id", "payment_type", "payment_value"], ["order_purchase_date"])
    return paid.select("order_purchase_date", "payment_type", "payment_value", *_month(paid))


def load_reviews(
    fct_order_reviews: DataFrame,
    fct_orders: DataFrame,
    fct_order_items: DataFrame,
    dim_products: DataFrame,
    dim_sellers: DataFrame,
) -> DataFrame:
    """One row per review and order line: a review counts for every category and seller in its order.

    Reviews of orders without lines drop out. For figures over these rows use ``weighted_reviews``, which
    never builds the fan-out.
    """
    lines = (
        fct_order_items.select("order_id", "product_id", "seller_id")
        .join(_current_sellers(dim_sellers).select("seller_id"), "seller_id")
        .join(_categories(dim_products), "product_id", "left")
        .select("order_id", "product_category_name_english", "seller_id")
    )
    return (
        fct_order_reviews.select("review_id", "order_id", "review_score")
        .join(fct_orders.select("order_id", "order_purchase_date", "is_late_delivery"), "order_id")
        .join(lines, "order_id")
        .select("review_id", "review_score", "order_purchase_date", "is_late_delivery",
                "product_category_name_english", "seller_id")
    )


def weighted_reviews(
    fct_order_reviews: DataFrame,
    fct_orders: DataFrame,
    fct_order_items: DataFrame,
    dim_products: DataFrame,
    dim_sellers: DataFrame,
) -> DataFrame:
    """``load_reviews`` grouped by (order, category, score), with the number of its rows as ``weight``.

    Reviews per (order, score) and lines per (order, category) are counted before they meet, so an order
    with very many of both is a handful of rows in the join instead of their product.
    """
    lines = (
        fct_order_items.select("order_id", "product_id", "seller_id")
        .join(_current_sellers(dim_sellers).select("seller_id"), "seller_id")
        .join(_categories(dim_products), "product_id", "left")
        .groupBy("order_id", "product_category_name_english").agg(F.count("*").alias("lines"))
    )
    scores = fct_order_reviews.groupBy("order_id", "review_score").agg(F.count("*").alias("reviews"))
    return (
        scores.join(fct_orders.select("order_id", "order_purchase_date", "is_late_delivery"), "order_id")
        .join(lines, "order_id")
        .select("order_id", "order_purchase_date", "is_late_delivery", "product_category_name_english",
                "review_score", (F.col("reviews") * F.col("lines")).alias("weight"))
    )


def review_grain(fct_order_reviews: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """Reviews counted once each, in the shape of ``weighted_reviews`` without a category."""
    return (
        fct_order_reviews.groupBy("order_id", "review_score").agg(F.count("*").alias("weight"))
        .join(fct_orders.select("order_id", "order_purchase_date", "is_late_delivery"), "order_id")
        .select("order_id", "order_purchase_date", "is_late_delivery",
                F.lit(None).cast("string").alias("product_category_name_english"), "review_score", "weight")
    )


def paid_by_order(fct_order_payments: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """Amount paid per order, with the order's date.

    Summed before the join, on the join's own key: no further shuffle, and an order with very many payments
    is one row in it.
    """
    paid = fct_order_payments.groupBy("order_id").agg(F.sum("payment_value").alias("payment_value"))
    return paid.join(fct_orders.select("order_id", "order_purchase_date"), "order_id")


def value_by_product(
    fct_order_items: DataFrame,
    fct_orders: DataFrame,
    dim_products: DataFrame,
    dim_sellers: DataFrame,
    selection: Selection = Selection(),
) -> DataFrame:
    """Line value per product and its category, over the lines ``load_order_items`` keeps in the date range.

    Summed before the product join, which then reuses the sum's partitioning: a best-seller reaches the
    join as one row.
    """
    dates = filter_by_date(fct_orders.select("order_id", "order_purchase_date"), selection).select("order_id")
    return (
        fct_order_items.select("order_id", "product_id", "seller_id", "total_item_value")
        .join(dates, "order_id")
        .join(_current_sellers(dim_sellers).select("seller_id"), "seller_id")
        .groupBy("product_id").agg(F.sum("total_item_value").alias("revenue"))
        .join(_categories(dim_products), "product_id", "left")
    )
