"""Star schema: four dimensions and four facts, each at its own grain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.constants import CALENDAR_END, CALENDAR_START, DELIVERED
from mercato.functions.exprs import flag, whole_hours
from mercato.operators.history import dim_scd2
from mercato.plans.staging import geo_by_zip
from mercato.session import materialise

ORDER_FLAGS = ["is_late_delivery", "is_carrier_before_approved", "is_delivered_missing_date", "has_no_line_items"]


def _located(df: DataFrame, zip_column: str, geo: DataFrame, lat: str, lng: str) -> DataFrame:
    places = geo.select(
        F.col("zip_code_prefix").alias(zip_column), F.col("lat").alias(lat), F.col("lng").alias(lng))
    return df.join(places, zip_column, "left")


def dim_customers(customers: DataFrame, geo: DataFrame) -> DataFrame:
    """One row per customer_id, with the mean coordinates of its zip prefix."""
    return _located(customers, "customer_zip_code_prefix", geo, "customer_lat", "customer_lng").select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
        "customer_lat", "customer_lng",
    )


def dim_sellers(snapshot: DataFrame, geo: DataFrame) -> DataFrame:
    """One row per seller version, located by that version's own zip prefix."""
    located = _located(snapshot, "seller_zip_code_prefix", geo, "seller_lat", "seller_lng")
    return dim_scd2(located).select(
        "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state", "seller_lat", "seller_lng",
        "valid_from", "valid_to", "is_current",
    )


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """One row per product; no category or an untranslated one gives a NULL English name."""
    return products.join(translation, "product_category_name", "left").select(
        "product_id", "product_category_name", "product_category_name_english",
        "product_name_length", "product_description_length", "product_photos_qty",
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    )


def _calendar(days: DataFrame) -> DataFrame:
    day = F.col("date_day")
    return days.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),  # 1 = Sunday
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end``."""
    first, last = F.to_date(F.lit(start)), F.date_sub(F.to_date(F.lit(end)), 1)
    return _calendar(spark.range(1).select(F.explode(F.sequence(first, last)).alias("date_day")))


def dim_date_covering(orders: DataFrame) -> DataFrame:
    """Calendar of the whole years that hold the orders' purchase dates."""
    span = orders.agg(
        F.min(F.to_date("order_purchase_timestamp")).alias("first"),
        F.max(F.to_date("order_purchase_timestamp")).alias("last"),
    )
    new_year = F.trunc("first", "year")
    year_end = F.date_sub(F.add_months(F.trunc("last", "year"), 12), 1)
    return _calendar(span.select(F.explode(F.sequence(new_year, year_end)).alias("date_day")))


def order_flags(df: DataFrame) -> DataFrame:
    """The four anomaly flags from order dates, status and ``item_count``; never NULL."""
    delivered = F.col("order_delivered_customer_date")
    return df.withColumns({
        "is_late_delivery": flag(delivered > F.col("order_estimated_delivery_date")),
        "is_carrier_before_approved": flag(F.col("order_delivered_carrier_date") < F.col("order_approved_at")),
        "is_delivered_missing_date": flag((F.col("order_status") == DELIVERED) & delivered.isNull()),
        "has_no_line_items": F.col("item_count") == 0,
    })


def fct_orders(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """One row per order with its item count and anomaly flags; items are counted before the join."""
    items_per_order = order_items.groupBy("order_id").agg(F.count("*").alias("item_count"))
    counted = orders.join(items_per_order, "order_id", "left").withColumns({
        "item_count": F.coalesce("item_count", F.lit(0)),
        "order_purchase_date": F.to_date("order_purchase_timestamp"),
    })
    return order_flags(counted).select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_purchase_date",
        "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date", "item_count", *ORDER_FLAGS,
    )


def fct_order_items(order_items: DataFrame) -> DataFrame:
    """One row per order line, with the value the customer paid for it."""
    return order_items.select(
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
        (F.col("price") + F.col("freight_value")).alias("total_item_value"),
    )


def fct_order_payments(order_payments: DataFrame) -> DataFrame:
    """One row per payment of an order."""
    return order_payments.select(
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value")


def fct_order_reviews(order_reviews: DataFrame) -> DataFrame:
    """One row per (review, order), with full hours until the answer."""
    return order_reviews.withColumn(
        "hours_to_answer", whole_hours("review_creation_date", "review_answer_timestamp"))


def build_star(staging: dict[str, DataFrame], sellers_history: DataFrame) -> dict[str, DataFrame]:
    """All marts as lazy plans over staging and the sellers' history.

    Coordinates by zip are written once: two dimensions read them, and their measured size lets the
    planner broadcast them instead of shuffling every customer by zip.
    """
    geo = materialise(geo_by_zip(staging["geolocation"]), "geo-by-zip")
    return {
        "dim_customers": dim_customers(staging["customers"], geo),
        "dim_sellers": dim_sellers(sellers_history, geo),
        "dim_products": dim_products(staging["products"], staging["category_translation"]),
        "dim_date": dim_date(staging["orders"].sparkSession),
        "fct_orders": fct_orders(staging["orders"], staging["order_items"]),
        "fct_order_items": fct_order_items(staging["order_items"]),
        "fct_order_payments": fct_order_payments(staging["order_payments"]),
        "fct_order_reviews": fct_order_reviews(staging["order_reviews"]),
    }
