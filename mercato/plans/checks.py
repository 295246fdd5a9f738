"""The data tests of the staging layer and the marts, and the constraints of the raw tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from mercato.constants import WARN_ABOVE
from mercato.operators.quality import (
    ACCEPTED,
    EXPRESSION,
    NOT_NULL,
    RELATIONSHIP,
    UNIQUE,
    UNIQUE_COMBO,
    Check,
)


def _each(kind: str, pairs: Iterable[tuple[str, str]]) -> list[Check]:
    return [Check(kind, table, (column,)) for table, column in pairs]


def _combo(table: str, *columns: str) -> Check:
    return Check(UNIQUE_COMBO, table, columns)


def _expects(table: str, column: str, expression: str) -> Check:
    return Check(EXPRESSION, table, (column,), expression=expression)


def _refers(table: str, column: str, parent: str) -> Check:
    return Check(RELATIONSHIP, table, (column,), parent=(parent, column))


# fixed values: the declared checks of the staging layer and the marts
STAGING_CHECKS: list[Check] = [
    *_each(UNIQUE, [
        ("stg_customers", "customer_id"),
        ("stg_sellers", "seller_id"),
        ("stg_category_translation", "product_category_name"),
        ("stg_products", "product_id"),
        ("stg_orders", "order_id"),
    ]),
    *_each(NOT_NULL, [
        ("stg_customers", "customer_id"),
        ("stg_sellers", "seller_id"),
        ("stg_category_translation", "product_category_name"),
        ("stg_products", "product_id"),
        ("stg_orders", "order_id"),
        ("stg_orders", "customer_id"),
        ("stg_order_items", "price"),
        ("stg_order_items", "freight_value"),
        ("stg_order_items", "order_id"),
        ("stg_order_payments", "payment_value"),
        ("stg_order_payments", "payment_installments"),
        ("stg_order_payments", "order_id"),
        ("stg_order_reviews", "review_score"),
        ("stg_order_reviews", "order_id"),
    ]),
    _refers("stg_orders", "customer_id", "stg_customers"),
    _refers("stg_order_items", "order_id", "stg_orders"),
    _refers("stg_order_items", "product_id", "stg_products"),
    _refers("stg_order_items", "seller_id", "stg_sellers"),
    _refers("stg_order_payments", "order_id", "stg_orders"),
    _refers("stg_order_reviews", "order_id", "stg_orders"),
    _expects("stg_order_items", "price", "> 0"),
    _expects("stg_order_items", "freight_value", ">= 0"),
    _expects("stg_order_payments", "payment_value", ">= 0"),
    _expects("stg_order_payments", "payment_installments", ">= 0"),
    Check(ACCEPTED, "stg_order_reviews", ("review_score",), values=(1, 2, 3, 4, 5)),
    _combo("stg_order_items", "order_id", "order_item_id"),
    _combo("stg_order_reviews", "review_id", "order_id"),
]

MART_CHECKS: list[Check] = [
    *_each(UNIQUE, [
        ("dim_customers", "customer_id"),
        ("dim_products", "product_id"),
        ("dim_date", "date_day"),
        ("fct_orders", "order_id"),
    ]),
    *_each(NOT_NULL, [
        ("dim_customers", "customer_id"),
        ("dim_sellers", "seller_id"),
        ("dim_products", "product_id"),
        ("dim_date", "date_day"),
        ("fct_orders", "order_id"),
    ]),
    _refers("fct_orders", "customer_id", "dim_customers"),
    _refers("fct_order_items", "order_id", "fct_orders"),
    _refers("fct_order_items", "product_id", "dim_products"),
    _refers("fct_order_items", "seller_id", "dim_sellers"),
    _refers("fct_order_payments", "order_id", "fct_orders"),
    _refers("fct_order_reviews", "order_id", "fct_orders"),
    *[
        Check(EXPRESSION, "fct_orders", (flag,), expression="= false", severity="warn", warn_above=limit)
        for flag, limit in WARN_ABOVE.items()
    ],
    _combo("dim_sellers", "seller_id", "valid_from"),
    _combo("fct_order_items", "order_id", "order_item_id"),
    _combo("fct_order_reviews", "review_id", "order_id"),
]

CHECKS: list[Check] = STAGING_CHECKS + MART_CHECKS

# the payments' stated grain, which the list above leaves untested
EXTRA_CHECKS: list[Check] = [_combo("fct_order_payments", "order_id", "payment_sequential")]

# (table, key columns) whose uniqueness the integrity profile reports
PROFILED_KEYS: list[tuple[str, list[str]]] = [
    ("customers", ["customer_id"]),
    ("orders", ["order_id"]),
    ("products", ["product_id"]),
    ("sellers", ["seller_id"]),
    ("category_translation", ["product_category_name"]),
    ("order_items", ["order_id", "order_item_id"]),
    ("order_reviews", ["review_id"]),
    ("order_reviews", ["order_id"]),
]

# (child, column, parent, column)
REFERENCES: list[tuple[str, str, str, str]] = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("order_payments", "order_id", "orders", "order_id"),
    ("order_reviews", "order_id", "orders", "order_id"),
    ("products", "product_category_name", "category_translation", "product_category_name"),
]


def row_rules(table: str) -> dict[str, Column]:
    """Row constraints of a raw table besides its required columns, keys and references."""
    rules = {
        "orders": {
            "approved after purchase": F.col("order_approved_at") >= F.col("order_purchase_timestamp"),
            "delivered after purchase": F.col("order_delivered_customer_date") >= F.col("order_purchase_timestamp"),
        },
        "order_items": {
            "price positive": F.col("price") > 0,
            "freight not negative": F.col("freight_value") >= 0,
        },
        "order_payments": {
            "instalments not negative": F.col("payment_installments") >= 0,
            "payment not negative": F.col("payment_value") >= 0,
        },
        "order_reviews": {"score 1 to 5": F.col("review_score").between(1, 5)},
    }
    return rules.get(table, {})
