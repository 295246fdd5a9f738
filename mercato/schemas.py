"""Declared schemas and keys of the nine raw tables."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# decimal(28,9): a sum of two stays at scale 9, which decimal(38,9) would not
MONEY = T.DecimalType(28, 9)

_STR, _INT, _DBL, _TS = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()


@dataclass(frozen=True)
class TableSpec:
    """One raw table: its file stem, columns, merge key, and whether a row as a whole is the key."""

    name: str
    stem: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    full_row: bool = False

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    @property
    def timestamps(self) -> list[str]:
        return [f.name for f in self.schema if f.dataType == _TS]

    @property
    def merge_keys(self) -> list[str]:
        return self.columns if self.full_row else list(self.keys)


def _schema(*fields: tuple) -> T.StructType:
    # a third element marks a nullable column
    return T.StructType([T.StructField(f[0], f[1], len(f) == 3) for f in fields])


_SPECS = [
    TableSpec("category_translation", "product_category_name_translation", _schema(
        ("product_category_name", _STR),
        ("product_category_name_english", _STR),
    ), ("product_category_name",)),
    TableSpec("customers", "customers", _schema(
        ("customer_id", _STR),
        ("customer_unique_id", _STR),
        ("customer_zip_code_prefix", _INT),
        ("customer_city", _STR),
        ("customer_state", _STR),
    ), ("customer_id",)),
    TableSpec("sellers", "sellers", _schema(
        ("seller_id", _STR),
        ("seller_zip_code_prefix", _INT),
        ("seller_city", _STR),
        ("seller_state", _STR),
    ), ("seller_id",)),
    TableSpec("products", "products", _schema(
        ("product_id", _STR),
        ("product_category_name", _STR, "null"),
        ("product_name_lenght", _INT, "null"),
        ("product_description_lenght", _INT, "null"),
        ("product_photos_qty", _INT, "null"),
        ("product_weight_g", MONEY, "null"),
        ("product_length_cm", MONEY, "null"),
        ("product_height_cm", MONEY, "null"),
        ("product_width_cm", MONEY, "null"),
    ), ("product_id",)),
    TableSpec("geolocation_raw", "geolocation", _schema(
        ("geolocation_zip_code_prefix", _INT),
        ("geolocation_lat", _DBL),
        ("geolocation_lng", _DBL),
        ("geolocation_city", _STR),
        ("geolocation_state", _STR),
    ), full_row=True),
    TableSpec("orders", "orders", _schema(
        ("order_id", _STR),
        ("customer_id", _STR),
        ("order_status", _STR),
        ("order_purchase_timestamp", _TS),
        ("order_approved_at", _TS, "null"),
        ("order_delivered_carrier_date", _TS, "null"),
        ("order_delivered_customer_date", _TS, "null"),
        ("order_estimated_delivery_date", _TS),
    ), ("order_id",)),
    TableSpec("order_items", "order_items", _schema(
        ("order_id", _STR),
        ("order_item_id", _INT),
        ("product_id", _STR),
        ("seller_id", _STR),
        ("shipping_limit_date", _TS),
        ("price", MONEY),
        ("freight_value", MONEY),
    ), ("order_id", "order_item_id")),
    TableSpec("order_payments", "order_payments", _schema(
        ("order_id", _STR),
        ("payment_sequential", _INT),
        ("payment_type", _STR),
        ("payment_installments", _INT),
        ("payment_value", MONEY),
    ), ("order_id", "payment_sequential")),
    TableSpec("order_reviews", "order_reviews", _schema(
        ("review_id", _STR),
        ("order_id", _STR),
        ("review_score", _INT),
        ("review_comment_title", _STR, "null"),
        ("review_comment_message", _STR, "null"),
        ("review_creation_date", _TS),
        ("review_answer_timestamp", _TS),
    ), ("review_id", "order_id")),
]

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}


def spec_for_file(file_name: str, prefix: str = "", suffix: str = "_dataset") -> TableSpec | None:
    """The table a landed CSV belongs to, or ``None`` for files that are not ours.

    ``orders.csv``, and with the publisher's ``prefix`` or ``suffix`` also ``<prefix>orders<suffix>.csv``; of a table
    landed in several files, each has a number of five or more digits at the end (``orders-00001.csv``). Names are otherwise exact, so that
    ``cancelled_orders.csv`` is no order file. Numbered files may be compressed (``orders-00001.csv.gz``).
    """
    base = file_name.rsplit("/", 1)[-1]
    base = re.sub(r"(-[0-9]{5,}\.csv)\.gz\Z", r"\1", base)
    if not base.endswith(".csv"):
        return None
    stem = re.sub(r"-[0-9]{5,}\Z", "", base.removesuffix(".csv")).removesuffix(suffix).removeprefix(prefix)
    return next((spec for spec in _SPECS if stem == spec.stem), None)
