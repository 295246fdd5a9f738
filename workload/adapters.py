"""The nine raw marketplace tables, derived from the given tables.

One text per table, portable between Spark SQL and the checking engine; ``{name}`` stands for a given
table. Anomalies are planted on purpose, so that every check has something to find.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from mercato.operators.history import first_snapshot, snapshot_check
from mercato.plans import star
from mercato.plans.staging import build_staging, geo_by_zip
from mercato.session import materialise

RUN_1, RUN_2 = datetime(1998, 1, 1), datetime(2000, 1, 1)
LOADED_AT = datetime(2024, 1, 1)
SELLER_COLS = ["seller_zip_code_prefix", "seller_city", "seller_state"]

_BOUGHT = "o_orderdate + INTERVAL '1' MINUTE * (o_orderkey % 1440)"

_ORDER_COLUMNS = f"""
 CASE WHEN o_orderkey % 50 = 7 THEN 'canceled' WHEN o_orderkey % 50 = 8 THEN 'unavailable'
  WHEN o_orderstatus = 'O' AND o_orderkey % 5 = 0 THEN 'shipped' ELSE 'delivered' END AS order_status,
 {_BOUGHT} AS order_purchase_timestamp,
 CASE WHEN o_orderkey % 97 = 0 THEN NULL
  ELSE {_BOUGHT} + INTERVAL '1' HOUR * (o_orderkey % 72) END AS order_approved_at,
 CASE WHEN o_orderkey % 50 IN (7, 8) THEN NULL
  ELSE {_BOUGHT} + INTERVAL '1' HOUR * ((o_orderkey % 72) + (o_orderkey % 41) - 3) END AS order_delivered_carrier_date,
 CASE WHEN o_orderkey % 50 IN (7, 8) OR (o_orderstatus = 'O' AND o_orderkey % 5 = 0) OR o_orderkey % 499 = 0 THEN NULL
  ELSE {_BOUGHT} + INTERVAL '1' HOUR * ((o_orderkey % 72) + (o_orderkey % 41) + (o_custkey % 500))
  END AS order_delivered_customer_date,
 o_orderdate + INTERVAL '1' DAY * 21 AS order_estimated_delivery_date"""

# uneven factors: means of round coordinates would sit exactly on a rounding edge, where sums of doubles differ
_GEO_COLUMNS = """CAST((user_id % 25) * 100 + event_id % 7 AS BIGINT) AS geolocation_zip_code_prefix,
 value * 0.0971031 - 34.0 AS geolocation_lat, -40.0 - value * 0.0493077 AS geolocation_lng"""

_GEO_STATE = "concat('S', CAST(user_id % 25 AS STRING)) AS geolocation_state"

ADAPTERS: dict[str, str] = {
    # one customer_id per order; a person repeats or not; some zips have no place
    "customers": """
SELECT CAST(o_orderkey AS STRING) AS customer_id,
 CASE WHEN o_orderkey % 10 < 7 THEN concat('once-', CAST(o_orderkey AS STRING))
  ELSE concat('rep-', CAST(c_custkey AS STRING)) END AS customer_unique_id,
 CAST(c_nationkey * 100 + c_custkey % 10 AS BIGINT) AS customer_zip_code_prefix,
 c_mktsegment AS customer_city, n_name AS customer_state
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""",
    "sellers": """
SELECT CAST(s_suppkey AS STRING) AS seller_id, CAST(s_nationkey * 100 + s_suppkey % 10 AS BIGINT) AS seller_zip_code_prefix,
 s_name AS seller_city, n_name AS seller_state
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    # second run: some moved, one new key, some absent
    "sellers_v2": """
SELECT CASE WHEN s_suppkey = 1 THEN '-1' ELSE CAST(s_suppkey AS STRING) END AS seller_id,
 CAST(s_nationkey * 100 + s_suppkey % 10 + CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE 0 END AS BIGINT) AS seller_zip_code_prefix,
 s_name AS seller_city, n_name AS seller_state
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey WHERE s_suppkey % 9 <> 5""",
    "products": """
SELECT CAST(p_partkey AS STRING) AS product_id,
 CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE concat(p_type, '_', p_brand) END AS product_category_name,
 CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE CAST(length(p_name) AS BIGINT) END AS product_name_lenght,
 CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE CAST(p_size * 10 AS BIGINT) END AS product_description_lenght,
 CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE CAST(p_size % 7 AS BIGINT) END AS product_photos_qty,
 CAST(CASE WHEN p_partkey % 97 = 0 THEN 0 ELSE p_retailprice END AS DECIMAL(28,9)) AS product_weight_g,
 CAST(p_size AS DECIMAL(28,9)) AS product_length_cm, CAST(p_size % 11 AS DECIMAL(28,9)) AS product_height_cm,
 CAST(p_size + 1 AS DECIMAL(28,9)) AS product_width_cm
FROM {part}""",
    # two categories left untranslated
    "category_translation": """
SELECT DISTINCT concat(p_type, '_', p_brand) AS product_category_name,
 lower(concat(p_type, '_', p_brand)) AS product_category_name_english
FROM {part} WHERE NOT (p_type = 'PROMO' AND p_brand IN ('Brand#2', 'Brand#3'))""",
    # a quarter of the events twice: full-row duplicates; some points outside the box
    "geolocation_raw": f"""
SELECT {_GEO_COLUMNS}, event_type AS geolocation_city, {_GEO_STATE} FROM {{events}}
UNION ALL
SELECT {_GEO_COLUMNS}, event_type AS geolocation_city, {_GEO_STATE} FROM {{events}} WHERE event_id % 4 = 0""",
    # second batch: every place again, some under a new spelling and those twice
    "geolocation_v2": f"""
SELECT {_GEO_COLUMNS}, CASE WHEN event_id % 3 = 0 THEN upper(event_type) ELSE event_type END AS geolocation_city,
 {_GEO_STATE} FROM {{events}}
UNION ALL
SELECT {_GEO_COLUMNS}, upper(event_type) AS geolocation_city, {_GEO_STATE} FROM {{events}} WHERE event_id % 3 = 0""",
    "orders": f"""
SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_orderkey AS STRING) AS customer_id,{_ORDER_COLUMNS}
FROM {{orders}}""",
    # second batch: every order again, some under a new key, with new states, dates reset to NULL, approvals
    # before the purchase, and customers that do not exist
    "orders_v2": f"""
SELECT CASE WHEN o_orderkey % 7 = 0 THEN concat('new-', order_id) ELSE order_id END AS order_id,
 CASE WHEN o_orderkey % 17 = 0 THEN concat('gone-', customer_id) ELSE customer_id END AS customer_id,
 CASE WHEN order_status = 'shipped' THEN 'delivered' ELSE order_status END AS order_status, order_purchase_timestamp,
 CASE WHEN o_orderkey % 11 = 0 THEN order_purchase_timestamp - INTERVAL '1' HOUR ELSE order_approved_at END AS order_approved_at,
 order_delivered_carrier_date,
 CASE WHEN o_orderkey % 5 = 1 THEN NULL ELSE order_delivered_customer_date END AS order_delivered_customer_date,
 order_estimated_delivery_date
FROM (SELECT o_orderkey, CAST(o_orderkey AS STRING) AS order_id, CAST(o_orderkey AS STRING) AS customer_id,{_ORDER_COLUMNS}
 FROM {{orders}}) o""",
    # what each product was offered for: a new price on every day that a line of it was to be shipped
    "asking_prices": """
SELECT product_id, max(price) AS asking_price, valid_from,
 lead(valid_from) OVER (PARTITION BY product_id ORDER BY valid_from) AS valid_to
FROM (SELECT CAST(l_partkey AS STRING) AS product_id, l_shipdate AS valid_from, CAST(l_extendedprice AS DECIMAL(28,9)) AS price
 FROM {lineitem}) offers
GROUP BY product_id, valid_from""",
    # as text, with values that do not parse
    "orders_text": f"""
SELECT CAST(o_orderkey AS STRING) AS order_id,
 CASE WHEN o_orderkey % 13 = 0 THEN 'not a date' ELSE CAST({_BOUGHT} AS STRING) END AS order_purchase_timestamp,
 CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE CAST(o_orderdate AS STRING) END AS order_estimated_delivery_date,
 CASE WHEN o_orderkey % 23 = 0 THEN 'n/a' WHEN o_orderkey % 2 = 0 THEN concat(CAST(o_custkey AS STRING), '.0')
  ELSE CAST(o_custkey AS STRING) END AS customer_number
FROM {{orders}}""",
    # (l_orderkey, l_linenumber) repeats in the given data, so the line's number also carries part and supplier
    "order_items": """
SELECT CAST(l_orderkey AS STRING) AS order_id,
 (CAST(l_partkey AS BIGINT) * 1000003 + l_suppkey) * 8 + l_linenumber AS order_item_id,
 CAST(l_partkey AS STRING) AS product_id, CAST(l_suppkey AS STRING) AS seller_id, l_shipdate AS shipping_limit_date,
 CAST(l_extendedprice AS DECIMAL(28,9)) AS price,
 CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS DECIMAL(28,9)) AS freight_value
FROM {lineitem}""",
    "order_payments": """
SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(1 AS BIGINT) AS payment_sequential, o_orderpriority AS payment_type,
 CAST(o_orderkey % 11 AS BIGINT) AS payment_installments, CAST(o_totalprice AS DECIMAL(28,9)) AS payment_value
FROM {orders} WHERE o_orderkey % 331 <> 0
UNION ALL
SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(2 AS BIGINT) AS payment_sequential, o_orderpriority AS payment_type,
 CAST(o_orderkey % 11 AS BIGINT) AS payment_installments, CAST(0 AS DECIMAL(28,9)) AS payment_value
FROM {orders} WHERE o_orderkey % 5 = 0""",
    # review_id repeats, order_id repeats, the pair is unique; newlines inside messages
    "order_reviews": """
SELECT CAST(CAST(floor((event_id + 1) / 2) AS BIGINT) AS STRING) AS review_id, CAST(event_id - event_id % 2 AS STRING) AS order_id,
 CAST(1 + (user_id + event_id) % 5 AS BIGINT) AS review_score,
 CASE WHEN event_id % 8 = 0 THEN event_type END AS review_comment_title,
 CASE WHEN event_id % 5 < 2 THEN concat(props, chr(10), event_type) END AS review_comment_message,
 ts AS review_creation_date, ts + INTERVAL '1' MINUTE * CAST(floor(value) AS BIGINT) AS review_answer_timestamp
FROM {events}""",
}

RAW = ["category_translation", "customers", "sellers", "products", "geolocation_raw",
       "orders", "order_items", "order_payments", "order_reviews"]


# layers that only select from given tables
SELECTED = {
    "stg_sellers", "stg_products", "stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews",
    "fct_order_items", "fct_order_payments", "fct_order_reviews",
}


def given_tables(text: str) -> list[str]:
    """Given tables a text refers to."""
    return sorted({name for _, name, _, _ in string.Formatter().parse(text) if name})


# reading a schema from the files costs a job, so each path is asked once
_SCHEMAS: dict[str, StructType] = {}


class LazyTables(Mapping):
    """Named plans, each built on first use only: most queries need two or three."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


class Marketplace:
    """Lazy raw tables, staging and marts over one folder of the given tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._given: dict[str, DataFrame] = {}
        self.raw = LazyTables({name: partial(self.adapter, name) for name in RAW})
        self.staging = LazyTables({
            ("geolocation" if name == "geolocation_raw" else name): partial(self._staged, name) for name in RAW
        })
        m = self.staging
        self.marts = LazyTables({
            "dim_customers": lambda: star.dim_customers(m["customers"], self.geo),
            "dim_sellers": lambda: star.dim_sellers(self.sellers_history, self.geo),
            "dim_products": lambda: star.dim_products(m["products"], m["category_translation"]),
            "dim_date": lambda: star.dim_date_covering(m["orders"]),
            "fct_orders": lambda: star.fct_orders(m["orders"], m["order_items"]),
            "fct_order_items": lambda: star.fct_order_items(m["order_items"]),
            "fct_order_payments": lambda: star.fct_order_payments(m["order_payments"]),
            "fct_order_reviews": lambda: star.fct_order_reviews(m["order_reviews"]),
        })

    def given(self, name: str) -> DataFrame:
        if name not in self._given:
            path = f"{self.sf_dir}/{name}.parquet"
            if path not in _SCHEMAS:
                _SCHEMAS[path] = self.spark.read.parquet(path).schema
            self._given[name] = self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        return self._given[name]

    def adapter(self, name: str) -> DataFrame:
        text = ADAPTERS[name]
        return self.spark.sql(text, **{t: self.given(t) for t in given_tables(text)})

    def _staged(self, name: str) -> DataFrame:
        return next(iter(build_staging({name: self.raw[name]}).values()))

    @cached_property
    def geo(self) -> DataFrame:
        return geo_by_zip(self.staging["geolocation"])

    @cached_property
    def sellers_history(self) -> DataFrame:
        """Two snapshot runs."""
        first = first_snapshot(self.raw["sellers"], RUN_1)
        return snapshot_check(first, self.adapter("sellers_v2"), "seller_id", SELLER_COLS, RUN_2, validate=False)

    @cached_property
    def asking_prices(self) -> DataFrame:
        return materialise(self.adapter("asking_prices"), "asking-prices")

    @cached_property
    def seller_lookup(self) -> DataFrame:
        """The seller columns facts look up, written first as a build would: with a size read from files, the
        planner broadcasts a small dimension at once instead of first shuffling the fact for it."""
        return materialise(self.marts["dim_sellers"].select("seller_id", "seller_state", "is_current"), "sellers")

    @cached_property
    def product_lookup(self) -> DataFrame:
        return materialise(self.marts["dim_products"].select("product_id", "product_category_name_english"), "products")

    def layers(self, columns: Mapping[str, Iterable[str]] | None = None) -> LazyTables:
        """Staging tables as ``stg_<name>`` together with the marts. Those that join or group are written when first asked
        for: a report's many checks then read columns of files instead of building the table again; the others only select
        from files, which costs less than to write and read them. ``columns`` names the tables that a report looks at, and
        what it reads of each: they are written at once with these alone, side by side, as one small table does not fill a
        cluster."""
        wanted = {name: list(read) for name, read in (columns or {}).items()}

        def table(tables: Mapping[str, DataFrame], name: str, label: str) -> DataFrame:
            df = tables[name].select(*wanted[label]) if label in wanted else tables[name]
            return df if label in SELECTED else materialise(df, name)

        tables = LazyTables({
            **{f"stg_{name}": partial(table, self.staging, name, f"stg_{name}") for name in self.staging},
            **{name: partial(table, self.marts, name, name) for name in self.marts},
        })
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(tables.__getitem__, wanted))
        return tables
