"""Check SQL for each registered query, written against the given tables."""

from __future__ import annotations

import re

from mercato.constants import BOUNDING_BOX, WARN_ABOVE
from mercato.operators.quality import ACCEPTED, EXPRESSION, NOT_NULL, RELATIONSHIP, UNIQUE, UNIQUE_COMBO
from mercato.plans.checks import CHECKS, EXTRA_CHECKS, PROFILED_KEYS, REFERENCES
from mercato.schemas import TABLES
from workload.adapters import ADAPTERS, RAW, given_tables

_LAT, _LNG = BOUNDING_BOX["lat"], BOUNDING_BOX["lng"]

# named intermediate results; raw_* are the adapters
_VIEWS: dict[str, str] = {
    f"raw_{name}": text.format(**{t: t for t in given_tables(text)}) for name, text in ADAPTERS.items()
}
_VIEWS |= {
    "places": f"""
SELECT DISTINCT * FROM raw_geolocation_raw
WHERE geolocation_lat >= {_LAT[0]} AND geolocation_lat <= {_LAT[1]}
  AND geolocation_lng >= {_LNG[0]} AND geolocation_lng <= {_LNG[1]}""",
    "zip_points": """
SELECT geolocation_zip_code_prefix AS zip, sum(geolocation_lat) / count(*) AS lat, sum(geolocation_lng) / count(*) AS lng
FROM places GROUP BY 1""",
    "products_fixed": """
SELECT * EXCLUDE (product_name_lenght, product_description_lenght), product_name_lenght AS product_name_length,
 product_description_lenght AS product_description_length FROM raw_products""",
    "history": """
SELECT a.seller_id, a.seller_zip_code_prefix, a.seller_city, a.seller_state, TIMESTAMP '1998-01-01' AS valid_from,
 CASE WHEN b.seller_id IS NOT NULL AND (a.seller_zip_code_prefix, a.seller_city, a.seller_state)
   IS DISTINCT FROM (b.seller_zip_code_prefix, b.seller_city, b.seller_state) THEN TIMESTAMP '2000-01-01' END AS valid_to
FROM raw_sellers a LEFT JOIN raw_sellers_v2 b ON a.seller_id = b.seller_id
UNION ALL
SELECT b.*, TIMESTAMP '2000-01-01', NULL FROM raw_sellers_v2 b
WHERE b NOT IN (SELECT s FROM raw_sellers s)""",
    "d_customers": """
SELECT c.*, z.lat AS customer_lat, z.lng AS customer_lng
FROM raw_customers c LEFT JOIN zip_points z ON z.zip = c.customer_zip_code_prefix""",
    "d_sellers": """
SELECT h.seller_id, h.seller_zip_code_prefix, h.seller_city, h.seller_state, z.lat AS seller_lat, z.lng AS seller_lng,
 h.valid_from, h.valid_to, h.valid_to IS NULL AS is_current
FROM history h LEFT JOIN zip_points z ON z.zip = h.seller_zip_code_prefix""",
    "d_products": """
SELECT p.*, t.product_category_name_english
FROM products_fixed p LEFT JOIN raw_category_translation t USING (product_category_name)""",
    "d_date": """
SELECT CAST(d AS DATE) AS date_day, CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month,
 CAST(day(d) AS BIGINT) AS day, CAST(dayofweek(d) + 1 AS BIGINT) AS day_of_week, dayname(d) AS day_name,
 monthname(d) AS month_name, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT unnest(generate_series(date_trunc('year', min(order_purchase_timestamp)),
  date_trunc('year', max(order_purchase_timestamp)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM raw_orders)""",
    "f_orders": """
SELECT o.*, CAST(o.order_purchase_timestamp AS DATE) AS order_purchase_date, coalesce(n.item_count, 0) AS item_count,
 coalesce(o.order_delivered_customer_date > o.order_estimated_delivery_date, false) AS is_late_delivery,
 coalesce(o.order_delivered_carrier_date < o.order_approved_at, false) AS is_carrier_before_approved,
 o.order_status = 'delivered' AND o.order_delivered_customer_date IS NULL AS is_delivered_missing_date,
 n.item_count IS NULL AS has_no_line_items
FROM raw_orders o LEFT JOIN (SELECT order_id, count(*) AS item_count FROM raw_order_items GROUP BY ALL) n USING (order_id)""",
    "f_items": "SELECT *, price + freight_value AS total_item_value FROM raw_order_items",
    "f_reviews": """
SELECT *, date_sub('hour', review_creation_date, review_answer_timestamp) AS hours_to_answer FROM raw_order_reviews""",
    "l_orders": """
SELECT order_id, order_purchase_date, order_status, is_late_delivery, is_carrier_before_approved,
 is_delivered_missing_date, has_no_line_items, customer_id, customer_state
FROM f_orders JOIN raw_customers USING (customer_id)""",
    "l_items": """
SELECT i.order_id, o.order_purchase_date, i.total_item_value, p.product_category_name_english, s.seller_id, s.seller_state
FROM f_items i, f_orders o, history s, d_products p
WHERE i.order_id = o.order_id AND s.seller_id = i.seller_id AND s.valid_to IS NULL AND p.product_id = i.product_id""",
    "l_payments": """
SELECT order_purchase_date, payment_type, payment_value FROM raw_order_payments JOIN f_orders USING (order_id)""",
    "l_reviews": """
SELECT r.review_id, r.review_score, l.order_purchase_date, o.is_late_delivery, l.product_category_name_english, l.seller_id
FROM raw_order_reviews r JOIN l_items l USING (order_id) JOIN f_orders o USING (order_id)""",
    "legs": """
SELECT customer_state, count(*) AS delivered_orders,
 avg(CAST(order_delivered_customer_date AS DATE) - order_purchase_date) AS avg_delivery_days,
 count(*) FILTER (is_late_delivery) / count(*) AS late_rate_delivered,
 avg(CAST(order_delivered_carrier_date AS DATE) - CAST(order_approved_at AS DATE)) AS avg_seller_handling_days,
 avg(CAST(order_delivered_customer_date AS DATE) - CAST(order_delivered_carrier_date AS DATE)) AS avg_carrier_transit_days
FROM f_orders JOIN raw_customers USING (customer_id)
WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL GROUP BY customer_state""",
    "persons": """
SELECT c.customer_unique_id, count(*) AS order_count, CAST(sum(w.worth) AS DECIMAL(38,9)) AS lifetime_value,
 max(o.order_purchase_date) AS last_purchase_date
FROM f_orders o JOIN raw_customers c USING (customer_id)
LEFT JOIN (SELECT order_id, sum(total_item_value) AS worth FROM f_items GROUP BY 1) w USING (order_id)
WHERE o.order_status <> 'canceled' AND o.order_status <> 'unavailable' GROUP BY 1""",
    "scored": """
SELECT *, ntile(4) OVER (ORDER BY last_purchase_date, customer_unique_id) AS r_score,
 ntile(4) OVER (ORDER BY order_count, customer_unique_id) AS f_score,
 ntile(4) OVER (ORDER BY lifetime_value NULLS FIRST, customer_unique_id) AS m_score
FROM persons""",
    "segmented": """
SELECT *, CASE WHEN m_score = 4 AND r_score IN (3, 4) THEN 'gold' WHEN m_score IN (3, 4) AND r_score <> 1 THEN 'silver'
 WHEN order_count >= 2 THEN 'repeat' WHEN r_score = 1 THEN 'lapsed' ELSE 'standard' END AS customer_segment
FROM scored""",
}


def _needs(sql: str, found: dict[str, None]) -> dict[str, None]:
    """Names of the views ``sql`` uses, each after the ones it builds on."""
    for name in re.findall(r"\b[a-z_0-9]+\b", sql):
        if name in _VIEWS and name not in found:
            _needs(_VIEWS[name], found)
            found[name] = None
    return found


def _sql(body: str) -> str:
    views = ",\n".join(f"{name} AS ({_VIEWS[name].strip()})" for name in _needs(body, {}))
    return f"WITH {views}\n{body.strip()}" if views else body.strip()


def _columns(table: str) -> str:
    return f"SELECT {', '.join(TABLES[table].columns)} FROM raw_{table}"


def _upsert_orders() -> str:
    return """
SELECT * FROM raw_orders_v2
UNION ALL SELECT * FROM raw_orders WHERE order_id NOT IN (SELECT order_id FROM raw_orders_v2)"""


_YEAR = "order_purchase_date >= DATE '1997-01-01' AND order_purchase_date <= DATE '1997-12-31'"
_STATES = "customer_state IN ('NATION_3', 'NATION_17')"
_CATEGORIES = "product_category_name_english IN ('economy_brand#2', 'standard_brand#17', 'promo_brand#5')"
_NAMED = "product_category_name_english IS NOT NULL"
_MONTH = "CAST(date_trunc('month', order_purchase_date) AS DATE) AS month"
_FLAGS = ["is_late_delivery", "is_carrier_before_approved", "is_delivered_missing_date", "has_no_line_items"]

_SATISFACTION = """
 round(avg(review_score), 6) AS avg_review_score,
 round(coalesce(100.0 * count(*) FILTER (review_score <= 2) / nullif(count(*), 0), 0), 6) AS low_score_pct,
 round(avg(review_score) FILTER (NOT is_late_delivery) - avg(review_score) FILTER (is_late_delivery), 6) AS on_time_minus_late"""

# checked layers -> the views above
_LAYERS = {f"stg_{name}": f"raw_{name}" for name in RAW} | {
    "stg_products": "products_fixed", "stg_geolocation": "places",
    "dim_customers": "d_customers", "dim_sellers": "d_sellers", "dim_products": "d_products", "dim_date": "d_date",
    "fct_orders": "f_orders", "fct_order_items": "f_items", "fct_order_payments": "raw_order_payments",
    "fct_order_reviews": "f_reviews",
}


def _failures(check) -> str:
    source, columns = _LAYERS[check.table], ", ".join(check.columns)
    column = check.columns[0]
    if check.kind == NOT_NULL:
        return f"SELECT count(*) FROM {source} WHERE {column} IS NULL"
    if check.kind == EXPRESSION:
        return f"SELECT count(*) FROM {source} WHERE NOT ({column} {check.expression})"
    if check.kind in (UNIQUE, UNIQUE_COMBO):
        present = f"WHERE {column} IS NOT NULL" if check.kind == UNIQUE else ""
        return f"SELECT count(*) FROM (SELECT 1 FROM {source} {present} GROUP BY {columns} HAVING count(*) > 1)"
    if check.kind == ACCEPTED:
        return f"SELECT count(DISTINCT {column}) FROM {source} WHERE {column} NOT IN {check.values}"
    parent, parent_column = check.parent
    return (f"SELECT count(*) FROM {source} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {_LAYERS[parent]} p WHERE p.{parent_column} = c.{column})")


def _report(*kinds: str) -> str:
    lines = []
    for check in CHECKS + EXTRA_CHECKS:
        if kinds and check.kind not in kinds:
            continue
        warns = check.table == "fct_orders" and check.kind == EXPRESSION
        limit = WARN_ABOVE[check.columns[0]] if warns else 0
        lines.append(
            f"SELECT '{check.name}' AS check_name, '{check.kind}' AS kind, '{check.table}' AS table_name, "
            f"'{', '.join(check.columns)}' AS column_name, ({_failures(check)}) AS failures, "
            f"'{'warn' if warns else 'error'}' AS severity, CAST({limit} AS BIGINT) AS threshold")
    body = "\nUNION ALL ".join(lines)
    return f"SELECT *, CASE WHEN failures <= threshold THEN 'pass' ELSE severity END AS status FROM ({body})"


def _rates() -> str:
    lines = []
    for check in CHECKS:
        if check.severity == "warn":
            lines.append(
                f"SELECT '{check.name}' AS check_name, '{check.kind}' AS kind, 'fct_orders' AS table_name, "
                f"'{check.columns[0]}' AS column_name, count(*) FILTER ({check.columns[0]}) AS failures, "
                f"'warn' AS severity, CAST(floor(count(*) * 0.05) AS BIGINT) AS threshold FROM f_orders")
    return (f"SELECT *, CASE WHEN failures <= threshold THEN 'pass' ELSE severity END AS status "
            f"FROM ({' UNION ALL '.join(lines)})")


def _union(lines: list[str]) -> str:
    return "\nUNION ALL ".join(lines)


def _nulls() -> str:
    lines = [
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS null_count, "
        f"round(100.0 * (count(*) - count({c})) / nullif(count(*), 0), 2) AS null_pct FROM raw_{name}"
        for name in RAW for c in TABLES[name].columns
    ]
    return f"SELECT * FROM ({_union(lines)}) WHERE null_count > 0"


def _duplicates() -> str:
    return _union([
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM raw_{name}) AS total_rows, "
        f"(SELECT count(*) FROM raw_{name}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_{name})) AS duplicate_rows"
        for name in RAW
    ])


def _keys() -> str:
    lines = []
    for name, keys in PROFILED_KEYS:
        distinct = f"count(DISTINCT {keys[0]})" if len(keys) == 1 else f"count(DISTINCT ({', '.join(keys)}))"
        lines.append(
            f"SELECT '{name}' AS table_name, '{', '.join(keys)}' AS key_columns, count(*) AS total_rows, "
            f"{distinct} AS distinct_keys, count(*) - {distinct} AS excess_rows FROM raw_{name}")
    return _union(lines)


def _orphans() -> str:
    lines = []
    for child, column, parent, parent_column in REFERENCES:
        lines.append(f"""
SELECT '{child}.{column} -> {parent}.{parent_column}' AS reference, count(*) AS distinct_values,
 count(*) FILTER (k NOT IN (SELECT {parent_column} FROM raw_{parent})) AS orphan_values,
 round(100.0 * count(*) FILTER (k NOT IN (SELECT {parent_column} FROM raw_{parent})) / greatest(count(*), 1), 3) AS orphan_pct
FROM (SELECT DISTINCT {column} AS k FROM raw_{child} WHERE {column} IS NOT NULL)""")
    return _union(lines)


def _ranges() -> str:
    columns = [
        ("orders", "order_purchase_timestamp", "timestamp_ntz"), ("orders", "order_approved_at", "timestamp_ntz"),
        ("orders", "order_estimated_delivery_date", "timestamp_ntz"),
        ("order_items", "price", "decimal(28,9)"), ("order_items", "freight_value", "decimal(28,9)"),
        ("order_items", "shipping_limit_date", "timestamp_ntz"),
        ("order_payments", "payment_value", "decimal(28,9)"), ("order_payments", "payment_installments", "bigint"),
        ("order_reviews", "review_score", "bigint"), ("order_reviews", "review_creation_date", "timestamp_ntz"),
        ("products", "product_weight_g", "decimal(28,9)"), ("products", "product_photos_qty", "bigint"),
    ]
    return _union([
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS column_type, count({c}) AS non_null, "
        f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM raw_{t}"
        for t, c, kind in columns
    ])


def _sanity() -> str:
    measures = [
        ("order_items", "price", "<= 0", "price", "price <= 0"),
        ("order_items", "freight_value", "< 0", "freight_value", "freight_value < 0"),
        ("order_payments", "payment_value", "<= 0", "payment_value", "payment_value <= 0"),
        ("order_payments", "payment_installments", "= 0", "payment_installments", "payment_installments = 0"),
        ("products", "product_weight_g", "= 0", "product_weight_g", "product_weight_g = 0"),
        ("products", "any_dimension", "= 0", "least(product_length_cm, product_height_cm, product_width_cm)",
         "product_length_cm = 0 OR product_height_cm = 0 OR product_width_cm = 0"),
    ]
    return _union([
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{rule}' AS rule, "
        f"CAST(min({value}) AS DECIMAL(28,9)) AS min_value, CAST(max({value}) AS DECIMAL(28,9)) AS max_value, "
        f"count(*) FILTER ({bad}) AS violations FROM raw_{t}"
        for t, c, rule, value, bad in measures
    ])


def _merge_report() -> str:
    def keyed(name: str, batch: str, key: str) -> str:
        known = f"{key} IN (SELECT {key} FROM raw_{name})"
        return (f"SELECT '{name}' AS table_name, count(*) AS rows_staged, count(*) FILTER (NOT {known}) AS rows_inserted, "
                f"count(*) FILTER ({known}) AS rows_updated, count(*) AS rows_merged FROM {batch}")

    places = """
SELECT 'geolocation_raw', count(*), count(*) FILTER (NOT known), 0, count(*) FILTER (NOT known)
FROM (SELECT b IN (SELECT t FROM raw_geolocation_raw t) AS known FROM raw_geolocation_v2 b)"""
    return _union([keyed("orders", "raw_orders_v2", "order_id"), keyed("sellers", "raw_sellers_v2", "seller_id"), places])


def _landed() -> str:
    known = "order_id IN (SELECT order_id FROM raw_orders)"
    lines = [
        f"SELECT '{t}' AS table_name, count(*) AS rows_held, count(*) AS rows_staged, count(*) AS rows_inserted, "
        f"CAST(0 AS BIGINT) AS rows_updated, true AS is_complete "
        f"FROM (SELECT {'DISTINCT ' + ', '.join(TABLES[t].keys) if TABLES[t].keys else '*'} FROM raw_{t})"
        for t in RAW if t != "orders"]
    return _union([*lines, f"""
SELECT 'orders', first + fresh, first + second, first + fresh, second - fresh, true
FROM (SELECT (SELECT count(*) FROM raw_orders) AS first, count(*) AS second, count(*) FILTER (NOT {known}) AS fresh FROM raw_orders_v2)"""])


def _value_counts() -> str:
    return _union([
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS value_count "
        f"FROM raw_{t} WHERE {c} IS NOT NULL GROUP BY {c}"
        for t, c in [("orders", "order_status"), ("order_payments", "payment_type"), ("order_reviews", "review_score")]
    ])


_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"

_AT_TIME = """
SELECT i.order_id, i.order_item_id, i.seller_id, i.shipping_limit_date, i.price, h.seller_zip_code_prefix, h.seller_state,
 h.valid_from, h.valid_to, h.valid_to IS NULL AS is_current
FROM raw_order_items i {how} JOIN history h ON i.seller_id = h.seller_id AND {within}"""


def _bodies() -> dict[str, str]:
    return {
        "coerce_types": """
SELECT order_id, TRY_CAST(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_timestamp,
 TRY_CAST(order_estimated_delivery_date AS TIMESTAMP) AS order_estimated_delivery_date,
 TRY_CAST(customer_number AS BIGINT) AS customer_number FROM raw_orders_text""",
        "load_audit": "SELECT *, 'orders.csv' AS _source_file, TIMESTAMP '2024-01-01' AS _loaded_at FROM raw_orders",
        "append_load": """
SELECT payment_type, payment_sequential, 2 * count(*) AS rows, CAST(2 * sum(payment_value) AS DECIMAL(38,9)) AS payment_value
FROM raw_order_payments GROUP BY ALL""",
        "stream_upsert": _upsert_orders(),
        "mart_rebuild": f"""
SELECT order_status, coalesce(order_delivered_customer_date > order_estimated_delivery_date, false) AS is_late_delivery,
 count(*) AS orders, CAST(sum(coalesce(n, 0)) AS BIGINT) AS items, CAST(2 AS BIGINT) AS version
FROM ({_upsert_orders()}) LEFT JOIN (SELECT order_id, count(*) AS n FROM raw_order_items GROUP BY 1) USING (order_id)
GROUP BY 1, 2""",
        "merge_report": _merge_report(),
        "landing_routed": _landed(),
        "batch_completeness": f"""
SELECT table_name, n > 0 AS is_loaded, CAST(sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) OVER () AS BIGINT) AS tables_loaded,
 count(*) OVER () AS tables_expected, bool_and(n > 0) OVER () AS is_complete
FROM ({_union([
    f"SELECT '{t}' AS table_name, count(*) AS n FROM " + ("raw_" + t if t != "category_translation" else "(SELECT 1 WHERE false)")
    for t in RAW])})""",
        "stg_select": _columns("orders"),
        "stg_customers": _columns("customers"),
        "stg_sellers": _columns("sellers"),
        "stg_category_translation": _columns("category_translation"),
        "stg_order_items": _columns("order_items"),
        "stg_order_payments": _columns("order_payments"),
        "stg_order_reviews": _columns("order_reviews"),
        "stg_products": "SELECT * FROM products_fixed",
        "geo_clean": """
SELECT geolocation_zip_code_prefix, round(geolocation_lat, 6) AS geolocation_lat, round(geolocation_lng, 6) AS geolocation_lng,
 geolocation_city, geolocation_state FROM places""",
        "geo_by_zip": "SELECT zip AS zip_code_prefix, round(lat, 6) AS lat, round(lng, 6) AS lng FROM zip_points",
        "dim_customers": """
SELECT * REPLACE (round(customer_lat, 6) AS customer_lat, round(customer_lng, 6) AS customer_lng) FROM d_customers""",
        "dim_sellers": """
SELECT * REPLACE (round(seller_lat, 6) AS seller_lat, round(seller_lng, 6) AS seller_lng) FROM d_sellers""",
        "dim_products": "SELECT * FROM d_products",
        "dim_date": "SELECT * FROM d_date",
        "fct_orders": "SELECT * FROM f_orders",
        "fct_order_items": "SELECT * FROM f_items",
        "fct_order_payments": _columns("order_payments"),
        "fct_order_reviews": "SELECT * FROM f_reviews",
        "order_flags": f"SELECT order_id, {', '.join(_FLAGS)} FROM f_orders",
        "upsert_keyed": _upsert_orders(),
        "upsert_full_row": """
SELECT * REPLACE (round(geolocation_lat, 6) AS geolocation_lat, round(geolocation_lng, 6) AS geolocation_lng)
FROM (SELECT * FROM raw_geolocation_raw
 UNION ALL SELECT b.* FROM raw_geolocation_v2 b WHERE b NOT IN (SELECT t FROM raw_geolocation_raw t))""",
        "upsert_cold_start": _columns("orders"),
        "snapshot_check": "SELECT * FROM history",
        "pit_join": _AT_TIME.format(
            how="", within="i.shipping_limit_date BETWEEN h.valid_from AND coalesce(h.valid_to, TIMESTAMP '9999-12-31')"),
        "pit_join_backfill": _AT_TIME.format(how="LEFT", within="""
 i.shipping_limit_date < coalesce(h.valid_to, TIMESTAMP '9999-12-31') AND (i.shipping_limit_date >= h.valid_from
  OR h.valid_from = (SELECT min(f.valid_from) FROM history f WHERE f.seller_id = h.seller_id))"""),
        "pit_join_bucketed": """
SELECT i.order_id, i.order_item_id, i.product_id, o.order_purchase_timestamp, p.asking_price, p.valid_from, p.valid_to
FROM raw_order_items i JOIN raw_orders o USING (order_id) JOIN raw_asking_prices p ON p.product_id = i.product_id
 AND o.order_purchase_timestamp BETWEEN p.valid_from AND coalesce(p.valid_to, TIMESTAMP '9999-12-31')""",
        "load_orders": "SELECT * FROM l_orders",
        "load_order_items": "SELECT * FROM l_items",
        "load_items_bucketed": "SELECT * FROM l_items",
        "filter_items_by_month": f"SELECT * FROM l_items WHERE {_YEAR} AND {_CATEGORIES}",
        "load_payments": "SELECT * FROM l_payments",
        "load_reviews": "SELECT * FROM l_reviews",
        "filter_date": f"SELECT * FROM l_orders WHERE {_YEAR}",
        "filter_date_state": f"SELECT * FROM l_orders WHERE {_YEAR} AND {_STATES}",
        "filter_date_category": f"SELECT * FROM l_items WHERE {_NAMED}",
        "filter_date_category_list": f"SELECT * FROM l_items WHERE {_YEAR} AND {_CATEGORIES}",
        "filter_options": f"""
SELECT 'min_date' AS filter, CAST(min(order_purchase_date) AS VARCHAR) AS option FROM l_orders
UNION ALL SELECT 'max_date', CAST(max(order_purchase_date) AS VARCHAR) FROM l_orders
UNION ALL SELECT DISTINCT 'state', customer_state FROM l_orders WHERE customer_state IS NOT NULL
UNION ALL SELECT DISTINCT 'category', product_category_name_english FROM l_items WHERE {_NAMED}""",
        "kpi_sales": f"""
SELECT total_revenue, total_orders, round(CAST(total_revenue AS DOUBLE) / total_orders, 6) AS avg_order_value
FROM (SELECT (SELECT CAST(sum(payment_value) AS DECIMAL(38,9)) FROM l_payments) AS total_revenue,
 (SELECT count(DISTINCT order_id) FROM l_items WHERE {_NAMED}) AS total_orders)""",
        "monthly_revenue": f"""
SELECT {_MONTH}, CAST(sum(payment_value) AS DECIMAL(38,9)) AS revenue FROM l_payments GROUP BY 1""",
        "top_categories": f"""
SELECT product_category_name_english, CAST(sum(total_item_value) AS DECIMAL(38,9)) AS revenue FROM l_items
WHERE {_NAMED} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
        "kpi_delivery": f"""
SELECT round(100.0 * count(*) FILTER (is_late_delivery) / count(*), 6) AS late_rate_all,
 count(*) FILTER (is_late_delivery) AS late_orders,
 round((SELECT avg(avg_delivery_days) FROM legs), 6) AS avg_state_delivery_days
FROM l_orders WHERE {_YEAR} AND {_STATES}""",
        "delivery_legs": """
SELECT customer_state, delivered_orders, round(avg_delivery_days, 6) AS avg_delivery_days,
 round(late_rate_delivered, 6) AS late_rate_delivered, round(avg_seller_handling_days, 6) AS avg_seller_handling_days,
 round(avg_carrier_transit_days, 6) AS avg_carrier_transit_days FROM legs""",
        "monthly_anomaly_rates": _union([
            f"SELECT {_MONTH}, '{f}' AS flag, round(100.0 * count(*) FILTER ({f}) / count(*), 6) AS rate_pct "
            "FROM l_orders GROUP BY 1" for f in _FLAGS[:3]]),
        "anomaly_counts": _union([
            f"SELECT '{f}' AS flag, count(*) FILTER ({f}) AS orders FROM l_orders" for f in _FLAGS]),
        "monthly_volume_late": f"""
SELECT {_MONTH}, count(*) AS orders, round(count(*) FILTER (is_late_delivery) / count(*), 6) AS late_rate_all
FROM l_orders GROUP BY 1""",
        "kpi_satisfaction": f"SELECT {_SATISFACTION} FROM l_reviews WHERE {_NAMED}",
        "kpi_satisfaction_per_review": f"""
SELECT {_SATISFACTION} FROM raw_order_reviews JOIN f_orders USING (order_id)""",
        "review_histogram": "SELECT review_score, count(*) AS reviews FROM l_reviews GROUP BY 1",
        "score_by_lateness": """
SELECT if(is_late_delivery, 'Late', 'On time') AS delivery, round(avg(review_score), 6) AS avg_review_score
FROM l_reviews GROUP BY 1""",
        "lowest_rated_categories": f"""
SELECT product_category_name_english, round(mean, 6) AS avg_review_score
FROM (SELECT product_category_name_english, CAST(sum(review_score) AS DOUBLE) / count(*) AS mean
 FROM l_reviews WHERE {_NAMED} GROUP BY 1 ORDER BY 2, 1 LIMIT 15)""",
        "kpi_marketplace": f"""
SELECT round(100.0 * count(*) FILTER (order_status = 'delivered') / count(*), 6) AS delivered_pct,
 round(100.0 * count(*) FILTER (order_status = 'canceled') / count(*), 6) AS canceled_pct,
 (SELECT count(DISTINCT seller_id) FROM l_items WHERE {_NAMED}) AS active_sellers
FROM l_orders WHERE customer_state IS NOT NULL""",
        "top_sellers": f"""
SELECT seller_id, CAST(sum(total_item_value) AS DECIMAL(38,9)) AS revenue FROM l_items
WHERE {_YEAR} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
        "orders_by_status": "SELECT order_status, count(*) AS orders FROM l_orders GROUP BY 1",
        "sellers_by_state": "SELECT seller_state, count(DISTINCT seller_id) AS sellers FROM l_items GROUP BY 1",
        "revenue_share_by_state": """
SELECT customer_state, revenue, round(CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER () AS DOUBLE), 6) AS revenue_share
FROM (SELECT customer_state, CAST(sum(payment_value) AS DECIMAL(38,9)) AS revenue
 FROM raw_order_payments JOIN l_orders USING (order_id) GROUP BY 1)""",
        "headline_shares": """
SELECT round(avg(CASE WHEN is_late_delivery THEN 1 ELSE 0 END), 6) AS late_rate_delivered,
 round((SELECT count(*) FILTER (review_score < 3) / count(*) FROM raw_order_reviews JOIN raw_orders USING (order_id)), 6)
  AS low_score_share
FROM f_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL""",
        "rfm_per_customer": "SELECT * FROM persons",
        "rfm_scored": "SELECT * FROM scored",
        "rfm_segments": "SELECT * FROM segmented",
        "segment_summary": """
SELECT customer_segment, count(*) AS customers, CAST(coalesce(sum(lifetime_value), 0) AS DECIMAL(38,9)) AS revenue,
 round(avg(CAST(lifetime_value AS DOUBLE)), 6) AS avg_ltv, round(avg(order_count), 6) AS avg_orders,
 round(CAST(sum(lifetime_value) AS DOUBLE) / (SELECT CAST(sum(lifetime_value) AS DOUBLE) FROM persons), 6) AS revenue_share,
 round(count(*) / (SELECT count(*) FROM persons), 6) AS customer_share
FROM segmented GROUP BY 1""",
        "kpi_segments": """
SELECT count(*) AS total_customers, round(count(*) FILTER (order_count > 1) / count(*), 6) AS repeat_rate,
 count(*) FILTER (customer_segment = 'gold') AS gold_customers,
 round(CAST(sum(lifetime_value) FILTER (customer_segment = 'gold') AS DOUBLE) / CAST(sum(lifetime_value) AS DOUBLE), 6)
  AS gold_revenue_share
FROM segmented""",
        "dq_unique": _report(UNIQUE),
        "dq_not_null": _report(NOT_NULL),
        "dq_relationships": _report(RELATIONSHIP),
        "dq_accepted_values": _report(ACCEPTED),
        "dq_expression": _report(EXPRESSION),
        "dq_unique_combo": _report(UNIQUE_COMBO),
        "dq_report": _report(),
        "dq_report_rates": _rates(),
        "dq_flags": f"""
SELECT table_name, record_id, rule_name, detail, TIMESTAMP '2024-01-01' AS flagged_at FROM (
SELECT 'orders' AS table_name, order_id AS record_id, 'carrier_date_before_approved_at' AS rule_name,
 'carrier=' || {_STAMP.format('order_delivered_carrier_date')} || ' approved=' || {_STAMP.format('order_approved_at')} AS detail
FROM raw_orders WHERE order_delivered_carrier_date < order_approved_at
UNION ALL SELECT 'orders', order_id, 'delivered_but_missing_date', order_status
FROM raw_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NULL
UNION ALL SELECT 'orders', order_id, 'late_delivery', 'delivered=' || {_STAMP.format('order_delivered_customer_date')}
 || ' estimated=' || {_STAMP.format('order_estimated_delivery_date')}
FROM raw_orders WHERE order_delivered_customer_date > order_estimated_delivery_date
UNION ALL SELECT 'orders', order_id, 'no_line_items', order_status
FROM raw_orders WHERE order_id NOT IN (SELECT order_id FROM raw_order_items)
UNION ALL SELECT 'products', product_id, 'orphan_category', product_category_name
FROM raw_products WHERE product_category_name NOT IN (SELECT product_category_name FROM raw_category_translation))""",
        "constraint_split": """
SELECT order_id, customer_id, violations, violations = '' AS accepted FROM (
SELECT order_id, customer_id, concat_ws('; ',
 CASE WHEN order_approved_at < order_purchase_timestamp THEN 'approved after purchase' END,
 CASE WHEN order_delivered_customer_date < order_purchase_timestamp THEN 'delivered after purchase' END,
 CASE WHEN customer_id NOT IN (SELECT customer_id FROM raw_customers) THEN 'customer_id foreign key' END) AS violations
FROM raw_orders_v2)""",
        "profile_nulls": _nulls(),
        "profile_duplicates": _duplicates(),
        "profile_keys": _keys(),
        "profile_shape": _union([
            f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST({len(TABLES[t].columns)} AS BIGINT) AS column_count "
            f"FROM raw_{t}" for t in RAW]),
        "profile_ranges": _ranges(),
        "profile_values": _value_counts(),
        "fk_orphans": _orphans(),
        "childless_orders": _union([
            f"SELECT '{t}' AS child_table, count(*) AS orders_without FROM raw_orders "
            f"WHERE order_id NOT IN (SELECT order_id FROM raw_{t})"
            for t in ("order_items", "order_payments", "order_reviews")]),
        "zip_coverage": _union([
            f"SELECT '{t}' AS table_name, count(DISTINCT {c}) FILTER ({c} NOT IN "
            f"(SELECT geolocation_zip_code_prefix FROM raw_geolocation_raw)) AS missing_zips, "
            f"count(DISTINCT {c}) AS total_zips FROM raw_{t}"
            for t, c in [("customers", "customer_zip_code_prefix"), ("sellers", "seller_zip_code_prefix")]]),
        "date_logic": """
SELECT min(order_purchase_timestamp) AS first_purchase, max(order_purchase_timestamp) AS last_purchase,
 count(*) FILTER (order_delivered_customer_date < order_purchase_timestamp) AS delivered_before_purchase,
 count(*) FILTER (order_approved_at < order_purchase_timestamp) AS approved_before_purchase,
 count(*) FILTER (order_delivered_carrier_date < order_approved_at) AS carrier_before_approved,
 count(*) FILTER (order_status = 'delivered' AND order_delivered_customer_date IS NULL) AS delivered_missing_date
FROM raw_orders_v2""",
        "numeric_sanity": _sanity(),
        "geo_outside": f"""
SELECT count(*) AS total_points, count(*) FILTER (bad) AS outside_points, round(min(geolocation_lat), 6) AS min_lat,
 round(max(geolocation_lat), 6) AS max_lat, round(min(geolocation_lng), 6) AS min_lng, round(max(geolocation_lng), 6) AS max_lng,
 round(100.0 * count(*) FILTER (bad) / count(*), 3) AS outside_pct
FROM (SELECT *, NOT (geolocation_lat BETWEEN {_LAT[0]} AND {_LAT[1]} AND geolocation_lng BETWEEN {_LNG[0]} AND {_LNG[1]}) AS bad
 FROM raw_geolocation_raw)""",
    }


# table, key, rules, references
_SPLITS = {
    "items": ("order_items", ("order_id", "order_item_id"), [
        ("price <= 0", "price positive"), ("freight_value < 0", "freight not negative")],
        [("order_id", "orders"), ("product_id", "products"), ("seller_id", "sellers")]),
    "payments": ("order_payments", ("order_id", "payment_sequential"), [
        ("payment_installments < 0", "instalments not negative"), ("payment_value < 0", "payment not negative")],
        [("order_id", "orders")]),
    "reviews": ("order_reviews", ("review_id", "order_id"), [
        ("review_score NOT BETWEEN 1 AND 5", "score 1 to 5")], [("order_id", "orders")]),
}


def _constraints(table: str, key: tuple[str, ...], rules: list, references: list) -> str:
    names = ", ".join(key)
    cases = [f"CASE WHEN {broken} THEN '{name}' END" for broken, name in rules]
    cases += [f"CASE WHEN {f.name} IS NULL THEN '{f.name} not null' END" for f in TABLES[table].schema if not f.nullable]
    cases.append(f"CASE WHEN count(*) OVER (PARTITION BY {names}) > 1 THEN 'unique {names}' END")
    cases += [f"CASE WHEN {c} NOT IN (SELECT {c} FROM raw_{parent}) THEN '{c} foreign key' END" for c, parent in references]
    return (f"SELECT {names}, violations, violations = '' AS accepted FROM "
            f"(SELECT {names}, concat_ws('; ', {', '.join(cases)}) AS violations FROM raw_{table})")


def all_oracles() -> dict[str, str]:
    bodies = _bodies()
    bodies |= {
        "snapshot_run": bodies["snapshot_check"],
        "gated_build": "SELECT 'fct_orders' AS mart, count(*) AS rows, 1 AS version FROM raw_orders "
                       "UNION ALL SELECT 'dim_customers', count(*), 1 FROM raw_customers",
        "csv_roundtrip": _union([
            f"SELECT '{t}' AS table_name, count(*) AS rows, 0 AS differ FROM raw_{t}" for t in RAW]),
    }
    bodies |= {f"constraint_split_{n}": _constraints(*parts) for n, parts in _SPLITS.items()}
    return {name: _sql(body) for name, body in bodies.items()}
