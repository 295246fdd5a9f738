"""Registered queries: each runs one operator or plan of the library over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators import filters, history, profiling, quality, upsert
from mercato.operators.filters import ALL, Selection
from mercato.functions.exprs import digest
from mercato.functions.frames import union_all
from mercato.plans import build, checks, dashboard, layout, loaders, segments, staging, star
from mercato.schemas import TABLES
from mercato.session import materialise, scratch_path, short_shuffles
from mercato.sources.files import coerce_types, read_table, with_audit
from mercato.sources.tables import HistoryTable, MergedTable, VersionedTable, append_rows, write_mart
from mercato.streaming import ingest
from workload.adapters import LOADED_AT, RAW, RUN_1, RUN_2, SELLER_COLS, Marketplace

Query = Callable[[SparkSession, str], DataFrame]

ONE_YEAR = Selection(date_range=(date(1997, 1, 1), date(1997, 12, 31)))
TWO_STATES = Selection(date_range=ONE_YEAR.date_range, states=("NATION_3", "NATION_17"))
TWO_CATEGORIES = Selection(
    date_range=ONE_YEAR.date_range, categories=("economy_brand#2", "standard_brand#17", "promo_brand#5"))
DEFAULT = Selection(states=ALL, categories=ALL)

_QUERIES: dict[str, Query] = {}


def _tidy(df: DataFrame) -> DataFrame:
    """Doubles to six digits, as sums of doubles depend on their order; whole numbers to one width."""
    columns = []
    for f in df.schema:
        if isinstance(f.dataType, T.DoubleType):
            columns.append(F.round(f.name, 6).alias(f.name))
        elif isinstance(f.dataType, T.IntegerType):
            columns.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def query(build: Callable[[Marketplace], DataFrame]) -> Callable[[Marketplace], DataFrame]:
    """Register ``build`` under its own name."""
    _QUERIES[build.__name__] = lambda spark, sf_dir: _tidy(build(Marketplace(spark, sf_dir)))
    return build


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# sources and sinks

@query
def coerce_types_(m):
    return coerce_types(
        m.adapter("orders_text"), ["order_purchase_timestamp", "order_estimated_delivery_date"], ["customer_number"])


@query
def load_audit(m):
    return with_audit(m.raw["orders"], "orders.csv", LOADED_AT)


@query
def append_load(m):
    """The payments appended twice: every row is there twice."""
    path = scratch_path(m.spark, "appended")
    append_rows(m.raw["order_payments"], path)
    append_rows(m.raw["order_payments"], path)
    return (
        m.spark.read.parquet(path).groupBy("payment_type", "payment_sequential")
        .agg(F.count("*").alias("rows"), F.sum("payment_value").alias("payment_value"))
    )


def _land(df: DataFrame, folder: str, **options: str) -> None:
    """Drop files into a landing folder as a producer would."""
    full = "yyyy-MM-dd HH:mm:ss.SSSSSS"  # the writer's default keeps milliseconds only
    df.write.mode("append").options(header="true", escape='"', timestampNTZFormat=full, **options).csv(folder)


@query
def stream_upsert(m):
    """Two drops of order files, each merged by its own run of the stream."""
    root = scratch_path(m.spark, "stream")
    table = MergedTable(m.spark, f"{root}/raw_orders", TABLES["orders"], buckets=8)
    for drop in ("orders", "orders_v2"):
        _land(m.adapter(drop), f"{root}/landing")
        ingest.stream_upsert(table, f"{root}/landing", f"{root}/progress")
    return table.read()


FILE_ROWS = 500_000  # of a landed file, in the mean: some 40 to 80 MB, as a file is read by one task


def _land_as(m, df, folder, name, keys, once=False):
    """Files of a given name, numbered if they are several, as the landing folder of all tables gets them.

    Their number grows with the rows. Rows are dealt by ``keys``, so that a key's rows, or the copies of a row, share a file;
    ``once`` leaves one row of each key. Several files are compressed, as each is read by one task in any case.
    """
    files = max(1, -(-df.count() // FILE_ROWS))
    stem, path = name.removesuffix(".csv"), f"{folder}-{name}"
    dealt = df.repartition(files, *keys)
    with short_shuffles(m.spark):
        _land(dealt.dropDuplicates(keys) if once else dealt, path, compression="none" if files == 1 else "gzip")
    fs_path = m.spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(folder).getFileSystem(m.spark._jsc.hadoopConfiguration())
    fs.mkdirs(fs_path(folder))
    parts = sorted(s.getPath().getName() for s in fs.listStatus(fs_path(path)) if s.getPath().getName().startswith("part-"))
    for i, part in enumerate(parts):
        fs.rename(fs_path(f"{path}/{part}"), fs_path(f"{folder}/{name}" if files == 1 else f"{folder}/{stem}-{i:05d}.csv.gz"))


@query
def landing_routed(m):
    """Files of all tables (each key once, as a file must) and a stranger in one landing folder, then a second drop of
    orders; what each table holds, what the log says was done to it, and whether all are loaded."""
    root = scratch_path(m.spark, "landing")
    tables = {name: MergedTable(m.spark, f"{root}/raw/{name}", TABLES[name], buckets=8) for name in RAW}
    log = ingest.load_log(m.spark, f"{root}/log")
    drops = [[(f"acme_{spec.stem}_dataset.csv", m.raw[name], spec.merge_keys, not spec.full_row)
              for name, spec in ((name, TABLES[name]) for name in RAW)]
             + [("cancelled_orders.csv", m.raw["sellers"], ["seller_id"])],
             [("orders.csv", m.adapter("orders_v2"), TABLES["orders"].merge_keys)]]
    for files in drops:
        for name, rows, *dealt in files:
            _land_as(m, rows, f"{root}/files", name, *dealt)
        ingest.stream_landing(m.spark, f"{root}/files", tables, f"{root}/progress", log, prefix="acme_")
    held = union_all([t.read().groupBy().count().select(F.lit(n).alias("table_name"), F.col("count").alias("rows_held")) for n, t in tables.items()])
    done = log.read().groupBy("table_name").agg(
        F.sum("rows_staged").alias("rows_staged"), F.sum("rows_inserted").alias("rows_inserted"), F.sum("rows_updated").alias("rows_updated"))
    loaded = ingest.batch_completeness(ingest.expected_tables(m.spark), log.read()).select("table_name", "is_complete")
    return held.join(done, "table_name").join(loaded, "table_name")


@query
def mart_rebuild(m):
    """A mart written, rebuilt from changed orders, and read back at its current version."""
    root = scratch_path(m.spark, "marts")
    items = m.staging["order_items"]
    write_mart(star.fct_orders(m.staging["orders"], items), root, "fct_orders")
    merged = upsert.upsert(m.raw["orders"], m.adapter("orders_v2"), ["order_id"], validate=False)
    table = write_mart(star.fct_orders(merged, items), root, "fct_orders")
    return table.read().groupBy("order_status", "is_late_delivery").agg(
        F.count("*").alias("orders"), F.sum("item_count").alias("items"),
        F.max(F.lit(table.version)).alias("version"))


@query
def merge_report(m):
    """Second batches merged into stored tables, as counted by the writes."""
    root = scratch_path(m.spark, "merged")
    reports = {}
    for name, batch in (("orders", "orders_v2"), ("geolocation_raw", "geolocation_v2"), ("sellers", "sellers_v2")):
        table = MergedTable(m.spark, f"{root}/{name}", TABLES[name], buckets=8)
        upsert.merge_into(table, m.raw[name], validate=False)
        reports[name] = upsert.merge_into(table, m.adapter(batch), validate=False)
    return upsert.merge_reports(m.spark, reports)


@query
def batch_completeness(m):
    """Load log of every table but one, from their real row counts."""
    loaded = {name: m.raw[name] for name in RAW if name != "category_translation"}
    log = profiling.profile_shape(loaded).filter("row_count > 0")
    return ingest.batch_completeness(ingest.expected_tables(m.spark), log)


# staging

@query
def stg_select(m):
    """Orders as loaded, with audit columns, back to their declared columns."""
    return staging.stage("orders", with_audit(m.raw["orders"], "orders.csv", LOADED_AT))


@query
def stg_customers(m):
    return m.staging["customers"]


@query
def stg_sellers(m):
    return m.staging["sellers"]


@query
def stg_category_translation(m):
    return m.staging["category_translation"]


@query
def stg_order_items(m):
    return m.staging["order_items"]


@query
def stg_order_payments(m):
    return m.staging["order_payments"]


@query
def stg_order_reviews(m):
    return m.staging["order_reviews"]


@query
def stg_products(m):
    return m.staging["products"]


@query
def geo_clean(m):
    return m.staging["geolocation"]


@query
def geo_by_zip(m):
    return m.geo


# star schema

def _places(m):
    """Coordinates by zip, written once: its size is known when the dimension is planned."""
    return materialise(m.geo, "geo-by-zip")


@query
def dim_customers(m):
    return star.dim_customers(m.staging["customers"], _places(m))


@query
def dim_sellers(m):
    return star.dim_sellers(m.sellers_history, _places(m))


@query
def dim_products(m):
    return star.dim_products(m.staging["products"], m.staging["category_translation"])


@query
def dim_date(m):
    return m.marts["dim_date"]


@query
def fct_orders(m):
    return m.marts["fct_orders"]


@query
def fct_order_items(m):
    return m.marts["fct_order_items"]


@query
def fct_order_payments(m):
    return m.marts["fct_order_payments"]


@query
def fct_order_reviews(m):
    return m.marts["fct_order_reviews"]


@query
def order_flags(m):
    return m.marts["fct_orders"].select("order_id", *star.ORDER_FLAGS)


# upsert and history

@query
def upsert_keyed(m):
    return upsert.upsert(m.raw["orders"], m.adapter("orders_v2"), ["order_id"])


@query
def upsert_full_row(m):
    return upsert.upsert_full_row(m.raw["geolocation_raw"], m.adapter("geolocation_v2"))


@query
def upsert_cold_start(m):
    """First merge into a table that does not exist yet."""
    table = MergedTable(m.spark, scratch_path(m.spark, "cold"), TABLES["orders"], buckets=8)
    upsert.merge_into(table, m.raw["orders"])
    return table.read()


@query
def snapshot_check(m):
    """Two runs, and a third over the same source, which changes nothing."""
    third = history.snapshot_check(
        m.sellers_history, m.adapter("sellers_v2"), "seller_id", SELLER_COLS, RUN_2.replace(year=2001))
    return third


@query
def snapshot_run(m):
    """Two stored runs, and the second replayed, which changes nothing."""
    schema = m.sellers_history.schema
    table = HistoryTable(m.spark, scratch_path(m.spark, "history") + "/sellers", schema)
    build.snapshot_run(table, m.raw["sellers"], "seller_id", SELLER_COLS, RUN_1)
    for _ in range(2):
        build.snapshot_run(table, m.adapter("sellers_v2"), "seller_id", SELLER_COLS, RUN_2)
    return table.read()


@query
def gated_build(m):
    """A build that passes, and one whose failed check leaves every version as it was."""
    root = scratch_path(m.spark, "gated")
    marts = {name: m.marts[name] for name in ("fct_orders", "dim_customers")}
    tables = {name: VersionedTable(m.spark, f"{root}/{name}", df.schema) for name, df in marts.items()}
    rules = [c for c in checks.CHECKS if c.table in marts and (c.parent is None or c.parent[0] in marts)]
    build.gated_build({name: (tables[name], df) for name, df in marts.items()}, rules)
    twice = marts["dim_customers"].unionByName(marts["dim_customers"])
    try:
        build.gated_build({"dim_customers": (tables["dim_customers"], twice)}, [
            quality.Check(quality.UNIQUE, "dim_customers", ("customer_id",))])
    except quality.QualityError:
        pass
    else:
        raise AssertionError("a repeated key passed the gate")
    return union_all([
        table.read().groupBy().agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("mart"), "rows", F.lit(table.version).alias("version"))
        for name, table in tables.items()])


@query
def csv_roundtrip(m):
    """Every raw table written as CSV and read by the loader: rows, and how many differ, by 128-bit digests of the rows."""
    root = scratch_path(m.spark, "csv")
    lines = []
    for name in RAW:
        _land(m.raw[name], f"{root}/{name}")
        read = read_table(m.spark, TABLES[name], f"{root}/{name}")
        both = m.raw[name].withColumn("_side", F.lit(1)).unionByName(read.withColumn("_side", F.lit(-1)))
        lines.append(
            both.select("_side", *digest([F.col(c) for c in m.raw[name].columns])).groupBy("_d1", "_d2")
            .agg(F.sum("_side").alias("_more"), F.count_if(F.col("_side") < 0).alias("_rows"))
            .groupBy().agg(F.sum("_rows").alias("rows"), F.sum(F.abs("_more")).alias("differ"))
            .select(F.lit(name).alias("table_name"), "rows", "differ"))
    return union_all(lines)


@query
def pit_join(m):
    return _items_at_time(m, closed="both")


@query
def pit_join_backfill(m):
    return _items_at_time(m, closed="left", backfill_first=True, how="left")


def _items_at_time(m, **options):
    items = m.marts["fct_order_items"].select("order_id", "order_item_id", "seller_id", "shipping_limit_date", "price")
    versions = materialise(history.dim_scd2(m.sellers_history).select(
        "seller_id", "seller_zip_code_prefix", "seller_state", "valid_from", "valid_to", "is_current"), "versions")
    return history.pit_join(items, versions, "seller_id", "shipping_limit_date", **options)


@query
def pit_join_bucketed(m):
    """Each line with its product's asking price when the order was placed; a product has many prices."""
    items = m.staging["order_items"].select("order_id", "order_item_id", "product_id").join(
        m.staging["orders"].select("order_id", "order_purchase_timestamp"), "order_id")
    return history.pit_join_bucketed(items, m.asking_prices, "product_id", "order_purchase_timestamp").select(
        "order_id", "order_item_id", "product_id", "order_purchase_timestamp", "asking_price", "valid_from", "valid_to")


# loaders and filters

def _orders(m):
    return loaders.load_orders(m.marts["fct_orders"], m.marts["dim_customers"])


def _items(m):
    return loaders.load_order_items(
        m.marts["fct_order_items"], m.marts["fct_orders"], m.product_lookup, m.seller_lookup)


def _payments(m):
    return loaders.load_payments(m.marts["fct_order_payments"], m.marts["fct_orders"])


def _review_tables(m):
    facts = [m.marts[t] for t in ("fct_order_reviews", "fct_orders", "fct_order_items")]
    return [*facts, m.product_lookup, m.seller_lookup]


def _paid(m):
    return loaders.paid_by_order(m.marts["fct_order_payments"], m.marts["fct_orders"])


def _by_product(m, selection=Selection()):
    return loaders.value_by_product(
        m.marts["fct_order_items"], m.marts["fct_orders"], m.product_lookup, m.seller_lookup, selection)


def _weighted(m):
    return loaders.weighted_reviews(*_review_tables(m))


@query
def load_orders(m):
    return _orders(m)


@query
def load_order_items(m):
    return _items(m)


@query
def load_items_bucketed(m):
    """Order lines over facts stored in buckets by order."""
    facts = layout.store_bucketed(
        {name: m.marts[name] for name in ("fct_orders", "fct_order_items")}, "bucketed_" + uuid.uuid4().hex,
        scratch_path(m.spark, "bucketed"), buckets=8)
    return loaders.load_order_items(facts["fct_order_items"], facts["fct_orders"], m.product_lookup, m.seller_lookup)


@query
def filter_items_by_month(m):
    """A year's order lines over facts stored by month: other months' folders are not read."""
    facts = layout.store_by_month(
        {name: m.marts[name] for name in ("fct_orders", "fct_order_items")}, scratch_path(m.spark, "by-month"))
    lines = loaders.load_order_items(facts["fct_order_items"], facts["fct_orders"], m.product_lookup, m.seller_lookup)
    return filters.filter_by_date_and_category(lines, TWO_CATEGORIES).drop(filters.MONTH)


@query
def load_payments(m):
    return _payments(m)


@query
def load_reviews(m):
    return loaders.load_reviews(*_review_tables(m))


@query
def filter_date(m):
    return filters.filter_by_date(_orders(m), ONE_YEAR)


@query
def filter_date_state(m):
    return filters.filter_by_date_and_state(_orders(m), TWO_STATES)


@query
def filter_date_category(m):
    """The default choice: every category, so lines without one are dropped."""
    return filters.filter_by_date_and_category(_items(m), DEFAULT)


@query
def filter_date_category_list(m):
    return filters.filter_by_date_and_category(_items(m), TWO_CATEGORIES)


@query
def filter_options(m):
    return filters.filter_options(_orders(m), _by_product(m))


# dashboard figures

@query
def kpi_sales(m):
    return dashboard.kpi_sales(_paid(m), _items(m), DEFAULT)


@query
def monthly_revenue(m):
    return dashboard.monthly_revenue(_paid(m))


@query
def top_categories(m):
    return dashboard.top_categories(_by_product(m), DEFAULT)


@query
def kpi_delivery(m):
    legs = dashboard.delivery_legs(m.marts["fct_orders"], m.marts["dim_customers"])
    return dashboard.kpi_delivery(_orders(m), legs, TWO_STATES)


@query
def delivery_legs(m):
    return dashboard.delivery_legs(m.marts["fct_orders"], m.marts["dim_customers"])


@query
def monthly_anomaly_rates(m):
    return dashboard.monthly_anomaly_rates(_orders(m))


@query
def anomaly_counts(m):
    return dashboard.anomaly_counts(_orders(m))


@query
def monthly_volume_late(m):
    return dashboard.monthly_volume_late(_orders(m))


@query
def kpi_satisfaction(m):
    return dashboard.kpi_satisfaction(_weighted(m), DEFAULT)


@query
def kpi_satisfaction_per_review(m):
    """The same figures with each review counted once."""
    reviews = loaders.review_grain(m.marts["fct_order_reviews"], m.marts["fct_orders"])
    return dashboard.kpi_satisfaction(reviews)


@query
def review_histogram(m):
    return dashboard.review_histogram(_weighted(m))


@query
def score_by_lateness(m):
    return dashboard.score_by_lateness(_weighted(m))


@query
def lowest_rated_categories(m):
    return dashboard.lowest_rated_categories(_weighted(m), DEFAULT)


@query
def kpi_marketplace(m):
    return dashboard.kpi_marketplace(_orders(m), _items(m), DEFAULT)


@query
def top_sellers(m):
    return dashboard.top_sellers(_items(m), ONE_YEAR)


@query
def orders_by_status(m):
    return dashboard.orders_by_status(_orders(m))


@query
def sellers_by_state(m):
    return dashboard.sellers_by_state(_items(m))


@query
def revenue_share_by_state(m):
    return dashboard.revenue_share_by_state(
        m.marts["fct_orders"], m.marts["dim_customers"], m.marts["fct_order_payments"])


@query
def headline_shares(m):
    reviews = loaders.review_grain(m.marts["fct_order_reviews"], m.marts["fct_orders"])
    return dashboard.headline_shares(m.marts["fct_orders"], reviews)


# segments

def _per_customer(m):
    return segments.rfm_per_customer(m.marts["fct_orders"], m.marts["dim_customers"], m.marts["fct_order_items"])


def _segments(m):
    return segments.rfm_segments(segments.rfm_scored(_per_customer(m)))


@query
def rfm_per_customer(m):
    return _per_customer(m)


@query
def rfm_scored(m):
    return segments.rfm_scored(_per_customer(m))


@query
def rfm_segments(m):
    return _segments(m)


@query
def segment_summary(m):
    return segments.segment_summary(_segments(m))


@query
def kpi_segments(m):
    return segments.kpi_segments(_segments(m))


# quality

def _report(m, *kinds):
    wanted = [c for c in checks.CHECKS + checks.EXTRA_CHECKS if not kinds or c.kind in kinds]
    return quality.run_checks(m.layers(quality.columns_read(wanted)), wanted)


@query
def dq_unique(m):
    return _report(m, quality.UNIQUE)


@query
def dq_not_null(m):
    return _report(m, quality.NOT_NULL)


@query
def dq_relationships(m):
    return _report(m, quality.RELATIONSHIP)


@query
def dq_accepted_values(m):
    return _report(m, quality.ACCEPTED)


@query
def dq_expression(m):
    return _report(m, quality.EXPRESSION)


@query
def dq_unique_combo(m):
    return _report(m, quality.UNIQUE_COMBO)


@query
def dq_report(m):
    return _report(m)


@query
def dq_report_rates(m):
    """The monitors with thresholds as shares of the table, which fit any scale."""
    return quality.run_checks(m.layers(), [
        c.with_rate(0.05) for c in checks.CHECKS if c.severity == "warn"])


@query
def dq_flags(m):
    return quality.dq_flags(
        m.marts["fct_orders"], m.staging["products"], m.staging["category_translation"], LOADED_AT)


@query
def constraint_split(m):
    spec = TABLES["orders"]
    batch = quality.with_violations(
        m.adapter("orders_v2"), checks.row_rules("orders"), required=spec.required, unique=spec.keys,
        foreign={"customer_id": (m.raw["customers"], "customer_id")})
    return batch.select(
        "order_id", "customer_id", F.array_join("_violations", "; ").alias("violations"),
        (F.size("_violations") == 0).alias("accepted"))


def _split(m, name):
    """Broken constraints of a raw table's rows: its rules, required columns, key and references."""
    spec = TABLES[name]
    marked = quality.with_violations(
        m.raw[name], checks.row_rules(name), required=spec.required, unique=spec.keys,
        foreign={column: (m.raw[parent], known) for child, column, parent, known in checks.REFERENCES if child == name})
    return marked.select(
        *spec.keys, F.array_join("_violations", "; ").alias("violations"), (F.size("_violations") == 0).alias("accepted"))


@query
def constraint_split_items(m):
    return _split(m, "order_items")


@query
def constraint_split_payments(m):
    return _split(m, "order_payments")


@query
def constraint_split_reviews(m):
    return _split(m, "order_reviews")


# profile

@query
def profile_nulls(m):
    return profiling.profile_nulls(m.raw)


@query
def profile_duplicates(m):
    return profiling.profile_duplicates(m.raw)


@query
def profile_keys(m):
    return profiling.profile_keys(m.raw, checks.PROFILED_KEYS)


@query
def profile_shape(m):
    return profiling.profile_shape(m.raw)


@query
def profile_ranges(m):
    return profiling.profile_ranges(m.raw, {
        "orders": ["order_purchase_timestamp", "order_approved_at", "order_estimated_delivery_date"],
        "order_items": ["price", "freight_value", "shipping_limit_date"],
        "order_payments": ["payment_value", "payment_installments"],
        "order_reviews": ["review_score", "review_creation_date"],
        "products": ["product_weight_g", "product_photos_qty"],
    })


@query
def profile_values(m):
    return profiling.value_counts(m.raw, [
        ("orders", "order_status"), ("order_payments", "payment_type"), ("order_reviews", "review_score")])


@query
def fk_orphans(m):
    return profiling.fk_orphans(m.raw, checks.REFERENCES)


@query
def childless_orders(m):
    return profiling.childless(m.raw["orders"], "order_id", {
        name: m.raw[name] for name in ("order_items", "order_payments", "order_reviews")})


@query
def zip_coverage(m):
    return profiling.zip_coverage(m.raw["geolocation_raw"], "geolocation_zip_code_prefix", {
        "customers": (m.raw["customers"], "customer_zip_code_prefix"),
        "sellers": (m.raw["sellers"], "seller_zip_code_prefix"),
    })


@query
def date_logic(m):
    return profiling.date_logic(m.adapter("orders_v2"))


@query
def numeric_sanity(m):
    return profiling.numeric_sanity(m.raw["order_items"], m.raw["order_payments"], m.raw["products"])


@query
def geo_outside(m):
    return profiling.geo_outside(m.raw["geolocation_raw"])


_QUERIES["coerce_types"] = _QUERIES.pop("coerce_types_")
