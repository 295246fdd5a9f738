"""Integrity profile: NULLs, duplicates, keys, references, ranges and plausibility."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.constants import BOUNDING_BOX
from mercato.functions.exprs import digest as _digest
from mercato.functions.exprs import outside_box, percent
from mercato.functions.frames import to_lines, union_all
from mercato.session import materialise


def profile_nulls(tables: Mapping[str, DataFrame]) -> DataFrame:
    """NULL count and percent of every column that has any; one pass per table."""
    def one(name: str, df: DataFrame) -> DataFrame:
        counts = df.selectExpr(
            "count(*) AS total", *[f"count_if(`{c}` IS NULL) AS n{i}" for i, c in enumerate(df.columns)])
        return to_lines(counts, [
            {"table_name": f"'{name}'", "column_name": f"'{c}'", "null_count": f"n{i}",
             "null_pct": percent(f"n{i}", "total")}
            for i, c in enumerate(df.columns)
        ])

    return union_all([one(name, df) for name, df in tables.items()]).filter("null_count > 0")


def profile_duplicates(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows beyond the first of each fully equal group, NULLs equal.

    Rows of all tables are counted by a digest first, in one grouping whose shuffle holds 16 bytes a row however wide it
    is. Only rows whose digest repeats are then fetched and compared in full; without any, nothing is. Runs at once.
    """
    names = list(tables)
    digests = [tables[name].select(F.lit(i).alias("_t"), *_digest([F.col(c) for c in tables[name].columns])) for i, name in enumerate(names)]
    counted = union_all(digests).groupBy("_t", "_d1", "_d2").count()
    repeated = materialise(counted.filter("count > 1").select("_t", "_d1", "_d2"), "repeated-digests")
    holding = {r["_t"] for r in repeated.select("_t").distinct().collect()}  # a row a table
    lines = [tables[name].selectExpr(f"{i} AS _t", "1 AS rows", "0 AS more") for i, name in enumerate(names)]
    for i in holding:
        df = tables[names[i]]
        own = repeated.filter(F.col("_t") == i).drop("_t")
        rows = df.select("*", *_digest([F.col(c) for c in df.columns])).join(own, ["_d1", "_d2"], "left_semi")
        lines.append(rows.groupBy(*df.columns).count().selectExpr(f"{i} AS _t", "0 AS rows", "count - 1 AS more"))
    spark = repeated.sparkSession
    lines.append(spark.createDataFrame([(i, 0, 0) for i in range(len(names))], "_t int, rows int, more int"))  # of empty tables, too
    labels = F.array(*[F.lit(name) for name in names])
    return union_all(lines).groupBy("_t").agg(F.sum("rows").alias("total_rows"), F.sum("more").alias("duplicate_rows")).select(
        F.get(labels, F.col("_t")).alias("table_name"), "total_rows", "duplicate_rows")


def profile_key(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    """Total rows, distinct keys and the excess. A NULL in a single key is no key; in a composite it counts."""
    distinct = "count(*)" if len(keys) > 1 else f"count({keys[0]})"
    return df.groupBy(*keys).agg(F.count("*").alias("_copies")).selectExpr(
        f"'{name}' AS table_name", f"'{', '.join(keys)}' AS key_columns",
        "coalesce(sum(_copies), 0) AS total_rows", f"{distinct} AS distinct_keys",
        f"coalesce(sum(_copies), 0) - {distinct} AS excess_rows")


def profile_keys(tables: Mapping[str, DataFrame], keys: list[tuple[str, list[str]]]) -> DataFrame:
    return union_all([profile_key(name, tables[name], columns) for name, columns in keys])


def fk_profile(child: DataFrame, column: str, parent: DataFrame, parent_column: str, label: str) -> DataFrame:
    """Distinct foreign-key values, how many have no parent, and their share."""
    values = child.select(F.col(column).alias("_key")).na.drop().distinct()
    known = parent.select(F.col(parent_column).alias("_key")).na.drop().distinct().withColumn("_known", F.lit(True))
    return (
        values.join(known, "_key", "left")
        .selectExpr("count(*) AS distinct_values", "count_if(_known IS NULL) AS orphan_values")
        .selectExpr(f"'{label}' AS reference", "distinct_values", "orphan_values",
                    percent("orphan_values", "distinct_values", 3) + " AS orphan_pct")
    )


def fk_orphans(tables: Mapping[str, DataFrame], references: list[tuple[str, str, str, str]]) -> DataFrame:
    """Profile of each (child table, column, parent table, column)."""
    return union_all([
        fk_profile(tables[child], column, tables[parent], parent_column, f"{child}.{column} -> {parent}.{parent_column}")
        for child, column, parent, parent_column in references
    ])


def childless(parents: DataFrame, key: str, children: Mapping[str, DataFrame]) -> DataFrame:
    """How many distinct parent keys never occur in each child table."""
    keys = parents.select(key).distinct()
    return union_all([
        keys.join(child.select(key).distinct(), key, "left_anti")
        .agg(F.count("*").alias("orders_without"))
        .select(F.lit(name).alias("child_table"), "orders_without")
        for name, child in children.items()
    ])


def zip_coverage(places: DataFrame, zip_column: str, owners: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distinct zip prefixes of each owner table that have no place, with their total."""
    known = places.select(F.col(zip_column).alias("_zip")).distinct().withColumn("_known", F.lit(True))
    return union_all([
        df.select(F.col(column).alias("_zip")).distinct().join(known, "_zip", "left")
        .agg(F.count_if(F.col("_known").isNull()).alias("missing_zips"), F.count("*").alias("total_zips"))
        .select(F.lit(name).alias("table_name"), "missing_zips", "total_zips")
        for name, (df, column) in owners.items()
    ])


def date_logic(orders: DataFrame) -> DataFrame:
    """Counts of impossible or incomplete order dates, with the purchase range, in one pass."""
    bought, approved = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    carrier, delivered = F.col("order_delivered_carrier_date"), F.col("order_delivered_customer_date")
    return orders.agg(
        F.min(bought).alias("first_purchase"),
        F.max(bought).alias("last_purchase"),
        F.count_if(delivered < bought).alias("delivered_before_purchase"),
        F.count_if(approved < bought).alias("approved_before_purchase"),
        F.count_if(carrier < approved).alias("carrier_before_approved"),
        F.count_if((F.col("order_status") == "delivered") & delivered.isNull()).alias("delivered_missing_date"),
    )


def _sanity(df: DataFrame, table: str, measures: list[tuple[str, str, str]]) -> DataFrame:
    """min, max and implausible count per (column, rule, failing condition), one pass over the table."""
    aggs = []
    for i, (column, _, failing) in enumerate(measures):
        aggs += [f"min({column}) AS lo{i}", f"max({column}) AS hi{i}", f"count_if({failing}) AS bad{i}"]
    return to_lines(df.selectExpr(*aggs), [
        {"table_name": f"'{table}'", "column_name": f"'{column}'", "rule": f"'{rule}'",
         "min_value": f"CAST(lo{i} AS DECIMAL(28,9))", "max_value": f"CAST(hi{i} AS DECIMAL(28,9))",
         "violations": f"bad{i}"}
        for i, (column, rule, _) in enumerate(measures)
    ])


def numeric_sanity(items: DataFrame, payments: DataFrame, products: DataFrame) -> DataFrame:
    """Non-positive prices, negative freight, empty payments, zero instalments, weights and dimensions."""
    sides = ["product_length_cm", "product_height_cm", "product_width_cm"]
    shortest = products.withColumn("any_dimension", F.least(*sides))
    return union_all([
        _sanity(items, "order_items", [
            ("price", "<= 0", "price <= 0"),
            ("freight_value", "< 0", "freight_value < 0"),
        ]),
        _sanity(payments, "order_payments", [
            ("payment_value", "<= 0", "payment_value <= 0"),
            ("payment_installments", "= 0", "payment_installments = 0"),
        ]),
        _sanity(shortest, "products", [
            ("product_weight_g", "= 0", "product_weight_g = 0"),
            ("any_dimension", "= 0", " OR ".join(f"coalesce({c} = 0, false)" for c in sides)),
        ]),
    ])


def column_ranges(name: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """Non-NULL count, minimum and maximum of each column, as text with its type."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [f"count({c}) AS n{i}", f"min({c}) AS lo{i}", f"max({c}) AS hi{i}"]
    types = dict(df.dtypes)
    return to_lines(df.selectExpr(*aggs), [
        {"table_name": f"'{name}'", "column_name": f"'{c}'", "column_type": f"'{types[c]}'", "non_null": f"n{i}",
         "min_value": f"CAST(lo{i} AS STRING)", "max_value": f"CAST(hi{i} AS STRING)"}
        for i, c in enumerate(columns)
    ])


def profile_ranges(tables: Mapping[str, DataFrame], columns: dict[str, list[str]]) -> DataFrame:
    return union_all([column_ranges(name, tables[name], cols) for name, cols in columns.items()])


def value_counts(tables: Mapping[str, DataFrame], columns: list[tuple[str, str]]) -> DataFrame:
    """Every non-NULL value of the named columns with its count, as rows rather than a collected list."""
    return union_all([
        tables[name].select(c).na.drop().groupBy(c).agg(F.count("*").alias("n")).selectExpr(
            f"'{name}' AS table_name", f"'{c}' AS column_name", f"CAST({c} AS STRING) AS value", "n AS value_count")
        for name, c in columns
    ])


def profile_shape(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column count per table."""
    return union_all([
        df.selectExpr(f"'{name}' AS table_name", "count(*) AS row_count", f"{len(df.columns)} AS column_count")
        for name, df in tables.items()
    ])


def geo_outside(geolocation: DataFrame) -> DataFrame:
    """Points outside the bounding box, count and percent, with the coordinate ranges."""
    outside = outside_box("geolocation_lat", "geolocation_lng", BOUNDING_BOX)
    return geolocation.withColumn("_outside", outside).selectExpr(
        "count(*) AS total_points", "count_if(_outside) AS outside_points",
        "min(geolocation_lat) AS min_lat", "max(geolocation_lat) AS max_lat",
        "min(geolocation_lng) AS min_lng", "max(geolocation_lng) AS max_lng",
    ).selectExpr("*", percent("outside_points", "total_points", 3) + " AS outside_pct")
