"""Declarative checks, their report and gate, the anomaly log, and the pre-load split."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from mercato.functions.exprs import instant, stamp
from mercato.functions.frames import union_all
from mercato.session import materialise

NOT_NULL, EXPRESSION, UNIQUE, UNIQUE_COMBO = "not_null", "expression", "unique", "unique_combo"
ACCEPTED, RELATIONSHIP = "accepted_values", "relationship"


@dataclass(frozen=True)
class Check:
    """One rule on one table.

    ``expression`` completes the column (``> 0``); ``values`` are the accepted ones; ``parent`` is
    ``(table, column)``. A ``warn`` check warns above ``warn_above`` failures, or above ``warn_rate`` of the
    table's rows if that is set, and never errors.
    """

    kind: str
    table: str
    columns: tuple[str, ...]
    expression: str | None = None
    values: tuple = ()
    parent: tuple[str, str] | None = None
    severity: str = "error"
    warn_above: int = 0
    warn_rate: float | None = None

    @property
    def name(self) -> str:
        detail = self.expression or (".".join(self.parent) if self.parent else "")
        return " ".join(filter(None, [self.kind, f"{self.table}({', '.join(self.columns)})", detail]))

    @property
    def tables(self) -> list[str]:
        return [self.table] + ([self.parent[0]] if self.parent else [])

    def with_rate(self, warn_rate: float) -> Check:
        return replace(self, warn_rate=warn_rate)


def columns_read(checks: list[Check]) -> dict[str, list[str]]:
    """Table -> the columns that ``checks`` read of it, parents' included; all else need not be built for them."""
    read: dict[str, dict[str, None]] = defaultdict(dict)
    for check in checks:
        read[check.table].update(dict.fromkeys(check.columns))
        if check.parent:
            read[check.parent[0]][check.parent[1]] = None
    return {table: list(columns) for table, columns in sorted(read.items())}


def _row_checks(df: DataFrame, checks: dict[int, Check]) -> DataFrame:
    """All not-null and expression checks of one table in a single pass; NULL never fails an expression."""
    def failing(check: Check) -> str:
        column = f"`{check.columns[0]}`"
        return f"{column} IS NULL" if check.kind == NOT_NULL else f"NOT ({column} {check.expression})"

    counts = [f"count_if({failing(c)}) AS f{i}" for i, c in checks.items()]
    pairs = ", ".join(f"{i}, f{i}" for i in checks)
    return df.selectExpr(*counts, "count(*) AS rows").selectExpr(
        f"stack({len(checks)}, {pairs}) AS (check_id, failures)", "rows")


def _first_hash(columns: list[Column]) -> Column:
    return F.xxhash64(*columns)


def _second_hash(columns: list[Column]) -> Column:
    return F.xxhash64(F.lit(1), *columns)


def _key_parts(check: Check, side: int, types: Mapping[str, DataFrame]) -> tuple[list[Column], Column]:
    """What is hashed of a row's key, and whether the row counts. The parent's side of a relationship has 1."""
    if check.kind == RELATIONSHIP:
        parent, column = types[check.parent[0]], check.parent[1]
        key = F.col(column) if side else F.col(check.columns[0]).cast(parent.schema[column].dataType)
        return [key], key.isNotNull()
    keys = [F.col(c) for c in check.columns]
    if check.kind == UNIQUE_COMBO:  # a hash skips a NULL, so where they stand is hashed too
        return [*keys, *(k.isNull() for k in keys)], F.lit(True)
    if check.kind == ACCEPTED:
        return keys, F.coalesce(~keys[0].isin(*check.values), F.lit(False))
    return keys, keys[0].isNotNull()


def _domain(i: int, check: Check) -> tuple:
    """Checks with the same domain look at the same set of keys: a column's uniqueness and all references to it."""
    if check.kind == RELATIONSHIP:
        return check.parent
    return (check.table, *check.columns) if check.kind == UNIQUE else (i,)


def _places(checks: dict[int, Check]) -> dict[int, tuple[int, int]]:
    """Check -> (number of its domain, its place among the domain's children). Place 0 is the keys' own table."""
    numbers: dict[tuple, int] = {}
    children: dict[int, int] = defaultdict(int)
    places = {}
    for i, check in checks.items():
        number = numbers.setdefault(_domain(i, check), len(numbers))
        children[number] += check.kind == RELATIONSHIP
        places[i] = number, children[number] if check.kind == RELATIONSHIP else 0
    return places


def _tags(tables: Mapping[str, DataFrame], checks: dict[int, Check]) -> DataFrame:
    """(domain, key hash, second hash, place) of every row and key that a check looks at; one scan per table.

    A row has one tag for its own key, however many checks refer to it."""
    wanted: dict[str, dict[tuple[int, int], list[Column]]] = defaultdict(dict)
    for i, (domain, place) in _places(checks).items():
        for side, table in enumerate(checks[i].tables):
            parts, counts = _key_parts(checks[i], side, tables)
            at = domain, 0 if side else place
            wanted[table][at] = [F.when(counts, F.lit(domain)), _first_hash(parts), _second_hash(parts), F.lit(at[1])]
    return union_all([
        tables[name].select(F.stack(F.lit(len(tags)), *(c for tag in tags.values() for c in tag)).alias("domain", "hash", "again", "place"))
        .filter("domain IS NOT NULL")
        for name, tags in wanted.items()])


def _grouped_failures(tables: Mapping[str, DataFrame], checks: dict[int, Check]) -> DataFrame:
    """Failures of all checks on keys, from one grouping of (domain, key hash).

    A hash that only one key has decides by itself: a key repeats, is not among the accepted, or has no parent. Where the
    second hashes of a group differ, keys share a hash; these few (fewer than one in a billion keys) are looked for in a
    second grouping, if there are any, and counted again on the full keys.
    """
    spark = next(iter(tables.values())).sparkSession
    places = _places(checks)
    children = range(1, max(place for _, place in places.values()) + 1)
    grouped = _tags(tables, checks).groupBy("domain", "hash").agg(
        *[F.count_if(F.col("place") == n).alias(f"rows{n}") for n in (0, *children)],
        F.min("again").alias("low"), F.max("again").alias("high"))
    certain = F.col("low") == F.col("high")
    found = materialise(grouped.groupBy("domain").agg(
        F.count_if(certain & (F.col("rows0") > 1)).alias("repeated"), F.count_if(certain).alias("kinds"),
        *[F.sum(F.when(certain & (F.col("rows0") == 0), F.col(f"rows{n}"))).alias(f"orphans{n}") for n in children],
        F.count_if(~certain).alias("shared")), "key-checks")
    measure = {UNIQUE: "repeated", UNIQUE_COMBO: "repeated", ACCEPTED: "kinds"}
    lines = ", ".join(
        f"named_struct('check_id', {i}, 'of', {domain}, 'failures', {measure.get(checks[i].kind, f'orphans{place}')})"
        for i, (domain, place) in places.items())
    known = found.selectExpr("domain", f"inline(array({lines}))").filter("domain = of").select("check_id", "failures")
    none = spark.createDataFrame([(i, 0) for i in checks], "check_id int, failures long")  # of empty tables, too
    doubtful: dict[int, list[int]] = defaultdict(list)
    if sharing := [r["domain"] for r in found.filter("shared > 0").select("domain").collect()]:
        for r in grouped.filter(~certain & F.col("domain").isin(sharing)).select("domain", "hash").collect():
            doubtful[r["domain"]].append(r["hash"])
    again = [_counted_again(i, tables, checks[i], doubtful[domain]) for i, (domain, _) in places.items() if domain in doubtful]
    return union_all([known, none, *again]).groupBy("check_id").agg(F.sum("failures").alias("failures")).selectExpr(
        "check_id", "coalesce(failures, 0) AS failures", "CAST(NULL AS BIGINT) AS rows")


def _counted_again(check_id: int, tables: Mapping[str, DataFrame], check: Check, hashes: list[int]) -> DataFrame:
    """Failures among the keys with the given hashes, by the keys themselves."""
    def keyed(side: int, table: str) -> DataFrame:
        parts, counts = _key_parts(check, side, tables)
        rows = tables[table].filter(counts & _first_hash(parts).isin(hashes))
        return rows.select(*[p.alias(f"k{i}") for i, p in enumerate(parts)])

    children = keyed(0, check.table)
    groups = children.groupBy(*children.columns).count()
    if check.kind == RELATIONSHIP:
        groups = groups.join(keyed(1, check.parent[0]).distinct(), "k0", "left_anti")
    failures = {RELATIONSHIP: "sum(count)", ACCEPTED: "count(*)"}.get(check.kind, "count_if(count > 1)")
    return groups.selectExpr(f"{check_id} AS check_id", f"coalesce({failures}, 0) AS failures")


def run_checks(tables: Mapping[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One report row per check: name, kind, table, columns, failures, severity, threshold, status.

    Row-level checks of a table share one scan. All checks on keys share one grouping, which runs at once: a repeated
    key counts once (a single NULL is no key), an unaccepted value once (NULL passes), and an orphan with every child row.
    A threshold given as a rate is applied to that table's row count.
    """
    by_table: dict[str, dict[int, Check]] = defaultdict(dict)
    on_keys: dict[int, Check] = {}
    for i, check in enumerate(checks):
        if check.kind in (NOT_NULL, EXPRESSION):
            by_table[check.table][i] = check
        elif check.kind in (UNIQUE, UNIQUE_COMBO, ACCEPTED, RELATIONSHIP):
            on_keys[i] = check
        else:
            raise ValueError(f"unknown check kind {check.kind!r}")
    parts = [_row_checks(tables[name], row_checks) for name, row_checks in by_table.items()]
    if on_keys:
        parts.append(_grouped_failures(tables, on_keys))
    return _judged(union_all(parts), checks)


def _text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _judged(found: DataFrame, checks: list[Check]) -> DataFrame:
    """Label the failures and compare them with the thresholds; labels are one constant array, not a join."""
    labels = ", ".join(
        f"named_struct('check_name', {_text(c.name)}, 'kind', {_text(c.kind)}, 'table_name', {_text(c.table)}, "
        f"'column_name', {_text(', '.join(c.columns))}, 'severity', {_text(c.severity)}, "
        f"'warn_above', {c.warn_above}L, 'warn_rate', CAST({'NULL' if c.warn_rate is None else c.warn_rate} AS DOUBLE))"
        for c in checks
    )
    return found.selectExpr(f"array({labels})[check_id] AS label", "failures", "rows").selectExpr(
        "label.check_name", "label.kind", "label.table_name", "label.column_name", "failures", "label.severity",
        "CASE WHEN label.severity = 'error' THEN 0 "
        "ELSE coalesce(floor(rows * label.warn_rate), label.warn_above) END AS threshold",
    ).selectExpr("*", "CASE WHEN failures <= threshold THEN 'pass' ELSE severity END AS status")


class QualityError(RuntimeError):
    """At least one check with severity ``error`` failed."""


def enforce(report: DataFrame) -> list[str]:
    """Gate before publishing: raise on errors, return the names of checks that only warn."""
    return judge(report.filter("status <> 'pass'").select("check_name", "failures", "status").collect())


def judge(report: list[Row]) -> list[str]:
    """:func:`enforce` on the report's rows."""
    errors = [f"{r['check_name']}: {r['failures']}" for r in report if r["status"] == "error"]
    if errors:
        raise QualityError("; ".join(sorted(errors)))
    return sorted(r["check_name"] for r in report if r["status"] != "pass")


def order_flags_log(fct_orders: DataFrame, flagged_at: datetime) -> DataFrame:
    """Anomaly log of the order flags: one pass over the fact, one row per raised flag."""
    rules = [
        ("is_carrier_before_approved", "carrier_date_before_approved_at",
         F.format_string("carrier=%s approved=%s", stamp("order_delivered_carrier_date"), stamp("order_approved_at"))),
        ("is_delivered_missing_date", "delivered_but_missing_date", F.col("order_status")),
        ("is_late_delivery", "late_delivery",
         F.format_string("delivered=%s estimated=%s",
                         stamp("order_delivered_customer_date"), stamp("order_estimated_delivery_date"))),
        ("has_no_line_items", "no_line_items", F.col("order_status")),
    ]
    raised = F.array(*[
        F.when(F.col(flag), F.struct(F.lit(rule).alias("rule_name"), detail.alias("detail")))
        for flag, rule, detail in rules
    ])
    return (
        fct_orders.filter(reduce(lambda a, b: a | b, [F.col(flag) for flag, _, _ in rules]))
        .select(F.col("order_id").alias("record_id"), F.inline(F.filter(raised, lambda r: r.isNotNull())))
        .select(F.lit("orders").alias("table_name"), "record_id", "rule_name", "detail",
                instant(flagged_at).alias("flagged_at"))
    )


def orphan_category_log(products: DataFrame, translation: DataFrame, flagged_at: datetime) -> DataFrame:
    filled = products.filter(F.col("product_category_name").isNotNull())
    known = translation.select("product_category_name").distinct()
    orphans = materialise(  # few; written, so that a hot category's products can be split in the join
        filled.select("product_category_name").distinct().join(known, "product_category_name", "left_anti"), "orphan-categories")
    return (
        filled.join(orphans, "product_category_name")
        .select(
            F.lit("products").alias("table_name"), F.col("product_id").alias("record_id"),
            F.lit("orphan_category").alias("rule_name"), F.col("product_category_name").alias("detail"),
            instant(flagged_at).alias("flagged_at"),
        )
    )


def dq_flags(fct_orders: DataFrame, products: DataFrame, translation: DataFrame, flagged_at: datetime) -> DataFrame:
    """Log of known anomalies that are reported but never block a load."""
    return order_flags_log(fct_orders, flagged_at).unionByName(
        orphan_category_log(products, translation, flagged_at))


def with_violations(
    df: DataFrame,
    rules: dict[str, Column],
    required: list[str] = (),
    unique: list[str] = (),
    foreign: dict[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """Add ``_violations``, the names of the constraints a row breaks.

    A rule fails only where it is false, not where it is NULL. ``unique`` rejects every row of a repeated
    key; ``foreign`` maps a column to (parent, parent column).
    """
    out = df
    broken = [F.when(~rule, F.lit(name)) for name, rule in rules.items()]
    broken += [F.when(F.col(c).isNull(), F.lit(f"{c} not null")) for c in required]
    extra: list[str] = []
    if unique:
        # the repeated keys, normally few, are written: joined as a scan, a hot key's rows can be split
        counts = materialise(df.groupBy(*unique).agg(F.count("*").alias("_copies")).filter("_copies > 1"), "repeated-keys")
        out = out.join(counts, list(unique), "left")
        broken.append(F.when(F.col("_copies") > 1, F.lit(f"unique {', '.join(unique)}")))
        extra.append("_copies")
    for i, (column, (parent, parent_column)) in enumerate((foreign or {}).items()):
        lost = f"_lost{i}"
        known = parent.select(F.col(parent_column).alias(column)).distinct()
        # the keys without a parent, normally few, are written: joined as a scan, a hot key's rows can be split
        orphans = materialise(
            df.select(column).na.drop().distinct().join(known, column, "left_anti").withColumn(lost, F.lit(True)), "orphan-keys")
        out = out.join(orphans, column, "left")
        broken.append(F.when(F.col(lost), F.lit(f"{column} foreign key")))
        extra.append(lost)
    violations = F.filter(F.array(*broken), lambda name: name.isNotNull())
    return out.withColumn("_violations", violations).select(*df.columns, "_violations")


def split_valid(df: DataFrame, rules: dict[str, Column], **constraints) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with ``_violations``), to run before an upsert."""
    checked = with_violations(df, rules, **constraints)
    accepted = checked.filter(F.size("_violations") == 0).drop("_violations")
    return accepted, checked.filter(F.size("_violations") > 0)
