from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators import quality
from mercato.operators.quality import Check, QualityError, enforce, run_checks, split_valid
from mercato.plans import star
from mercato.plans.build import gated_build
from mercato.plans.checks import CHECKS, EXTRA_CHECKS, MART_CHECKS, STAGING_CHECKS, row_rules
from mercato.schemas import TABLES
from mercato.sources.tables import VersionedTable


def _one(spark, check, **tables):
    return run_checks(tables, [check]).collect()[0]


def test_inventory_of_checks():
    assert Counter(c.kind for c in CHECKS) == {
        "unique": 9, "not_null": 19, "relationship": 12, "accepted_values": 1, "expression": 8, "unique_combo": 5}
    assert (len(STAGING_CHECKS), len(MART_CHECKS), len(EXTRA_CHECKS)) == (32, 22, 1)
    assert len({c.name for c in CHECKS + EXTRA_CHECKS}) == 55


def test_unique_counts_values_and_ignores_null(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("b",), ("c",), (None,), (None,)], "k string")
    assert _one(spark, Check("unique", "t", ("k",)), t=df)["failures"] == 2


def test_unique_combination(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1)], "k string, n long")
    assert _one(spark, Check("unique_combo", "t", ("k", "n")), t=df)["failures"] == 1


def test_expression_passes_null(spark):
    df = spark.createDataFrame([(1,), (0,), (-1,), (None,)], "price long")
    row = _one(spark, Check("expression", "t", ("price",), expression="> 0"), t=df)
    assert (row["failures"], row["status"]) == (2, "error")


def test_accepted_values_counts_distinct_strangers(spark):
    df = spark.createDataFrame([(1,), (7,), (7,), (9,), (None,)], "s long")
    assert _one(spark, Check("accepted_values", "t", ("s",), values=(1, 2)), t=df)["failures"] == 2


def test_relationship_counts_rows_and_tolerates_repeated_parents(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "fk string")
    parent = spark.createDataFrame([("a",), ("a",)], "k string")
    row = _one(spark, Check("relationship", "c", ("fk",), parent=("p", "k")), c=child, p=parent)
    assert row["failures"] == 2


@pytest.fixture
def keyed(spark):
    """Tables with repeated, missing, unaccepted and orphan keys, and checks with the failures that brute force counts."""
    child = spark.createDataFrame(
        [(f"k{i % 37}" if i % 9 else None, i % 5 if i % 4 else None, float(i % 3)) for i in range(200)]
        + [(None, 1, 0.0), (None, 1, 0.0), ("only", None, 1.5), ("x", 1, None), ("x", None, 1.0)], "k string, n int, v double")
    parent = spark.createDataFrame([(f"k{i}",) for i in range(0, 37, 2)] + [("k0",), (None,)], "id string")
    tables = {"c": child, "p": parent, "none": child.limit(0)}
    rows = [tuple(r) for r in child.collect()]
    singles, combos = Counter(r[0] for r in rows if r[0] is not None), Counter(r[:2] for r in rows)
    known = {r[0] for r in parent.collect()}
    expected = [
        (Check("unique", "c", ("k",)), sum(n > 1 for n in singles.values())),
        (Check("unique_combo", "c", ("k", "n")), sum(n > 1 for n in combos.values())),
        (Check("accepted_values", "c", ("n",), values=(0, 1)), 3),
        (Check("relationship", "c", ("k",), parent=("p", "id")), sum(n for k, n in singles.items() if k not in known)),
        (Check("unique", "p", ("id",)), 1),
        (Check("relationship", "p", ("id",), parent=("none", "k")), 20),
        (Check("unique", "none", ("k",)), 0), (Check("relationship", "none", ("k",), parent=("p", "id")), 0),
        (Check("not_null", "c", ("v",)), 1)]
    return tables, expected


@pytest.mark.parametrize("hashes", [0, 1, 5])
def test_all_key_checks_in_one_grouping(keyed, monkeypatch, hashes):
    if hashes:  # so few values that keys share them, and are counted again by the keys themselves
        monkeypatch.setattr(quality, "_first_hash", lambda columns: F.pmod(F.xxhash64(*columns), F.lit(hashes)))
    tables, expected = keyed
    got = {r["check_name"]: r["failures"] for r in run_checks(tables, [c for c, _ in expected]).collect()}
    assert got == {c.name: n for c, n in expected}


def test_a_key_is_looked_at_once_for_all_that_refer_to_it(keyed):
    tables, _ = keyed
    references = [Check("relationship", "c", ("k",), parent=("p", "id")), Check("relationship", "none", ("k",), parent=("p", "id"))]
    tags = quality._tags(tables, dict(enumerate([*references, Check("unique", "p", ("id",))])))
    assert tags.count() == tables["c"].filter("k IS NOT NULL").count() + tables["p"].filter("id IS NOT NULL").count()


def test_a_report_builds_only_what_its_checks_read(spark, small):
    wanted = [c for c in CHECKS if c.kind == "relationship"]
    read = quality.columns_read(wanted)
    assert read["fct_orders"] == ["customer_id", "order_id"] and read["stg_products"] == ["product_id"]
    layers = small(spark).layers(read)
    assert all(layers[name].columns == columns for name, columns in read.items())
    files = {name: layers[name].inputFiles()[0] for name in read}
    assert "/sf0.001/lineitem" in files["fct_order_items"] and "/mercato-scratch/" in files["fct_orders"]


def test_keys_of_another_type_meet_their_parents(spark):
    child = spark.createDataFrame([(1,), (2,), (3,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "k long")
    assert _one(spark, Check("relationship", "c", ("fk",), parent=("p", "k")), c=child, p=parent)["failures"] == 1


def test_warn_threshold_and_rate(spark):
    df = spark.createDataFrame([(True,)] * 3 + [(False,)] * 7, "late boolean")
    check = Check("expression", "t", ("late",), expression="= false", severity="warn", warn_above=3)
    assert _one(spark, check, t=df)["status"] == "pass"
    assert _one(spark, Check(**{**check.__dict__, "warn_above": 2}), t=df)["status"] == "warn"
    assert _one(spark, check.with_rate(0.3), t=df)["status"] == "pass"
    row = _one(spark, check.with_rate(0.29), t=df)
    assert (row["status"], row["threshold"]) == ("warn", 2)


def test_gate(spark):
    df = spark.createDataFrame([(None,), (1,)], "k long")
    warn = Check("expression", "t", ("k",), expression="> 5", severity="warn")
    assert enforce(run_checks({"t": df}, [warn])) == [warn.name]
    with pytest.raises(QualityError, match="not_null"):
        enforce(run_checks({"t": df}, [warn, Check("not_null", "t", ("k",))]))


def test_gate_keeps_the_old_mart(spark, tmp_path):
    from mercato.sources.tables import write_mart

    good = spark.createDataFrame([(1,)], "k long")
    table = write_mart(good, str(tmp_path), "m")
    staged = table.stage(good.unionByName(good))
    with pytest.raises(QualityError):
        enforce(run_checks({"m": table.read_staged(staged)}, [Check("unique", "m", ("k",))]))
    assert table.version == 1 and table.read().count() == 1


def test_planted_anomalies(spark, small):
    m = small(spark, "0.01")
    failures = {r["column_name"]: r["failures"] for r in run_checks(
        m.layers(), [c for c in CHECKS if c.severity == "warn"]).collect()}
    assert failures == {
        "is_late_delivery": 1713, "is_carrier_before_approved": 1043, "is_delivered_missing_date": 28,
        "has_no_line_items": 257}


def test_flag_log_matches_flags(spark, small):
    m = small(spark, "0.01")
    log = quality.dq_flags(m.marts["fct_orders"], m.staging["products"], m.staging["category_translation"],
                           datetime(2024, 1, 1))
    counts = {r["rule_name"]: r["count"] for r in log.groupBy("rule_name").count().collect()}
    flags = m.marts["fct_orders"].agg(*[F.count_if(f).alias(f) for f in star.ORDER_FLAGS]).collect()[0]
    assert counts["late_delivery"] == flags["is_late_delivery"]
    assert counts["carrier_date_before_approved_at"] == flags["is_carrier_before_approved"]
    assert counts.get("delivered_but_missing_date", 0) == flags["is_delivered_missing_date"]
    assert counts["no_line_items"] == flags["has_no_line_items"]


def test_flags_are_never_null(spark):
    ts = "CAST(NULL AS TIMESTAMP_NTZ)"
    df = spark.sql(f"""SELECT 'o' AS order_id, 'shipped' AS order_status, {ts} AS order_approved_at,
        {ts} AS order_delivered_carrier_date, {ts} AS order_delivered_customer_date,
        TIMESTAMP_NTZ'2020-01-01 00:00:00' AS order_estimated_delivery_date, 0L AS item_count""")
    row = star.order_flags(df).select(*star.ORDER_FLAGS).collect()[0]
    assert tuple(row) == (False, False, False, True)


def test_split_valid(spark):
    df = spark.createDataFrame(
        [("o1", 1, 5), ("o1", 2, 0), ("o2", 1, None), ("o3", 1, 5), ("o3", 1, 6), (None, 1, 5)],
        "order_id string, n long, score long")
    parents = spark.createDataFrame([("o1",), ("o3",)], "id string")
    accepted, rejected = split_valid(
        df, {"score 1 to 5": F.col("score").between(1, 5)}, required=["order_id"], unique=["order_id", "n"],
        foreign={"order_id": (parents, "id")})
    assert [tuple(r) for r in accepted.collect()] == [("o1", 1, 5)]
    broken = {(r["order_id"], r["score"]): set(r["_violations"]) for r in rejected.collect()}
    assert broken == {
        ("o1", 0): {"score 1 to 5"},
        ("o2", None): {"order_id foreign key"},
        ("o3", 5): {"unique order_id, n"},
        ("o3", 6): {"unique order_id, n", "score 1 to 5"},
        (None, 5): {"order_id not null"},
    }


def test_row_rules_cover_declared_constraints(spark):
    rules = {t: set(row_rules(t)) for t in TABLES}
    assert rules["orders"] == {"approved after purchase", "delivered after purchase"}
    assert len(rules["order_items"]) == len(rules["order_payments"]) == 2 and len(rules["order_reviews"]) == 1
    assert rules["sellers"] == set()


@pytest.fixture
def three(spark, tmp_path):
    """Published tables base, report (made of base) and other, and their next states; base's next state repeats a key."""
    schema = T.StructType([T.StructField("k", T.LongType())])
    tables = {name: VersionedTable(spark, str(tmp_path / name), schema) for name in ("base", "report", "other")}
    for table in tables.values():
        table.publish(spark.range(2).toDF("k"))
    fresh = spark.range(5).toDF("k")
    marts = {name: (table, fresh.unionByName(fresh) if name == "base" else fresh) for name, table in tables.items()}
    return marts, [Check("unique", name, ("k",)) for name in tables]


def test_a_failure_withholds_what_depends_on_it(three):
    marts, rules = three
    with pytest.raises(QualityError, match=r"unique base\(k\): 5"):
        gated_build(marts, rules, depends={"report": ["base"], "other": ["elsewhere"]})
    assert {name: (table.version, table.read().count()) for name, (table, _) in marts.items()} == {
        "base": (1, 2), "report": (1, 2), "other": (2, 5)}


def test_without_dependencies_a_failure_withholds_all(three):
    marts, rules = three
    with pytest.raises(QualityError):
        gated_build(marts, rules)
    assert {table.version for table, _ in marts.values()} == {1}
    good = {name: pair for name, pair in marts.items() if name != "base"}
    assert gated_build(good, [c for c in rules if c.table in good]) == []
    assert {table.version for table, _ in good.values()} == {2}
