"""Stored layouts: joins without a shuffle, and dates that prune folders on both sides of a join."""

import re
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from mercato.operators.filters import Selection, filter_by_date
from mercato.plans import layout, loaders
from mercato.session import materialise

WIDE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
SPRING = Selection(date_range=(date(1996, 3, 15), date(1996, 5, 2)))


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in WIDE}
    for k, v in WIDE.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def marts(spark, small):
    m = small(spark)
    return {name: m.marts[name] for name in layout.FACTS}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_facts_meet_without_a_shuffle(no_broadcast, marts, rows, tmp_path):
    name = "t_" + uuid.uuid4().hex
    facts = layout.store_bucketed(marts, name, str(tmp_path), buckets=4)
    for load, fact in ((loaders.load_payments, "fct_order_payments"), (loaders.review_grain, "fct_order_reviews")):
        got = load(facts[fact], facts["fct_orders"])
        assert "Exchange" not in plan(got) and "SortMergeJoin" in plan(got)
        assert rows(got) == rows(load(marts[fact], marts["fct_orders"]))
    lines = facts["fct_order_items"].join(facts["fct_orders"].select("order_id", "order_purchase_date"), "order_id")
    assert "Exchange" not in plan(lines) and lines.count() == marts["fct_order_items"].count()


def test_a_date_range_prunes_the_months_of_items_and_payments(no_broadcast, marts, small, rows, tmp_path):
    facts = layout.store_by_month(marts, str(tmp_path))
    m = small(no_broadcast)
    args = [materialise(m.marts["dim_products"], "products"), materialise(m.marts["dim_sellers"], "sellers")]
    for got, plain in [
        (loaders.load_payments(facts["fct_order_payments"], facts["fct_orders"]), loaders.load_payments(marts["fct_order_payments"], marts["fct_orders"])),
        (loaders.load_order_items(facts["fct_order_items"], facts["fct_orders"], *args),
         loaders.load_order_items(marts["fct_order_items"], marts["fct_orders"], *args)),
    ]:
        assert rows(got.drop("order_month")) == rows(plain)
        got, plain = filter_by_date(got, SPRING), filter_by_date(plain, SPRING)
        scans = [scan for scan in re.findall(r"FileScan parquet [^\n]*", plan(got)) if "order_month" in scan]
        assert len(scans) >= 2  # the orders', and the other fact's
        assert all(re.search(r"PartitionFilters: \[[^\]]*order_month[^\]]*1996-03-01", scan) for scan in scans)
        assert rows(got.drop("order_month")) == rows(plain) and got.count() > 0


def test_rows_of_unknown_orders_are_kept(spark, marts, tmp_path):
    stray = marts["fct_order_items"].limit(3).withColumn("order_id", F.concat("order_id", F.lit("-gone")))
    timeless = marts["fct_orders"].limit(2).withColumns({
        "order_id": F.concat("order_id", F.lit("-timeless")), "order_purchase_date": F.lit(None).cast("date")})
    theirs = timeless.select("order_id").crossJoin(marts["fct_order_items"].drop("order_id").limit(2)).select(*marts["fct_order_items"].columns)
    given = {**marts, "fct_order_items": marts["fct_order_items"].unionByName(stray).unionByName(theirs),
             "fct_orders": marts["fct_orders"].unionByName(timeless)}
    given = {name: materialise(df, name) for name, df in given.items()}
    facts = layout.store_by_month(given, str(tmp_path))
    assert facts["fct_order_items"].filter(F.col("order_month") == F.to_date(F.lit(layout.NO_MONTH))).count() == 7
    lines = [loaders._with_order(f["fct_order_items"], f["fct_orders"], ["order_id"], ["order_purchase_date"]).count() for f in (facts, given)]
    assert lines[0] == lines[1]


def test_buckets_grow_with_the_facts(no_broadcast, marts, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "BUCKET_ROWS", 500)
    name = "t_" + uuid.uuid4().hex
    facts = layout.store_bucketed(marts, name, str(tmp_path), buckets=4)
    buckets = {r["data_type"] for fact in facts for r in no_broadcast.sql(f"DESCRIBE FORMATTED {name}.{fact}").collect()
               if r["col_name"] == "Num Buckets"}
    assert buckets == {str(-(-max(marts[fact].count() for fact in facts) // 500))} and int(*buckets) > 4
    got = loaders.load_payments(facts["fct_order_payments"], facts["fct_orders"])
    assert "Exchange" not in plan(got)
    assert rows(got) == rows(loaders.load_payments(marts["fct_order_payments"], marts["fct_orders"]))
