from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercato.operators import filters, profiling
from mercato.operators.filters import ALL, Selection
from mercato.plans import dashboard, loaders, segments, staging, star

REVIEWS = ("order_id string, order_purchase_date date, is_late_delivery boolean, "
           "product_category_name_english string, review_score long, weight long")
D = date(2017, 5, 1)


@pytest.fixture
def orders(spark):
    return spark.createDataFrame([
        ("a", date(2017, 1, 1), "S1"), ("b", date(2017, 1, 31), "S2"), ("c", date(2017, 2, 1), None),
    ], "order_id string, order_purchase_date date, customer_state string")


@pytest.mark.parametrize("bounds,kept", [
    (None, "abc"), ((date(2017, 1, 1), date(2017, 1, 31)), "ab"), ((date(2017, 1, 1),), "abc"),
    ((date(2017, 1, 31), date(2017, 2, 1)), "bc"),
])
def test_date_range_is_inclusive_and_needs_two_dates(orders, bounds, kept):
    got = filters.filter_by_date(orders, Selection(date_range=bounds))
    assert "".join(sorted(r["order_id"] for r in got.collect())) == kept


@pytest.mark.parametrize("states,kept", [(None, "abc"), ([], "abc"), (ALL, "ab"), (["S2"], "b")])
def test_empty_choice_keeps_null_a_full_one_drops_it(orders, states, kept):
    got = filters.filter_by_date_and_state(orders, Selection(states=states))
    assert "".join(sorted(r["order_id"] for r in got.collect())) == kept


def test_weighted_reviews_equal_the_fan_out(spark, small):
    m = small(spark)
    tables = [m.marts[t] for t in ("fct_order_reviews", "fct_orders", "fct_order_items", "dim_products", "dim_sellers")]
    fan_out = loaders.load_reviews(*tables)
    weighted = loaders.weighted_reviews(*tables)
    keys = ["order_purchase_date", "is_late_delivery", "product_category_name_english", "review_score"]
    a = {tuple(r)[:4]: r["n"] for r in fan_out.groupBy(*keys).agg(F.count("*").alias("n")).collect()}
    b = {tuple(r)[:4]: r["n"] for r in weighted.groupBy(*keys).agg(F.sum("weight").alias("n")).collect()}
    assert a == b


def test_hot_order_never_builds_its_fan_out(spark):
    """One order holds 2,000 reviews and 3,000 lines: six million rows if joined, a handful as weights."""
    reviews = spark.range(2000).selectExpr(
        "CAST(id AS STRING) AS review_id", "'hot' AS order_id", "1 + id % 5 AS review_score")
    items = spark.range(3000).selectExpr(
        "'hot' AS order_id", "CAST(id % 4 AS STRING) AS product_id", "'s' AS seller_id")
    orders = spark.sql("SELECT 'hot' AS order_id, DATE'2017-01-01' AS order_purchase_date, true AS is_late_delivery")
    products = spark.range(4).selectExpr(
        "CAST(id AS STRING) AS product_id", "concat('c', id % 2) AS product_category_name_english")
    sellers = spark.sql("SELECT 's' AS seller_id, 'S' AS seller_state, true AS is_current")
    weighted = loaders.weighted_reviews(reviews, orders, items, products, sellers)
    assert weighted.count() == 10
    assert weighted.agg(F.sum("weight")).collect()[0][0] == 2000 * 3000


def test_satisfaction_on_empty_and_one_sided_input(spark):
    empty = spark.createDataFrame([], REVIEWS)
    assert tuple(dashboard.kpi_satisfaction(empty).collect()[0]) == (None, 0, None)
    late_only = spark.createDataFrame([("o", D, True, "c", 2, 3), ("p", D, True, "c", 5, 1)], REVIEWS)
    assert tuple(dashboard.kpi_satisfaction(late_only).collect()[0]) == (11 / 4, 75.0, None)


def test_sales_on_empty_input(spark):
    payments = spark.createDataFrame([], "order_purchase_date date, payment_value decimal(28,9)")
    items = spark.createDataFrame([], "order_id string, order_purchase_date date, product_category_name_english string")
    row = dashboard.kpi_sales(payments, items).collect()[0]
    assert (row["total_revenue"], row["total_orders"], row["avg_order_value"]) == (0, 0, 0.0)


def test_paid_by_order_keeps_revenue(spark, small):
    m = small(spark)
    by_payment = loaders.load_payments(m.marts["fct_order_payments"], m.marts["fct_orders"])
    by_order = loaders.paid_by_order(m.marts["fct_order_payments"], m.marts["fct_orders"])
    months = [[tuple(r) for r in dashboard.monthly_revenue(df).collect()] for df in (by_payment, by_order)]
    assert months[0] == months[1] and len(months[0]) > 12


def test_delivery_means_skip_their_own_nulls(spark):
    orders = spark.sql("""
        SELECT 'a' AS customer_id, 'delivered' AS order_status, DATE'2017-01-01' AS order_purchase_date,
          TIMESTAMP_NTZ'2017-01-01 23:00:00' AS order_approved_at, TIMESTAMP_NTZ'2017-01-03 01:00:00' AS order_delivered_carrier_date,
          TIMESTAMP_NTZ'2017-01-05 00:00:00' AS order_delivered_customer_date, true AS is_late_delivery
        UNION ALL SELECT 'b', 'delivered', DATE'2017-01-01', NULL, NULL, TIMESTAMP_NTZ'2017-01-11 00:00:00', false
        UNION ALL SELECT 'c', 'shipped', DATE'2017-01-01', NULL, NULL, TIMESTAMP_NTZ'2017-01-31 00:00:00', true""")
    customers = spark.createDataFrame([("a", "S"), ("b", "S"), ("c", "S")], "customer_id string, customer_state string")
    assert tuple(dashboard.delivery_legs(orders, customers).collect()[0]) == ("S", 2, 7.0, 0.5, 2.0, 2.0)


def test_whole_hours(spark):
    df = spark.sql("""SELECT TIMESTAMP_NTZ'2020-01-01 00:00:01' AS review_creation_date,
        explode(array(TIMESTAMP_NTZ'2020-01-01 01:00:00', TIMESTAMP_NTZ'2020-01-01 01:00:01')) AS review_answer_timestamp""")
    got = star.fct_order_reviews(df).select("hours_to_answer").collect()
    assert [r[0] for r in got] == [0, 1]


def test_nan_coordinates_are_neither_inside_nor_outside(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), -50.0, "c", "s"), (1, 0.0, -50.0, "c", "s"), (1, 5.27, -34.79, "c", "s"),
         (1, 9.0, -50.0, "c", "s"), (1, 0.0, -50.0, "c", "s")],
        "geolocation_zip_code_prefix long, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string")
    assert staging.stage_geolocation(df).count() == 2
    row = profiling.geo_outside(df).collect()[0]
    assert (row["total_points"], row["outside_points"], row["outside_pct"]) == (5, 1, 20.0)


def test_default_calendar(spark):
    days = star.dim_date(spark)
    assert days.count() == 1096
    row = days.filter("date_day = '2016-01-01'").collect()[0]
    assert (row["day_of_week"], row["day_name"], row["month_name"], row["is_weekend"]) == (6, "Friday", "January", False)


def test_products_without_category_stay(spark):
    products = spark.sql("""SELECT 'p' AS product_id, CAST(NULL AS STRING) AS product_category_name, 1L AS product_name_lenght,
        1L AS product_description_lenght, 1L AS product_photos_qty, 1BD AS product_weight_g, 1BD AS product_length_cm,
        1BD AS product_height_cm, 1BD AS product_width_cm""")
    translation = spark.createDataFrame([("x", "y")], "product_category_name string, product_category_name_english string")
    row = star.dim_products(staging.stage_products(products), translation).collect()[0]
    assert row["product_category_name_english"] is None and row["product_name_length"] == 1


PERSONS = "customer_unique_id string, order_count long, lifetime_value decimal(38,9), last_purchase_date date"


def test_segments(spark):
    persons = spark.createDataFrame(
        [(f"p{i:02d}", 2 if i == 1 else 1, None if i == 0 else Decimal(i), date(2017, 1, 1 + i)) for i in range(16)], PERSONS)
    named = segments.rfm_segments(segments.rfm_scored(persons))
    got = {r["customer_unique_id"]: r for r in named.collect()}
    assert (got["p15"]["r_score"], got["p15"]["m_score"], got["p15"]["customer_segment"]) == (4, 4, "gold")
    assert got["p00"]["m_score"] == 1 and got["p00"]["customer_segment"] == "lapsed"
    assert got["p01"]["customer_segment"] == "repeat" and got["p01"]["f_score"] == 4
    assert got["p08"]["customer_segment"] == "silver" and got["p04"]["customer_segment"] == "standard"
    summary = segments.segment_summary(named).collect()
    assert sum(r["customers"] for r in summary) == 16
    assert sum(r["revenue_share"] for r in summary) == pytest.approx(1)
    assert sum(r["customer_share"] for r in summary) == pytest.approx(1)
    assert [r["revenue"] for r in summary] == sorted((r["revenue"] for r in summary), reverse=True)
    kpi = segments.kpi_segments(named).collect()[0]
    assert (kpi["total_customers"], kpi["repeat_rate"], kpi["gold_customers"]) == (16, 1 / 16, 4)


def test_no_gold_gives_null(spark):
    one = spark.createDataFrame([("p", 1, Decimal(1), date(2017, 1, 1))], PERSONS)
    kpi = segments.kpi_segments(segments.rfm_segments(segments.rfm_scored(one))).collect()[0]
    assert kpi["gold_customers"] is None and kpi["gold_revenue_share"] is None


def test_profile_counts(spark, rows):
    t = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2)], "k string, n long")
    assert rows(profiling.profile_nulls({"t": t})) == [("t", "k", 1, 25.0), ("t", "n", 1, 25.0)]
    assert rows(profiling.profile_duplicates({"t": t})) == [("t", 4, 1)]
    assert rows(profiling.profile_keys({"t": t}, [("t", ["k"]), ("t", ["k", "n"])])) == [
        ("t", "k", 4, 2, 2), ("t", "k, n", 4, 3, 1)]
    parents = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(profiling.fk_orphans({"t": t, "p": parents}, [("t", "k", "p", "k")])) == [("t.k -> p.k", 2, 1, 50.0)]
    empty = t.limit(0)
    assert rows(profiling.fk_orphans({"t": empty, "p": parents}, [("t", "k", "p", "k")])) == [("t.k -> p.k", 0, 0, 0.0)]
    assert rows(profiling.profile_duplicates({"t": empty})) == [("t", 0, 0)]


def test_date_logic_counts(spark):
    bought = "TIMESTAMP_NTZ'2017-01-02 00:00:00'"
    early, none = "TIMESTAMP_NTZ'2017-01-01 00:00:00'", "CAST(NULL AS TIMESTAMP_NTZ)"
    df = spark.sql(f"""SELECT {bought} AS order_purchase_timestamp, {early} AS order_approved_at, {none} AS order_delivered_carrier_date,
          {none} AS order_delivered_customer_date, 'delivered' AS order_status
        UNION ALL SELECT {bought}, {bought}, {early}, {early}, 'delivered'""")
    row = profiling.date_logic(df).collect()[0]
    assert row["first_purchase"] == datetime(2017, 1, 2)
    assert tuple(row)[2:] == (1, 1, 1, 1)


def test_rows_that_share_a_digest_are_compared_in_full(spark, rows, monkeypatch):
    monkeypatch.setattr(profiling, "_digest", lambda columns: [F.lit(1).alias("_d1"), F.lit(2).alias("_d2")])
    t = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("b", None), ("b", None), (None, 2)], "k string, n long")
    assert rows(profiling.profile_duplicates({"t": t, "one": t.limit(1)})) == [("one", 1, 0), ("t", 6, 3)]


def test_duplicates_are_counted_by_digest(spark):
    t = spark.range(0, 1000).selectExpr("id", "repeat('wide ', 100) AS text")
    plan = profiling.profile_duplicates({"t": t})._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan  # no digest repeats, so no row is fetched


def test_duplicates_of_signed_zero_and_nan(spark, rows):
    t = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (1.0,), (None,), (None,)], "x double")
    assert rows(profiling.profile_duplicates({"t": t, "empty": t.limit(0)})) == [("empty", 0, 0), ("t", 7, 3)]


def test_a_review_without_a_score_has_no_part_in_a_mean(spark):
    reviews = spark.createDataFrame(
        [(5, 1, True, "a", date(2018, 1, 1)), (None, 3, True, "a", date(2018, 1, 1)),
         (1, 1, False, "b", date(2018, 1, 1)), (None, 1, False, "c", date(2018, 1, 1))],
        "review_score int, weight long, is_late_delivery boolean, product_category_name_english string, order_purchase_date date")
    row = dashboard.kpi_satisfaction(reviews).collect()[0]
    assert (row["avg_review_score"], row["on_time_minus_late"]) == (3.0, -4.0)
    rated = {r[0]: r[1] for r in dashboard.lowest_rated_categories(reviews).collect()}
    assert rated == {"a": 5.0, "b": 1.0, "c": None}
    assert {r[0]: r[1] for r in dashboard.score_by_lateness(reviews).collect()} == {"Late": 5.0, "On time": 1.0}
