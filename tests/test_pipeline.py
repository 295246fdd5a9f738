"""Landed CSV files to gated, written marts and a dashboard figure."""

from datetime import date, datetime

from mercato.operators.filters import Selection
from mercato.operators.history import snapshot_check
from mercato.operators.quality import enforce, run_checks
from mercato.operators.upsert import merge_into
from mercato.plans import checks, dashboard, loaders, staging, star
from mercato.schemas import TABLES
from mercato.sources.files import read_table
from mercato.sources.tables import MergedTable, write_mart

LANDED = {"header": "true", "escape": '"', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
WATCHED = ["seller_zip_code_prefix", "seller_city", "seller_state"]


def test_files_to_figures(spark, small, rows, tmp_path):
    m = small(spark, "0.01")
    raw = {}
    for name, spec in TABLES.items():
        landed = str(tmp_path / "landing" / spec.stem)
        m.raw[name].write.options(**LANDED).csv(landed)
        table = MergedTable(spark, str(tmp_path / "raw" / name), spec, buckets=4)
        merge_into(table, read_table(spark, spec, landed))
        raw[name] = table.read()
        assert rows(raw[name]) == rows(m.raw[name].select(*spec.columns)), name

    stg = staging.build_staging(raw)
    history = snapshot_check(None, stg["sellers"], "seller_id", WATCHED, as_of=datetime(1998, 1, 1))
    marts = star.build_star(stg, history)
    warned = enforce(run_checks({**{f"stg_{n}": df for n, df in stg.items()}, **marts}, checks.CHECKS))
    assert warned == ["expression fct_orders(is_delivered_missing_date) = false"]
    written = {n: write_mart(df, str(tmp_path / "marts"), n).read() for n, df in marts.items()}
    assert {n: df.count() for n, df in written.items()} == {
        "dim_customers": 15000, "dim_sellers": 100, "dim_products": 2000, "dim_date": 1096,
        "fct_orders": 15000, "fct_order_items": 60000, "fct_order_payments": 17954, "fct_order_reviews": 10000}

    orders = loaders.load_orders(written["fct_orders"], written["dim_customers"])
    year = Selection(date_range=(date(1997, 1, 1), date(1997, 12, 31)))
    figure = dashboard.monthly_anomaly_rates(orders, year)
    assert figure.count() == 36
    plan = figure._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(order_purchase_date), GreaterThanOrEqual(order_purchase_date" in plan


def test_small_batch_keys_are_broadcast(spark, small, tmp_path):
    """A batch of measured small size leaves the target unshuffled."""
    from mercato.operators.upsert import upsert
    from mercato.session import materialise

    m = small(spark)
    target, batch = materialise(m.raw["orders"], "target"), materialise(m.adapter("orders_v2"), "batch")
    plan = upsert(target, batch, ["order_id"], validate=False)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "hashpartitioning" not in plan
