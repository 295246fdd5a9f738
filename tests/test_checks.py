"""The data tests, model by model as declared, against the list that the runner folds by kind."""

from mercato.plans.checks import CHECKS

# fixed values: model -> column (or columns) -> tests
DECLARED = {
    "dim_customers": {"customer_id": ["unique", "not_null"]},
    "dim_sellers": {"seller_id, valid_from": ["unique_combo"], "seller_id": ["not_null"]},
    "dim_products": {"product_id": ["unique", "not_null"]},
    "dim_date": {"date_day": ["unique", "not_null"]},
    "fct_orders": {
        "order_id": ["unique", "not_null"], "customer_id": ["dim_customers.customer_id"],
        "is_late_delivery": ["= false warn 9000"], "is_carrier_before_approved": ["= false warn 1600"],
        "is_delivered_missing_date": ["= false warn 20"], "has_no_line_items": ["= false warn 900"]},
    "fct_order_items": {
        "order_id, order_item_id": ["unique_combo"], "order_id": ["fct_orders.order_id"],
        "product_id": ["dim_products.product_id"], "seller_id": ["dim_sellers.seller_id"]},
    "fct_order_payments": {"order_id": ["fct_orders.order_id"]},
    "fct_order_reviews": {"review_id, order_id": ["unique_combo"], "order_id": ["fct_orders.order_id"]},
    "stg_customers": {"customer_id": ["unique", "not_null"]},
    "stg_sellers": {"seller_id": ["unique", "not_null"]},
    "stg_category_translation": {"product_category_name": ["unique", "not_null"]},
    "stg_products": {"product_id": ["unique", "not_null"]},
    "stg_orders": {"order_id": ["unique", "not_null"], "customer_id": ["not_null", "stg_customers.customer_id"]},
    "stg_order_items": {
        "price": ["not_null", "> 0"], "freight_value": ["not_null", ">= 0"], "order_id": ["not_null", "stg_orders.order_id"],
        "product_id": ["stg_products.product_id"], "seller_id": ["stg_sellers.seller_id"],
        "order_id, order_item_id": ["unique_combo"]},
    "stg_order_payments": {
        "payment_value": ["not_null", ">= 0"], "payment_installments": ["not_null", ">= 0"],
        "order_id": ["not_null", "stg_orders.order_id"]},
    "stg_order_reviews": {
        "review_score": ["not_null", "in 1 2 3 4 5"], "order_id": ["not_null", "stg_orders.order_id"],
        "review_id, order_id": ["unique_combo"]},
}


def _said(check):
    if check.parent:
        return ".".join(check.parent)
    if check.values:
        return "in " + " ".join(map(str, check.values))
    if check.expression:
        return check.expression + (f" warn {check.warn_above}" if check.severity == "warn" else "")
    return check.kind


def test_every_declared_test_is_run():
    declared = {(model, column, test) for model, columns in DECLARED.items() for column, tests in columns.items() for test in tests}
    assert len(declared) == len(CHECKS) == 54
    assert {(c.table, ", ".join(c.columns), _said(c)) for c in CHECKS} == declared
