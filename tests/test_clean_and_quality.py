import datetime

import pytest
from conftest import master

from cartwise.operators import clean, quality
from cartwise.operators.clean import clean_master, cleaning_log
from cartwise.plans import reports
from cartwise.session import stage


def test_status_filter_keeps_null(spark):
    rows = [{"order_status": s} for s in ("canceled", "unavailable", "created", "shipped", None)]
    kept = {r["order_status"] for r in clean_master(master(spark, rows)).collect()}
    assert kept == {"shipped", None}


def test_fill_order_state_then_global(spark):
    # State X: 1, 3 -> median 2 fills its gap; state Y has no value; NULL state has no group.
    rows = [
        {"order_id": "x1", "seller_state": "X", "delivery_days": 1.0},
        {"order_id": "x2", "seller_state": "X", "delivery_days": 3.0},
        {"order_id": "x3", "seller_state": "X", "delivery_days": None},
        {"order_id": "z1", "seller_state": "Z", "delivery_days": 9.0},
        {"order_id": "y1", "seller_state": "Y", "delivery_days": None},
        {"order_id": "n1", "seller_state": None, "delivery_days": None},
        {"order_id": "r1", "seller_state": "X", "delivery_days": 1.0, "review_score": None},
    ]
    got = {r["order_id"]: r for r in clean_master(master(spark, rows)).collect()}
    assert got["x3"]["delivery_days"] == 1.0  # median of 1, 3, 1
    # Global median of the filled column 1, 3, 1, 9, 1 is 1.
    assert got["y1"]["delivery_days"] == 1.0 and got["n1"]["delivery_days"] == 1.0
    assert got["r1"]["review_score"] == 4.0


def test_price_cap_is_inclusive_and_drops_null(spark):
    prices = [10.0, 20.0, 30.0, 40.0]  # q1 17.5, q3 32.5, cap 77.5
    table = master(spark, [{"price": p} for p in prices])
    assert clean_master(table).count() == 4
    with_null = master(spark, [{"price": p} for p in [*prices, None]])
    assert clean_master(with_null).count() == 4
    # With five prices 10 20 30 40 x: q1 20, q3 40, cap 100.
    assert clean_master(master(spark, [{"price": p} for p in [*prices, 100.0]])).count() == 5
    assert clean_master(master(spark, [{"price": p} for p in [*prices, 100.01]])).count() == 4
    log = cleaning_log(master(spark, [{"price": p} for p in [*prices, 100.01]] + [{"category_en": None}])).first()
    assert log["cleaning_log"] == "Dropped no-category: 1 | price outliers: 1"


def test_business_metrics_count_empty_orders_as_zero(spark):
    rows = [
        {"order_id": "a", "customer_unique_id": "u1", "price": 9.0, "freight_value": 1.0},
        {"order_id": "a", "customer_unique_id": "u1", "price": 19.0, "freight_value": 1.0, "category_en": "B", "order_item_id": 2},
        {"order_id": "b", "customer_unique_id": "u1", "price": None, "freight_value": 0.0, "order_item_id": None,
         "product_id": None, "category_en": None, "order_status": "shipped"},
        {"order_id": "c", "customer_unique_id": "u2", "price": None, "freight_value": 0.0, "order_item_id": None,
         "product_id": None, "category_en": None, "customer_state": "T", "order_status": "shipped"},
    ]
    m = quality.business_metrics(master(spark, rows)).first()
    assert (m["total_orders"], m["total_customers"], m["total_products"], m["total_categories"]) == (3, 2, 1, 2)
    assert m["avg_items_per_order"] == pytest.approx(2 / 3)
    assert m["avg_order_value_brl"] == pytest.approx(10.0)
    assert m["repeat_customer_rate"] == pytest.approx(50.0)
    assert m["avg_categories_per_customer"] == pytest.approx(1.0)  # two and none
    assert m["top_state_customers"] == "S"  # tie: name order
    assert quality.rounded_metrics(quality.business_metrics(master(spark, rows))).first()["avg_items_per_order"] == 0.67


def test_quality_exact_and_approximate(spark):
    table = master(spark, [{"price": 1.0}, {"price": None}, {"price": 1.0, "product_id": "q"}])
    for approximate in (False, True):
        got = {r["column"]: r for r in quality.data_quality(table, approximate).collect()}
        assert (got["price"]["null_count"], got["price"]["unique"]) == (1, 1)
        assert got["price"]["null_pct"] == 33.33
        assert got["product_id"]["unique"] == 2 and got["product_id"]["dtype"] == "string"
    assert {r["column"] for r in quality.columns_with_nulls(table).collect()} >= {"price", "item_total"}


def test_histogram_puts_maximum_in_last_bin(spark):
    table = master(spark, [{"delivery_days": float(d)} for d in (1, 2, 50, 99)] + [{"delivery_days": 0.0}, {"delivery_days": 100.0}])
    bins = {r["bin"]: r["n"] for r in reports.delivery_histogram(table).collect()}
    assert sum(bins.values()) == 4 and bins[1] == 2 and max(bins) == 50


def test_reports_drop_missing_months(spark):
    rows = [{}, {"order_purchase_timestamp": None}, {"order_purchase_timestamp": datetime.datetime(2018, 2, 1)}]
    got = {r["order_ym"]: r["orders"] for r in reports.orders_by_month(master(spark, rows)).collect()}
    assert got == {"2018-01": 1, "2018-02": 1}
    demand = reports.demand_by_month(master(spark, rows)).first()
    assert (demand["Ene"], demand["Feb"], demand["Mar"]) == (1, 1, 0)


def test_key_figures_come_from_one_scan(spark):
    table = stage(master(spark, [{"price": float(n), "order_id": f"o{n // 2}"} for n in range(20)]))
    plan = quality.grouped_figures(table, [quality._raw_side()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_both_sides_equal_each_table_alone(spark):
    rows = [
        {"order_id": f"o{n // 3}", "customer_unique_id": f"u{n % 7}" if n % 11 else None, "category_en": f"k{n % 4}" if n % 5 else None,
         "product_id": f"p{n % 6}", "order_status": "canceled" if n % 8 == 0 else "delivered", "customer_state": f"S{n % 3}",
         "delivery_days": None if n % 4 == 1 else float(n % 9), "review_score": None if n % 6 == 5 else float(n % 5 + 1),
         "price": 10.0 + n % 6 if n % 13 else 900.0}
        for n in range(90)
    ]
    raw = stage(master(spark, rows))
    flagged, cleaned = clean.flagged_master(raw), stage(clean_master(raw))
    both = {r["dataset"]: r.asDict() for r in quality.metrics_raw_and_clean(quality.grouped_sides(flagged)).collect()}
    for name, table in (("raw", raw), ("clean", cleaned)):
        alone = quality.business_metrics(table).first().asDict()
        assert {k: v for k, v in both[name].items() if k != "dataset"} == pytest.approx(alone)
    report = {r["metric"]: (r["before"], r["after"]) for r in quality.cleaning_report(quality.grouped_sides(flagged), flagged).collect()}
    assert report["rows"] == (90, cleaned.count()) and report["null_pct_category_en"][1] == 0
    assert report["orders"] == (30, cleaned.select("order_id").distinct().count())


def test_monthly_sketches_merge(spark):
    rows = [{"order_id": f"o{n}", "product_id": f"p{n % 40}", "order_purchase_timestamp": datetime.datetime(2018, n % 5 + 1, 2)} for n in range(400)]
    state = stage(quality.profile_by_month(master(spark, rows)))
    assert state.select("order_ym").distinct().count() == 5
    whole = {r["column"]: r for r in quality.merged_profile(state).collect()}
    assert whole["product_id"]["unique"] == 40 and abs(whole["order_id"]["unique"] - 400) <= 8 and whole["price"]["rows"] == 400
    some = {r["column"]: r for r in quality.merged_profile(state.where("order_ym <= '2018-02'")).collect()}
    assert some["order_id"]["rows"] == 160 and abs(some["order_id"]["unique"] - 160) <= 4
