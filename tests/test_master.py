from conftest import sources, ts

from cartwise.operators.master import build_master, payments_per_order
from cartwise.sources.tables import read_sources, write_sources


def _rows(src, key="order_id"):
    return {(r[key], r["order_item_id"]): r for r in build_master(src).collect()}


def test_days_late_and_missing_dates(spark):
    src = sources(
        spark,
        orders=[
            {"order_id": "early", "customer_id": "c", "order_purchase_timestamp": ts("2018-01-02T12:00"),
             "order_delivered_customer_date": ts("2018-01-02T00:00"),
             "order_estimated_delivery_date": ts("2018-01-12T12:00")},
            {"order_id": "late", "customer_id": "c", "order_purchase_timestamp": ts("2018-01-01"),
             "order_delivered_customer_date": ts("2018-01-20"),
             "order_estimated_delivery_date": ts("2018-01-10")},
            {"order_id": "lost", "customer_id": "c", "order_purchase_timestamp": ts("2018-01-01"),
             "order_estimated_delivery_date": ts("2018-01-10")},
            {"order_id": "undated", "customer_id": "c"},
        ],
        customers=[{"customer_id": "c", "customer_unique_id": "u"}],
    )
    rows = _rows(src)
    assert rows[("early", None)]["delivery_days"] == -1  # 12 hours before: rounded down
    assert rows[("early", None)]["is_late"] == 0
    assert rows[("late", None)]["delivery_delay"] == 10 and rows[("late", None)]["is_late"] == 1
    assert rows[("lost", None)]["delivery_days"] is None and rows[("lost", None)]["is_late"] == 0
    assert rows[("undated", None)]["order_ym"] is None
    assert rows[("late", None)]["order_ym"] == "2018-01"
    assert rows[("late", None)]["customer_unique_id"] == "u"


def test_items_labels_and_ratios(spark):
    src = sources(
        spark,
        orders=[{"order_id": o, "customer_id": "x"} for o in ("o1", "empty")],
        items=[
            {"order_id": "o1", "order_item_id": 1, "product_id": "p1", "seller_id": "s1", "price": 10.0, "freight_value": 2.0},
            {"order_id": "o1", "order_item_id": 2, "product_id": "p2", "seller_id": "s2", "price": 0.0, "freight_value": 2.0},
            {"order_id": "o1", "order_item_id": 3, "product_id": "p3", "seller_id": "s1", "price": None, "freight_value": 2.0},
        ],
        products=[
            {"product_id": "p1", "product_category_name": "moveis_e_decor"},
            {"product_id": "p2", "product_category_name": "bebes"},
            {"product_id": "p3"},
        ],
        category_map=[{"product_category_name": "bebes", "product_category_name_english": "baby"}],
        sellers=[{"seller_id": "s1", "seller_state": "SP"}],
    )
    rows = _rows(src)
    assert len(rows) == 4
    assert rows[("o1", 1)]["category_en"] == "Moveis E Decor"
    assert rows[("o1", 2)]["category_en"] == "baby"
    assert rows[("o1", 3)]["category_en"] is None
    assert rows[("o1", 1)]["freight_ratio"] == 0.2
    assert rows[("o1", 2)]["freight_ratio"] is None
    assert rows[("o1", 3)]["item_total"] is None
    assert rows[("o1", 1)]["seller_state"] == "SP" and rows[("o1", 2)]["seller_state"] is None
    assert rows[("empty", None)]["price"] is None and rows[("empty", None)]["customer_unique_id"] is None


def test_reviews_and_payments_do_not_multiply_items(spark):
    src = sources(
        spark,
        orders=[{"order_id": "o1", "customer_id": "x"}],
        items=[{"order_id": "o1", "order_item_id": i, "price": 1.0, "freight_value": 0.0} for i in (1, 2)],
        reviews=[{"order_id": "o1", "review_id": "a", "review_score": 5}, {"order_id": "o1", "review_id": "b", "review_score": 2}],
        payments=[
            {"order_id": "o1", "payment_type": "voucher", "payment_installments": 1, "payment_value": 3.0},
            {"order_id": "o1", "payment_type": "card", "payment_installments": 4, "payment_value": 4.0},
        ],
    )
    rows = _rows(src)
    assert len(rows) == 2
    row = rows[("o1", 2)]
    assert (row["review_score"], row["review_count"]) == (3.5, 2)
    assert (row["total_payment"], row["num_installments"], row["payment_type"]) == (7.0, 4, "card")


def test_payment_type_of_only_nulls_is_null(spark):
    src = sources(spark, payments=[{"order_id": "o", "payment_value": None}])
    row = payments_per_order(src.payments).first()
    assert row["payment_type"] is None and row["total_payment"] == 0.0


def test_csv_is_read_by_name_and_keeps_leading_zeros(spark, tmp_path):
    src = sources(
        spark,
        orders=[{"order_id": "o1", "customer_id": "c", "order_purchase_timestamp": ts("2018-03-04T05:06:07")}],
        customers=[{"customer_id": "c", "customer_unique_id": "u", "customer_zip_code_prefix": "00123"}],
        reviews=[{"review_id": "r", "order_id": "o1", "review_score": 4}],
    )
    write_sources(src, str(tmp_path), "csv")
    spark.createDataFrame(
        [('line one\nline "two"', 5, "o1", "r1")], "comment string, review_score int, order_id string, review_id string"
    ).write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{tmp_path}/reviews.csv")
    again = read_sources(spark, str(tmp_path), "csv", multiline=("reviews",))
    assert again.customers.first()["customer_zip_code_prefix"] == "00123"
    assert again.orders.first()["order_purchase_timestamp"] == ts("2018-03-04T05:06:07")
    assert again.reviews.collect() == [("r1", "o1", 5)]
    assert again.items.count() == 0
