import datetime

import numpy as np
import pytest
from conftest import master
from pyspark.sql import functions as F

from cartwise.functions.columns import right_closed_label
from cartwise.operators.features import build_category_features, build_rfm, quintile_score
from cartwise.operators.interactions import customer_baskets, customer_history, history_rows, popularity
from cartwise.operators.quantiles import exact_quantiles, quintile_limits


def _scores(spark, values, reverse=False):
    df = spark.createDataFrame([(float(v),) for v in values], "v double").coalesce(3)
    limits = quintile_limits(df, ["v"]).select(F.struct("c1", "c2", "c3", "c4")).scalar()
    rows = df.withColumn("l", limits).select("v", quintile_score(F.col("l"), "v", reverse).alias("s")).collect()
    return {r["v"]: r["s"] for r in rows}


def test_quintiles_with_distinct_edges(spark):
    got = _scores(spark, range(1, 101))
    assert [got[float(v)] for v in (1, 20, 21, 40, 41, 60, 61, 80, 81, 100)] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert _scores(spark, range(1, 101), reverse=True)[1.0] == 5


def test_quintiles_fall_back_on_tied_values(spark):
    assert _scores(spark, [1] * 97 + [2, 2, 3]) == {1.0: 1, 2.0: 5, 3.0: 5}
    assert _scores(spark, [7] * 10) == {7.0: 3}


@pytest.mark.parametrize("n", [1, 2, 7, 400])
def test_exact_quantiles_match_numpy(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.gamma(2.0, 50.0, n), 1)
    df = spark.createDataFrame([(float(v), int(i % 3)) for i, v in enumerate(values)], "v double, g int")
    probabilities = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}
    row = exact_quantiles(df.repartition(5), "v", probabilities).first()
    for name, p in probabilities.items():
        assert row[name] == pytest.approx(np.quantile(values, p))
    for r in exact_quantiles(df, "v", {"m": 0.5}, ["g"]).collect():
        assert r["m"] == pytest.approx(np.median(values[r["g"] :: 3]))


def test_quantile_of_a_column_with_one_very_frequent_value(spark):
    values = [5.0] * 3000 + [float(v) for v in range(6000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_quantiles(df, "v", {"q": 0.4}).first()["q"] == pytest.approx(np.quantile(values, 0.4))


def test_segment_edges_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.5,), (1.6,), (5.0,), (5.2,), (None,)], "v double")
    labels = [r[0] for r in df.select(right_closed_label("v", [0, 1.5, 2.5, 5.1], ["a", "b", "c"])).collect()]
    assert labels == [None, "a", "b", "c", None, None]


def test_rfm_row(spark):
    day = datetime.datetime(2018, 1, 1)
    rows = [
        {"order_id": "1", "order_purchase_timestamp": day, "category_en": "A", "order_item_id": 2},
        {"order_id": "1", "order_purchase_timestamp": day, "category_en": "B", "order_item_id": 1},
        {"order_id": "0", "order_purchase_timestamp": None, "category_en": None, "payment_type": None, "price": None, "freight_value": None},
        {"customer_unique_id": "v", "order_id": "9", "order_purchase_timestamp": day + datetime.timedelta(days=3, hours=1)},
    ]
    got = {r["customer_unique_id"]: r for r in build_rfm(master(spark, rows)).collect()}["u"]
    assert (got["recency"], got["frequency"], got["total_items"]) == (3, 2, 3)
    assert got["monetary"] == 22.0 and got["avg_ticket"] == 11.0
    assert got["category_diversity"] == 2 and got["n_distinct_payments"] == 1
    assert got["last_category"] == "A"  # same order: the item number decides
    assert got["preferred_category"] == "A"  # tie: name order


def test_category_features_rank_and_repeat(spark):
    rows = [{"category_en": c, "customer_unique_id": u} for c, u in
            [("A", "u"), ("A", "u"), ("A", "v"), ("A", "w"), ("A", None), ("B", "u"), ("B", "v"), ("B", "w"),
             ("B", "x"), ("B", "y"), ("C", "u"), ("C", "v"), ("C", "w")]]
    got = {r["category_en"]: r for r in build_category_features(master(spark, rows)).collect()}
    assert [got[c]["total_orders"] for c in "ABC"] == [5, 5, 3]
    assert [got[c]["popularity_rank"] for c in "ABC"] == [1, 1, 3]  # average rank 1.5, cut
    assert got["A"]["total_customers"] == 3
    assert got["A"]["repeat_rate"] == pytest.approx(1 / 3) and got["B"]["repeat_rate"] == 0


def test_popularity_breaks_ties_by_name_and_skips_null(spark):
    table = master(spark, [{"category_en": c} for c in ("B", "A", None, "C", "C")])
    got = [(r["category_en"], r["rank"], r["pct_of_total"]) for r in popularity(table).orderBy("rank").collect()]
    assert got == [("C", 1, 50.0), ("A", 2, 25.0), ("B", 3, 25.0)]


def test_history_order_and_counts(spark):
    day = datetime.datetime(2018, 1, 1)
    rows = [
        {"order_id": "2", "order_purchase_timestamp": None, "category_en": "Z"},
        {"order_id": "1", "order_purchase_timestamp": day, "order_item_id": 2, "category_en": "B"},
        {"order_id": "1", "order_purchase_timestamp": day, "order_item_id": 1, "category_en": "C"},
        {"order_id": "0", "order_purchase_timestamp": day + datetime.timedelta(days=1), "category_en": "C"},
    ]
    got = customer_history(master(spark, rows)).first()
    assert got["category_history"] == ["C", "B", "Z"]  # undated rows last
    assert (got["n_categories"], got["n_orders"]) == (3, 4)
    placed = history_rows(master(spark, rows)).orderBy("position").collect()
    assert [r["category_en"] for r in placed] == ["C", "B", "C", "Z"]
    assert [r["position"] for r in placed] == [1, 2, 3, 4]
    assert customer_baskets(master(spark, rows)).first()["counts"] == [2, 1, 1]


def test_history_of_one_customer_holding_most_rows(spark):
    rows = [
        {"customer_unique_id": "hot" if i % 3 else f"u{i % 50}", "category_en": f"c{i % 7}", "order_id": f"{i:05d}",
         "order_purchase_timestamp": datetime.datetime(2018, 1, 1 + i % 5)}
        for i in range(1500)
    ]
    got = history_rows(master(spark, rows)).collect()
    want = {}
    for r in sorted(rows, key=lambda r: (r["order_purchase_timestamp"], r["order_id"])):
        want.setdefault(r["customer_unique_id"], []).append(r["category_en"])
    found = {}
    for r in sorted(got, key=lambda r: r["position"]):
        found.setdefault(r["customer_unique_id"], []).append(r["category_en"])
    assert found == want
