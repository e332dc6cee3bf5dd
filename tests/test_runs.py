import dataclasses
import datetime
import random

import pytest
from pyspark.sql import functions as F
from conftest import master, sources, ts
from test_recommend import naive_fit, naive_loo

from cartwise.operators import evolution, splits
from cartwise.operators.recommend import recommend_all
from cartwise.operators.interactions import customer_baskets
from cartwise.plans import retrain
from cartwise.session import stage
from cartwise.sources import model_store


def shop(spark, users=50, seed=3):
    rng = random.Random(seed)
    orders, items = [], []
    for n in range(150):
        when = datetime.datetime(2017, 1, 1) + datetime.timedelta(days=rng.randrange(600), hours=n % 24)
        orders.append(
            {"order_id": f"o{n:03d}", "customer_id": f"c{n % users}", "order_status": "delivered",
             "order_purchase_timestamp": when, "order_delivered_customer_date": when + datetime.timedelta(days=3),
             "order_estimated_delivery_date": when + datetime.timedelta(days=9)}
        )
        for i in range(rng.choice([1, 1, 2])):
            items.append({"order_id": f"o{n:03d}", "order_item_id": i + 1, "product_id": f"p{rng.randrange(8)}",
                          "seller_id": "s", "price": 10.0 + n % 7, "freight_value": 1.0})
    return sources(
        spark,
        orders=orders,
        items=items,
        customers=[{"customer_id": f"c{i}", "customer_unique_id": f"u{i}", "customer_state": "S"} for i in range(users)],
        products=[{"product_id": f"p{i}", "product_category_name": f"cat_{i}"} for i in range(8)],
        sellers=[{"seller_id": "s", "seller_state": "S"}],
    )


def test_retrain_is_versioned_logged_once_and_loadable(spark, tmp_path):
    src = shop(spark)
    params = {"method": "hybrid", "alpha": 0.8, "min_support": 1}
    folder = str(tmp_path / "models")
    retrain.monthly_retrain(src, params, folder, "2018-01", version="20180131_0000")
    retrain.monthly_retrain(src, params, folder, version="20180831_0000")
    retrain.monthly_retrain(src, params, folder, version="20180831_0000")
    log = model_store.read_log(spark, folder).collect()
    assert [(r["version"], r["cutoff_ym"]) for r in log] == [("20180131_0000", "2018-01"), ("20180831_0000", "full")]
    assert log[1]["n_users_train"] == 50 and log[1]["n_users_eval"] <= 50
    assert model_store.latest_version(spark, folder) == "20180831_0000"
    model = model_store.load_model(spark, folder)
    assert model.params["alpha"] == 0.8 and model.n_cats == 8
    assert model_store.load_metrics(spark, folder, "20180831_0000").first()["n_users"] == log[1]["n_users_eval"]
    clean = stage(retrain.clean_master(stage(retrain.build_master(src))))
    got = recommend_all(stage(customer_baskets(clean)), model.similarity, model.popular, model.variant, 2)
    assert got.select("customer_unique_id").distinct().count() == 50
    with pytest.raises(ValueError):
        retrain.monthly_retrain(src, params, folder, "2018-01", cutoff="sometime")


def test_split_summary_ignores_undated_rows(spark):
    rows = [{"order_purchase_timestamp": datetime.datetime(y, m, 1), "customer_unique_id": u}
            for y, m, u in [(2017, 8, "a"), (2017, 9, "a"), (2017, 10, "b"), (2018, 4, "c"), (2018, 6, "c")]]
    rows.append({"order_purchase_timestamp": None})
    got = {r["split"]: r for r in splits.split_summary(splits.with_split(master(spark, rows))).collect()}
    assert (got["train"]["from_month"], got["train"]["to_month"], got["train"]["months"]) == ("2017-08", "2017-09", 2)
    assert (got["val"]["from_month"], got["val"]["to_month"], got["val"]["orders"]) == ("2017-10", "2018-03", 1)
    assert (got["backtest"]["from_month"], got["backtest"]["to_month"]) == ("2018-04", "2018-06")
    assert got["backtest"]["orders"] == 2 and got["backtest"]["customers"] == 1


def _monthly_master(spark, seed=8):
    rng = random.Random(seed)
    rows = []
    for n in range(400):
        rows.append(
            {"order_id": f"o{n // 2:03d}", "customer_unique_id": f"u{(n // 2) % 40}", "order_item_id": n % 2,
             "order_purchase_timestamp": datetime.datetime(2017 + (n // 2) % 2, 1 + (n // 80) % 12, 1 + n % 2 * 0, n // 2 % 24),
             "category_en": f"k{rng.choices(range(7), [7, 6, 5, 4, 3, 2, 1])[0]}"}
        )
    return rows


def test_monthly_products_add_up_to_the_gram_matrix(spark):
    rows = _monthly_master(spark)
    table = master(spark, rows)
    monthly = evolution.monthly_products(table).collect()
    for cutoff in sorted({r["month"] for r in monthly}):
        counts = {}
        for r in rows:
            if r["order_purchase_timestamp"].strftime("%Y-%m") <= cutoff:
                counts.setdefault((r["customer_unique_id"], r["category_en"]), set()).add(r["order_id"])
        want = {}
        for (u, a), x in counts.items():
            for (v, b), y in counts.items():
                if u == v and a <= b:
                    want[a, b] = want.get((a, b), 0) + len(x) * len(y)
        got = {}
        for r in monthly:
            if r["month"] <= cutoff:
                got[r["cat_a"], r["cat_b"]] = got.get((r["cat_a"], r["cat_b"]), 0) + r["dot"]
        assert {k: v for k, v in got.items() if v} == want


def test_expanding_refits_equal_single_fits(spark):
    rows = _monthly_master(spark)
    table = stage(master(spark, rows))
    got = {r["cutoff"]: r for r in evolution.expanding_refits(table, 3, k=2, warm_up=4, min_users=5).collect()}
    months = sorted({r["order_purchase_timestamp"].strftime("%Y-%m") for r in rows})
    assert sorted(got) == months[4:]
    for cutoff in (months[4], months[-1]):
        known = [r for r in rows if r["order_purchase_timestamp"].strftime("%Y-%m") <= cutoff]
        known.sort(key=lambda r: (r["order_purchase_timestamp"], r["order_id"], r["order_item_id"]))
        orders, history = {}, {}
        for r in known:
            orders.setdefault(r["category_en"], set()).add(r["order_id"])
            history.setdefault(r["customer_unique_id"], []).append(r["category_en"])
        popular = sorted(orders, key=lambda c: (-len(orders[c]), c))
        model = (popular, None, None)
        recall, precision, _, n = naive_loo(model, history, 2, None)
        row = got[cutoff]
        assert row["eval_users"] == n and row["recall_baseline"] == pytest.approx(recall)
        assert row["train_orders"] == len({r["order_id"] for r in known})
        assert row["train_customers"] == len(history)
    assert naive_fit({"u": ["A"]}, 1)[0] == ["A"]


def test_feature_and_selection_runs(spark, tmp_path):
    src = shop(spark)
    found = retrain.feature_run(src, 3)
    assert found["rfm"].count() == 50 and found["matrix_stats"].first()["n_categories"] == 8
    assert [r["k"] for r in found["model_comparison"].orderBy("k").collect()] == [5, 10, 20]
    assert {r["split"] for r in found["split_evaluation"].collect()} <= {"val", "backtest"}
    assert found["user_factors"].count() == 50
    picked = retrain.selection_run(src, str(tmp_path / "m"), k=3, n_splits=2, trials=2)
    assert picked["winner"].count() == 3 and picked["leave_one_out"].first()["n_users"] > 0
    assert picked["backtest"].count() == 1 and picked["cross_validation"].count() == 2
    assert picked["families"].count() == 5 and picked["factor_importance"].count() == 7
    assert model_store.load_model(spark, str(tmp_path / "m")).params["method"] == "hybrid"


def test_split_summary_lists_empty_periods(spark):
    rows = [{"order_purchase_timestamp": ts("2017-01-05")}, {"order_purchase_timestamp": ts("2018-05-05")}]
    got = {r["split"]: r for r in splits.split_summary(splits.with_split(master(spark, rows))).collect()}
    assert set(got) == {"train", "val", "backtest"} and (got["val"]["months"], got["val"]["orders"]) == (0, 0)


def test_widest_customers_have_a_segment(spark):
    from cartwise.plans import reports

    wide = spark.createDataFrame([(101,), (6,), (1,)], "n_categories int")
    got = {r["segment"]: r["customers"] for r in reports.diversity_segments(wide).collect()}
    assert got == {"6+ categorías": 2, "1 categoría": 1}


def test_a_run_that_dies_between_two_tables_is_not_read(spark, tmp_path):
    """Tables without a record are no version; the version before stays the newest."""
    src, folder = shop(spark), str(tmp_path / "models")
    retrain.monthly_retrain(src, {"method": "svd", "n_components": 2}, folder, version="1")
    first = model_store.load_model(spark, folder)
    metrics = model_store.load_metrics(spark, folder, "1")
    dies = dataclasses.replace(first, products=first.products.withColumn("dot", F.raise_error(F.lit("lost"))))
    for version in ("1", "2"):  # a new version, and the published one written again
        with pytest.raises(Exception, match="lost"):
            model_store.publish_model(dies, metrics, folder, version)
    assert len(list((tmp_path / "models" / "version=2").glob("attempt=*/popular"))) == 1  # half of it is there
    assert model_store.latest_version(spark, folder) == "1" and model_store.read_log(spark, folder).count() == 1
    with pytest.raises(ValueError, match="no published version 2"):
        model_store.load_model(spark, folder, "2")
    baskets = stage(customer_baskets(stage(retrain.clean_master(stage(retrain.build_master(src))))))
    again = model_store.load_model(spark, folder, "1")
    lists = [recommend_all(baskets, m.scoring, m.popular, m.variant, 3).collect() for m in (first, again)]
    assert sorted(lists[0]) == sorted(lists[1]) and lists[0]
    model_store.publish_model(first, metrics, folder, "2", measures={"backtest": {"recall": 0.5}})
    assert model_store.latest_version(spark, folder) == "2"
    assert model_store.load_metadata(spark, folder)["measures"]["backtest"] == {"recall": 0.5}
    with pytest.raises(ValueError, match="no published version"):
        model_store.load_model(spark, str(tmp_path / "empty"))
