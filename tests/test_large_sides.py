"""Rows per customer, unit or unit and category are not broadcast, however small their files are."""

from conftest import master
from test_recommend import purchases, random_baskets

from cartwise.operators import evaluate, recommend
from cartwise.operators.cooccurrence import copurchase_similarity
from cartwise.operators.interactions import customer_baskets, popularity
from cartwise.operators.recommend import Variant
from cartwise.operators.splits import with_split
from cartwise.session import stage


def joins(df) -> list[str]:
    """The physical joins with their keys, as planned from file sizes."""
    return [x for x in df._jdf.queryExecution().sparkPlan().toString().split("\n") if "Join" in x]


def broadcast_keys(df) -> list[str]:
    return [x.split("[")[1].split("#")[0] for x in joins(df) if "BroadcastHashJoin" in x]


def test_baskets_meet_their_customers_in_a_shuffle(spark):
    baskets = stage(customer_baskets(master(spark, purchases(random_baskets(3)))))
    found = recommend.attach_to_customers(baskets, recommend.basket_units(baskets))
    assert sum("SortMergeJoin [cats" in x for x in joins(found)) == 1
    assert found.count() == baskets.count()


def test_evaluations_do_not_broadcast_units(spark):
    table = stage(master(spark, purchases(random_baskets(4))))
    baskets, popular = stage(customer_baskets(table)), stage(popularity(table))
    similarity = stage(copurchase_similarity(baskets, 1))
    split = with_split(table, "2017-12", "2017-12")
    periods = evaluate.evaluate_periods(split, baskets, similarity, popular, 3)
    assert not {"unit_id", "customer_unique_id"} & set(broadcast_keys(periods))
    assert periods.first()["recall"] >= 0
    tested = evaluate.backtest(baskets, table, similarity, popular, Variant("v", "sim", 0.6), 3)
    assert not {"unit_id", "customer_unique_id"} & set(broadcast_keys(tested))
