"""Rows per customer move as rarely as they can: plans, and results beside plain counting."""

from __future__ import annotations

import datetime

import pyarrow as pa
import pytest

from cartwise.operators import cooccurrence, evaluate, evolution, features, interactions, latent, threshold
from tests.conftest import master


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return plan(df).count("Exchange hashpartitioning")


def purchases(spark, months: int = 4):
    rows = []
    for user, cats in {"u": "ABAC", "v": "ABDC", "w": "A", "x": "CBBA", "y": "BA"}.items():
        for n, cat in enumerate(cats):
            when = datetime.datetime(2018, 1 + n % months, 1)
            rows.append({"order_id": f"{user}{n}", "customer_unique_id": user, "category_en": cat, "order_purchase_timestamp": when})
    rows.append({"order_id": "u0", "customer_unique_id": "u", "category_en": "A", "order_item_id": 2, "order_purchase_timestamp": datetime.datetime(2018, 1, 1)})
    return master(spark, rows)


def test_matrix_moves_rows_once(spark):
    found = interactions.interactions(purchases(spark))
    assert exchanges(found) == 1
    assert {(r.user, r.category): r.interactions for r in found.collect()}[("u", "A")] == 2


def test_baskets_move_rows_twice(spark):
    found = interactions.customer_baskets(purchases(spark))
    assert exchanges(found) == 2
    rows = {r.customer_unique_id: (r.cats, r.counts, r.n_items) for r in found.collect()}
    assert rows["u"] == (["A", "B", "C"], [2, 1, 1], 5)
    assert rows["x"] == (["C", "B", "A"], [1, 2, 1], 4)


def test_a_basket_of_one_block_moves_once(spark):
    baskets = interactions.customer_baskets(purchases(spark))
    blocks = cooccurrence.weighted_blocks(baskets, baskets["cats"], ())
    assert blocks.where("right IS NOT NULL").count() == 0


@pytest.fixture
def units_and_popular(spark):
    units = spark.createDataFrame(
        [("1", 0, ["A", "B"], "C", 3), ("1", 1, ["D"], "A", 1), ("2", 2, ["A", "Z"], "B", 2), ("2", 3, ["A"], "Z", 9), ("3", 4, ["A"], "B", 5)],
        "cutoff string, unit_id bigint, cats array<string>, test string, customers bigint",
    )
    popular = spark.createDataFrame(
        [("1", c, n + 1) for n, c in enumerate("ABCD")] + [("2", c, n + 1) for n, c in enumerate("BA")],
        "cutoff string, category_en string, rank int",
    )
    return units, popular


def test_places_in_the_popularity_list_without_a_shuffle_of_units(units_and_popular):
    units, popular = units_and_popular
    found = threshold.popular_places(units, popular, ["cutoff"])
    assert "Exchange" not in plan(found)
    counted = evaluate.popularity_rank_counts(units, popular, ["cutoff"])
    assert plan(counted).count("Exchange") == 1 and "Generate" not in plan(counted)
    assert sorted(map(tuple, counted.collect())) == [("1", 1, 4), ("2", 1, 2)]


def test_places_are_the_same_by_a_join(units_and_popular, monkeypatch):
    units, popular = units_and_popular
    sent = evaluate.popularity_rank_counts(units, popular, ["cutoff"]).collect()
    monkeypatch.setattr(threshold, "SENT_BYTES", 1)
    assert sorted(evaluate.popularity_rank_counts(units, popular, ["cutoff"]).collect()) == sorted(sent)


def test_cutoff_units_move_a_state_once_for_all_its_cutoffs(spark, monkeypatch):
    cutoffs = ["2018-02", "2018-03", "2018-04", "2018-05", "2018-06"]
    monkeypatch.setattr(evolution, "stage", lambda df: df)
    units = evolution.cutoff_units(purchases(spark), cutoffs)
    lines = plan(units).splitlines()
    repeated = next(i for i, line in enumerate(lines) if "Generate explode(active" in line)
    assert not any("Exchange" in line for line in lines[:repeated])
    found = {(r.cutoff, tuple(r.cats), r.test): r.customers for r in units.collect()}
    assert found[("2018-02", ("A",), "B")] == 2 and found[("2018-06", ("A", "B", "D"), "C")] == 1
    assert sum(n for (c, *_), n in found.items() if c == "2018-06") == 4


def test_ranking_holds_a_bounded_number_of_units(monkeypatch):
    monkeypatch.setattr(latent, "UNITS", 3)
    batch = pa.RecordBatch.from_pydict({"cats": [["A"], ["B", "Q"], [], ["C", "A"], ["A"], ["B"], ["C"]]})
    parts = list(latent.slices(iter([batch])))
    assert [len(p) for p in parts] == [3, 3, 1]
    assert [o.tolist() for o in latent.owned_of(parts[0]["cats"], ["A", "B", "C"], [0, 1, 2])] == [[0], [1], []]
    assert [o.tolist() for o in latent.owned_of(parts[1]["cats"], ["A", "B", "C"], [2, 0])] == [[1], [2, 0]]


def test_customer_features_move_rows_once(spark):
    base = features.rfm_base(purchases(spark))
    assert exchanges(base) == 1
    rows = {r.customer_unique_id: (r.frequency, r.category_diversity, r.total_items, r.last_category) for r in base.collect()}
    assert rows["u"] == (4, 3, 5, "C") and rows["w"] == (1, 1, 1, "A")
