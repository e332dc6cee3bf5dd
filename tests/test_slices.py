"""Large tables are built slice by slice: the same rows, and no shuffle file of an earlier slice stays."""

import dataclasses
import datetime
import os

import pytest
from conftest import sources, ts
from test_one_exchange import purchases
from test_runs import shop

from cartwise import session
from cartwise.operators import clean, evolution, features, interactions, master, quality
from cartwise.session import STAGED, free_shuffles, in_slice, stage, stage_in_slices
from cartwise.sources import layout


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.fixture
def small_slices(monkeypatch):
    monkeypatch.setattr(session, "SLICE_ROWS", 7)


def odd_shop(spark):
    """Repeated lines and names, orders without items, null keys."""
    src = shop(spark)
    orders = spark.createDataFrame(
        [("empty", "c1", "delivered", ts("2018-01-01"), None, None, None, None), (None, None, None, None, None, None, None, None)],
        src.orders.schema,
    )
    items = src.items.unionByName(src.items.limit(3)).unionByName(
        spark.createDataFrame([(None, 1, None, None, 1.0, 0.0), ("nobody", 1, None, None, 2.0, None)], src.items.schema)
    )
    names = src.category_map.unionByName(src.category_map.limit(1)).unionByName(
        spark.createDataFrame([(None, "x")], src.category_map.schema)
    )
    sellers = src.sellers.unionByName(src.sellers.limit(1))
    return dataclasses.replace(src, orders=src.orders.unionByName(orders), items=items, category_map=names, sellers=sellers)


def test_slices_hold_every_row_once(spark):
    table = spark.createDataFrame([(k,) for k in ["a", "b", None, "a", "c", None]], "k string")
    parts = [table.where(in_slice(["k"], i, 3)).collect() for i in range(3)]
    assert sum(map(len, parts)) == 6 and sum(r.k is None for p in parts for r in p) == 2
    assert sum(1 for p in parts if any(r.k == "a" for r in p)) == 1


def test_a_master_in_slices_is_the_same(spark, small_slices):
    src = odd_shop(spark)
    whole, staged = master.build_master(src), master.staged_master(src)
    assert staged.columns == whole.columns and staged.schema.simpleString() == whole.schema.simpleString()
    assert rows(staged) == rows(whole)


def test_a_master_with_large_lookups_is_the_same(spark, monkeypatch):
    src = odd_shop(spark)
    found = rows(master.build_master(src))
    monkeypatch.setattr(master, "is_small", lambda staged: False)
    assert rows(master.build_master(src)) == found


def test_staged_master_holds_no_derived_columns(spark):
    at = len(STAGED)
    staged = master.staged_master(shop(spark))
    stored = spark.read.parquet(STAGED[-1]).columns
    assert len(STAGED) > at and "item_total" not in stored and "price" in stored and "item_total" in staged.columns


def test_cleaning_stages_few_values_only(spark):
    raw = stage(master.build_master(odd_shop(spark)))
    at = len(STAGED)
    cleaned = clean.clean_master(raw)
    stored = [spark.read.parquet(p) for p in STAGED[at:]]
    assert all(len(t.columns) <= 3 for t in stored) and not any("value" in t.columns for t in stored)
    assert rows(cleaned) == rows(stage(cleaned))


def test_tables_of_slices_are_the_same(spark, monkeypatch):
    table = stage(purchases(spark))
    cutoffs = ["2018-02", "2018-03", "2018-04"]

    def build():
        return {
            "baskets": rows(stage_in_slices(table, ["customer_unique_id"], interactions.customer_baskets)),
            "popularity": rows(interactions.popularity(table)),
            "rfm": rows(features.build_rfm(table)),
            "categories": rows(features.build_category_features(table)),
            "units": rows(evolution.cutoff_units(table, cutoffs).drop("unit_id")),
            "popular": rows(evolution.cutoff_popularity(table, cutoffs)),
            "products": rows(evolution.monthly_products(table)),
        }

    whole = build()
    monkeypatch.setattr(session, "SLICE_ROWS", 5)
    assert build() == whole


def test_months_are_written_in_slices(spark, small_slices, tmp_path):
    table = stage(master.build_master(odd_shop(spark)))
    stored = master.without_derived(table.withColumn("delivery_days", table.delivery_days + 1))
    layout.write_master(stored, str(tmp_path / "m"))
    again = master.derived_again(layout.read_master(spark, str(tmp_path / "m"), stored.schema), table.columns)
    assert again.columns == table.columns
    assert rows(again) == rows(table.withColumn("delivery_days", table.delivery_days + 1))


@pytest.mark.parametrize("cells", [1, 40])
def test_columns_counted_in_groups_give_the_same_profile(spark, monkeypatch, cells):
    day = datetime.datetime(2018, 1, 1)
    table = stage(
        spark.createDataFrame(
            [("a", 0.0, day, 1, True), ("a", -0.0, day, 2, None), (None, float("nan"), None, 2, False), ("b", None, day, 1, True)],
            "s string, d double, t timestamp, i int, b boolean",
        )
    )
    whole = quality.data_quality(table).collect()
    assert {r.column: r.unique for r in whole} == {"s": 2, "d": 3, "t": 1, "i": 2, "b": 2}
    monkeypatch.setattr(quality, "CELLS", cells // 10)
    assert quality.data_quality(table).collect() == whole


def test_no_shuffle_file_of_an_earlier_slice_stays(spark, monkeypatch):
    """Before, the files of all shuffles of a session stayed until the driver happened to collect."""
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    folders = [d.getPath() for d in env.blockManager().diskBlockManager().localDirs()]

    def held():
        found = 0
        for top in folders:
            for d, _, names in os.walk(top):
                for n in names:
                    try:
                        found += os.lstat(f"{d}/{n}").st_size * n.startswith("shuffle_")
                    except OSError:
                        pass
        return found

    free_shuffles(spark)
    table = spark.range(200_000).selectExpr("id AS k", "uuid() AS v")
    monkeypatch.setattr(session, "SLICE_ROWS", 50_000)
    most = []
    real = session.free_shuffles
    monkeypatch.setattr(session, "free_shuffles", lambda s: (most.append(held()), real(s)))
    found = stage_in_slices(table, ["k"], lambda part: part.repartition("k"))
    assert found.count() == 200_000
    assert len(most) >= 3 and most[-1] < 2.5 * max(1, most[0])
