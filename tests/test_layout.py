"""Stored layouts: buckets that meet without a shuffle, months that are read only where wanted."""

import re

import pytest
from conftest import ts
from test_runs import shop

from cartwise.operators import clean, splits
from cartwise.operators.master import build_master
from cartwise.plans import retrain
from cartwise.session import stage
from cartwise.sources import layout, model_store


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets_give_the_same_master_with_one_scan_of_the_items(spark, tmp_path):
    src = shop(spark)
    more = spark.createDataFrame([("empty", "c1", "delivered", ts("2018-01-01"), None, None, None, None)], src.orders.schema)
    src = src.__class__(**{**vars(src), "orders": src.orders.unionByName(more)})
    stored = layout.bucket_sources(src, str(tmp_path), 4)
    columns = build_master(src).columns
    assert sorted(map(str, build_master(stored).select(columns).collect())) == sorted(map(str, build_master(src).collect()))
    text = plan(build_master(stored))
    items, orders = (re.findall(rf"FileScan parquet [^\n]*{n}_[^\n]*", text) for n in ("items", "orders"))
    assert len(items) == 1 and len(orders) == 1 and "Bucketed: true" in items[0]
    # Between the scans and the join of both lies no exchange: the first join up from the items is fed by sorts or scans only.
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if re.search(r"FileScan parquet [^\n]*items_", line))
    depth = lines[at].index("FileScan")
    for line in reversed(lines[:at]):
        found = re.search(r"(SortMergeJoin|Exchange|Sort|Filter|Project|ColumnarToRow)", line)
        if found and found.start() < depth:
            depth = found.start()
            assert found.group() != "Exchange"
            if found.group() == "SortMergeJoin":
                break
    else:
        raise AssertionError(text)


def test_lines_of_buckets_move_for_products_only(spark, tmp_path):
    """With no table small enough for Spark to broadcast: customers meet orders, not lines, and sellers are few."""
    src, limit = shop(spark), "spark.sql.autoBroadcastJoinThreshold"
    stored, before = layout.bucket_sources(src, str(tmp_path), 4), spark.conf.get(limit)
    try:
        spark.conf.set(limit, "-1")
        built = build_master(stored)
        text, rows = plan(built), built.select(build_master(src).columns).collect()
    finally:
        spark.conf.set(limit, before)
    assert sorted(map(str, rows)) == sorted(map(str, build_master(src).collect()))
    moved = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line]
    assert sum("(product_id#" in line for line in moved) == 2 and not any("(seller_id#" in line for line in moved)
    # The exchanges by customer lie below the join of orders and items.
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if re.search(r"FileScan parquet [^\n]*items_", line))
    assert max(i for i, line in enumerate(lines) if "Exchange hashpartitioning(customer_id#" in line) < scan


def _months_read(df):
    return {m for f in df.inputFiles() for m in re.findall(r"order_ym=([^/]+)/", f)}


def test_only_wanted_months_are_read(spark, tmp_path):
    table = stage(build_master(shop(spark)))
    undated = table.limit(1).selectExpr(*("NULL AS order_ym" if c == "order_ym" else c for c in table.columns))
    table = stage(table.unionByName(undated))
    path = str(tmp_path / "master")
    layout.write_master(table, path)
    everything = layout.read_master(spark, path, table.schema)
    assert everything.columns == table.columns
    assert sorted(map(str, everything.collect())) == sorted(map(str, table.collect()))
    some = layout.read_master(spark, path, table.schema, "2017-03", "2017-05")
    assert "PartitionFilters: [isnotnull(order_ym" in plan(some)
    scan = some._jdf.queryExecution().optimizedPlan().toString()
    assert "order_ym" in scan and some.count() == table.where("order_ym BETWEEN '2017-03' AND '2017-05'").count()
    assert some.selectExpr("input_file_name() AS f").distinct().count() == 3  # a small file for each month
    # A period is a condition on the month alone, so it selects folders as well.
    split = splits.with_split(everything, "2017-04", "2017-08")
    for period, months in (("train", 4), ("val", 4)):
        part = split.where(f"split = '{period}'")
        assert "PartitionFilters: [" in plan(part) and "CASE WHEN" in re.search(r"PartitionFilters: \[.*", plan(part)).group()
        files = part.selectExpr("regexp_extract(input_file_name(), 'order_ym=([^/]+)', 1) AS m").distinct().count()
        assert files == months


def test_a_month_is_replaced_alone(spark, tmp_path):
    table = stage(build_master(shop(spark)))
    path = str(tmp_path / "master")
    layout.write_master(table, path)
    before = {f for f in layout.read_master(spark, path, table.schema).inputFiles()}
    layout.replace_months(table.where("order_ym = '2017-03'").limit(2), path)
    after = {f for f in layout.read_master(spark, path, table.schema).inputFiles()}
    assert {f for f in before if "2017-03" not in f} == {f for f in after if "2017-03" not in f} and before != after
    assert layout.read_master(spark, path, table.schema, "2017-03", "2017-03").count() == 2


@pytest.mark.parametrize("cutoff", ["before", "after"])
def test_retraining_from_a_stored_master(spark, tmp_path, cutoff):
    src, params = shop(spark), {"method": "hybrid", "alpha": 0.8, "min_support": 1}
    table = stage(build_master(src))
    layout.write_master(table, str(tmp_path / "master"))
    stored = layout.read_master(spark, str(tmp_path / "master"), table.schema)
    for folder, given in (("a", None), ("b", stored)):
        retrain.monthly_retrain(src, params, str(tmp_path / folder), "2017-09", cutoff, "1", 3, given)
    logs = [model_store.read_log(spark, str(tmp_path / f)).collect() for f in "ab"]
    assert logs[0] == logs[1] and logs[0][0]["n_users_train"] > 0
    assert "order_ym" in re.search(r"PartitionFilters: \[.*", plan(clean.eligible_rows(stored.where("order_ym <= '2017-09'")))).group()
