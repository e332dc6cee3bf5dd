"""Registered queries against their SQL on the smallest driver tables (all: check_queries.py)."""

import glob
import os

import pytest

import __spark_entry__ as entry
from check_queries import compare

FOLDER = "/root/testdata/sf0.001"
QUERIES = [
    "master_table", "data_quality", "business_metrics", "clean_table", "cleaning_report", "rfm_features",
    "category_features", "user_item", "customer_history", "history_rows", "popularity", "copurchase_pairs",
    "jaccard_similarity", "gram_matrix", "recommend_hybrid", "popularity_curve", "loo_hybrid", "split_summary",
    "period_recall_copurchase", "temporal_backtest", "cross_validation", "expanding_popularity",
    "report_demand_by_month", "report_rfm_histograms", "report_rfm_segments", "svd_category_factors",
    "svd_user_factors", "svd_explained_variance", "recommend_svd", "compare_popularity_and_svd", "period_recall_svd",
    "nmf_quality", "metrics_raw_and_clean", "data_quality_by_sketch", "master_from_buckets", "retrain_log",
    "model_metadata", "recommend_reloaded_model",
]


@pytest.fixture(scope="module")
def connection():
    duckdb = pytest.importorskip("duckdb")
    found = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path)[:-8]
        found.execute(f"CREATE VIEW \"{name}\" AS SELECT * FROM read_parquet('{path}')")
    return found


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, connection, name):
    assert compare(entry.queries()[name](spark, FOLDER), connection, entry.oracle_sql()[name]) == ""


def test_every_statement_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
