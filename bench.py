"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select
tables and cores. Every query is run to its last row (noop sink); tables that
a query needs from an earlier step are staged by that step and timed there.
"""

from __future__ import annotations

import json
import os
import time

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
os.environ.setdefault("CARTWISE_PARTITIONS", CPUS)

from cartwise.plans.catalog import QUERIES, tables_of  # noqa: E402
from cartwise.session import local_session  # noqa: E402

# Shared tables in build order, then queries over them.
TABLES = ["raw", "clean", "sides", "months", "baskets", "popular", "units", "jaccard", "products", "factors", "svd", "rfm"]
HEADLINE = [
    "data_quality", "business_metrics", "cleaning_report", "category_features", "user_item", "history_rows",
    "copurchase_pairs", "recommend_popularity", "recommend_hybrid", "recommend_svd", "popularity_curve",
    "loo_copurchase", "loo_hybrid", "compare_popularity_and_svd", "period_recall_svd", "temporal_backtest",
    "cross_validation", "grid_search", "random_search", "nmf_category_factors", "report_demand_by_month",
    "report_rfm_histograms", "svd_user_factors", "conditional_search", "tuning_winner", "model_families",
    "expanding_refits", "monthly_retrain_log", "recommend_reloaded_model",
]


def main() -> None:
    spark = local_session(CPUS, "cartwise-bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{SF_DIR}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # JVM start
    tables = tables_of(spark, SF_DIR)
    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    for name in TABLES:
        timed(f"build_{name}", lambda: getattr(tables, name))
    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "total seconds of the feature, recommendation, evaluation and search queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
