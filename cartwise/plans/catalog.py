"""Every registered query as a function of (session, table folder).

All queries of one session share the staged master, cleaned and basket tables
of a folder: they are built once from the given tables, as a pipeline would,
and read back column-pruned.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.operators import (
    clean,
    cooccurrence,
    evaluate,
    evolution,
    factors,
    features,
    interactions,
    latent,
    master,
    model,
    quality,
    recommend,
    splits,
    tune,
)
from cartwise.plans import reports, retrain
from cartwise.session import ensure_checkpoint_dir, stage, stage_in_slices
from cartwise.sources import layout, model_store, tables, testdata

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TRAIN_END, VALIDATION_END = testdata.TRAIN_END, testdata.VALIDATION_END


def stable(column: Column | str, digits: int) -> Column:
    """Rounding whose tie point lies off the decimal grid (summation order cannot flip it)."""
    column = F.col(column) if isinstance(column, str) else column
    return F.floor(column * F.lit(10.0**digits) + F.lit(0.5001)) / F.lit(10.0**digits)


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: stable(c, d) for c, d in digits.items()})


COMPARED = {"precision_baseline": 8, "recall_baseline": 8, "precision_model": 8, "recall_model": 8}
MEASURES = {"precision": 8, "recall": 8, "hit_rate": 8, "coverage": 8, "f1": 8}


class Tables:
    """Staged intermediate tables of one session and folder, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def present(self) -> bool:
        """Whether the staged tables built so far still exist (the shared folder may be cleaned)."""
        built = [v for v in vars(self).values() if isinstance(v, DataFrame) and v.inputFiles()]
        try:
            for table in built:
                folder = table.inputFiles()[0].rsplit("/", 1)[0]
                self.spark.read.schema(table.schema).parquet(folder)
        except AnalysisException:
            return False
        return True

    def folder(self, name: str) -> str:
        """A new folder in the shared checkpoint folder."""
        return f"{ensure_checkpoint_dir(self.spark)}/{name}-{uuid.uuid4().hex}"

    @functools.cached_property
    def sources(self) -> tables.Sources:
        return testdata.load(self.spark, self.sf_dir)

    @functools.cached_property
    def rows(self) -> int:
        """Rows of the master table, read from its files; tables made from it have no more."""
        return self.raw.count()

    def by_customer(self, table: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return stage_in_slices(table, ["customer_unique_id"], build, self.rows)

    @functools.cached_property
    def raw(self) -> DataFrame:
        return master.staged_master(self.sources)

    @functools.cached_property
    def clean(self) -> DataFrame:
        return clean.clean_master(self.raw)  # a filter and few values: no second copy of the table

    @functools.cached_property
    def flagged(self) -> DataFrame:
        return clean.flagged_master(self.raw)

    @functools.cached_property
    def sides(self) -> DataFrame:
        return quality.grouped_sides(self.flagged)

    @functools.cached_property
    def baskets(self) -> DataFrame:
        return self.by_customer(self.clean, interactions.customer_baskets)

    @functools.cached_property
    def matrix(self) -> DataFrame:
        return self.by_customer(self.clean, interactions.interactions)

    @functools.cached_property
    def popular(self) -> DataFrame:
        return stage(interactions.popularity(self.clean, self.rows))

    @functools.cached_property
    def units(self) -> DataFrame:
        return evaluate.loo_units(self.baskets)

    @functools.cached_property
    def jaccard(self) -> DataFrame:
        return stage(cooccurrence.copurchase_similarity(self.baskets, 10))

    @functools.cached_property
    def products(self) -> DataFrame:
        return stage(cooccurrence.gram(self.baskets))

    @functools.cached_property
    def factors(self) -> DataFrame:
        return stage(factors.category_factors(self.products, 15))

    @functools.cached_property
    def svd(self) -> latent.Latent:
        return latent.Latent(self.factors, {"sim": 15})

    @functools.cached_property
    def nmf(self) -> tuple[DataFrame, list[float]]:
        found, errors = factors.nmf_factors(self.baskets, 15)
        return stage(found), errors

    @functools.cached_property
    def rfm(self) -> DataFrame:
        return stage(features.build_rfm(self.clean, self.rows))

    @functools.cached_property
    def category_features(self) -> DataFrame:
        return stage(features.build_category_features(self.clean, self.rows))

    @functools.cached_property
    def months(self) -> DataFrame:
        """The cleaned table in month folders: periods and cut-offs read theirs only."""
        path, table = self.folder("months"), clean.clean_master(self.raw)  # written once, in months
        stored = master.without_derived(table)
        layout.write_master(stored, path, self.rows)
        return master.derived_again(layout.read_master(self.spark, path, stored.schema), table.columns)

    @functools.cached_property
    def split(self) -> DataFrame:
        return splits.with_split(self.months, TRAIN_END, VALIDATION_END)

    @functools.cached_property
    def train_baskets(self) -> DataFrame:
        return self.by_customer(self.split.where("split = 'train'"), interactions.customer_baskets)

    @functools.cached_property
    def retrained(self) -> str:
        """Folder of a model retrained with a cut-off after cleaning."""
        folder = self.folder("models")
        params = {"method": "hybrid", "alpha": 0.7, "min_support": 10}
        retrain.monthly_retrain(self.sources, params, folder, VALIDATION_END, version="20000630_0001")
        return folder

    @functools.cached_property
    def grid(self) -> DataFrame:
        return stage(tune.search_table(self.baskets, self.popular, tune.grid_params(tune.GRID)))


_BUILT: dict[tuple[str, str, str], Tables] = {}


def tables_of(spark: SparkSession, sf_dir: str) -> Tables:
    key = (spark.sparkContext.applicationId, ensure_checkpoint_dir(spark), sf_dir.rstrip("/"))
    if key not in _BUILT or not _BUILT[key].present():
        _BUILT[key] = Tables(spark, key[-1])
    return _BUILT[key]


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(tables_of(spark, sf_dir))
    return build


# --- sources and master table -------------------------------------------------


@query
def master_table(t: Tables) -> DataFrame:
    return _shown(master.build_master(t.sources))


@query
def master_from_buckets(t: Tables) -> DataFrame:
    """The same from orders and items that are stored in buckets by order."""
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return _shown(master.build_master(layout.bucket_sources(t.sources, t.folder("buckets"), buckets)))


def _shown(table: DataFrame) -> DataFrame:
    built = table.select(
        "order_id", "customer_unique_id", "order_status", "order_item_id", "product_id", "category_en",
        "seller_state", "customer_state", "payment_type", "num_installments", "review_score",
        "review_count", "delivery_days", "estimated_days", "delivery_delay", "is_late", "order_year",
        "order_month", "order_ym", "item_total", "freight_ratio", "total_payment",
    )
    return rounded(built, item_total=4, freight_ratio=6, total_payment=4, review_score=6)


@query
def payments_per_order(t: Tables) -> DataFrame:
    return rounded(master.payments_per_order(t.sources.payments), total_payment=4)


@query
def reviews_per_order(t: Tables) -> DataFrame:
    return rounded(master.reviews_per_order(t.sources.reviews), review_score=6)


@query
def labelled_products(t: Tables) -> DataFrame:
    return master.labelled_products(t.sources.products, t.sources.category_map)


@query
def csv_round_trip(t: Tables) -> DataFrame:
    """Writes all tables as CSV, reads them back and counts orders per category."""
    path = t.folder("csv")
    tables.write_sources(t.sources, path, "csv")
    again = tables.read_sources(t.spark, path, "csv")
    return interactions.popularity(master.build_master(again)).select("category_en", "num_orders", "rank")


# --- profile, figures, cleaning -----------------------------------------------


@query
def data_quality(t: Tables) -> DataFrame:
    return quality.data_quality(t.raw)


@query
def data_quality_by_sketch(t: Tables) -> DataFrame:
    """The profile merged from monthly sketches, and whether its distinct counts are within 5 % of the true ones."""
    path = t.folder("profile")
    quality.profile_by_month(t.raw).write.parquet(path)
    merged = quality.merged_profile(t.spark.read.parquet(path))
    exact = quality.data_quality(t.raw).select("column", F.col("unique").alias("exact"))
    near = F.abs(F.col("unique") - F.col("exact")) <= 0.05 * F.col("exact")
    return merged.join(exact, "column").select("column", "rows", "null_count", near.alias("near"))


@query
def columns_with_nulls(t: Tables) -> DataFrame:
    return quality.columns_with_nulls(t.raw)


@query
def business_metrics(t: Tables) -> DataFrame:
    return _figures(quality.business_metrics(t.raw))


def _figures(df: DataFrame) -> DataFrame:
    return rounded(
        df,
        avg_review_score=6,
        avg_items_per_order=6,
        avg_order_value_brl=4,
        avg_delivery_days=6,
        late_delivery_rate_pct=6,
        repeat_customer_rate=6,
        avg_categories_per_customer=6,
    )


@query
def metrics_raw_and_clean(t: Tables) -> DataFrame:
    return _figures(quality.metrics_raw_and_clean(t.sides))


@query
def clean_table(t: Tables) -> DataFrame:
    kept = clean.clean_master(t.raw).select(
        "order_id", "order_item_id", "product_id", "category_en", "order_status", "delivery_days",
        "review_score", "price", "delivery_delay", "is_late",
    )
    return rounded(kept, price=4, review_score=6)


@query
def cleaning_log(t: Tables) -> DataFrame:
    return clean.cleaning_log(t.raw)


@query
def cleaning_report(t: Tables) -> DataFrame:
    return rounded(quality.cleaning_report(t.sides, t.flagged), before=4, after=4)


@query
def null_share_before_after(t: Tables) -> DataFrame:
    return rounded(quality.null_share_before_after(t.flagged), before=6, after=6)


# --- features and interactions -------------------------------------------------


@query
def rfm_features(t: Tables) -> DataFrame:
    return rounded(
        t.rfm, monetary=4, avg_ticket=6, avg_review=6, avg_delivery_days=6, late_rate=8, RFM_score=1
    )


@query
def category_features(t: Tables) -> DataFrame:
    return rounded(
        features.build_category_features(t.clean, t.rows),
        avg_price=6, avg_review=6, avg_delivery=6, late_rate=8, total_revenue=4, avg_freight_ratio=8,
        repeat_rate=8,
    )


@query
def user_item(t: Tables) -> DataFrame:
    return rounded(
        interactions.user_item(t.clean), total_spent=4, avg_review=6, avg_delivery_days=6
    )


@query
def interaction_matrix(t: Tables) -> DataFrame:
    return interactions.interactions(t.clean)


@query
def matrix_stats(t: Tables) -> DataFrame:
    return interactions.matrix_stats(t.matrix)


@query
def customer_history(t: Tables) -> DataFrame:
    return interactions.customer_history(t.clean).withColumn(
        "category_history", F.concat_ws("|", "category_history")
    )


@query
def history_rows(t: Tables) -> DataFrame:
    return interactions.history_rows(t.clean)


@query
def popularity(t: Tables) -> DataFrame:
    return rounded(interactions.popularity(t.raw), pct_of_total=8, pop_score=8)


@query
def leave_one_out_split(t: Tables) -> DataFrame:
    return t.units.select("test", F.concat_ws("|", "cats").alias("train"), "customers")


# --- similarity ------------------------------------------------------------------


@query
def copurchase_pairs(t: Tables) -> DataFrame:
    return cooccurrence.copurchase(t.baskets, 20)


@query
def jaccard_similarity(t: Tables) -> DataFrame:
    return rounded(cooccurrence.copurchase_similarity(t.baskets, 10), sim=10)


@query
def copurchase_influence(t: Tables) -> DataFrame:
    return rounded(cooccurrence.centrality(t.jaccard, 15), influence=8)


@query
def top_category_similarity(t: Tables) -> DataFrame:
    return rounded(cooccurrence.top_similarity(t.jaccard, t.category_features, 20), sim=10)


@query
def gram_matrix(t: Tables) -> DataFrame:
    return cooccurrence.gram(t.baskets)


@query
def svd_category_factors(t: Tables) -> DataFrame:
    found = factors.category_factors(t.products, 15).select(
        "category_en", F.posexplode("factors").alias("factor", "loading")
    )
    return rounded(found, loading=6)


@query
def svd_similarity(t: Tables) -> DataFrame:
    return rounded(factors.cosine_similarity(t.factors), sim=6)


@query
def svd_user_factors(t: Tables) -> DataFrame:
    found = factors.user_factors(t.matrix, t.factors)
    return rounded(found.select("user", F.posexplode("factors").alias("factor", "value")), value=6)


@query
def svd_explained_variance(t: Tables) -> DataFrame:
    found = factors.explained_variance(t.matrix, t.products, t.factors, t.baskets.count())
    return rounded(found, explained_variance=8, cumulative_variance=8)


@query
def svd_influence(t: Tables) -> DataFrame:
    return rounded(factors.loading_influence(t.factors, 15), influence=6)


@query
def svd_factor_map(t: Tables) -> DataFrame:
    return factors.factor_map(t.factors, t.category_features)


@query
def nmf_category_factors(t: Tables) -> DataFrame:
    return t.nmf[0].select("category_en", F.posexplode("factors").alias("factor", "loading"))


@query
def nmf_quality(t: Tables) -> DataFrame:
    """The error of the non-negative factors between those of as many singular vectors and of one."""
    found, errors = t.nmf
    sigma = t.factors.first()["sigma"]
    norm = t.matrix.agg(F.sum(F.col("interactions") * F.col("interactions"))).first()[0]
    floor, one = norm - sum(s * s for s in sigma), norm - sigma[0] ** 2
    falls = all(b <= a * (1 + 1e-9) for a, b in zip(errors, errors[1:]))
    row = found.agg(
        F.count(F.lit(1)).alias("n_categories"),
        F.max(F.size("factors")).alias("n_factors"),
        F.min(F.array_min("factors") >= 0).alias("non_negative"),
    )
    return rounded(
        row.select(
            "*", F.lit(norm).cast("bigint").alias("squared_norm"), F.lit(floor).alias("svd_error"),
            F.lit(falls).alias("error_falls"), F.lit(floor <= errors[-1] < one).alias("between_svd_and_rank_one"),
        ),
        svd_error=4,
    )


# --- recommendation ----------------------------------------------------------------


def _recommended(t: Tables, similarity: DataFrame | None, variant: recommend.Variant) -> DataFrame:
    listed = recommend.recommend_all(t.baskets, similarity, t.popular, variant, 10)
    return rounded(listed, affinity=8, score=8, explain=8)


@query
def recommend_popularity(t: Tables) -> DataFrame:
    return _recommended(t, None, recommend.Variant("popularity"))


@query
def recommend_copurchase(t: Tables) -> DataFrame:
    return _recommended(t, t.jaccard, recommend.Variant("copurchase", "sim"))


@query
def recommend_hybrid(t: Tables) -> DataFrame:
    return _recommended(t, t.jaccard, recommend.Variant("hybrid", "sim", 0.5))


@query
def recommend_svd(t: Tables) -> DataFrame:
    return _recommended(t, t.svd, recommend.Variant("svd", "sim", keep_all=True))


@query
def recommend_final_model(t: Tables) -> DataFrame:
    """The shipped parameters (hybrid, alpha 1) with each customer's history."""
    listed = _recommended(t, t.jaccard, recommend.Variant("hybrid", "sim", 1.0))
    history = t.baskets.where("n_categories >= 2").select(
        "customer_unique_id", F.concat_ws("|", "cats").alias("history")
    )
    return history.join(listed.where("rank <= 10"), "customer_unique_id")


# --- evaluation ---------------------------------------------------------------------


@query
def popularity_curve(t: Tables) -> DataFrame:
    return rounded(
        evaluate.popularity_at_k(t.units, t.popular, range(1, 21)), precision=8, recall=8
    )


@query
def loo_popularity(t: Tables) -> DataFrame:
    found = evaluate.loo_metrics(t.units, None, t.popular, [recommend.Variant("popularity")])
    return rounded(found, **MEASURES)


@query
def loo_copurchase(t: Tables) -> DataFrame:
    found = evaluate.loo_metrics(t.units, t.jaccard, t.popular, [recommend.Variant("copurchase", "sim")])
    return rounded(found, **MEASURES)


@query
def loo_hybrid(t: Tables) -> DataFrame:
    found = evaluate.loo_metrics(
        t.units, t.jaccard, t.popular, [recommend.Variant("hybrid", "sim", 0.5)]
    )
    return rounded(found, **MEASURES)


@query
def compare_popularity_and_svd(t: Tables) -> DataFrame:
    return rounded(evaluate.compare_models(t.units, t.svd, t.popular), **COMPARED)


@query
def compare_popularity_and_copurchase(t: Tables) -> DataFrame:
    return rounded(evaluate.compare_models(t.units, t.jaccard, t.popular), **COMPARED)


@query
def split_summary(t: Tables) -> DataFrame:
    return splits.split_summary(t.split, TRAIN_END, VALIDATION_END)


@query
def split_orders_per_month(t: Tables) -> DataFrame:
    return splits.orders_per_month(t.split)


@query
def period_recall_svd(t: Tables) -> DataFrame:
    return rounded(evaluate.evaluate_periods(t.split, t.train_baskets, t.svd, t.popular), recall=8)


@query
def period_recall_copurchase(t: Tables) -> DataFrame:
    return rounded(
        evaluate.evaluate_periods(t.split, t.train_baskets, t.jaccard, t.popular), recall=8
    )


def _backtest(t: Tables) -> DataFrame:
    past = t.split.where("split <> 'backtest'")
    baskets = t.by_customer(past, interactions.customer_baskets)
    fitted = model.fit(past, {"method": "hybrid", "alpha": 0.7, "min_support": 10}, baskets)
    return evaluate.backtest(
        baskets, t.split.where("split = 'backtest'"), fitted.scoring, fitted.popular, fitted.variant
    )


@query
def temporal_backtest(t: Tables) -> DataFrame:
    return rounded(_backtest(t), precision=8, recall=8)


# --- search ---------------------------------------------------------------------------


@query
def cross_validation(t: Tables) -> DataFrame:
    params = [{"method": "hybrid", "alpha": 0.9, "min_support": 10}]
    return rounded(tune.cross_validate(t.baskets, t.popular, params, n_splits=3), **MEASURES)


@query
def cross_validation_summary(t: Tables) -> DataFrame:
    params = [{"method": "hybrid", "alpha": 0.9, "min_support": 10}]
    found = tune.cv_summary(tune.cross_validate(t.baskets, t.popular, params, n_splits=3))
    return rounded(found, mean=8, std=8, min=8, max=8)


@query
def grid_search(t: Tables) -> DataFrame:
    return rounded(
        t.grid.select("trial", "method", "cf_method", "alpha", "min_support", "precision_mean",
                      "recall_mean", "recall_std", "f1_mean", "coverage_mean"),
        precision_mean=8, recall_mean=8, recall_std=8, f1_mean=8, coverage_mean=8,
    )


@query
def grid_pivot(t: Tables) -> DataFrame:
    pivoted = tune.grid_pivot(t.grid, tune.GRID["alpha"])
    return rounded(pivoted, **{c: 8 for c in pivoted.columns if c.startswith("alpha_")})


@query
def grid_running_best(t: Tables) -> DataFrame:
    return rounded(tune.running_best(t.grid), recall_mean=8, best_so_far=8)


@query
def random_search(t: Tables) -> DataFrame:
    return tune.search_table(t.baskets, t.popular, tune.random_params(tune.RANDOM_SPACE, 8))


@query
def conditional_search(t: Tables) -> DataFrame:
    return tune.search_table(t.baskets, t.popular, tune.conditional_params(20))


@query
def tuning_winner(t: Tables) -> DataFrame:
    drawn = tune.search_table(t.baskets, t.popular, tune.random_params(tune.RANDOM_SPACE, 8))
    conditional = tune.search_table(t.baskets, t.popular, tune.conditional_params(20))
    return tune.tuning_winner(
        {"GridSearchCV": t.grid, "RandomSearch": stage(drawn), "ConditionalSearch": stage(conditional)}
    )


@query
def model_families(t: Tables) -> DataFrame:
    return tune.compare_families(t.baskets, t.popular)


@query
def scenario_measures(t: Tables) -> DataFrame:
    """Leave-one-out, cross-validated and backtest measures side by side."""
    params = [{"method": "hybrid", "alpha": 0.7, "min_support": 10}]
    folds = tune.cross_validate(t.baskets, t.popular, params, n_splits=3)
    variant = recommend.Variant("hybrid", "sim", 0.7)
    table = reports.scenario_table(
        {
            "leave_one_out": evaluate.loo_metrics(t.units, t.jaccard, t.popular, [variant]),
            "cross_validation": folds.agg(
                F.avg("precision").alias("precision"), F.avg("recall").alias("recall")
            ),
            "backtest": _backtest(t),
        }
    )
    return rounded(table, value=8)


# --- monthly runs ------------------------------------------------------------------------


@query
def expanding_refits(t: Tables) -> DataFrame:
    return evolution.expanding_refits(t.raw, 15)


@query
def expanding_popularity(t: Tables) -> DataFrame:
    """Popularity part of the expanding evaluation."""
    return rounded(
        evolution.expanding_popularity(t.raw), recall_baseline=8, precision_baseline=8
    )


@query
def monthly_retrain_log(t: Tables) -> DataFrame:
    """One retraining run with a cut-off, exported, logged and read back."""
    folder = t.folder("models")
    params = {"method": "hybrid", "alpha": 1.0, "min_support": 10}
    retrain.monthly_retrain(
        t.sources, params, folder, VALIDATION_END, cutoff="before", version="20000630_0000"
    )
    log = model_store.read_log(t.spark, folder)
    return rounded(log, **MEASURES)


@query
def retrain_log(t: Tables) -> DataFrame:
    """The log of a run in the usual order: all months are cleaned, then cut off."""
    return rounded(model_store.read_log(t.spark, t.retrained), **MEASURES)


@query
def model_metadata(t: Tables) -> DataFrame:
    """What the record of the retrained version says."""
    found = model_store.load_metadata(t.spark, t.retrained)
    loo = found["measures"]["leave_one_out"]
    row = (
        found["model_version"], found["target"], found["algorithm"], found["parameters"]["alpha"],
        found["parameters"]["min_support"], found["n_categories"], found["n_users_train"], loo["n_users"],
        loo["precision"], loo["recall"], ",".join(found["tables"]),
    )
    schema = (
        "model_version string, target string, algorithm string, alpha double, min_support int, n_categories bigint, "
        "n_users_train bigint, n_users_eval bigint, precision double, recall double, tables string"
    )
    return rounded(t.spark.createDataFrame([row], schema), precision=8, recall=8)


@query
def recommend_reloaded_model(t: Tables) -> DataFrame:
    """The retrained version is read back and recommends to the customers it was trained on."""
    fitted = model_store.load_model(t.spark, t.retrained)
    past = t.months.where(F.col("order_ym") <= VALIDATION_END)
    baskets = t.by_customer(past, interactions.customer_baskets)
    listed = recommend.recommend_all(baskets, fitted.scoring, fitted.popular, fitted.variant, 10)
    return rounded(listed, affinity=8, score=8, explain=8)


# --- reports --------------------------------------------------------------------------------


def _report(name: str, build: Callable[[Tables], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(tables_of(spark, sf_dir))


_report("report_orders_by_month", lambda t: reports.orders_by_month(t.raw))
_report("report_orders_by_review_score", lambda t: rounded(reports.orders_by_review_score(t.raw), review_score=6))
_report("report_delivery_histogram", lambda t: rounded(reports.delivery_histogram(t.raw), low=4, high=4))
_report("report_delivery_median", lambda t: reports.delivery_median(t.raw))
_report("report_orders_by_category", lambda t: rounded(reports.orders_by_category(t.raw, 20), pct=8))
_report("report_ticket_by_category", lambda t: reports.ticket_by_category(t.raw, 20))
_report("report_demand_by_month", lambda t: reports.demand_by_month(t.raw, 15))
_report("report_top_pairs", lambda t: reports.top_pairs(cooccurrence.copurchase(t.baskets, 30), 25))
_report("report_customers_by_orders", lambda t: reports.customers_by_orders(t.raw))
_report("report_customers_by_categories", lambda t: reports.customers_by_categories(t.raw))
_report("report_customers_by_state", lambda t: reports.customers_by_state(t.raw))
_report("report_spend_by_state", lambda t: reports.spend_by_state(t.raw))
_report("report_diversity_segments", lambda t: reports.diversity_segments(t.baskets))
_report("report_revenue_by_month", lambda t: rounded(reports.revenue_by_month(t.raw), revenue=4))
_report("report_rfm_histograms", lambda t: rounded(reports.rfm_histograms(t.rfm), low=4, high=4))
_report("report_rfm_medians", lambda t: rounded(reports.rfm_medians(t.rfm), median_monetary=4))
_report("report_rfm_segments", lambda t: reports.rfm_segments(t.rfm))
_report("report_top_category_features", lambda t: rounded(
    reports.top_category_features(t.category_features), avg_price=6, avg_review=6, avg_delivery=6,
    late_rate=8, total_revenue=4, avg_freight_ratio=8, repeat_rate=8))
