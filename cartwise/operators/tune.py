"""Cross-validation and parameter search, evaluated together.

Orders, customers and pairs are sums over customers. The counts of a training
set are therefore the totals minus those of the held-out fold, and one
grouping by fold replaces every refit. Support floors and factor numbers
become weight columns of one similarity table, alpha only mixes scores, so
all parameter sets and folds are ranked in one job.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.operators.cooccurrence import gram, jaccard, pair_counts
from cartwise.operators.evaluate import loo_metrics, loo_units
from cartwise.operators.factors import basket_factors, group_factors, is_wide, nmf_factors
from cartwise.operators.interactions import ranked_popularity
from cartwise.operators.latent import Latent
from cartwise.operators.model import backbone, full_params, variant_of, weight_name
from cartwise.operators.recommend import Weights
from cartwise.session import stage


def fold_of(user: Column | str, n_splits: int, seed: int = 42) -> Column:
    """Fold 0..n-1 from a hash of the customer, the same on every engine and run."""
    user = F.col(user) if isinstance(user, str) else user
    digest = F.substr(F.md5(F.concat(F.lit(str(seed)), user)), F.lit(1), F.lit(7))
    return F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(n_splits)).cast("int")


def assign_folds(baskets: DataFrame, n_splits: int, seed: int = 42) -> DataFrame:
    """Customers with two or more categories get a fold; the others (-1) always train."""
    return baskets.withColumn(
        "fold",
        F.when(F.col("n_categories") >= 2, fold_of("customer_unique_id", n_splits, seed)).otherwise(-1),
    )


def _minus_fold(counted: DataFrame, keys: Sequence[str], value: str, n_splits: int) -> DataFrame:
    """Per fold: the total of ``value`` minus the fold's own part, where something remains."""
    per_fold = F.map_from_entries(F.collect_list(F.struct("fold", value)))  # one entry per fold
    totals = counted.groupBy(*keys).agg(F.sum(value).alias("total"), per_fold.alias("parts"))
    folds = F.explode(F.array(*(F.lit(f) for f in range(n_splits)))).alias("fold")
    return (
        totals.select(*keys, "total", "parts", folds)
        .select(
            "fold",
            *keys,
            (F.col("total") - F.coalesce(F.col("parts")[F.col("fold")], F.lit(0))).alias(value),
        )
        .where(F.col(value) > 0)
    )


@dataclass(frozen=True)
class FoldModels:
    units: DataFrame
    popular: DataFrame
    similarity: Weights
    n_splits: int


def fold_models(
    baskets: DataFrame,
    popular: DataFrame,
    param_sets: Sequence[dict],
    n_splits: int,
    seed: int = 42,
) -> FoldModels:
    """Training tables of every fold for all parameter sets."""
    folded = assign_folds(baskets, n_splits, seed)
    cells = folded.select("fold", F.inline(F.arrays_zip("cats", "counts"))).groupBy(
        "fold", F.col("cats").alias("category_en")
    )
    held = stage(
        cells.agg(F.sum("counts").alias("orders"), F.count(F.lit(1)).alias("customers"))
    )
    # Popularity also counts orders of unknown customers, which no fold holds out.
    outside = (
        popular.select("category_en", "num_orders")
        .join(held.groupBy("category_en").agg(F.sum("orders").alias("known")), "category_en", "left")
        .select(
            F.lit(-2).alias("fold"),
            "category_en",
            (F.col("num_orders") - F.coalesce("known", F.lit(0))).alias("num_orders"),
        )
    )
    orders = held.select("fold", "category_en", F.col("orders").alias("num_orders"))
    train_popular = stage(
        ranked_popularity(
            _minus_fold(orders.unionByName(outside), ["category_en"], "num_orders", n_splits), ("fold",)
        )
    )
    train_customers = stage(_minus_fold(held, ["category_en"], "customers", n_splits))
    units = loo_units(folded.where("fold >= 0"), ["fold"])

    floors = sorted({p["min_support"] for p in param_sets if backbone(p) == "copurchase"})
    ranks = sorted({p["n_components"] for p in param_sets if backbone(p) == "svd"})
    nmf_ranks = sorted({p["n_components"] for p in param_sets if backbone(p) == "nmf"})
    links = None
    if floors:
        pairs = _minus_fold(pair_counts(folded, ["fold"]), ["cat_a", "cat_b"], "support", n_splits)
        links = stage(jaccard(pairs, train_customers, floors, ["fold"]))
    latents = []
    if ranks:
        latents.append(Latent(stage(fold_factors(folded, max(ranks), n_splits)), {f"svd{r}": r for r in ranks}))
    for rank in nmf_ranks:
        per_fold = None
        for fold in range(n_splits):
            factors, _ = nmf_factors(folded.where(F.col("fold") != fold), rank)
            one = factors.withColumn("fold", F.lit(fold))
            per_fold = one if per_fold is None else per_fold.unionByName(one)
        latents.append(Latent(per_fold, {f"nmf{rank}": rank}))
    return FoldModels(units, train_popular, Weights(links, tuple(latents)), n_splits)


def fold_factors(folded: DataFrame, n_components: int, n_splits: int) -> DataFrame:
    """Category factors of every fold's training customers: fold, category_en, factors, sigma.

    One decomposition serves all smaller factor numbers. Beyond the categories
    of a Gram matrix in one task, the training baskets of all folds are
    decomposed at once, with the fold as a key of their cells.
    """
    if is_wide(folded):
        others = F.filter(F.array(*(F.lit(f) for f in range(n_splits))), lambda f: f != F.col("fold"))
        train = folded.select("cats", "counts", F.explode(others).alias("fold"))
        return basket_factors(train, n_components, ["fold"])
    products = _minus_fold(gram(folded, ["fold"]), ["cat_a", "cat_b"], "dot", n_splits)
    return group_factors(stage(products), n_components, ["fold"])


def cross_validate(
    baskets: DataFrame,
    popular: DataFrame,
    param_sets: Sequence[dict],
    k: int = 10,
    n_splits: int = 4,
    seed: int = 42,
) -> DataFrame:
    """Leave-one-out measures per parameter set (``variant`` = position) and fold 1..n."""
    param_sets = [full_params(p) for p in param_sets]
    models = fold_models(baskets, popular, param_sets, n_splits, seed)
    variants = [variant_of(p, str(i), weight_name(p)) for i, p in enumerate(param_sets)]
    return loo_metrics(
        models.units, models.similarity, models.popular, variants, k, ["fold"]
    ).withColumn("fold", F.col("fold") + 1)


def best_first() -> tuple[Column, Column]:
    """Published recalls have four decimals; equal ones keep the order of the trials."""
    return F.round("recall_mean", 4).desc(), F.asc("trial")


PARAM_SCHEMA = (
    "variant string, method string, cf_method string, alpha double, min_support int, n_components int"
)


def params_frame(spark, param_sets: Sequence[dict]) -> DataFrame:
    """The parameter sets as a frame (one row per trial, so a handful)."""
    rows = [
        (
            str(i),
            p.get("method"),
            p.get("cf_method"),
            None if p.get("alpha") is None else float(p["alpha"]),
            p.get("min_support"),
            p.get("n_components"),
        )
        for i, p in enumerate(param_sets)
    ]
    return spark.createDataFrame(rows, PARAM_SCHEMA)


def search_table(
    baskets: DataFrame,
    popular: DataFrame,
    param_sets: Sequence[dict],
    k: int = 10,
    n_splits: int = 3,
    seed: int = 42,
) -> DataFrame:
    """Mean measures over the folds per parameter set, best recall first."""
    folds = cross_validate(baskets, popular, param_sets, k, n_splits, seed)
    means = folds.groupBy("variant").agg(
        F.avg("precision").alias("precision_mean"),
        F.avg("recall").alias("recall_mean"),
        F.stddev_samp("recall").alias("recall_std"),
        F.avg("f1").alias("f1_mean"),
        F.avg("coverage").alias("coverage_mean"),
    )
    return (
        params_frame(baskets.sparkSession, param_sets)
        .join(means, "variant")
        .withColumn("trial", F.col("variant").cast("int"))
        .drop("variant")
        .orderBy(*best_first())
    )


# The search spaces of the full run.
GRID = {
    "method": ["hybrid"],
    "cf_method": ["copurchase"],
    "alpha": [0.3, 0.5, 0.7, 0.9, 1.0],
    "min_support": [3, 5, 10],
}
RANDOM_SPACE = {
    "method": ["hybrid"],
    "cf_method": ["copurchase", "svd"],
    "alpha": [0.2, 0.3, 0.4, 0.5, 0.7],
    "n_components": [10, 20, 30],
    "min_support": [5, 10, 20],
}


def grid_params(grid: dict[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def effective(params: dict) -> dict:
    """Drop parameters without effect, so that equal models compare equal."""
    kept = dict(params)
    if kept.get("cf_method") == "copurchase":
        kept.pop("n_components", None)
    elif kept.get("cf_method") == "svd":
        kept.pop("min_support", None)
    return kept


def random_params(space: dict[str, Sequence], n: int, seed: int = 42) -> list[dict]:
    """``n`` distinct parameter sets in the order of a seeded hash."""
    distinct = {json.dumps(effective(p), sort_keys=True) for p in grid_params(space)}
    order = sorted(distinct, key=lambda text: hashlib.md5(f"{seed}|{text}".encode()).hexdigest())
    return [json.loads(text) for text in order[:n]]


def conditional_params(n_trials: int = 20, seed: int = 42) -> list[dict]:
    """Seeded draws from the continuous space; factors only with the SVD backbone."""
    rng = random.Random(seed)
    trials = []
    for _ in range(n_trials):
        trial = {
            "method": "hybrid",
            "cf_method": rng.choice(["copurchase", "svd"]),
            "alpha": round(rng.uniform(0.0, 1.0), 4),
            "min_support": rng.randint(3, 30),
        }
        if trial["cf_method"] == "svd":
            trial["n_components"] = rng.randint(5, 40)
        trials.append(trial)
    return trials


def best_params(table: DataFrame) -> dict:
    row = table.orderBy(*best_first()).first()
    found = {c: row[c] for c in ("method", "cf_method", "alpha", "min_support", "n_components")}
    return {c: v for c, v in found.items() if v is not None}


def tuning_winner(tables: dict[str, DataFrame]) -> DataFrame:
    """The best row of each search, best recall first; ties go to the search listed first."""
    union = None
    for place, (name, table) in enumerate(tables.items()):
        best = (
            table.orderBy(*best_first())
            .limit(1)
            .select(F.lit(name).alias("search"), F.lit(place).alias("place"), *table.columns)
        )
        union = best if union is None else union.unionByName(best)
    return union.orderBy(F.round("recall_mean", 4).desc(), "place")


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean, sample deviation, minimum and maximum of each measure over the folds."""
    measures = ["precision", "recall", "f1", "coverage"]
    return (
        folds.select(*measures)
        .unpivot([], measures, "metric", "value")
        .groupBy("metric")
        .agg(
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )


def grid_pivot(table: DataFrame, alphas: Sequence[float]) -> DataFrame:
    """Mean recall by support floor (rows) and alpha (columns)."""
    pivoted = (
        table.groupBy("min_support").pivot("alpha", [float(a) for a in alphas]).agg(F.avg("recall_mean"))
    )
    return pivoted.withColumnsRenamed(
        {str(float(a)): f"alpha_{str(float(a)).replace('.', '_')}" for a in alphas}
    )


def running_best(table: DataFrame) -> DataFrame:
    """Best recall up to each trial (a handful of rows)."""
    from pyspark.sql import Window

    so_far = Window.orderBy("trial").rowsBetween(Window.unboundedPreceding, 0)
    return table.select("trial", "recall_mean", F.max("recall_mean").over(so_far).alias("best_so_far"))


# The compared model families.
FAMILIES = {
    "Popularidad (baseline)": {"method": "popularity"},
    "Co-compra item-item": {"method": "copurchase", "min_support": 10},
    "SVD": {"method": "svd", "n_components": 20},
    "NMF": {"method": "nmf", "n_components": 20},
    "Híbrido (Cop+Pop)": {
        "method": "hybrid",
        "cf_method": "copurchase",
        "alpha": 0.5,
        "min_support": 10,
    },
}


def compare_families(
    baskets: DataFrame,
    popular: DataFrame,
    families: dict[str, dict] | None = None,
    k: int = 10,
) -> DataFrame:
    """Leave-one-out measures of all families in one ranking job (in-sample)."""
    from cartwise.operators.cooccurrence import category_customers

    families = {n: full_params(p) for n, p in (families or FAMILIES).items()}
    floors = sorted({p["min_support"] for p in families.values() if backbone(p) == "copurchase"})
    ranks = sorted({p["n_components"] for p in families.values() if backbone(p) == "svd"})
    nmf_ranks = sorted({p["n_components"] for p in families.values() if backbone(p) == "nmf"})
    links = stage(jaccard(pair_counts(baskets), category_customers(baskets), floors)) if floors else None
    latents = []
    if ranks:
        latents.append(Latent(stage(basket_factors(baskets, max(ranks))), {f"svd{r}": r for r in ranks}))
    for rank in nmf_ranks:
        factors, _ = nmf_factors(baskets, rank)
        latents.append(Latent(factors, {f"nmf{rank}": rank}))
    variants = [variant_of(p, name, weight_name(p)) for name, p in families.items()]
    return loo_metrics(loo_units(baskets), Weights(links, tuple(latents)), popular, variants, k).orderBy(
        F.desc("recall"), "variant"
    )
