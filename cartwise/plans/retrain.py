"""Batch runs: feature pipeline, model selection and monthly retraining."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.operators import evaluate, evolution, factors, features, quality, splits, tune
from cartwise.operators.clean import clean_master, flagged_master
from cartwise.operators.interactions import customer_baskets, interactions, matrix_stats, popularity
from cartwise.operators.latent import Latent
from cartwise.operators.master import build_master, staged_master  # noqa: F401
from cartwise.operators.model import Model, fit
from cartwise.session import stage, stage_in_slices
from cartwise.sources.model_store import publish_model
from cartwise.sources.tables import Sources


def loo_of(model: Model, baskets: DataFrame, k: int = 10) -> DataFrame:
    """Leave-one-out measures of a fitted model (in-sample if fitted on the same customers)."""
    return evaluate.loo_metrics(
        evaluate.loo_units(baskets), model.scoring, model.popular, [model.variant], k
    )


def _baskets_of(table: DataFrame) -> DataFrame:
    return stage_in_slices(table, ["customer_unique_id"], customer_baskets)


def monthly_retrain(
    sources: Sources,
    params: dict,
    model_dir: str,
    cutoff_ym: str | None = None,
    cutoff: str = "after",
    version: str | None = None,
    k: int = 10,
    master: DataFrame | None = None,
) -> str:
    """Rebuild, clean, fit, evaluate, export and log one model version; returns the version.

    The cut-off applies to the cleaned table. With ``cutoff="before"`` it
    applies before cleaning, so that later months cannot influence medians and
    the price cap. A stored ``master`` (``layout.read_master``) stands in for
    the one built from the sources; in month folders, only the months up to an
    early cut-off are read.
    """
    if cutoff not in ("before", "after"):
        raise ValueError("cutoff must be 'before' or 'after'")
    version = version or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    early = cutoff_ym and cutoff == "before"
    if master is None:
        bought = F.date_format("order_purchase_timestamp", "yyyy-MM")
        master = staged_master(replace(sources, orders=sources.orders.where(bought <= cutoff_ym)) if early else sources)
    else:
        master = stage(master.where(F.col("order_ym") <= cutoff_ym) if early else master)
    clean = clean_master(master)
    if cutoff_ym and cutoff == "after":
        clean = clean.where(F.col("order_ym") <= cutoff_ym)
    baskets = _baskets_of(clean)
    model = fit(clean, params, baskets)
    metrics = stage(loo_of(model, baskets, k))
    publish_model(model, metrics, model_dir, version, cutoff_ym)
    return version


def feature_run(
    sources: Sources,
    n_components: int = 15,
    train_end: str = splits.TRAIN_END,
    validation_end: str = splits.VALIDATION_END,
) -> dict[str, DataFrame]:
    """Master table to features, SVD similarity and its evaluation; all frames by name."""
    raw = staged_master(sources)
    clean = clean_master(raw)
    flagged = flagged_master(raw)
    baskets = _baskets_of(clean)
    matrix = stage_in_slices(clean, ["customer_unique_id"], interactions)
    popular = stage(popularity(clean))
    category_factors = stage(factors.basket_factors(baskets, n_components))
    similarity = Latent(category_factors, {"sim": n_components})
    units = evaluate.loo_units(baskets)
    split = splits.with_split(clean, train_end, validation_end)
    train_baskets = _baskets_of(split.where("split = 'train'"))
    return {
        "master_raw": raw,
        "master_clean": clean,
        "cleaning_report": quality.cleaning_report(quality.grouped_sides(flagged), flagged),
        "rfm": features.build_rfm(clean),
        "category_features": features.build_category_features(clean),
        "matrix": matrix,
        "matrix_stats": matrix_stats(matrix),
        "category_factors": category_factors,
        "user_factors": factors.user_factors(matrix, category_factors),
        "similarity": factors.cosine_similarity(category_factors),
        "customer_baskets": baskets,
        "popularity": popular,
        "model_comparison": evaluate.compare_models(units, similarity, popular),
        "split_summary": splits.split_summary(split, train_end, validation_end),
        "split_evaluation": evaluate.evaluate_periods(split, train_baskets, similarity, popular),
        "monthly_evolution": evolution.expanding_refits(raw, n_components),
    }


def selection_run(
    sources: Sources,
    model_dir: str | None = None,
    k: int = 10,
    n_splits: int = 3,
    trials: int = 20,
    train_end: str = splits.TRAIN_END,
    validation_end: str = splits.VALIDATION_END,
) -> dict:
    """Family comparison, three searches, final model and its evaluation; exported if asked."""
    clean = clean_master(staged_master(sources))
    baskets = _baskets_of(clean)
    popular = stage(popularity(clean))

    def search(param_sets: list[dict]) -> DataFrame:
        return stage(tune.search_table(baskets, popular, param_sets, k, n_splits))

    tables = {
        "GridSearchCV": search(tune.grid_params(tune.GRID)),
        "RandomSearch": search(tune.random_params(tune.RANDOM_SPACE, 8)),
        "Conditional search": search(tune.conditional_params(trials)),
    }
    winner = tune.tuning_winner(tables)
    first = winner.first()
    params = tune.best_params(tables[first["search"]])
    model = fit(clean, params, baskets)
    loo = stage(loo_of(model, baskets, k))
    split = splits.with_split(clean, train_end, validation_end)
    past = split.where("split <> 'backtest'")
    past_baskets = _baskets_of(past)
    past_model = fit(past, params, past_baskets)
    found = {
        "families": tune.compare_families(baskets, popular, k=k),
        "searches": tables,
        "winner": winner,
        "best_params": params,
        "model": model,
        "leave_one_out": loo,
        "backtest": evaluate.backtest(
            past_baskets,
            split.where("split = 'backtest'"),
            past_model.scoring,
            past_model.popular,
            past_model.variant,
            k,
        ),
        "cross_validation": tune.cross_validate(baskets, popular, [params], k, n_splits),
        "category_influence": model.influence(15),
        "factor_importance": fit(clean, {"method": "svd", "n_components": 20}, baskets).factor_importance(
            clean
        ),
    }
    if model_dir:
        version = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
        best = first.asDict()
        measures = {
            "backtest": found["backtest"].first().asDict(),
            "cross_validation": found["cross_validation"]
            .agg(*(F.avg(c).alias(c) for c in ("precision", "recall", "f1", "coverage")))
            .first()
            .asDict(),
            "tuning_winner": {c: best[c] for c in ("search", "recall_mean", "precision_mean")},
        }
        found["path"] = publish_model(model, loo, model_dir, version, measures=measures)
    return found
