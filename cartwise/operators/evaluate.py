"""Offline evaluation: leave-one-out, period and backtest measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.operators import threshold
from cartwise.operators.recommend import Similarity, Variant, attach_to_customers, basket_units, rank_units
from cartwise.session import large_side, small_side, stage


def loo_units(baskets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Hide the last first-purchased category of customers having two or more.

    Customers with the same remaining basket and the same hidden category
    become one row with a weight.
    """
    known = F.slice("cats", F.lit(1), F.size("cats") - 1)
    units = (
        baskets.where("n_categories >= 2")
        .select(*by, F.sort_array(known).alias("cats"), F.element_at("cats", -1).alias("test"))
        .groupBy(*by, "cats", "test")
        .agg(F.count(F.lit(1)).alias("customers"))
        .withColumn("unit_id", F.monotonically_increasing_id())
    )
    return stage(units)


def popularity_rank_counts(units: DataFrame, popular: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many customers find their hidden category at which place of the popularity list.

    The place is its popularity rank minus the owned categories ranked above
    it, so one frame answers every k. A hidden category outside the list gets
    no row. A list that fits is sent to the tasks and no unit moves; a longer
    one is looked up by a join.
    """
    by = list(by)
    if threshold.fits(None, popular, (), (), by):
        places = threshold.popular_places(units, popular, by)
        if places is not None:
            return places.groupBy(*by, "place").agg(F.sum("customers").alias("customers"))
    entries = F.concat(
        F.transform("cats", lambda c: F.struct(c.alias("category_en"), F.lit(False).alias("hidden"))),
        F.array(F.struct(F.col("test").alias("category_en"), F.lit(True).alias("hidden"))),
    )
    places = (
        units.select(*by, "unit_id", "customers", F.inline(entries))
        .join(small_side(popular.select(*by, "category_en", "rank")), [*by, "category_en"])
        .groupBy(*by, "unit_id")
        .agg(
            F.first("customers").alias("customers"),
            F.max(F.when(F.col("hidden"), F.col("rank"))).alias("at"),
            F.collect_list(F.when(~F.col("hidden"), F.col("rank"))).alias("owned"),
        )
        .where("at IS NOT NULL")
        .select(
            *by,
            "customers",
            (F.col("at") - F.size(F.filter("owned", lambda r: r < F.col("at")))).alias("place"),
        )
    )
    return places.groupBy(*by, "place").agg(F.sum("customers").alias("customers"))


def popularity_at_k(
    units: DataFrame, popular: DataFrame, ks: Sequence[int], by: Sequence[str] = ()
) -> DataFrame:
    """Precision and recall of the popularity list for each k."""
    return measures_at_k(units, popularity_rank_counts(units, popular, by), ks, by)


def loo_metrics(
    units: DataFrame,
    similarity: Similarity,
    popular: DataFrame,
    variants: Sequence[Variant],
    k: int = 10,
    by: Sequence[str] = (),
) -> DataFrame:
    """Precision, recall, F1, hit rate, coverage and users per variant (and group)."""
    by = list(by)
    ranked = rank_units(
        units, similarity, popular, variants, k, by, carry=["test", "customers"]
    )
    per_category = ranked.groupBy(*by, "variant", "category").agg(
        F.sum(F.when(F.col("category") == F.col("test"), F.col("customers")).otherwise(0)).alias("hits")
    )
    found = per_category.groupBy(*by, "variant").agg(
        F.sum("hits").alias("hits"), F.count(F.lit(1)).alias("covered")
    )
    return metric_rows(units, popular, found, variants, k, by)


def metric_rows(
    units: DataFrame,
    popular: DataFrame,
    found: DataFrame,
    variants: Sequence[Variant],
    k: int,
    by: list[str],
) -> DataFrame:
    """Turn hits and covered categories into measures; a variant without users gets zeros."""
    names = F.explode(F.array(*(F.lit(v.name) for v in variants))).alias("variant")
    sizes = popular.groupBy(*by).agg(F.count(F.lit(1)).alias("n_cats"))
    totals = units.groupBy(*by).agg(F.coalesce(F.sum("customers"), F.lit(0)).alias("n_users"))
    if by:
        base = sizes.join(totals, by, "left").select(*by, "n_cats", "n_users", names)
        joined = base.join(found, [*by, "variant"], "left")
    else:
        joined = (
            totals.withColumn("n_cats", sizes.scalar())
            .select("n_cats", "n_users", names)
            .join(found, "variant", "left")
        )
    zero = F.lit(0.0)
    hits = F.coalesce("hits", F.lit(0))
    users = F.coalesce("n_users", F.lit(0))
    rows = joined.select(
        *by,
        "variant",
        F.coalesce(F.try_divide(hits, users * k), zero).alias("precision"),
        F.coalesce(F.try_divide(hits, users), zero).alias("recall"),
        F.coalesce(F.try_divide(hits, users), zero).alias("hit_rate"),
        F.coalesce(F.try_divide(F.coalesce("covered", F.lit(0)), "n_cats"), zero).alias("coverage"),
        users.alias("n_users"),
    )
    both = F.col("precision") + F.col("recall")
    return rows.withColumn(
        "f1", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0)
    )


def raw_similarity_recall(
    units: DataFrame,
    similarity: Similarity,
    popular: DataFrame,
    ks: Sequence[int],
    weight: str = "sim",
    by: Sequence[str] = (),
) -> DataFrame:
    """Leave-one-out measures of the plain similarity sum for each k (one ranking serves all)."""
    by = list(by)
    ranked = rank_units(
        units,
        similarity,
        popular,
        [Variant("similarity", weight, keep_all=True)],
        max(ks),
        by,
        carry=["test", "customers"],
    )
    places = (
        ranked.where(F.col("category") == F.col("test"))
        .groupBy(*by, F.col("rank").alias("place"))
        .agg(F.sum("customers").alias("customers"))
    )
    return measures_at_k(units, places, ks, by)


def measures_at_k(
    units: DataFrame, places: DataFrame, ks: Sequence[int], by: Sequence[str] = ()
) -> DataFrame:
    """Precision and recall per k from the number of customers at each place."""
    by = list(by)
    all_k = F.array(*(F.lit(int(k)) for k in ks))
    hits = (
        places.select(*by, "customers", F.explode(F.filter(all_k, lambda k: k >= F.col("place"))).alias("k"))
        .groupBy(*by, "k")
        .agg(F.sum("customers").alias("hits"))
    )
    grid = (
        units.groupBy(*by)
        .agg(F.coalesce(F.sum("customers"), F.lit(0)).alias("n_users"))
        .select(*by, "n_users", F.explode(all_k).alias("k"))
    )
    hit, zero = F.coalesce("hits", F.lit(0)), F.lit(0.0)
    return grid.join(hits, [*by, "k"], "left").select(
        *by,
        "k",
        F.coalesce(F.try_divide(hit, F.col("k") * F.col("n_users")), zero).alias("precision"),
        F.coalesce(F.try_divide(hit, F.col("n_users")), zero).alias("recall"),
        "n_users",
    )


def compare_models(
    units: DataFrame,
    similarity: Similarity,
    popular: DataFrame,
    ks: Sequence[int] = (5, 10, 20),
    weight: str = "sim",
) -> DataFrame:
    """Popularity against the similarity model per k, with relative differences in percent.

    The similarity is fitted on all customers, so its figures are in-sample.
    """
    base = popularity_at_k(units, popular, ks)
    model = raw_similarity_recall(units, similarity, popular, ks, weight)
    both = base.select(
        "k",
        F.col("precision").alias("precision_baseline"),
        F.col("recall").alias("recall_baseline"),
    ).join(
        model.select(
            "k", F.col("precision").alias("precision_model"), F.col("recall").alias("recall_model")
        ),
        "k",
    )

    def delta(name: str):
        change = F.try_divide(F.col(f"{name}_model"), F.col(f"{name}_baseline")) * 100 - 100
        return F.format_string("%+.1f%%", F.coalesce(change, F.lit(0.0)))

    return both.withColumns({"delta_precision": delta("precision"), "delta_recall": delta("recall")})


def _truth_pairs(period: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return (
        period.where("customer_unique_id IS NOT NULL AND category_en IS NOT NULL")
        .select(*extra, "customer_unique_id", F.col("category_en").alias("category"))
        .distinct()
    )


def evaluate_periods(
    split: DataFrame,
    train_baskets: DataFrame,
    similarity: Similarity,
    popular: DataFrame,
    k: int = 10,
    weight: str = "sim",
) -> DataFrame:
    """Share of all later categories found in the top k, per later period.

    Customers are those with training history; their later categories count
    even if they bought them before. The history is the training period for
    both later periods.
    """
    units = basket_units(train_baskets)
    known = attach_to_customers(train_baskets, units)
    truth = stage(
        _truth_pairs(split.where("split <> 'train'"), ["split"])
        .join(large_side(known.select("customer_unique_id", "unit_id")), "customer_unique_id")
    )
    ranked = rank_units(
        units, similarity, popular, [Variant("similarity", weight, keep_all=True)], k
    ).select("unit_id", "category")
    weighted = truth.groupBy("split", "unit_id", "category").agg(F.count(F.lit(1)).alias("n"))
    hits = weighted.join(large_side(ranked), ["unit_id", "category"]).groupBy("split").agg(F.sum("n").alias("hits"))
    # Customers seen in the period, with or without a known category there.
    seen = (
        split.where("split <> 'train'")
        .select("split", "customer_unique_id")
        .distinct()
        .join(large_side(train_baskets.select("customer_unique_id")), "customer_unique_id", "left_semi")
        .groupBy("split")
        .agg(F.count(F.lit(1)).alias("n_users"))
    )
    totals = weighted.groupBy("split").agg(F.sum("n").alias("relevant"))
    return (
        seen.join(totals, "split", "left")
        .join(hits, "split", "left")
        .select(
            "split",
            "n_users",
            F.coalesce(F.try_divide(F.coalesce("hits", F.lit(0)), F.col("relevant")), F.lit(0.0)).alias(
                "recall"
            ),
        )
    )


def backtest(
    train_baskets: DataFrame,
    later: DataFrame,
    similarity: Similarity,
    popular: DataFrame,
    variant: Variant,
    k: int = 10,
) -> DataFrame:
    """Mean per-customer precision and recall on categories that are new in the later period."""
    units = basket_units(train_baskets)
    history = train_baskets.select("customer_unique_id", F.explode("cats").alias("category"))
    known = attach_to_customers(train_baskets, units)
    fresh = (
        _truth_pairs(later)
        .join(large_side(known.select("customer_unique_id", "unit_id")), "customer_unique_id")
        .join(large_side(history), ["customer_unique_id", "category"], "left_anti")
    )
    per_customer = fresh.groupBy("customer_unique_id", "unit_id").agg(
        F.collect_list("category").alias("relevant")  # bounded by the number of categories
    )
    relevant = stage(
        per_customer.groupBy("unit_id", F.sort_array("relevant").alias("relevant")).agg(
            F.count(F.lit(1)).alias("customers")
        )
    )
    wanted = (
        relevant.select(
            "unit_id",
            F.explode("relevant").alias("category"),
            "customers",
            (F.col("customers") / F.size("relevant")).alias("recall_part"),
        )
        .groupBy("unit_id", "category")
        .agg(F.sum("customers").alias("customers"), F.sum("recall_part").alias("recall_part"))
    )
    ranked = rank_units(units, similarity, popular, [variant], k).select("unit_id", "category")
    hits = (
        wanted.join(large_side(ranked), ["unit_id", "category"])
        .agg(F.struct(F.sum("customers").alias("hits"), F.sum("recall_part").alias("recall")))
        .scalar()
    )
    return (
        relevant.agg(F.coalesce(F.sum("customers"), F.lit(0)).alias("n_users"))
        .withColumn("found", hits)
        .select(
            F.coalesce(F.try_divide(F.col("found.hits"), F.col("n_users") * k), F.lit(0.0)).alias(
                "precision"
            ),
            F.coalesce(F.try_divide(F.col("found.recall"), F.col("n_users")), F.lit(0.0)).alias("recall"),
            "n_users",
        )
    )
