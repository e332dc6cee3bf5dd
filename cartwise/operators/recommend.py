"""Batch recommendation for all customers at once.

A recommendation depends only on the set of purchased categories, so customers
are first collapsed into *units* (distinct baskets with a weight). A unit meets
the model through one table of links:

* ``c:<category>`` -> every similar category with its weights, and the
  category itself marked as owned;
* ``r:<rank>`` -> the category at that popularity rank.

A unit looks up its categories and the ranks 1..k+|basket|. With similarities
that are never negative no category further down the popularity list can reach
the top k: at least k categories that are not owned precede it. A table with
negative similarities makes every category a candidate of every unit, in rows.
Cosines of category factors are not looked up in a table: ``latent`` multiplies
the units with blocks of category vectors and keeps k categories of each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.columns import score_key
from cartwise.operators import threshold
from cartwise.operators.latent import Latent, rank_by_factors
from cartwise.session import large_side, small_side, stage


@dataclass(frozen=True)
class Variant:
    """One way to score: a weight column of the similarity table and the mix with popularity.

    ``weight=None`` is pure popularity. ``keep_all`` ranks every scored
    category, also those with a score of zero or less.
    """

    name: str
    weight: str | None = None
    alpha: float = 1.0
    keep_all: bool = False


@dataclass(frozen=True)
class Weights:
    """Where the weights of variants come from: a table of category pairs, category factors, or both."""

    links: DataFrame | None = None
    latents: tuple[Latent, ...] = ()


Similarity = DataFrame | Latent | Weights | None


def weights_of(similarity: Similarity) -> Weights:
    if isinstance(similarity, Weights):
        return similarity
    return Weights(latents=(similarity,)) if isinstance(similarity, Latent) else Weights(similarity)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def basket_units(baskets: DataFrame, cats: Column | str = "cats", by: Sequence[str] = ()) -> DataFrame:
    """Distinct baskets (sorted ``cats``) with ``customers`` and a stored ``unit_id``."""
    cats = F.col(cats) if isinstance(cats, str) else cats
    units = (
        baskets.groupBy(*by, F.sort_array(cats).alias("cats"))
        .agg(F.count(F.lit(1)).alias("customers"))
        .withColumn("unit_id", F.monotonically_increasing_id())
    )
    return stage(units)  # the ids must not be drawn twice


def model_links(
    similarity: DataFrame | None, popular: DataFrame, weights: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """The lookup table described above; staged, so that Spark knows its size."""
    by = list(by)
    none = [F.lit(0.0).alias(w) for w in weights]
    owned = popular.select(
        *by,
        F.concat(F.lit("c:"), "category_en").alias("key"),
        F.col("category_en").alias("category"),
        F.lit(1).alias("owned"),
        *none,
    )
    ranks = popular.select(
        *by,
        F.concat(F.lit("r:"), F.col("rank").cast("string")).alias("key"),
        F.col("category_en").alias("category"),
        F.lit(0).alias("owned"),
        *none,
    )
    links = owned.unionByName(ranks)
    if similarity is not None:
        nonzero = F.lit(False)
        for w in weights:
            nonzero = nonzero | (F.col(w) != 0)
        links = links.unionByName(
            similarity.where(nonzero).select(
                *by,
                F.concat(F.lit("c:"), "cat_a").alias("key"),
                F.col("cat_b").alias("category"),
                F.lit(0).alias("owned"),
                *weights,
            )
        )
    return stage(links)


def _reach(
    similarity: DataFrame | None, popular: DataFrame, variants: Sequence[Variant], weights: Sequence[str], k: int
) -> int:
    """How many popular categories beside the basket's own are candidates of a unit.

    Where no score is negative and categories without a score are filled by
    popularity, the first ``k`` are enough. Otherwise a category of score 0 may
    rank before a linked one, or by its name, so every category is a candidate.
    """
    every = any(v.keep_all for v in variants)
    if not every and similarity is not None and weights:
        below = F.least(F.lit(0.0), *(F.col(w).cast("double") for w in weights))
        every = (similarity.agg(F.min(below)).first()[0] or 0.0) < 0
    return max(k, popular.agg(F.max("rank")).first()[0] or 0) if every else k


def rank_units(
    units: DataFrame,
    similarity: Similarity,
    popular: DataFrame,
    variants: Sequence[Variant],
    k: int,
    by: Sequence[str] = (),
    carry: Sequence[str] = (),
) -> DataFrame:
    """The k best categories per unit and variant.

    Columns: ``by``, unit_id, ``carry``, variant, category, rank, affinity (sum
    of similarities to the basket) and score. Variants whose weight is a cosine
    of factors are ranked by ``rank_by_factors``, the others by links.
    """
    weights = weights_of(similarity)
    by_factors = {w for latent in weights.latents for w in latent.weights}
    linked = [v for v in variants if v.weight not in by_factors]
    latent = [v for v in variants if v.weight in by_factors]
    ranked = _rank_by_links(units, weights.links, popular, linked, k, by, carry) if linked or not latent else None
    if latent:
        found = rank_by_factors(units, weights.latents, popular, latent, k, by, carry)
        ranked = found if ranked is None else ranked.unionByName(found)
    return ranked


def _rank_by_links(
    units: DataFrame,
    similarity: DataFrame | None,
    popular: DataFrame,
    variants: Sequence[Variant],
    k: int,
    by: Sequence[str] = (),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Pairs that fit are sent to the tasks (``threshold``). Else only the unit rows are shuffled:
    lookups, sums and rankings all stay in the unit's partition as long as the
    links are small enough for Spark to broadcast.
    """
    by, carry = list(by), list(carry)
    weights = sorted({v.weight for v in variants if v.weight})
    if threshold.fits(similarity, popular, variants, weights, by):
        return threshold.rank_by_pairs(units, similarity, popular, variants, k, by, carry)
    links = model_links(similarity, popular, weights, by)
    reach = _reach(similarity, popular, variants, weights, k)
    popular = stage(
        popular.select(
            *by,
            F.col("category_en").alias("category"),
            F.col("rank").alias("pop_rank"),
            "pop_score",
        )
    )
    keys = F.concat(
        F.transform("cats", lambda c: F.concat(F.lit("c:"), c)),
        F.transform(
            F.sequence(F.lit(1), F.size("cats") + reach),
            lambda r: F.concat(F.lit("r:"), r.cast("string")),
        ),
    )
    unit = [*by, "unit_id"]
    candidates = (
        units.repartition(shuffle_partitions(units), "unit_id")
        .select(*unit, *carry, F.explode(keys).alias("key"))
        .join(small_side(links), [*by, "key"])
        .groupBy(*unit, *carry, "category")  # carried columns depend on the unit
        .agg(F.max("owned").alias("owned"), *(F.sum(w).alias(w) for w in weights))
        .join(small_side(popular), [*by, "category"])
    )
    peak = Window.partitionBy(*unit)
    scaled = candidates.withColumns({f"max_{w}": F.max(w).over(peak) for w in weights}).where(
        "owned = 0"
    )
    options = []
    for v in variants:
        affinity = F.col(v.weight) if v.weight else F.lit(0.0)
        if v.weight and not v.keep_all:
            share = F.when(F.col(f"max_{v.weight}") > 0, affinity / F.col(f"max_{v.weight}")).otherwise(
                affinity
            )
            score = F.lit(v.alpha) * share + F.lit(1 - v.alpha) * F.col("pop_score")
        else:
            score = affinity
        listed = F.lit(True) if v.keep_all else score > 0
        options.append(
            F.struct(
                F.lit(v.name).alias("variant"),
                affinity.alias("affinity"),
                score.alias("score"),
                listed.alias("listed"),
            )
        )
    scored = scaled.select(
        *unit, *carry, "category", "pop_rank", F.explode(F.array(*options)).alias("o")
    ).select(*unit, *carry, "category", "pop_rank", "o.*")
    order = Window.partitionBy(*unit, "variant").orderBy(
        F.desc("listed"),
        F.when(F.col("listed"), score_key(F.col("score"))).desc(),
        F.when(~F.col("listed"), F.col("pop_rank")).asc(),
        F.asc("category"),
    )
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(*unit, *carry, "variant", "category", "rank", "affinity", "score")
    )


# A basket shared by more than one customer in this many is joined by broadcast.
HOT_SHARE = 1_000


def attach_to_customers(baskets: DataFrame, per_basket: DataFrame) -> DataFrame:
    """Customers with the row of their basket (``cats``, ``customers`` and more; staged).

    At most ``HOT_SHARE`` baskets can each hold more than that share of all
    customers. Those few rows are broadcast, so no task receives all customers
    of a hot basket; the other baskets meet their customers in a shuffle.
    """
    total = per_basket.agg(F.sum("customers")).first()[0] or 0
    hot = per_basket.where(F.col("customers") * HOT_SHARE > total)
    rare = per_basket.where(F.col("customers") * HOT_SHARE <= total)
    users = baskets.select("customer_unique_id", F.sort_array("cats").alias("cats"))
    in_hot = users.join(F.broadcast(hot), "cats")
    in_rare = users.join(F.broadcast(hot.select("cats")), "cats", "left_anti").join(large_side(rare), "cats")
    return in_hot.unionByName(in_rare)


def recommend_all(
    baskets: DataFrame,
    similarity: Similarity,
    popular: DataFrame,
    variant: Variant,
    k: int = 10,
) -> DataFrame:
    """Ranked categories for every customer: customer, category, rank, affinity, score, explain.

    ``explain`` is the mean similarity of the category to the customer's basket.
    """
    units = basket_units(baskets)
    lists = stage(
        rank_units(units, similarity, popular, [variant], k)
        .groupBy("unit_id")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "category", "affinity", "score"))).alias("recs"))
        .join(large_side(units), "unit_id")
        .select("cats", "customers", "recs")
    )
    return (
        attach_to_customers(baskets, lists)
        .select("customer_unique_id", F.size("cats").alias("n_cats"), F.inline("recs"))
        .select(
            "customer_unique_id",
            "category",
            "rank",
            "affinity",
            "score",
            (F.col("affinity") / F.col("n_cats")).alias("explain"),
        )
    )
