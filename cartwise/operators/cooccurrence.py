"""Category pairs bought by the same customer, and the similarity made from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Categories per block; a wider basket is split into block pairs that spread over tasks.
BLOCK = 64


def weighted_blocks(baskets: DataFrame, entries: Column, by: Sequence[str]) -> DataFrame:
    """Distinct (left, right) block pairs of sorted entries with their number of customers.

    A block with itself has no ``right``: a basket of one block moves once. Identical baskets collapse here into one weighted row (with partial counts
    before the shuffle), and the block pairs of one very wide basket are
    hashed to different tasks.
    """
    last = F.floor((F.size("entries") - 1) / BLOCK).cast("int")
    return (
        baskets.select(*by, F.sort_array(entries).alias("entries"))
        .select(
            *by,
            F.transform(
                F.sequence(F.lit(0), last),
                lambda i: F.slice("entries", i * BLOCK + 1, F.lit(BLOCK)),
            ).alias("blocks"),
        )
        .select(*by, "blocks", F.posexplode("blocks").alias("at", "left"))
        .select(
            *by,
            "left",
            F.posexplode(F.slice("blocks", F.col("at") + 1, F.size("blocks"))).alias("further", "right"),
        )
        .withColumn("right", F.when(F.col("further") > 0, F.col("right")))
        .groupBy(*by, "left", "right")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


def exploded_pairs(blocks: DataFrame, by: Sequence[str], skip: int) -> DataFrame:
    """All (a, b) with a before b; inside one block b starts ``skip`` places after a."""
    own = F.slice("left", F.col("at") + 1 + skip, F.size("left"))
    return blocks.select(*by, "customers", "left", "right", F.posexplode("left").alias("at", "a")).select(
        *by, "customers", "a", F.explode(F.coalesce("right", own)).alias("b")
    )


def pair_counts(baskets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Customers having both categories, ``cat_a < cat_b`` (per group)."""
    wide = baskets.where(F.size("cats") > 1)
    blocks = weighted_blocks(wide, F.col("cats"), by)
    return (
        exploded_pairs(blocks, by, skip=1)
        .groupBy(*by, F.col("a").alias("cat_a"), F.col("b").alias("cat_b"))
        .agg(F.sum("customers").alias("support"))
    )


def copurchase(baskets: DataFrame, min_support: int = 20) -> DataFrame:
    """Pairs reaching the support floor, most frequent first; empty if there are none."""
    return (
        pair_counts(baskets)
        .where(F.col("support") >= min_support)
        .orderBy(F.desc("support"), "cat_a", "cat_b")
    )


def category_customers(baskets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return (
        baskets.select(*by, F.explode("cats").alias("category_en"))
        .groupBy(*by, "category_en")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


def gram(baskets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Inner products of the count columns of the matrix, ``cat_a <= cat_b`` (per group)."""
    blocks = weighted_blocks(baskets, F.arrays_zip("cats", "counts"), by)
    return (
        exploded_pairs(blocks, by, skip=0)
        .groupBy(*by, F.col("a.cats").alias("cat_a"), F.col("b.cats").alias("cat_b"))
        .agg(F.sum(F.col("customers") * F.col("a.counts") * F.col("b.counts")).alias("dot"))
    )


def jaccard(
    pairs: DataFrame, singles: DataFrame, min_supports: Sequence[int], by: Sequence[str] = ()
) -> DataFrame:
    """Similarity rows in both directions plus the diagonal (1.0).

    One column ``w<floor>`` per support floor, so that several floors share one
    pass: shared / (n_a + n_b - shared), 0 below the floor.
    """
    by = list(by)
    names = [f"w{m}" for m in min_supports]
    n_a = singles.select(*by, F.col("category_en").alias("cat_a"), F.col("customers").alias("n_a"))
    n_b = singles.select(*by, F.col("category_en").alias("cat_b"), F.col("customers").alias("n_b"))
    support = F.col("support")
    ratio = support / (F.col("n_a") + F.col("n_b") - support)
    upper = (
        pairs.where(support >= min(min_supports))
        .join(n_a, [*by, "cat_a"])
        .join(n_b, [*by, "cat_b"])
        .select(
            *by,
            "cat_a",
            "cat_b",
            *(
                F.when(support >= m, ratio).otherwise(0.0).alias(name)
                for m, name in zip(min_supports, names)
            ),
        )
    )
    lower = upper.select(
        *by, F.col("cat_b").alias("cat_a"), F.col("cat_a").alias("cat_b"), *names
    )
    diagonal = singles.select(
        *by,
        F.col("category_en").alias("cat_a"),
        F.col("category_en").alias("cat_b"),
        *(F.lit(1.0).alias(n) for n in names),
    )
    return upper.unionByName(lower).unionByName(diagonal)


def copurchase_similarity(baskets: DataFrame, min_support: int = 10) -> DataFrame:
    return jaccard(pair_counts(baskets), category_customers(baskets), [min_support]).withColumnRenamed(
        f"w{min_support}", "sim"
    )


def centrality(similarity: DataFrame, top: int = 15) -> DataFrame:
    """Categories by the sum of their similarities to others."""
    return (
        similarity.groupBy(F.col("cat_a").alias("category_en"))
        .agg(
            F.sum(F.when(F.col("cat_a") != F.col("cat_b"), F.col("sim")).otherwise(0.0)).alias(
                "influence"
            )
        )
        .orderBy(F.desc("influence"), "category_en")
        .limit(top)
    )


def top_similarity(similarity: DataFrame, category_features: DataFrame, top: int = 20) -> DataFrame:
    """Similarities among the ``top`` categories by orders."""
    best = (
        category_features.orderBy(F.desc("total_orders"), "category_en")
        .limit(top)
        .select("category_en")
    )
    return similarity.join(best.withColumnRenamed("category_en", "cat_a"), "cat_a", "left_semi").join(
        best.withColumnRenamed("category_en", "cat_b"), "cat_b", "left_semi"
    )
