"""Latent factors of the customer x category matrix.

The truncated SVD of few categories is computed from the Gram matrix
(categories x categories), which Spark aggregates from all customers and one
task per group decomposes. Beyond a checked number of categories ``krylov``
finds the same vectors without that matrix. Non-negative factors are in ``nmf``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.operators import krylov, nmf
from cartwise.operators.cooccurrence import gram
from cartwise.operators.latent import NEGLIGIBLE
from cartwise.session import stage

# The small helpers below run in Python workers, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Categories up to which a Gram matrix (8 bytes per pair: 32 MB) may sit in one task.
DENSE_CATEGORIES = 2_000
# Categories (about) of a block of the similarity table.
PAIR_BLOCK = 1_024


def _dense(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    cats = np.unique(np.concatenate([pdf["cat_a"].to_numpy(), pdf["cat_b"].to_numpy()]))
    a = np.searchsorted(cats, pdf["cat_a"].to_numpy())
    b = np.searchsorted(cats, pdf["cat_b"].to_numpy())
    matrix = np.zeros((len(cats), len(cats)))
    matrix[a, b] = pdf["dot"].to_numpy(dtype=float)
    matrix[b, a] = pdf["dot"].to_numpy(dtype=float)
    return cats, matrix


def _leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues with vectors as columns; the largest loading of each is positive."""
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    peak = np.abs(vectors).argmax(axis=0)
    return np.maximum(values, 0), vectors * np.where(vectors[peak, np.arange(vectors.shape[1])] < 0, -1, 1)


def _clip(k: int, n_cats: int) -> int:
    return max(1, min(k, n_cats - 1))


def check_dense(products: DataFrame, by: Sequence[str] = ()) -> bool:
    """Whether every group's Gram matrix is small enough for one task."""
    widest = (
        products.where("cat_a = cat_b").groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"))
    )
    return (widest.first()[0] or 0) <= DENSE_CATEGORIES


def category_factors(products: DataFrame, n_components: int = 15) -> DataFrame:
    """Right singular vectors: category_en, ``factors`` (array) and ``sigma`` (array)."""
    return group_factors(products, n_components)


def group_factors(products: DataFrame, n_components: int, by: Sequence[str] = ()) -> DataFrame:
    """The same per group, from inner products of the matrix' columns (``by``, cat_a <= cat_b, dot).

    The first k factors are those of a smaller ``n_components``. A group's
    matrix goes to one task if it is small enough, else block Lanczos steps
    multiply with the table of products.
    """
    by = list(by)
    if not check_dense(products, by):
        return _distributed_factors(products, n_components, by)

    def decompose(pdf: pd.DataFrame) -> pd.DataFrame:
        cats, matrix = _dense(pdf)
        values, vectors = _leading(matrix, _clip(n_components, len(cats)))
        out = {c: [pdf[c].iloc[0]] * len(cats) for c in by}
        return pd.DataFrame(
            {**out, "category_en": cats, "factors": list(vectors), "sigma": [np.sqrt(values)] * len(cats)}
        )

    types = dict(products.dtypes)
    schema = ", ".join([*(f"{c} {types[c]}" for c in by), "category_en string, factors array<double>, sigma array<double>"])
    return products.groupBy(*by).applyInPandas(decompose, schema)


def _distributed_factors(products: DataFrame, n_components: int, by: Sequence[str] = ()) -> DataFrame:
    return krylov.leading_factors(krylov.Products(products, tuple(by)), n_components)


def is_wide(baskets: DataFrame, by: Sequence[str] = ()) -> bool:
    """Whether some group has more categories than a Gram matrix in one task may have."""
    cats = baskets.select(*by, F.explode("cats").alias("c")).distinct()
    return (cats.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0) > DENSE_CATEGORIES


def basket_factors(baskets: DataFrame, n_components: int, by: Sequence[str] = ()) -> DataFrame:
    """Category factors straight from baskets; with very many categories no product of two columns is formed."""
    if is_wide(baskets, by):
        return krylov.leading_factors(krylov.Cells.of_baskets(baskets, by), n_components)
    return group_factors(stage(gram(baskets, by)), n_components, by)


def cosine_similarity(factors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cosine between the factor rows of all categories (both directions, with diagonal), per group.

    A product of blocks: categories are hashed into blocks of about
    ``PAIR_BLOCK``, every block meets every block of its group by a join on the
    block number, and a task multiplies one pair of blocks at a time. The
    output has a row per pair of categories; rankings do without it (``latent``).
    """
    by = list(by)
    most = factors.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    blocks = -(-most // PAIR_BLOCK)
    block = F.pmod(F.xxhash64("category_en"), F.lit(blocks)).cast("int")
    packed = stage(
        factors.groupBy(*by, block.alias("block"))
        .agg(F.collect_list(F.struct("category_en", "factors")).alias("e"))
        .select(*by, "block", F.col("e.category_en").alias("cats"), F.col("e.factors").alias("vectors"))
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    left = packed.select(*by, F.col("cats").alias("left_cats"), F.col("vectors").alias("left_vectors"), every)
    names = [*by, "cat_a", "cat_b", "sim"]

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.to_dict("records"):
                sims = _unit_rows(np.vstack(row["left_vectors"])) @ _unit_rows(np.vstack(row["vectors"])).T
                pairs = {"cat_a": np.repeat(row["left_cats"], sims.shape[1]), "cat_b": np.tile(row["cats"], sims.shape[0])}
                yield pd.DataFrame({**{c: row[c] for c in by}, **pairs, "sim": sims.ravel()})[names]

    types = dict(factors.dtypes)
    schema = ", ".join([*(f"{c} {types[c]}" for c in by), "cat_a string, cat_b string, sim double"])
    return left.join(packed, [*by, "block"]).mapInPandas(multiply, schema)


def _unit_rows(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > NEGLIGIBLE)


def svd_similarity(baskets: DataFrame, n_components: int = 15) -> DataFrame:
    return cosine_similarity(stage(basket_factors(baskets, n_components)))


def svd_similarities(products: DataFrame, components: Sequence[int], by: Sequence[str]) -> DataFrame:
    """Cosine tables for several factor numbers and groups: one weight column ``svd<k>`` each."""
    factors = stage(group_factors(products, max(components), by))
    tables = None
    for k in components:
        leading = factors.withColumn("factors", F.slice("factors", 1, k))
        one = cosine_similarity(leading, by).withColumnRenamed("sim", f"svd{k}")
        tables = one if tables is None else tables.join(one, [*by, "cat_a", "cat_b"])
    return tables


def user_factors(matrix: DataFrame, factors: DataFrame) -> DataFrame:
    """Customer coordinates: sum of counts times category factors, one row per customer."""
    terms = matrix.join(factors, F.col("category") == F.col("category_en")).select(
        "user", "interactions", F.posexplode("factors").alias("factor", "loading")
    )
    return (
        terms.groupBy("user", "factor")
        .agg(F.sum(F.col("interactions") * F.col("loading")).alias("value"))
        .groupBy("user")
        .agg(F.sort_array(F.collect_list(F.struct("factor", "value"))).alias("pairs"))
        .select("user", F.col("pairs.value").alias("factors"))
    )


def explained_variance(
    matrix: DataFrame, products: DataFrame, factors: DataFrame, n_users: int
) -> DataFrame:
    """Share of the column variance carried by each factor, and its running sum.

    From category-sized tables only: (v'Gv/n - (m'v/n)^2) over the summed
    column variances, with m the column sums.
    """
    n = float(n_users)
    sums = stage(matrix.groupBy(F.col("category").alias("category_en")).agg(F.sum("interactions").alias("m")))
    loadings = factors.select("category_en", F.posexplode("factors").alias("factor", "v"))
    quadratic = (
        products.join(loadings.withColumnsRenamed({"category_en": "cat_a", "v": "va"}), "cat_a")
        .join(loadings.withColumnsRenamed({"category_en": "cat_b", "v": "vb"}), ["cat_b", "factor"])
        .groupBy("factor")
        .agg(
            F.sum(
                F.col("dot") * F.col("va") * F.col("vb") * F.when(F.col("cat_a") == F.col("cat_b"), 1).otherwise(2)
            ).alias("vgv")
        )
    )
    means = (
        loadings.join(sums, "category_en").groupBy("factor").agg(F.sum(F.col("m") * F.col("v")).alias("mv"))
    )
    total = (
        products.where("cat_a = cat_b")
        .join(sums.withColumnRenamed("category_en", "cat_a"), "cat_a")
        .agg(F.sum(F.col("dot") / n - (F.col("m") / n) ** 2))
        .scalar()
    )
    running = Window.orderBy("factor").rowsBetween(Window.unboundedPreceding, 0)
    return (
        quadratic.join(means, "factor")
        .withColumn("total", total)
        .select(
            "factor",
            F.try_divide(F.col("vgv") / n - (F.col("mv") / n) ** 2, F.col("total")).alias("ratio"),
        )
        .select(
            F.concat(F.lit("F"), (F.col("factor") + 1).cast("string")).alias("factor"),
            F.col("ratio").alias("explained_variance"),
            F.sum("ratio").over(running).alias("cumulative_variance"),
        )
    )


def loading_influence(factors: DataFrame, top: int = 15) -> DataFrame:
    """Categories by the sum of their absolute loadings."""
    return (
        factors.select(
            "category_en",
            F.expr("aggregate(factors, 0D, (s, x) -> s + abs(x))").alias("influence"),
        )
        .orderBy(F.desc("influence"), "category_en")
        .limit(top)
    )


def factor_map(factors: DataFrame, category_features: DataFrame) -> DataFrame:
    """Two principal components of the centred category factors, with the order volume."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    size = len(factors.select("factors").first()[0])
    centre = factors.agg(
        F.array(*(F.avg(F.col("factors")[i]) for i in range(size)))
    ).scalar()
    centred = (
        factors.withColumn("centre", centre)
        .select(
            "category_en",
            array_to_vector(F.zip_with("factors", "centre", lambda x, m: x - m)).alias("v"),
        )
    )
    centred = stage(centred.select("category_en", vector_to_array("v").alias("a"))).select(
        "category_en", array_to_vector("a").alias("v")
    )
    model = PCA(k=min(2, size), inputCol="v", outputCol="p").fit(centred)
    components = model.pc.toArray()
    signs = [1.0 if c[np.abs(c).argmax()] >= 0 else -1.0 for c in components.T] + [1.0]
    placed = model.transform(centred).withColumn("p", vector_to_array("p"))
    return placed.select(
        "category_en",
        (F.col("p")[0] * signs[0]).alias("x"),
        (F.get("p", F.lit(1)) * signs[1]).alias("y"),
    ).join(category_features.select("category_en", "total_orders"), "category_en", "left")


# --- non-negative factorisation -------------------------------------------------


def nmf_factors(
    baskets: DataFrame, n_components: int = 15, rounds: int = 300, tolerance: float = 1e-4
) -> tuple[DataFrame, list[float]]:
    """Non-negative category factors and the squared error at the start of each round (see ``nmf``)."""
    return nmf.descend(baskets, stage(basket_factors(baskets, n_components)), rounds, tolerance)
