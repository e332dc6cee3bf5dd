"""Non-negative factorisation of the customer x category matrix by alternating coordinate descent.

The start is made from the singular vectors: of each, the positive or the
negative parts of both sides, whichever weigh more, zeros filled with the mean
of the matrix. Then rows are solved for fixed category factors H, and
categories for fixed row factors W, each by sweeps of exact one-coordinate
steps; with one side fixed the other's rows do not depend on each other.

Up to ``FACTOR_ROWS`` categories H goes to the tasks and a round is one job
that returns only W'X and W'W. Beyond, H is a table: rows meet it by a join,
and categories are solved where their part of W'X arrives; the driver then
holds nothing but k x k matrices.
"""

from __future__ import annotations

import sys
import warnings
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.operators.krylov import Cells
from cartwise.session import stage, unstage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of a factor matrix (at most some 40 doubles each) that may be sent to the tasks.
FACTOR_ROWS = 100_000
SWEEPS = 200  # of coordinate steps at most; they end when nothing moves
ZERO = 1e-6  # start values below are taken as zeros


def solve(products: np.ndarray, inner: np.ndarray, start: np.ndarray, precision: float = 1e-6) -> np.ndarray:
    """Rows y >= 0 that minimise |x - y F|^2 for fixed factors F: ``products`` = x F', ``inner`` = F F'.

    Sweeps end when no entry moves by more than ``precision`` of the largest;
    the error is then off by about its square.
    """
    y = start.copy()
    scale = max(np.abs(y).max(initial=0.0), 1e-12)
    for _ in range(SWEEPS):
        moved = 0.0
        for t in np.flatnonzero(np.diag(inner) > 0):
            step = np.maximum(y[:, t] + (products[:, t] - y @ inner[:, t]) / inner[t, t], 0.0)
            moved = max(moved, np.abs(step - y[:, t]).max(initial=0.0))
            y[:, t] = step
        scale = max(scale, np.abs(y).max(initial=0.0))
        if moved <= precision * scale:
            break
    return y


def start_factors(vectors: np.ndarray, sigma: np.ndarray, positive: np.ndarray, negative: np.ndarray, mean: float) -> np.ndarray:
    """Start of H (categories x k). ``positive`` and ``negative``: the squared lengths of both parts of each left vector."""
    h = np.empty_like(vectors)
    h[:, 0] = np.sqrt(sigma[0]) * np.abs(vectors[:, 0])
    for j in range(1, vectors.shape[1]):
        up, down = np.maximum(vectors[:, j], 0), np.maximum(-vectors[:, j], 0)
        weigh_up = np.linalg.norm(up) * np.sqrt(positive[j])
        weigh_down = np.linalg.norm(down) * np.sqrt(negative[j])
        side, weight = (up, weigh_up) if weigh_up > weigh_down else (down, weigh_down)
        length = np.linalg.norm(side)
        h[:, j] = np.sqrt(sigma[j] * weight) * side / length if length > 0 else 0.0
    return np.where(h < ZERO, mean, h)


def _totals(cells: Cells, factors: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, float]:
    """sigma, squared lengths of the parts of the left vectors, mean and squared norm of the matrix."""
    sigma = np.asarray(factors.first()["sigma"])
    columns = [F.col("factors")[i].alias(f"v{i}") for i in range(k)]
    rows = (
        cells.table.join(factors.select("category_en", *columns), "category_en")
        .groupBy("row", "weight")
        .agg(*(F.sum(F.col("x") * F.col(f"v{i}")).alias(f"y{i}") for i in range(k)))
    )
    parts = [f(F.lit(0.0), s * F.col(f"y{i}")) for i in range(k) for f, s in ((F.greatest, 1), (F.greatest, -1))]
    squares = rows.agg(*(F.sum(F.col("weight") * p * p).alias(f"p{n}") for n, p in enumerate(parts))).first()
    lengths = np.array([x or 0.0 for x in squares]).reshape(k, 2) / np.maximum(sigma, 1e-12)[:, None] ** 2
    sums = cells.table.agg(
        F.sum(F.col("weight") * F.col("x")).alias("s"), F.sum(F.col("weight") * F.col("x") * F.col("x")).alias("q")
    ).first()
    weights = cells.table.select("row", "weight").distinct().agg(F.sum("weight")).first()[0]
    return sigma, lengths[:, 0], lengths[:, 1], sums["s"] / (weights * factors.count()), sums["q"]


def descend(
    baskets: DataFrame, factors: DataFrame, rounds: int, tolerance: float
) -> tuple[DataFrame, list[float]]:
    """Non-negative category factors, and the squared error at the start of each round.

    ``factors`` holds the singular vectors (category_en, factors, sigma;
    staged) and thereby the number of factors. The rounds end when the error
    falls by less than ``tolerance`` of its first value. As many errors as
    ``rounds`` mean that it had not converged by then; that is warned of.
    """
    cells = Cells.of_baskets(baskets)
    k = len(factors.first()["factors"])
    start = _totals(cells, factors, k)
    run = _with_sent_factors if factors.count() <= FACTOR_ROWS else _with_joined_factors
    found, errors = run(baskets, cells, factors, start, k, rounds, tolerance)
    if len(errors) == rounds:
        warnings.warn(f"NMF had not converged after {rounds} rounds", stacklevel=3)
    return found, errors


def _converged(errors: list[float], tolerance: float) -> bool:
    return len(errors) > 1 and errors[-2] - errors[-1] < tolerance * errors[0]


# --- category factors in the tasks ---------------------------------------------------


def _with_sent_factors(baskets, cells, factors, start, k, rounds, tolerance) -> tuple[DataFrame, list[float]]:
    """A round is one job over the distinct rows; a lost executor costs that round."""
    sigma, positive, negative, mean, norm = start
    known = factors.orderBy("category_en").toPandas()
    cats = known["category_en"].to_numpy()
    h = start_factors(np.vstack(known["factors"]), sigma, positive, negative, mean)
    spark = baskets.sparkSession
    rows = _numbered_rows(baskets, cats)
    errors: list[float] = []
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(h)
        sums = (
            rows.mapInPandas(_round_part(shared), "at int, value double")
            .groupBy("at")
            .agg(F.sum("value").alias("value"))
            .toPandas()
            .sort_values("at")["value"]
            .to_numpy()
        )
        shared.unpersist()
        xw, ww = sums[: h.size].reshape(h.shape), sums[h.size :].reshape(k, k)
        errors.append(float(norm - 2 * (xw * h).sum() + (ww * (h.T @ h)).sum()))
        if _converged(errors, tolerance):
            break
        h = solve(xw, ww, h)
    # Plain lists: sessions without Arrow take no numpy values.
    frame = spark.createDataFrame(list(zip(cats.tolist(), h.tolist(), strict=True)), "category_en string, factors array<double>")
    return frame, errors


def _numbered_rows(baskets: DataFrame, cats: np.ndarray) -> DataFrame:
    """Distinct rows of the matrix with their weight; categories become their place in ``cats``."""
    shared = baskets.sparkSession.sparkContext.broadcast(cats)

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = pd.Index(shared.value)
        for pdf in batches:
            sizes = pdf["cats"].map(len).to_numpy()
            flat = known.get_indexer(np.concatenate(pdf["cats"].to_numpy())) if sizes.sum() else np.zeros(0, int)
            pdf["cats"] = np.split(flat.astype(np.int32), np.cumsum(sizes)[:-1]) if len(pdf) else []
            yield pdf

    distinct = (
        baskets.where(F.size("cats") > 0)
        .select(F.sort_array(F.arrays_zip("cats", "counts")).alias("e"))
        .groupBy("e")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
        .select(F.col("e.cats").alias("cats"), F.col("e.counts").alias("counts"), "weight")
    )
    return stage(distinct.mapInPandas(number, "cats array<int>, counts array<bigint>, weight double"))


def _round_part(shared_h: Broadcast) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Per task: X'W and W'W of its solved rows, flattened."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h = shared_h.value
        hh = h.T @ h
        xw, ww = np.zeros_like(h), np.zeros_like(hh)
        for pdf in batches:
            sizes = pdf["cats"].map(len).to_numpy()
            if not len(sizes):
                continue
            cols = np.concatenate(pdf["cats"].to_numpy())
            vals = np.concatenate(pdf["counts"].to_numpy()).astype(float)
            first = np.cumsum(sizes) - sizes
            products = np.add.reduceat(vals[:, None] * h[cols], first, axis=0)
            w = solve(products, hh, np.zeros_like(products))
            weight = pdf["weight"].to_numpy()
            ww += (w * weight[:, None]).T @ w
            terms = (np.repeat(weight, sizes) * vals)[:, None] * np.repeat(w, sizes, axis=0)
            order = np.argsort(cols, kind="stable")
            heads = np.flatnonzero(np.diff(cols[order], prepend=-1))
            xw[cols[order][heads]] += np.add.reduceat(terms[order], heads, axis=0)
        flat = np.concatenate([xw.ravel(), ww.ravel()])
        yield pd.DataFrame({"at": np.arange(len(flat), dtype="int32"), "value": flat})

    return part


# --- category factors as a table -------------------------------------------------------


def _small_sum(df: DataFrame, part: Callable[[pd.DataFrame], np.ndarray], k: int) -> np.ndarray:
    """Sum of the k x k matrices that the batches of ``df`` give."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((k, k))
        for pdf in batches:
            if len(pdf):
                total += part(pdf)
        yield pd.DataFrame({"at": np.arange(k * k, dtype="int32"), "value": total.ravel()})

    sums = df.mapInPandas(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    return sums.toPandas().sort_values("at")["value"].to_numpy().reshape(k, k)


def _solved(df: DataFrame, keep: str, inner: np.ndarray, start: str | None) -> DataFrame:
    """Column ``y`` solved for ``products`` (an array), from the array ``start`` or zeros; staged."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                products = np.vstack(pdf["products"])
                begin = np.vstack(pdf[start]) if start else np.zeros_like(products)
                yield pdf[[c.split()[0] for c in keep.split(", ")]].assign(y=list(solve(products, inner, begin)))

    return stage(df.mapInPandas(run, f"{keep}, y array<double>"))


def _with_joined_factors(baskets, cells, factors, start, k, rounds, tolerance) -> tuple[DataFrame, list[float]]:
    """H and W are staged tables; a round joins the cells with each of them once."""
    sigma, positive, negative, mean, norm = start
    up = np.maximum(sigma, 0)
    lengths = factors.agg(
        *(F.sum(F.greatest(F.lit(0.0), s * F.col("factors")[j]) ** 2).alias(f"l{j}{n}") for j in range(k) for n, s in (("p", 1), ("n", -1)))
    ).first()
    columns = []
    for j in range(k):
        v = F.col("factors")[j]
        if j == 0:
            value = F.abs(v) * float(np.sqrt(up[0]))
        else:
            lp, ln = np.sqrt(lengths[f"l{j}p"] or 0.0), np.sqrt(lengths[f"l{j}n"] or 0.0)
            weigh_up, weigh_down = lp * np.sqrt(positive[j]), ln * np.sqrt(negative[j])
            sign, length, weight = (1.0, lp, weigh_up) if weigh_up > weigh_down else (-1.0, ln, weigh_down)
            value = F.greatest(F.lit(0.0), v * sign) * float(np.sqrt(up[j] * weight) / length if length > 0 else 0.0)
        columns.append(F.when(value < ZERO, mean).otherwise(value))
    h = stage(factors.select("category_en", F.array(*columns).alias("y")))
    errors: list[float] = []
    for _ in range(rounds):
        hh = _small_sum(h, lambda p: np.vstack(p["y"]).T @ np.vstack(p["y"]), k)
        named = h.select("category_en", *(F.col("y")[i].alias(f"h{i}") for i in range(k)))
        rows = (
            cells.table.join(named, "category_en").groupBy("row", "weight")
            .agg(*(F.sum(F.col("x") * F.col(f"h{i}")).alias(f"p{i}") for i in range(k)))
            .select("row", "weight", F.array(*(F.col(f"p{i}") for i in range(k))).alias("products"))
        )
        w = _solved(rows, "row bigint, weight double", hh, None)
        ww = _small_sum(w, lambda p: (np.vstack(p["y"]) * p["weight"].to_numpy()[:, None]).T @ np.vstack(p["y"]), k)
        scaled = F.col("weight") * F.col("x")
        parts = stage(
            cells.table.join(w.select("row", *(F.col("y")[i].alias(f"w{i}") for i in range(k))), "row")
            .groupBy("category_en")
            .agg(*(F.sum(scaled * F.col(f"w{i}")).alias(f"p{i}") for i in range(k)))
            .select("category_en", F.array(*(F.col(f"p{i}") for i in range(k))).alias("products"))
            .join(h.withColumnRenamed("y", "old"), "category_en")
        )
        cross = parts.agg(F.sum(F.aggregate(F.zip_with("products", "old", lambda p, y: p * y), F.lit(0.0), lambda s, x: s + x))).first()[0]
        errors.append(float(norm - 2 * cross + (ww * hh).sum()))
        if _converged(errors, tolerance):
            break
        after = _solved(parts, "category_en string", ww, "old")
        unstage(h, w, parts)
        h = after
    return h.withColumnRenamed("y", "factors"), errors
