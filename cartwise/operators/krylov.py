"""Leading singular vectors of very wide matrices, by block Lanczos steps in Spark.

No Gram matrix is built and no task or driver holds a row per category. A block
of some more vectors than wanted is multiplied with X'X by two joins of the long
table (cells with vectors, rows with their sums) and made orthogonal to all
blocks before. The driver sees only matrices of the size of the block products,
one set for each group, and decomposes the small projected matrix. With few
categories the blocks soon span the whole space, and the result is exact; else
steps go on until the residuals of all wanted vectors are negligible.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.session import stage, unstage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

EXTRA = 10  # vectors of a block beyond those wanted
TOLERANCE = 1e-12  # residual of a vector, as a share of the largest eigenvalue
MOST_COLUMNS = 600  # basis vectors before the steps begin again from the best ones
MOST_STEPS = 200


def group_name(by: Sequence[str]) -> Column:
    """The columns of a group as one text."""
    return F.concat_ws("\u0001", *(F.col(c).cast("string") for c in by)) if by else F.lit("")


@dataclass(frozen=True)
class Cells:
    """The matrices of all groups in long form: ``by``, row, category_en, x, and the weight of the row."""

    table: DataFrame
    by: tuple[str, ...] = ()

    @classmethod
    def of_baskets(cls, baskets: DataFrame, by: Sequence[str] = ()) -> Cells:
        """From ``cats`` and ``counts`` arrays; equal baskets become one weighted row."""
        rows = (
            baskets.groupBy(*by, F.sort_array(F.arrays_zip("cats", "counts")).alias("e"))
            .agg(F.count(F.lit(1)).cast("double").alias("weight"))
            .withColumn("row", F.monotonically_increasing_id())
        )
        cells = rows.select(*by, "row", "weight", F.inline("e")).select(
            *by, "row", "weight", F.col("cats").alias("category_en"), F.col("counts").cast("double").alias("x")
        )
        return cls(stage(cells.withColumn("grp", group_name(by))), tuple(by))

    def categories(self) -> DataFrame:
        return self.table.select("grp", *self.by, "category_en").distinct()

    def times(self, vectors: DataFrame, width: int) -> DataFrame:
        """X'X times the vectors v0, v1, .. of each category."""
        sums = (
            self.table.join(vectors, ["grp", "category_en"])
            .groupBy("grp", "row")
            .agg(*(F.sum(F.col("x") * F.col(f"v{i}")).alias(f"y{i}") for i in range(width)))
        )
        scaled = F.col("weight") * F.col("x")
        return (
            self.table.join(sums, ["grp", "row"])
            .groupBy("grp", "category_en")
            .agg(*(F.sum(scaled * F.col(f"y{i}")).alias(f"v{i}") for i in range(width)))
        )


@dataclass(frozen=True)
class Products:
    """The same for a table of inner products (``by``, cat_a <= cat_b, dot), where only that is known."""

    table: DataFrame
    by: tuple[str, ...] = ()

    def _both(self) -> DataFrame:
        named = self.table.withColumn("grp", group_name(self.by))
        return named.select("grp", "cat_a", "cat_b", "dot").unionByName(
            named.where("cat_a <> cat_b").select(
                "grp", F.col("cat_b").alias("cat_a"), F.col("cat_a").alias("cat_b"), "dot"
            )
        )

    def categories(self) -> DataFrame:
        named = self.table.withColumn("grp", group_name(self.by))
        return named.where("cat_a = cat_b").select("grp", *self.by, F.col("cat_a").alias("category_en"))

    def times(self, vectors: DataFrame, width: int) -> DataFrame:
        return (
            self._both()
            .join(vectors.withColumnRenamed("category_en", "cat_b"), ["grp", "cat_b"])
            .groupBy("grp", F.col("cat_a").alias("category_en"))
            .agg(*(F.sum(F.col("dot") * F.col(f"v{i}")).alias(f"v{i}") for i in range(width)))
        )


@dataclass
class _Group:
    """What the driver knows of one group: the projected matrix and the columns of the last block."""

    size: int  # categories
    projected: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    columns: int = 0  # of the basis
    last: int = 0  # of them in the last block
    done: bool = False

    def ritz(self) -> tuple[np.ndarray, np.ndarray]:
        values, vectors = np.linalg.eigh((self.projected + self.projected.T) / 2)
        return values[::-1], vectors[:, ::-1]


_TABLE = "grp string, category_en string, q array<double>, z array<double>"


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.vstack(column.to_numpy()).reshape(len(column), -1) if width else np.zeros((len(column), 0))


def _width(column: pd.Series) -> int:
    return len(column.iloc[0])


def _change(table: DataFrame, of_group: dict[str, Callable]) -> DataFrame:
    """The staged table after ``of_group[grp](q, z) -> (q, z)`` on the rows of every group."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, part in pdf.groupby("grp"):
                q, z = of_group[name](_matrix(part["q"], _width(part["q"])), _matrix(part["z"], _width(part["z"])))
                yield pd.DataFrame({"grp": name, "category_en": part["category_en"], "q": list(q), "z": list(z)})

    return stage(table.mapInPandas(run, _TABLE))


def _products(table: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Per group: q'z, and R of the QR decomposition of z (from the tasks' own R matrices)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cross: dict[str, np.ndarray] = {}
        upper: dict[str, np.ndarray] = {}
        for pdf in batches:
            for name, part in pdf.groupby("grp"):
                q, z = _matrix(part["q"], _width(part["q"])), _matrix(part["z"], _width(part["z"]))
                cross[name] = cross.get(name, 0) + q.T @ z
                upper[name] = np.linalg.qr(np.vstack([upper[name], z]) if name in upper else z, mode="r")
        for name in cross:
            yield pd.DataFrame(
                {"grp": [name], "cross": [cross[name].ravel()], "upper": [upper[name].ravel()], "width": [cross[name].shape[1]]}
            )

    parts = stage(table.mapInPandas(run, "grp string, cross array<double>, upper array<double>, width int"))
    sums = (
        parts.select("grp", F.posexplode("cross").alias("at", "value"))
        .groupBy("grp", "at").agg(F.sum("value").alias("value")).orderBy("grp", "at").toPandas()
    )
    by_group = {name: part["value"].to_numpy() for name, part in sums.groupby("grp")}
    found = {}
    for name, part in parts.select("grp", "upper", "width").toPandas().groupby("grp"):
        width = int(part["width"].iloc[0])
        if width:
            stacked = np.vstack([np.asarray(u).reshape(-1, width) for u in part["upper"]])
            found[name] = by_group.get(name, np.zeros(0)).reshape(-1, width), np.linalg.qr(stacked, mode="r")
        else:
            found[name] = np.zeros((0, 0)), np.zeros((0, 0))
    unstage(parts)
    return found


def _project(cross: np.ndarray) -> Callable:
    return lambda q, z: (q, z - q @ cross if z.shape[1] and q.shape[1] else z)


def _project_and_scale(cross: np.ndarray, scale: np.ndarray) -> Callable:
    return lambda q, z: (q, (z - q @ cross if q.shape[1] and z.shape[1] else z) @ scale)


def _append(q: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.hstack([q, z]), z


def _orthonormal(table: DataFrame, largest: dict[str, float]) -> tuple[DataFrame, dict[str, tuple[np.ndarray, np.ndarray]]]:
    """Make z orthogonal to q and orthonormal; per group, z before was q @ first + (z now) @ second.

    Directions of z that are negligible beside the largest eigenvalue go.
    """
    found = _products(table)
    first = {name: cross for name, (cross, _) in found.items()}
    once = _change(table, {name: _project(cross) for name, cross in first.items()})
    again = _products(once)
    scales, second = {}, {}
    for name, (cross, upper) in again.items():
        first[name] = first[name] + cross
        _, s, vt = np.linalg.svd(upper, full_matrices=False) if upper.size else (0, np.zeros(0), np.zeros((0, upper.shape[1])))
        kept = s > max(largest.get(name, 0.0), s.max(initial=0.0) if name not in largest else 0.0) * 1e-13
        scales[name] = vt[kept].T / s[kept]
        second[name] = s[kept][:, None] * vt[kept]
    scaled = _change(once, {name: _project_and_scale(again[name][0], scales[name]) for name in again})
    last = _products(scaled)
    ends = {}
    for name, (cross, upper) in last.items():
        ends[name] = np.linalg.inv(upper) if upper.size else upper
        second[name] = upper @ second[name] if upper.size else second[name]
    done = _change(scaled, {name: _project_and_scale(last[name][0], ends[name]) for name in last})
    unstage(once, scaled)
    return done, {name: (first[name], second[name]) for name in first}


def _start(categories: DataFrame, width: int) -> DataFrame:
    """A block of fixed pseudo-random vectors: numbers from -1 to 1 by a hash of category and place."""
    draws = (F.xxhash64("category_en", F.lit(i)) / float(2**63) for i in range(width))
    return categories.select("grp", "category_en", F.array().cast("array<double>").alias("q"), F.array(*draws).alias("z"))


def leading_factors(matrix: Cells | Products, n_components: int, tolerance: float = TOLERANCE) -> DataFrame:
    """Right singular vectors of every group's matrix: ``by``, category_en, ``factors`` and ``sigma`` (arrays).

    At most one vector less than the group has categories (at least one), the
    largest loading of each vector positive.
    """
    categories = stage(matrix.categories())
    groups = {
        r["grp"]: _Group(r["n"]) for r in categories.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    width = n_components + EXTRA
    table, links = _orthonormal(stage(_start(categories, width)), {})
    table = _advance(table, groups, links, fresh=True)
    for _ in range(MOST_STEPS):
        if all(g.done for g in groups.values()):
            break
        last = max(g.last for g in groups.values() if not g.done)
        live = [name for name, g in groups.items() if not g.done]
        vectors = table.where(F.col("grp").isin(live)).select(
            "grp", "category_en", *(F.coalesce(F.get("z", F.lit(i)), F.lit(0.0)).alias(f"v{i}") for i in range(last))
        )
        product = matrix.times(vectors, last).select(
            "grp", "category_en", F.array(*(F.col(f"v{i}") for i in range(last))).alias("product")
        )
        # A finished group keeps its basis and gets no new block; widths follow each group's last one.
        widths = F.create_map(*(F.lit(x) for name, g in groups.items() for x in (name, 0 if g.done else g.last)))
        joined = stage(
            table.join(product, ["grp", "category_en"], "left").select(
                "grp", "category_en", "q",
                F.coalesce(F.slice("product", F.lit(1), widths[F.col("grp")]), F.array().cast("array<double>")).alias("z"),
            )
        )
        largest = {name: g.ritz()[0][0] for name, g in groups.items() if g.projected.size}
        after, links = _orthonormal(joined, largest)
        unstage(table, joined)
        table = _advance(after, groups, links, fresh=False, wanted=n_components, tolerance=tolerance)
    else:
        raise RuntimeError(f"the singular vectors had not converged after {MOST_STEPS} steps")
    return _finish(matrix, table, groups, categories, n_components)


def _advance(
    table: DataFrame, groups: dict[str, _Group], links: dict, fresh: bool, wanted: int = 0, tolerance: float = 0.0
) -> DataFrame:
    """Enter the new block into the projected matrices and append it to the basis."""
    changes: dict[str, Callable] = {}
    for name, g in groups.items():
        first, second = links[name]
        new = second.shape[0]
        if fresh:
            g.columns = g.last = new
            changes[name] = _append
            continue
        changes[name] = _append
        if g.done:
            continue
        begin = g.columns - g.last
        grown = np.zeros((g.columns, g.columns))
        grown[: g.projected.shape[0], : g.projected.shape[1]] = g.projected
        grown[:, begin:] = first
        grown[begin:, :] = first.T
        g.projected = grown
        values, vectors = g.ritz()
        most = max(1, min(wanted, g.size - 1))
        residual = np.linalg.norm(second @ vectors[begin:, :most], axis=0) if new else np.zeros(most)
        if not new or (g.columns >= most and (residual <= tolerance * values[0]).all()):
            g.done, g.last = True, 0
            changes[name] = lambda q, z: (q, z[:, :0])
        elif g.columns + new > MOST_COLUMNS:
            # Begin again from the best vectors so far.
            kept = vectors[:, : wanted + EXTRA]
            changes[name] = lambda q, z, kept=kept: (q @ kept, q @ kept)
            g.projected, g.columns, g.last = np.zeros((0, 0)), kept.shape[1], kept.shape[1]
        else:
            wider = np.zeros((g.columns + new, g.columns + new))
            wider[: g.columns, : g.columns] = g.projected
            wider[g.columns :, begin : g.columns] = second
            wider[begin : g.columns, g.columns :] = second.T
            g.projected, g.columns, g.last = wider, g.columns + new, new
    return _change(table, changes)


def _finish(
    matrix: Cells | Products, table: DataFrame, groups: dict[str, _Group], categories: DataFrame, n_components: int
) -> DataFrame:
    turns, sigma = {}, {}
    for name, g in groups.items():
        values, vectors = g.ritz()
        most = max(1, min(n_components, g.size - 1))
        turns[name] = lambda q, z, y=vectors[:, :most]: (q @ y, z)
        sigma[name] = np.sqrt(np.maximum(values[:most], 0)).tolist()
    found = _change(table, turns).select("grp", "category_en", F.col("q").alias("factors"))
    peaks = (
        found.select("grp", "category_en", F.posexplode("factors").alias("at", "v"))
        .groupBy("grp", "at")
        .agg(F.min(F.struct(-F.abs("v"), "category_en", "v"))["v"].alias("peak"))
        .groupBy("grp")
        .agg(F.sort_array(F.collect_list(F.struct("at", F.when(F.col("peak") < 0, -1.0).otherwise(1.0).alias("sign"))))["sign"].alias("signs"))
    )
    spark = table.sparkSession
    scales = spark.createDataFrame(list(sigma.items()), "grp string, sigma array<double>")
    return (
        found.join(F.broadcast(scales), "grp").join(F.broadcast(peaks), "grp")  # a row for each group
        .join(categories, ["grp", "category_en"])
        .select(*matrix.by, "category_en", F.zip_with("factors", "signs", lambda v, s: v * s).alias("factors"), "sigma")
    )
