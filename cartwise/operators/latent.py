"""Rankings by cosine of category factors, without a table of category pairs.

The similarity of a category to a basket is the inner product of its unit
factor vector with the sum of the basket's unit vectors. Units go through the
tasks in batches; category vectors come to them in chunks of bounded size, one
chunk after the other, and every unit keeps its k best so far. Inside a chunk
categories lie in blocks of near vectors: a block whose centre and radius
(times the length of the basket's vector) cannot reach a unit's k-th score is
not multiplied for it.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.session import stage, unstage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 64 << 20  # of category vectors that are sent to the tasks at once
BLOCK = 512  # categories that are multiplied at once
UNLISTED = -(1 << 60)  # key of a category without score, less its popularity rank
NONE = np.iinfo(np.int64).min
NEGLIGIBLE = 1e-9  # a shorter factor row is what rounding leaves of zeros
GRID = 1e10  # scores are compared on this grid, as in score_key
_CELLS = 1 << 20  # scores computed at once
UNITS = 2_048  # units ranked at once


@dataclass(frozen=True)
class Latent:
    """Category factors as weights of a ranking.

    ``frame`` has the group columns, category_en and ``factors``; a weight is
    the cosine of as many leading factors as ``weights`` says (fewer, if a
    group has fewer).
    """

    frame: DataFrame
    weights: dict[str, int]


def _unit(size: int):
    """The leading factors scaled to length one and padded with zeros; a negligible row is zeros."""
    leading = F.slice("factors", 1, size)
    length = F.sqrt(F.aggregate(leading, F.lit(0.0), lambda s, x: s + x * x))
    scaled = F.transform(leading, lambda x: F.when(length > NEGLIGIBLE, x / length).otherwise(0.0))
    return F.concat(scaled, F.array_repeat(F.lit(0.0), F.lit(size) - F.size(scaled)))


def category_vectors(latents: Sequence[Latent], popular: DataFrame, by: Sequence[str]) -> tuple[DataFrame, dict[str, slice]]:
    """by, category_en, pop_rank, pop_score, ``v`` (the unit vectors of all weights), and where each weight lies in v.

    A category without factors has zeros; one outside the popularity list has
    no rank, counts in baskets and is never recommended.
    """
    keys = [*by, "category_en"]
    table = popular.select(*keys, F.col("rank").alias("pop_rank"), "pop_score")
    places, start, columns = {}, 0, []
    for i, latent in enumerate(latents):
        widths = list(latent.weights.items())
        vectors = F.concat(*(_unit(size) for _, size in widths))
        table = table.join(latent.frame.select(*keys, vectors.alias(f"v{i}")), keys, "full")
        total = sum(size for _, size in widths)
        columns.append(F.coalesce(F.col(f"v{i}"), F.array_repeat(F.lit(0.0), total)))
        for name, size in widths:
            places[name] = slice(start, start + size)
            start += size
    return table.select(*keys, "pop_rank", "pop_score", F.concat(*columns).alias("v")), places


# --- one chunk of categories in a task ---------------------------------------------


@dataclass
class _Chunk:
    """Categories of one group: names ascending, in blocks of near vectors."""

    names: np.ndarray
    rank: np.ndarray  # 0 where the category is not in the popularity list
    pop: np.ndarray
    vectors: np.ndarray
    blocks: list[np.ndarray]

    @classmethod
    def of(cls, pdf: pd.DataFrame) -> _Chunk:
        pdf = pdf.sort_values("category_en")
        vectors = np.vstack(pdf["v"].to_numpy())
        listed = pdf["pop_rank"].notna().to_numpy()
        blocks = list(_near_blocks(vectors, np.flatnonzero(listed)))
        rank, pop = pdf["pop_rank"].fillna(0).to_numpy(np.int64), pdf["pop_score"].fillna(0).to_numpy(float)
        return cls(pdf["category_en"].to_numpy(object), rank, pop, vectors, blocks)


def _near_blocks(vectors: np.ndarray, places: np.ndarray) -> Iterator[np.ndarray]:
    """At most BLOCK places each: halves at the median of the coordinate that varies most."""
    todo = [places]
    while todo:
        part = todo.pop()
        if len(part) <= BLOCK:
            if len(part):
                yield np.sort(part)
            continue
        axis = vectors[part].var(0).argmax()
        order = np.argsort(vectors[part, axis], kind="stable")
        todo += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]


@dataclass
class Best:
    """The k best of each unit so far: keys (larger is better), names, affinities and scores."""

    key: np.ndarray
    name: np.ndarray
    affinity: np.ndarray
    score: np.ndarray

    @classmethod
    def empty(cls, units: int, k: int) -> Best:
        return cls(
            np.full((units, k), NONE), np.full((units, k), "", object), np.zeros((units, k)), np.zeros((units, k))
        )

    def of(self, rows: np.ndarray) -> Best:
        return Best(self.key[rows], self.name[rows], self.affinity[rows], self.score[rows])

    def put(self, rows: np.ndarray, other: Best) -> None:
        self.key[rows], self.name[rows] = other.key, other.name
        self.affinity[rows], self.score[rows] = other.affinity, other.score

    def merge(self, rows: np.ndarray, key: np.ndarray, names: np.ndarray, affinity: np.ndarray, score: np.ndarray) -> None:
        """Take in candidates (a column each) of the units ``rows``; equal keys rank by name."""
        k = self.key.shape[1]
        every = np.hstack([self.key[rows], key])
        least = np.partition(every, every.shape[1] - k, axis=1)[:, every.shape[1] - k]
        row, col = np.nonzero((every >= least[:, None]) & (every > NONE))
        old = col < k
        new = np.maximum(col - k, 0)
        source = rows[row]
        name = np.where(old, self.name[source, np.minimum(col, k - 1)], names[new])
        order = np.lexsort((pd.factorize(name, sort=True)[0], -every[row, col], row))
        place = np.arange(len(order)) - np.searchsorted(row[order], row[order])
        order, place = order[place < k], place[place < k]
        took = [
            (self.key, every[row, col]),
            (self.name, name),
            (self.affinity, np.where(old, self.affinity[source, np.minimum(col, k - 1)], affinity[row, new])),
            (self.score, np.where(old, self.score[source, np.minimum(col, k - 1)], score[row, new])),
        ]
        self.key[rows] = NONE
        for target, values in took:
            target[source[order], place] = values[order]


def _peaks(chunk: _Chunk, wanted: np.ndarray, place: slice) -> np.ndarray:
    """Largest inner product of each unit with a listed category (minus infinity if there is none)."""
    peak = np.full(len(wanted), -np.inf)
    for block in chunk.blocks:
        for at in range(0, len(wanted), max(1, _CELLS // len(block))):
            part = slice(at, at + max(1, _CELLS // len(block)))
            peak[part] = np.maximum(peak[part], (wanted[part, place] @ chunk.vectors[block, place].T).max(1))
    return peak


def _rank(
    chunk: _Chunk, wanted: np.ndarray, peaks: dict[str, np.ndarray], owned: list[np.ndarray], variants: Sequence, places: dict, best: list[Best]
) -> int:
    """Merge the chunk's categories into ``best``; returns how many scores were computed."""
    seen = 0
    row_of = np.repeat(np.arange(len(owned)), [len(o) for o in owned])
    own = np.concatenate(owned) if owned else np.zeros(0, np.int64)
    for weight, place in places.items():
        users = [(i, v) for i, v in enumerate(variants) if v.weight == weight]
        if not users:
            continue
        length = np.linalg.norm(wanted[:, place], axis=1)
        bounds = []
        for block in chunk.blocks:
            centre = chunk.vectors[block, place].mean(0)
            radius = np.linalg.norm(chunk.vectors[block, place] - centre, axis=1).max()
            bounds.append(wanted[:, place] @ centre + radius * length)
        for b in np.argsort([-x.max(initial=0) for x in bounds]):
            block, bound = chunk.blocks[b], bounds[b]
            reach = np.zeros(len(wanted), bool)
            for i, v in users:
                if not v.keep_all:
                    share = np.where(peaks[weight] > 0, bound / np.where(peaks[weight] > 0, peaks[weight], 1), bound)
                    top = v.alpha * share + (1 - v.alpha) * chunk.pop[block].max()
                    prunable = 0 <= v.alpha <= 1
                else:
                    top, prunable = bound, True
                # A k-th key of an unlisted category is below every score.
                reach |= (top + 1e-6) * GRID >= best[i].key[:, -1] if prunable else True
            rows = np.flatnonzero(reach)
            for at in range(0, len(rows), max(1, _CELLS // len(block))):
                part = rows[at : at + max(1, _CELLS // len(block))]
                affinity = wanted[part, place] @ chunk.vectors[block, place].T
                seen += affinity.size
                mask = np.zeros(affinity.shape, bool)
                slot = np.full(len(wanted), -1)
                slot[part] = np.arange(len(part))
                column = np.full(len(chunk.names), -1)
                column[block] = np.arange(len(block))
                hit = (slot[row_of] >= 0) & (column[own] >= 0)
                mask[slot[row_of[hit]], column[own[hit]]] = True
                for i, v in users:
                    if v.keep_all:
                        score, key = affinity, np.floor(affinity * GRID + 0.5).astype(np.int64)
                    else:
                        peak = peaks[weight][part, None]
                        share = np.where(peak > 0, affinity / np.where(peak > 0, peak, 1), affinity)
                        score = v.alpha * share + (1 - v.alpha) * chunk.pop[block]
                        key = np.where(score > 0, np.floor(score * GRID + 0.5).astype(np.int64), UNLISTED - chunk.rank[block])
                    best[i].merge(part, np.where(mask, NONE, key), chunk.names[block], affinity, score)
    return seen


# --- units ---------------------------------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * width, pa.array(matrix.ravel()))


_BEST = pa.struct([("category", pa.string()), ("key", pa.int64()), ("affinity", pa.float64()), ("score", pa.float64())])


BEST_TYPE = "best array<array<struct<category: string, key: bigint, affinity: double, score: double>>>"


def rows_by_group(batch: pa.RecordBatch, by: Sequence[str]) -> dict[tuple, list[int]]:
    """Row numbers of each group of a batch; a group's key holds its values as texts."""
    keys = list(zip(*([str(x) for x in batch[c].to_pylist()] for c in by))) if by else [()] * len(batch)
    rows: dict[tuple, list[int]] = {}
    for i, key in enumerate(keys):
        rows.setdefault(key, []).append(i)
    return rows


def owned_of(cats: pa.ListArray, names: np.ndarray, rows: Sequence[int]) -> list[np.ndarray]:
    """Where the categories of the baskets ``rows`` stand in ``names``; others are left out."""
    mine = cats.take(pa.array(rows, pa.int64()))
    place = pc.index_in(mine.flatten(), value_set=pa.array(names, pa.string())).fill_null(-1).to_numpy().astype(np.int64)
    row = pc.list_parent_indices(mine).to_numpy()[place >= 0]
    return np.split(place[place >= 0], np.searchsorted(row, np.arange(1, len(mine))))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of at most ``UNITS`` rows: what a task holds does not grow with the batches it is given."""
    for batch in batches:
        for at in range(0, len(batch), UNITS):
            yield batch.slice(at, UNITS)


def packed(best: list[Best]) -> pa.ListArray:
    """Per unit a list of variants, each a list of its best."""
    n, k = best[0].key.shape
    parts = [np.stack([getattr(b, f) for b in best], 1).ravel() for f in ("name", "key", "affinity", "score")]
    flat = pa.StructArray.from_arrays([pa.array(p, t.type) for p, t in zip(parts, _BEST)], fields=list(_BEST))
    inner = pa.ListArray.from_arrays(np.arange(n * len(best) + 1, dtype=np.int32) * k, flat)
    return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * len(best), inner)


def _unpacked(column: pa.ListArray, variants: int, k: int) -> list[Best]:
    flat = column.flatten().flatten()
    fields = [flat.field(i).to_numpy(zero_copy_only=False).reshape(-1, variants, k) for i in range(4)]
    return [Best(fields[1][:, i].copy(), fields[0][:, i].astype(object), fields[2][:, i].copy(), fields[3][:, i].copy()) for i in range(variants)]


def rank_by_factors(
    units: DataFrame, latents: Sequence[Latent], popular: DataFrame, variants: Sequence, k: int,
    by: Sequence[str] = (), carry: Sequence[str] = (),
) -> DataFrame:
    """The k best categories per unit and variant, with the columns and rules of ``recommend.rank_units``.

    Every category of the popularity list is a candidate. One chunk of
    categories takes one pass without a shuffle; with more chunks, baskets are
    summed over all of them first, and the state of the units (a vector and k
    categories per variant) is staged between them.
    """
    by, carry = list(by), list(carry)
    table, places = category_vectors(latents, popular, by)
    table = stage(table)
    width = max((p.stop for p in places.values()), default=0)
    chunks = max(1, -(-table.count() * (8 * width + 64) // CHUNK_BYTES))
    scaled = [w for w in places if any(v.weight == w and not v.keep_all for v in variants)]
    spark = units.sparkSession

    def send(number: int):
        part = table.where(F.pmod(F.xxhash64("category_en"), F.lit(chunks)) == number) if chunks > 1 else table
        pdf = part.toPandas()
        groups = pdf.groupby([pdf[c].astype(str) for c in by]) if by else [((), pdf)]
        return spark.sparkContext.broadcast(
            {tuple(g) if isinstance(g, tuple) else (g,): _Chunk.of(p) for g, p in groups} if len(pdf) else {}
        )

    kept = [*by, "unit_id", *carry, "cats"]
    types = dict(units.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in kept) + f", wanted array<double>, peaks array<double>, {BEST_TYPE}"
    state = units.select(kept)

    def visit(shared, steps: Sequence[str]) -> Callable:
        """A pass over the units with one chunk: add to the baskets' vectors, raise the peaks, merge the best."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            chunk_of = shared.value
            for batch in slices(batches):
                n = len(batch)
                known = "wanted" in batch.schema.names
                wanted = _matrix(batch["wanted"]) if known and width else np.zeros((n, width))
                wanted = wanted.copy()
                peaks = _matrix(batch["peaks"]).copy() if known and scaled else np.full((n, len(scaled)), -np.inf)
                best = _unpacked(batch["best"], len(variants), k) if known else [Best.empty(n, k) for _ in variants]
                for key, numbers in rows_by_group(batch, by).items():
                    chunk, rows = chunk_of.get(key), np.array(numbers)
                    if chunk is None:
                        continue
                    owned = owned_of(batch["cats"], chunk.names, numbers)
                    if "sums" in steps:
                        row = np.repeat(rows, [len(o) for o in owned])
                        np.add.at(wanted, row, chunk.vectors[np.concatenate(owned)])
                    if "peaks" in steps:
                        for j, w in enumerate(scaled):
                            peaks[rows, j] = np.maximum(peaks[rows, j], _peaks(chunk, wanted[rows], places[w]))
                    if "best" in steps:
                        own_best = [b.of(rows) for b in best]
                        _rank(chunk, wanted[rows], {w: peaks[rows, j] for j, w in enumerate(scaled)}, owned, variants, places, own_best)
                        for b, mine in zip(best, own_best, strict=True):
                            b.put(rows, mine)
                yield pa.RecordBatch.from_arrays(
                    [*(batch[c] for c in kept), _lists(wanted), _lists(peaks), packed(best)], [*kept, "wanted", "peaks", "best"]
                )

        return run

    passes = [("sums", "peaks", "best")] if chunks == 1 else [("sums",), *([("peaks",)] if scaled else []), ("best",)]
    for steps in passes:
        for number in range(chunks):
            shared = send(number)
            changed = state.mapInArrow(visit(shared, steps), schema)
            if chunks > 1:
                after = stage(changed)
                if hasattr(state, "_staged_path"):
                    unstage(state)
                shared.unpersist()
                changed = after
            state = changed
    return listed(state, [*by, "unit_id", *carry], variants)


def listed(state: DataFrame, keep: Sequence[str], variants: Sequence) -> DataFrame:
    """A row per unit, variant and place, from the arrays of ``best``."""
    names = F.array(*(F.lit(v.name) for v in variants))
    return (
        state.select(*keep, F.posexplode("best").alias("at", "found"))
        .select(*keep, F.get(names, F.col("at")).alias("variant"), F.posexplode("found").alias("place", "b"))
        .where(F.col("b.key") > NONE)
        .select(
            *keep, "variant", F.col("b.category").alias("category"), (F.col("place") + 1).alias("rank"),
            F.col("b.affinity").alias("affinity"), F.col("b.score").alias("score"),
        )
    )
