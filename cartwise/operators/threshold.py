"""Rankings from a table of similar category pairs that is small enough to send to the tasks.

With few categories the pairs are a square matrix and a batch of baskets is
multiplied with it. With many, every category has a list of its partners sorted
by weight, and the threshold algorithm reads the lists of a basket side by side
with the popularity list: the categories met so far are scored exactly, and a
unit is done as soon as the weights reached in all lists prove that no unseen
category can enter its k best.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Accumulator, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.operators.latent import (
    BEST_TYPE,
    GRID,
    NONE,
    UNLISTED,
    Best,
    listed,
    owned_of,
    packed,
    rows_by_group,
    slices,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SENT_BYTES = 64 << 20  # of pairs that are sent to the tasks
SQUARE = 2048  # categories up to which the pairs become a square matrix
FIRST_DEPTH = 16  # places read of each list at first; then four times as many, and so on
_CELLS = 1 << 20  # scores or lookups done at once


@dataclass
class _Lists:
    """Partners of all categories for one weight: list by list, heaviest first, and by (category, partner)."""

    start: np.ndarray
    partner: np.ndarray
    weight: np.ndarray
    keys: np.ndarray
    by_key: np.ndarray

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray, weight: np.ndarray, n: int) -> _Lists:
        on = weight != 0
        a, b, weight = a[on], b[on], weight[on]
        order = np.lexsort((b, -weight, a))
        key = a * n + b
        sort = np.argsort(key)
        return cls(np.searchsorted(a[order], np.arange(n + 1)), b[order], weight[order], key[sort], weight[sort])

    def lookup(self, key: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(key))
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.by_key[at], 0.0)


@dataclass
class _Group:
    """Categories of one group by name, and their pairs."""

    names: np.ndarray
    rank: np.ndarray  # 0 where the category is not in the popularity list
    pop: np.ndarray
    by_rank: np.ndarray
    pairs: dict[str, np.ndarray | _Lists]

    @classmethod
    def of(cls, popular: pd.DataFrame, links: pd.DataFrame | None, weights: Sequence[str]) -> _Group:
        names = set(popular["category_en"])
        if links is not None:
            names |= set(links["cat_a"]) | set(links["cat_b"])
        names = np.array(sorted(names), object)
        n, place = len(names), {name: i for i, name in enumerate(names)}
        rank, pop = np.zeros(n, np.int64), np.zeros(n)
        at = popular["category_en"].map(place).to_numpy(np.int64)
        rank[at], pop[at] = popular["rank"].to_numpy(), popular["pop_score"].to_numpy(float)
        on = np.flatnonzero(rank)
        pairs: dict[str, np.ndarray | _Lists] = {}
        for w in weights:
            a = links["cat_a"].map(place).to_numpy(np.int64) if links is not None else np.zeros(0, np.int64)
            b = links["cat_b"].map(place).to_numpy(np.int64) if links is not None else a
            value = links[w].to_numpy(float) if links is not None else np.zeros(0)
            if n <= SQUARE:
                pairs[w] = np.zeros((n, n))
                pairs[w][a, b] = value
            else:
                pairs[w] = _Lists.of(a, b, value, n)
        return cls(names, rank, pop, on[np.argsort(rank[on])], pairs)


def _score(group: _Group, variant, columns: np.ndarray, affinity: np.ndarray, peak: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score and key of the categories ``columns`` (by the rules of ``recommend.rank_units``)."""
    if variant.weight is None:
        score = affinity
    elif variant.keep_all:
        return affinity, np.floor(affinity * GRID + 0.5).astype(np.int64)
    else:
        share = np.where(peak > 0, affinity / np.where(peak > 0, peak, 1), affinity)
        score = variant.alpha * share + (1 - variant.alpha) * group.pop[columns]
    if variant.keep_all:
        return score, np.floor(score * GRID + 0.5).astype(np.int64)
    return score, np.where(score > 0, np.floor(score * GRID + 0.5).astype(np.int64), UNLISTED - group.rank[columns])


def _rank_square(group: _Group, owned: list[np.ndarray], variants: Sequence, k: int) -> tuple[list[Best], int]:
    """All listed categories of all units, by one product for each weight."""
    best, n, seen = [Best.empty(len(owned), k) for _ in variants], len(group.names), 0
    columns = group.by_rank[np.argsort(group.by_rank)]
    step = max(1, _CELLS // max(1, n))
    for at in range(0, len(owned), step):
        part = owned[at : at + step]
        rows = np.arange(at, at + len(part))
        basket = np.zeros((len(part), n))
        basket[np.repeat(np.arange(len(part)), [len(o) for o in part]), np.concatenate(part)] = 1
        for weight in {v.weight for v in variants}:
            affinity = basket @ group.pairs[weight][:, columns] if weight else np.zeros((len(part), len(columns)))
            peak = affinity.max(1, initial=-np.inf)[:, None]
            for i, v in enumerate(variants):
                if v.weight == weight and len(columns):
                    score, key = _score(group, v, columns, affinity, peak)
                    key = np.where(basket[:, columns] > 0, NONE, key)
                    best[i].merge(rows, key, group.names[columns], affinity, score)
                    seen += affinity.size
    return best, seen


def _spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, .. (count[i] numbers) for every i."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _rank_lists(group: _Group, owned: list[np.ndarray], variants: Sequence, k: int) -> tuple[list[Best], int]:
    """The threshold algorithm for all units side by side; also how many (unit, category) pairs were scored."""
    best, seen = [Best.empty(len(owned), k) for _ in variants], 0
    size, n = np.array([len(o) for o in owned], np.int64), len(group.names)
    begin = np.cumsum(size) - size
    flat = np.concatenate(owned) if owned else np.zeros(0, np.int64)
    for weight in {v.weight for v in variants}:
        lists = group.pairs[weight] if weight else _Lists.of(*[np.zeros(0, np.int64)] * 2, np.zeros(0), n)
        users = [(i, v) for i, v in enumerate(variants) if v.weight == weight]
        open_ = np.arange(len(owned))
        depth = FIRST_DEPTH
        while len(open_):
            most = len(group.by_rank)
            popular = np.minimum(size[open_] + k + depth, most)
            own_row = np.repeat(np.arange(len(open_)), size[open_])
            own = flat[_spread(begin[open_], size[open_])]
            length = lists.start[own + 1] - lists.start[own]
            reached = np.minimum(length, depth)
            # Met so far: the heads of the basket's lists, its own categories, the head of the popularity list.
            rows = np.concatenate([np.repeat(own_row, reached), own_row, np.repeat(np.arange(len(open_)), popular)])
            cols = np.concatenate(
                [lists.partner[_spread(lists.start[own], reached)], own, group.by_rank[_spread(np.zeros(len(open_), np.int64), popular)]]
            )
            pair = np.unique(rows * n + cols)
            pair = pair[group.rank[pair % n] > 0]
            row, col = pair // n, pair % n
            affinity = _affinity(lists, row, col, size[open_], begin[open_], flat, n)
            seen += len(pair)
            # What an unseen category can have at most.
            unread = length > reached
            rest = np.zeros(len(open_))
            np.add.at(rest, own_row[unread], lists.weight[lists.start[own[unread]] + reached[unread]])
            peak = np.full(len(open_), -np.inf)
            np.maximum.at(peak, row, affinity)
            mine = np.zeros(len(pair), bool)
            mine[np.searchsorted(pair, np.intersect1d(pair, own_row * n + own))] = True
            done = (peak >= rest) | (rest == 0)
            below = np.where(popular < most, group.pop[group.by_rank[np.minimum(popular, most - 1)]], 0.0) if most else np.zeros(len(open_))
            found = []
            for i, v in users:
                score, key = _score(group, v, col, affinity, peak[row])
                order = np.flatnonzero(~mine)
                order = order[np.lexsort((col[order], -key[order], row[order]))]
                place = np.arange(len(order)) - np.searchsorted(row[order], row[order])
                order, place = order[place < k], place[place < k]
                one = Best.empty(len(open_), k)
                for target, values in ((one.key, key), (one.name, group.names[col]), (one.affinity, affinity), (one.score, score)):
                    target[row[order], place] = values[order]
                if v.weight is None:
                    bound = np.zeros(len(open_))
                else:
                    bound = v.alpha * rest / np.where(peak > 0, peak, 1) + (1 - v.alpha) * below
                unseen = np.where(bound > 0, np.floor(bound * GRID + 1.5).astype(np.int64), UNLISTED - popular - 1)
                done &= one.key[:, -1] > unseen
                found.append((i, one))
            done |= (popular >= most) & (rest == 0)
            for i, one in found:
                best[i].put(open_[done], one.of(np.flatnonzero(done)))
            open_, depth = open_[~done], depth * 4
    return best, seen


def _affinity(lists: _Lists, row: np.ndarray, col: np.ndarray, size: np.ndarray, begin: np.ndarray, flat: np.ndarray, n: int) -> np.ndarray:
    """Sum of the weights between each pair's category and all of its unit's basket."""
    out = np.zeros(len(row))
    ends = np.cumsum(size[row])
    for a, b in zip(*_cuts(ends)):
        count = size[row[a:b]]
        own = flat[_spread(begin[row[a:b]], count)]
        value = lists.lookup(own * n + np.repeat(col[a:b], count))
        out[a:b] = np.bincount(np.repeat(np.arange(b - a), count), value, b - a)
    return out


def _cuts(ends: np.ndarray) -> tuple[list[int], list[int]]:
    """Ranges of pairs with about _CELLS lookups each."""
    edges = [0, *(np.flatnonzero(np.diff(ends // _CELLS)) + 1).tolist(), len(ends)]
    return edges[:-1], edges[1:]


def fits(similarity: DataFrame | None, popular: DataFrame, variants: Sequence, weights: Sequence[str], by: Sequence[str]) -> bool:
    """Whether the pairs may be sent to the tasks and the kernels above can rank with them."""
    widest, rows = popular.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    if similarity is None or not weights:
        return (rows or 0) * 100 <= SENT_BYTES
    least = F.least(F.lit(0.0), *(F.col(w).cast("double") for w in weights))
    stats = similarity.agg(
        F.count(F.lit(1)).alias("rows"), F.min(least).alias("least"),
        F.sum(F.length("cat_a") + F.length("cat_b") + F.lit(16 + 24 * len(weights))).alias("size"),
    ).first()
    size, groups = (stats["size"] or 0) + (rows or 0) * 100, -(-(rows or 0) // max(1, widest or 1))
    if (widest or 0) <= SQUARE:
        return size + groups * (widest or 0) ** 2 * 8 * len(weights) <= SENT_BYTES
    plain = all(not v.keep_all and 0 <= v.alpha <= 1 for v in variants)
    return plain and (stats["least"] or 0.0) >= 0 and size <= SENT_BYTES


def rank_by_pairs(
    units: DataFrame, similarity: DataFrame | None, popular: DataFrame, variants: Sequence, k: int,
    by: Sequence[str] = (), carry: Sequence[str] = (), scored: Accumulator | None = None,
) -> DataFrame:
    """The k best categories per unit and variant, as ``recommend.rank_units`` returns them, without a shuffle.

    Only where ``fits`` says so. ``scored`` counts the (unit, category) pairs
    whose score was computed.
    """
    by, carry = list(by), list(carry)
    weights = sorted({v.weight for v in variants if v.weight})
    keys = [*by, "category_en"]
    tops = popular.select(*keys, "rank", "pop_score").toPandas()
    links = similarity.select(*by, "cat_a", "cat_b", *weights).toPandas() if similarity is not None and weights else None

    def grouped(pdf: pd.DataFrame) -> dict[tuple, pd.DataFrame]:
        if not by:
            return {(): pdf}
        return {g if isinstance(g, tuple) else (g,): p for g, p in pdf.groupby([pdf[c].astype(str) for c in by])}

    link_groups = grouped(links) if links is not None else {}
    none = links.iloc[:0] if links is not None else None
    shared = units.sparkSession.sparkContext.broadcast(
        {g: _Group.of(p, link_groups.get(g, none), weights) for g, p in grouped(tops).items() if len(p)}
    )
    kept = [*by, "unit_id", *carry]
    types = dict(units.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = shared.value
        for batch in slices(batches):
            best = [Best.empty(len(batch), k) for _ in variants]
            for key, numbers in rows_by_group(batch, by).items():
                group = groups.get(key)
                if group is None:
                    continue
                owned = owned_of(batch["cats"], group.names, numbers)
                rank = _rank_square if len(group.names) <= SQUARE else _rank_lists
                found, seen = rank(group, owned, variants, k)
                if scored is not None:
                    scored.add(seen)
                for b, mine in zip(best, found, strict=True):
                    b.put(np.array(numbers), mine)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), packed(best)], [*kept, "best"])

    schema = ", ".join(f"{c} {types[c]}" for c in kept) + f", {BEST_TYPE}"
    return listed(units.select(*kept, "cats").mapInArrow(run, schema), kept, variants)


def popular_places(units: DataFrame, popular: DataFrame, by: Sequence[str] = ()) -> DataFrame | None:
    """by, customers and the ``place`` of each unit's hidden category ``test`` in the popularity list without its ``cats``.

    The list goes to the tasks as ranks by group and category and no unit is
    shuffled. None if groups times categories is too large for that.
    """
    by = list(by)
    tops = popular.select(*by, "category_en", "rank").toPandas()
    names = np.array(sorted(set(tops["category_en"])), object)
    keys = list(zip(*(tops[c].astype(str) for c in by))) if by else [()] * len(tops)
    number = {key: i for i, key in enumerate(dict.fromkeys(keys))}
    if len(number) * len(names) * 4 > SENT_BYTES:
        return None
    ranks = np.zeros((len(number) + 1, len(names) + 1), np.int32)  # the last row and column: not in the list
    ranks[[number[key] for key in keys], np.searchsorted(names, tops["category_en"].to_numpy(object))] = tops["rank"]
    shared = units.sparkSession.sparkContext.broadcast((names, number, ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, number, ranks = shared.value
        known = pa.array(names, pa.string())

        def codes(values: pa.Array) -> np.ndarray:
            return pc.index_in(values, value_set=known).fill_null(len(names)).to_numpy()

        for batch in batches:
            group = np.full(len(batch), len(number))
            for key, rows in rows_by_group(batch, by).items():
                group[rows] = number.get(key, len(number))
            at = ranks[group, codes(batch["test"])]
            row = pc.list_parent_indices(batch["cats"]).to_numpy()
            rank = ranks[group[row], codes(batch["cats"].flatten())]
            above = np.bincount(row[(rank > 0) & (rank < at[row])], minlength=len(batch))
            place = pa.array((at - above).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in by), batch["customers"], place], [*by, "customers", "place"]
            ).filter(pa.array(at > 0))

    types = dict(units.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in [*by, "customers"]) + ", place int"
    return units.select(*by, "customers", "cats", "test").mapInArrow(run, schema)
