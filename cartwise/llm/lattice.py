"""Embedding near-duplicates by lattice hashing (operator 6).

Unit vectors are projected at random to eight-dimensional blocks, and each
block is decoded to its nearest point of the E8 lattice; the points of all
blocks of a table are the cell. A vector is stored in its own cell and also
looked up in the neighbouring cells that lie nearest to it. Vectors that meet
in any of several tables are compared by cosine in double precision.
"""

from __future__ import annotations

import itertools
import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.components import connected_components
from cartwise.session import in_slice, stage, unstage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TABLES = 6
BLOCKS = 1
PROBES = 24
SCALE = 1.0  # how far a unit step spreads a projection, in lattice units
COSINE = 0.9
MEMBERS = 1024  # vectors of one cell that are compared in one block
# Rows with a vector that move to their blocks at once: so many, or so many times the number of vectors.
MOVED_ROWS = 1 << 18
MOVED_SHARE = 1
SEED = 20240611
# A 64-bit sketch of projection signs. A pair at the threshold differs in 9 of 64
# bits on average with deviation 2.8; pairs beyond this many are not compared.
SKETCH_BITS = 22


def _decode_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates of even sum."""
    near = np.round(x)
    odd = np.flatnonzero(near.sum(1) % 2 != 0)
    if len(odd):
        error = x[odd] - near[odd]
        worst = np.abs(error).argmax(1)
        step = np.where(error[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
        near[odd, worst] += step
    return near


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 lattice points of the rows of ``x`` (n x 8): D8, or D8 moved by one half."""
    a, b = _decode_d8(x), _decode_d8(x - 0.5) + 0.5
    first = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
    return np.where(first[:, None], a, b)


def shortest_vectors() -> np.ndarray:
    """The 240 lattice points next to the origin."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    for signs in itertools.product((0.5, -0.5), repeat=8):
        if sum(s < 0 for s in signs) % 2 == 0:
            out.append(np.array(signs))
    return np.array(out)


def projection(dim: int, table: int, blocks: int) -> np.ndarray:
    return np.random.default_rng([SEED, table, dim]).standard_normal((dim, 8 * blocks)) * SCALE


def _odd(width: int) -> np.ndarray:
    return np.random.default_rng([SEED, 7]).integers(1 << 62, size=width, dtype=np.uint64) | np.uint64(1)


def _sums(points: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """Weighted sums, modulo 2^64, of lattice points (n x 8 blocks); the sum of a moved point is the sum of both."""
    return (np.round(points * 2).astype(np.int64).astype(np.uint64) * odd).sum(1, dtype=np.uint64)


def _cell_keys(sums: np.ndarray, table: int) -> np.ndarray:
    """64-bit keys from the sums of lattice points."""
    key = sums ^ np.uint64((table + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    key ^= key >> np.uint64(29)
    return (key * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def cells(unit: np.ndarray, table: int, blocks: int = BLOCKS, probes: int = PROBES) -> np.ndarray:
    """Keys of the own cell (column 0) and of the ``probes`` nearest neighbouring cells of unit vectors."""
    # Sums in one order whatever the number of rows: a block works the same keys out again.
    y = np.einsum("ij,jk->ik", unit, projection(unit.shape[1], table, blocks), optimize=False)
    parts = y.reshape(-1, 8)
    points = decode_e8(parts)
    around = shortest_vectors()
    gain = ((parts - points) @ around.T).reshape(len(unit), -1)  # larger: nearer
    own = points.reshape(len(unit), -1)
    probes = min(probes, gain.shape[1])
    best = np.argpartition(-gain, probes - 1, axis=1)[:, :probes] if probes else np.zeros((len(unit), 0), np.int64)
    odd = _odd(8 * blocks)
    steps = np.concatenate([_sums(around, odd[8 * k : 8 * k + 8]) for k in range(blocks)])
    sums = _sums(own, odd)[:, None]
    return _cell_keys(np.concatenate([sums, sums + steps[best]], 1), table)


def sketches(unit: np.ndarray) -> np.ndarray:
    """Signs of 64 random projections as one signed 64-bit number."""
    planes = np.random.default_rng([SEED, 9, unit.shape[1]]).standard_normal((unit.shape[1], 64))
    return np.packbits(unit @ planes > 0, axis=1).view(np.int64).ravel()


def _units(embeddings: pd.Series) -> np.ndarray:
    """Unit vectors of embeddings that have one length."""
    x = np.array(embeddings.tolist(), np.float64).reshape(len(embeddings), -1)
    x /= np.abs(x).max(1)[:, None]  # neither overflow nor underflow in the norm
    return x / np.sqrt((x * x).sum(1))[:, None]


def _salted(unit: np.ndarray, table: int, probes: int, blocks: int) -> np.ndarray:
    """``cells`` with keys that vectors of other lengths do not have."""
    return cells(unit, table, blocks, probes) ^ np.int64(unit.shape[1] * 0x5851F42D4C957F2D % (1 << 62))


def hashed(vectors: DataFrame, table: int, probes: int, blocks: int) -> DataFrame:
    """(cid, sketch, keys): ``keys`` has the own cell in ``table`` and the probed ones."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby(batch["embedding"].str.len()):
                unit = _units(part["embedding"])
                keys = _salted(unit, table, probes, blocks)
                yield pd.DataFrame({"cid": part["cid"].to_numpy(), "sketch": sketches(unit), "keys": list(keys)})

    return vectors.select("cid", "embedding").mapInPandas(work, "cid long, sketch long, keys array<long>")


def _meeting(a: np.ndarray, b: np.ndarray, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """First table in which the pairs meet (``tables`` if none), and the smallest cell in which they do."""
    a, b = a.reshape(len(a), tables, -1), b.reshape(len(b), tables, -1)
    none = np.iinfo(np.int64).max
    table, cell = np.full(len(a), tables), np.full(len(a), none)
    for t in reversed(range(tables)):
        own_a, own_b = a[:, t, 0], b[:, t, 0]
        there = np.where((a[:, t] == own_b[:, None]).any(1), own_b, none)
        here = np.where((b[:, t] == own_a[:, None]).any(1), own_a, none)
        least = np.minimum(there, here)
        met = least != none
        table[met], cell[met] = t, least[met]
    return table, cell


def _compare(group: pd.DataFrame, cosine: float, tables: int, probes: int = PROBES, blocks: int = BLOCKS) -> pd.DataFrame:
    """Links of one block: for each vector the copies it is linked with, and one neighbour in its component.

    Keys of all tables are worked out again, for vectors with a near one only:
    they are some times as large as the vector and do not move.
    """
    unit = _units(group["embedding"])
    at_row, keys = np.full(len(unit), -1), np.zeros((0, tables * (min(probes, 240 * blocks) + 1)), np.int64)
    own, chunk = group["own"].to_numpy(), group["chunk"].to_numpy()
    cid, copies = group["cid"].to_numpy(), group["copies"].to_numpy()
    key, bi, bj = group["key"].iloc[0], group["bi"].iloc[0], group["bj"].iloc[0]
    t = int(group["tbl"].iloc[0])
    links, root = np.zeros(len(group), np.int64), np.arange(len(group))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    left = np.flatnonzero(chunk == bi)
    right = np.flatnonzero(chunk == bj)
    for at in range(0, len(left), 512):
        some = left[at : at + 512]
        i, j = np.nonzero(unit[some] @ unit[right].T >= cosine)
        i, j = some[i], right[j]
        if bi == bj:
            i, j = i[i < j], j[i < j]
        on = own[i] | own[j]
        i, j = i[on], j[on]
        new = np.unique(np.concatenate([i, j]))
        new = new[at_row[new] < 0]
        if len(new):
            at_row[new] = len(keys) + np.arange(len(new))
            found = [_salted(unit[new], table, probes, blocks) for table in range(tables)]
            keys = np.concatenate([keys, np.concatenate(found, 1)])
        for k in range(0, len(i), 50_000):
            x, y = i[k : k + 50_000], j[k : k + 50_000]
            first, cell = _meeting(keys[at_row[x]], keys[at_row[y]], tables)
            here = (first == t) & (cell == key)
            x, y = x[here], y[here]
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            for a, b in zip(x.tolist(), y.tolist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
    on = np.flatnonzero(links)
    return pd.DataFrame({"cid": cid[on], "links": links[on], "other": cid[[find(i) for i in on]] if len(on) else cid[:0]})


def near_vectors(
    vectors: DataFrame, vec_id: str, embedding: str, cosine: float = COSINE, tables: int = TABLES,
    probes: int = PROBES, blocks: int = BLOCKS,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Links are pairs found in a common cell whose cosine in double precision
    is at least ``cosine``; ``n_links`` counts the vectors linked directly,
    ``component_id`` is the smallest vec_id reachable, ``kept`` says that the
    vector is that one. Vectors that are null, empty, zero or hold null or
    non-finite numbers have no links; vectors of different lengths are not
    compared. Equal vectors are hashed once and counted as often as they
    occur. Null ids are kept as rows; a component with no other id has a null
    one. An empty table gives an empty result.

    Cells are first matched by key and sketch without vectors; only rows that
    have a partner get theirs. Large cells are compared in pairs of blocks of
    about ``MEMBERS`` vectors, and a block returns counts and one neighbour
    for each vector, never its pairs. A pair is counted only in the first
    table and the smallest cell in which it meets. Tables are looked up one
    after the other, and vectors move to their blocks in slices, so that only
    a few times the vectors are on disk at once.
    """
    exact_float = dict(vectors.dtypes)[embedding] == "array<float>"
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    usable = finite & F.exists("embedding", lambda v: v != 0)
    rows = stage(rows.withColumn("usable", F.coalesce(usable, F.lit(False))))
    classes = rows.where("usable").groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = stage(classes.withColumn("cid", F.monotonically_increasing_id()))
    moved = "array<float>" if exact_float else "array<double>"  # half the bytes, and the same numbers
    slim_vectors = classes.select("cid", "copies", F.col("embedding").cast(moved).alias("embedding"))

    def meeting(at: int) -> DataFrame:
        """Members of table ``at`` that have a partner in a cell, and rows that look it up."""
        slim = hashed(classes, at, probes, blocks).select("cid", "sketch", F.posexplode("keys").alias("at", "key"))
        slim = stage(slim.withColumn("own", F.col("at") == 0).drop("at"))
        own = slim.where("own").select("key", F.col("cid").alias("oc"), F.col("sketch").alias("os"))
        near = F.bit_count(F.col("sketch").bitwiseXOR(F.col("os"))) <= SKETCH_BITS
        # Rows that meet a member of the cell, and members that are met.
        met = stage(slim.alias("s").join(own.alias("o"), (F.col("s.key") == F.col("o.key")) & (F.col("cid") != F.col("oc")) & near, "left_semi"))
        any_row = met.select("key", F.col("cid").alias("oc"), F.col("sketch").alias("os"))
        members = slim.where("own").alias("s").join(
            any_row.alias("o"), (F.col("s.key") == F.col("o.key")) & (F.col("cid") != F.col("oc")) & near, "left_semi"
        )
        passing.extend([slim, met])
        return met.where("NOT own").select("key", "cid", "own").unionByName(members.select("key", "cid", "own")).withColumn("tbl", F.lit(at))

    passing: list[DataFrame] = []

    def each() -> Iterator[DataFrame]:
        for at in range(tables):
            unstage(*passing)
            passing.clear()
            yield meeting(at)

    parts = each()
    active = stage(next(parts), parts)
    unstage(*passing)
    sizes = active.groupBy("key").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
    active = active.join(sizes, "key").withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j")
    active = active.select("key", "tbl", "cid", "own", "chunk", other)
    active = active.withColumn("bi", F.least("chunk", "j")).withColumn("bj", F.greatest("chunk", "j")).drop("j")
    active = stage(active)
    slices = math.ceil(active.count() / max(MOVED_ROWS, MOVED_SHARE * classes.count()))

    def compared(at: int) -> DataFrame:
        part = active.where(in_slice(["key", "bi", "bj"], at, slices)) if slices > 1 else active
        return part.join(slim_vectors, "cid").groupBy("key", "bi", "bj").applyInPandas(
            lambda g: _compare(g, cosine, tables, probes, blocks), "cid long, links long, other long"
        )

    found = stage(compared(0), (compared(i) for i in range(1, slices)))
    unstage(active)
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select(F.col("cid").alias("u"), F.col("other").alias("v")))
    ids = classes.join(links, "cid", "left").join(groups.withColumnRenamed("id", "cid"), "cid", "left")
    ids = stage(ids.withColumn("group", F.coalesce("component", "cid")))
    least = ids.groupBy("group").agg(F.min("least").alias("component_id"))
    ids = ids.join(least, "group").select("embedding", "copies", "links", "component_id")
    linked = rows.where("usable").join(ids, "embedding").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    result = linked.unionByName(alone)
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
