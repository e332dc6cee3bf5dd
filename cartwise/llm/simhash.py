"""SimHash near-duplicates with pigeonring filtering (operator 5).

Fingerprints are cut into one segment more than the allowed distance. If two
fingerprints differ in at most ``bits`` bits, then starting at some segment of
the ring every chain of 1, 2, 3 ... consecutive segments differs in at most
its proportional share of bits: none in the first, one in the first two, and
so on. Candidates share the first segment and agree in the second up to one
bit; longer chains are tested before the full distance.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import bounded_batches, hand_back_memory
from cartwise.llm.components import connected_components
from cartwise.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 4
BITS = 4
_CHUNK = 1 << 16  # shingles whose bits are counted at once


def simhash(data: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text: a bit is set if more than half of the shingle hashes set it."""
    import xxhash

    words = data.lower().split()  # bytes: lower() is A-Z, split() is space and 09-0D
    if not words:
        return 0
    join, digest = b" ".join, xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(join(words), 42)
    ones, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for at in range(0, n, _CHUNK):
        runs = zip(*(words[at + i : min(at + _CHUNK, n) + i] for i in range(shingle)), strict=True)
        hashes = np.array([digest(join(r), 42) for r in runs], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """SimHash of whole texts as signed 64-bit numbers; null counts as empty, whose fingerprint is 0."""

    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            raw = [simhash(t.encode("utf-8", "surrogatepass") if t else b"", shingle) for t in texts]
            yield pd.Series(np.array(raw, np.uint64).view(np.int64))
        hand_back_memory()

    bounded_batches()
    return fp(text)


def _ring(bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the ``bits`` + 1 segments of a 64-bit number."""
    m = bits + 1
    edges = [64 * i // m for i in range(m + 1)]
    return [(edges[i], edges[i + 1] - edges[i]) for i in range(m)]


def _segment(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))


def _keys(fp: Column, bits: int, near: bool) -> Column:
    """Keys (first segment, second segment) of each ring position; ``near``: also with one 0 of the second set to 1.

    Of two fingerprints that differ in one bit of the second segment exactly
    one has a 0 there, so setting bits reaches every partner.
    """
    ring, keys = _ring(bits), []
    for i, (shift, width) in enumerate(ring):
        shift2, width2 = ring[(i + 1) % len(ring)]
        key = F.shiftleft(_segment(fp, shift, width), width2).bitwiseOR(_segment(fp, shift2, width2))
        key = F.shiftleft(key, 6).bitwiseOR(F.lit(i))
        keys.append(key)
        if near:
            for b in range(width2):
                free = fp.bitwiseAND(F.lit(_signed(1 << (shift2 + b)))) == 0
                keys.append(F.when(free, key.bitwiseOR(F.lit(1 << (b + 6)).cast("long"))))
    return F.filter(F.array(*keys), lambda k: k.isNotNull())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _close(x: str, y: str, bits: int, at: Column) -> Column:
    """The chains from ring position ``at`` keep their budgets, then the whole distance is within ``bits``."""
    ring = _ring(bits)
    differ = F.col(x).bitwiseXOR(F.col(y))
    chains = F.lit(False)
    for i in range(len(ring)):
        kept = F.lit(True)
        for length in range(2, len(ring)):
            mask = sum(((1 << w) - 1) << s for s, w in (ring[(i + j) % len(ring)] for j in range(length)))
            kept = kept & (F.bit_count(differ.bitwiseAND(F.lit(_signed(mask)))) <= length * bits // len(ring))
        chains = chains | ((at == i) & kept)
    return chains & (F.bit_count(differ) <= bits)


def link_fingerprints(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """(id, component) of the distinct fingerprints in column ``fp`` that have a neighbour within ``bits`` bits.

    First every fingerprint is compared with the smallest one under each of
    its keys, which joins large groups without listing their pairs. Then only
    keys under which two components still meet are searched, and only for
    pairs from different components; so no link between components is missed.
    """
    if not 1 <= bits <= 15:
        raise ValueError("bits must be from 1 to 15")
    fps = stage(fps.select("fp").distinct())
    where = F.col("key").bitwiseAND(F.lit(63))
    keyed = fps.select(F.explode(_keys(F.col("fp"), bits, False)).alias("key"), "fp")
    centre = keyed.groupBy("key").agg(F.min("fp").alias("centre"), F.max("fp").alias("most")).where("centre < most")
    star = keyed.join(centre.drop("most"), "key").where(F.col("fp") != F.col("centre"))
    star = star.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("centre"))) <= bits)
    star = stage(star.select(F.col("fp").alias("u"), F.col("centre").alias("v")).distinct())
    groups = stage(connected_components(star))
    named = fps.join(groups.withColumnRenamed("id", "fp"), "fp", "left")
    named = stage(named.select("fp", F.coalesce("component", "fp").alias("group")))
    index = named.select(F.explode(_keys(F.col("fp"), bits, False)).alias("key"), "fp", "group")
    probe = named.select(F.explode(_keys(F.col("fp"), bits, True)).alias("key"), "fp", "group")
    met = probe.groupBy("key").agg(F.min("group").alias("a"), F.max("group").alias("b")).where("a < b").select("key")
    met = stage(met.join(index.select("key").distinct(), "key"))
    index = index.join(met, "key").select("key", F.col("fp").alias("x"), F.col("group").alias("u"))
    probe = probe.join(met, "key").select("key", F.col("fp").alias("y"), F.col("group").alias("v"))
    links = index.join(probe, (index["key"] == probe["key"]) & (F.col("u") != F.col("v")) & _close("x", "y", bits, index["key"].bitwiseAND(F.lit(63))))
    links = stage(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    joined = stage(connected_components(links))
    outer = groups.select("id", F.col("component").alias("group"))
    outer = outer.unionByName(links.select(F.explode(F.array("u", "v")).alias("group")).distinct().join(
        groups.select(F.col("id").alias("group")).distinct(), "group", "left_anti").select(F.col("group").alias("id"), "group"))
    final = outer.join(joined.select(F.col("id").alias("group"), "component"), "group", "left")
    return final.select("id", F.coalesce("component", "group").alias("component"))


def simhash_components(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """``rows`` (doc_id, fp, ...) with ``component_id``, the smallest doc_id reachable over links.

    Equal fingerprints are linked at distance 0. A component without any
    non-null doc_id has a null id; an empty table gives an empty result.
    """
    groups = stage(link_fingerprints(rows.where(F.col("fp").isNotNull()), bits))
    ids = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    ids = ids.join(groups.withColumnRenamed("id", "fp"), "fp", "left")
    ids = stage(ids.select("fp", "least", F.coalesce("component", "fp").alias("group")))
    least = ids.groupBy("group").agg(F.min("least").alias("component_id"))
    return rows.join(ids.join(least, "group").select("fp", "component_id"), "fp")
