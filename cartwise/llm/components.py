"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.session import stage, unstage


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(id, component): every node of ``edges`` with the smallest node it can reach.

    Alternates two steps until the edges form stars: every node links its
    larger neighbours to its smallest one, then its smaller ones. Both are a
    minimum per node (combined before the shuffle) and a join back, so a node
    with very many links is no single task's work; each round is written to
    the shared folder. Null ends and loops are ignored; an empty table gives
    an empty result.
    """
    now = stage(
        edges.where((F.col(u) != F.col(v)) & F.col(u).isNotNull() & F.col(v).isNotNull())
        .select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .distinct()
    )
    seen = _signature(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where((F.col("v") > F.col("u")) & (F.col("v") != F.col("m")))
        large = stage(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, now = now, stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        unstage(last, large)
        before, seen = seen, _signature(now)
        if before == seen:
            break
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.min("u"), F.max("v")).first())
