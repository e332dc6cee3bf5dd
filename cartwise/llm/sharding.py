"""Sharding by extendible hashing (operator 1).

Rows are placed by the leading bits of a 64-bit hash: 32 bits of the MD5 of
the key, then 32 bits of the MD5 of key and row number, which only matter for
a key whose rows alone are more than a shard may hold. The directory is a
sparse trie: a bucket that is over the limit is split on its next bit until
it fits; a bucket that fits is never split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import free_name, numbered
from cartwise.session import stage

BITS = 63  # prefixes are kept as non-negative longs: 32 key bits, 31 row bits
STEP = 16  # bits that one pass over the remaining rows can split


def _hash(key, row):
    """32 bits of the key's MD5, then 31 bits of the MD5 of key and row."""
    head = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long")
    tail = F.conv(F.substring(F.md5(F.concat_ws(":", key, row.cast("string")).cast("binary")), 1, 8), 16, 10)
    return F.shiftleft(head, 31) + F.shiftright(tail.cast("long"), 1)


def assign_shards(rows: DataFrame, key: str, text: str, limit: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``key``, ``keep`` and its shard.

    Added columns: ``bytes`` (UTF-8 length of ``text``, null: 0), ``shard``
    (the bucket's prefix as a string of 0 and 1, empty for the undivided
    table), ``depth`` (its bits), ``shard_bytes``, ``shard_rows``. Every shard
    holds at most ``limit`` bytes, unless it is one single row that is longer.
    Null keys hash like the empty string. Rows that repeat a key stay together
    until that key alone is over the limit; repeated rows are kept. An empty
    table gives an empty result.

    A pass sums bytes by the finest prefix it looks at (combined before the
    shuffle), adds up the ancestors and takes for each prefix the first depth
    that fits. Rows whose finest bucket does not fit go to the next pass.
    """
    if limit < 1:
        raise ValueError("limit must be at least one byte")
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    out = [key, *keep]
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    hashed, own = free_name(rows, "hash"), free_name(rows, "bytes")
    slim = rows.select(*out, size.alias(own), F.monotonically_increasing_id().alias(free_name(rows, "row")))
    row = slim.columns[-1]
    todo = stage(slim.withColumn(hashed, _hash(name, F.col(row))).drop(row))
    total = todo.agg(F.sum(own)).first()[0] or 0
    # Fine enough that a mean bucket of the first pass is a 64th of a shard.
    depth, done = min(32, max(8, (total // limit).bit_length() + 6)), 0
    parts = []
    while True:
        last = depth >= BITS
        prefix = F.shiftright(hashed, BITS - depth)
        cells = stage(todo.groupBy(prefix.alias("cell")).agg(F.sum(own).alias("size"), F.count("*").alias("n")))
        steps = F.explode(F.sequence(F.lit(done), F.lit(depth))).alias("depth")
        up = cells.select("cell", "size", "n", steps)
        up = up.withColumn("prefix", F.expr(f"shiftright(cell, {depth} - depth)"))
        sizes = up.groupBy("depth", "prefix").agg(F.sum("size").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
        fits = sizes.where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1) | (F.col("depth") == BITS))
        first = up.join(fits.select("depth", "prefix"), ["depth", "prefix"]).groupBy("cell").agg(F.min("depth").alias("depth"))
        first = first.withColumn("prefix", F.expr(f"shiftright(cell, {depth} - depth)"))
        leaf = stage(first.join(fits, ["depth", "prefix"]))
        placed = todo.withColumn("_cell", prefix).join(leaf.withColumnRenamed("cell", "_cell"), "_cell", "left")
        placed = stage(placed.drop("_cell"))
        fit = placed if last else placed.where(F.col("depth").isNotNull())
        parts.append(fit)
        if last:
            break
        over = placed.where(F.col("depth").isNull()).select(*todo.columns)
        if over.isEmpty():
            break
        todo, done, depth = over, depth, min(BITS, depth + STEP)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    bits = F.expr("CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), cast(depth AS int), '0') END")
    return result.select(
        *out, F.col(own).alias("bytes"), bits.alias("shard"), F.col("depth").cast("long").alias("depth"),
        "shard_bytes", "shard_rows",
    )


def write_shards(rows: DataFrame, shards: DataFrame, key: str, path: str, row: str | None = None) -> None:
    """Write ``rows`` as one Parquet folder per shard; ``shards`` is the result of ``assign_shards``.

    Rows are joined to their shard's name by ``row``, a stable row number that
    ``rows`` and ``shards`` hold; it is written too. Without one they are
    joined by ``key`` (null keys are equal), which is an error if a key is
    divided over several shards: then only a number tells which row goes where.
    """
    folder, same = free_name(rows, "shard"), free_name(rows, "key")
    if row is not None:
        where = shards.select(F.col(row).alias(same), F.col("shard").alias(folder))
        joined = rows.join(where, rows[row] == where[same], "left").drop(same)
    else:
        where = stage(shards.groupBy(F.col(key).alias(same)).agg(F.min("shard").alias(folder), F.max("shard").alias("_most")))
        if not where.where(F.col(folder) != F.col("_most")).isEmpty():
            raise ValueError("a key is divided over several shards: give the column of a row number, or use shard_table")
        joined = rows.join(where.drop("_most"), rows[key].eqNullSafe(where[same]), "left").drop(same)
    joined.repartition(folder).write.partitionBy(folder).parquet(path)


def shard_table(rows: DataFrame, key: str, text: str, limit: int, path: str) -> DataFrame:
    """Assign ``rows`` to shards and write each row to its own; returns ``assign_shards`` with the row's number.

    The number is a column ``row`` (or that name with underscores behind it).
    """
    row = free_name(rows, "row")
    rows = numbered(rows, row)
    shards = stage(assign_shards(rows, key, text, limit, (row,)))
    write_shards(rows, shards, key, path, row)
    return shards
