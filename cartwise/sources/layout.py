"""Stored layouts: sources bucketed by order, and the master table by month.

Both are written once and read often. Orders and items in buckets of the same
hash meet without a shuffle of either; a master table in month folders is read
only where a cut-off or period needs it, and a new month replaces its own
folder.
"""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartwise.session import free_shuffles, in_slice, slices_of
from cartwise.sources.tables import Sources

MONTH = "order_ym"


def bucket_sources(src: Sources, folder: str, buckets: int) -> Sources:
    """Orders and items written in ``buckets`` sorted buckets by order_id below ``folder``; the rest as given.

    Choose at least as many buckets as ``spark.sql.shuffle.partitions``: with
    fewer, Spark would rather shuffle both sides to that number.
    """
    spark, run = src.orders.sparkSession, uuid.uuid4().hex
    stored = {}
    for name in ("orders", "items"):
        table = f"{name}_{run}"
        (
            getattr(src, name)
            .repartition(buckets, "order_id")  # one file for each bucket, not one for each task and bucket
            .write.bucketBy(buckets, "order_id")
            .sortBy("order_id")
            .option("path", f"{folder.rstrip('/')}/{table}")
            .option("compression", "zstd")
            .saveAsTable(table)
        )
        stored[name] = spark.table(table)
    return dataclasses.replace(src, **stored, bucketed=True)


def write_master(master: DataFrame, path: str, rows: int | None = None) -> None:
    """Write (or rewrite) the master table in one folder per month; rows without a month have a folder of their own.

    A month goes to as many tasks as its size asks for, and a small one to a
    single file, sorted by order. The months of a large table are written in
    slices; ``rows`` spares the count of its rows.
    """
    slices = slices_of(master.count() if rows is None else rows)
    for i in range(slices):
        part = master if slices == 1 else master.where(in_slice([MONTH], i, slices))
        ordered = part.hint("rebalance", MONTH).sortWithinPartitions(MONTH, "order_id")
        writer = ordered.write.mode("append" if i else "overwrite").partitionBy(MONTH)
        writer.parquet(path, compression="zstd")
        if slices > 1:
            free_shuffles(master.sparkSession)


def replace_months(rows: DataFrame, path: str) -> None:
    """Replace the months that ``rows`` holds, whole; the other folders are not touched."""
    (
        rows.hint("rebalance", MONTH)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )


def read_master(
    spark: SparkSession, path: str, schema: StructType, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Months from ``first`` to ``last`` (both included; all without a limit); only their folders are read."""
    table = spark.read.schema(schema).parquet(path).select(schema.names)
    if first is not None:
        table = table.where(F.col(MONTH) >= first)
    return table.where(F.col(MONTH) <= last) if last is not None else table
