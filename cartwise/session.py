"""Session set-up and the one place where lineage is cut."""

from __future__ import annotations

import gc
import math
import os
import tempfile
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = 8, app: str = "cartwise") -> SparkSession:
    """A session for tests and benches; a cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", os.environ.get("CARTWISE_PARTITIONS", "8"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names; a temporary one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="cartwise-checkpoint-")
    sc.setCheckpointDir(named)
    return named


_LONG = 5.0  # seconds of a job whose shuffle files may be worth a garbage collection


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs whose results are staged.

    It does so only once the driver has collected what refers to them, which
    by itself may come long after a large shuffle.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


# Folders that stage() has written in this process and that still exist, in order.
STAGED: list[str] = []


def stage(df: DataFrame, then: Iterable[DataFrame] = ()) -> DataFrame:
    """Run ``df`` once into a Parquet table in the shared folder and read it back.

    The table cuts the lineage, survives lost executors, keeps column pruning,
    and its true size lets Spark decide by itself whether a join may broadcast
    it (``spark.sql.autoBroadcastJoinThreshold``); above that, both sides are
    shuffled and AQE splits hot partitions. ``then`` has further rows with the
    same columns; each is asked for and run when the one before is written.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/staged-{uuid.uuid4().hex}"
    began = time.monotonic()
    df.write.parquet(path, compression="zstd")
    for part in then:
        free_shuffles(spark)
        part.write.mode("append").parquet(path, compression="zstd")
    if time.monotonic() - began > _LONG:
        free_shuffles(spark)
    STAGED.append(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_path = path
    return staged


# Rows of a table that are moved at once; larger ones go slice by slice.
SLICE_ROWS = 32 << 20


def slices_of(rows: int) -> int:
    return max(1, math.ceil(rows / SLICE_ROWS))


def in_slice(keys: Iterable[str], at: int, slices: int) -> Column:
    """Whether a row belongs to slice ``at``: rows with equal keys (null counts as a value) share one."""
    return F.pmod(F.xxhash64(*keys), F.lit(slices)) == at


def stage_in_slices(
    table: DataFrame, keys: Iterable[str], build: Callable[[DataFrame], DataFrame], rows: int | None = None
) -> DataFrame:
    """``stage(build(table))`` for a ``build`` that never mixes rows with different ``keys``.

    A large table is read and built once for each slice of the keys, so that
    the shuffle files of one slice only are on disk at a time. ``rows`` spares
    the count of the table's rows.
    """
    keys, slices = list(keys), slices_of(table.count() if rows is None else rows)
    if slices == 1:
        return stage(build(table))
    first, *others = (table.where(in_slice(keys, i, slices)) for i in range(slices))
    return stage(build(first), (build(part) for part in others))


def unstage(*staged: DataFrame) -> None:
    """Delete tables that ``stage`` returned and that no later query reads."""
    for df in staged:
        _delete(df.sparkSession, [df._staged_path])


def release(spark: SparkSession, start: int = 0, end: int | None = None) -> None:
    """Delete what ``STAGED`` lists from ``start`` to ``end``: all of it when a job ends."""
    _delete(spark, STAGED[start:end])


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        if path in STAGED:
            STAGED.remove(path)


# Rows and bytes of a staged table (a few short columns each) that may be broadcast.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def small_side(staged: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if the staged table is measured to be small: by its rows, and by rows times their width.

    The hint is needed where the other side has few rows that are exploded just
    before the join: by its file size Spark would broadcast that side instead.
    Above either limit Spark shuffles both sides and AQE splits hot partitions.
    Widths of strings and arrays are taken from all rows.
    """
    return F.broadcast(staged) if is_small(staged, max_rows, max_bytes) else staged


def is_small(staged: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the staged table is within both limits of ``small_side``."""
    wide = [c for c, kind in staged.dtypes if kind == "string" or kind.startswith(("array", "map", "struct", "binary"))]
    width = F.lit(16 * len(staged.columns))
    for c in wide:
        width = width + F.coalesce(F.length(F.col(c).cast("string")), F.lit(0))
    rows, size = staged.agg(F.count("*"), F.sum(width)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def large_side(df: DataFrame) -> DataFrame:
    """A side with rows per customer, unit or unit and category: never broadcast, both sides are sorted and merged.

    Spark would decide by the file size of a staged table, and files of repeated
    category names are some 40 times smaller than their rows in the driver's memory.
    """
    return df.hint("merge")
