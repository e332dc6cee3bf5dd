"""Helpers that the operators share."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.session import free_shuffles, stage  # noqa: F401

# Tasks get this module by value; workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# What separates words: ASCII characters that are neither letter nor digit.
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_az(text: Column) -> Column:
    """Lower-case A-Z and nothing else; a null text counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Maximal runs of letters, digits and non-ASCII characters, in order."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), NOT_WORD), lambda w: w != F.lit(""))


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    name = wish
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once with a row number that stays the same when a task is run again."""
    return stage(df.withColumn(name, F.monotonically_increasing_id()))


def training_row(doc_id: Column) -> Column:
    """Rows that models may learn from: CRC-32 of the id's text, modulo 4, is not 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 != 2


BATCH_ROWS = 256  # rows of whole texts that a Python worker gets at once


def bounded_batches() -> None:
    """Hand whole texts to Python in batches that fit beside the executor's heap.

    Sets the session's Arrow batch size unless it is below already.
    """
    conf, key = SparkSession.active().conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))


def byte_slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with at most about ``most`` bytes in a text column without nulls (a longer text alone)."""
    block = pc.binary_length(batch[column]).to_numpy(zero_copy_only=False).cumsum(dtype=np.int64) // most
    edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(batch)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def hand_back_memory() -> None:
    """Return what a finished task has freed to the system: workers live on beside the executor's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
