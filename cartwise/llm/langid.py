"""Language identification with language-bitmask n-gram filters (operator 7).

One Bloom filter for all languages: each slot holds one bit per language
(bit-sliced), so the AND of an n-gram's slots names every language that holds
it. A text's n-grams are counted per language, the share expected from false
positives is taken off, and the language with the largest corrected count is
predicted.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import bounded_batches, hand_back_memory
from cartwise.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZES = (3, 4)  # bytes of an n-gram
ROWS_PER_LANGUAGE = 4000  # rows (about) that a language is learned from at most
GRAMS = 12_000  # n-grams a language may put into the filter
FILTER_BITS = 20  # slots of the filter, as a power of two
HASHES = 2
# A language holds an n-gram if it uses it at least this share of the most that any language does.
SHARE = 0.25
UND = "und"
_LETTER = re.compile(r"[^\W\d_]")
_CHUNK = 1 << 21  # bytes that are looked up at once


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit number for the ``size`` bytes at every place but the last ones."""
    out = np.zeros(max(len(data) - size + 1, 0), np.uint64)
    for k in range(size):
        out = (out << np.uint64(8)) | data[k : len(data) - size + 1 + k].astype(np.uint64)
    return out ^ np.uint64(size << 56)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    return x * np.uint64(0xD6E8FEB86659FD93)


def _slots(grams: np.ndarray, seed: int, bits: int) -> np.ndarray:
    return (_mix(grams, seed) >> np.uint64(64 - bits)).astype(np.int64)


def _plain(text: str) -> bytes:
    """Lower-case words between single spaces; runs without a letter are left out."""
    words = re.findall(r"[^\W\d_]+", text.lower())
    return (" " + " ".join(words) + " ").encode("utf-8", "replace")


def count_grams(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n): n-grams (by hash) of all rows; each task sends a language's sums once per batch."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, part in batch.groupby("lang"):
                total: dict = {}
                for t in part["text"]:
                    data = np.frombuffer(_plain(t or ""), np.uint8)
                    for at in range(0, len(data), _CHUNK):
                        piece = data[at : at + _CHUNK + max(SIZES) - 1]
                        grams, n = np.unique(np.concatenate([_grams(piece, s) for s in SIZES]), return_counts=True)
                        total.setdefault(0, []).append((grams, n))
                if not total:
                    continue
                grams = np.concatenate([g for g, _ in total[0]])
                grams, where = np.unique(grams, return_inverse=True)
                n = np.bincount(where, np.concatenate([n for _, n in total[0]])).astype(np.int64)
                yield pd.DataFrame({"lang": name, "gram": grams.view(np.int64), "n": n})

    bounded_batches()
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    counted = rows.mapInPandas(work, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class LanguageFilter:
    """Slots of language bits; ``languages`` in the order of the bits."""

    def __init__(self, grams: dict[str, np.ndarray]):
        self.languages = sorted(grams)
        words = (len(self.languages) + 63) // 64
        self.slots = np.zeros((max(words, 1), 1 << FILTER_BITS), np.uint64)
        for i, name in enumerate(self.languages):
            for seed in range(1, HASHES + 1):
                at = _slots(grams[name].view(np.uint64), seed, FILTER_BITS)
                self.slots[i // 64, at] |= np.uint64(1 << (i % 64))
        share = [np.count_nonzero(self.slots[i // 64] & np.uint64(1 << (i % 64))) for i in range(len(self.languages))]
        self.false_share = (np.array(share, float) / (1 << FILTER_BITS)) ** HASHES

    def counts(self, data: np.ndarray) -> tuple[int, np.ndarray]:
        """n-grams of a text, and for each language how many it holds, without the expected false ones."""
        total, held = 0, np.zeros(len(self.languages))
        for at in range(0, len(data), _CHUNK):
            for size in SIZES:
                grams = _grams(data[at : at + _CHUNK + size - 1], size)
                total += len(grams)
                where = [_slots(grams, seed, FILTER_BITS) for seed in range(1, HASHES + 1)]
                for word in range(len(self.slots)):
                    mask = self.slots[word, where[0]]
                    for w in where[1:]:
                        mask &= self.slots[word, w]
                    for i in range(word * 64, min(len(self.languages), word * 64 + 64)):
                        held[i] += np.count_nonzero(mask & np.uint64(1 << (i % 64)))
        false = total * self.false_share
        return total, np.maximum(held - false, 0.0) / np.maximum(1.0 - self.false_share, 1e-9)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not _LETTER.search(text) or not self.languages:
            return UND, 0.0
        total, held = self.counts(np.frombuffer(_plain(text), np.uint8))
        best = int(held.argmax())  # ties and unknown texts: the first name
        whole = held.sum()
        return self.languages[best], float(held[best] / whole) if whole > 0 else 0.0


def learn(docs: DataFrame, doc_id: str, text: str, lang: str, rows_per_language: int = ROWS_PER_LANGUAGE) -> LanguageFilter:
    """Fit the filter on labelled rows.

    A language with more than ``rows_per_language`` rows is learned from a
    part of them, chosen by a hash of the id, so that about that many remain;
    their whole texts count. A language takes its ``GRAMS`` most frequent
    n-grams among those it holds (see ``SHARE``); the tables returned to the driver have at most that many rows
    per language. Rows without text or language teach nothing.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("rows"))
    rows = rows.join(F.broadcast(sizes), "lang")  # one row per language
    share = F.lit(float(rows_per_language)) / F.col("rows")
    part = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(11)), F.lit(1 << 20)) < share * (1 << 20)
    grams = stage(count_grams(rows.where(part).select("text", "lang"), "text", "lang"))
    rate = F.col("n") / F.col("total")
    grams = grams.join(F.broadcast(grams.groupBy("lang").agg(F.sum("n").alias("total"))), "lang")  # as above
    most = F.max(rate).over(Window.partitionBy("gram"))  # a row per language
    grams = stage(grams.withColumn("most", most).where(rate >= SHARE * F.col("most")).select("lang", "gram", "n"))
    found: dict[str, np.ndarray] = {}
    for row in grams.select("lang").distinct().orderBy("lang").collect():
        top = grams.where(F.col("lang") == row["lang"]).orderBy(F.desc("n"), "gram").limit(GRAMS).toPandas()
        found[row["lang"]] = top["gram"].to_numpy(np.int64)
    return LanguageFilter(found)


def predictions(model: LanguageFilter, text: Column) -> Column:
    """struct(lang, score) of whole texts."""

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang", "score"])
        hand_back_memory()

    bounded_batches()
    return predict(text)
