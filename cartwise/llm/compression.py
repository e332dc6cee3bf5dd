"""Quality scores by compression (operator 9).

Two zstandard dictionaries are trained, on texts labelled good and on texts
labelled bad. A text is compressed with both, block by block; what the good
dictionary saves against the bad one, per byte of text, is turned into a
probability by a logistic curve fitted on other labelled texts.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import bounded_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1024  # bytes that are compressed at once, so that the dictionary counts
DICTIONARY = 112_640  # bytes of a dictionary
LEVEL = 3
ROWS_PER_LABEL = 4000  # labelled rows (about) that are learned from, half for dictionaries, half for the curve
BLOCKS_PER_ROW = 16  # blocks of a labelled row that a dictionary may learn from, spread over the text
# A text counts as if so many bytes of an even mixture came with it: short texts are judged carefully.
EXTRA_BYTES, EXTRA_SAVING = 200, 12


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


class CompressionModel:
    """Dictionaries and curve; without texts of both labels every score is the share of good ones."""

    def __init__(self, good: list[bytes], bad: list[bytes], share: float):
        self.share = share
        self.raw = (_dictionary(good), _dictionary(bad)) if good and bad else None
        self.slope, self.offset = 0.0, 0.0
        self._open = None

    def __getstate__(self):
        return self.__dict__ | {"_open": None}

    def saving(self, text: str | None) -> float:
        """Bytes that the good dictionary saves per byte of the whole text."""
        if self.raw is None:
            return 0.0
        if self._open is None:
            self._open = []
            for raw in self.raw:
                data = zstandard.ZstdCompressionDict(raw)
                data.precompute_compress(level=LEVEL)
                self._open.append(
                    zstandard.ZstdCompressor(
                        level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
                    )
                )
        good, bad = (c.compress for c in self._open)
        data = (text or "").encode("utf-8", "replace")
        saved = 0
        for at in range(0, len(data), BLOCK):
            block = data[at : at + BLOCK]
            saved += len(bad(block)) - len(good(block))
        return (saved + EXTRA_SAVING) / (len(data) + EXTRA_BYTES)

    def fit_curve(self, savings: np.ndarray, quality: np.ndarray) -> None:
        """Logistic curve by Newton steps with a small ridge."""
        if self.raw is None or len(set(quality.tolist())) < 2:
            self.raw = None
            return
        scale = max(float(np.std(savings)), 1e-6)
        x = np.stack([savings / scale, np.ones(len(savings))], 1)
        w = np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (quality - p) - 1e-3 * w
            hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            step = np.linalg.solve(hess, grad)
            w += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.offset = float(w[0] / scale), float(w[1])

    def score(self, text: str | None) -> float:
        if self.raw is None:
            return self.share
        z = self.slope * self.saving(text) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -700, 700))))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, quality: str) -> CompressionModel:
    """Fit a model on rows that ``labels`` marks 1 (good) or 0 (bad); both tables have ``doc_id``.

    Where a label has more than ``ROWS_PER_LABEL`` rows, a part of them is
    chosen by a hash of the id so that about that many remain; only they
    return to the driver, with at most ``BLOCKS_PER_ROW`` blocks of
    ``BLOCK`` characters each. Ids with both labels, null ids and other labels
    teach nothing.
    """
    marked = labels.select(F.col(doc_id).alias("id"), F.col(quality).cast("int").alias("q"))
    marked = marked.where("id IS NOT NULL AND q IN (0, 1)").groupBy("id").agg(F.min("q").alias("q"), F.max("q").alias("r"))
    marked = marked.where("q = r").select("id", "q")
    sizes = {r["q"]: r["n"] for r in marked.groupBy("q").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(5)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    share = F.lit(0.0)
    for q, n in sizes.items():
        share = F.when(F.col("q") == q, F.lit(ROWS_PER_LABEL / n)).otherwise(share)
    half = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(6)), F.lit(2)) == 0
    chosen = marked.where(draw < share).withColumn("trains", half)
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(chosen), "id")  # at most about ROWS_PER_LABEL rows a label
    last = F.floor((F.length("text") - 1) / F.lit(BLOCK))
    step = F.greatest(F.ceil((last + 1) / F.lit(BLOCKS_PER_ROW)), F.lit(1))
    starts = F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(last, F.lit(0)), step), lambda k: (k * BLOCK + 1).cast("int"))
    blocks = rows.where("trains").select("id", "q", "text", F.explode(starts).alias("at"))
    blocks = blocks.select("id", "q", "at", F.substring(F.col("text"), F.col("at"), F.lit(BLOCK)).alias("block"))
    got = blocks.toPandas().sort_values(["id", "at"])
    good, bad = ([b.encode("utf-8", "replace") for b in got.loc[got["q"] == q, "block"] if b] for q in (1, 0))
    model = CompressionModel(good, bad, sizes.get(1, 0) / total if total else 0.5)
    if model.raw is not None:
        curve = rows.where("NOT trains").select("id", "q", savings(model, F.col("text")).alias("s")).toPandas()
        curve = curve.sort_values(["id", "s"])
        model.fit_curve(curve["s"].to_numpy(float), curve["q"].to_numpy(float))
    return model


def savings(model: CompressionModel, text: Column) -> Column:
    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([model.saving(t) for t in texts], dtype=float)

    bounded_batches()
    return run(text)


def scores(model: CompressionModel, text: Column) -> Column:
    """Probability of label 1 for whole texts; null counts as empty, which is judged by the curve too."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype=float)

    bounded_batches()
    return run(text)
