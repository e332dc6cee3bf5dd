"""Periodic runs of words (operator 13).

A run is a stretch of consecutive words with smallest period q and a length of
at least 6 and at least 4 q that no neighbouring word extends. At every dyadic
scale B the words are cut into blocks of B words. A run with a period from B to
2 B - 1 holds one whole block and its copy one period later, so the distances
from B to 2 B - 1 at which a block occurs again are the only possible periods.
The sums of squared differences of a block and all places of the window behind
it come from number-theoretic transforms, exact integers; a sum of zero is an
occurrence, and its distance seeds an extension to both sides.

Many documents are looked at as one sequence in which no word number occurs in
two documents, so one transform serves the blocks of many texts. A block with a
word that does not come again within 2 B words cannot occur again and is not
transformed; in prose hardly any block of more than a few words is left.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import byte_slices, hand_back_memory

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST, TIMES = 6, 4  # a run has at least LEAST words and TIMES periods
# Primes with a primitive root each; 2^26 divides each prime less one.
PRIMES = ((2013265921, 31), (1811939329, 13), (469762049, 3))
_HASH_PRIME, _HASH_BASES = 2147483647, (1327217884, 2016347121, 764261123, 1583910557)
_CELLS = 1 << 19  # numbers transformed at once (one block may have more)
_SEEDS = 1 << 18  # seeds extended at once
_BLOCK_BYTES = 4 << 20  # of text looked at as one sequence
_NEVER = np.iinfo(np.int64).max


# --- exact block convolution -----------------------------------------------------


def _powers(base: int, count: int, prime: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1) modulo the prime."""
    out = np.ones(1, np.int64)
    while len(out) < count:
        out = np.concatenate([out, out * pow(base, len(out), prime) % prime])
    return out[:count]


def transform(rows: np.ndarray, root: int, prime: int) -> np.ndarray:
    """Number-theoretic transform of each row, of a power of two numbers, for a primitive root of unity of that order."""
    count, n = rows.shape
    halves, done, x = n // 2, 1, rows
    while halves:
        x = x.reshape(count, 2, halves, done)
        twiddle = _powers(pow(root, done, prime), halves, prime)[:, None]
        out = np.empty((count, halves, 2, done), np.int64)
        total = x[:, 0] + x[:, 1]
        out[:, :, 0] = total - prime * (total >= prime)
        out[:, :, 1] = (x[:, 0] - x[:, 1] + prime) * twiddle % prime
        halves, done, x = halves // 2, done * 2, out
    return x.reshape(count, n)


def squared_differences(blocks: np.ndarray, windows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Sum of squared differences of each block (B numbers) and the first B places of its window (2 B numbers), modulo the prime."""
    count, size = blocks.shape
    n = 2 * size
    root = pow(generator, (prime - 1) // n, prime)
    mirrored = np.zeros((count, n), np.int64)
    mirrored[:, 0] = blocks[:, 0]
    mirrored[:, size + 1 :] = blocks[:, :0:-1]
    mirrored, windows = mirrored % prime, windows % prime
    product = transform(mirrored, root, prime) * transform(windows, root, prime) % prime
    cross = transform(product, pow(root, prime - 2, prime), prime)[:, :size] * pow(n, prime - 2, prime) % prime
    squares = np.cumsum(np.concatenate([np.zeros((count, 1), np.int64), windows * windows % prime], 1), 1)
    behind = squares[:, size:n] - squares[:, :size]
    own = (blocks % prime * (blocks % prime) % prime).sum(1)
    return (own[:, None] + behind - 2 * cross) % prime


class Words:
    """Words of several documents as numbers: no number occurs in two documents."""

    def __init__(self, documents: list[list]):
        sizes = np.array([len(d) for d in documents], np.int64)
        self.ends = np.cumsum(sizes)
        numbers, distinct = [], []
        for words in documents:
            table: dict = {}
            numbers.append(np.array([table.setdefault(w, len(table)) for w in words], np.int64))
            distinct.append(len(table))
        self.local = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        self.document = np.repeat(np.arange(len(sizes)), sizes)
        self.distinct = np.array(distinct, np.int64)
        self.number = self.local + np.repeat(np.cumsum(self.distinct) - self.distinct, sizes)
        self.begin = np.repeat(self.ends - sizes, sizes)  # of each word's document
        self.end = np.repeat(self.ends, sizes)
        # Distance to the next place of the same word.
        order = np.argsort(self.number, kind="stable")
        same = self.number[order[1:]] == self.number[order[:-1]]
        self.again = np.full(len(order), _NEVER)
        self.again[order[:-1][same]] = (order[1:] - order[:-1])[same]

    def __len__(self) -> int:
        return len(self.number)

    def seeds(self, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Starts of blocks of ``size`` words and distances (size to 2 size - 1) at which they occur again in their document."""
        count = len(self) // size
        if not count:
            return
        starts = np.arange(count) * size
        whole = (self.document[starts] == self.document[starts + size - 1]) & (starts + 2 * size <= self.end[starts])
        whole &= self.again[: count * size].reshape(count, size).max(1) < 2 * size
        starts = starts[whole]
        rows = max(1, _CELLS // (2 * size))
        for at in range(0, len(starts), rows):
            part = starts[at : at + rows]
            blocks = self.local[part[:, None] + np.arange(size)]
            places = part[:, None] + np.arange(size, 3 * size)
            # Behind the document's end stands a number that none of its words has.
            beyond = self.distinct[self.document[part]][:, None]
            windows = np.where(places < self.end[part][:, None], self.local[np.minimum(places, len(self) - 1)], beyond)
            bound, product, zero = size * int(windows.max()) ** 2, 1, np.ones((len(part), size), bool)
            for prime, generator in PRIMES:
                zero &= squared_differences(blocks, windows, prime, generator) == 0
                product *= prime
                if product > bound:  # then a sum that is zero modulo the primes is zero
                    break
            row, distance = np.nonzero(zero)
            for k in range(0, len(row), _SEEDS):
                yield part[row[k : k + _SEEDS]], distance[k : k + _SEEDS] + size

    def _hashes(self, base: int) -> tuple[np.ndarray, np.ndarray]:
        powers = _powers(base, len(self) + 1, _HASH_PRIME)
        terms = (self.number + 1) % _HASH_PRIME * powers[:-1] % _HASH_PRIME
        return np.concatenate([[0], np.cumsum(terms) % _HASH_PRIME]), powers

    def runs(self, least: int = LEAST, times: int = TIMES) -> np.ndarray:
        """Rows (start, end, period) of all runs, by start and period.

        Extensions compare hashes by bisection; every run found is then compared
        word by word, and should a hash have lied, all is done with another base.
        """
        for base in _HASH_BASES:
            found = self._runs(base, least, times)
            if all(self._is_run(*row) for row in found.tolist()):
                return found
        raise RuntimeError("no hash base without a collision")

    def _runs(self, base: int, least: int, times: int) -> np.ndarray:
        hashes, powers = self._hashes(base)

        def equal(i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
            left = (hashes[i + length] - hashes[i]) % _HASH_PRIME * powers[j - i] % _HASH_PRIME
            return left == (hashes[j + length] - hashes[j]) % _HASH_PRIME

        def longest(most: np.ndarray, fits) -> np.ndarray:
            low, high = np.zeros(len(most), np.int64), most.copy()
            while (low < high).any():
                mid = (low + high + 1) // 2
                ok = fits(mid)
                low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
            return low

        found = np.zeros((0, 3), np.int64)
        widest = int((self.end - self.begin).max()) if len(self) else 0
        size = 1
        while times * size <= widest:
            for start, period in self.seeds(size):
                # Only where the whole document could hold a run of this period.
                fits = self.end[start] - self.begin[start] >= times * period
                start, period = start[fits], period[fits]
                behind = start + size
                right = longest(self.end[start] - behind - period, lambda n: equal(behind, behind + period, n))
                left = longest(start - self.begin[start], lambda n: equal(start - n, start - n + period, n))
                rows = np.stack([start - left, behind + right + period, period], 1)
                length = rows[:, 1] - rows[:, 0]
                found = _smallest(np.concatenate([found, rows[(length >= least) & (length >= times * period)]]))
            size *= 2
        return found[np.lexsort((found[:, 2], found[:, 0]))]

    def _is_run(self, start: int, end: int, period: int) -> bool:
        x, begin, stop = self.number, self.begin[start], self.end[start]
        return (
            bool((x[start : end - period] == x[start + period : end]).all())
            and (start == begin or x[start - 1] != x[start - 1 + period])
            and (end == stop or x[end] != x[end - period])
        )


def _smallest(rows: np.ndarray) -> np.ndarray:
    """Of equal stretches the one with the smallest period: the others are its multiples."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    return rows[first]


# --- documents -------------------------------------------------------------------

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(
    docs: DataFrame, doc_id: str, text: str, least: int = LEAST, times: int = TIMES, keep: bool = True
) -> DataFrame:
    """Per row: doc_id, n_words, ``runs`` (array of start, length, period, by start and period) and ``collapsed``.

    Words are what stands between the ASCII characters space, tab, line feed,
    vertical tab, form feed and carriage return. ``collapsed`` is the text
    without the words that some run holds after its first period, the others
    joined by one space (null unless ``keep``). A null or empty text has no
    words, no runs and an empty collapsed text. Repeated rows are answered each,
    an empty table gives an empty result, other columns are not read.

    Nothing is shuffled: rows are looked at where they are read, in slices of
    some megabytes of text; a longer text is a slice of its own, and takes
    memory in proportion to its words.
    """
    if times < 3 or least < 1:
        raise ValueError("a run needs at least three periods and one word")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", _BLOCK_BYTES):
                documents = [t.split() for t in part["text"].to_pylist()]  # bytes: splits at ASCII white space only
                words = Words(documents)
                rows = words.runs(least, times)
                owner = words.document[rows[:, 0]]
                first = np.searchsorted(owner, np.arange(len(documents) + 1))
                begin = words.begin[rows[:, 0]]
                values = [rows[:, 0] - begin, rows[:, 1] - rows[:, 0], rows[:, 2]]
                runs = pa.StructArray.from_arrays([pa.array(v) for v in values], fields=list(RUN))
                kept = [None] * len(documents)
                if keep:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, rows[:, 0] + rows[:, 2], 1)
                    np.add.at(edge, rows[:, 1], -1)
                    stays = np.cumsum(edge[:-1]) == 0
                    kept = [
                        b" ".join(d if a == b else [w for w, ok in zip(d, stays[end - len(d) : end].tolist()) if ok])
                        for d, a, b, end in zip(documents, first, first[1:], words.ends.tolist())
                    ]
                sizes = [len(d) for d in documents]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(first.astype(np.int32), runs), pa.array(kept, pa.binary())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )
        hand_back_memory()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).cast("binary").alias("text"))
    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    return rows.mapInArrow(find, schema).withColumn("collapsed", F.col("collapsed").cast("string"))


def with_repeats(doc_id: Column, text: Column) -> Column:
    """The text of the registered query: for every tenth id (by CRC-32) a tail of the words repeats with a period.

    With h the CRC-32 of the id's decimal text, g = h div 10 and n words, word
    i >= a becomes word a + (i - a) mod p, a = g mod n, p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != F.lit(""))

    def repeated(found: Column) -> Column:
        n, g = F.size(found).cast("long"), F.floor(h / 10)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        index = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        picked = F.transform(index, lambda i: F.get(found, i.cast("int")))
        return F.when(n > 0, F.concat_ws(" ", picked)).otherwise(F.lit(""))

    # The array is bound once, as the only element of a transform, not evaluated for every word.
    changed = F.transform(F.array(words), repeated)[0]
    return F.when(h % 10 == 0, changed).otherwise(text)
