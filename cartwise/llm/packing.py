"""Vector bin packing of token sequences (operator 3).

Examples have three sizes: tokens, segments (one for each piece) and
loss-bearing tokens. A sequence has a limit on each. The next example of an
open sequence is the one whose size vector has the largest dot product with
the sequence's remaining capacity (both as shares of the limits), among those
that fit; many short segments are so mixed with few long ones.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm import tokens
from cartwise.llm.common import bounded_batches, hand_back_memory

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 2048
SEGMENTS = 32
END = 1  # id that closes a document
POOL = 256  # examples that wait in a task for a place; a full pool closes sequences
_BATCH_BYTES = 8 << 20  # text that is encoded at once: a word is looked up once for it


class Packer:
    """Places examples into sequences; holds at most ``POOL`` examples and no closed sequence.

    ``add`` and ``finish`` yield (sequence, example, start, length, offset).
    Examples may be cut at any token when ``cut`` is set; the last sequences
    are then cut to powers of two, which need no padding.
    """

    def __init__(self, length: int = LENGTH, segments: int = SEGMENTS, loss: int = LENGTH, cut: bool = True):
        if min(length, segments, loss) < 1:
            raise ValueError("limits must be positive")
        self.limits = np.array([length, segments, loss], float)
        self.cut, self.sequence = cut, 0
        self.sizes = np.zeros((0, 3))
        self.waiting: list[tuple] = []  # (example, start)

    def add(self, example, tokens_: int, loss_tokens: int | None = None) -> Iterator[tuple]:
        """``loss_tokens`` None: every token bears loss. An example without tokens takes no place."""
        every = loss_tokens is None
        loss_tokens = tokens_ if every else loss_tokens
        length, _, most = (int(x) for x in self.limits)
        if not self.cut and (tokens_ > length or loss_tokens > most):
            raise ValueError("an example is over the limits and may not be cut")
        start = 0
        if self.cut:
            if not every:
                raise ValueError("where loss-bearing tokens lie is not known, so examples cannot be cut")
            whole = min(length, most)
            while tokens_ - start >= whole:
                yield self.sequence, example, start, whole, 0
                self.sequence += 1
                start += whole
            loss_tokens = tokens_ - start
        if tokens_ > start:
            self.waiting.append((example, start))
            self.sizes = np.concatenate([self.sizes, [[tokens_ - start, 1, loss_tokens]]])
        while len(self.waiting) >= POOL:
            yield from self._fill(False)

    def finish(self) -> Iterator[tuple]:
        while self.waiting:
            yield from self._fill(True)

    def _take(self, k: int) -> None:
        self.waiting.pop(k)
        self.sizes = np.delete(self.sizes, k, 0)

    def _fill(self, last: bool) -> Iterator[tuple]:
        room, offset, placed = self.limits.copy(), 0, []
        while self.waiting:
            fits = (self.sizes <= room).all(1)
            if not fits.any():
                break
            score = (self.sizes / self.limits) @ (room / self.limits)
            k = int(np.where(fits, score, -1.0).argmax())
            placed.append((*self.waiting[k], int(self.sizes[k, 0]), offset))
            offset += int(self.sizes[k, 0])
            room -= self.sizes[k]
            self._take(k)
        if self.cut and self.waiting and min(room) >= 1:
            # What is left is filled from the longest example, whose rest waits on.
            k, part = int(self.sizes[:, 0].argmax()), int(min(room[0], room[2]))
            example, start = self.waiting[k]
            placed.append((example, start, part, offset))
            offset += part
            self.waiting[k] = (example, start + part)
            self.sizes[k] -= (part, 0, part)
        full = offset == int(self.limits[0])
        if full or not self.cut or not (last and not self.waiting):
            yield from ((self.sequence, e, s, n, at) for e, s, n, at in placed)
            self.sequence += 1
            return
        # The last sequence: its tokens in runs of powers of two, the largest first.
        run = 1 << (offset.bit_length() - 1)
        used = 0
        for example, start, n, _ in placed:
            while n:
                part = min(n, run - used)
                yield self.sequence, example, start, part, used
                start, n, used, offset = start + part, n - part, used + part, offset - part
                if used == run:
                    self.sequence, used = self.sequence + 1, 0
                    run = 1 << (offset.bit_length() - 1) if offset else 0


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "padding long, ids array<int>"
)


def pack_documents(
    docs: DataFrame, doc_id: str, text: str, vocabulary: str, length: int = LENGTH, segments: int = SEGMENTS,
    with_ids: bool = False,
) -> DataFrame:
    """Documents as token pieces in sequences of ``length``: one row per piece.

    A document is the ids of its whole text and the closing id 1; a null or
    empty text is that id alone. Every id lies in exactly one piece; pieces of
    a sequence lie without gaps from offset 0. ``padding`` (at a sequence's
    last piece, else 0) is what is missing to ``length``, none at a power of
    two. Repeated rows are packed again each; an empty table gives an empty
    result. ``ids`` holds the piece's ids if ``with_ids`` is set, else null.

    Every task packs the rows it reads, so nothing is shuffled and a task
    holds one batch, ``POOL`` waiting examples and one open sequence. A
    sequence's number starts with its task's.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = tokens.Encoder(vocabulary)
        base = TaskContext.get().partitionId() << 32
        packer = Packer(length, segments, length)
        held: dict[int, tuple] = {}  # ids of documents that still have tokens to place
        ready: list[tuple] = []  # pieces of the sequence that is not complete yet
        out: list[tuple] = []

        def place(pieces) -> None:
            for seq, key, start, n, at in pieces:
                if ready and ready[-1][5] != base + seq:
                    close()
                name, ids, left = held[key]
                part = ids[start : start + n]
                crc = zlib.crc32(part.astype("<u4").tobytes())
                shown = part.astype(np.int32) if with_ids else None
                ready.append((name, start, n, crc, len(ids), base + seq, at, shown))
                if left == n:
                    del held[key]
                else:
                    held[key] = (name, ids, left - n)

        def close() -> None:
            end = ready[-1][6] + ready[-1][2]
            padding = 0 if end & (end - 1) == 0 else length - end
            out.extend((*p[:7], padding if p is ready[-1] else 0, p[7]) for p in ready)
            ready.clear()

        def frame() -> pd.DataFrame:
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padding", "ids"]
            done = pd.DataFrame(out, columns=names)
            done["doc_id"] = done["doc_id"].astype("Int64")
            out.clear()
            return done

        number = 0
        for names, texts in _parts(batches):
            for name, ids in zip(names, encoder.encode(texts), strict=True):
                ids = np.append(ids, np.uint32(END))
                held[number] = (None if pd.isna(name) else int(name), ids, len(ids))
                place(packer.add(number, len(ids)))
                number += 1
            if out:
                yield frame()
        place(packer.finish())
        if ready:
            close()
        if out:
            yield frame()
        del encoder, held
        hand_back_memory()

    bounded_batches()
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(pack, PIECES)


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of consecutive rows of all batches, about ``_BATCH_BYTES`` of text at once."""
    names, texts, weight = [], [], 0
    for batch in batches:
        for name, text in zip(batch["doc_id"].tolist(), batch["text"], strict=True):
            names.append(name)
            texts.append(text or "")
            weight += len(texts[-1])
            if weight >= _BATCH_BYTES:
                yield names, texts
                names, texts, weight = [], [], 0
    if names:
        yield names, texts
