"""Token ids of whole texts with a public word-level BPE vocabulary file.

The tokenizer file defines the ids. Encoding word by word is slow, so the same
merges are applied to all new words of a batch at once with numpy; texts with
characters outside the Latin blocks, or with special token strings, go through
the tokenizer library itself. Both ways give the same ids.
"""

from __future__ import annotations

import json
import re
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Characters that the fast way knows: characters below U+0180 and common punctuation.
_KNOWN = re.compile("[\x00-\x1b -\u017f\u2010-\u2027\u2030-\u205e\u20ac]*", re.S)
_SPACE = "\t-\r \x85\xa0"
_LETTER = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
# The words that the tokenizer file's own pattern finds, for those characters.
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
_LONGEST = 48  # bytes of a word that is merged here; longer ones go to the library
_MOST_WORDS = 400_000  # words remembered by one task


class Encoder:
    """Texts to numpy arrays of ids; keeps the ids of words it has seen, up to a bound."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + suffix] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([(vocab[a] << 20) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.table = _pair_table(self.keys)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """One array of ids per text."""
        if len(self.known) > _MOST_WORDS:
            self._forget()
        out: list = [None] * len(texts)
        fast, lowered = [], []
        for i, text in enumerate(texts):
            if "<|" in text or not _KNOWN.fullmatch(text):
                ids = self.library.encode(text, add_special_tokens=False).ids
                out[i] = np.array(ids, np.uint32)
            else:
                fast.append(i)
                lowered.append(text.lower())
        chunks = pc.utf8_split_whitespace(pa.array(lowered, pa.large_string()))
        # Every different chunk is looked up once. White space at an end of a text leaves an empty one.
        coded = chunks.flatten().dictionary_encode()
        names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self._learn({c for c in names if c and c not in self.known})
        place = np.fromiter((self.known[c] if c else -1 for c in names), np.int64, len(names))
        at = place[code]
        filled = at >= 0
        ids, ends = self._ids(at[filled])
        sizes = np.concatenate([[0], np.cumsum(filled)])[chunks.offsets.to_numpy()]
        bound = np.concatenate([[0], ends])[sizes]
        for k, i in enumerate(fast):
            out[i] = ids[bound[k] : bound[k + 1]]
        return out

    def _ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of remembered entries one after the other, and the end of each."""
        counts = self.count[at]
        ends = np.cumsum(counts)
        shift = np.repeat(self.start[at] - (ends - counts), counts)
        return self.flat[shift + np.arange(len(shift))], ends

    def _remember(self, names: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        self.known.update(zip(names, range(len(self.known), len(self.known) + len(names)), strict=True))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(counts) - counts])
        self.count = np.concatenate([self.count, counts])
        self.flat = np.concatenate([self.flat, ids.astype(np.uint32)])

    def _learn(self, fresh: set[str]) -> None:
        """Remember the ids of texts without white space: their words first, then what is joined from several."""
        split = {c: found for c in fresh if len(found := _WORD.findall(c)) != 1}
        pieces = (fresh - split.keys()).union(*split.values()).difference(self.known)
        self._learn_words(sorted(pieces))
        if split:
            at = np.array([self.known[w] for found in split.values() for w in found], np.int64)
            ids, ends = self._ids(at)
            sizes = np.array([len(found) for found in split.values()], np.int64)
            bound = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
            self._remember(list(split), ids, np.diff(bound))

    def _learn_words(self, words: list[str]) -> None:
        coded = [w.encode() for w in words]
        lengths = np.array([len(b) for b in coded], np.int64)
        for lo, hi in ((1, 4), (5, 8), (9, 12), (13, 20), (21, _LONGEST)):
            where = np.flatnonzero((lengths >= lo) & (lengths <= hi))
            for part in np.array_split(where, len(where) // 20000 + 1):
                if len(part):
                    ids, counts = self._merge([coded[i] for i in part])
                    self._remember([words[i] for i in part], ids, counts)
        for i in np.flatnonzero(lengths > _LONGEST):
            ids = np.array([t.id for t in self.library.model.tokenize(_letters_of(coded[i]))], np.uint32)
            self._remember([words[i]], ids, np.array([len(ids)], np.int64))

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 20) | right
        place = self.table[_slot(key, len(self.table))]
        rank = np.full(len(key), 1 << 30, np.int32)
        for k in range(place.shape[1]):
            hit = place[:, k]
            right_one = (hit >= 0) & (self.keys[hit] == key) & (left >= 0) & (right >= 0)
            rank[right_one] = self.ranks[hit[right_one]]
        return rank

    def _merge(self, coded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Merge the lowest-ranked pair of every word, leftmost first, until no word has one."""
        n, width = len(coded), max(map(len, coded))
        length = np.array([len(b) for b in coded])
        raw = np.frombuffer(b"".join(b.ljust(width, b"\0") for b in coded), np.uint8).reshape(n, width)
        col = np.arange(width)
        ids = np.where(col < length[:, None], self.inner[raw], -1)
        ids[np.arange(n), length - 1] = self.final[raw[np.arange(n), length - 1]]
        rank = np.full((n, width), 1 << 30, np.int32)
        if width > 1:
            rank[:, :-1] = self._rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, -1)
        live = np.arange(n)
        while len(live):
            best = rank[live].argmin(1)
            lowest = rank[live, best]
            on = lowest < 1 << 30
            live, best, lowest = live[on], best[on], lowest[on]
            if not len(live):
                break
            some, moved = ids[live], rank[live]
            shifted = np.concatenate([some[:, 1:], np.full((len(live), 1), -1)], 1)
            after = col > best[:, None]
            some = np.where(after, shifted, some)
            moved = np.where(after, np.concatenate([moved[:, 1:], np.full((len(live), 1), 1 << 30, np.int32)], 1), moved)
            row = np.arange(len(live))
            some[row, best] = self.merged[lowest]
            nxt = np.minimum(best + 1, width - 1)
            right = np.where(best + 1 < width, some[row, nxt], -1)
            moved[row, best] = self._rank(some[row, best], right)
            prev = np.flatnonzero(best > 0)
            moved[prev, best[prev] - 1] = self._rank(some[prev, best[prev] - 1], some[prev, best[prev]])
            ids[live], rank[live] = some, moved
        return ids[ids >= 0], (ids >= 0).sum(1)


def _slot(key: np.ndarray, size: int) -> np.ndarray:
    mixed = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    return (mixed % np.uint64(size)).astype(np.int64)


def _pair_table(keys: np.ndarray) -> np.ndarray:
    """Places of the merge pairs by a hash of the pair; a row holds all that share a slot."""
    slot = _slot(keys, 1 << 20)
    order = np.argsort(slot, kind="stable")
    sorted_slot = slot[order]
    nth = np.arange(len(order)) - np.searchsorted(sorted_slot, sorted_slot)
    table = np.full((1 << 20, int(nth.max()) + 1), -1, np.int32)
    table[sorted_slot, nth] = order
    return table


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def _letters_of(coded: bytes) -> str:
    letters = _byte_letters()
    return "".join(letters[b] for b in coded)
