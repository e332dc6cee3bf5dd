"""Elias-Fano coded sequences of non-decreasing integers, with select.

A value is cut in two: its low bits lie packed side by side, its high part is
the number of zeros before its one in a bit string. That takes about
2 + log2(range / values) bits a value. The place of every 256th one is kept
(32 bits each), so the value at any index is found without decoding the rest.
"""

from __future__ import annotations

import struct
import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 256  # ones between two kept places
_STEP = 1 << 16  # values packed at once
_HEAD = "<QqQB"  # count, first value, bits of the upper string, low bits


def encode(values: np.ndarray) -> bytes:
    """The coded form of a non-decreasing int64 array."""
    values = np.asarray(values, np.int64)
    if not len(values):
        return struct.pack(_HEAD, 0, 0, 0, 0)
    if (values[1:] < values[:-1]).any():
        raise ValueError("values must not decrease")
    first = int(values[0])
    last = int(values[-1]) - first  # a Python integer: the range may exceed 63 bits
    low = max(0, (last // len(values)).bit_length() - 1)
    span = values.view(np.uint64) - np.uint64(first & (1 << 64) - 1)
    size = (last >> low) + len(values)
    upper = np.zeros(-(-size // 8), np.uint8)
    packed, samples = [], []
    for at in range(0, len(span), _STEP):
        part = span[at : at + _STEP]
        place = (part >> np.uint64(low)) + np.arange(at, at + len(part), dtype=np.uint64)
        np.bitwise_or.at(upper, (place >> np.uint64(3)).astype(np.int64), (1 << (place & np.uint64(7))).astype(np.uint8))
        samples.append(place[(-at) % SAMPLE :: SAMPLE].astype("<u4"))
        if low:
            bits = (part[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
            packed.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little"))
    return b"".join([
        struct.pack(_HEAD, len(values), first, size, low), *(s.tobytes() for s in samples), upper.tobytes(),
        *(p.tobytes() for p in packed),
    ])


class Sequence:
    """Reads the coded form: ``seq[i]`` by select, ``seq.range(i, j)`` many at once."""

    def __init__(self, coded: bytes):
        self.count, self.first, size, self.low = struct.unpack_from(_HEAD, coded)
        kept = -(-self.count // SAMPLE)
        at = struct.calcsize(_HEAD)
        self.samples = np.frombuffer(coded, "<u4", kept, at)
        at += 4 * kept
        self.upper = np.frombuffer(coded, np.uint8, -(-size // 8), at)
        at += len(self.upper)
        # Nine bytes are read for each low part, also for the last one.
        self.packed = np.frombuffer(coded[at:] + bytes(9), np.uint8)

    def __len__(self) -> int:
        return self.count

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.count:
            raise IndexError(i)
        return int(self.range(i, i + 1)[0])

    def _places(self, i: int, j: int) -> np.ndarray:
        """Places of ones i..j-1 in the upper string."""
        block = i // SAMPLE
        start = int(self.samples[block]) // 8
        end = int(self.samples[-(-j // SAMPLE)]) // 8 + 1 if -(-j // SAMPLE) < len(self.samples) else len(self.upper)
        # Ones before the sampled one may share its byte; they are skipped.
        before = int(np.unpackbits(self.upper[start : start + 1], bitorder="little")[: int(self.samples[block]) % 8].sum())
        wanted, parts, seen = before + j - block * SAMPLE, [], 0
        for at in range(start, end, _STEP):
            ones = np.flatnonzero(np.unpackbits(self.upper[at : min(at + _STEP, end)], bitorder="little")) + 8 * at
            parts.append(ones)
            seen += len(ones)
            if seen >= wanted:
                break
        found = np.concatenate(parts)
        return found[before + i - block * SAMPLE : wanted]

    def range(self, i: int, j: int) -> np.ndarray:
        """Values i..j-1 as int64."""
        if i >= j:
            return np.zeros(0, np.int64)
        index = np.arange(i, j, dtype=np.int64)
        value = (self._places(i, j) - index).astype(np.uint64) << np.uint64(self.low)
        if self.low:
            bit = index * self.low
            byte, shift = bit >> 3, (bit & 7).astype(np.uint64)
            part = np.zeros(len(index), np.uint64)
            for k in range(8):
                part |= self.packed[byte + k].astype(np.uint64) << np.uint64(8 * k)
            part >>= shift
            if self.low > 56:
                ninth = self.packed[byte + 8].astype(np.uint64) << (np.uint64(63) - shift)
                part |= ninth << np.uint64(1)  # in two steps: a shift by 64 has no defined result
            value |= part & np.uint64((1 << self.low) - 1)
        return (value + np.uint64(self.first & (1 << 64) - 1)).view(np.int64)

    def rank(self, value: int) -> int:
        """How many values are at most ``value``."""
        lo, hi = 0, self.count
        while lo < hi:
            mid = (lo + hi) // 2
            if self[mid] <= value:
                lo = mid + 1
            else:
                hi = mid
        return lo
