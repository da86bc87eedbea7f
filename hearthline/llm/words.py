"""Words and word hashes of whole Arrow text columns, in numpy.

A column is taken as one run of UTF-8 bytes. The byte classes used here are
ASCII, and no byte of a longer UTF-8 character is ASCII, so splitting bytes
gives the same words as splitting characters. Work goes in pieces of whole
texts, so that memory follows the largest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 16

WHITE = bytes([0x20, *range(0x09, 0x0E)])
#: Everything but white space is in a word.
PLAIN = np.array([b not in WHITE for b in range(256)])
#: Digits, letters and whatever is not ASCII are in a word.
ALPHANUMERIC = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])

LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mix_int(x: int) -> int:
    return int(mix(np.array([x & _MASK], np.uint64))[0])


#: A 64-bit value for each byte, with capitals A-Z valued as small letters.
_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))[LOWER]


class _Powers:
    """Powers of a number modulo 2**64, computed as far as they are needed."""

    def __init__(self, base: int):
        self.base, self.values = base, np.ones(1, np.uint64)

    def __call__(self, n: int) -> np.ndarray:
        while len(self.values) < n:
            step = np.uint64(pow(self.base, len(self.values), 1 << 64))
            self.values = np.concatenate([self.values, self.values * step])
        return self.values[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(_BASE_INVERSE)


@dataclass
class Words:
    """The words of some texts: place in the bytes, and number of the text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    #: Word i of text k is in first[k] <= i < first[k + 1].
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def texts(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same for capitals A-Z and small letters."""
        return self.prefix_hashes(())[0]

    def prefix_hashes(self, limits: tuple[int, ...]) -> list[np.ndarray]:
        """Hashes of the words, then of their first bytes for each limit."""
        if not len(self.starts):
            return [np.zeros(0, np.uint64)] * (1 + len(limits))
        n = len(self.data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[self.data] * _UP(n), out=sums[1:])
        before, factor = sums[self.starts], _DOWN(n)[self.starts]
        ends = [self.ends, *(np.minimum(self.ends, self.starts + limit) for limit in limits)]
        return [mix((sums[end] - before) * factor) for end in ends]


def find_words(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray) -> Words:
    """Words of texts lying at bounds[k] to bounds[k + 1] in the bytes."""
    inside = kind[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[cuts - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, bounds, "left"))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the bounds of each text; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, places, data = column.buffers()
    bounds = np.frombuffer(places, np.int64, len(column) + 1, column.offset * 8)
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(column: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Consecutive texts with their bytes and bounds, about PIECE_BYTES at a time."""
    data, bounds = text_bytes(column)
    low, count = 0, len(bounds) - 1
    while low < count:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + PIECE_BYTES, "right")) - 1)
        yield slice(low, high), data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
        low = high


def code_points(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of characters of each text."""
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def shingles(words: Words, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words.

    A shorter text has one run, all its words; a text without words has none.
    """
    hashes, first = words.hashes(), words.first
    factors = [np.uint64(mix_int(k + 77)) | np.uint64(1) for k in range(size)]
    total = max(0, len(hashes) - size + 1)
    runs = np.zeros(total, np.uint64)
    for k in range(size):
        runs += hashes[k : k + total] * factors[k]
    runs = mix(runs)
    out = []
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        n = high - low
        if n >= size:
            out.append(np.unique(runs[low : low + n - size + 1]))
        elif n:
            seed = mix_int(n)
            for h in hashes[low:high].tolist():
                seed = mix_int(seed * 31 + h)
            out.append(np.array([seed], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
