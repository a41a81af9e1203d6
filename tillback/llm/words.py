"""Words and word hashes of whole text columns as numpy arrays, without a Python loop over words.

A word is a maximal run of characters other than space and U+0009 to U+000D, or other than the
given bytes between words. Its hash is a 64-bit
sum of byte values times position factors, so equal words have equal hashes in every task. Two
different words share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tillback.llm.frames import text_bytes

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NO_TERM = np.ones(256, bool)  # what stands between terms: ASCII other than letters and digits
NO_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit result (a bijection)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def constants(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit factors that depend on the seed alone."""
    start = np.arange(1, count + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)
    return mixed(start) | U64(1)


BYTE_VALUES = constants(256, 11)
_factors = constants(1024, 12)


def factors(count: int) -> np.ndarray:
    global _factors
    if count > len(_factors):
        _factors = constants(2 * count, 12)
    return _factors


class Words:
    """Where the words of a slice of texts are, and their hashes."""

    def __init__(self, column: pa.Array, *, lower: bool = False, hashed: bool = True, gaps: np.ndarray = SPACE):
        self.data, self.offsets = text_bytes(column)
        blank = gaps[self.data]
        edge = np.zeros(len(blank) + 1, bool)
        edge[self.offsets] = True  # a text's first byte begins a word, whatever the text before ends with
        before, after = edge[:-1].copy(), edge[1:].copy()
        before[1:] |= blank[:-1]
        after[:-1] |= blank[1:]
        self.starts = np.flatnonzero(before & ~blank)
        self.ends = np.flatnonzero(after & ~blank) + 1
        self.first = np.searchsorted(self.starts, self.offsets)  # index of each text's first word
        if hashed:
            self.hashes = self._hashes(blank, lower)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def rows(self) -> np.ndarray:
        """Row number of every word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def _hashes(self, blank: np.ndarray, lower: bool) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, U64)
        place = np.arange(len(self.data), dtype=np.int32)
        begin = np.zeros(len(self.data), np.int32)
        begin[self.starts] = self.starts
        place -= np.maximum.accumulate(begin)
        place[blank] = 0
        values = BYTE_VALUES[LOWER[self.data] if lower else self.data]
        values *= factors(int(place.max()) + 1)[place]
        values[blank] = 0
        return mixed(np.add.reduceat(values, self.starts) + (self.ends - self.starts).astype(U64))

    def windows(self, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """First-word indexes and hashes of all runs of ``size`` words that lie within one text."""
        count = len(self.starts) - size + 1
        if count <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        last = np.repeat(self.first[1:], np.diff(self.first))  # end of the text each word belongs to
        at = np.arange(count)
        whole = at + size <= last[:count]
        return at[whole], self._combined(size, seed)[whole]

    def _combined(self, size: int, seed: int) -> np.ndarray:
        count = len(self.starts) - size + 1
        total = np.zeros(count, U64)
        for k, factor in enumerate(constants(size, seed)):
            total += self.hashes[k : k + count] * factor
        return mixed(total)
