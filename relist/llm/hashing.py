"""Word hashes of a byte string, all words at once.

A word's hash is a polynomial over random byte values, read off running sums, so the cost is a few
passes of numpy over the bytes and no Python step per word. Words end at ASCII white space.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


class Powers:
    """Powers of the base and of its inverse, grown to the longest text seen by this worker."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def grow(cls, n: int) -> None:
        while len(cls.up) < n:
            k = len(cls.up)
            cls.up = np.concatenate([cls.up, cls.up * np.uint64(pow(_BASE, k, 1 << 64))])
            cls.down = np.concatenate([cls.down, cls.down * np.uint64(pow(_INVERSE, k, 1 << 64))])


class Words:
    """Start, end and hash of each word of ``data``; hashes of word prefixes on request."""

    def __init__(self, data: bytes) -> None:
        raw = np.frombuffer(data, np.uint8)
        edge = np.diff(_SPACE[raw].astype(np.int8), prepend=1, append=1)
        self.raw = raw
        self.start = np.flatnonzero(edge == -1)
        self.end = np.flatnonzero(edge == 1)
        if len(self.start):
            Powers.grow(len(raw) + 1)
            self._sums = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(_BYTE[raw] * Powers.up[: len(raw)], out=self._sums[1:])
            self.hash = self._between(self.start, self.end)
        else:
            self.hash = np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return len(self.start)

    def _between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * Powers.down[start])

    def prefix(self, size: int) -> np.ndarray:
        """Hashes of the first ``size`` bytes of the words that are longer than that."""
        start = self.start[self.end - self.start > size]
        return self._between(start, start + size) if len(start) else np.zeros(0, np.uint64)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size`` words in a row; a shorter sequence is one shingle."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(size, n)
    total = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        total = mix(total * np.uint64(_BASE) + hashes[k : n - width + 1 + k])
    return np.unique(total)


def digest(hashes: np.ndarray) -> tuple[int, int]:
    """Two independent order-free 64-bit sums of a set of hashes, as signed integers."""
    with np.errstate(over="ignore"):
        sums = np.array([mix(hashes ^ np.uint64(seed)).sum(dtype=np.uint64) for seed in (0x51ED270B, 0xA24BAED5)], np.uint64)
    low, high = sums.view(np.int64)
    return int(low), int(high)


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype(np.uint64, copy=False).view(np.int64)
