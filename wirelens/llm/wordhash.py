"""64-bit hashes of words and word shingles, for many texts at once.

A word's hash is a polynomial of its bytes modulo 2 ** 64, taken for all words
of a slice from running sums, and mixed.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
ODD = 0x9E3779B97F4A7C15


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


class Words:
    """The words of a slice: hashes, byte places, and each text's first word (then the number of words)."""

    def __init__(self, data: np.ndarray, hashes: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray):
        self.data, self.hashes, self.start, self.end, self.first = data, hashes, start, end, first

    def shingles(self, n: int) -> np.ndarray:
        """The hash of the n words from each place on; across texts too."""
        w = self.hashes
        many = max(0, len(w) - n + 1)
        h = w[:many]
        for j in range(1, n):
            h = mix(h * np.uint64(ODD) + w[j : j + many])
        return h


class WordHasher:
    def __init__(self):
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            steps = np.full(n, ODD, np.uint64)
            back = np.full(n, pow(ODD, -1, 1 << 64), np.uint64)
            steps[0] = back[0] = 1
            self.power, self.inverse = np.cumprod(steps), np.cumprod(back)

    def words(self, raws: list[bytes]) -> Words:
        data = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
        self._powers(len(data))
        space = _SPACE[data]
        before = np.concatenate(([True], space[:-1]))
        start, end = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[: len(data)])))
        first = np.searchsorted(start, np.cumsum([0] + [len(r) + 1 for r in raws]))
        return Words(data, mix((total[end] - total[start]) * self.inverse[start]), start, end, first)
