"""Word shingles as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE_WORDS = 5
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SHORT = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    return x * np.uint64(0x94D049BB133111EB)


class _Hashes(dict):
    """Hashes of words; the first ``limit`` different ones are remembered, which the frequent ones are among."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.limit and len(word) < 100:
            self[word] = found
        return found


class Shingler:
    """Hashes of word shingles."""

    def __init__(self, size: int = SHINGLE_WORDS, limit: int = 50_000):
        self.size = size
        self.known = _Hashes(limit)

    def words(self, text: bytes) -> np.ndarray:
        """The hash of every word (a run without ASCII white space) after lower-casing A-Z."""
        known = self.known
        return np.array([known[w] for w in text.lower().split()], np.uint64)

    def distinct(self, text: bytes) -> np.ndarray:
        """The sorted distinct shingles; of fewer words the whole sequence is one, of none there is none."""
        words, k = self.words(text), self.size
        if not len(words):
            return words
        if len(words) < k:
            return mixed(np.array([len(words)], np.uint64) * _SHORT + sum(
                mixed(w + np.uint64(i)) * _FACTOR for i, w in enumerate(words.reshape(-1, 1))))
        n = len(words) - k + 1
        total = words[:n].copy()
        for i in range(1, k):
            total = total * _FACTOR + words[i:i + n]
        return np.unique(mixed(total))
