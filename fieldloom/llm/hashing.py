"""NumPy helpers for Arrow functions: words as bytes, their 64-bit hashes, windows of hashes."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64


class WordHash(dict):
    """Word to 64-bit hash. It forgets everything when it holds `limit` words, so memory stays bounded."""

    limit = 1 << 19

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_hashes(text: bytes | None, cache: WordHash, lower: bool) -> np.ndarray:
    """Hashes of the words. bytes.split() cuts at ASCII white space alone and bytes.lower() changes A-Z alone."""
    if not text:
        return np.zeros(0, dtype=U)
    got = (text.lower() if lower else text).split()
    return np.fromiter(map(cache.__getitem__, got), dtype=U, count=len(got))


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """A hash for each window of `width` words; for the whole sequence if it is shorter; none if it is empty."""
    n = len(h)
    if not n:
        return h
    take = min(n, width)
    acc = np.full(n - take + 1, take, dtype=U)
    for i in range(take):
        acc = (acc ^ h[i : n - take + 1 + i]) * U(0x9E3779B97F4A7C15)
        acc ^= acc >> U(29)
    return mix(acc)
