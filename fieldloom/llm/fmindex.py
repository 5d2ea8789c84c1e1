"""A word-level FM-index in NumPy: wavelet matrix, C array and document array, searched for many patterns at once."""

from __future__ import annotations

import io

import numpy as np

from .hashing import U


def _context_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` symbols (rounded up to a power of 2), by prefix doubling.

    That order is enough to search patterns of up to `depth` words: all suffixes that start with such a pattern stand together.
    """
    n = len(symbols)
    rank, h = symbols.astype(np.int64), 1
    while h < depth:
        later = np.zeros(n, dtype=np.int64)
        later[: n - h] = rank[h:] + 1
        pair = rank * (n + 2) + later
        order = np.argsort(pair, kind="stable")
        ordered = pair[order]
        fresh = np.r_[0, np.cumsum(ordered[1:] != ordered[:-1])]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = fresh
        h *= 2
    return np.argsort(rank, kind="stable")


class FMIndex:
    """Index of a shard's documents for patterns of at most `depth` words."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.words, self.c, self.bits, self.before, self.zeros, self.doc = (parts[k] for k in ("words", "c", "bits", "before", "zeros", "doc"))

    @classmethod
    def build(cls, docs: list[tuple[int, np.ndarray]], depth: int) -> FMIndex:
        """docs: (document, word hashes). Symbol 0 ends each document, so no match runs from one into the next."""
        words = np.unique(np.concatenate([h for _, h in docs])) if docs else np.zeros(0, dtype=U)
        total = sum(len(h) + 1 for _, h in docs)
        symbols, owner = np.zeros(total, dtype=np.int64), np.zeros(total, dtype=np.int64)
        at = 0
        for d, h in docs:
            symbols[at : at + len(h)] = np.searchsorted(words, h) + 1
            owner[at : at + len(h) + 1] = d
            at += len(h) + 1
        order = _context_order(symbols, depth)
        bwt = symbols[order - 1]
        c = np.searchsorted(symbols[order], np.arange(len(words) + 2))
        levels = max(1, int(len(words)).bit_length())
        bits, before, zeros = [], [], []
        seq = bwt
        for level in range(levels - 1, -1, -1):
            bit = ((seq >> level) & 1).astype(np.uint8)
            padded = np.zeros((total // 64 + 1) * 64, dtype=np.uint8)
            padded[:total] = bit
            packed = np.packbits(padded, bitorder="little").view(U)
            bits.append(packed)
            before.append(np.r_[0, np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]].astype(np.uint32))
            zeros.append(total - int(bit.sum()))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])
        return cls({"words": words, "c": c.astype(np.int64), "bits": np.array(bits, dtype=U), "before": np.array(before, dtype=np.uint32), "zeros": np.array(zeros, dtype=np.int64), "doc": owner[order]})

    def dump(self) -> bytes:
        out = io.BytesIO()
        docs, where = np.unique(self.doc, return_inverse=True)
        np.savez(out, words=self.words, c=self.c, bits=self.bits, before=self.before, zeros=self.zeros, docs=docs, where=where.astype(np.uint32))
        return out.getvalue()

    @classmethod
    def load(cls, blob: bytes) -> FMIndex:
        got = dict(np.load(io.BytesIO(blob)))
        got["doc"] = got.pop("docs")[got.pop("where")]
        return cls(got)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbol of each word; -1 for one that the shard has not."""
        if not len(self.words):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at + 1, -1)

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        """Set bits before i."""
        block, rest = i >> 6, (i & 63).astype(U)
        return self.before[level][block].astype(np.int64) + np.bitwise_count(self.bits[level][block] & ((U(1) << rest) - U(1)))

    def _rank(self, symbol: np.ndarray, i: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the BWT before i; start: the same walk for position 0."""
        top = len(self.zeros) - 1
        for level in range(len(self.zeros)):
            one = (symbol >> (top - level)) & 1
            ones = self._ones(level, i)
            i = np.where(one == 1, self.zeros[level] + ones, i - ones)
        return i - start

    def _starts(self) -> np.ndarray:
        """Where the walk for position 0 ends, for each symbol."""
        symbol, top = np.arange(len(self.words) + 1), len(self.zeros) - 1
        i = np.zeros(len(symbol), dtype=np.int64)
        for level in range(len(self.zeros)):
            ones = self._ones(level, i)
            i = np.where(((symbol >> (top - level)) & 1) == 1, self.zeros[level] + ones, i - ones)
        return i

    def statistics(self, symbols: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """For the words before each of `ends` in one run of symbols: how many of them, `depth` at most, match
        somewhere in the shard, and the smallest document that holds all `depth` (else the largest integer)."""
        starts = self._starts()
        m = len(ends)
        length, least = np.zeros(m, dtype=np.int64), np.full(m, np.iinfo(np.int64).max)
        live, lo, hi = np.arange(m), np.zeros(m, dtype=np.int64), np.full(m, len(self.doc), dtype=np.int64)
        for step in range(1, depth + 1):
            s = symbols[ends[live] - step]
            ok = s > 0
            live, lo, hi, s = live[ok], lo[ok], hi[ok], s[ok]
            if not len(live):
                break
            if step == 1:
                lo, hi = self.c[s], self.c[s + 1]
            else:
                lo, hi = self.c[s] + self._rank(s, lo, starts[s]), self.c[s] + self._rank(s, hi, starts[s])
            ok = hi > lo
            live, lo, hi = live[ok], lo[ok], hi[ok]
            length[live] = step
        if len(live):
            # patterns of one length: their intervals are equal or disjoint, so in order they cover the array once
            lo, back = np.unique(lo, return_inverse=True)
            hi_of = np.zeros(len(lo), dtype=np.int64)
            hi_of[back] = hi
            bounds = np.stack([lo, np.minimum(hi_of, len(self.doc) - 1)], axis=1).ravel()
            low = np.minimum.reduceat(self.doc, bounds)[::2]
            at_end = hi_of == len(self.doc)
            low[at_end] = np.minimum(low[at_end], self.doc[-1])
            low = low[back]
            least[live] = low
        return length, least
