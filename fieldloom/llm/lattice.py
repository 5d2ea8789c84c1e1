"""Subword lattices: the probability of a word under a unigram vocabulary, summed over all its segmentations."""

from __future__ import annotations

import math

import numpy as np

from .hashing import U, mix

BASE, SLOT_BITS = U(0x100000001B3), 18
LONG = 4096


class Lattice:
    """Pieces (byte strings; a leading space marks the start of a word) with log probabilities."""

    def __init__(self, pieces: list[bytes], log_p: np.ndarray):
        self.log_p = np.asarray(log_p, dtype=np.float64)
        self.lengths = sorted({len(p) for p in pieces})
        h = np.array([self._hash_one(p) for p in pieces], dtype=U)
        # small tables in turn: pieces whose slot is taken go to the next one, so that a look-up in each finds any piece
        self.tables, left = [], np.arange(len(h))
        while len(left):
            slot, first = np.unique(self._slot(h[left], len(self.tables)), return_index=True)
            table = np.full(1 << SLOT_BITS, -1, dtype=np.int32)
            table[slot] = left[first]
            self.tables.append(table)
            left = np.delete(left, first)
        self.hash = h

    @staticmethod
    def _hash_one(p: bytes) -> int:
        x = 0
        for b in p:
            x = ((x * int(BASE)) + b + 1) & 0xFFFFFFFFFFFFFFFF
        return x

    @staticmethod
    def _slot(h: np.ndarray, turn: int) -> np.ndarray:
        return (mix(h + U(turn * 0x9E3779B9)) >> U(64 - SLOT_BITS)).astype(np.int64)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The piece of each hash, -1 for none."""
        out = np.full(h.shape, -1, dtype=np.int32)
        for turn, table in enumerate(self.tables):
            got = table[self._slot(h, turn)]
            hit = (got >= 0) & (self.hash[got] == h)
            out[hit] = got[hit]
        return out

    def edges(self, block: np.ndarray) -> dict[int, np.ndarray]:
        """block: words of one length as rows of bytes. For each piece length the piece at each start, -1 for none."""
        wide, out = block.astype(U) + U(1), {}
        h, done = np.zeros_like(wide), 0
        for n in self.lengths:
            if n > block.shape[1]:
                break
            while done < n:
                m = block.shape[1] - done
                h = h[:, :m] * BASE + wide[:, done : done + m]
                done += 1
            out[n] = self._find(h)
        return out

    def _weights(self, edges: dict) -> dict:
        return {n: np.where(e >= 0, self.log_p[e], -np.inf) for n, e in edges.items() if (e >= 0).any()}

    @staticmethod
    def _forward(weights: dict, rows: int, m: int) -> np.ndarray:
        a = np.full((m + 1, rows), -np.inf)
        a[0] = 0
        for end in range(1, m + 1):
            terms = [a[end - n] + w[:, end - n] for n, w in weights.items() if n <= end]
            if len(terms) == 1:
                a[end] = terms[0]
            elif terms:
                stack = np.array(terms)
                top = stack.max(axis=0)
                safe = np.where(np.isfinite(top), top, 0.0)
                with np.errstate(divide="ignore"):
                    a[end] = np.log(np.exp(stack - safe).sum(axis=0)) + safe
        return a

    def _long(self, word: bytes, step: int = 1 << 16) -> float:
        """Log probability of one long word, block by block: only the forward values of the last bytes, as many as the longest piece has, go on to
        the next block, scaled so that they stay in range."""
        reach, p = self.lengths[-1], np.exp(self.log_p)
        carry, scale = [0.0] * (reach - 1) + [1.0], 0.0
        for start in range(0, len(word), step):
            left = min(start, reach - 1)
            block = np.frombuffer(word[start - left : start + step], dtype=np.uint8)
            found = [(np.flatnonzero(e[0] >= 0) + n - left, n, e[0]) for n, e in self.edges(block[None]).items()]
            end = np.concatenate([f for f, *_ in found])
            size = np.concatenate([np.full(len(f), n) for f, n, _ in found])
            value = np.concatenate([p[e[e >= 0]] for *_, e in found])
            order = np.argsort(end, kind="stable")
            order = order[end[order] > 0]
            end, size, value = end[order].tolist(), size[order].tolist(), value[order].tolist()
            a, k, most = carry, 0, len(end)
            for e in range(1, len(block) - left + 1):
                total, at = 0.0, reach - 1 + e
                while k < most and end[k] == e:
                    total += a[at - size[k]] * value[k]
                    k += 1
                a.append(total)
                if 0.0 < total < 1e-150:
                    a[at - reach + 1 :] = [x / total for x in a[at - reach + 1 :]]
                    scale += math.log(total)
            carry = a[-reach:]
        return math.log(carry[-1]) + scale if carry[-1] > 0 else -math.inf

    def score(self, words: list[bytes]) -> np.ndarray:
        """Log probability of each word (forward recursion in log space; words above LONG bytes in scaled blocks)."""
        out = np.empty(len(words))
        long = [i for i, w in enumerate(words) if len(w) > LONG]
        for i in long:
            out[i] = self._long(words[i])
        rest = np.delete(np.arange(len(words)), long) if long else np.arange(len(words))
        for at, block in _blocks([words[i] for i in rest]):
            weights = self._weights(self.edges(block))
            out[rest[at]] = self._forward(weights, *block.shape)[-1]
        return out

    def expect(self, words: list[bytes], times: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece when each word occurs so many times (forward and backward). Words above LONG bytes count
        piece by piece of LONG bytes, without the pieces that would cross their ends."""
        total = np.zeros(len(self.log_p))
        if any(len(w) > LONG for w in words):
            times = np.repeat(times, [-(-len(w) // LONG) for w in words])
            words = [w[i : i + LONG] for w in words for i in range(0, len(w), LONG)]
        for at, block in _blocks(words):
            edges = self.edges(block)
            weights = self._weights(edges)
            rows, m = block.shape
            a = self._forward(weights, rows, m)
            back = {n: w[:, ::-1] for n, w in weights.items()}
            b = self._forward(back, rows, m)[::-1]
            ok = np.isfinite(a[-1])
            for n, w in weights.items():
                p = np.exp(a[: m + 1 - n].T[ok] + w[ok] + b[n:].T[ok] - a[-1][ok, None])
                e = edges[n][ok]
                use = e >= 0
                total += np.bincount(e[use], weights=(p * times[at][ok, None])[use], minlength=len(total))
        return total


def _blocks(words: list[bytes], most: int = 250_000):
    """Indices and byte matrix of words of equal length, about `most` bytes at a time."""
    lens = np.array([len(w) for w in words], dtype=np.int64)
    order = np.argsort(lens, kind="stable")
    cuts = np.flatnonzero(np.r_[True, lens[order][1:] != lens[order][:-1], True]) if len(words) else []
    for x, y in zip(cuts[:-1], cuts[1:], strict=True):
        m = int(lens[order[x]])
        step = max(1, most // m)
        for z in range(x, y, step):
            at = order[z : min(y, z + step)]
            yield at, np.frombuffer(b"".join([words[i] for i in at]), dtype=np.uint8).reshape(-1, m)
