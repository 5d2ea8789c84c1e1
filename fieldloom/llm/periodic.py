"""Periodic run detection: stretches of words that repeat with a period, maximal, with their smallest period.

A run of period q and length L >= max(least, 2 q) holds each of its words twice at least. So a word that occurs once in its segment is in no
run of that segment and splits it; the pieces are looked at again until no segment has such a word (pieces shorter than `least` hold no run and go).
The surviving segments are scanned by lag: a run of period q is a stretch of L - q places that agree with the place q further on.

Lags below 16 are compared at every place. For larger ones, class [2h, 4h) with h = 8, 16, 32 ...: such a run holds, at a multiple of h in its first h
places, h words that come again q further on, still inside it. Occurrences of the same h words form chains (gaps of h/2 or less: within a
chain the gap is the period p of these words). If both occurrences are in one chain, the run has period p, which is no new run. If not, the chains' first or last
occurrences are q apart, or the two chains' stretches touch and q is their distance plus a multiple of p. So each pair of neighbouring chains proposes a
few lags, and each proposal is extended both ways by ranks of words, pairs, fours, eights ... (equal ranks: equal words), which is exact.
All of it works on the words of many documents at once; a document is never cut.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL = 16
GROUP_WORDS = 400_000
GROUP_BYTES = 16_000_000
SCHEMA = pa.schema([
    ("key", pa.int64()),
    ("n_words", pa.int64()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
    ("kept", pa.string()),
])


def split_rare(w: np.ndarray, lo: np.ndarray, hi: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments [lo, hi) of w, split at words that occur once in their segment until no segment has any; those of `least` words or more."""
    done_lo, done_hi, base = [], [], int(w.max(initial=0)) + 1
    while True:
        fit = hi - lo >= least
        lo, hi = lo[fit], hi[fit]
        if not len(lo):
            break
        size = hi - lo
        seg = np.repeat(np.arange(len(lo)), size)
        at = np.arange(size.sum()) + np.repeat(lo - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        key = seg * base + w[at]
        order = np.argsort(key, kind="stable")
        k = key[order]
        other = np.concatenate(([True], k[1:] != k[:-1], [True]))
        lone = np.sort(order[other[:-1] & other[1:]])
        touched = np.bincount(seg[lone], minlength=len(lo)) > 0
        done_lo.append(lo[~touched])
        done_hi.append(hi[~touched])
        # pieces between lone words and the ends of touched segments
        cut = at[lone]
        lo, hi = np.sort(np.concatenate((lo[touched], cut + 1))), np.sort(np.concatenate((hi[touched], cut)))
    return np.concatenate(done_lo or [lo]), np.concatenate(done_hi or [hi])


def _stretches(same: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the stretches of True with `need` places or more."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
    start, end = edge[::2], edge[1::2]
    long = end - start >= need
    return start[long], (end - start)[long]


def _dense(key: np.ndarray) -> np.ndarray:
    return np.unique(key, return_inverse=True)[1]


def _repeats(rank: np.ndarray) -> np.ndarray:
    return np.bincount(rank)[rank] > 1


def _extend(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many places before and from i on agree with those before and from j on (i < j)."""
    m, ahead, back = len(ranks[0]), np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        step, r = 1 << k, ranks[k]
        a, b = i + ahead, j + ahead
        ok = b + step <= m
        ok[ok] = r[a[ok]] == r[b[ok]]
        ahead[ok] += step
        a, b = i - back - step, j - back - step
        ok = a >= 0
        ok[ok] = r[a[ok]] == r[b[ok]]
        back[ok] += step
    return back, ahead


def _propose(rank: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags in [2h, 4h) that chains of equal h-grams propose."""
    at = np.flatnonzero(_repeats(rank))
    at = at[np.argsort(rank[at], kind="stable")]
    r = rank[at]
    new = np.concatenate(([True], (r[1:] != r[:-1]) | (at[1:] - at[:-1] > h // 2)))
    begin = np.flatnonzero(new)
    last = np.concatenate((begin[1:], [len(at)])) - 1
    gram, first, final = r[begin], at[begin], at[last]
    anchored = np.add.reduceat((at % h == 0).astype(np.int64), begin) > 0
    period = np.where(last > begin, at[np.minimum(begin + 1, len(at) - 1)] - first, 0)
    places, lags = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def add(place, lag):
        fit = (lag >= 2 * h) & (lag < 4 * h)
        places.append(place[fit])
        lags.append(lag[fit])

    for t in range(1, 9):
        if t >= len(gram):
            break
        a = np.flatnonzero(anchored[:-t] & (gram[:-t] == gram[t:]))
        add(first[a], first[a + t] - first[a])
        add(final[a], final[a + t] - final[a])
        if t == 1:
            p = np.maximum(period[a], period[a + 1])
            gap = first[a + 1] - final[a]
            a, gap, p = (x[(gap < 2 * h) & (p > 0)] for x in (a, gap, p))
            count = 4 * h // np.maximum(p, 1) + 1
            nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            lag = np.repeat(gap, count) + nth * np.repeat(p, count)
            inside = lag <= np.repeat(final[a + 1] - first[a], count)
            add(np.repeat(final[a], count)[inside], lag[inside])
    return np.concatenate(places), np.concatenate(lags)


def _may_repeat(u: np.ndarray, seg: np.ndarray) -> np.ndarray:
    """Segments in which eight words come again SMALL places or more further on (by 64-bit hashes, so some too many)."""
    if len(u) < 8:
        return np.zeros(0, np.int64)
    x = u.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    n, acc = len(u) - 7, np.zeros(len(u) - 7, np.uint64)
    for k in range(8):
        acc = (acc ^ x[k : k + n]) * np.uint64(0xBF58476D1CE4E5B9)
        acc ^= acc >> np.uint64(31)
    order = np.argsort(acc, kind="stable")
    a = acc[order]
    new = np.concatenate(([True], a[1:] != a[:-1], [True]))
    begin, end = np.flatnonzero(new[:-1]), np.flatnonzero(new[1:])
    wide = order[end] - order[begin] >= SMALL
    # the first and the last of equal eights, and all between: whichever segment they are in
    inner = np.repeat(wide, end - begin + 1)
    return np.unique(seg[order[inner]])


def find_runs(w: np.ndarray, lo: np.ndarray, hi: np.ndarray, least: int = 12) -> np.ndarray:
    """Runs in the documents [lo, hi) of the word numbers w: rows (start, length, period) by start, then period; start counts in w."""
    lo, hi = split_rare(w, lo, hi, least)
    if not len(lo):
        return np.zeros((0, 3), np.int64)

    def join(lo, hi):
        # segments end to end, each followed by a number of its own, so no stretch goes from one to the next
        size = hi - lo + 1
        seg = np.repeat(np.arange(len(lo)), size)
        place = np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)
        ends = np.cumsum(size) - 1
        u = w[np.minimum(place, len(w) - 1)].astype(np.int64)
        u[ends] = int(w.max()) + 1 + np.arange(len(lo))
        return u, seg, place

    found = []

    def keep(start, length, period, place):
        found.append(np.stack((place[start], length, period), axis=1))

    u, seg, place = join(lo, hi)
    for q in range(1, min(SMALL, len(u))):
        start, n = _stretches(u[:-q] == u[q:], max(least - q, q))
        keep(start, n + q, np.full(len(start), q), place)
    big = _may_repeat(u, seg)
    if len(big):
        u, seg, place = join(lo[big], hi[big])
        ranks, h = [_dense(u)], 1
        while 2 * h <= len(u) and _repeats(ranks[-1]).any():
            r = ranks[-1]
            ranks.append(_dense(r[:-h] * (int(r.max()) + 1) + r[h:]))
            h *= 2
        places, lags = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in range(3, len(ranks)):
            if _repeats(ranks[k]).any():
                p, q = _propose(ranks[k], 1 << k)
                places.append(p)
                lags.append(q)
        i, q = np.concatenate(places), np.concatenate(lags)
        fit = i + q < len(u)
        i, q = i[fit], q[fit]
        back, ahead = _extend(ranks, i, i + q)
        fit = back + ahead + q >= np.maximum(least, 2 * q)
        keep((i - back)[fit], (back + ahead + q)[fit], q[fit], place)
    runs = np.concatenate(found)
    # the same stretch with a multiple of its period comes after it
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.concatenate(([True], (runs[1:, :2] != runs[:-1, :2]).any(axis=1))) if len(runs) else np.zeros(0, bool)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapse(least: int):
    def run(batches):
        keys, split, words, held = [], [], 0, 0

        def flush():
            nonlocal keys, split, words, held
            if not keys:
                return None
            number = defaultdict()
            number.default_factory = number.__len__
            sizes = np.array([len(x) for x in split], np.int64)
            w = np.fromiter((number[x] for own in split for x in own), np.int64, count=int(sizes.sum()))
            hi = np.cumsum(sizes)
            lo = hi - sizes
            runs = find_runs(w, lo, hi, least) if len(w) else np.zeros((0, 3), np.int64)
            drop = np.zeros(len(w) + 1, np.int64)
            np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
            np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
            gone = np.cumsum(drop)[:-1] > 0
            owner = np.searchsorted(hi, runs[:, 0], side="right")
            offsets = np.searchsorted(owner, np.arange(len(keys) + 1))
            fields = [pa.array(x) for x in (runs[:, 0] - lo[owner] if len(runs) else runs[:, 0], runs[:, 1].copy(), runs[:, 2].copy())]
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, names=["start", "length", "period"]))
            has = np.diff(offsets) > 0
            kept = [b" ".join([x for x, g in zip(own, gone[a:b].tolist(), strict=True) if not g] if r else own) for own, a, b, r in zip(split, lo, hi, has, strict=True)]
            out = pa.record_batch([pa.array(keys, pa.int64()), pa.array(sizes), lists.cast(SCHEMA.field("runs").type), pa.array(kept, pa.binary()).cast(pa.string())], schema=SCHEMA)
            keys, split, words, held = [], [], 0, 0
            return out

        for batch in batches:
            for key, text in zip(*batch.columns, strict=True):
                body = text.as_py() or b""
                keys.append(key.as_py())
                split.append(body.split())
                words, held = words + len(split[-1]), held + len(body)
                if words >= GROUP_WORDS or held >= GROUP_BYTES:
                    yield flush()
        rest = flush()
        if rest is not None:
            yield rest

    return run


def collapse_runs(docs: DataFrame, key: str = "doc_id", text: str | Column = "text", least: int = 12) -> DataFrame:
    """key, n_words, runs (start, length, period in words; by start, then period) and kept (the words left, one space between) for each row.

    A run is maximal, has its smallest period q and max(least, 2 q) words or more; of each run the first q words stay. No row is shuffled; a task
    holds some 400,000 words, or one document.

    Edge cases: null or empty text, or white space alone: no words, no runs, kept empty; null keys stay; repeated rows are rows of
    their own; other columns are ignored, whatever their names; an empty table gives no rows. Keys are whole numbers.
    """
    body = F.col(text) if isinstance(text, str) else text
    given = docs.select(F.col(key).cast("long").alias("key"), body.cast("binary").alias("text"))
    return given.mapInArrow(_collapse(least), "key bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, kept string")
