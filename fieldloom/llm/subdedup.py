"""Substring dedup by a compressed FM-index for each shard.

1. Route. Each window of `width` words has a 64-bit hash; hashes seen in several documents name, for each later document, a
   smaller one that seems to hold the window (its owner). This only decides which shard has to be asked.
2. Index. Owners are dealt to shards of bounded size, and each shard gets an FM-index over the words of its documents.
3. Search. The suspected runs of each document are streamed past the index of their shard: backward search over the
   wavelet matrix gives the matching statistic at each position, and the document array the smallest document that holds
   the match. Windows of `width` words matched in a smaller document make up the reported intervals.

Documents with equal texts are settled before that: of equal ones all but the smallest are covered whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fmindex import FMIndex
from .hashing import U, WordHash, window_hashes, word_hashes
from .linededup import NO_KEY
from .scratch import Scratch, small_side

SIG, POS = np.dtype("<u8"), np.dtype("<u4")
HEAD = np.dtype([("d", "<i8"), ("t", "<i8"), ("n", "<u4")])
HIT = np.dtype([("pos", "<u4"), ("owner", "<i8")])


def _pack_pos(pos: np.ndarray) -> bytes:
    """Positions byte plane by byte plane, so the high bytes compress."""
    return np.ascontiguousarray(pos, dtype=POS).view(np.uint8).reshape(-1, POS.itemsize).T.tobytes()


def _unpack_pos(x: bytes) -> np.ndarray:
    return np.frombuffer(x, dtype=np.uint8).reshape(POS.itemsize, -1).T.copy().view(POS)[:, 0]


def _heads(d: np.ndarray, t: np.ndarray) -> bytes:
    """Runs of equal (d, t)."""
    change = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (t[1:] != t[:-1])]) if len(d) else np.zeros(0, dtype=np.int64)
    heads = np.empty(len(change), dtype=HEAD)
    heads["d"], heads["t"], heads["n"] = d[change], t[change], np.diff(np.r_[change, len(d)])
    return heads.tobytes()


def _hit_rows(d: np.ndarray, t: np.ndarray, pos: np.ndarray, owner: np.ndarray, rows: dict) -> None:
    """Adds one row for each (d, t) with its hits."""
    order = np.lexsort((t, d))
    d, t, pos, owner = d[order], t[order], pos[order], owner[order]
    hits = np.empty(len(d), dtype=HIT)
    hits["pos"], hits["owner"] = pos, owner
    first = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (t[1:] != t[:-1])]) if len(d) else []
    for a, b in zip(first, [*first[1:], len(d)], strict=True) if len(d) else ():
        rows["d"].append(int(d[a]))
        rows["t"].append(int(t[a]))
        rows["hits"].append(hits[a:b].tobytes())


def _mapper(width: int, parts: int, limit: int = 1_000_000):
    schema = pa.schema([("p", pa.int32()), *[(n, pa.binary()) for n in ("sigs", "pos", "heads", "hit_pos", "hit_owner", "hit_heads")]])

    def pack(ds: list, ts: list, hs: list):
        if not hs:
            return
        lens = [len(h) for h in hs]
        d, t = np.repeat(np.array(ds, dtype=np.int64), lens), np.repeat(np.array(ts, dtype=np.int64), lens)
        h, pos = np.concatenate(hs), np.concatenate([np.arange(n, dtype=np.uint32) for n in lens])
        order = np.argsort(h)
        sorted_h = h[order]
        first = np.flatnonzero(np.r_[True, sorted_h[1:] != sorted_h[:-1]])
        low = np.empty_like(d)
        low[order] = np.repeat(np.minimum.reduceat(d[order], first), np.diff(np.r_[first, len(h)]))
        rows = {name: [] for name in schema.names}
        # within the pack the smallest document is owner of the others' windows; only its own are compared with other packs
        later = d > low
        # the hits go by text, so those of a hot window are spread
        part = np.where(later, t % parts, ((h >> U(32)) % U(parts)).astype(np.int64))
        # rows stand by document and position, and a stable sort by part leaves them so
        place = 2 * part + later
        order = np.argsort(place.astype(np.uint16) if parts < 1 << 15 else place, kind="stable")
        h, d, t, pos, low, later, part = h[order], d[order], t[order], pos[order], low[order], later[order], part[order]
        cuts = np.searchsorted(part, np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(cuts)):
            a, b = cuts[p], cuts[p + 1]
            m = b - np.count_nonzero(later[a:b])
            own = (h[a:m].tobytes(), _pack_pos(pos[a:m]), _heads(d[a:m], t[a:m]))
            hit = (_pack_pos(pos[m:b]), low[m:b].tobytes(), _heads(d[m:b], t[m:b]))
            for name, v in zip(schema.names, (int(p), *own, *hit), strict=True):
                rows[name].append(v)
        yield pa.record_batch(rows, schema=schema)

    def run(batches):
        cache, ds, ts, hs, held = WordHash(), [], [], [], 0
        for batch in batches:
            for d, t, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                h = word_hashes(text.as_py(), cache, False)
                if len(h) >= width:
                    ds.append(d)
                    ts.append(t)
                    hs.append(window_hashes(h, width))
                    held += len(hs[-1])
                if held > limit:
                    yield from pack(ds, ts, hs)
                    ds, ts, hs, held = [], [], [], 0
        yield from pack(ds, ts, hs)

    return run


def _router():
    def run(table: pa.Table) -> pa.Table:
        def flat(name, read):
            return np.concatenate([read(x.as_py()) for x in table.column(name)])

        def spread(name):
            heads = flat(name, lambda x: np.frombuffer(x, dtype=HEAD))
            return np.repeat(heads["d"], heads["n"]), np.repeat(heads["t"], heads["n"])

        sig, pos, (d, t) = flat("sigs", lambda x: np.frombuffer(x, dtype=SIG)), flat("pos", _unpack_pos), spread("heads")
        order = np.argsort(sig)
        sig = sig[order]
        first = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        low = np.empty_like(d)
        low[order] = np.repeat(np.minimum.reduceat(d[order], first), np.diff(np.r_[first, len(sig)])) if len(sig) else sig.astype(np.int64)
        later = d > low
        d0, t0 = spread("hit_heads")
        pos0, low0 = flat("hit_pos", _unpack_pos), flat("hit_owner", lambda x: np.frombuffer(x, dtype="<i8"))
        rows = {"d": [], "t": [], "hits": []}
        _hit_rows(np.r_[d0, d[later]], np.r_[t0, t[later]], np.r_[pos0, pos[later]], np.r_[low0, low[later]], rows)
        return pa.table(rows, schema=pa.schema([("d", pa.int64()), ("t", pa.int64()), ("hits", pa.binary())]))

    return run


def _owners(batches):
    """The owners that a row of hits names, each once, with its number of hits."""
    for batch in batches:
        rows = {"owner": [], "n": []}
        for x in batch.column(0):
            who, n = np.unique(np.frombuffer(x.as_py(), dtype=HIT)["owner"], return_counts=True)
            rows["owner"] += who.tolist()
            rows["n"] += n.tolist()
        yield pa.record_batch(rows, schema=pa.schema([("owner", pa.int64()), ("n", pa.int64())]))


def shard_of(d: np.ndarray, shards: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((d.astype(np.int64).view(U) * U(0x9E3779B97F4A7C15) >> U(20)) % U(shards)).astype(np.int64)


def _shard_column(batches, shards: int):
    for batch in batches:
        d = batch.column(0).to_numpy(zero_copy_only=False)
        yield pa.record_batch([batch.column(0), pa.array(shard_of(d, shards), pa.int64()), *batch.columns[1:]], names=["d", "shard", *batch.schema.names[1:]])


def _indexer(width: int):
    def run(table: pa.Table) -> pa.Table:
        cache = WordHash()
        docs = [(d, word_hashes(x.as_py(), cache, False)) for d, x in zip(table.column("d").to_pylist(), table.column("text"), strict=True)]
        return pa.table({"shard": [table.column("shard")[0].as_py()], "index": [FMIndex.build(docs, width).dump()]}, schema=pa.schema([("shard", pa.int64()), ("index", pa.binary())]))

    return run


def _query_runs(width: int, shards: int):
    """Texts with their hits to runs of word hashes for each shard: (shard, d, t, start, run)."""
    schema = pa.schema([("shard", pa.int64()), ("d", pa.int64()), ("t", pa.int64()), ("start", pa.int64()), ("run", pa.binary())])

    def run(batches):
        cache = WordHash()
        for batch in batches:
            rows = {name: [] for name in schema.names}
            for d, t, text, hits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = word_hashes(text, cache, False)
                hit = np.unique(np.concatenate([np.frombuffer(x, dtype=HIT) for x in hits]))
                shard = shard_of(np.ascontiguousarray(hit["owner"]), shards)
                order = np.lexsort((hit["pos"], shard))
                pos, shard = hit["pos"][order].astype(np.int64), shard[order]
                first = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (pos[1:] > pos[:-1] + 1)])
                for a, b in zip(first, [*first[1:], len(pos)], strict=True):
                    for name, v in zip(schema.names, (int(shard[a]), d, t, int(pos[a]), words[pos[a] : pos[b - 1] + width].tobytes()), strict=True):
                        rows[name].append(v)
            yield pa.record_batch(rows, schema=schema)

    return run


def _searcher(width: int):
    def run(key, queries: pa.Table, index: pa.Table) -> pa.Table:
        rows = {"d": [], "t": [], "starts": []}
        if queries.num_rows and index.num_rows:
            fm = FMIndex.load(index.column("index")[0].as_py())
            at = 0
            while at < queries.num_rows:
                # some 500,000 words at a time
                runs, d, t, start, held = [], [], [], [], 0
                while at < queries.num_rows and held < 500_000:
                    runs.append(np.frombuffer(queries.column("run")[at].as_py(), dtype=U))
                    held += len(runs[-1])
                    d.append(queries.column("d")[at].as_py())
                    t.append(queries.column("t")[at].as_py())
                    start.append(queries.column("start")[at].as_py())
                    at += 1
                lens = np.array([len(r) for r in runs])
                base = np.cumsum(lens) - lens
                count = lens - width + 1
                who = np.repeat(np.arange(len(runs)), count)
                offset = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
                length, least = fm.statistics(fm.symbols(np.concatenate(runs)), base[who] + offset + width, width)
                good = (length >= width) & (least < np.array(d, dtype=np.int64)[who])
                who, offset = who[good], offset[good]
                cuts = np.searchsorted(who, np.arange(len(runs) + 1))
                for i in np.flatnonzero(np.diff(cuts)):
                    rows["d"].append(d[i])
                    rows["t"].append(t[i])
                    rows["starts"].append((offset[cuts[i] : cuts[i + 1]] + start[i]).astype(np.uint32).tobytes())
        return pa.table(rows, schema=pa.schema([("d", pa.int64()), ("t", pa.int64()), ("starts", pa.binary())]))

    return run


def _cutter(width: int):
    """(key, text, copy, starts) to (key, n_words, n_removed, kept)."""

    def run(batches):
        for batch in batches:
            rows = {"key": batch.column(0).to_pylist(), "n_words": [], "n_removed": [], "kept": []}
            for text, copy, starts in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                words = (text or b"").split()
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                if copy and len(words) >= width:
                    gone[:] = 1
                elif starts:
                    s = np.unique(np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in starts])).astype(np.int64)
                    np.add.at(gone, s, 1)
                    np.add.at(gone, s + width, -1)
                    gone = np.cumsum(gone)
                gone = gone[: len(words)] > 0
                rows["n_words"].append(len(words))
                rows["n_removed"].append(int(gone.sum()))
                rows["kept"].append(b" ".join([w for w, g in zip(words, gone, strict=True) if not g] if gone.any() else words))
            yield pa.record_batch(rows, schema=pa.schema([("key", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())]))

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 13, shard_words: int = 1_000_000) -> DataFrame:
    """One row for each row of docs: key, n_words, n_removed, kept (words left, joined by one space).

    A word goes if it is covered by a window of `width` consecutive words that also starts in a document with a smaller key.
    Windows are judged on the input.

    Edge cases: null and empty texts have no words; a text shorter than `width` loses nothing; rows with one key are one document and do
    not cut each other; null keys are one document that stands last; an empty table gives an empty table; other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    full = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("d"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("t"), F.col(text).cast("binary").alias("text"))
    ids = full.select("d", "t", F.xxhash64(F.lit("second"), "text").alias("t2"), F.octet_length("text").alias("size"))
    ids = scratch.write(ids, "ids")
    firsts = ids.groupBy("t", "t2").agg(F.min("d").alias("first"), F.max("d").alias("last")).filter("first < last").drop("last")
    copies = scratch.write(ids.join(firsts, ["t", "t2"]).filter("d > first").select("d", "t").distinct(), "copies")
    size = ids.agg(F.sum("size")).first()[0] or 0
    # windows of 40 MB of text at most in a part (some 6 million); a document repeats its key in every part
    parts = max(48, size // 40_000_000)

    body = full.select("d", "t", "text").join(small_side(copies), ["d", "t"], "left_anti")
    # the anti join leaves rows in file order or sorted by (d, t), so a repeated task packs alike
    mapped = body.mapInArrow(_mapper(width, parts), "p int, sigs binary, pos binary, heads binary, hit_pos binary, hit_owner binary, hit_heads binary")
    hits = scratch.write(mapped.groupBy("p").applyInArrow(_router(), "d bigint, t bigint, hits binary"), "hits")

    owners = hits.select("hits").mapInArrow(_owners, "owner bigint, n bigint").groupBy(F.col("owner").alias("d")).agg(F.sum("n").alias("n"))
    owners = scratch.write(owners, "owners")
    owned = full.select("d", "t", "text").join(small_side(copies), ["d", "t"], "left_anti").join(small_side(owners.select("d")), "d")
    owner_bytes = ids.join(owners, "d").agg(F.sum("size")).first()[0] or 0
    shards = max(1, int(owner_bytes // (6 * shard_words)) + 1)
    sharded = owned.select("d", "text").mapInArrow(lambda b: _shard_column(b, shards), "d bigint, shard bigint, text binary")
    index = scratch.write(sharded.groupBy("shard").applyInArrow(_indexer(width), "shard bigint, index binary"), "index")

    # a shard that many documents ask is searched by several tasks
    load = owners.select("d", "n").mapInArrow(lambda b: _shard_column(b, shards), "d bigint, shard bigint, n bigint")
    load = small_side(scratch.write(load.groupBy("shard").agg(F.ceil(F.sum("n") / F.lit(2_000_000)).alias("salts")), "load"))
    who = scratch.write(hits.select("d", "t").distinct(), "who")
    asked = hits.groupBy("d", "t").agg(F.collect_list("hits").alias("hits"))
    texts = body.join(small_side(who), ["d", "t"])
    texts = texts.dropDuplicates(["d", "t"]).join(asked, ["d", "t"]).select("d", "t", "text", "hits")
    runs = texts.mapInArrow(_query_runs(width, shards), "shard bigint, d bigint, t bigint, start bigint, run binary")
    runs = runs.join(load, "shard").withColumn("salt", F.pmod(F.xxhash64("d"), F.col("salts")))
    left = runs.select("shard", "salt", "d", "t", "start", "run").groupBy("shard", "salt")
    right = index.join(load, "shard").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), "index").groupBy("shard", "salt")
    found = scratch.write(left.cogroup(right).applyInArrow(_searcher(width), "d bigint, t bigint, starts binary"), "found")
    scratch.drop("index")
    scratch.drop("hits")

    cut = scratch.write(found.select("d", "t").distinct(), "cut")
    starts = found.groupBy("d", "t").agg(F.collect_list("starts").alias("starts"))
    marked = full.join(small_side(copies.withColumn("copy", F.lit(True))), ["d", "t"], "left").select("key", "d", "t", "text", F.coalesce("copy", F.lit(False)).alias("copy"))
    whole = marked.join(small_side(cut), ["d", "t"], "left_anti").select("key", "text", "copy", F.lit(None).cast("array<binary>").alias("starts"))
    parted = marked.join(small_side(cut), ["d", "t"]).join(starts, ["d", "t"]).select("key", "text", "copy", "starts")
    done = whole.unionByName(parted).mapInArrow(_cutter(width), "key bigint, n_words bigint, n_removed bigint, kept binary")
    return done.select("key", "n_words", "n_removed", F.col("kept").cast("string").alias("kept"))
