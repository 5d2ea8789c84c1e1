"""N-gram Jaccard join by parity sketches, exact.

A document is its set of hashed shingles. XORing the elements into the segments of a sketch makes two sets
that differ in d elements differ in d segments at most, so if both fill more than d segments they agree in one that is not
empty. The number of segments follows from the size band; sets meet in their own band and, near its lower end, in the
band below; sets that fill too few segments are sent again with finer ones.

All segments are counted first. In the one order of rarest first (number of sets that fill a segment alike, ties by value), the
first segment that two such sets share is among the first d + 1 of both, so each set keeps only these: a passage that many
documents share sorts last, and forms groups only of documents that consist of little else. What nobody shares is dropped at once.

Sets that agree in a kept segment are candidates. Their parity sketches (1,024 bits, for long sets 16,384 as well), whose Hamming
distance is at most the symmetric difference, drop most false ones, and shingles are compared for the rest.

Large groups are not multiplied out. Equal sets are one node, and groups of equal members one group. Each member is first
compared with its group's lead only. Where a group is then still in several components, each member is compared with its few nearest sketches in
other components, then with more of them (4, 64, 1,024, ...), until no member has more; pairs whose sketches are too far apart never leave the task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .components import connected_components
from .hashing import U, WordHash, mix, window_hashes, word_hashes
from .linededup import NO_KEY
from .scratch import Scratch, small_side

SKETCH_BITS, WIDE_BITS, WIDE_FROM = 1024, 16384, 1024
LEVELS = 4  # finer and finer segments; at the last every element has its own
TASK_ROWS = 50_000  # members of groups of one lead that one task compares
BLOCK = 2048  # members of a group that one task compares with as many others
SHARE_PAIRS, SHARE_SHINGLES = 500, 1_000_000  # pairs and shingles that one share of a group's verification holds


def shingle_set(text: bytes | None, cache: WordHash, width: int) -> np.ndarray:
    return np.unique(window_hashes(word_hashes(text, cache, True), width))


def set_key(u: np.ndarray) -> int:
    """A signed 64-bit identity of the set."""
    both = mix(np.array([np.bitwise_xor.reduce(u) ^ mix(np.array([u.sum(dtype=U)], dtype=U))[0]], dtype=U))
    return int(both.view(np.int64)[0])


def parity_sketch(u: np.ndarray, bits: int = SKETCH_BITS) -> list[int]:
    """Parity of the number of elements at each of `bits` places, as 64-bit integers."""
    odd = (np.bincount((u & U(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).tolist()


def _apart(n: int, num: int, den: int) -> int:
    """The most elements by which a set of n can differ from one with Jaccard similarity of num / den or more: with m
    elements the difference is at most (n + m)(den - num) / (den + num), and m is at most n * den / num."""
    return n * (den - num) // num


def segments(u: np.ndarray, num: int, den: int) -> list[tuple[int, np.ndarray, int]]:
    """Segments of one set as (tag, values, spare); any two sets with the similarity have a value in common, or are equal.

    The tag names the band and the level. Of its values, in any one order, the last `spare` need not be looked at.
    """
    n = len(u)
    most = _apart(n, num, den)
    if most < 1:
        return []
    out = []
    band = n.bit_length() - 1
    # a smaller partner has at least n * num / den elements
    for b in {band, (-(-n * num // den)).bit_length() - 1}:
        for level in range(LEVELS):
            if level == LEVELS - 1:
                value = mix(u ^ U(0xA5A5 + b))
            else:
                k = (1 << b) << level
                seg = (mix(u ^ U(level + 1)) >> U(8)) % U(k)
                seg = seg.astype(np.uint16 if k <= 1 << 16 else np.int64)
                order = np.argsort(seg, kind="stable")
                seg = seg[order]
                first = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
                value = mix(np.bitwise_xor.reduceat(u[order], first) ^ mix(seg[first].astype(U) + U(((b * LEVELS + level) << 40) + 1)))
            out.append((b * LEVELS + level, value, max(0, len(value) - most - 1)))
            if len(value) > most:
                break
    return out


def signatures(u: np.ndarray, num: int, den: int) -> np.ndarray:
    """The values of all segments."""
    return np.unique(np.concatenate([u[:0], *[v for _, v, _ in segments(u, num, den)]]))


HEAD = np.dtype([("key", "<i8"), ("n", "<u4"), ("spare", "<u4"), ("tag", "<u2")])


def _mapper(width: int, num: int, den: int, parts: int, word_limit: int = 600_000):
    schema = pa.schema([("kind", pa.int32()), ("d", pa.int64()), ("t", pa.int64()), ("n", pa.int64()), ("k", pa.int64()), ("sketch", pa.list_(pa.int64())), ("wide", pa.list_(pa.int64())), ("p", pa.int32()), ("sigs", pa.binary()), ("keys", pa.binary())])

    def pack(sets: list):
        """A row for each part: values (32 bits beside the part), and each set and tag with how many of them are its."""
        if not sets:
            return
        who = np.repeat(np.arange(len(sets)), [len(v) for _, _, v, _ in sets])
        s = np.concatenate([v for _, _, v, _ in sets])
        key, tag, spare = (np.array([x[i] for x in sets], dtype=np.int64) for i in (0, 1, 3))
        part = ((s >> U(32)) % U(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        s, who, part = (s[order] & U(0xFFFFFFFF)).astype(np.uint32), who[order], part[order]
        cuts = np.searchsorted(part, np.arange(parts + 1))
        rows = {name: [] for name in schema.names}
        for p in np.flatnonzero(np.diff(cuts)):
            mine = who[cuts[p] : cuts[p + 1]]
            first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
            head = np.empty(len(first), dtype=HEAD)
            at = mine[first]
            head["key"], head["tag"], head["spare"], head["n"] = key[at], tag[at], spare[at], np.diff(np.r_[first, len(mine)])
            for name, v in zip(schema.names, (1, None, None, None, None, None, None, int(p), s[cuts[p] : cuts[p + 1]].tobytes(), head.tobytes()), strict=True):
                rows[name].append(v)
        yield pa.record_batch(rows, schema=schema)

    def run(batches):
        cache, sets, seen, held = WordHash(), [], set(), 0
        for batch in batches:
            rows = {name: [] for name in schema.names}
            for d, t, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                u = shingle_set(text.as_py(), cache, width)
                k = set_key(u) if len(u) else 0
                for name, v in zip(schema.names, (0, d, t, len(u), k, parity_sketch(u) if len(u) else None, parity_sketch(u, WIDE_BITS) if len(u) >= WIDE_FROM else None, None, None, None), strict=True):
                    rows[name].append(v)
                if len(u) and k not in seen:
                    seen.add(k)
                    for tag, value, spare in segments(u, num, den):
                        sets.append((k, tag, value, spare))
                        held += len(value)
                if held > word_limit:
                    yield from pack(sets)
                    sets, seen, held = [], set(), 0
            yield pa.record_batch(rows, schema=schema)
        yield from pack(sets)

    return run


def _counter():
    """Values of one part to those that two or more sets have: (sig, k, tag, spare, df)."""
    schema = pa.schema([("sig", pa.int64()), ("k", pa.int64()), ("tag", pa.int32()), ("spare", pa.int32()), ("df", pa.int32())])

    def run(table: pa.Table) -> pa.Table:
        sigs = np.concatenate([np.frombuffer(x.as_py(), dtype=np.uint32) for x in table.column("sigs")])
        heads = np.concatenate([np.frombuffer(x.as_py(), dtype=HEAD) for x in table.column("keys")])
        head = np.repeat(np.arange(len(heads), dtype=np.int64), heads["n"])
        order = np.argsort(sigs, kind="stable")
        sigs, head = sigs[order], head[order]
        alike = np.flatnonzero(np.r_[sigs[1:] == sigs[:-1], False] | np.r_[False, sigs[1:] == sigs[:-1]])
        sigs, head = sigs[alike], heads[head[alike]]
        order = np.lexsort((head["tag"], head["key"], sigs))
        sigs, head = sigs[order], head[order]
        # a set that several packs have sent counts once
        new = np.r_[True, (sigs[1:] != sigs[:-1]) | (head["key"][1:] != head["key"][:-1]) | (head["tag"][1:] != head["tag"][:-1])] if len(sigs) else np.zeros(0, dtype=bool)
        sigs, head = sigs[new], head[new]
        first = np.flatnonzero(np.r_[True, sigs[1:] != sigs[:-1]]) if len(sigs) else np.zeros(0, dtype=np.int64)
        df = np.repeat(np.diff(np.r_[first, len(sigs)]), np.diff(np.r_[first, len(sigs)]))
        sigs, head, df = sigs[df > 1], head[df > 1], df[df > 1]
        cols = [(np.int64(table.column("p")[0].as_py()) << 32) | sigs.astype(np.int64), head["key"], head["tag"], head["spare"], df]
        return pa.table([pa.array(np.ascontiguousarray(c), f.type, safe=False) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return run


def _nearest(num: int, den: int, most: int):
    """Members of open groups (gid, i, j, side, k, component, n, sk, wide) to pairs that their sketches allow: for each member its `most` nearest
    ones in other components, over all groups of the task. A row of a null pair tells that there are more."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("g", pa.int64()), ("w", pa.int64())])

    def words(values: pa.Array) -> np.ndarray:
        return values.to_numpy(zero_copy_only=False).view(U)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("gid", "ascending"), ("i", "ascending"), ("j", "ascending")])
        gid, i, j, side, k, comp, n = (table.column(c).to_numpy() for c in ("gid", "i", "j", "side", "k", "component", "n"))
        sk, wide = words(table.column("sk").combine_chunks().flatten()).reshape(len(k), -1), table.column("wide").combine_chunks()
        first = np.flatnonzero(np.r_[True, (gid[1:] != gid[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        end = np.repeat(np.r_[first[1:], len(k)], np.diff(np.r_[first, len(k)]))
        count = end - np.arange(len(k)) - 1
        upto = np.cumsum(count)
        held, more, at = [np.zeros((5, 0), dtype=np.int64)], False, 0

        def compact() -> None:
            """Each pair once at either end, and of each end's partners the nearest `most`."""
            nonlocal held, more
            every = np.concatenate(held, axis=1)
            end, far, other = every[0], every[1], every[2]
            every = every[:, np.lexsort((other, far, end))]
            every = every[:, np.r_[True, (every[0][1:] != every[0][:-1]) | (every[2][1:] != every[2][:-1])]] if every.shape[1] else every
            first = np.flatnonzero(np.r_[True, every[0][1:] != every[0][:-1]]) if every.shape[1] else np.zeros(0, dtype=np.int64)
            rank = np.arange(every.shape[1]) - np.repeat(first, np.diff(np.r_[first, every.shape[1]]))
            more |= bool((rank >= most).any())
            held = [every[:, rank < most]]

        while at < len(k):
            stop = max(at + 1, int(np.searchsorted(upto, upto[at] - count[at] + 250_000, side="right")))
            x = np.repeat(np.arange(at, stop), count[at:stop])
            y = np.arange(len(x)) - np.repeat(upto[at:stop] - count[at:stop] - (upto[at] - count[at]), count[at:stop]) + x + 1
            ok = (comp[x] != comp[y]) & (k[x] != k[y]) & ((i[x] == j[x]) | (side[x] != side[y])) & (n[x] * den >= n[y] * num) & (n[y] * den >= n[x] * num)
            x, y = x[ok], y[ok]
            apart = np.bitwise_count(sk[x] ^ sk[y]).sum(axis=1, dtype=np.int64)
            ok = apart * (den + num) <= (n[x] + n[y]) * (den - num)
            x, y, apart = x[ok], y[ok], apart[ok]
            long = np.flatnonzero((n[x] >= WIDE_FROM) & (n[y] >= WIDE_FROM))
            bad = [p for p in long if np.bitwise_count(words(wide[int(x[p])].values) ^ words(wide[int(y[p])].values)).sum() * (den + num) > (n[x[p]] + n[y[p]]) * (den - num)]
            x, y, apart = np.delete(x, bad), np.delete(y, bad), np.delete(apart, bad)
            w = n[x] + n[y]
            held += [np.stack([k[x], apart, k[y], gid[x], w]), np.stack([k[y], apart, k[x], gid[x], w])]
            if sum(h.shape[1] for h in held) > 1_000_000:
                compact()
            at = stop
        compact()
        end, _, other, g, w = held[0]
        a, b = np.minimum(end, other), np.maximum(end, other)
        _, once = np.unique(np.stack([a, b], axis=1), axis=0, return_index=True)
        pairs = pa.table([pa.array(np.ascontiguousarray(c[once]), pa.int64()) for c in (a, b, g, w)], schema=schema)
        return pa.concat_tables([pairs, pa.table([[None]] * 4, schema=schema)]) if more else pairs

    return run


def _top_bytes(u: np.ndarray) -> bytes:
    """The upper 40 bits of each hash: enough to compare two sets, and less to shuffle."""
    return u.view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()


def _from_top(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 5, 8), dtype=np.uint8)
    wide[:, 3:] = np.frombuffer(blob, dtype=np.uint8).reshape(-1, 5)
    return wide.view(U).ravel()


def _sets(width: int):
    def run(batches):
        cache = WordHash()
        for batch in batches:
            blobs = [_top_bytes(shingle_set(x.as_py(), cache, width)) for x in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(blobs, pa.binary())], names=["k", "set"])

    return run


def _verifier(num: int, den: int):
    """Pairs of one task against the sets that they name."""

    def run(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        of = {k: _from_top(blob.as_py()) for k, blob in zip(sets.column("k").to_pylist(), sets.column("set"), strict=True)}
        keep = []
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True):
            u, v = of[a], of[b]
            both = len(np.intersect1d(u, v, assume_unique=True))
            keep.append(den * both >= num * (len(u) + len(v) - both))
        return pairs.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _may_link(num: int, den: int) -> Column:
    """Sizes and sketches of a pair (na, ska, wa, nb, skb, wb) allow the similarity; two long sets are held against their wide sketches too."""

    def near(x: str, y: str) -> Column:
        apart = F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)
        return apart * (den + num) <= (F.col("na") + F.col("nb")) * (den - num)

    sizes = (F.col("na") * den >= F.col("nb") * num) & (F.col("nb") * den >= F.col("na") * num)
    return sizes & near("ska", "skb") & F.coalesce(near("wa", "wb"), F.lit(True))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, num: int = 3, den: int = 4, parts: int | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, group, and d and t, its key and a hash of its text as in linededup.

    Documents link when the Jaccard similarity of their sets of `width`-word shingles (A-Z lower-cased) is num / den or
    more; component_id is the smallest doc_id that links reach. group names the component also where keys repeat; it is null for an empty set.

    Edge cases: with fewer words the whole sequence is the one shingle; without words or text the set is empty and links
    with nothing; a null key stands last and is null again in the result; each row gets a result of its own, repeated rows equal ones; other columns are ignored; an empty
    table gives an empty table.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "parity")
    body = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("d"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("t"), F.col(text).cast("binary").alias("text"))
    if parts is None:
        # signatures of 40 MB of text at most in a part (some 3 million), so a part fits a task at any size of the corpus;
        # no more parts than that, for each set repeats its key in every part
        chars = body.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(48, chars // 40_000_000)
    mapped = "kind int, d bigint, t bigint, n bigint, k bigint, sketch array<bigint>, wide array<bigint>, p int, sigs binary, keys binary"
    out = scratch.write(body.mapInArrow(_mapper(width, num, den, parts), mapped), "mapped", by="kind")
    base = out.filter("kind = 0").select("d", "t", "n", "k", "sketch", "wide")
    shared = out.filter("kind = 1").select("p", "sigs", "keys").groupBy("p").applyInArrow(_counter(), "sig bigint, k bigint, tag int, spare int, df int")
    # rarest first: the `spare` most frequent segments of a set are left out; those that no other set has come before all of these
    last = W.partitionBy("k", "tag").orderBy(F.col("df").desc(), F.col("sig").desc())
    prefix = shared.withColumn("r", F.row_number().over(last)).filter("r > spare").select("sig", "k")
    prefix = scratch.write(prefix, "prefix")
    scratch.drop("mapped/kind=1")
    # groups of equal members are one; its lead is its least member by one of two hashes, so a family of sets has two leads at least
    draw = F.struct(F.xxhash64(F.pmod("sig", F.lit(2)), "k").alias("h"), "k")
    each = prefix.groupBy("sig").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("k")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "k")).alias("y"), F.min(draw).alias("lead"))
    groups = each.filter("m > 1").groupBy("m", "x", "y").agg(F.min(F.struct("sig", "lead")).alias("g")).select("g.sig", F.col("g.lead.k").alias("lead"))
    members = scratch.write(prefix.join(groups, "sig").select(F.col("sig").alias("gid"), "lead", "k"), "members")
    scratch.drop("prefix")
    stars = members.filter("k <> lead").select(F.col("lead").alias("a"), F.col("k").alias("b")).distinct()

    nodes = base.filter("n > 0").groupBy("k").agg(F.min(F.struct("d", "t")).alias("first"), F.max("n").alias("n"), F.first("sketch").alias("sk"), F.first("wide").alias("wide"))
    nodes = scratch.write(nodes.select("k", "first.d", "first.t", "n", "sk", "wide"), "nodes")

    def verified(near: DataFrame, name: str) -> DataFrame:
        """near: a, b, g (a group that both are in), w (shingles of both). The pairs that link.

        Pairs of one group are verified together, so that a set goes to few tasks; a group of more pairs or shingles than a share
        holds is split, and the shares are dealt to as many tasks as all of them need.
        """
        near = scratch.write(near.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("g").alias("g"), F.max("w").alias("w")), f"{name}-near")
        load = near.groupBy("g").agg(F.greatest(F.ceil(F.count(F.lit(1)) / SHARE_PAIRS), F.ceil(F.sum("w") / SHARE_SHINGLES)).alias("shares")).filter("shares > 1")
        load = scratch.write(load, f"{name}-load")
        n, w = near.agg(F.count(F.lit(1)), F.coalesce(F.sum("w"), F.lit(0))).first()
        buckets = max(256, 2 * n // SHARE_PAIRS, 2 * w // SHARE_SHINGLES)
        share = F.pmod(F.xxhash64("a", "b"), F.coalesce("shares", F.lit(1).cast("long")))
        tasks = near.join(small_side(load), "g", "left").select("a", "b", F.pmod(F.xxhash64("g", share), F.lit(buckets)).alias("task"))
        ends = tasks.select("task", F.explode(F.array("a", "b")).alias("k")).distinct()
        ends = scratch.write(ends, f"{name}-ends")
        texts = scratch.write(ends.select("k").distinct().join(nodes.select("k", "d", "t"), "k"), f"{name}-texts")
        held = body.join(small_side(texts), ["d", "t"]).select("k", "text").dropDuplicates(["k"]).mapInArrow(_sets(width), "k bigint, set binary")
        sets = scratch.write(held, f"{name}-sets")
        sent = ends.join(sets, "k").select("task", "k", "set")
        links = tasks.groupBy("task").cogroup(sent.groupBy("task")).applyInArrow(_verifier(num, den), "a bigint, b bigint")
        links = scratch.write(links, f"{name}-links")
        scratch.drop(f"{name}-sets")
        return links

    def with_ends(pairs: DataFrame) -> DataFrame:
        left = nodes.select(F.col("k").alias("a"), F.col("n").alias("na"), F.col("sk").alias("ska"), F.col("wide").alias("wa"))
        right = nodes.select(F.col("k").alias("b"), F.col("n").alias("nb"), F.col("sk").alias("skb"), F.col("wide").alias("wb"))
        return pairs.join(left, "a").join(right, "b")

    def grown(comp: DataFrame, links: DataFrame, name: str) -> DataFrame:
        """Components (node, component) after more links."""
        joined = comp.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)
        return scratch.write(connected_components(joined, scratch, f"cc-{name}"), f"comp-{name}")

    near = with_ends(stars).filter(_may_link(num, den)).select("a", "b", F.col("a").alias("g"), (F.col("na") + F.col("nb")).alias("w"))
    comp = scratch.write(connected_components(verified(near, "star"), scratch, "cc-star"), "comp-star")
    turn, most = 0, 4
    while True:
        # members of one group in different components: these pairs are still open
        placed = members.join(comp.select(F.col("node").alias("k"), "component"), "k", "left").select("gid", "lead", "k", F.coalesce("component", "k").alias("component"))
        mixed = placed.groupBy("gid", "lead").agg(F.count(F.lit(1)).alias("m"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
        mixed = scratch.write(mixed.select("gid", "lead", F.ceil(F.col("m") / BLOCK).alias("blocks"), "m"), f"mixed{turn}")
        # groups of one lead overlap, so they go to one task, or to as many as their members fill
        load = mixed.groupBy("lead").agg(F.ceil(F.sum(F.col("m") * F.col("blocks")) / TASK_ROWS).alias("shares"))
        mixed = mixed.join(load, "lead").drop("lead")
        rows = mixed.agg(F.coalesce(F.sum(F.col("m") * F.col("blocks")), F.lit(0))).first()[0]
        # a group of more than BLOCK members is compared block by block
        mine = F.pmod(F.xxhash64(F.lit(turn), "k"), F.col("blocks"))
        opened = placed.join(mixed, "gid").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        home = F.xxhash64("lead", F.pmod(F.xxhash64("gid", F.least("mine", "other"), F.greatest("mine", "other")), F.col("shares")))
        opened = opened.select(F.pmod(home, F.lit(max(256, 2 * rows // TASK_ROWS))).alias("task"), "gid", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), (F.col("mine") > F.col("other")).cast("int").alias("side"), "k", "component")
        opened = opened.join(nodes.select("k", "n", "sk", "wide"), "k")
        found = opened.groupBy("task").applyInArrow(_nearest(num, den, most), "a bigint, b bigint, g bigint, w bigint")
        found = scratch.write(found, f"found{turn}")
        links = verified(found.filter("a is not null"), f"more{turn}")
        if not links.isEmpty():
            comp = grown(comp, links, f"more{turn}")
        if found.filter("a is null").isEmpty():
            break
        turn, most = turn + 1, most * 16
    final = comp
    classes = nodes.select("k", "d").join(final.select(F.col("node").alias("k"), "component"), "k", "left").withColumn("component", F.coalesce("component", "k"))
    smallest = classes.groupBy("component").agg(F.min("d").alias("smallest"))
    classes = classes.join(smallest, "component").select(F.col("k").alias("ck"), "smallest", "component")
    docs_k = base.select("d", "t", "n", F.when(F.col("n") > 0, F.col("k")).alias("k"))
    done = docs_k.join(classes, F.col("k") == F.col("ck"), "left").select("d", "t", "n", F.coalesce("smallest", "d").alias("c"), "component")
    real = lambda c: F.when(F.col(c) != NO_KEY, F.col(c))
    return done.select(real("d").alias("doc_id"), F.col("n").alias("n_shingles"), real("c").alias("component_id"), F.col("component").alias("group"), "d", "t")
