"""LM scoring by subword lattice likelihood.

The vocabulary is that of a public tokenizer. Its scores (merge ranks) weigh the pieces at first; expectation
maximisation over the distinct words of the training documents, each once, turns them into unigram probabilities. A
word's lattice probability sums over all its segmentations into pieces. Words of the training documents are one more
edge over their whole lattice: P(w) = max(c - D, 0) / N + D * V / N * lattice(w), with the absolute discount D = n1 / (n1 + 2 n2).
A text is its words and one end, and its score the log10 of their product. The sum over all texts is 1 at most.

The lattice is worked out once for each distinct word of the corpus, not at each place. Words that make up
1/20,000 of the corpus or more (so 20,000 of them at most) are scored where the documents are read; the others meet their scores in a
shuffle by hash.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lattice import Lattice
from .linededup import NO_KEY
from .scratch import Scratch, small_side

HOT = 20_000
SHARE = 48_000_000
TALLY = 300_000


def load_pieces(model: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a sentencepiece vocabulary as bytes, a space for the word start, with weights by their rank; and all 256 bytes."""
    proc = sentencepiece.SentencePieceProcessor(model_file=model)
    weight: dict[bytes, float] = {bytes([b]): 1e-4 for b in range(256)}
    for i in range(proc.get_piece_size()):
        if proc.is_byte(i) or proc.is_control(i) or proc.is_unknown(i):
            continue
        piece = proc.id_to_piece(i).replace("▁", " ").encode()
        if b" " not in piece[1:]:
            rank = min(-proc.get_score(i), 1e6)
            weight[piece] = max(weight.get(piece, 0.0), 1.0 / (rank + 20.0))
    pieces = sorted(weight)
    w = np.array([weight[p] for p in pieces])
    return pieces, w / w.sum()


def _tally(batches):
    """(text, train) to words with their counts in training documents and in all."""
    train, rest = Counter(), Counter()
    schema = pa.schema([("h", pa.int64()), ("word", pa.binary()), ("c", pa.int64()), ("n", pa.int64())])

    def flush():
        rest.update(train)
        words = list(rest)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words)).view(np.int64)
        out = pa.record_batch([pa.array(h), pa.array(words, pa.binary()), pa.array([train[w] for w in words], pa.int64()), pa.array([rest[w] for w in words], pa.int64())], schema=schema)
        train.clear()
        rest.clear()
        return out

    for batch in batches:
        for text, trains in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            (train if trains else rest).update((text.as_py() or b"").lower().split())
            if len(train) + len(rest) > TALLY:
                yield flush()
    yield flush()


def _expect(pieces: list[bytes], log_p: np.ndarray):
    def run(batches):
        lattice, total, held = Lattice(pieces, log_p), np.zeros(len(pieces)), []
        for batch in batches:
            held += [b" " + w for w in batch.column(0).to_pylist()]
            if len(held) > 50_000:
                total += lattice.expect(held, np.ones(len(held)))
                held = []
        if held:
            total += lattice.expect(held, np.ones(len(held)))
        yield pa.record_batch([pa.array(np.arange(len(pieces)), pa.int32()), pa.array(total)], names=["piece", "uses"])

    return run


def _word_scores(pieces: list[bytes], log_p: np.ndarray, n: int, v: int, d: float):
    def run(batches):
        lattice = Lattice(pieces, log_p)
        for batch in batches:
            lat = lattice.score([b" " + w for w in batch.column(1).to_pylist()])
            c = batch.column(2).to_numpy().astype(np.float64)
            base = np.log10((c + 1) / (n + 1 * (v + 1)))
            if n:
                with np.errstate(divide="ignore"):
                    score = np.logaddexp(np.log(np.maximum(c - d, 0) / n), lat + math.log(d * v / n)) / math.log(10)
            else:
                score = (lat + math.log(0.5)) / math.log(10)
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(base), pa.array(score)], names=["h", "c", "base", "score"])

    return run


ENTRY = np.dtype([("h", "<i8"), ("tf", "<u4")])
HEAD = np.dtype([("d", "<i8"), ("t", "<i8"), ("n", "<u4")])
SUMS = pa.schema([("p", pa.int32()), ("entries", pa.binary()), ("heads", pa.binary()), ("d", pa.int64()), ("t", pa.int64()), ("rows", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])


def _score_docs(hot: dict, parts: int, end: tuple, limit: int = 500_000):
    """(d, t, text) to what the frequent words and the end add up to (p null), and the other words by part."""

    def run(batches):
        heads, entries, held = [], [], 0
        rows = {name: [] for name in SUMS.names}

        def add(*values):
            for name, value in zip(SUMS.names, values, strict=True):
                rows[name].append(value)

        def flush():
            nonlocal heads, entries, held, rows
            if heads:
                e = np.array([x for own in entries for x in own], dtype=ENTRY)
                who = np.repeat(np.arange(len(heads)), [len(x) for x in entries])
                part = (e["h"].view(np.uint64) >> np.uint64(40)) % np.uint64(parts)
                order = np.argsort(part, kind="stable")
                e, who, part = e[order], who[order], part[order]
                cuts = np.searchsorted(part, np.arange(parts + 1))
                ids = np.array(heads, dtype=np.int64)
                for p in np.flatnonzero(np.diff(cuts)):
                    mine = who[cuts[p] : cuts[p + 1]]
                    first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
                    head = np.empty(len(first), dtype=HEAD)
                    head["d"], head["t"], head["n"] = ids[mine[first], 0], ids[mine[first], 1], np.diff(np.r_[first, len(mine)])
                    add(int(p), e[cuts[p] : cuts[p + 1]].tobytes(), head.tobytes(), *[None] * 7)
            out = pa.record_batch(rows, schema=SUMS)
            heads, entries, held, rows = [], [], 0, {name: [] for name in SUMS.names}
            return out

        for batch in batches:
            for d, t, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                words = (text.as_py() or b"").lower().split()
                known, base, score = end
                own = []
                for w, tf in Counter(words).items():
                    if got := hot.get(w):
                        known += got[0] * tf
                        base += got[1] * tf
                        score += got[2] * tf
                    else:
                        h = xxhash.xxh3_64_intdigest(w)
                        own.append((h - (1 << 64) if h >> 63 else h, tf))
                add(None, None, None, d, t, 1, len(words) + 1, known, base, score)
                if own:
                    heads.append((d, t))
                    entries.append(own)
                    held += len(own)
                if held > limit:
                    yield flush()
        yield flush()

    return run


def _meet():
    schema = pa.schema([f for f in SUMS if f.name not in ("p", "entries", "heads")])

    def run(key, words: pa.Table, scores: pa.Table) -> pa.Table:
        if not words.num_rows or not scores.num_rows:
            return schema.empty_table()
        e = np.concatenate([np.frombuffer(x.as_py(), dtype=ENTRY) for x in words.column("entries")])
        heads = np.concatenate([np.frombuffer(x.as_py(), dtype=HEAD) for x in words.column("heads")])
        h = scores.column("h").to_numpy()
        order = np.argsort(h)
        at = order[np.searchsorted(h[order], e["h"])]
        who = np.repeat(np.arange(len(heads)), heads["n"])
        tf = e["tf"].astype(np.float64)

        def total(x):
            return np.bincount(who, weights=x * tf, minlength=len(heads))

        known = total((scores.column("c").to_numpy()[at] > 0).astype(np.float64)).astype(np.int64)
        zero = np.zeros(len(heads), dtype=np.int64)
        cols = [heads["d"], heads["t"], zero, zero, known, total(scores.column("base").to_numpy()[at]), total(scores.column("score").to_numpy()[at])]
        return pa.table([pa.array(np.ascontiguousarray(c)) for c in cols], schema=schema)

    return run


def fit_pieces(words: DataFrame, pieces: list[bytes], p: np.ndarray, rounds: int, floor: float = 0.05) -> np.ndarray:
    """Probabilities of the pieces after rounds of expectation maximisation over the words, each once; every piece has `floor` uses besides."""
    for _ in range(rounds):
        uses = words.mapInArrow(_expect(pieces, np.log(p)), "piece int, uses double")
        count = np.full(len(pieces), floor)
        # as many rows as the vocabulary has pieces
        for row in uses.groupBy("piece").agg(F.sum("uses").alias("uses")).collect():
            count[row[0]] += row[1]
        p = count / count.sum()
    return p


def score_documents(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", folds: int = 7, fold: int = 2, rounds: int = 2) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    docs whose crc32(key as text) mod `folds` is `fold` are held out, the others train the model (a null key trains).

    Edge cases: a word of any length is scored whole, in blocks of bounded memory; a null or empty text is one end token; without training documents the lattice alone
    gives the score; repeated rows count as often as they occur and get equal scores; other columns are ignored; an empty
    table gives an empty table.
    """
    scratch = Scratch(docs.sparkSession, "lm")
    held = F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))
    full = docs.select(F.col(key).alias("doc_id"), held.alias("held_out"), F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("d"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("t"), F.col(text).cast("binary").alias("text"))
    ids = scratch.write(full.select("doc_id", "held_out", "d", "t"), "ids")
    tallied = full.select("text", (~F.col("held_out")).alias("train")).mapInArrow(_tally, "h bigint, word binary, c bigint, n bigint")
    vocab = scratch.write(tallied.groupBy("h", "word").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "vocab")
    one = lambda x: F.coalesce(F.sum(F.when(F.col("c") == x, 1)), F.lit(0))
    of = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("c") > 0, 1)), F.lit(0)), one(1), one(2), F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    ends = ids.filter(~F.col("held_out")).count()
    n, v = of[0] + ends, of[1] + (ends > 0)
    d = of[2] / (of[2] + 2 * of[3]) if of[2] and of[3] else 0.5

    pieces, p = load_pieces(model)
    if of[1]:
        p = fit_pieces(vocab.filter("c > 0").select("word"), pieces, p, rounds)
    scores = vocab.select("h", "word", "c").mapInArrow(_word_scores(pieces, np.log(p), n, v, d), "h bigint, c bigint, base double, score double")
    scores = scratch.write(scores, "scores")

    # at most HOT words make up 1 / HOT of the corpus each
    frequent = vocab.filter(F.col("n") * HOT >= of[5]).select("h", "word").join(scores, "h")
    hot = {bytes(r["word"]): (int(r["c"] > 0), r["base"], r["score"]) for r in frequent.collect()}
    end = (int(ends > 0), math.log10((ends + 1) / (n + 1 * (v + 1))), math.log10(max(ends - d, 0.5) / n if n else 0.5))
    # words of a part: a million at most; the documents' words that meet them come in shares of about SHARE bytes
    parts = max(12, of[4] // 1_000_000)
    sums = full.select("d", "t", "text").mapInArrow(_score_docs(hot, parts, end), "p int, entries binary, heads binary, d bigint, t bigint, rows bigint, n_tokens bigint, n_known bigint, base double, score double")
    sums = scratch.write(sums.withColumn("tail", F.col("p").isNotNull()), "sums", by="tail")
    part = F.pmod(F.shiftrightunsigned("h", 40), F.lit(parts)).cast("int")
    rare = sums.filter("tail").select("p", "entries", "heads")
    load = rare.groupBy("p").agg(F.ceil(F.sum(F.octet_length("entries") + F.octet_length("heads")) / SHARE).alias("shares"))
    load = small_side(scratch.write(load, "load"))
    dealt = rare.join(load, "p").withColumn("share", F.pmod(F.xxhash64("heads"), F.col("shares"))).select("p", "share", "entries", "heads")
    known = scores.select(part.alias("p"), "h", "c", "base", "score").join(load, "p")
    known = known.select("p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"), "h", "c", "base", "score")
    tail = dealt.groupBy("p", "share").cogroup(known.groupBy("p", "share"))
    tail = tail.applyInArrow(_meet(), "d bigint, t bigint, rows bigint, n_tokens bigint, n_known bigint, base double, score double")
    head = sums.filter("not tail").select("d", "t", "rows", "n_tokens", "n_known", "base", "score")
    total = head.unionByName(tail).groupBy("d", "t").agg(*[F.sum(c).alias(c) for c in ("rows", "n_tokens", "n_known", "base", "score")])
    mean = lambda c: F.expr(f"{c} div rows")
    return ids.join(total, ["d", "t"]).select(
        "doc_id", "held_out", mean("n_tokens").alias("n_tokens"), mean("n_known").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), (F.col("base") / F.col("rows")).alias("base_score"), (F.col("score") / F.col("rows")).alias("score")
    )
