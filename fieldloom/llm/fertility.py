"""Quality rules by tokeniser fertility, after plain base rules.

Public vocabularies cut each word into pieces. Three figures of a document follow for each of them: characters per token, the share of
byte-fallback tokens (of a byte-level vocabulary: of single bytes beyond ASCII), and the entropy of its tokens (with the Miller-Madow correction for short texts). Text that the
base rules pass is held against bands around the median of its language and length class, some robust deviations
wide, over all documents of the corpus, for each vocabulary. Where no language is given the script of its letters takes
its place.
"""

from __future__ import annotations

import base64
import math
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import U, mix, window_hashes
from .scratch import Scratch, small_side

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
# First code points of Unicode blocks and their script, fixed values.
SCRIPTS = [(0x41, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x590, "hebrew"), (0x600, "arabic"), (0x900, "indic"), (0xE00, "thai"), (0x1100, "hangul"), (0x1E00, "latin"), (0x3040, "kana"), (0x3400, "han"), (0xAC00, "hangul"), (0xD7B0, "other")]


# How byte-level vocabularies part a text before they merge bytes, a fixed value.
PARTS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# Longer words are cut piece by piece of so many characters: merging takes the square of a word's length.
LONG = 1000


def _spans(word: str) -> list[str]:
    return [word[i : i + LONG] for i in range(0, len(word), LONG)]


def _piece_model(path: str):
    """Pieces of a word by a sentencepiece model, and which ids stand for single bytes."""
    proc = sentencepiece.SentencePieceProcessor(model_file=path)

    def cut(words: list[str]) -> list[list[int]]:
        if max(map(len, words)) <= LONG:
            return proc.encode(words, num_threads=1)
        return [[i for x in proc.encode(_spans(w), num_threads=1) for i in x] for w in words]

    return cut, np.array([proc.is_byte(i) for i in range(proc.get_piece_size())])


def _rank_file(path: str):
    """Pieces of a word by a byte-level vocabulary of ranks, each word after a space."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    proc = tiktoken.Encoding("ranks", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})
    byte = np.zeros(max(ranks.values()) + 1, dtype=bool)
    byte[[r for t, r in ranks.items() if len(t) == 1 and t[0] > 0x7F]] = True
    return (lambda words: [proc.encode_ordinary(" " + w) if len(w) < LONG else [i for x in _spans(" " + w) for i in proc.encode_ordinary(x)] for w in words]), byte


class _Index(dict):
    """Words to numbers in the order in which they come; `new` holds those that nobody has cut yet."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        k = self[word] = len(self)
        self.new.append(word)
        return k


class Pieces:
    """Pieces of words by several vocabularies, each in one flat array; a word is cut once. Starts over when it holds `limit` words."""

    limit = 500_000

    def __init__(self, models: list[str]):
        self.cut = [_rank_file(m) if m.endswith(".tiktoken") else _piece_model(m) for m in models]
        self._reset()

    def _reset(self) -> None:
        self.index = _Index()
        self.flat = [np.zeros(1 << 16, dtype=np.int32) for _ in self.cut]
        self.bounds = [np.zeros(1 << 16, dtype=np.int64) for _ in self.cut]

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.zeros(max(len(a), n - len(a)), dtype=a.dtype)])

    def of(self, words: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
        """The words' numbers, and the ids of their pieces in order for each vocabulary."""
        if len(self.index) > self.limit:
            self._reset()
        at = np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words))
        if self.index.new:
            strings, last = [w.decode("utf-8", "replace") for w in self.index.new], len(self.index)
            first = last - len(strings)
            for v, (cut, _) in enumerate(self.cut):
                got = cut(strings)
                ends = self.bounds[v][first] + np.cumsum(np.fromiter(map(len, got), dtype=np.int64, count=len(got)))
                self.flat[v], self.bounds[v] = self._room(self.flat[v], int(ends[-1])), self._room(self.bounds[v], last + 1)
                self.flat[v][self.bounds[v][first] : ends[-1]] = np.fromiter(chain.from_iterable(got), dtype=np.int32, count=int(ends[-1] - self.bounds[v][first]))
                self.bounds[v][first + 1 : last + 1] = ends
            self.index.new.clear()
        out = []
        for flat, bounds in zip(self.flat, self.bounds, strict=True):
            lo, n = bounds[at], bounds[at + 1] - bounds[at]
            out.append(flat[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())])
        return at, out


def _script_table() -> np.ndarray:
    """The script of each code point below 0x30000 as a place in SCRIPTS; 255 for Latin's neighbours that are no letters."""
    points = np.arange(0x30000)
    table = (np.searchsorted([s for s, _ in SCRIPTS], points, side="right") - 1).astype(np.int64)
    table[(table < 0) | ((points > 0x5A) & (points < 0x61)) | ((points > 0x7A) & (points < 0xC0))] = 255
    return table.astype(np.uint8)


SCRIPT_OF = _script_table()


def _script(text: str) -> str:
    if text.isascii():
        return "latin" if any(map(str.isalpha, text)) else "none"
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    counts = np.bincount(SCRIPT_OF[np.minimum(points, len(SCRIPT_OF) - 1)], minlength=256)[: len(SCRIPTS)]
    return SCRIPTS[counts.argmax()][1] if counts.any() else "none"


def _repeat_words(at: np.ndarray, width: int = 3) -> int:
    """Words inside windows of `width` words that occur twice or more; at: a number for each word."""
    if len(at) < width:
        return 0
    h = window_hashes(mix(at.astype(U)), width)
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    starts = order[np.r_[same, False] | np.r_[False, same]]
    if not len(starts):
        return 0
    cover = np.zeros(len(at) + 1, dtype=np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + width, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def _dup_lines(text: bytes) -> int:
    seen, found = set(), 0
    for line in text.split(b"\n"):
        if line.strip(SPACE):
            found += line in seen
            seen.add(line)
    return found


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
KINDS = ("chars_per_token", "byte_share", "entropy")


def names(models: list[str]) -> list[str]:
    """The figures' columns: plain for the first vocabulary, numbered from 2 for the others."""
    return [k if i == 0 else f"{k}_{i + 1}" for i in range(len(models)) for k in KINDS]


def figures(text: bytes | None, pieces: Pieces) -> tuple:
    text = text or b""
    words = text.split()
    if not words:
        return 0, 0, len(text) - len(text.translate(None, SYMBOLS)), 0, 0, *[0.0] * 3 * len(pieces.cut), "none"
    string = text.decode("utf-8", "replace")
    word_chars = len(string) - (len(text) - len(text.translate(None, SPACE)))
    found = []
    at, cut = pieces.of(words)
    for ids, (_, byte) in zip(cut, pieces.cut, strict=True):
        n, entropy = len(ids), 0.0
        if n:
            counts = np.unique(ids, return_counts=True)[1]
            p = counts / n
            entropy = float(-(p * np.log2(p)).sum() + (len(counts) - 1) / (2 * n * math.log(2)))
        found += [word_chars / max(n, 1), float(byte[ids].mean()) if n else 0.0, entropy]
    return len(words), word_chars, len(text) - len(text.translate(None, SYMBOLS)), _dup_lines(text), _repeat_words(at), *found, _script(string)


def _measure(models: list[str]):
    schema = pa.schema([(n, pa.int64()) for n in BASE] + [(n, pa.float64()) for n in names(models)] + [("script", pa.string())])

    def run(batches):
        pieces = Pieces(models)
        for batch in batches:
            rows = [figures(text.as_py(), pieces) for text in batch.column(1)]
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
            yield pa.record_batch([*[pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], batch.column(0), *batch.columns[2:]], names=[*schema.names, "lang", *batch.schema.names[2:]])

    return run


def measure(docs: DataFrame, models: list[str], text: str, lang: str, carry: list[str]) -> DataFrame:
    """Base figures and those of the method for each row, and the `carry` columns (named c0, c1, ...)."""
    given = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("binary").alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    kinds = {f.name: f.dataType for f in given.schema.fields}
    schema = ", ".join([f"{n} bigint" for n in BASE] + [f"{n} double" for n in names(models)] + ["script string", "lang string"] + [f"c{i} {kinds[f'c{i}'].simpleString()}" for i in range(len(carry))])
    got = given.mapInArrow(_measure(models), schema)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    group = F.coalesce("lang", F.concat(F.lit("script:"), F.col("script")))
    return got.withColumn("base_failed", failed).withColumn("group", group).withColumn("length_class", F.floor(F.log2(F.greatest("n_words", F.lit(1)))).cast("int")).drop("lang")


def _band(stats: DataFrame, by: list[str], least: int, figure: list[str], scratch: Scratch, name: str) -> DataFrame:
    """Median and robust deviation (1.4826 times the median distance from it) of the figures for each group of `least` rows or more.

    The medians are written first: a row for each group, which documents then look up without being shuffled by their group.
    """
    mid = stats.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(c, 0.5, 10_000).alias(f"{c}_mid") for c in figure]).filter(F.col("n") >= least).drop("n")
    mid = small_side(scratch.write(mid, f"{name}-mid"))
    away = stats.join(mid, by).groupBy(*by, *[f"{c}_mid" for c in figure]).agg(*[(F.percentile_approx(F.abs(F.col(c) - F.col(f"{c}_mid")), 0.5, 10_000) * 1.4826).alias(f"{c}_dev") for c in figure])
    return scratch.write(away, name)


def judge(measured: DataFrame, figure: list[str], chars: tuple[float, float] = (8.0, 8.0), entropy: tuple[float, float] = (4.0, 12.0), byte_share: tuple[float, float] = (12.0, 12.0), least: int = 100, few: int = 20) -> DataFrame:
    """measured plus kept. Rejected: what the base rules fail, and what lies outside its band in one of the figures (names()).
    chars, entropy and byte_share: how many robust deviations below and above the median are still good. Poor text repeats its tokens, so entropy is
    held more tightly below.

    A group of a language and length class with fewer than `least` documents takes the band of its language over all lengths, a
    language with fewer than that the band of its script, and a script with fewer than `few` that of all documents. So every document has a band, at any
    size of the corpus.
    """
    scratch = Scratch(measured.sparkSession, "bands")
    good = measured.filter(~F.col("base_failed")).withColumn("one", F.lit(1))
    levels = [("fine", ["group", "length_class"], least), ("rough", ["group"], least), ("script", ["script"], few), ("whole", ["one"], 1)]
    columns = [f"{c}_{x}" for c in figure for x in ("mid", "dev")]
    both = measured.withColumn("one", F.lit(1))
    for name, by, n in levels:
        band = _band(good, by, n, figure, scratch, name).select(*[F.col(c).alias(f"{name}_{c}") for c in [*by, *columns]])
        both = both.join(small_side(band), reduce(lambda a, b: a & b, [F.col(c) == F.col(f"{name}_{c}") for c in by]), "left")
    m = {c: F.coalesce(*[f"{name}_{c}" for name, *_ in levels]) for c in columns}
    wide = dict(zip(KINDS, (chars, byte_share, entropy), strict=True))

    def inside(c: str) -> Column:
        low, high = wide[c.rstrip("_0123456789")]
        z = (F.col(c) - m[f"{c}_mid"]) / F.greatest(m[f"{c}_dev"], F.lit(0.01))
        return F.coalesce((z >= -low) & (z <= high), F.lit(True))

    ok = reduce(lambda a, b: a & b, [inside(c) for c in figure])
    gone = [f"{name}_{c}" for name, by, _ in levels for c in [*by, *columns]]
    return both.withColumn("kept", ~F.col("base_failed") & ok).drop("script", "one", *gone)


def quality(docs: DataFrame, models: str | list[str], carry: list[str], text: str = "text", lang: str = "lang", **bands) -> DataFrame:
    """Figures and verdict for each row of docs, with the `carry` columns under their own names. models: vocabulary files, sentencepiece models or ranks.

    Edge cases: a word of more than LONG characters is cut into spans of that many before it is cut into pieces; null, empty and white-space texts have no words and fail the base rules; a null language stands for the script; repeated rows
    are judged alike; other columns are ignored; an empty table gives an empty table.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    models = [models] if isinstance(models, str) else models
    done = judge(scratch.write(measure(docs, models, text, lang, carry), "figures"), names(models), **bands)
    return done.withColumnsRenamed({f"c{i}": c for i, c in enumerate(carry)})
