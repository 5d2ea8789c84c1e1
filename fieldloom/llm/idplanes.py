"""Token-id files: ids in fixed-size blocks, each block turned into byte or bit planes, each plane compressed by zstandard, with a chunk index.

A file: 16 bytes of head (MAGIC, version, planes a block, ids a block), the planes of block after block, the table of documents (keys and
numbers of ids), the chunk index (for each block its place, its ids and the bytes of each plane), and 32 bytes of tail (places and sizes of the two
tables, MAGIC). A reader needs the tail, the two tables and then only the blocks that hold the ids it wants.

Plane k of a block in byte mode holds byte k of all its ids (4 planes); in bit mode bit k of all of them, eight a byte (32 planes). The last block
of a file is shorter.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import uuid

import numpy as np
import pyarrow as pa
import tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .files import open_read, open_write
from .scratch import Scratch

MAGIC, VERSION = b"IDPLANES", 1
BLOCK_IDS, FILE_IDS, SLICE_IDS = 65_536, 16_000_000, 1_000_000
PLANES = {"byte": 4, "bit": 32}
NO_KEY = -(2**63)
BLOCK = np.dtype([("offset", "<u8"), ("ids", "<u4"), ("sizes", "<u4", (32,))])
DOC = np.dtype([("key", "<i8"), ("null", "u1"), ("ids", "<u8")])
FILES = "path string, part int, seq int, docs bigint, ids bigint, bytes bigint"
#: Unicode's white space, fixed values: what \\s means to the tokenizers' pattern (Python's own \\s has four more).
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNK = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: What a text without any of these has between its words is one space or one line feed.
DOUBLE = ("  ", "\n\n", " \n", "\n ")
BLANK_ASCII = tuple("\t\x0b\x0c\r\x1c\x1d\x1e\x1f")
BLANK_MORE = tuple(chr(c) for c in range(0x80, 0x3001) if chr(c).isspace())


def plain_spaces(text: str) -> bool:
    if text[:1] in (" ", "\n") or text[-1:] in (" ", "\n"):
        return not text
    return not any(x in text for x in DOUBLE) and not any(x in text for x in BLANK_ASCII) and (text.isascii() or not any(x in text for x in BLANK_MORE))


def to_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """Bytes (4 planes) or bits (32 planes) of unsigned 32-bit ids, place by place."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4).T
    if planes == 4:
        return [np.ascontiguousarray(x).tobytes() for x in raw]
    return [np.packbits((raw[k // 8] >> (k % 8)) & 1, bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The n ids again."""
    out = np.zeros((n, 4), np.uint8)
    for k, plane in enumerate(planes):
        got = np.frombuffer(plane, np.uint8)
        if len(planes) == 4:
            out[:, k] = got
        else:
            out[:, k // 8] |= np.unpackbits(got, count=n, bitorder="little") << (k % 8)
    return out.reshape(-1).view("<u4")


class Writer:
    """One file, written from front to back; it holds one block of ids and 17 bytes a document."""

    def __init__(self, out, block: int, planes: int):
        self.out, self.block, self.planes = out, block, planes
        self.zip = zstandard.ZstdCompressor(level=1)
        self.held, self.n_held, self.ids = [], 0, 0
        self.docs, self.index = [], []
        self.at = 0
        self._put(MAGIC + struct.pack("<HHI", VERSION, planes, block))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.docs.append((NO_KEY if key is None else key, key is None, len(ids)))
        self.ids += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block:
            every = np.concatenate(self.held)
            whole = len(every) // self.block * self.block
            for k in range(0, whole, self.block):
                self._block(every[k : k + self.block])
            self.held, self.n_held = [every[whole:]], len(every) - whole

    def _block(self, ids: np.ndarray) -> None:
        packed = [self.zip.compress(p) for p in to_planes(ids, self.planes)]
        self.index.append((self.at, len(ids), [len(p) for p in packed] + [0] * (32 - self.planes)))
        self._put(b"".join(packed))

    def close(self) -> None:
        if self.n_held:
            self._block(np.concatenate(self.held))
        docs = self.zip.compress(np.array(self.docs, DOC).tobytes())
        index = self.zip.compress(np.array(self.index, BLOCK).tobytes())
        tail = struct.pack("<QII", self.at, len(docs), len(index)) + struct.pack("<Q", len(self.docs)) + MAGIC
        self._put(docs + index + tail)
        self.out.close()


class Reader:
    """The tables of one file, and its ids by range."""

    def __init__(self, path: str):
        self.file = open_read(path)
        size = self.file.size()
        tail = self._get(size - 32, 32)
        at, docs, index = struct.unpack("<QII", tail[:16])
        head = self._get(0, 16)
        if head[:8] != MAGIC or tail[24:] != MAGIC:
            raise ValueError(f"{path} is no file of token ids")
        self.planes = struct.unpack("<HHI", head[8:])[1]
        unzip = zstandard.ZstdDecompressor()
        self.docs = np.frombuffer(unzip.decompress(self._get(at, docs)), DOC)
        self.index = np.frombuffer(unzip.decompress(self._get(at + docs, index)), BLOCK)
        self.ends = np.cumsum(self.docs["ids"].astype(np.int64))
        self.block_ends = np.cumsum(self.index["ids"].astype(np.int64))
        self.unzip, self.now, self.held = unzip, -1, None

    def _get(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(length)

    def _block(self, b: int) -> np.ndarray:
        if b != self.now:
            entry, planes, at = self.index[b], [], 0
            sizes = [int(x) for x in entry["sizes"][: self.planes]]
            raw = self._get(int(entry["offset"]), sum(sizes))
            for size in sizes:
                planes.append(self.unzip.decompress(raw[at : at + size]))
                at += size
            self.held, self.now = from_planes(planes, int(entry["ids"])), b
        return self.held

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids start .. end - 1 of the file."""
        parts, b = [], int(np.searchsorted(self.block_ends, start, side="right"))
        while start < end:
            first = int(self.block_ends[b]) - int(self.index["ids"][b])
            got = self._block(b)[start - first : end - first]
            parts.append(got)
            start, b = start + len(got), b + 1
        return np.concatenate(parts) if parts else np.zeros(0, "<u4")


@functools.lru_cache(maxsize=4)
def _load(path: str):
    """The tokenizer, whether a text may be encoded in chunks that end where its pattern ends a piece anyway, and a pattern for the texts that may not."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok = tokenizers.Tokenizer.from_file(path)
    plan = json.loads(tok.to_str())
    pre = plan["pre_tokenizer"] or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not plan["normalizer"]
    added = [re.escape(t["content"]) for t in plan["added_tokens"]]
    return tok, bool(plain), re.compile("|".join(added) or "(?!)")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


#: Signs that end a run of letters; one of them after another stays in one piece.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: The byte-level alphabet: bytes that are not printable in Latin-1 are numbered from 256 on.
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
ALPHABET = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in PRINTED)}


class _Known(dict):
    """Ids of chunks as bytes, encoded when first asked for. Of two generations of `limit` chunks the older goes, so frequent chunks stay.

    The pattern keeps a run of letters, with the space before it, in one piece, and the signs after it in another: such letters (Latin ones, which all
    versions of Unicode know) go straight to the tokenizer's model, written in its alphabet of bytes.
    """

    def __init__(self, tok, lead: str, limit: int):
        self.tok, self.model, self.lead, self.limit = tok, tok.model, lead, limit
        self.space = ALPHABET[0x20] if lead else ""
        self.old: dict = {}
        self.signs: dict = {}

    def _whole(self, chunk: str) -> bytes:
        return _packed(self.tok.encode(chunk, add_special_tokens=False).ids)

    def _tail(self, signs: str) -> bytes:
        if signs not in self.signs:
            if len(self.signs) >= 10_000:
                self.signs.clear()
            self.signs[signs] = self._whole(signs)
        return self.signs[signs]

    def __missing__(self, part: str) -> bytes:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        if part in self.old:
            got = self[part] = self.old[part]
            return got
        letters = part.rstrip(SIGNS)
        if letters.isalpha():
            if letters.isascii():
                spelt = self.space + letters
            elif max(letters) < "\u0250":
                spelt = (self.lead + letters).encode().decode("latin-1").translate(ALPHABET)
            else:
                spelt = None
            if spelt is not None:
                if len(letters) < len(part):
                    got = self[part] = self[letters] + self._tail(part[len(letters) :])
                else:
                    got = self[part] = _packed([t.id for t in self.model.tokenize(spelt)])
                return got
        got = self[part] = self._whole(self.lead + part)
        return got


class Encoder:
    """Texts to ids. Where the tokenizer allows it, chunks (a word with the space before it, or white space) are encoded once and looked up again.
    Texts with added tokens in them, and all texts of other tokenizers, are encoded whole."""

    def __init__(self, path: str, limit: int = 300_000):
        self.tok, self.chunks, self.added = _load(path)
        self.bare, self.spaced = _Known(self.tok, "", limit), _Known(self.tok, " ", limit)

    def encode(self, text: str) -> np.ndarray:
        if not self.chunks or self.added.search(text):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4")
        if not plain_spaces(text):
            return np.frombuffer(b"".join(map(self.bare.__getitem__, CHUNK.findall(text))), "<u4")
        # words with one space or one line feed between them
        lines = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            lines.append(self.bare[first] + b"".join(map(self.spaced.__getitem__, rest)))
        return np.frombuffer(self.bare["\n"].join(lines), "<u4")


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    # tasks that follow each other in one Python worker go on with its table
    return Encoder(path)


def _write(root: str, tokenizer: str, end_id: int, block: int, planes: int, file_ids: int):
    schema = pa.schema([("path", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("docs", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())])

    def run(batches):
        encoder, end = _encoder(tokenizer), np.array([end_id], "<u4")
        part, seq, now, path = TaskContext.get().partitionId(), 0, None, None

        def done():
            now.close()
            return pa.record_batch([[path], pa.array([part], pa.int32()), pa.array([seq], pa.int32()), [len(now.docs)], [now.ids], [now.at]], schema=schema)

        for batch in batches:
            for key, text in zip(*batch.columns, strict=True):
                if now is None:
                    path = f"{root}/{part:06d}-{seq:04d}-{uuid.uuid4().hex}.ids"
                    now = Writer(open_write(path), block, planes)
                now.add(key.as_py(), np.concatenate((encoder.encode(text.as_py()), end)))
                if now.ids >= file_ids:
                    yield done()
                    now, seq = None, seq + 1
        if now is not None:
            yield done()

    return run


def write_ids(docs: DataFrame, key: str, text: str, tokenizer: str, root: str, end_id: int, planes: str = "byte", block: int = BLOCK_IDS, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode the texts and write their ids, each text followed by end_id, in ascending order of the keys; returns FILES, one row a file.

    Documents are dealt out by ranges of the key and of a hash of the text, so a key that fills many rows does not fill one task. Files in order of (part, seq)
    hold the documents in order. A task names its files anew, so one that runs again leaves at most files that no row names. Write the result
    down before reading from it.
    """
    given = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    dealt = given.repartitionByRange(F.col("key").asc_nulls_first(), F.col("h")).sortWithinPartitions(F.col("key").asc_nulls_first(), "h", "text").drop("h")
    return dealt.mapInArrow(_write(root, tokenizer, end_id, block, PLANES[planes], file_ids), FILES)


def _slices(slice_ids: int):
    def run(batches):
        for batch in batches:
            rows = {"path": [], "base": [], "first": [], "upto": []}
            for path, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                read = Reader(path)
                with read.file:
                    if len(read.docs):
                        of = (read.ends - read.docs["ids"].astype(np.int64)) // slice_ids
                        cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
                        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                            for name, x in zip(rows, (path, base, a, b), strict=True):
                                rows[name].append(x)
            yield pa.record_batch([pa.array(rows["path"], pa.string()), *(pa.array(rows[c], pa.int64()) for c in ("base", "first", "upto"))], names=list(rows))

    return run


def _read(batches):
    schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.binary())])
    rows, held, now, read = [], 0, None, None

    def flush():
        nonlocal rows, held
        out = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        rows, held = [], 0
        return out

    for batch in batches:
        for path, base, first, upto in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if path != now:
                if read:
                    read.file.close()
                now, read = path, Reader(path)
            for d in range(first, upto):
                end, n = int(read.ends[d]), int(read.docs["ids"][d])
                body = read.ids(end - n, end).tobytes()
                rows.append((None if read.docs["null"][d] else int(read.docs["key"][d]), base + end - n, n, body))
                held += len(body)
                if held > 8_000_000:
                    yield flush()
    if read:
        read.file.close()
    if rows:
        yield flush()


def read_ids(files: DataFrame, slice_ids: int = SLICE_IDS) -> DataFrame:
    """All documents of the files (a written table of FILES): key, start (ids of all documents before it), n_ids, ids (little-endian unsigned 32 bits each).

    Slices of about slice_ids ids are dealt out, so a large file is read by several tasks.
    """
    # one row a file
    order = W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1)
    based = files.select("path", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("base"))
    cut = based.repartition("path").mapInArrow(_slices(slice_ids), "path string, base bigint, first bigint, upto bigint")
    n = files.agg(F.coalesce(F.sum("ids"), F.lit(0))).first()[0]
    dealt = cut.repartition(max(12, -(-n // (4 * slice_ids))), "path", "first").sortWithinPartitions("path", "first")
    return dealt.mapInArrow(_read, "key bigint, start bigint, n_ids bigint, ids binary")


def round_trip(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 2, planes: str = "byte") -> DataFrame:
    """Write the ids of all documents and read them back (the columns of read_ids).

    Edge cases: null or empty text: the end id alone; null keys come first and come back null; repeated keys are documents of their own, in the order
    of a hash of their texts, then the texts; other columns are ignored, whatever their names; an empty table writes no file and gives no
    rows. Keys are whole numbers.
    """
    scratch = Scratch(docs.sparkSession, "idplanes")
    return read_ids(scratch.write(write_ids(docs, key, text, tokenizer, scratch.path("files"), end_id, planes), "list"))
