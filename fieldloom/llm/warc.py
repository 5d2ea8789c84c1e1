"""WARC records in ZIP archives: written with an index, read back by byte range without extraction.

An archive holds stored members: archive/data.warc.gz, each record a gzip member of its own, and indexes/index.cdxj,
one JSON line for each record with its offset and length. A reader needs the central directory, the index, and then only the records it
wants.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import open_read, open_write
from .scratch import Scratch
from .zipfmt import data_offset, list_members, write_zip

SLICE_BYTES = 4_000_000
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def mark_revisits(pages: DataFrame, key: str, payload: str, least: int = 100) -> DataFrame:
    """pages plus payload_bytes, payload_digest, record_type and refers_to.

    Among rows whose payloads are equal and have `least` bytes or more, the smallest key is the response and the others
    revisit it. Equal payloads are counted before they shuffle, so a payload that fills many rows is one row for each task.
    A null payload is empty; a null key is never the one referred to unless all are null, and then all are responses.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    scratch = Scratch(pages.sparkSession, "revisits")
    marked = pages.withColumns({"payload_bytes": F.octet_length(body).cast("long"), "payload_digest": F.sha2(body, 256)})
    firsts = marked.filter(F.col("payload_bytes") >= least).groupBy(F.col("payload_digest").alias("_digest")).agg(F.min(key).alias("_first"), F.count(F.lit(1)).alias("_n"))
    firsts = scratch.write(firsts.filter("_n > 1").drop("_n"), "firsts")
    joined = marked.join(firsts, F.col("payload_digest") == F.col("_digest"), "left")
    again = F.col("_first").isNotNull() & (F.col(key).isNull() | (F.col(key) > F.col("_first")))
    return joined.withColumns({"record_type": F.when(again, "revisit").otherwise("response"), "refers_to": F.when(again, F.col("_first"))}).drop("_digest", "_first")


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _record_id(page_id, digest: str) -> str:
    """The id of a page's record follows from the page and its payload, so a revisit can name the record that it refers to."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def render(page_id, url, kind, refers_to, size, digest, payload, date: str) -> bytes:
    """One record as WARC/1.1 text."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"WARC-Refers-To-Date: {date}", f"X-Refers-To-Page: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(record: bytes) -> tuple:
    """A record back to the columns of RECORD; the digest and length of a response come from its payload."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    kind, page = fields["WARC-Type"], fields.get("X-Page-ID")
    page = None if page is None else int(page)
    if kind == "revisit":
        return page, fields.get("WARC-Target-URI"), kind, int(fields["X-Refers-To-Page"]), int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:"), None
    payload = block.partition(b"\r\n\r\n")[2]
    return page, fields.get("WARC-Target-URI"), kind, None, len(payload), hashlib.sha256(payload).hexdigest(), payload


def _writer(root: str, archive_bytes: int, date: str, zip64: bool):
    schema = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])

    def run(batches):
        data, index = bytearray(), []

        def flush():
            nonlocal data, index
            path = f"{root}/{uuid.uuid4().hex}.zip"
            blob = write_zip([(DATA, bytes(data)), (INDEX, "".join(index).encode())], zip64)
            with open_write(path) as out:
                out.write(blob)
            rows = pa.record_batch([[path], [len(blob)], [len(index)]], schema=schema)
            data, index = bytearray(), []
            return rows

        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                page_id, url, kind, refers_to, size, digest, payload = (x.as_py() for x in row)
                record = gzip.compress(render(page_id, url, kind, refers_to, size, digest, payload, date), 1, mtime=0)
                index.append(json.dumps({"page": page_id, "digest": digest, "mime": kind, "filename": DATA, "offset": len(data), "length": len(record)}) + "\n")
                data += record
                if len(data) > archive_bytes:
                    yield flush()
        if index:
            yield flush()

    return run


def write_archives(records: DataFrame, root: str, archive_bytes: int = 32_000_000, date: str = "2024-01-01T00:00:00Z", zip64: bool = False) -> DataFrame:
    """Write records (the columns of RECORD) under root; returns (path, bytes, records) for each archive.

    A task holds one archive of about archive_bytes at a time and writes it whole under a name of its own, so a task that runs again
    leaves at most an archive that no row names. Write the result down before reading from it.
    """
    return records.mapInArrow(_writer(root, archive_bytes, date, zip64), "path string, bytes bigint, records bigint")


def _ranged(path: str):
    file = open_read(path)

    def read(offset: int, length: int) -> bytes:
        file.seek(offset)
        return file.read(length)

    return file, read


def _list(batches):
    for batch in batches:
        rows = {"path": [], "offset": [], "length": []}
        for path, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            file, read = _ranged(path)
            with file:
                members = {m.name: m for m in list_members(read, size)}
                start = {name: data_offset(read, m) for name, m in members.items() if m.method == 0}
                for name in [n for n in members if n.endswith(".cdxj") and n in start]:
                    for line in read(start[name], members[name].size).decode().splitlines():
                        entry = json.loads(line)
                        rows["path"].append(path)
                        rows["offset"].append(start[entry["filename"]] + entry["offset"])
                        rows["length"].append(entry["length"])
        yield pa.record_batch(rows, schema=pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))


def _fetch(batches):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
    for batch in batches:
        file, now, rows, held = None, None, [], 0
        for path, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if path != now:
                if file:
                    file.close()
                (file, read), now = _ranged(path), path
            rows.append(parse(gzip.decompress(read(offset, length))))
            held += rows[-1][4]
            if held > 16_000_000:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                rows, held = [], 0
        if file:
            file.close()
        if rows:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def read_archives(archives: DataFrame) -> DataFrame:
    """All records of the archives (path, bytes). Directories and indexes are read first; the records, dealt by archive and
    place, are then read by byte range, neighbours together."""
    entries = archives.select("path", "bytes").mapInArrow(_list, "path string, offset bigint, length bigint")
    # slices of an archive, so a large one is read by several tasks; the rows to be dealt are small, so the bytes that they stand for give the number of tasks
    size = archives.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    tasks = max(12, 2 * size // SLICE_BYTES)
    dealt = entries.repartition(tasks, F.col("path"), F.floor(F.col("offset") / SLICE_BYTES)).sortWithinPartitions("path", "offset")
    return dealt.mapInArrow(_fetch, RECORD)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 100) -> DataFrame:
    """Write a record for each row of pages and read all of them back (the columns of RECORD).

    Edge cases: null payload: empty; null url and key are left out of the record and come back null; repeated rows are records of their own (both
    responses if they are the first of their payload); an empty table writes no archive and gives no rows; other columns are ignored.
    """
    spark: SparkSession = pages.sparkSession
    scratch = Scratch(spark, "warc")
    given = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(payload).alias("body"))
    marked = mark_revisits(given, "page_id", "body", least)
    sent = F.when(F.col("record_type") == "response", F.coalesce("body", F.lit("")).cast("binary"))
    records = marked.select("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", sent.alias("payload"))
    return read_archives(scratch.write(write_archives(records, scratch.path("archives")), "list"))
