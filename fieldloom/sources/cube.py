"""Cubes of samples in the Zarr layout (version 2) as a Spark sink: a chunk a sample, or a chunk for several that follow each other, written by the task that has them.

Tasks write under a folder that belongs to the job; only when all of them have ended does the driver add the few lines of metadata and give the folder its
name. A job that fails removes its folder, so a cube is there whole or not at all.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

NAME = "fieldloom_cube"


def _fs(path: str):
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/(?=[^/])", "file:///", path)) if ":" in path else (pyarrow.fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    count: int
    last: int


class CubeWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.shape = tuple(int(options[k]) for k in ("channels", "rows", "cols"))
        self.text = int(options.get("text", 512))
        self.level = int(options.get("level", 1))
        self.each = int(options.get("each", 1))
        self.part = f"{self.path}.part-{uuid.uuid4().hex}"

    def _chunk(self, fs, root: str, name: str, data: bytes) -> None:
        with fs.open_output_stream(f"{root}/{name}") as out:
            out.write(zlib.compress(data, self.level))

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = _fs(self.part)
        for array in ("images", "masks", "meta"):
            fs.create_dir(f"{root}/{array}", recursive=True)
        c, h, w = self.shape
        count, last, at, held = 0, -1, 0, []
        names, empty = ("images/{}.0.0.0", "masks/{}.0.0", "meta/{}"), (c * h * w * 4, h * w, self.text * 4)

        def put() -> None:
            # a chunk is written whole, at the end of the cube too
            for name, size, *parts in zip(names, empty, *held, strict=True):
                self._chunk(fs, root, name.format(at), b"".join(parts).ljust(size * self.each, b"\0"))
            held.clear()

        for batch in batches:
            for position, image, mask, meta in zip(*(batch.column(k) for k in ("position", "image", "mask", "meta")), strict=True):
                n = position.as_py()
                pixels = np.asarray(image.values.to_numpy(zero_copy_only=False), "<f4")
                labels = np.asarray(mask.values.to_numpy(zero_copy_only=False), "u1")
                words = meta.as_py() or ""
                if pixels.size != c * h * w or labels.size != h * w or len(words) > self.text:
                    raise ValueError(f"sample {n} is not of the cube's shape")
                if held and (len(held) == self.each or n // self.each != at):
                    put()
                if n % self.each != len(held):
                    raise ValueError("the samples of a chunk come in one task, in order, each once")
                held.append((pixels.tobytes(), labels.tobytes(), words.ljust(self.text, "\0").encode("utf-32-le")))
                count, last, at = count + 1, max(last, n), n // self.each
        if held:
            put()
        return Written(count, last)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        done = [m for m in messages if m is not None]
        n = sum(m.count for m in done)
        if n != max((m.last for m in done), default=-1) + 1:
            self.abort(messages)
            raise ValueError("the samples of a cube are numbered 0 .. n - 1, each once")
        fs, root = _fs(self.part)
        c, h, w = self.shape
        fs.create_dir(root, recursive=True)
        shapes = {"images": ("<f4", [n, c, h, w]), "masks": ("|u1", [n, h, w]), "meta": (f"<U{self.text}", [n])}
        for array, (kind, shape) in shapes.items():
            info = {"zarr_format": 2, "shape": shape, "chunks": [self.each, *shape[1:]], "dtype": kind, "compressor": {"id": "zlib", "level": self.level}, "fill_value": 0 if array != "meta" else "", "order": "C", "filters": None}
            fs.create_dir(f"{root}/{array}", recursive=True)
            with fs.open_output_stream(f"{root}/{array}/.zarray") as out:
                out.write(json.dumps(info).encode())
        with fs.open_output_stream(f"{root}/.zgroup") as out:
            out.write(b'{"zarr_format": 2}')
        target = _fs(self.path)[1]
        if fs.get_file_info(target).type != pyarrow.fs.FileType.NotFound:
            if not self.overwrite:
                self.abort(messages)
                raise FileExistsError(self.path)
            fs.delete_dir(target)
        fs.move(root, target)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = _fs(self.part)
        if fs.get_file_info(root).type != pyarrow.fs.FileType.NotFound:
            fs.delete_dir(root)


class CubeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return CubeWriter(self.options, overwrite)


def write_cube(samples: DataFrame, path: str, channels: int, rows: int, cols: int, overwrite: bool = False, text: int = 512, each: int = 1) -> None:
    """samples: position (0 .. n - 1), image (channels x rows x cols numbers), mask (rows x cols), meta (at most `text` characters). A null meta is empty.

    An existing cube is an error unless it is to be overwritten. positions() of operators.batches numbers samples. each: samples of a chunk, which are dealt to
    one task and held there; with one file an array for each of very many small samples, files are what takes the time.
    """
    samples.sparkSession.dataSource.register(CubeSource)
    rows_of = samples.selectExpr("cast(position as bigint) as position", "cast(image as array<float>) as image", "cast(mask as array<int>) as mask", "meta")
    if each > 1:
        rows_of = rows_of.repartition(F.floor(F.col("position") / each)).sortWithinPartitions("position")
    rows_of.write.format(NAME).mode("overwrite" if overwrite else "append").options(path=path, channels=channels, rows=rows, cols=cols, text=text, each=each).save()


def read_cube(spark, path: str, array: str) -> DataFrame:
    """The chunks of one array as rows: position, values (numbers, or for meta the text in one)."""
    fs, root = _fs(path)
    with fs.open_input_stream(f"{root}/{array}/.zarray") as given:
        info = json.loads(given.read())
    n, each = info["shape"][0], info["chunks"][0]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[0-9]*").load(f"{path}/{array}")

    def run(batches):
        for batch in batches:
            for name, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = zlib.decompress(blob)
                first = int(name.rpartition("/")[2].partition(".")[0]) * each
                count = min(each, n - first)
                if array == "meta":
                    raw = raw.decode("utf-32-le")
                    text = len(raw) // each
                    values = pa.array([[raw[k * text : (k + 1) * text].rstrip("\0")] for k in range(count)], pa.list_(pa.string()))
                else:
                    numbers = np.frombuffer(raw, {"images": "<f4", "masks": "u1"}[array]).reshape(each, -1)[:count].astype(float)
                    values = pa.ListArray.from_arrays(pa.array(np.arange(count + 1) * numbers.shape[1], pa.int32()), pa.array(numbers.ravel()))
                yield pa.record_batch([pa.array(np.arange(first, first + count), pa.int64()), values], names=["position", "values"])

    return files.select("path", "content").mapInArrow(run, f"position bigint, values array<{'string' if array == 'meta' else 'double'}>")
