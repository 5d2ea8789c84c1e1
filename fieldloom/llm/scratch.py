"""Intermediate tables in the folder that driver and executors share.

Long plans are cut by writing a table and reading it back: a lost executor then costs only the tasks
it was running, and Spark learns the size of the table, so its own broadcast threshold decides the
joins that follow.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; in local mode, where none is named, a folder of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="fieldloom-")
        spark.conf.set("spark.checkpoint.dir", named)
        _delete_on_exit(spark, named)
    at, fs = _fs(spark, named.rstrip("/"))
    # with its file system, so that tasks which write files of their own write them where Spark does
    return re.sub(r"^file:/(?=[^/])", "file:///", fs.makeQualified(at).toString())


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    at, fs = _fs(spark, path)
    fs.deleteOnExit(at)


class Scratch:
    """Tables of one operator call, under a folder of its own in the shared folder."""

    made: list[Scratch] | None = None

    @classmethod
    @contextmanager
    def passing(cls):
        """What is written inside by objects that are made inside is deleted at the end."""
        outer, cls.made = cls.made, []
        try:
            yield
        finally:
            mine, cls.made = cls.made, outer
            for x in mine:
                x.drop("")

    def __init__(self, spark: SparkSession, owner: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{owner}-{uuid.uuid4().hex}"
        self._marked = False
        if Scratch.made is not None:
            Scratch.made.append(self)

    def path(self, name: str) -> str:
        if not self._marked:
            at, fs = _fs(self.spark, self.root)
            fs.mkdirs(at)
            fs.deleteOnExit(at)
            self._marked = True
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if by:
            writer = writer.partitionBy(by)
        writer.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a table that no later plan reads."""
        at, fs = _fs(self.spark, f"{self.root}/{name}" if name else self.root)
        fs.delete(at, True)


def small_side(table: DataFrame, limit: int = 32_000_000) -> DataFrame:
    """A written table, marked for broadcast if it fits in about `limit` bytes; beyond that it is left as it is and the join
    shuffles. Its size: 16 bytes a row and column, and four times the bytes of its files (compressed) for columns without a fixed width."""
    files = table.inputFiles()
    fixed = all(not isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)) for f in table.schema.fields)
    held = 0
    if not fixed:
        for path in files:
            at, fs = _fs(table.sparkSession, path)
            held += 4 * fs.getFileStatus(at).getLen()
            if held > limit:
                return table
    # the count reads the footers alone
    return F.broadcast(table) if held + table.count() * 16 * len(table.columns) <= limit else table
