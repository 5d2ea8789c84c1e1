"""Copy ledgers, checksums and set logic on file names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def copy_status(src: DataFrame, dst: DataFrame) -> DataFrame:
    """src (path, size) against dst (path, size): pending without a copy, completed with equal sizes, else mismatched."""
    d = dst.select(F.col("path").alias("_p"), F.col("size").alias("dst_size"))
    status = F.when(F.col("dst_size").isNull(), "pending").when(F.col("size") == F.col("dst_size"), "completed").otherwise("mismatched")
    return src.join(d, F.col("path") == F.col("_p"), "left").select("path", F.col("size").alias("src_size"), "dst_size", status.alias("status"))


def resumable(ledger: DataFrame) -> DataFrame:
    """Tasks to run again; mismatched ones are not."""
    return ledger.filter(F.col("status").isin("pending", "failed"))


def merge_status(ledger: DataFrame, updates: DataFrame) -> DataFrame:
    """The ledger with the status of updates (path, status) where there is one."""
    u = updates.select(F.col("path").alias("_p"), F.col("status").alias("_s"))
    return ledger.join(u, F.col("path") == F.col("_p"), "left").withColumn("status", F.coalesce("_s", "status")).drop("_p", "_s")


def estimate(ledger: DataFrame, workers: int, rate: float) -> DataFrame:
    """Count and bytes by status, and the seconds they take with so many workers at `rate` bytes a second."""
    return ledger.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("src_size").alias("bytes"), (F.sum("src_size") / F.lit(float(workers * rate))).alias("seconds"))


def checksum_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """`<md5> <path>` lines to (md5, path); malformed ones are skipped."""
    p = r"^\s*([0-9a-fA-F]{32})\s+(\S.*?)\s*$"
    return lines.filter(F.col(column).rlike(p)).select(F.lower(F.regexp_extract(column, p, 1)).alias("md5"), F.regexp_extract(column, p, 2).alias("path"))


def checksums_ok(listed: DataFrame, files: DataFrame) -> DataFrame:
    """listed (md5, path) against files (path, content): path and ok; a file that is not there has an empty sum and fails."""
    f = files.select(F.col("path").alias("_p"), F.md5("content").alias("_m"))
    return listed.join(f, F.col("path") == F.col("_p"), "left").select("path", (F.coalesce("_m", F.lit("")) == F.col("md5")).alias("ok"))


def type_stats(files: DataFrame, ext: Column) -> DataFrame:
    """files (name, size, modified): count, bytes and first, largest and newest name for each type."""
    return files.groupBy(ext.alias("ext")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.min("name").alias("first"),
        F.max_by("name", F.struct("size", "name")).alias("largest"), F.max_by("name", F.struct("modified", "name")).alias("newest"),
    )


def shared_names(a: DataFrame, b: DataFrame, name: str = "name") -> DataFrame:
    return a.select(name).intersect(b.select(name)).orderBy(name)


def remaining(every: DataFrame, done: list[DataFrame], name: str) -> DataFrame:
    """Names that none of the tables in done has."""
    gone = reduce(DataFrame.union, [d.select(name) for d in done]).distinct()
    return every.select(name).distinct().join(gone, name, "left_anti")


def all_logs(logs: dict[str, DataFrame]) -> DataFrame:
    """Logs of one set of columns as one table, each row with its log's name (kind); none gives an error."""
    return reduce(DataFrame.unionByName, [df.withColumn("kind", F.lit(name)) for name, df in logs.items()])


def same_group(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Groups of two or more: keys, sorted values joined by commas, n."""
    got = df.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("v"))
    return got.filter(F.size("v") > 1).select(*keys, F.array_join(F.transform("v", lambda x: x.cast("string")), ",").alias("members"), F.size("v").alias("n"))


def require_columns(df: DataFrame, names: list[str]) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
