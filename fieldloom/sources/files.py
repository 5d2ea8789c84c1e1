"""Files as rows: listings, archives, text and number formats."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_rasters(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """path, name, size and modified of .tif and .tiff files (any case) in a folder, or below it. Contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", "*.{tif,tiff,TIF,TIFF,Tif,Tiff}").load(folder)
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def read_contents(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "content")


def _members(batches):
    schema = pa.schema([("path", pa.string()), ("member", pa.string()), ("content", pa.binary())])
    for batch in batches:
        for path, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            with zipfile.ZipFile(io.BytesIO(blob)) as z:
                for name in z.namelist():
                    if name.lower().endswith((".tif", ".tiff")):
                        yield pa.record_batch([[path], [name], [z.read(name)]], schema=schema)


def zip_rasters(spark: SparkSession, folder: str) -> DataFrame:
    """Raster members of the .zip files of a folder (path, member, content), one member at a time."""
    return read_contents(spark, folder, "*.zip").mapInArrow(_members, "path string, member string, content binary")


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_excel(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """A sheet through pandas on the driver (a sheet holds a million rows at most); needs an Excel engine."""
    try:
        import openpyxl  # noqa: F401
    except ImportError as e:
        raise RuntimeError("reading Excel files needs openpyxl") from e
    import pandas as pd

    return spark.createDataFrame(pd.read_excel(path, sheet_name=sheet))


def two_decimals(c: Column) -> Column:
    """%.2f, without grouping commas."""
    return F.format_string("%.2f", c.cast("double"))


def yes_no(c: Column) -> Column:
    return F.when(c, "yes").otherwise("no")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """A JSON object a line; NaN is written as a string, null is left out."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def write_missing(df: DataFrame, path: str, key: str) -> int:
    """Append the rows whose key is not there yet; returns how many."""
    spark = df.sparkSession
    try:
        done = spark.read.parquet(path).select(key)
        df = df.join(done, key, "left_anti")
    except Exception as e:  # no table yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    n = df.count()
    if n:
        df.write.mode("append").parquet(path)
    return n


def bad_samples(spark: SparkSession, path: str) -> DataFrame:
    """`country,idx` lines to columns; others are skipped."""
    p = r"^\s*([^,]+?)\s*,\s*(\d+)\s*$"
    t = spark.read.text(path).filter(F.col("value").rlike(p))
    return t.select(F.regexp_extract("value", p, 1).alias("country"), F.regexp_extract("value", p, 2).cast("bigint").alias("idx"))
