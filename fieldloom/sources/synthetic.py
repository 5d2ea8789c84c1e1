"""Synthetic inputs from a seed: fields and chips made of hashed row numbers, the same in every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _unit(seed: int, *parts) -> Column:
    """A number in [0, 1) for each combination of seed and parts."""
    return F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(1_000_003)) / 1_000_003


def fields(spark: SparkSession, n: int = 12, seed: int = 7, lon: float = -55.5, lat: float = -12.5) -> DataFrame:
    """n boxes of 0.002 to 0.009 degrees within 0.02 of a point."""
    k = F.col("field_id")
    out = spark.range(n).withColumnRenamed("id", "field_id")
    out = out.withColumns({"x0": lon + 0.04 * _unit(seed, k, F.lit("x")) - 0.02, "y0": lat + 0.04 * _unit(seed, k, F.lit("y")) - 0.02})
    return out.withColumns({"x1": F.col("x0") + 0.002 + 0.007 * _unit(seed, k, F.lit("w")), "y1": F.col("y0") + 0.002 + 0.007 * _unit(seed, k, F.lit("h"))})


def chips(spark: SparkSession, n: int = 2, side: int = 16, seed: int = 11) -> DataFrame:
    """n chips in two windows of four bands, values 200 to 2999, window b 400 higher (chip, window_a, window_b)."""
    cells = F.sequence(F.lit(0), F.lit(side * side - 1))
    band = lambda b: F.transform(cells, lambda i: (200 + F.floor(2800 * _unit(seed, F.col("chip"), F.lit(b), i))).cast("int"))
    out = spark.range(n).select(F.concat(F.lit("chip_"), F.col("id").cast("string")).alias("chip"))
    out = out.withColumn("window_a", F.array(*[band(b) for b in range(4)]))
    return out.withColumn("window_b", F.transform("window_a", lambda b: F.transform(b, lambda v: v + 400)))
