"""Model weights as tables (ckpt, key, idx, v): task vectors and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def mergeable(base: DataFrame, tuned: DataFrame) -> DataFrame:
    """Keys present in both with equal shape and floating kind: tables (key, shape, kind)."""
    t = tuned.select("key", F.col("shape").alias("shape2"), F.col("kind").alias("kind2"))
    return base.join(t, "key").filter((F.col("shape") == F.col("shape2")) & F.col("kind").startswith("float") & F.col("kind2").startswith("float")).select("key")


def task_vectors(base: DataFrame, tuned: DataFrame) -> DataFrame:
    """Differences (ckpt, key, idx, v) of tuned checkpoints from the base (key, idx, v); keys the base lacks raise no row."""
    b = base.select("key", "idx", F.col("v").alias("v0"))
    return tuned.join(b, ["key", "idx"]).select("ckpt", "key", "idx", (F.col("v") - F.col("v0")).alias("v"))


def magnitude_max(vectors: DataFrame) -> DataFrame:
    """The value of largest magnitude for each weight; the first checkpoint among equals."""
    return vectors.groupBy("key", "idx").agg(F.max_by("v", F.struct(F.abs("v").alias("m"), (-F.col("ckpt")).alias("o"))).alias("v"))


def total(vectors: DataFrame) -> DataFrame:
    return vectors.groupBy("key", "idx").agg(F.sum("v").alias("v"))


def scaled(vectors: DataFrame, k: float) -> DataFrame:
    return vectors.withColumn("v", F.col("v") * k)


def norm(vectors: DataFrame) -> DataFrame:
    return vectors.groupBy("ckpt").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("l2"))


def apply(base: DataFrame, delta: DataFrame, k: float = 1.0) -> DataFrame:
    """base + k * delta; weights without a delta stay."""
    d = delta.select("key", "idx", F.col("v").alias("dv"))
    return base.join(d, ["key", "idx"], "left").select("key", "idx", (F.col("v") + k * F.coalesce("dv", F.lit(0.0))).alias("v"))


def save_weights(weights: DataFrame, path: str) -> None:
    """A model's state as a table (key, shape, kind, values), replacing what is there."""
    weights.select("key", "shape", "kind", "values").write.mode("overwrite").parquet(path)


def load_weights(spark: SparkSession, path: str) -> DataFrame:
    """The state that save_weights wrote, one row a tensor; a row without values is no tensor and is left out."""
    return spark.read.parquet(path).select("key", "shape", "kind", "values").filter("values is not null")


def long_weights(weights: DataFrame) -> DataFrame:
    """Tensors to one row a number (key, idx, v), as the merges take them; only of floating kinds."""
    return weights.filter(F.col("kind").startswith("float")).select("key", F.posexplode("values").alias("idx", "v")).withColumn("idx", F.col("idx").cast("bigint"))
