"""Numbered batches of samples in one order, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.functions.shared import settled

STAGES = {"fit": "train", "validate": "val", "test": "test"}


def positions(rows: DataFrame, order: list) -> DataFrame:
    """rows with `position`, 0 .. n - 1 in the order given; rows that tie in it are told apart by a hash of all their columns.

    Rows are dealt out by ranges of the order; a position is the number of rows in the ranges before, one sum over a row a range, and the place within the range.
    """
    tie = F.xxhash64(*rows.columns)
    ranged = rows.withColumn("_tie", tie).repartitionByRange(*order, F.col("_tie")).withColumn("_part", F.spark_partition_id())
    held = settled(ranged, "positions")
    counts = held.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row a range
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("_part", before.alias("_before"))
    place = F.row_number().over(W.partitionBy("_part").orderBy(*order, "_tie"))
    return held.join(counts, "_part").withColumn("position", (F.col("_before") + place - 1).cast("bigint")).drop("_part", "_before", "_tie")


def batches(samples: DataFrame, stage: str, key: str, size: int, seed: int = 0, epoch: int = 0, drop_last: bool = False) -> DataFrame:
    """The samples of a stage (split, key) with position, batch (from 0) and place in the batch.

    fit takes the train split by a hash of seed, epoch and key, so each epoch has an order of its own, the same in every run; validate and test
    take theirs by key. The last batch may be short; drop_last leaves it out.
    """
    if stage not in STAGES or size < 1:
        raise ValueError("a stage is fit, validate or test, and a batch has one sample at least")
    mine = samples.filter(F.col("split") == STAGES[stage])
    order = [F.xxhash64(F.lit(seed), F.lit(epoch), F.col(key)), F.col(key)] if stage == "fit" else [F.col(key)]
    placed = positions(mine, order).withColumn("batch", F.floor(F.col("position") / size)).withColumn("place", (F.col("position") % size).cast("int"))
    if drop_last:
        placed = placed.filter(F.col("batch") < F.lit(mine.count() // size))
    return placed
