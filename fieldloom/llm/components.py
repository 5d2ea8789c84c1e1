"""Connected components by alternating large and small stars; nothing goes to the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select("a", "b")
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m"))
    low = low.select("a", F.least("a", "m").alias("m"))
    hung = both.join(low, "a").select(F.col("b").alias("x"), "m", "a")
    if large:
        out = hung.filter(F.col("x") > F.col("a")).select(F.col("x").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("x").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """edges: a, b (equal types, any direction, repeats allowed). One row (node, component) for each node in an
    edge with another node; component is its smallest reachable node.

    Minima are combined before they shuffle and the joins are plain equi-joins, so a node with very many neighbours is one
    skewed key that adaptive execution splits. Rounds go on until nothing changes. No edges give no rows.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    now = scratch.write(now, f"{name}0")
    mark, turn = None, 0
    while True:
        turn += 1
        # now: a > b, each node pointing to smaller ones
        now = scratch.write(_stars(_stars(now, True), False), f"{name}{turn}")
        scratch.drop(f"{name}{turn - 1}")
        got = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 30)))).first()
        if tuple(got) == mark:
            break
        mark = tuple(got)
    pairs = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return pairs.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
