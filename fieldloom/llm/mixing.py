"""Mix sources to target weights by hash-threshold histograms.

Each source gets a token budget. It is met without sorting: every document has a hash, the mix takes
the documents whose hash lies below its source's threshold, and the threshold is read off a histogram
of tokens by (source, hash bucket). Only the bucket in which the budget runs out is refined, into
buckets 4,096 times finer, until the threshold is an exact hash. Thresholds are nested: a larger budget takes a
superset of the documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import order_hash

BITS, STEP = 60, 12


def _targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """sizes: one row for each source (source, source_size). Adds weight and target.

    Filling by weight with a ceiling for each source has a closed form: in order of ceiling / weight the
    first k sources are full and the others share what is left by weight, for the smallest k at
    which the next one stays below its ceiling. The windows run over the table of sources, which the
    aggregation has already brought down to one row for each.
    """
    order = W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = reduce(lambda c, kw: c.when(turn == kw[0], F.lit(float(kw[1]))), enumerate(weights), F.when(F.lit(False), 0.0))
    sizes = sizes.withColumn("weight", weight).withColumn("ceiling", F.col("source_size") * F.lit(float(cap)))
    fill = W.orderBy(F.col("ceiling") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    sizes = (
        sizes.withColumn("full_before", F.coalesce(F.sum("ceiling").over(before), F.lit(0.0)))
        .withColumn("left_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("budget", F.sum("source_size").over(whole) * F.lit(float(share)))
        .withColumn("level", (F.col("budget") - F.col("full_before")) / F.col("left_weight"))
        .withColumn("open", F.col("level") * F.col("weight") < F.col("ceiling"))
        .withColumn("at", F.row_number().over(fill))
    )
    first = F.min(F.when(F.col("open"), F.struct("at", "level"))).over(whole)
    return sizes.withColumn("first", first).select(
        "source",
        "source_size",
        F.when(F.col("first").isNull() | (F.col("at") < F.col("first.at")), F.col("ceiling"))
        .otherwise(F.col("first.level") * F.col("weight"))
        .alias("target"),
    )


def _bucket(depth: int) -> Column:
    return F.shiftright(F.col("h"), BITS - STEP * depth)


def mix_plan(
    docs: DataFrame,
    key: str,
    source: str,
    size: Column,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.0,
    cap: float = 3.0,
    salt: str = "mix:",
) -> DataFrame:
    """One row for each row of docs: key, source, size, source_size, target, copies, taken.

    docs: any columns; only key, source and what `size` reads are used. Weights go to the sources in code-point
    order, null last, repeating. The sources share `share` of all sizes; no target exceeds
    `cap` times its source's size and the excess goes to the others by weight.

    A source whose target is r times its size takes floor(r) whole copies of each document and one
    more of those below its threshold. The threshold falls where the sum comes nearest the target;
    a tie leaves the boundary document out.

    Edge cases: a null size or text counts 0 and takes 0; null is a source of its own; equal
    keys have equal hashes and are taken or left together, so repeated rows agree; a source of size 0 has target 0;
    an empty table gives an empty table; other columns are not looked at, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    sized = scratch.write(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).alias("source"),
            F.coalesce(size, F.lit(0)).cast("long").alias("size"),
            order_hash(F.col(key), salt).alias("h"),
        ),
        "sized",
    )
    hist = scratch.write(sized.groupBy("source", _bucket(1).alias("b")).agg(F.sum("size").alias("n")), "hist")
    targets = _targets(hist.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, cap)
    plan = scratch.write(
        targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("below", F.lit(0.0)),
        "plan0",
    )
    for depth in range(1, BITS // STEP + 1):
        if depth > 1:
            # documents of the boundary bucket alone
            edge = plan.select(F.col("source").alias("s"), F.col("bucket"))
            near = sized.join(edge, F.col("source").eqNullSafe(F.col("s")) & (_bucket(depth - 1) == F.col("bucket")))
            hist = near.groupBy("source", _bucket(depth).alias("b")).agg(F.sum("size").alias("n"))
        running = F.sum("n").over(W.partitionBy("source").orderBy("b"))
        cum = hist.withColumn("cum", running).select(F.col("source").alias("s"), "b", "n", "cum")
        # the first bucket in which the part passes; before it everything is taken
        found = (
            plan.join(cum, F.col("source").eqNullSafe(F.col("s")), "left")
            .groupBy("source", "source_size", "target", "whole", "part", "below")
            .agg(
                F.min(F.when(F.col("below") + F.col("cum") > F.col("part"), F.struct("b", "n", "cum"))).alias("edge"),
            )
        )
        plan = scratch.write(
            found.select(
                "source",
                "source_size",
                "target",
                "whole",
                "part",
                (F.col("below") + F.coalesce(F.col("edge.cum") - F.col("edge.n"), F.lit(0))).alias("below"),
                # no bucket passes: the budget never runs out and no bucket is the boundary
                F.coalesce(F.col("edge.b"), F.lit(-1)).alias("bucket"),
                F.coalesce(F.col("edge.n"), F.lit(0)).alias("edge_n"),
            ),
            f"plan{depth}",
        )
    bound = plan.select(
        F.col("source").alias("s"),
        "source_size",
        "target",
        "whole",
        F.when(F.col("bucket") < 0, F.lit(-1))
        .otherwise(F.col("bucket") + F.when(F.col("part") - F.col("below") > F.col("below") + F.col("edge_n") - F.col("part"), 1).otherwise(0))
        .alias("threshold"),
    )
    copies = F.col("whole") + F.when(F.col("h") < F.col("threshold"), 1).otherwise(0)
    return sized.join(bound, F.col("source").eqNullSafe(F.col("s"))).select(
        "key", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )
