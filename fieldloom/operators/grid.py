"""Fishnet grids and their coverage by fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions import geometry as G
from fieldloom.functions.expressions import percent

from .joins import box_join


def fishnet(spark: SparkSession, x0: int, y0: int, x1: int, y1: int, side: int) -> DataFrame:
    """Cells over the bounds (chip_id, x0, y0, x1, y1): as many columns and rows as cover them, numbered column by column."""
    cols, rows = -(-(x1 - x0) // side), -(-(y1 - y0) // side)
    i, j = F.floor(F.col("id") / rows), F.col("id") % rows
    return spark.range(cols * rows).select(
        F.col("id").alias("chip_id"), (x0 + i * side).alias("x0"), (y0 + j * side).alias("y0"), (x0 + (i + 1) * side).alias("x1"), (y0 + (j + 1) * side).alias("y1")
    )


def union_area(pieces: DataFrame, key: str) -> DataFrame:
    """Area of the union of each key's boxes (key, cov_area), overlaps counted once.

    Each key's boxes are cut into slabs at all their left and right edges; in a slab the union is one of intervals, found by a running maximum.
    """
    edges = pieces.select(key, F.explode(F.array("x0", "x1")).alias("x")).distinct()
    slabs = edges.withColumn("next_x", F.expr(f"lead(x) over (partition by {key} order by x)")).filter("next_x is not null")
    inside = slabs.withColumnRenamed(key, "_k").join(pieces, (F.col("_k") == F.col(key)) & (F.col("x0") <= F.col("x")) & (F.col("x1") >= F.col("next_x")))
    inside = inside.select(key, "x", "next_x", "y0", "y1")
    before = f"coalesce(max(y1) over (partition by {key}, x order by y0, y1 rows between unbounded preceding and 1 preceding), y0)"
    run = inside.withColumn("_before", F.expr(before)).withColumn("_len", F.greatest(F.col("y1") - F.greatest("y0", "_before"), F.lit(0)))
    return run.groupBy(key).agg(F.sum(F.col("_len") * (F.col("next_x") - F.col("x"))).alias("cov_area"))


def coverage(chips: DataFrame, fields: DataFrame, side: int) -> DataFrame:
    """chips plus chip_area, cov_area and cov_pct (0 without fields)."""
    c = chips.select("chip_id", *[F.col(k).alias(f"l_{k}") for k in ("x0", "y0", "x1", "y1")])
    f = fields.select(*[F.col(k).alias(f"r_{k}") for k in ("x0", "y0", "x1", "y1")])
    a, b = G.box("l_"), G.box("r_")
    pieces = box_join(c, f, side, exact=G.box_intersection(a, b) > 0).select(
        "chip_id", F.greatest(a[0], b[0]).alias("x0"), F.greatest(a[1], b[1]).alias("y0"), F.least(a[2], b[2]).alias("x1"), F.least(a[3], b[3]).alias("y1")
    )
    got = chips.join(union_area(pieces, "chip_id"), "chip_id", "left").withColumn("cov_area", F.coalesce("cov_area", F.lit(0)))
    got = got.withColumn("chip_area", G.box_area(G.box()))
    return got.withColumn("cov_pct", percent(F.col("cov_area"), F.col("chip_area")))


def covered_grid(chips: DataFrame, fields: DataFrame, side: int, least: float = 10.0) -> DataFrame:
    """Cells covered by more than `least` percent."""
    return coverage(chips, fields, side).filter(F.col("cov_pct") > least)


#: Hectares from which on a lattice has this step in metres, fixed values; on an edge both apply.
STEPS = [(0, 5, 10), (5, 20, 50), (20, 100, 100), (100, None, 200)]


def points_in_fields(fields: DataFrame) -> DataFrame:
    """Centres of a lattice of cells over each box (field_id, step, px, py), those on its edge included; finer for small fields."""
    ha = G.box_area(G.box()) / 10_000
    steps = F.array(*[F.when((ha >= lo) & ((ha <= hi) if hi else F.lit(True)), F.lit(step)) for lo, hi, step in STEPS])
    g = fields.withColumn("step", F.explode(F.filter(steps, lambda s: s.isNotNull())))

    def centres(lo: str, hi: str):
        return F.explode(F.transform(F.expr(f"sequence({lo}, {hi} - 1, cast(step as bigint))"), lambda v: v + F.expr("step div 2")))

    g = g.withColumn("px", centres("x0", "x1")).withColumn("py", centres("y0", "y1"))
    return g.filter((F.col("px") <= F.col("x1")) & (F.col("py") <= F.col("y1"))).select("field_id", "step", "px", "py")
