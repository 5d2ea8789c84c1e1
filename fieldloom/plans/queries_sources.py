"""Queries through the library's own data sources: what is written is read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fieldloom.functions.shared import shared_folder
from fieldloom.operators import batches
from fieldloom.sources import catalogue, cube

from .registry import query
from .views import rasters, scenes, sql


def _catalogue(spark, d):
    box = ["cast(scene_id % 360 - 180 as double) as x0", "cast(scene_id % 170 - 85 as double) as y0", "cast(scene_id % 360 - 179 as double) as x1", "cast(scene_id % 170 - 84 as double) as y1"]
    items = scenes(spark, d).selectExpr("scene_id", "cast(tile as string) as tile", "ts", "cast(cloud as double) as cloud", "cast(nodata as double) as nodata", *box)
    root = f"{shared_folder(spark)}/catalogue-{uuid.uuid4().hex}"
    catalogue.write_catalogue(items, root)
    return catalogue.read_catalogue(spark, root)


@query("s7_catalogue_source", sql("scenes", "select scene_id, tile::varchar as tile, cloud::double as cloud from scenes where tile in (3, 7, 11) and ts >= timestamp '1997-03-15' and ts < timestamp '1997-06-01' and cloud <= 10 and nodata < 50"))
def s7_source(spark, d):
    found = _catalogue(spark, d).filter("tile in ('3', '7', '11') and ts >= timestamp_ntz '1997-03-15' and ts < timestamp_ntz '1997-06-01' and cloud <= 10 and nodata < 50")
    return found.select("scene_id", "tile", "cloud")


@query("s8_catalogue_boxes", sql("scenes", "select tile::varchar as tile, count(*) as n from scenes where scene_id % 360 - 180 <= 10 and scene_id % 360 - 179 >= -20 and scene_id % 170 - 85 <= 30 and scene_id % 170 - 84 >= -5 and scene_id % 2 = 0 group by 1"))
def s8_source(spark, d):
    """Boxes go to the source, the rest (here a test that it cannot do) stays with Spark."""
    found = _catalogue(spark, d).filter("x0 <= 10 and x1 >= -20 and y0 <= 30 and y1 >= -5 and scene_id % 2 = 0")
    return found.groupBy("tile").agg(F.count(F.lit(1)).alias("n"))


@query("s16_cube", sql("rasters", "select row_number() over (order by chip) - 1 as position, sum(abs(q))::double as total, sum(bad)::double as inside, 'chip ' || chip as meta from rasters group by chip"))
def s16(spark, d):
    band = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("r", "c", c))), lambda s: s[c])
    chips = rasters(spark, d).groupBy("chip").agg(band("q").alias("image"), band("bad").alias("mask"))
    placed = batches.positions(chips, [F.col("chip")]).withColumn("meta", F.concat(F.lit("chip "), F.col("chip").cast("string")))
    root = f"{shared_folder(spark)}/cube-{uuid.uuid4().hex}"
    cube.write_cube(placed, root, 1, 8, 8, text=32, each=256)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, v: s + F.abs(v))
    images, masks, meta = (cube.read_cube(spark, root, a) for a in ("images", "masks", "meta"))
    both = images.select("position", total("values").alias("total")).join(masks.select("position", total("values").alias("inside")), "position")
    return both.join(meta.select("position", F.col("values")[0].alias("meta")), "position")
