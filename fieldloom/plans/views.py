"""Views of the driver's tables as scenes, fields, chips, pixels and weights, and the same as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.operators.grid import fishnet

SIDE, EXTENT = 2560, 20480


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def scenes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").selectExpr("o_orderkey as scene_id", "o_custkey % 20 as tile", "o_orderdate as ts", "cast(floor(o_totalprice) as bigint) % 21 as cloud", "o_orderkey % 100 as nodata")


SCENES = """scenes as (
  select o_orderkey as scene_id, o_custkey % 20 as tile, o_orderdate as ts, cast(floor(o_totalprice) as bigint) % 21 as cloud, o_orderkey % 100 as nodata
  from orders)"""


def fields(spark: SparkSession, d: str) -> DataFrame:
    k = "c_custkey"
    return table(spark, d, "customer").selectExpr(
        f"{k} as field_id", f"({k} * 7919) % 20000 as x0", f"({k} * 104729) % 20000 as y0", f"({k} * 7919) % 20000 + 200 + ({k} * 31) % 700 as x1", f"({k} * 104729) % 20000 + 200 + ({k} * 17) % 700 as y1", "c_nationkey"
    )


FIELDS = """fields as (
  select c_custkey as field_id, (c_custkey * 7919) % 20000 as x0, (c_custkey * 104729) % 20000 as y0,
    (c_custkey * 7919) % 20000 + 200 + (c_custkey * 31) % 700 as x1, (c_custkey * 104729) % 20000 + 200 + (c_custkey * 17) % 700 as y1, c_nationkey
  from customer)"""


def shifted(spark: SparkSession, d: str) -> DataFrame:
    """A second digitisation of the fields: each moved by up to 120 and cut by up to 60."""
    return fields(spark, d).selectExpr("field_id", "x0 + (field_id * 13) % 120 as x0", "y0 + (field_id * 7) % 90 as y0", "x1 + (field_id * 13) % 120 - (field_id * 5) % 60 as x1", "y1 + (field_id * 7) % 90 as y1")


SHIFTED = """shifted as (
  select field_id, x0 + (field_id * 13) % 120 as x0, y0 + (field_id * 7) % 90 as y0, x1 + (field_id * 13) % 120 - (field_id * 5) % 60 as x1, y1 + (field_id * 7) % 90 as y1 from fields)"""


def shapes(spark: SparkSession, d: str) -> DataFrame:
    """Fields as polygons that are no boxes: a rhombus, an L or a right triangle by the key, within the field's box."""
    f = fields(spark, d).selectExpr("field_id", "x0", "y0", "(x1 - x0) div 2 as a", "((y1 - y0) div 4) * 2 + 1 as b")
    point = lambda x, y: F.struct(F.expr(x).cast("double").alias("x"), F.expr(y).cast("double").alias("y"))
    ring = lambda *p: F.array(*[point(*q) for q in (*p, p[0])])
    rhombus = ring(("x0", "y0 + b"), ("x0 + a", "y0"), ("x0 + 2 * a", "y0 + b"), ("x0 + a", "y0 + 2 * b"))
    ell = ring(("x0", "y0"), ("x0 + 2 * a", "y0"), ("x0 + 2 * a", "y0 + b"), ("x0 + a", "y0 + b"), ("x0 + a", "y0 + 2 * b"), ("x0", "y0 + 2 * b"))
    triangle = ring(("x0", "y0"), ("x0 + a", "y0"), ("x0", "y0 + b"))
    return f.select("field_id", F.when(F.col("field_id") % 3 == 0, rhombus).when(F.col("field_id") % 3 == 1, ell).otherwise(triangle).alias("ring"))


SHAPES = """shapes as (select field_id, field_id % 3 as kind, x0, y0, (x1 - x0) // 2 as a, ((y1 - y0) // 4) * 2 + 1 as b from fields),
corners as (
  select field_id, unnest(case kind when 0 then [[x0, y0 + b], [x0 + a, y0], [x0 + 2 * a, y0 + b], [x0 + a, y0 + 2 * b], [x0, y0 + b]]
    when 1 then [[x0, y0], [x0 + 2 * a, y0], [x0 + 2 * a, y0 + b], [x0 + a, y0 + b], [x0 + a, y0 + 2 * b], [x0, y0 + 2 * b], [x0, y0]]
    else [[x0, y0], [x0 + a, y0], [x0, y0 + b], [x0, y0]] end) as p, generate_subscripts(case kind when 0 then [1, 2, 3, 4, 5] when 1 then [1, 2, 3, 4, 5, 6, 7] else [1, 2, 3, 4] end, 1) as i
  from shapes),
edges as (select u.field_id, u.p[1]::double as px, u.p[2]::double as py, v.p[1]::double as qx, v.p[2]::double as qy from corners u join corners v on u.field_id = v.field_id and v.i = u.i + 1)"""
#: A shape (s) and a box (b) share a point; a point (px.x, px.y), on no edge, lies inside a shape (s).
SHAPE_TOUCHES = """case s.kind when 0 then greatest(b.x0 - s.x0 - s.a, s.x0 + s.a - b.x1, 0) * s.b + greatest(b.y0 - s.y0 - s.b, s.y0 + s.b - b.y1, 0) * s.a <= s.a * s.b
  when 1 then (s.x0 <= b.x1 and b.x0 <= s.x0 + 2 * s.a and s.y0 <= b.y1 and b.y0 <= s.y0 + s.b) or (s.x0 <= b.x1 and b.x0 <= s.x0 + s.a and s.y0 <= b.y1 and b.y0 <= s.y0 + 2 * s.b)
  else b.x1 >= s.x0 and b.y1 >= s.y0 and greatest(b.x0 - s.x0, 0) * s.b + greatest(b.y0 - s.y0, 0) * s.a <= s.a * s.b end"""
SHAPE_HOLDS = """case s.kind when 0 then abs(px.x - s.x0 - s.a) * s.b + abs(px.y - s.y0 - s.b) * s.a < s.a * s.b
  when 1 then px.x > s.x0 and px.y > s.y0 and ((px.x < s.x0 + 2 * s.a and px.y < s.y0 + s.b) or (px.x < s.x0 + s.a and px.y < s.y0 + 2 * s.b))
  else px.x > s.x0 and px.y > s.y0 and (px.x - s.x0) * s.b + (px.y - s.y0) * s.a < s.a * s.b end"""


def chips(spark: SparkSession, d: str) -> DataFrame:
    return fishnet(spark, 0, 0, EXTENT, EXTENT, SIDE)


CHIPS = """chips as (
  select (i * 8 + j)::bigint as chip_id, i * 2560 as x0, j * 2560 as y0, (i + 1) * 2560 as x1, (j + 1) * 2560 as y1
  from (select range as i from range(8)) a, (select range as j from range(8)) b)"""


def pixels(spark: SparkSession, d: str) -> DataFrame:
    """Events as pixels of chips (user_id): class codes, a season day, a confidence in hundredths."""
    return table(spark, d, "events").selectExpr(
        "event_id", "user_id as chip", "event_id div 16 % 16 as r", "event_id % 16 as c",
        "case event_type when 'view' then 8 when 'click' then 9 when 'signup' then 4 when 'purchase' then 0 else 5 end as scl",
        "cast(floor(value * 100) as bigint) % 100 as prob", "cast(floor(value * 10) as bigint) % 367 as doy",
        "cast(floor(value * 100) as bigint) % 3 as pred", "cast(floor(value * 7) as bigint) % 3 = 0 as ag",
    )


PIXELS = """pixels as (
  select event_id, user_id as chip, event_id // 16 % 16 as r, event_id % 16 as c,
    case event_type when 'view' then 8 when 'click' then 9 when 'signup' then 4 when 'purchase' then 0 else 5 end as scl,
    cast(floor(value * 100) as bigint) % 100 as prob, cast(floor(value * 10) as bigint) % 367 as doy,
    cast(floor(value * 100) as bigint) % 3 as pred, cast(floor(value * 7) as bigint) % 3 = 0 as ag
  from events)"""


def rasters(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings as 8 x 8 bands, one row a pixel; v is the value, bad marks negative ones, q is v in thousandths."""
    return table(spark, d, "embeddings").selectExpr("vec_id as chip", "label", "posexplode(embedding) as (pos, v)").selectExpr(
        "chip", "label", "cast(pos div 8 as bigint) as r", "cast(pos % 8 as bigint) as c", "cast(v as double) as v", "cast(v < 0 as bigint) as bad", "cast(floor(cast(v as double) * 1000) as bigint) as q"
    )


RASTERS = """rasters as (
  select vec_id as chip, label, ((pos - 1) // 8)::bigint as r, ((pos - 1) % 8)::bigint as c, v::double as v, (v < 0)::bigint as bad, cast(floor(v::double * 1000) as bigint) as q
  from (select vec_id, label, unnest(embedding) as v, generate_subscripts(embedding, 1) as pos from embeddings))"""


def weights(spark: SparkSession, d: str) -> DataFrame:
    """Whole-number weights: ckpt 0 is the base."""
    return rasters(spark, d).selectExpr("cast(label as bigint) as ckpt", "chip div 10 as key", "r * 8 + c as idx", "cast(q as double) as v", "chip").groupBy("ckpt", "key", "idx").agg({"v": "max"}).withColumnRenamed("max(v)", "v")


WEIGHTS = """weights as (
  select label::bigint as ckpt, chip // 10 as key, r * 8 + c as idx, max(q::double) as v from rasters group by all)"""

WITH = {"scenes": SCENES, "fields": FIELDS, "shifted": SHIFTED, "shapes": SHAPES, "chips": CHIPS, "pixels": PIXELS, "rasters": RASTERS, "weights": WEIGHTS}


def sql(uses: str, body: str) -> str:
    """An oracle text: the named views, then body (which may begin with more common tables and a comma)."""
    names = []
    for u in uses.split():
        names += [n for n in {"shifted": ["fields"], "shapes": ["fields"], "weights": ["rasters"]}.get(u, []) if n not in names]
        names += [u] if u not in names else []
    body = body.strip()
    return "with recursive " + ",\n".join(WITH[n] for n in names) + (",\n" if body.startswith("&") else "\n") + body.removeprefix("&")
