"""Queries on unions, repaired polygons and outlines of regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldloom.functions import expressions as X
from fieldloom.functions import geometry as G
from fieldloom.operators import agreement as A
from fieldloom.operators import batches, joins, metrics, overlay, simplify

from .registry import query
from .views import SHAPE_HOLDS, fields, rasters, shapes, sql, table

BOX = ("x0", "y0", "x1", "y1")


def _boxes(spark, d):
    return fields(spark, d).withColumn("ring", G.box_ring(*[F.col(c) for c in BOX]))


@query("g3_dissolve_boxes", sql("fields", """&e as (select distinct unnest([x0, x1]) as x from fields),
s as (select x, lead(x) over (order by x) as nx from e),
i as (select s.x, s.nx, f.y0, f.y1 from s join fields f on f.x0 <= s.x and f.x1 >= s.nx),
r as (select *, coalesce(max(y1) over (partition by x order by y0, y1 rows between unbounded preceding and 1 preceding), y0) as before from i)
select sum(greatest(y1 - greatest(y0, before), 0) * (nx - x))::bigint as area from r"""))
def g3_boxes(spark, d):
    return overlay.dissolve(_boxes(spark, d)).agg(F.round(F.sum("area"), 0).cast("bigint").alias("area"))


# between two neighbouring heights of corners and crossings the width of the union is linear, so its width half-way up counts
UNION = """&m as (select *, least(px, qx) as lx, greatest(px, qx) as hx, least(py, qy) as ly, greatest(py, qy) as hy from edges),
x as (select a.py + (a.qy - a.py) * ((b.px - a.px) * (b.qy - b.py) - (b.py - a.py) * (b.qx - b.px)) / ((a.qx - a.px) * (b.qy - b.py) - (a.qy - a.py) * (b.qx - b.px)) as y,
    ((b.px - a.px) * (b.qy - b.py) - (b.py - a.py) * (b.qx - b.px)) / ((a.qx - a.px) * (b.qy - b.py) - (a.qy - a.py) * (b.qx - b.px)) as s,
    ((b.px - a.px) * (a.qy - a.py) - (b.py - a.py) * (a.qx - a.px)) / ((a.qx - a.px) * (b.qy - b.py) - (a.qy - a.py) * (b.qx - b.px)) as t
  from m a join m b on a.field_id < b.field_id and a.lx <= b.hx and b.lx <= a.hx and a.ly <= b.hy and b.ly <= a.hy and (a.qx - a.px) * (b.qy - b.py) <> (a.qy - a.py) * (b.qx - b.px)),
v as (select distinct y from (select py as y from edges union all select y from x where s between 0 and 1 and t between 0 and 1)),
g as (select y, lead(y) over (order by y) as ny from v),
c as (select g.y, g.ny, e.field_id, e.px + (e.qx - e.px) * ((g.y + g.ny) / 2 - e.py) / (e.qy - e.py) as x from g join m e on e.ly <= g.y and e.hy >= g.ny and e.ly < e.hy),
k as (select y, ny, x, (row_number() over (partition by y, field_id order by x) - 1) % 2 as odd, lead(x) over (partition by y, field_id order by x) as nx from c),
r as (select *, coalesce(max(nx) over (partition by y order by x, nx rows between unbounded preceding and 1 preceding), x) as before from k where odd = 0)
select round(sum(greatest(nx - greatest(x, before), 0) * (ny - y)), -2)::double as area from r"""


@query("g3_dissolve_shapes", sql("shapes", UNION))
def g3_shapes(spark, d):
    return overlay.dissolve(shapes(spark, d), cell=640.0, grid=2e-6).agg(F.round(F.sum("area"), -2).alias("area"))


@query("g3_dissolve_points", sql("shapes", f"&px as (select event_id, (event_id * 37) % 20000 + 0.25::double as x, (event_id * 91) % 20000 + 0.125::double as y from events) select event_id from px where exists (select 1 from shapes s where {SHAPE_HOLDS})"))
def g3_points(spark, d):
    """Points inside a part of the union: each in one part at most."""
    p = table(spark, d, "events").selectExpr("event_id", "(event_id * 37) % 20000 + 0.25D as x", "(event_id * 91) % 20000 + 0.125D as y")
    parts = overlay.dissolve(shapes(spark, d), cell=1280.0, grid=4e-6).select("ring", "holes")
    return joins.points_in_parts(p, parts, 640).select("event_id")


@query("e8_repair", sql("fields", """select field_id, part::int as part, case when field_id % 4 = 3 then 1 else 0 end::int as n_holes,
 case field_id % 4 when 0 then (x1 - x0) * (y1 - y0) / 4.0::double when 3 then (x1 - x0) * (y1 - y0) - 2500 else (x1 - x0) * (y1 - y0) end::double as area
from fields, (select unnest([0, 1]) as part) where part = 0 or field_id % 4 = 0"""))
def e8(spark, d):
    """Bow ties, spikes, rings that go round twice, and loops inside."""
    point = lambda x, y: F.struct(F.expr(x).cast("double").alias("x"), F.expr(y).cast("double").alias("y"))
    ring = lambda *p: F.array(*[point(*q) for q in p])
    a, b, c, e = ("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1")
    loop = [("x0 + 50", "y0 + 50"), ("x0 + 50", "y0 + 100"), ("x0 + 100", "y0 + 100"), ("x0 + 100", "y0 + 50"), ("x0 + 50", "y0 + 50")]
    kinds = [ring(a, c, b, e, a), ring(a, b, c, ("x1", "y1 + 50"), c, e, a), ring(a, b, c, e, a, b, c, e, a), ring(a, b, c, e, a, *loop, a)]
    k = F.col("field_id") % 4
    crooked = F.when(k == 0, kinds[0]).when(k == 1, kinds[1]).when(k == 2, kinds[2]).otherwise(kinds[3])
    got = overlay.repaired(fields(spark, d).select("field_id", crooked.alias("ring")))
    return got.select("field_id", "part", F.size("holes").alias("n_holes"), F.round("area", 4).alias("area"))


@query("e16_regions", sql("rasters", """&n as (select chip, r, c, r * 8 + c as pos, bad from rasters),
reach(chip, pos, low) as (
  select chip, pos, pos from n union
  select a.chip, b.pos, a.low from reach a join n f on f.chip = a.chip and f.pos = a.pos join n b on b.chip = a.chip and b.bad = f.bad and abs(b.r - f.r) + abs(b.c - f.c) = 1),
l as (select chip, pos, min(low) as low from reach group by 1, 2),
z as (select n.chip, n.bad, l.low, count(*) as area from n join l using (chip, pos) group by all)
select chip, bad::double as value, count(*) as n_regions, sum(area)::double as area, max(area)::double as largest from z group by 1, 2"""))
def e16(spark, d):
    band = F.transform(F.array_sort(F.collect_list(F.struct("r", "c", F.col("bad").cast("double").alias("bad")))), lambda s: s["bad"])
    got = overlay.region_polygons(rasters(spark, d).groupBy("chip").agg(band.alias("band")), 8, 8)
    return got.groupBy("chip", "value").agg(F.count(F.lit(1)).alias("n_regions"), F.sum("area").alias("area"), F.max("area").alias("largest"))


@query("e16_mosaic", sql("rasters", "select bad::double as value, count(*)::double as area from rasters group by 1"))
def e16_mosaic(spark, d):
    """Regions that go on across bands: 16 bands a row."""
    band = F.transform(F.array_sort(F.collect_list(F.struct("r", "c", F.col("bad").cast("double").alias("bad")))), lambda s: s["bad"])
    bands = rasters(spark, d).groupBy("chip").agg(band.alias("band")).selectExpr("chip % 16 as gx", "chip div 16 as gy", "band")
    return overlay.mosaic_regions(bands, 8).groupBy(F.col("by").alias("value")).agg(F.sum("area").alias("area"))


# pairs of shapes and of the same shapes moved: what lies below both edges, edge by edge
MOVED = """&moved as (select field_id, px + field_id % 37 as px, py + field_id % 23 as py, qx + field_id % 37 as qx, qy + field_id % 23 as qy from edges),
box as (select field_id, min(px) as lx, max(px) as hx, min(py) as ly, max(py) as hy from edges group by 1),
near as (select a.field_id as l_id, b.field_id as r_id from box a join box b on a.lx <= b.hx + b.field_id % 37 and b.lx + b.field_id % 37 <= a.hx and a.ly <= b.hy + b.field_id % 23 and b.ly + b.field_id % 23 <= a.hy),
up as (select a.l_id, a.r_id, s.px as apx, s.py as apy, s.qx as aqx, s.qy as aqy, t.px as bpx, t.py as bpy, t.qx as bqx, t.qy as bqy,
    greatest(least(s.px, s.qx), least(t.px, t.qx)) as l, least(greatest(s.px, s.qx), greatest(t.px, t.qx)) as r
  from near a join edges s on s.field_id = a.l_id join moved t on t.field_id = a.r_id where s.px <> s.qx and t.px <> t.qx),
f as (select *, apy + (aqy - apy) * (l - apx) / (aqx - apx) as a0, apy + (aqy - apy) * (r - apx) / (aqx - apx) as a1, bpy + (bqy - bpy) * (l - bpx) / (bqx - bpx) as b0, bpy + (bqy - bpy) * (r - bpx) / (bqx - bpx) as b1 from up where r > l),
w as (select *, case when (a0 - b0) * (a1 - b1) < 0 then (a0 - b0) / (a0 - b0 - a1 + b1) else 1 end as t from f),
i as (select l_id, r_id, case when (aqx > apx) = (bqx > bpx) then 1 else -1 end * (r - l) * case when t = 1 then (least(a0, b0) + least(a1, b1)) / 2
    else ((least(a0, b0) + a0 + (a1 - a0) * t) * t + (a0 + (a1 - a0) * t + least(a1, b1)) * (1 - t)) / 2 end as v from w),
c as (select l_id, r_id, sum(v) as shared from i group by 1, 2),
area as (select field_id, abs(sum(px * qy - qx * py)) / 2 as area from edges group by 1),
pairs as (select l_id, r_id, shared, round(shared / (a.area + b.area - shared), 6) as iou from c join area a on a.field_id = l_id join area b on b.field_id = r_id where shared > 0.001)
"""


def _moved(spark, d):
    point = lambda p: F.struct((p["x"] + F.col("field_id") % 37).alias("x"), (p["y"] + F.col("field_id") % 23).alias("y"))
    return shapes(spark, d).withColumn("ring", F.transform("ring", point))


def _sets(spark, d):
    return tuple(f.select(F.col("field_id").alias("id"), "ring") for f in (shapes(spark, d), _moved(spark, d)))


@query("j9_shape_measures", sql("shapes", MOVED + "select l_id, r_id, round(shared + 0.00123, 2) as shared_area, iou from pairs"))
def j9_shapes(spark, d):
    # moved off the fractions that fall halfway
    shown = X.rounded(F.col("shared_area") + 0.00123, 2).alias("shared_area"), X.rounded(F.col("iou"), 6).alias("iou")
    return A.ring_measures(*_sets(spark, d), 700, 0.001, *shown, far=False)


@query("j10_shape_overlap", sql("shapes", MOVED + "select l_id, arg_min(r_id, [-iou, r_id]) as r_id, max(iou) as iou from pairs where iou > 0 group by 1"))
def j10_shapes(spark, d):
    return A.best_rings(*_sets(spark, d), 700, 0.001, 6)


@query("j11_shape_matches", sql("shapes", MOVED + "select l_id, min(r_id) as r_id from pairs where iou > 0.5 group by 1"))
def j11_shapes(spark, d):
    return A.ring_matches(*_sets(spark, d), 700, 0.5, 6).select("l_id", "r_id")


@query("g16_shape_scores", sql("shapes", MOVED + """, m as (select l_id, min(r_id) as r_id from pairs where iou > 0.5 group by 1),
n as (select (select count(*) from m) as tp, (select count(*) from shapes) - (select count(distinct r_id) from m) as fp, (select count(*) from shapes) - (select count(*) from m) as fn)
select tp, fp, fn, coalesce(tp::double / nullif(tp + fp, 0), 0) as precision, coalesce(tp::double / nullif(tp + fn, 0), 0) as recall, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)::double as f1 from n"""))
def g16_shapes(spark, d):
    c = A.object_counts(shapes(spark, d), _moved(spark, d), A.ring_matches(*_sets(spark, d), 700, 0.5, 6))
    return c.withColumns(metrics.object_scores(F.col("tp"), F.col("fp"), F.col("fn")))


@query("u3_shape_false_positives", sql("shapes", MOVED + "select field_id from shapes where field_id not in (select min(r_id) from pairs where iou > 0.5 group by l_id)"))
def u3_shapes(spark, d):
    m = A.ring_matches(*_sets(spark, d), 700, 0.5, 6).select(F.col("r_id").alias("field_id"))
    return _moved(spark, d).select("field_id").join(m, "field_id", "left_anti")


@query("j16_shape_pixels", sql("shapes", f"&px as (select event_id, (event_id * 37) % 20000 + 0.25::double as x, (event_id * 91) % 20000 + 0.125::double as y, cast(floor(value * 100) as bigint) as q from events) select s.field_id, count(*) as n, sum(q)::bigint as total from px join shapes s on {SHAPE_HOLDS} group by 1"))
def j16_shapes(spark, d):
    p = table(spark, d, "events").selectExpr("(event_id * 37) % 20000 + 0.25D as x", "(event_id * 91) % 20000 + 0.125D as y", "cast(floor(value * 100) as bigint) as q")
    return joins.ring_totals(p, shapes(spark, d), "field_id", 700, "q")


@query("s31_batches", "select doc_id, row_number() over (order by doc_id) - 1 as position, (row_number() over (order by doc_id) - 1) // 32 as batch, ((row_number() over (order by doc_id) - 1) % 32)::int as place from labels where quality = 1")
def s31(spark, d):
    s = table(spark, d, "labels").selectExpr("doc_id", "if(quality = 1, 'val', 'train') as split")
    return batches.batches(s, "validate", "doc_id", 32).drop("split")


# customers as cells of a crooked lattice, 40 a row, each side with a point a little off its middle that neighbours share
CORNER = ("100.0::double * ({i}) + (({i}) * 7 + ({j}) * 13) % 10", "100.0::double * ({j}) + (({i}) * 11 + ({j}) * 5) % 10")


@query("e12_shared_borders", "with c as (select c_custkey as id, c_custkey % 40 as i, c_custkey // 40 as j from customer), p as (select id, unnest([0, 1, 2, 3]) as k, unnest([i, i + 1, i + 1, i]) as i, unnest([j, j, j + 1, j + 1]) as j from c), x as (select id, k, "
       + CORNER[0].format(i="i", j="j") + " as x, " + CORNER[1].format(i="i", j="j") + " as y from p) select u.id, 5 as n, round(abs(sum(u.x * v.y - v.x * u.y)) / 2, 3)::double as area from x u join x v on u.id = v.id and v.k = (u.k + 1) % 4 group by 1")
def e12_shared(spark, d):
    x = lambda i, j: 100.0 * i + (i * 7 + j * 13) % 10
    y = lambda i, j: 100.0 * j + (i * 11 + j * 5) % 10
    i, j = F.col("i"), F.col("j")
    corners = [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1), (i, j)]
    points = []
    for (a, b), (u, v) in zip(corners[:-1], corners[1:], strict=True):
        points += [(x(a, b), y(a, b)), ((x(a, b) + x(u, v)) / 2 + 1.0, (y(a, b) + y(u, v)) / 2 + 1.0)]
    ring = F.array(*[F.struct(p.alias("x"), q.alias("y")) for p, q in [*points, points[0]]])
    cells = table(spark, d, "customer").selectExpr("c_custkey as id", "c_custkey % 40 as i", "c_custkey div 40 as j").select("id", ring.alias("ring"))
    done = simplify.simplify_shared(cells, "id", "ring", 5.0)
    return done.select("id", F.size("ring").alias("n"), F.round(G.ring_area(F.col("ring")), 3).alias("area"))


@query("e11_ribbons", sql("fields", "select field_id, 1 as n_holes, round((2.0 * (x1 - x0 + y1 - y0) * 20 - 400 + 4 * 8 * 100 * sin(pi() / 16) / 2) / 10)::double as area from fields"))
def e11(spark, d):
    """Within 10 of each box's outline: bands along four sides, four inner corners once, and quarter rounds of 8 steps outside."""
    got = overlay.ribbons(_boxes(spark, d).select("field_id", "ring"), 10.0, quarter=8)
    return got.select("field_id", F.size("holes").alias("n_holes"), F.round(F.col("area") / 10).alias("area"))
