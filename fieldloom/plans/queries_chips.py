"""Queries on fields and chips: grids, spatial joins, manifests, agreement."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldloom.functions import expressions as X
from fieldloom.functions import geometry as G
from fieldloom.functions.shared import settled, spread
from fieldloom.operators import agreement as A
from fieldloom.operators import grid, joins, manifest, metrics, raster

from .registry import query
from .views import SHAPE_HOLDS, SHAPE_TOUCHES, SIDE, chips, fields, shapes, shifted, sql, table

BOX = ("x0", "y0", "x1", "y1")
TOUCH = "a.x0 <= b.x1 and b.x0 <= a.x1 and a.y0 <= b.y1 and b.y0 <= a.y1"
W_, H_ = "(least(a.x1, b.x1) - greatest(a.x0, b.x0))", "(least(a.y1, b.y1) - greatest(a.y0, b.y0))"
SHARED = f"(case when {W_} > 0 and {H_} > 0 then {W_} * {H_} else 0 end)"


def _pre(df, p, key="field_id", as_key=None):
    return df.select(F.col(key).alias(as_key or key), *[F.col(k).alias(f"{p}{k}") for k in BOX])


@query("e1_fishnet", sql("chips", "select chip_id, x0, y0, x1, y1 from chips"))
def e1(spark, d):
    return chips(spark, d)


@query("w1_grid_ids", sql("chips", "select chip_id, x0 // 2560 as col, y0 // 2560 as row from chips"))
def w1(spark, d):
    return chips(spark, d).selectExpr("chip_id", "x0 div 2560 as col", "y0 div 2560 as row")


COVER = """&p as (
  select b.chip_id, greatest(a.x0, b.x0) as x0, greatest(a.y0, b.y0) as y0, least(a.x1, b.x1) as x1, least(a.y1, b.y1) as y1
  from fields a join chips b on a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1),
e as (select distinct chip_id, unnest([x0, x1]) as x from p),
s as (select chip_id, x, lead(x) over (partition by chip_id order by x) as nx from e),
i as (select s.chip_id, s.x, s.nx, p.y0, p.y1 from s join p on p.chip_id = s.chip_id and p.x0 <= s.x and p.x1 >= s.nx),
r as (select *, coalesce(max(y1) over (partition by chip_id, x order by y0, y1 rows between unbounded preceding and 1 preceding), y0) as before from i),
u as (select chip_id, sum(greatest(y1 - greatest(y0, before), 0) * (nx - x))::bigint as cov_area from r group by 1),
cov as (select c.chip_id, 2560 * 2560::bigint as chip_area, coalesce(cov_area, 0) as cov_area, 100.0::double * coalesce(cov_area, 0) / (2560 * 2560) as cov_pct from chips c left join u using (chip_id))
"""


@query("g3_union_area", sql("fields chips", COVER + "select chip_id, cov_area from cov"))
def g3(spark, d):
    return grid.coverage(chips(spark, d), fields(spark, d), SIDE).select("chip_id", F.col("cov_area").cast("bigint").alias("cov_area"))


@query("f2_covered_grid", sql("fields chips", COVER + "select chip_id, chip_area, cov_area, round(cov_pct, 6) as cov_pct from cov where cov_pct > 10"))
def f2(spark, d):
    got = grid.covered_grid(chips(spark, d), fields(spark, d), SIDE)
    return got.select("chip_id", "chip_area", F.col("cov_area").cast("bigint").alias("cov_area"), F.round("cov_pct", 6).alias("cov_pct"))


@query("k13_coverage_percent", sql("fields", "select field_id, case when (x1 - x0 - 200) > 0 then round(100.0 * (y1 - y0 - 200) / (x1 - x0 - 200), 6) else 0 end::double as pct from fields"))
def k13(spark, d):
    return fields(spark, d).select("field_id", F.round(X.percent(F.expr("y1 - y0 - 200"), F.expr("x1 - x0 - 200")), 6).alias("pct"))


@query("j1_fields_in_chips", sql("fields chips", f"select a.field_id, b.chip_id from fields a join chips b on {TOUCH}"))
def j1(spark, d):
    return joins.box_join(_pre(fields(spark, d), "l_"), _pre(chips(spark, d), "r_", "chip_id"), SIDE).select("field_id", "chip_id")


def _shape_pairs(spark, d):
    boxes = chips(spark, d).select("chip_id", G.box_ring(*G.box()).alias("r_ring"))
    return joins.ring_join(shapes(spark, d).withColumnRenamed("ring", "l_ring"), boxes, SIDE)


@query("j1_shapes_in_chips", sql("shapes chips", f"select s.field_id, b.chip_id from shapes s join chips b on {SHAPE_TOUCHES}"))
def j1s(spark, d):
    return _shape_pairs(spark, d).select("field_id", "chip_id")


@query("j8_points_in_shapes", sql("shapes", f"&px as (select p_partkey as id, (p_partkey * 613) % 20000 + 0.25 as x, (p_partkey * 421) % 20000 + 0.5 as y from part) select px.id, s.field_id from px join shapes s on {SHAPE_HOLDS}"))
def j8s(spark, d):
    pts = table(spark, d, "part").selectExpr("p_partkey as id", "(p_partkey * 613) % 20000 + 0.25D as x", "(p_partkey * 421) % 20000 + 0.5D as y")
    return joins.points_in_rings(pts, shapes(spark, d), 700).select("id", "field_id")


@query("j2_chips_left_join", sql("fields chips", f"select b.chip_id, count(a.field_id) as n, coalesce(string_agg(a.field_id::varchar, ',' order by a.field_id), '') as field_ids from chips b left join fields a on {TOUCH} group by 1"))
def j2(spark, d):
    got = manifest.manifest(chips(spark, d), fields(spark, d), SIDE, "s", (0.8, 0.1, 0.1))
    ids = F.array_join(F.transform(F.coalesce(F.col("parts.field_id"), F.array().cast("array<bigint>")), lambda x: x.cast("string")), ",")
    return got.select(F.col("aoi_id").alias("chip_id"), F.col("n_fields").cast("bigint").alias("n"), ids.alias("field_ids"))


SPLIT = "('0x' || substr(sha1('field-split::chip_' || {0}::varchar), 1, 8))::bigint / 4294967296.0::double"
SPLIT_NAME = f"case when {SPLIT} < 0.85 then 'train' when {SPLIT} < 0.95 then 'val' else 'test' end"


@query("g1_manifest", sql("fields chips", f"&j as (select b.chip_id as aoi_id, a.field_id from fields a join chips b on {TOUCH}) select chip_id as aoi_id, {SPLIT_NAME.format('chip_id')} as split, count(field_id) > 0 as has_fields, count(field_id)::int as n_fields from chips left join j on aoi_id = chip_id group by chip_id"))
def g1(spark, d):
    return manifest.manifest(chips(spark, d), fields(spark, d), SIDE, "field-split", (0.85, 0.10, 0.05)).drop("parts")


@query("g2_parts_or_null", sql("fields chips", f"&j as (select b.chip_id, a.* from fields a join chips b on {TOUCH}) select c.chip_id, sum((j.x1 - j.x0) * (j.y1 - j.y0))::bigint as area from chips c left join j using (chip_id) group by 1"))
def g2(spark, d):
    got = manifest.manifest(chips(spark, d), fields(spark, d), SIDE, "s", (0.8, 0.1, 0.1))
    area = F.aggregate(F.transform("parts", lambda p: (p["x1"] - p["x0"]) * (p["y1"] - p["y0"])), F.lit(0).cast("bigint"), lambda s, v: s + v)
    return got.select(F.col("aoi_id").alias("chip_id"), F.when(F.col("has_fields"), area).alias("area"))


@query("g24_duplicate_keys", "select c_nationkey as k, count(*) as n from customer group by 1 having count(*) > 1")
def g24(spark, d):
    return manifest.duplicate_keys(table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), "k")


@query("g9_counts_by_split", f"select split, count(*) as n from (select {SPLIT_NAME.format('c_custkey')} as split from customer) group by 1")
def g9(spark, d):
    return table(spark, d, "customer").select(X.split_name(F.concat(F.lit("chip_"), F.col("c_custkey").cast("string")), "field-split", 0.85, 0.10, 0.05).alias("split")).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("k5_split_hash", f"select doc_id, {SPLIT_NAME.format('doc_id')} as split, {SPLIT.format('doc_id')} as fraction from documents")
def k5(spark, d):
    key = F.concat(F.lit("chip_"), F.col("doc_id").cast("string"))
    return table(spark, d, "documents").select("doc_id", X.split_name(key, "field-split", 0.85, 0.10, 0.05).alias("split"), X.split_fraction(key, "field-split").alias("fraction"))


@query("j3_touched_chips", sql("fields chips", f"select distinct b.chip_id from fields a join chips b on {TOUCH}"))
def j3(spark, d):
    f = fields(spark, d)
    return joins.box_semi_join(_pre(chips(spark, d), "l_", "chip_id"), _pre(f, "r_"), "chip_id", SIDE).select("chip_id")


@query("j4_overlapped_chips", sql("fields chips", f"select distinct b.chip_id from fields a join chips b on {TOUCH} where {SHARED} > 0"))
def j4(spark, d):
    f = fields(spark, d)
    return joins.box_semi_join(_pre(chips(spark, d), "l_", "chip_id"), _pre(f, "r_"), "chip_id", SIDE, overlap=True).select("chip_id")


@query("j8_points_first_field", sql("fields", """&pts as (select p_partkey as id, (p_partkey * 613) % 20000 as x, (p_partkey * 421) % 20000 as y from part),
j as (select p.id, f.field_id from pts p left join fields f on p.x between f.x0 and f.x1 and p.y between f.y0 and f.y1)
select field_id, min(id) as point_id from j group by field_id"""))
def j8(spark, d):
    pts = table(spark, d, "part").selectExpr("p_partkey as id", "(p_partkey * 613) % 20000 as x", "(p_partkey * 421) % 20000 as y")
    return A.points_to_fields(pts, fields(spark, d).withColumnRenamed("field_id", "id"), 700)


def _sets(spark, d):
    return fields(spark, d).withColumnRenamed("field_id", "id"), shifted(spark, d).withColumnRenamed("field_id", "id")


def _pairs(spark, d, *shown):
    return A.pair_measures(*_sets(spark, d), 700, *shown)


AREA = "((a.x1 - a.x0) * (a.y1 - a.y0))", "((b.x1 - b.x0) * (b.y1 - b.y0))"
PAIRS = f"""&pairs as (
  select a.field_id as l_id, b.field_id as r_id, {SHARED} as shared_area, {AREA[0]} + {AREA[1]} - {SHARED} as union_area, {AREA[0]} + {AREA[1]} - 2 * {SHARED} as symdiff_area,
    {SHARED}::double / ({AREA[0]} + {AREA[1]} - {SHARED}) as iou, 2 * {SHARED}::double / ({AREA[0]} + {AREA[1]}) as dice, abs({AREA[0]} - {AREA[1]})::double / {AREA[0]} as area_diff,
    sqrt(pow((a.x0 + a.x1) / 2.0 - (b.x0 + b.x1) / 2.0, 2) + pow((a.y0 + a.y1) / 2.0 - (b.y0 + b.y1) / 2.0, 2)) as centroid_distance
  from fields a join shifted b on {TOUCH})
"""


@query("j9_label_measures", sql("fields shifted", PAIRS + "select l_id, r_id, shared_area::bigint as shared_area, round(iou, 6) as iou, round(dice, 6) as dice, round(area_diff, 6) as area_diff, round(centroid_distance, 6) as centroid_distance from pairs"))
def j9(spark, d):
    six = lambda c: X.rounded(F.col(c), 6).alias(c)
    return _pairs(spark, d, F.col("shared_area").cast("bigint").alias("shared_area"), *[six(c) for c in ("iou", "dice", "area_diff", "centroid_distance")])


@query("e3_overlay_areas", sql("fields shifted", PAIRS + "select l_id, r_id, shared_area::bigint as shared_area, union_area::bigint as union_area, symdiff_area::bigint as symdiff_area from pairs"))
def e3(spark, d):
    return _pairs(spark, d, *[F.col(c).cast("bigint").alias(c) for c in ("shared_area", "union_area", "symdiff_area")])


@query("j10_best_overlap", sql("fields shifted", PAIRS + "select l_id, r_id, round(iou, 6) as iou from (select *, row_number() over (partition by l_id order by iou desc, r_id) as rn from pairs where iou > 0) where rn = 1"))
def j10(spark, d):
    return A.best_boxes(*_sets(spark, d), 700).select("l_id", "r_id", F.round("iou", 6).alias("iou"))


@query("j11_iou_matches", sql("fields shifted", PAIRS + "select l_id, min(r_id) as r_id from pairs where iou > 0.5 group by l_id"))
def j11(spark, d):
    return A.box_matches(*_sets(spark, d), 700, 0.5)


@query("g16_object_scores", sql("fields shifted", PAIRS + """, m as (select l_id, min(r_id) as r_id from pairs where iou > 0.5 group by l_id),
n as (select (select count(*) from m) as tp, (select count(*) from shifted) - (select count(distinct r_id) from m) as fp, (select count(*) from fields) - (select count(*) from m) as fn)
select tp, fp, fn, coalesce(tp::double / nullif(tp + fp, 0), 0) as precision, coalesce(tp::double / nullif(tp + fn, 0), 0) as recall, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)::double as f1 from n"""))
def g16(spark, d):
    m = A.box_matches(*_sets(spark, d), 700, 0.5)
    hit = m.agg(F.count(F.lit(1)).alias("tp"), F.countDistinct("r_id").alias("used"))
    n = table(spark, d, "customer").agg(F.count(F.lit(1)).alias("n"))
    c = hit.crossJoin(n).selectExpr("tp", "n - used as fp", "n - tp as fn")
    return c.withColumns(metrics.object_scores(F.col("tp"), F.col("fp"), F.col("fn")))


@query("u3_false_positives", sql("fields shifted", PAIRS + "select field_id from shifted where field_id not in (select min(r_id) from pairs where iou > 0.5 group by l_id)"))
def u3(spark, d):
    m = A.box_matches(*_sets(spark, d), 700, 0.5).select(F.col("r_id").alias("field_id"))
    return shifted(spark, d).select("field_id").join(m, "field_id", "left_anti")


@query("j12_largest_overlap_box", sql("fields shifted", f"""&m as (select a.field_id as id, b.field_id as box_id, row_number() over (partition by a.field_id order by {SHARED} desc, b.field_id) as rn from fields a join shifted b on {TOUCH} where {SHARED} > 0)
select f.field_id as id, m.box_id, coalesce(s.x0, f.x0) as x0, coalesce(s.y0, f.y0) as y0, coalesce(s.x1, f.x1) as x1, coalesce(s.y1, f.y1) as y1, m.id is null as from_raster
from fields f left join m on m.id = f.field_id and rn = 1 left join shifted s on s.field_id = m.box_id"""))
def j12(spark, d):
    return A.largest_overlap(fields(spark, d).withColumnRenamed("field_id", "id").drop("c_nationkey"), shifted(spark, d).withColumnRenamed("field_id", "id"), 700)


@query("w5_quartiles", sql("fields", """&q as (select quantile_cont((x1 - x0) * (y1 - y0), 0.25) as a, quantile_cont((x1 - x0) * (y1 - y0), 0.5) as b, quantile_cont((x1 - x0) * (y1 - y0), 0.75) as c from fields)
select field_id, case when (x1 - x0) * (y1 - y0) <= a then 0 when (x1 - x0) * (y1 - y0) <= b then 1 when (x1 - x0) * (y1 - y0) <= c then 2 else 3 end as quartile from fields, q"""))
def w5(spark, d):
    f = fields(spark, d).withColumn("area", G.box_area(G.box()).cast("double"))
    return A.quartiles(f, "area").select("field_id", "quartile")


@query("g12_quartile_stats", sql("fields", """&q as (select quantile_cont((x1 - x0) * (y1 - y0), 0.25) as a, quantile_cont((x1 - x0) * (y1 - y0), 0.5) as b, quantile_cont((x1 - x0) * (y1 - y0), 0.75) as c from fields),
z as (select (x1 - x0) * (y1 - y0) as area, x1 - x0 as w, case when (x1 - x0) * (y1 - y0) <= a then 0 when (x1 - x0) * (y1 - y0) <= b then 1 when (x1 - x0) * (y1 - y0) <= c then 2 else 3 end as quartile from fields, q)
select quartile, count(*) as n, min(area)::bigint as lo, max(area)::bigint as hi, round(sum(w)::double / count(*), 6) as mean_width from z group by 1"""))
def g12(spark, d):
    f = fields(spark, d).withColumn("area", G.box_area(G.box()).cast("double")).withColumn("w", F.expr("x1 - x0"))
    q = A.quartiles(f, "area").groupBy("quartile")
    return q.agg(F.count(F.lit(1)).alias("n"), F.min("area").cast("bigint").alias("lo"), F.max("area").cast("bigint").alias("hi"), F.round(F.sum("w").cast("double") / F.count(F.lit(1)), 6).alias("mean_width"))


@query("g11_mean_median", sql("fields shifted", PAIRS + "select count(*) as n, round(sum(shared_area)::double / count(*), 4) as mean_shared, round(median(shared_area), 4)::double as median_shared from pairs where iou > 0.3"))
def g11(spark, d):
    near = settled(A.pair_counts(*_sets(spark, d), 700).filter("iou > 0.3").groupBy("shared_area").agg(F.sum("n").alias("n")), "areas")
    # one row each
    middle = F.broadcast(A.quantiles(near, "shared_area", [0.5], weight="n"))
    mean = near.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.round(F.sum(F.col("shared_area") * F.col("n")).cast("double") / F.sum("n"), 4).alias("mean_shared"))
    return mean.join(middle, F.lit(True)).select("n", "mean_shared", F.round("q0", 4).alias("median_shared"))


@query("g13_histogram", sql("fields", "&s as (select (x1 - x0) * (y1 - y0) as a from fields), m as (select min(a) as lo, max(a) as hi from s) select least(cast(floor((a - lo) * 20 / (hi - lo)::double) as bigint), 19) as bin, count(*) as n from s, m group by 1"))
def g13(spark, d):
    return A.histogram(fields(spark, d).withColumn("a", G.box_area(G.box())), "a", 20)


@query("f15_size_classes", sql("fields", "&s as (select field_id, (x1 - x0) * (y1 - y0) // 10000 as ha from fields), k as (select * from (values (0, 0, 5), (1, 5, 20), (2, 20, 100)) t(cls, lo, hi)) select field_id, cls from s join k on ha between lo and hi"))
def f15(spark, d):
    ha = F.expr("(x1 - x0) * (y1 - y0) div 10000")
    return fields(spark, d).select("field_id", F.explode(A.size_class(ha, [0, 5, 20, 100])).alias("cls"))


@query("f14_range", sql("fields", "select field_id from fields where (x1 - x0) * (y1 - y0) // 10000 between 0 and 20"))
def f14(spark, d):
    return fields(spark, d).dropna(subset=["x0"]).filter("(x1 - x0) * (y1 - y0) div 10000 between 0 and 20").select("field_id")


@query("f1_polygonal", sql("fields", "select field_id from fields where field_id % 4 <> 0"))
def f1(spark, d):
    f = spread(fields(spark, d))
    ring = F.when(F.col("field_id") % 4 == 0, F.array(*[F.struct(F.col("x0").cast("double").alias("x"), F.col("y0").cast("double").alias("y"))] * 4)).otherwise(G.box_ring(*G.box()))
    return f.withColumn("ring", ring).withColumn("ring", G.repair_ring(F.col("ring"))).filter("ring is not null").select("field_id")


@query("e2_ring_area", sql("fields", "select field_id, ((x1 - x0) * (y1 - y0))::double as area, (2 * (x1 - x0 + y1 - y0))::double as length from fields"))
def e2(spark, d):
    f = fields(spark, d).withColumn("ring", G.box_ring(*G.box()))
    return f.select("field_id", G.ring_area(F.col("ring")).alias("area"), G.ring_length(F.col("ring")).alias("length"))


@query("e4_centroid", sql("fields", "select field_id, round((x0 + x1) / 2.0, 3)::double as cx, round((y0 + y1) / 2.0, 3)::double as cy from fields"))
def e4(spark, d):
    f = fields(spark, d).withColumn("c", G.ring_centroid(G.box_ring(*G.box())))
    return f.select("field_id", F.round("c.x", 3).alias("cx"), F.round("c.y", 3).alias("cy"))


ELL = "(greatest(least(s.x0 + 2 * s.a, b.x1) - greatest(s.x0, b.x0), 0) * greatest(least(s.y0 + s.b, b.y1) - greatest(s.y0, b.y0), 0) + greatest(least(s.x0 + s.a, b.x1) - greatest(s.x0, b.x0), 0) * greatest(least(s.y0 + 2 * s.b, b.y1) - greatest(s.y0 + s.b, b.y0), 0))"


@query("e3_polygon_overlay", sql("fields shapes chips", f"select s.field_id, b.chip_id, {ELL}::bigint as shared_area from shapes s join chips b on s.kind = 1 and {SHAPE_TOUCHES}"))
def e3p(spark, d):
    """Polygons against polygons: the general overlay, on L-shaped rings (six corners)."""
    p = _shape_pairs(spark, d).filter(F.size("l_ring") == 7)
    return p.select("field_id", "chip_id", F.round(G.polygon_shared_area(F.col("l_ring"), F.col("r_ring")), 0).cast("bigint").alias("shared_area"))


@query("e2_shape_area", sql("shapes", """select field_id, case kind when 0 then 2.0 * a * b when 1 then 3.0 * a * b else a * b / 2.0 end::double as area,
 round(case kind when 0 then 4 * sqrt(a * a + b * b) when 1 then 4.0 * (a + b) else a + b + sqrt(a * a + b * b) end, 6)::double as length from shapes"""))
def e2s(spark, d):
    return shapes(spark, d).select("field_id", G.ring_area(F.col("ring")).alias("area"), F.round(G.ring_length(F.col("ring")), 6).alias("length"))


@query("e4_shape_centroid", sql("shapes", """select field_id, round(x0 + case kind when 0 then a when 1 then a * 5 / 6.0 else a / 3.0 end, 6)::double as cx,
 round(y0 + case kind when 0 then b when 1 then b * 5 / 6.0 else b / 3.0 end, 6)::double as cy from shapes"""))
def e4s(spark, d):
    return shapes(spark, d).withColumn("c", G.ring_centroid(F.col("ring"))).select("field_id", F.round("c.x", 6).alias("cx"), F.round("c.y", 6).alias("cy"))


@query("e5_hausdorff", sql("fields shifted", """&u as (select field_id, unnest([[x0, y0], [x1, y0], [x1, y1], [x0, y1]]) as p from fields), v as (select field_id, unnest([[x0, y0], [x1, y0], [x1, y1], [x0, y1]]) as q from shifted),
m as (select u.field_id, p, q, sqrt(pow(p[1] - q[1], 2) + pow(p[2] - q[2], 2)) as h from u join v using (field_id)),
k as (select field_id, max(h) as h from (select field_id, p, min(h) as h from m group by 1, 2 union all select field_id, q, min(h) from m group by 1, 2) group by 1) select field_id, round(h, 6) as h from k"""))
def e5(spark, d):
    p = _pre(fields(spark, d), "l_").join(_pre(shifted(spark, d), "r_"), "field_id")
    return p.select("field_id", F.round(G.hausdorff(G.box_ring(*G.box("l_")), G.box_ring(*G.box("r_"))), 6).alias("h"))


@query("e6_orientation", sql("fields", "select field_id, round(atan2((y1 - y0)::double, (x1 - x0)::double), 9) as angle from fields"))
def e6(spark, d):
    return spread(fields(spark, d)).select("field_id", F.round(G.orientation(G.box_ring(*G.box())), 9).alias("angle"))


@query("e7_boundary_ratio", sql("fields shifted", "select f.field_id, round((f.x1 - f.x0 + f.y1 - f.y0)::double / (s.x1 - s.x0 + s.y1 - s.y0), 9) as ratio, 0 as vertex_diff from fields f join shifted s using (field_id)"))
def e7(spark, d):
    p = _pre(fields(spark, d), "l_").join(_pre(shifted(spark, d), "r_"), "field_id").withColumns({"a": G.box_ring(*G.box("l_")), "b": G.box_ring(*G.box("r_"))})
    ratio = F.when(G.ring_length(F.col("b")) > 0, G.ring_length(F.col("a")) / G.ring_length(F.col("b"))).otherwise(float("inf"))
    return p.select("field_id", F.round(ratio, 9).alias("ratio"), (F.size("a") - F.size("b")).alias("vertex_diff"))


_PHI, _LAM = "radians({lat})", "radians({lon} - (23 * 6 - 183))"
_N = f"(6378137.0 / sqrt(1 - e2 * pow(sin({_PHI}), 2)))"
_T, _C, _A = f"pow(tan({_PHI}), 2)", f"(ep * pow(cos({_PHI}), 2))", f"(cos({_PHI}) * {_LAM})"
_M = f"(6378137.0 * ((1 - e2 / 4 - 3 * pow(e2, 2) / 64 - 5 * pow(e2, 3) / 256) * {_PHI} - (3 * e2 / 8 + 3 * pow(e2, 2) / 32 + 45 * pow(e2, 3) / 1024) * sin(2 * {_PHI}) + (15 * pow(e2, 2) / 256 + 45 * pow(e2, 3) / 1024) * sin(4 * {_PHI}) - 35 * pow(e2, 3) / 3072 * sin(6 * {_PHI})))"
UTM_X = f"(0.9996 * {_N} * ({_A} + (1 - {_T} + {_C}) * pow({_A}, 3) / 6 + (5 - 18 * {_T} + pow({_T}, 2) + 72 * {_C} - 58 * ep) * pow({_A}, 5) / 120) + 500000)"
UTM_Y = f"(0.9996 * ({_M} + {_N} * tan({_PHI}) * (pow({_A}, 2) / 2 + (5 - {_T} + 9 * {_C} + 4 * pow({_C}, 2)) * pow({_A}, 4) / 24 + (61 - 58 * {_T} + pow({_T}, 2) + 600 * {_C} - 330 * ep) * pow({_A}, 6) / 720)) + case when {{lat}} >= 0 then 0 else 10000000 end)"
_E = "&ell as (select e2, e2 / (1 - e2) as ep from (select (1 / 298.257223563::double) * (2 - 1 / 298.257223563::double) as e2)),\n"
_XY = lambda lon, lat: (UTM_X.format(lon=lon, lat=lat), UTM_Y.format(lon=lon, lat=lat))


@query("e10_bounds_transform", sql("fields", _E + """g as (select field_id, x0 / 20000.0::double - 47 as a0, -12 + y0 / 20000.0::double as b0, x1 / 20000.0::double - 47 as a1, -12 + y1 / 20000.0::double as b1 from fields),
s as (select range / 21.0::double as s from range(22)),
p as (select field_id, a0 + (a1 - a0) * s as lon, b0 as lat from g, s union all select field_id, a0 + (a1 - a0) * s, b1 from g, s union all select field_id, a0, b0 + (b1 - b0) * s from g, s union all select field_id, a1, b0 + (b1 - b0) * s from g, s)
select field_id, round(min(X), 3) as x0, round(min(Y), 3) as y0, round(max(X), 3) as x1, round(max(Y), 3) as y1 from p, ell group by 1""".replace("X)", _XY("lon", "lat")[0] + ")").replace("Y)", _XY("lon", "lat")[1] + ")")))
def e10(spark, d):
    f = spread(fields(spark, d)).selectExpr("field_id", "x0 / 20000.0D - 47 as lon0", "-12 + y0 / 20000.0D as lat0", "x1 / 20000.0D - 47 as lon1", "-12 + y1 / 20000.0D as lat1")
    b = G.densified_bounds(F.col("lon0"), F.col("lat0"), F.col("lon1"), F.col("lat1"), F.lit(23))
    return f.select("field_id", b.alias("b")).select("field_id", *[F.round(f"b.{k}", 3).alias(k) for k in BOX])


@query("e9_utm", sql("fields", _E + "g as (select field_id, x0 / 20000.0::double - 47 as lon, -12 + y0 / 20000.0::double as lat from fields) select field_id, round({}, 3) as x, round({}, 3) as y from g, ell".format(*_XY("lon", "lat"))))
def e9(spark, d):
    f = fields(spark, d).selectExpr("field_id", "x0 / 20000.0D - 47 as lon", "-12 + y0 / 20000.0D as lat")
    return f.select("field_id", G.utm(F.col("lon"), F.col("lat"), F.lit(23)).alias("p")).select("field_id", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y"))


@query("e9_round_trip", sql("fields", "select field_id, round(x0 / 20000.0 - 47, 6)::double as lon, round(-12 + y0 / 20000.0, 6)::double as lat from fields"))
def e9r(spark, d):
    """To the projected plane and back."""
    f = fields(spark, d).selectExpr("field_id", "x0 / 20000.0D - 47 as lon", "-12 + y0 / 20000.0D as lat")
    p = f.select("field_id", G.utm(F.col("lon"), F.col("lat"), F.lit(23)).alias("p"))
    return p.select("field_id", G.utm_inverse(F.col("p.x"), F.col("p.y"), F.lit(23), south=True).alias("q")).select("field_id", F.round("q.lon", 6).alias("lon"), F.round("q.lat", 6).alias("lat"))


@query("e12_simplify", sql("fields", "&c as (select field_id, unnest([0, 1, 2, 3, 4]) as pos, unnest([x0, x1, x1, x0, x0]) as x, unnest([y0, y0, y1, y1, y0]) as y from fields) select field_id, pos, x::double as x, y::double as y from c"))
def e12(spark, d):
    mid = F.struct(((F.col("x0") + F.col("x1")) / 2).alias("x"), (F.col("y0") + 0.1).alias("y"))
    ring = F.array_insert(G.box_ring(*G.box()), 2, mid)
    return spread(fields(spark, d)).select("field_id", F.posexplode(G.simplify(0.5)(ring)).alias("pos", "p")).select("field_id", "pos", "p.x", "p.y")


@query("e14_clip", sql("fields chips", f"select a.field_id, b.chip_id, {SHARED}::bigint as area from fields a join chips b on {TOUCH} where {SHARED} > 0"))
def e14(spark, d):
    p = joins.box_join(_pre(fields(spark, d), "l_"), _pre(chips(spark, d), "r_", "chip_id"), SIDE)
    ring = G.clip_to_box(G.box_ring(*G.box("l_")), *G.box("r_"))
    return spread(p).withColumn("ring", ring).filter("ring is not null").select("field_id", "chip_id", F.round(G.ring_area(F.col("ring")), 0).cast("bigint").alias("area")).filter("area > 0")


@query("e17_affine", sql("shapes", "select field_id, (i - 1)::int as pos, (p[1] * 10 + 500000)::double as x, (9000000 - p[2] * 10)::double as y from corners"))
def e17(spark, d):
    ring = G.affine_ring(F.col("ring"), 10.0, 0.0, 500000.0, 0.0, -10.0, 9000000.0)
    return shapes(spark, d).select("field_id", F.posexplode(ring).alias("pos", "p")).select("field_id", "pos", "p.x", "p.y")


POINTS = """&s as (select *, (x1 - x0) * (y1 - y0) / 10000.0 as ha from fields),
t as (select s.*, k.step from s join (values (0, 5, 10), (5, 20, 50), (20, 100, 100)) k(lo, hi, step) on ha between lo and hi union all select *, 200 from s where ha >= 100),
g as (select field_id, step, x1, y1, unnest(range(x0, x1, step)) + step // 2 as px, y0 from t),
h as (select field_id, step, px, unnest(range(y0, y1, step)) + step // 2 as py, x1, y1 from g)
select field_id, step, px::bigint as px, py::bigint as py from h where px <= x1 and py <= y1"""


@query("e15_field_points", sql("fields", POINTS))
def e15(spark, d):
    return grid.points_in_fields(fields(spark, d))


@query("w11_farthest_points")
def w11(spark, d):
    return raster.sample_points(grid.points_in_fields(spread(fields(spark, d))), 10)


@query("f10_contains", sql("fields chips", "select b.chip_id, count(*) as n from fields a join chips b on a.x0 >= b.x0 and a.y0 >= b.y0 and a.x1 <= b.x1 and a.y1 <= b.y1 group by 1"))
def f10(spark, d):
    held = G.box_contains(G.box("r_"), G.box("l_"), 1e-12)
    p = joins.box_join(_pre(fields(spark, d), "l_"), _pre(chips(spark, d), "r_", "chip_id"), SIDE, exact=held)
    return p.groupBy("chip_id").agg(F.count(F.lit(1)).alias("n"))


@query("w2_instance_ids", sql("fields chips", f"select b.chip_id, a.field_id, row_number() over (partition by b.chip_id order by a.field_id)::int as instance from fields a join chips b on {TOUCH}"))
def w2(spark, d):
    p = joins.box_join(_pre(fields(spark, d), "l_"), _pre(chips(spark, d), "r_", "chip_id"), SIDE)
    return p.selectExpr("chip_id", "field_id", "cast(row_number() over (partition by chip_id order by field_id) as int) as instance")


@query("j17_fields_for_chip", sql("fields chips", f"select a.field_id, b.chip_id from fields a join chips b on {TOUCH}"))
def j17(spark, d):
    return joins.box_join(_pre(chips(spark, d), "l_", "chip_id"), _pre(fields(spark, d), "r_"), SIDE).select("field_id", "chip_id")


RASTER_CTE = f"""&px as (select chip_id as chip, r, c, x0 + c * 160 + 80 as x, y0 + r * 160 + 80 as y from chips, (select range as r from range(16)) a, (select range as c from range(16)) b),
f as (select b.chip_id as chip, row_number() over (partition by b.chip_id order by a.field_id)::int as instance, a.x0, a.y0, a.x1, a.y1 from fields a join chips b on {TOUCH}),
m as (select px.chip, px.r, px.c, coalesce(max(f.instance), 0) as instance from px left join f on px.chip = f.chip and px.x >= f.x0 and px.x < f.x1 and px.y >= f.y0 and px.y < f.y1 group by all)
"""


def _masks(spark, d):
    p = chips(spark, d).select(F.col("chip_id").alias("chip"), "x0", "y0", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(15).cast("bigint"))).alias("r")).withColumn("c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(15).cast("bigint"))))
    p = p.selectExpr("chip", "r", "c", "x0 + c * 160 + 80 as x", "y0 + r * 160 + 80 as y")
    f = joins.box_join(_pre(fields(spark, d), "l_"), _pre(chips(spark, d), "r_", "chip_id"), SIDE)
    f = f.selectExpr("chip_id as chip", "cast(row_number() over (partition by chip_id order by field_id) as int) as instance", "l_x0 as x0", "l_y0 as y0", "l_x1 as x1", "l_y1 as y1")
    return raster.rasterize(p, f, 640), p, f


@query("r9_instance_mask", sql("fields chips", RASTER_CTE + "select chip, r, c, instance from m"))
def r9(spark, d):
    return _masks(spark, d)[0]


@query("r11_mask_counts", sql("fields chips", RASTER_CTE + "select chip, sum(case when instance > 0 then 1 else 0 end)::bigint as inside, count(*) as n from m group by 1"))
def r11(spark, d):
    return _masks(spark, d)[0].groupBy("chip").agg(F.count_if(F.col("instance") > 0).alias("inside"), F.count(F.lit(1)).alias("n"))


SHAPE_CTE = f"""&px as (select chip_id as chip, r, c, x0 + c * 160 + 80.25::double as x, y0 + r * 160 + 80.5::double as y from chips, (select range as r from range(16)) a, (select range as c from range(16)) b),
f as (select b.chip_id as chip, s.*, row_number() over (partition by b.chip_id order by s.field_id)::int as instance from shapes s join chips b on {SHAPE_TOUCHES}),
i as (select px.chip, px.r, px.c, coalesce(max(s.instance), 0) as instance from px left join f s on px.chip = s.chip and {SHAPE_HOLDS} group by all),
n as (select px.*, s.field_id from px join f s on px.chip = s.chip and px.x between s.x0 - 81 and s.x0 + 2 * s.a + 81 and px.y between s.y0 - 81 and s.y0 + 2 * s.b + 81),
t as (select n.*, e.*, greatest(0, least(1, ((n.x - e.px) * (e.qx - e.px) + (n.y - e.py) * (e.qy - e.py)) / (pow(e.qx - e.px, 2) + pow(e.qy - e.py, 2)))) as t from n join edges e on n.field_id = e.field_id),
g as (select distinct chip, r, c, true as edge from t where round(sqrt(pow(x - px - t * (qx - px), 2) + pow(y - py - t * (qy - py), 2)), 6) <= 80),
m as (select i.*, coalesce(edge, false) as edge from i left join g using (chip, r, c))
"""


def _shape_masks(spark, d):
    sixteen = lambda: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(15).cast("bigint")))
    p = chips(spark, d).select(F.col("chip_id").alias("chip"), "x0", "y0", sixteen().alias("r")).withColumn("c", sixteen())
    p = p.selectExpr("chip", "r", "c", "x0 + c * 160 + 80.25D as x", "y0 + r * 160 + 80.5D as y")
    f = _shape_pairs(spark, d).selectExpr("chip_id as chip", "cast(row_number() over (partition by chip_id order by field_id) as int) as instance", "l_ring as ring")
    return p, f


@query("r9_shape_mask", sql("shapes chips", SHAPE_CTE + "select chip, r, c, instance from i"))
def r9s(spark, d):
    return raster.rasterize_rings(*_shape_masks(spark, d), 640)


@query("r10_three_class_mask", sql("shapes chips", SHAPE_CTE + "select chip, r, c, case when edge then 2 when instance > 0 then 1 else 0 end as cls from m"))
def r10(spark, d):
    return raster.three_class_mask(*_shape_masks(spark, d), 640, 80.0)


@query("r10_boundary_under", sql("shapes chips", SHAPE_CTE + "select chip, r, c, case when instance > 0 then 1 when edge then 2 else 0 end as cls from m"))
def r10b(spark, d):
    return raster.three_class_mask(*_shape_masks(spark, d), 640, 80.0, inner_first=True)


@query("j15_land_cover_cells", sql("fields", "select field_id, cast(floor((x0 + 5) / 30) as bigint) as col, cast(floor((y0 + 5) / 30) as bigint) as row from fields"))
def j15(spark, d):
    return joins.nearest_cell(fields(spark, d), "x0", "y0", -5, -5, 30).select("field_id", "col", "row")


@query("j16_zonal_pixels", sql("fields", "&p as (select event_id, (event_id * 37) % 20000 as x, (event_id * 91) % 20000 as y, cast(floor(value * 100) as bigint) as q from events) select field_id, count(*) as n, sum(q)::bigint as total from p join fields on x >= x0 and x < x1 and y >= y0 and y < y1 group by 1"))
def j16(spark, d):
    p = table(spark, d, "events").selectExpr("(event_id * 37) % 20000 as x", "(event_id * 91) % 20000 as y", "cast(floor(value * 100) as bigint) as q")
    return joins.zonal_totals(p, _pre(fields(spark, d), "z_"), "field_id", 700, "q")
