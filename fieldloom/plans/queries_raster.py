"""Queries on pixels, bands, scores, metrics and weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldloom.functions import expressions as X
from fieldloom.functions import geometry as G
from fieldloom.operators import agreement as A
from fieldloom.operators import merge, metrics, raster, score

from .registry import query
from .views import fields, pixels, rasters, sql, table, weights


@query("g5_zonal_mode", sql("pixels", "select chip, arg_max(doy, n * 1000 - doy) as mode from (select chip, doy, count(*) as n from pixels where doy > 0 group by 1, 2) group by 1"))
def g5(spark, d):
    return score.zonal_mode(pixels(spark, d), "chip", "doy")


@query("g5_mode_or_sample", sql("pixels fields", """&p as (select chip as zone, doy from pixels where chip % 2 = 0),
m as (select zone, arg_max(doy, n * 1000 - doy) as mode from (select zone, doy, count(*) as n from p where doy > 0 group by 1, 2) group by 1),
z as (select field_id as zone, cast(floor((x0 + x1) / 2.0 / 100) as bigint) as col, cast(floor((y0 + y1) / 2.0 / 100) as bigint) as row from fields where field_id not in (select zone from m)),
c as (select event_id % 210 as row, event_id // 210 as col, max(doy) as doy from pixels group by 1, 2)
select zone, mode, false as sampled from m union all select z.zone, c.doy, true from z left join c on c.row = z.row and c.col = z.col and c.doy > 0"""))
def g5b(spark, d):
    p = pixels(spark, d)
    cells = p.groupBy((F.col("event_id") % 210).alias("row"), F.expr("event_id div 210").alias("col")).agg(F.max("doy").alias("doy"))
    zones = fields(spark, d).select(F.col("field_id").alias("zone"), G.box_ring(*G.box()).alias("ring"))
    return score.zonal_or_sampled(p.filter("chip % 2 = 0").select(F.col("chip").alias("zone"), "doy"), zones, cells, "doy", 0.0, 0.0, 100.0)


@query("g6_cloud_fraction", sql("pixels", "select chip, count(*) filter (scl in (8, 9)) / nullif(count(*) filter (scl <> 0), 0)::double as cloud_fraction from pixels group by 1"))
def g6(spark, d):
    return score.cloud_fraction(pixels(spark, d), "chip")


@query("f12_clear_pixels", sql("pixels", "select chip, count(*) as n from pixels where prob < 30 and scl not in (3, 8, 9, 10, 11) group by 1"))
def f12(spark, d):
    return pixels(spark, d).filter(score.clear()).groupBy("chip").agg(F.count(F.lit(1)).alias("n"))


@query("r17_agriculture", sql("pixels", "select chip, count(*) filter (prob in (9, 14, 15, 18, 19, 20, 21, 35, 36, 39, 40, 41, 46, 47, 48, 57, 58, 62)) as n from pixels group by 1"))
def r17(spark, d):
    return pixels(spark, d).groupBy("chip").agg(F.count_if(F.col("prob").isin(score.AGRICULTURE)).alias("n"))


SCORES = """&s as (
  select chip, count(*) as n, sum(prob)::double / count(*) as mean, sqrt(greatest(sum(prob * prob)::double / count(*) - pow(sum(prob)::double / count(*), 2), 0)) as std,
    sum(prob) filter (ag)::double / nullif(count(*) filter (ag), 0) as mean_ag, count(*) filter (ag) / count(*)::double as ag_frac,
    count(*) filter (pred > 0) / count(*)::double as frac_all, count(*) filter (pred = 1) / count(*)::double as frac_in
  from pixels group by 1)
"""


def _scores(spark, d):
    return score.chip_scores(pixels(spark, d).withColumn("conf", F.col("prob").cast("double")))


@query("g7_chip_scores", sql("pixels", SCORES + """select chip, round(mean, 6) as confidence_mean, round(std, 4) as confidence_std, round(coalesce(mean_ag, -1), 6) as confidence_mean_ag, round(ag_frac, 9) as lc_ag_frac,
 round(frac_all, 9) as pred_frac_all, round(frac_in, 9) as pred_frac_interiors, round(ag_frac - frac_all, 9) as metric_all, round(ag_frac - frac_in, 9) as metric_interiors from s"""))
def g7(spark, d):
    s = _scores(spark, d)
    r = lambda c, n: F.round(c, n).alias(c)
    ag = F.round(F.when(F.isnan("confidence_mean_ag"), -1.0).otherwise(F.col("confidence_mean_ag")), 6).alias("confidence_mean_ag")
    return s.select("chip", r("confidence_mean", 6), r("confidence_std", 4), ag, *[r(c, 9) for c in ("lc_ag_frac", "pred_frac_all", "pred_frac_interiors", "metric_all", "metric_interiors")])


@query("w6_top_discrepancy_all", sql("pixels", SCORES + "select chip from s order by round(abs(ag_frac - frac_all), 9) desc, chip limit 25"))
def w6(spark, d):
    return score.most_discrepant(_scores(spark, d).withColumn("metric_all", F.round("metric_all", 9)), "metric_all", 25, "chip").select("chip")


@query("w6_top_discrepancy_interiors", sql("pixels", SCORES + "select chip from s order by round(abs(ag_frac - frac_in), 9) desc, chip limit 25"))
def w6b(spark, d):
    return score.most_discrepant(_scores(spark, d).withColumn("metric_interiors", F.round("metric_interiors", 9)), "metric_interiors", 25, "chip").select("chip")


@query("w7_low_confidence", sql("pixels", SCORES + "select chip from s order by round(mean, 9), chip limit 25"))
def w7(spark, d):
    return score.least_confident(_scores(spark, d).withColumn("confidence_mean", F.round("confidence_mean", 9)), 25, "chip").select("chip")


@query("f9_low_confidence_ag", sql("pixels", SCORES + "select chip from s where ag_frac >= 0.2 order by round(mean, 9), chip limit 25"))
def f9(spark, d):
    return score.least_confident(_scores(spark, d).withColumn("confidence_mean", F.round("confidence_mean", 9)), 25, "chip", least_ag=0.2).select("chip")


@query("f8_padding", sql("rasters", "select chip from rasters group by chip having count(*) filter (abs(q) < 20) / count(*)::double <= 0.15"))
def f8(spark, d):
    g = rasters(spark, d).groupBy("chip").agg(F.count_if(F.abs("q") < 20).alias("z"), F.count(F.lit(1)).alias("n"))
    return g.filter(score.padding_ok(F.col("z"), F.col("n"))).select("chip")


@query("g8_finite_range", sql("rasters", "select label, coalesce(min(q) filter (q % 7 <> 0), 0) as lo, coalesce(max(q) filter (q % 7 <> 0), 0) as hi from rasters group by 1"))
def g8(spark, d):
    v = F.when(F.col("q") % 7 != 0, F.col("q").cast("double")).otherwise(float("nan"))
    ok = ~F.isnan("x") & (F.abs("x") < float("inf"))
    g = rasters(spark, d).withColumn("x", v).groupBy("label")
    return g.agg(F.coalesce(F.min(F.when(ok, F.col("q"))), F.lit(0)).alias("lo"), F.coalesce(F.max(F.when(ok, F.col("q"))), F.lit(0)).alias("hi"))


@query("w3_integral_image", sql("rasters", "select a.chip, a.r, a.c, sum(b.bad)::bigint as total from rasters a join rasters b on a.chip = b.chip and b.r <= a.r and b.c <= a.c group by all"))
def w3(spark, d):
    return raster.integral(rasters(spark, d))


@query("w4_best_window", sql("rasters", """&w as (select a.chip, a.r, a.c, sum(b.bad)::bigint as bad, count(*) as n from rasters a join rasters b on a.chip = b.chip and b.r between a.r and a.r + 2 and b.c between a.c and a.c + 3 group by all),
k as (select *, row_number() over (partition by chip order by bad, r, c) as rn from w where n = 12) select chip, bad, r, c from k where rn = 1"""))
def w4(spark, d):
    return raster.best_window(rasters(spark, d), 3, 4)


@query("r5_invalid_pixels", sql("rasters", "select chip, count(*) filter (q % 11 = 0 or q = 5) as bad from rasters group by 1"))
def r5(spark, d):
    v = F.when(F.col("q") % 11 == 0, float("nan")).otherwise(F.col("q").cast("double"))
    return rasters(spark, d).groupBy("chip").agg(F.count_if(raster.invalid(v, 5.0)).alias("bad"))


@query("r6_standardize_action", """select vec_id, case when vec_id % 13 = 0 then 'skip_exists' when vec_id % 11 = 0 then 'skip_bands' when w = 256 and h = 256 and bad = 0 then 'keep' when w = 256 and h = 256 then 'fill_only'
  when w >= 256 and h >= 256 and bad = 0 then 'crop_only' when w >= 256 and h >= 256 then 'crop_then_fill' else 'pad_then_fill' end as action
from (select vec_id, 254 + vec_id % 5 as w, 255 + vec_id % 3 as h, vec_id % 2 as bad from embeddings)""")
def r6(spark, d):
    k = F.col("vec_id")
    return table(spark, d, "embeddings").select("vec_id", raster.standard_action(254 + k % 5, 255 + k % 3, F.when(k % 11 == 0, 3).otherwise(4), k % 2, k % 13 == 0).alias("action"))


@query("g10_action_counts", "select case when vec_id % 13 = 0 then 'skip_exists' when vec_id % 5 = 2 and vec_id % 2 = 0 then 'keep' when vec_id % 5 = 2 then 'fill_only' else 'pad_then_fill' end as action, count(*) as n from embeddings group by 1")
def g10(spark, d):
    k = F.col("vec_id")
    side = F.when(k % 5 == 2, 256).otherwise(200)
    a = raster.standard_action(side, side, F.lit(4), k % 2, k % 13 == 0)
    return table(spark, d, "embeddings").groupBy(a.alias("action")).agg(F.count(F.lit(1)).alias("n"))


def _bands(spark, d):
    return rasters(spark, d).groupBy("chip", "label").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "c", "q"))), lambda s: s["q"]).alias("band"))


@query("r3_stack_and_split", "select vec_id as chip, (unnest(range(64)))::int as pos, unnest(embedding)::double as a, unnest(list_reverse(embedding))::double as b from embeddings")
def r3(spark, d):
    e = table(spark, d, "embeddings").withColumn("s", raster.stack(F.col("embedding"), F.reverse("embedding")))
    a, b = raster.split_stack(F.col("s"), 64)
    both = e.select(F.col("vec_id").alias("chip"), F.posexplode(F.arrays_zip(a.alias("a"), b.alias("b"))).alias("pos", "v"))
    return both.select("chip", "pos", F.col("v.a").cast("double").alias("a"), F.col("v.b").cast("double").alias("b"))


@query("k7_band_order", "select vec_id as chip, (unnest(range(64)))::int as pos, unnest(list_concat(embedding[33:64], embedding[1:32]))::double as v from embeddings")
def k7(spark, d):
    a, b = raster.split_stack(F.col("embedding"), 32)
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("chip"), F.posexplode(raster.stack(b, a)).alias("pos", "v")).withColumn("v", F.col("v").cast("double"))


@query("r12_to_uint16", sql("rasters", "select chip, r, c, case when q % 13 = 0 then 0 else least(65535, greatest(0, q * 400)) end::int as v from rasters"))
def r12(spark, d):
    v = F.when(F.col("q") % 13 == 0, float("nan")).otherwise(F.col("q") * 400.0)
    return rasters(spark, d).select("chip", "r", "c", raster.to_uint16(v, F.lit("clip")).alias("v"))


@query("k16_dtype_action", sql("rasters", "&b as (select chip, min(q) as lo, max(q) as hi from rasters group by 1) select chip, case when lo >= 0 and hi <= 65535 then case when chip % 5 = 0 then 'skip' else 'cast' end when chip % 5 <> 0 and chip % 2 = 0 and lo >= 0 and hi <= 1 then 'scale' else 'clip' end as action from b"))
def k16(spark, d):
    b = rasters(spark, d).groupBy("chip").agg(F.min("q").alias("lo"), F.max("q").alias("hi"))
    kind = F.when(F.col("chip") % 5 == 0, "uint16").when(F.col("chip") % 2 == 0, "float32").otherwise("int32")
    return b.select("chip", X.uint16_action(kind, F.col("lo"), F.col("hi")).alias("action"))


@query("r2_round_clip", sql("rasters", "select chip, r, c, least(greatest(case when (q * 5) % 2 = 0 or ((q * 5 - 1) / 2) % 2 = 0 then floor(q * 5 / 2.0) else ceil(q * 5 / 2.0) end, 0), 65535)::int as v from rasters"))
def r2(spark, d):
    return rasters(spark, d).select("chip", "r", "c", raster.round_clip(F.col("q") * 5 / 2.0).alias("v"))


@query("r13_confidence", "select vec_id as chip, (list_position(embedding, list_max(embedding)) - 1)::int as cls, round(1 / list_sum(list_transform(embedding, lambda x: exp(x::double - list_max(embedding)::double))), 9) as confidence from embeddings")
def r13(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("chip"), F.transform("embedding", lambda x: x.cast("double")).alias("z"))
    return e.withColumn("o", raster.confidence(F.col("z"))).select("chip", F.col("o.class").alias("cls"), F.round("o.confidence", 9).alias("confidence"))


@query("r13_rescaled", sql("rasters", """select chip, r // 2 * 4 + c // 2 as pos, avg(q)::double as confidence, max(case when r % 2 = 0 and c % 2 = 0 then abs(q) % 3 end)::int as cls from rasters group by 1, 2"""))
def r13b(spark, d):
    """Confidence and classes of a model at twice the resolution, brought back to the chip's."""
    half = lambda f, how: raster.rescale(8, 8, 4, 4, how)(F.transform("band", f))
    both = _bands(spark, d).select("chip", half(lambda x: x.cast("double"), False).alias("a"), half(lambda x: (F.abs(x) % 3).cast("double"), True).alias("b"))
    return both.select("chip", F.posexplode(F.arrays_zip("a", "b")).alias("pos", "v")).select("chip", F.col("pos").cast("bigint").alias("pos"), F.col("v.a").alias("confidence"), F.col("v.b").cast("int").alias("cls"))


@query("r14_normalize", sql("rasters", "select chip, r, c, q / 3000.0::double as v from rasters"))
def r14(spark, d):
    return rasters(spark, d).select("chip", "r", "c", raster.normalize(F.col("q"), "by_3000").alias("v"))


@query("r15_remap_unlabeled", sql("rasters", "select chip, r, c, case when bad > 0 then abs(q) % 3 else 3 end as y from rasters"))
def r15(spark, d):
    return rasters(spark, d).select("chip", "r", "c", raster.remap_unlabeled(F.abs("q") % 3, F.col("bad")).alias("y"))


@query("r16_corner_crops", sql("rasters", """&k as (select * from (values ('tl', 0, 0), ('tr', 0, 2), ('bl', 2, 0), ('br', 2, 2)) t(corner, r0, c0))
select chip, corner, count(*) as n, count(*) filter (r between 2 and 5 and c between 2 and 5) as shared from rasters join k on r between r0 and r0 + 5 and c between c0 and c0 + 5 group by 1, 2"""))
def r16(spark, d):
    return raster.crop_pixels(rasters(spark, d), 8, 6).groupBy("chip", "corner").agg(F.count(F.lit(1)).alias("n"), F.count_if("shared").alias("shared"))


@query("g18_consensus", sql("rasters", """&k as (select * from (values ('tl', 0), ('tr', 1), ('bl', 2), ('br', 3)) t(corner, o)),
p as (select chip, r, c, (abs(q) + case when abs(q) % 10 = 0 then o else 0 end) % 3 as cls from rasters, k where r between 2 and 5 and c between 2 and 5),
s as (select chip, r, c, case when min(cls) = max(cls) then 1 else 0 end as same from p group by 1, 2, 3)
select chip, sum(same)::double / count(*) as consensus from s group by 1"""))
def g18(spark, d):
    p = raster.crop_pixels(rasters(spark, d), 8, 6).filter("shared")
    o = F.when(F.col("corner") == "tl", 0).when(F.col("corner") == "tr", 1).when(F.col("corner") == "bl", 2).otherwise(3)
    cls = (F.abs("q") + F.when(F.abs("q") % 10 == 0, o).otherwise(0)) % 3
    return metrics.consensus(p.withColumn("cls", cls), "chip")


@query("r18_mosaic_top", sql("rasters", "select label, r, c, arg_max(q, chip) as q from rasters group by 1, 2, 3"))
def r18(spark, d):
    return raster.mosaic(rasters(spark, d), ["label", "r", "c"], "chip", "q")


@query("r19_clamp_scale", sql("rasters", "select label, r, c, arg_max(greatest(q, 0) * 10, chip) as q from rasters group by 1, 2, 3"))
def r19(spark, d):
    return raster.mosaic(rasters(spark, d).withColumn("q", F.greatest("q", F.lit(0)) * 10), ["label", "r", "c"], "chip", "q")


@query("g22_median_composite", sql("rasters", "select label, r, c, median(q)::double as median from rasters group by 1, 2, 3"))
def g22(spark, d):
    return raster.median_composite(rasters(spark, d), ["label", "r", "c"], "q")


@query("g22_two_date_median", sql("rasters", "select a.chip, a.r, a.c, trunc((a.q + b.q) / 2.0)::int as v from rasters a join rasters b on b.chip = a.chip + 1 and a.r = b.r and a.c = b.c where a.chip % 2 = 0"))
def g22b(spark, d):
    a = rasters(spark, d).filter("chip % 2 = 0").select("chip", "r", "c", F.col("q").alias("qa"))
    b = rasters(spark, d).selectExpr("chip - 1 as chip", "r", "c", "q as qb")
    return a.join(b, ["chip", "r", "c"]).select("chip", "r", "c", ((F.col("qa") + F.col("qb")) / 2.0).cast("int").alias("v"))


@query("r1_bilinear", sql("rasters", """&g as (select (i * 15 + j)::int as pos, unnest([i // 2, (i + 1) // 2]) as r, j from (select range as i from range(15)), (select range as j from range(15))),
h as (select pos, r, unnest([j // 2, (j + 1) // 2]) as c from g)
select chip, pos, sum(q) / 4.0::double as v from h join rasters using (r, c) group by 1, 2"""))
def r1(spark, d):
    """All positions: every second one lies halfway between two samples."""
    return _bands(spark, d).select("chip", F.posexplode(raster.resample(8, 8, 15, 15)(F.transform("band", lambda x: x.cast("double")))).alias("pos", "v"))


@query("r7_fill_gaps")
def r7(spark, d):
    b = F.transform("band", lambda x: F.when(x % 9 == 0, -9999.0).otherwise(x.cast("double")))
    return _bands(spark, d).select("chip", F.posexplode(raster.fill(8, 8, -9999.0)(b)).alias("pos", "v"))


@query("r8_pad", sql("rasters", "&g as (select distinct chip, p::int as pos from rasters, (select range as p from range(100))) select g.chip, pos, coalesce(q, 0)::double as v from g left join rasters b on b.chip = g.chip and b.r = pos // 10 and b.c = pos % 10"))
def r8(spark, d):
    p = raster.pad(8, 8, 10, 0.0)(F.transform("band", lambda x: x.cast("double")))
    return _bands(spark, d).select("chip", F.posexplode(p).alias("pos", "v"))


def _augmented(spark, d, **how):
    p = raster.augment(8, 8, **how)(F.transform("band", lambda x: x.cast("double")))
    return _bands(spark, d).select("chip", F.posexplode(p).alias("pos", "v"))


@query("r20_augment", sql("rasters", "select chip, ((7 - c) * 8 + 7 - r)::int as pos, q * 2.0::double as v from rasters"))
def r20(spark, d):
    return _augmented(spark, d, turn=1, flip_h=True, brightness=2.0)


@query("r20_flip_down", sql("rasters", "select chip, ((7 - r) * 8 + c)::int as pos, q::double as v from rasters"))
def r20v(spark, d):
    return _augmented(spark, d, flip_v=True)


@query("r20_sharpness", sql("rasters", """&k as (select a.chip, a.r, a.c, a.q, (sum(b.q) + 4 * a.q) / 13.0::double as soft from rasters a join rasters b on a.chip = b.chip and abs(a.r - b.r) <= 1 and abs(a.c - b.c) <= 1 group by 1, 2, 3, 4)
select chip, (r * 8 + c)::int as pos, round(case when r in (0, 7) or c in (0, 7) then q else soft + (q - soft) * 1.5 end, 6)::double as v from k"""))
def r20s(spark, d):
    return _augmented(spark, d, sharpness=1.5).withColumn("v", F.round("v", 6))


@query("e16_polygonize")
def e16(spark, d):
    b = raster.polygonize(8, 8)(F.transform("band", lambda x: (x < 0).cast("double")))
    return _bands(spark, d).select("chip", F.array_max(b).cast("int").alias("n_regions"))


CONF = """&t as (select vec_id, label % 3 as y, (list_position(embedding, list_max(embedding)) - 1)::int % 3 as p from embeddings),
c as (select y, p, count(*) as n from t group by 1, 2),
k as (select range::int as cls from range(3)),
m as (select cls, coalesce(sum(n) filter (y = cls and p = cls), 0)::bigint as tp, coalesce(sum(n) filter (y <> cls and p = cls), 0)::bigint as fp, coalesce(sum(n) filter (y = cls and p <> cls), 0)::bigint as fn from k, c group by 1),
x as (select *, coalesce(tp::double / nullif(tp + fp, 0), 0) as precision, coalesce(tp::double / nullif(tp + fn, 0), 0) as recall, coalesce(tp::double / nullif(tp + fp + fn, 0), 0) as jaccard from m)
"""


def _conf(spark, d):
    e = table(spark, d, "embeddings").select((F.col("label") % 3).alias("y"), ((F.array_position("embedding", F.array_max("embedding")) - 1) % 3).cast("int").alias("p"))
    return metrics.confusion(e)


@query("g17_class_metrics", "with " + CONF.removeprefix("&") + "select cls, tp, fp, fn, round(precision, 9) as precision, round(recall, 9) as recall, round(jaccard, 9) as jaccard from x")
def g17(spark, d):
    m = metrics.class_metrics(_conf(spark, d))
    return m.select("cls", "tp", "fp", "fn", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "jaccard")])


@query("g17_overall_metrics", "with " + CONF.removeprefix("&") + "select round(avg(precision), 9) as macro_precision, round(avg(recall), 9) as macro_recall, round(avg(jaccard), 9) as macro_jaccard, round(sum(tp)::double / sum(tp + fn), 9) as micro from x")
def g17b(spark, d):
    m = metrics.overall(metrics.class_metrics(_conf(spark, d)))
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


@query("g19_class_weights", """with v as (select label from embeddings where label <> 3), n as (select label, (select count(*) from v)::double / count(*) as ratio from v where label between 0 and 11 group by 1),
w as (select label, ratio / sum(ratio) over () as weight from n) select range::int as cls, round(coalesce(weight, 1e-5), 12) as weight from range(12) left join w on label = range""")
def g19(spark, d):
    return metrics.class_weights(table(spark, d, "embeddings"), "label", 12, ignore=3).select("cls", F.round("weight", 12).alias("weight"))


LOSS = """&o as (select chip, r, c, abs(q) % 3 as truth, abs(q) % 101 / 100.0::double as p0 from rasters),
l as (select chip, r, c, truth, cls, case when truth = cls then 1 else 0 end as y, case cls when 0 then p0 when 1 then (1 - p0) * 0.75 else (1 - p0) * 0.25 end as p from o, (select range::int as cls from range(3)))
"""


def _long(spark, d):
    o = rasters(spark, d).selectExpr("chip", "r", "c", "abs(q) % 3 as truth", "abs(q) % 101 / 100.0D as p0")
    l = o.withColumn("cls", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    p = F.when(F.col("cls") == 0, F.col("p0")).when(F.col("cls") == 1, (1 - F.col("p0")) * 0.75).otherwise((1 - F.col("p0")) * 0.25)
    return l.withColumn("y", (F.col("truth") == F.col("cls")).cast("int")).withColumn("p", p)


def _loss_query(name: str, expr: str):
    body = f"select cls, round({expr}, 8) as loss from (select cls, sum(p * y) as tp, sum(p * (1 - y)) as fp, sum((1 - p) * y) as fn, sum(p * p) as pp, sum(y * y) as yy, sum((1 - p) * (1 - p)) as cp, sum((1 - y) * (1 - y)) as cy, sum((1 - p) * (1 - y)) as tn from l group by 1)"

    @query(f"l_{name}", sql("rasters", LOSS + body))
    def run(spark, d):
        return _long(spark, d).groupBy("cls").agg(F.round(metrics.LOSSES[name](F.col("p"), F.col("y")), 8).alias("loss"))

    return run


_loss_query("tversky_focal", "pow(1 - (tp + 1) / (tp + 0.7 * fn + 0.3 * fp + 1), 1 / 1.33)")
_loss_query("tversky", "1 - (tp + 1) / (tp + 0.3 * fp + 0.7 * fn + 1)")
_loss_query("dice", "1 - (2 * tp + 1) / (2 * tp + fp + fn + 1)")
_loss_query("jaccard", "1 - (tp + 1) / (tp + fp + fn + 1)")
_loss_query("log_cosh_dice", "ln((exp(1 - (2 * tp + 1) / (2 * tp + fp + fn + 1)) + exp(-(1 - (2 * tp + 1) / (2 * tp + fp + fn + 1)))) / 2)")
_D = lambda s, a, b: " + ".join(f"1 / ({2.0**k} * ({a} + {b}) - {2.0 ** (k + 1) - 1} * {s} + 1e-5)" for k in range(5))
_loss_query("tanimoto", f"1 - ((tp + 1e-5) * ({_D('tp', 'pp', 'yy')}) / 5 + (tn + 1e-5) * ({_D('tn', 'cp', 'cy')}) / 5) / 2")


@query("l2_cross_entropy", sql("rasters", LOSS + "select round(sum(-w * ln(greatest(p, 1e-12))) / sum(w), 8) as loss from (select p, case truth when 0 then 0.2 when 1 then 0.3 else 0.5 end as w from l where y = 1 and truth <> 3)"))
def l2(spark, d):
    w = F.when(F.col("truth") == 0, 0.2).when(F.col("truth") == 1, 0.3).otherwise(0.5)
    return _long(spark, d).filter("y = 1 and truth <> 3").agg(F.round(metrics.cross_entropy(F.col("p"), w), 8).alias("loss"))


@query("l12_focal", sql("rasters", LOSS + "select round(avg(-pow(1 - p, 2) * ln(greatest(p, 1e-12))), 8) as loss from l where y = 1"))
def l12(spark, d):
    return _long(spark, d).filter("y = 1").agg(F.round(metrics.focal(F.col("p")), 8).alias("loss"))


@query("l5_multiclass_dice", sql("rasters", LOSS + "select round(avg(v), 8) as loss from (select cls, 1 - (2 * sum(p * y) + 1) / (2 * sum(p * y) + sum(p * (1 - y)) + sum((1 - p) * y) + 1) as v from l where truth <> 2 group by 1)"))
def l5(spark, d):
    return metrics.multiclass(_long(spark, d), "dice", ignore=2).select(F.round("loss", 8).alias("loss"))


@query("l6_locally_weighted", sql("rasters", LOSS + """, m as (select * from l where truth <> 1), n as (select truth as cls, (select count(*) from m where y = 1)::double / count(*) as ratio from m where y = 1 group by 1),
w as (select cls, ratio / sum(ratio) over () as weight from n),
x as (select cls, pow(1 - (sum(p * y) + 1) / (sum(p * y) + 0.7 * sum((1 - p) * y) + 0.3 * sum(p * (1 - y)) + 1), 1 / 1.33) as x from m group by 1)
select round(sum(coalesce(weight, 1e-5) * x), 8) as loss from x left join w using (cls)"""))
def l6(spark, d):
    return metrics.loss(_long(spark, d), "localtversky", ignore=1).select(F.round("loss", 8).alias("loss"))


@query("l7_tversky_ce", sql("rasters", LOSS + """select round(0.5 * (select avg(x) from (select cls, pow(1 - (sum(p * y) + 1) / (sum(p * y) + 0.7 * sum((1 - p) * y) + 0.3 * sum(p * (1 - y)) + 1), 1 / 1.33) as x from l group by 1))
 + 0.5 * (select avg(-ln(greatest(p, 1e-12))) from l where y = 1), 8) as loss"""))
def l7(spark, d):
    long = _long(spark, d)
    a = metrics.multiclass(long, "tversky_focal").withColumnRenamed("loss", "a")
    b = long.filter("y = 1").agg(metrics.cross_entropy(F.col("p"), F.lit(1.0)).alias("b"))
    return a.crossJoin(b).select(F.round(0.5 * F.col("a") + 0.5 * F.col("b"), 8).alias("loss"))


@query("l3_edge_weighted_ce", sql("rasters", """&px as (select chip, r, c, abs(q) % 3 as y, greatest(abs(q) % 101 / 100.0::double, 0.01) as p from rasters),
tap as (select i, j, exp(-(i * i + j * j) / 18.0::double) as k from (select unnest(range(-3, 4)) as i), (select unnest(range(-3, 4)) as j)),
near as (select a.chip, a.r, a.c, a.p, sum(case when b.y = 2 then t.k else 0 end) / (select sum(k) from tap) as blur from px a, tap t join px b on true
  where b.chip = a.chip and b.r = case when a.r + t.i < 0 then -(a.r + t.i) when a.r + t.i > 7 then 14 - (a.r + t.i) else a.r + t.i end and b.c = case when a.c + t.j < 0 then -(a.c + t.j) when a.c + t.j > 7 then 14 - (a.c + t.j) else a.c + t.j end group by 1, 2, 3, 4)
select chip, round(sum((1 + 4 * blur) * -ln(p)) / sum(1 + 4 * blur), 8) as loss from near group by 1"""))
def l3(spark, d):
    px = rasters(spark, d).selectExpr("chip", "r", "c", "abs(q) % 3 as y", "greatest(abs(q) % 101 / 100.0D, 0.01D) as p")
    w = metrics.edge_weights(px, 8, 8, scale=4.0)
    return w.groupBy("chip").agg(F.round(metrics.cross_entropy(F.col("p"), F.col("weight")), 8).alias("loss"))


SUMS = """, z as (select cls, sum(p * y) as tp, sum(p * (1 - y)) as fp, sum((1 - p) * y) as fn, sum(y) as n, sum(p * p) as pp, sum(y * y) as yy, sum((1 - p) * (1 - p)) as cp, sum((1 - y) * (1 - y)) as cy, sum((1 - p) * (1 - y)) as tn from l where truth <> 2 group by 1),
ce as (select sum(-w * ln(greatest(p, 1e-12))) / sum(w) as v from (select p, case truth when 0 then 0.2 when 1 then 0.3 else 0.5 end as w from l where y = 1 and truth <> 2))
"""
_DICE = "case when n > 0 then 1 - 2 * tp / greatest(2 * tp + fp + fn, 1e-7) else 0 end"
_TVF = "pow(1 - (tp + 1) / (tp + 0.7 * fn + 0.3 * fp + 1), 1 / 1.33)"
_FT = f"(1 - ((tp + 1e-5) * ({_D('tp', 'pp', 'yy')}) / 5 + (tn + 1e-5) * ({_D('tn', 'cp', 'cy')}) / 5) / 2)"
_W = "case cls when 0 then 0.2 when 1 then 0.3 else 0.5 end"
#: Each named loss over pixels whose truth is not 2, with class weights where it takes them.
NAMED_SQL = {
    "ce": "select v from ce",
    "jaccard": "select avg(case when n > 0 then 1 - tp / greatest(tp + fp + fn, 1e-7) else 0 end) as v from z",
    "focal": "select sum(f) as v from (select cls, avg(-pow(1 - q, 2) * ln(q)) / greatest(sum(pow(1 - q, 2)), 1e-6) as f from (select cls, greatest(case when y = 1 then p else 1 - p end, 1e-12) as q from l where truth <> 2) group by 1)",
    "tversky": "select avg(case when n > 0 then 1 - tp / greatest(tp + 0.5 * fp + 0.5 * fn, 1e-7) else 0 end) as v from z",
    "dice": f"select avg({_DICE}) as v from z",
    "ce+dice": f"select (select v from ce) + avg({_DICE}) as v from z",
    "logcoshdice": f"select ln((exp(x) + exp(-x)) / 2) as v from (select sum({_W} * {_DICE}) as x from z)",
    "logcoshdice+ce": f"select 0.5 * ln((exp(x) + exp(-x)) / 2) + 0.5 * (select v from ce) as v from (select sum({_W} * {_DICE}) as x from z)",
    "ftnmt": f"select sum({_W} * {_FT}) as v from z",
    "ce+ftnmt": f"select 0.5 * (select v from ce) + 0.5 * sum({_W} * {_FT}) as v from z",
    "localtversky": f"select sum({_TVF} * case when n > 0 then inv / (select sum((select sum(n) from z)::double / n) from z where n > 0) else 1e-5 end) as v from (select *, (select sum(n) from z)::double / nullif(n, 0) as inv from z)",
    "tversky_ce": f"select 0.5 * sum({_W} * {_TVF}) + 0.5 * (select v from ce) as v from z",
    "customtversky": f"select sum({_W} * case when n > 0 then 1 - tp / greatest(tp + case cls when 0 then 0.3 else 0.5 end * fp + case cls when 0 then 0.7 else 0.5 end * fn, 1e-7) else 0 end) as v from z",
}
HOW = {"customtversky": {"per_class": True, "alphas": {0: 0.3}, "betas": {0: 0.7}}}


def _named_loss(name: str, body: str):
    @query(f"l1_{name.replace('+', '_and_')}", sql("rasters", LOSS + SUMS + f", o1 as ({body}) select round(v, 8)::double as loss from o1"))
    def run(spark, d):
        return metrics.loss(_long(spark, d), name, {0: 0.2, 1: 0.3, 2: 0.5}, ignore=2, **HOW.get(name, {})).select(F.round("loss", 8).alias("loss"))

    return run


for _name, _body in NAMED_SQL.items():
    _named_loss(_name, _body)


@query("l1_pixel_weighted_ce", sql("rasters", """&px as (select chip, r, c, abs(q) % 3 as y, greatest(case abs(q) % 3 when 0 then abs(q) % 101 / 100.0::double when 1 then (1 - abs(q) % 101 / 100.0) * 0.75 else (1 - abs(q) % 101 / 100.0) * 0.25 end, 1e-12) as p from rasters),
tap as (select i, j, exp(-(i * i + j * j) / 18.0::double) as k from (select unnest(range(-3, 4)) as i), (select unnest(range(-3, 4)) as j)),
near as (select a.chip, a.r, a.c, a.p, a.y, sum(case when b.y = 2 then t.k else 0 end) / (select sum(k) from tap) as blur from px a, tap t join px b on true
  where b.chip = a.chip and b.r = case when a.r + t.i < 0 then -(a.r + t.i) when a.r + t.i > 7 then 14 - (a.r + t.i) else a.r + t.i end and b.c = case when a.c + t.j < 0 then -(a.c + t.j) when a.c + t.j > 7 then 14 - (a.c + t.j) else a.c + t.j end group by 1, 2, 3, 4, 5)
select round(sum((1 + 3 * blur) * -ln(p) * case y when 0 then 0.2 else 0.3 end) / sum(1 + 3 * blur), 8) as loss from near where y <> 2"""))
def l1p(spark, d):
    return metrics.loss(_long(spark, d), "pixel_weighted_ce", {0: 0.2, 1: 0.3, 2: 0.5}, ignore=2, rows=8, cols=8, pixel_weight_scale=3.0).select(F.round("loss", 8).alias("loss"))


@query("l9_log_cosh_ce", sql("rasters", LOSS + """select round((select avg(ln((exp(z) + exp(-z)) / 2)) from (select cls, 1 - (2 * sum(p * y) + 1) / (2 * sum(p * y) + sum(p * (1 - y)) + sum((1 - p) * y) + 1) as z from l group by 1))
 + (select avg(-ln(greatest(p, 1e-12))) from l where y = 1), 8) as loss"""))
def l9(spark, d):
    long = _long(spark, d)
    a = metrics.multiclass(long, "log_cosh_dice").withColumnRenamed("loss", "a")
    b = long.filter("y = 1").agg(metrics.cross_entropy(F.col("p"), F.lit(1.0)).alias("b"))
    return a.crossJoin(b).select(F.round(F.col("a") + F.col("b"), 8).alias("loss"))


@query("l11_combined_ignore", sql("rasters", LOSS + f"""select round((select avg(-ln(greatest(p, 1e-12))) from l where y = 1 and truth <> 2) + (select avg(1 - ((tp + 1e-5) * ({_D('tp', 'pp', 'yy')}) / 5 + (tn + 1e-5) * ({_D('tn', 'cp', 'cy')}) / 5) / 2)
 from (select cls, sum(p * y) as tp, sum(p * p) as pp, sum(y * y) as yy, sum((1 - p) * (1 - p)) as cp, sum((1 - y) * (1 - y)) as cy, sum((1 - p) * (1 - y)) as tn from l where truth <> 2 group by 1)), 8) as loss"""))
def l11(spark, d):
    long = _long(spark, d).filter("truth <> 2")
    a = metrics.multiclass(long, "tanimoto").withColumnRenamed("loss", "a")
    b = long.filter("y = 1").agg(metrics.cross_entropy(F.col("p"), F.lit(1.0)).alias("b"))
    return a.crossJoin(b).select(F.round(F.col("a") + F.col("b"), 8).alias("loss"))


VEC = "&t as (select a.ckpt, a.key, a.idx, a.v - b.v as v from weights a join weights b on b.ckpt = 0 and a.key = b.key and a.idx = b.idx where a.ckpt > 0)\n"


def _vectors(spark, d):
    w = weights(spark, d)
    return merge.task_vectors(w.filter("ckpt = 0"), w.filter("ckpt > 0"))


@query("j14_mergeable_keys", "select vec_id as key from embeddings where vec_id % 3 <> 0 and vec_id % 4 <> 0")
def j14(spark, d):
    e = table(spark, d, "embeddings")
    base = e.select(F.col("vec_id").alias("key"), F.lit("64").alias("shape"), F.when(F.col("vec_id") % 3 == 0, "int64").otherwise("float32").alias("kind"))
    tuned = e.select(F.col("vec_id").alias("key"), F.when(F.col("vec_id") % 4 == 0, "32").otherwise("64").alias("shape"), F.lit("float32").alias("kind"))
    return merge.mergeable(base, tuned)


@query("g20_magnitude_max", sql("weights", VEC + "select key, idx, v from (select *, row_number() over (partition by key, idx order by abs(v) desc, ckpt) as rn from t) where rn = 1"))
def g20(spark, d):
    return merge.magnitude_max(_vectors(spark, d))


@query("g21_task_sum", sql("weights", VEC + "select key, idx, sum(v)::double as v from t group by 1, 2"))
def g21(spark, d):
    return merge.total(_vectors(spark, d))


@query("g21_norms", sql("weights", VEC + "select ckpt, round(sqrt(sum(v * v)), 6) as l2 from t group by 1"))
def g21n(spark, d):
    return merge.norm(_vectors(spark, d)).select("ckpt", F.round("l2", 6).alias("l2"))


@query("g21_apply_scaled", sql("weights", VEC + ", s as (select key, idx, sum(v) as v from t group by 1, 2) select b.key, b.idx, (b.v + 0.5 * coalesce(s.v, 0))::double as v from weights b left join s using (key, idx) where b.ckpt = 0"))
def g21a(spark, d):
    w = weights(spark, d)
    return merge.apply(w.filter("ckpt = 0").drop("ckpt"), merge.total(_vectors(spark, d)), 0.5)


@query("g21_negate", sql("weights", VEC + "select ckpt, key, idx, (-v)::double as v from t"))
def g21m(spark, d):
    return merge.scaled(_vectors(spark, d), -1.0)
