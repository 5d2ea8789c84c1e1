"""Queries on scenes: search, pairs, tiers, dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldloom.functions import expressions as X
from fieldloom.operators import scenes as S

from .registry import query
from .views import scenes, sql, table

LADDER = [1, 2, 5, 10, 20]


@query("s7_search", sql("scenes", "select scene_id, tile, cloud from scenes where ts >= timestamp '1997-03-01' and ts < timestamp '1997-09-01' and cloud < 10 and nodata < 50"))
def s7(spark, d):
    return S.search(scenes(spark, d), "1997-03-01", "1997-09-01", 10, nodata=50).select("scene_id", "tile", "cloud")


@query("s7_search_inclusive", sql("scenes", "select scene_id, cloud from scenes where ts >= timestamp '1997-01-01' and ts < timestamp '1998-01-01' and cloud <= 10 and tile = 3"))
def s7b(spark, d):
    return S.search(scenes(spark, d), "1997-01-01", "1998-01-01", 10, inclusive=True, tile=3).select("scene_id", "cloud")


@query("s8_search_refine", sql("fields", "select field_id from fields where x0 <= 9000 and x1 >= 4000 and y0 <= 9000 and y1 >= 4000 and abs((x0 + x1) - 13000) + abs((y0 + y1) - 13000) <= 10000"))
def s8(spark, d):
    from .views import fields

    exact = F.expr("abs((x0 + x1) - 13000) + abs((y0 + y1) - 13000) <= 10000")
    return S.search_shapes(fields(spark, d), (4000, 4000, 9000, 9000), exact).select("field_id")


@query("s8_search_boxes", sql("fields", "select field_id from fields where x0 <= 9000 and x1 >= 4000 and y0 <= 9000 and y1 >= 4000"))
def s8b(spark, d):
    from .views import fields

    return S.search_shapes(fields(spark, d), (4000, 4000, 9000, 9000), F.lit(False), fallback=True).select("field_id")


@query("g4_group_by_tile", sql("scenes", "select tile, count(*) as n, min(ts) as first_ts, max(ts) as last_ts, string_agg(scene_id::varchar, ',' order by ts, scene_id) as scene_ids from scenes where tile is not null group by tile"))
def g4(spark, d):
    got = scenes(spark, d).filter("tile is not null").groupBy("tile").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.array_sort(F.collect_list(F.struct("ts", "scene_id"))).alias("s"))
    return got.select("tile", "n", "first_ts", "last_ts", F.array_join(F.transform("s.scene_id", lambda x: x.cast("string")), ",").alias("scene_ids"))


PAIR = """&p as (
  select a.tile, a.scene_id as s1, b.scene_id as s2, a.ts as t1, b.ts as t2, a.cloud as c1, b.cloud as c2, date_diff('day', a.ts, b.ts) as gap_days
  from scenes a join scenes b on a.tile = b.tile and b.ts >= a.ts + interval 90 days),
f as (select *, row_number() over (partition by tile, s1 order by c2, t2, s2) as rn from p),
g as (select *, c1 + c2 as cloud_sum, case when greatest(c1, c2) < 1 then 1.0 when greatest(c1, c2) < 2 then 2.0 when greatest(c1, c2) < 5 then 5.0 when greatest(c1, c2) < 10 then 10.0 when greatest(c1, c2) < 20 then 20.0 end::double as rung from f where rn = 1),
h as (select *, row_number() over (partition by tile order by rung, cloud_sum, gap_days desc, t1, s1) as rn2 from g where rung is not null)
select tile, rung, s1, s2, cloud_sum, gap_days from h where rn2 = 1"""


@query("j6_best_pair", sql("scenes", PAIR))
def j6(spark, d):
    return S.best_pair(scenes(spark, d), 3, LADDER)


@query("w9_ladder_inclusive", sql("scenes", PAIR.replace(") < ", ") <= ")))
def w9(spark, d):
    return S.best_pair(scenes(spark, d), 3, LADDER, inclusive=True)


@query("w8_pairs_sorted", sql("scenes", PAIR.replace("select tile, rung, s1, s2, cloud_sum, gap_days from h where rn2 = 1", "select row_number() over (order by cloud_sum, gap_days desc, t1, tile)::bigint as place, tile, cloud_sum from h where rn2 = 1")))
def w8(spark, d):
    best = S.best_pair(scenes(spark, d), 3, LADDER)
    t1 = scenes(spark, d).select(F.col("scene_id").alias("s1"), F.col("ts").alias("t1"))
    # one row a tile
    return best.join(t1, "s1").selectExpr("cast(row_number() over (order by cloud_sum, gap_days desc, t1, tile) as bigint) as place", "tile", "cloud_sum")


@query("s13_pair_csv_lines", sql("scenes", PAIR.replace("select tile, rung, s1, s2, cloud_sum, gap_days from h where rn2 = 1", "select tile::varchar || ',' || printf('%.2f', c1::double) || ',' || printf('%.2f', c2::double) || ',' || case when gap_days > 180 then 'yes' else 'no' end as line from h where rn2 = 1")))
def s13(spark, d):
    s = scenes(spark, d)
    best = S.best_pair(s, 3, LADDER)
    c = lambda k: s.select(F.col("scene_id").alias(f"s{k}"), F.col("cloud").alias(f"c{k}"))
    both = best.join(c(1), "s1").join(c(2), "s2")
    two = lambda k: F.format_string("%.2f", F.col(k).cast("double"))
    return both.select(F.concat_ws(",", F.col("tile").cast("string"), two("c1"), two("c2"), F.when(F.col("gap_days") > 180, "yes").otherwise("no")).alias("line"))


@query("j7_first_two_pairs", sql("scenes", """&s as (select *, row_number() over (partition by tile order by ts, scene_id) as i from scenes),
l as (select unnest([1, 2, 3, 4, 5]) as place, unnest([1.0, 2.0, 5.0, 10.0, 20.0])::double as rung, unnest([8, 7, 6, 4, 2]) as months),
r as (
  select a.tile, a.i as i1, b.i as i2, a.scene_id as s1, b.scene_id as s2, l.place, l.rung
  from s a join s b on a.tile = b.tile and a.i < b.i join l on a.cloud <= l.rung and b.cloud <= l.rung and b.ts - a.ts >= to_days((30 * l.months)::int)),
k as (select *, row_number() over (partition by tile, place order by i1, i2) as n, count(*) over (partition by tile, place) as m from r),
q as (select *, min(place) over (partition by tile) as low from k where m >= 2 and n <= 2)
select tile, rung, n, s1, s2 from q where place = low"""))
def j7(spark, d):
    return S.first_two_pairs(scenes(spark, d), [(1, 8), (2, 7), (5, 6), (10, 4), (20, 2)])


TIER = """&b as (
  select scene_id, tile as chip, ts, ts::date as day, cloud / 200.0::double as c, case when tile % 5 = 0 then null else 100 + tile * 10 end as doy, 1997 as y from scenes where scene_id % 7 <> 0),
e as (select *, date '1997-01-01' + (doy - 1)::int as dt from b),
t as (select *, {target} as target from e),
m as (select *, case when doy is null then case when year(day) = y and c <= 0.08 then 0 end
   when abs(date_diff('day', target, day)) <= 7 and c <= 0.01 then 1
   when day between {lo} and {hi} and c <= 0.02 then 2
   when {m2} and c <= 0.08 then 3 end as tier,
   case when {k2} then 2 when {k3} then 3 when {k4} then 4 when {k5} then 5 end as months from t),
k as (select *, case tier when 1 then abs(epoch_us(ts) - epoch_us(target::timestamp)) when 3 then months else 0 end as key from m where tier is not null),
w as (select *, row_number() over (partition by chip order by tier, key, case when tier = 1 then 0.0 else c end, ts, scene_id) as rn from k)
select chip, scene_id, tier from w where rn = 1"""
_P = {"target": "dt + 45", "lo": "dt + 14", "hi": "dt + 30"} | {f"k{m}": f"day between dt and (dt + interval {m} months)::date" for m in (2, 3, 4, 5)}
_H = {"target": "(dt - interval 1 month)::date", "lo": "dt - 30", "hi": "dt - 14"} | {f"k{m}": f"day between (dt - interval {m} months)::date and dt" for m in (2, 3, 4, 5)}


def _tiers(spark, d, harvest):
    s = scenes(spark, d).selectExpr("scene_id", "tile as chip", "ts", "case when scene_id % 7 = 0 then null else cloud / 200.0D end as cloud_fraction", "cast(case when tile % 5 = 0 then null else 100 + tile * 10 end as int) as doy", "1997 as year")
    return S.tiers(s, harvest)


@query("w10_tiers_planting", sql("scenes", TIER.format(**_P, m2=_P["k5"])))
def w10p(spark, d):
    return _tiers(spark, d, False)


@query("w10_tiers_harvest", sql("scenes", TIER.format(**_H, m2=_H["k5"])))
def w10h(spark, d):
    return _tiers(spark, d, True)


@query("k8_doy_to_date", "select event_id, make_date(2023, 1, 1) + least(366, greatest(1, cast(floor(value * 10) as bigint) % 400))::int - 1 as at from events")
def k8(spark, d):
    return table(spark, d, "events").select("event_id", X.doy_to_date(F.lit(2023), F.expr("cast(floor(value * 10) as bigint) % 400")).alias("at"))


@query("k9_months", "select o_orderkey, (o_orderdate::date - interval 1 month)::date as before, (o_orderdate::date + interval 3 months)::date as after from orders")
def k9(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.add_months("o_orderdate", -1).alias("before"), F.add_months("o_orderdate", 3).alias("after"))


@query("k10_season_window", """with w as (
  select o_orderkey, case when o_orderkey % 9 = 0 then null else o_orderdate::date end as sos, (o_orderdate::date + (o_orderkey % 200)::int - 20) as eos, year(o_orderdate)::int as y from orders),
v as (select *, greatest(make_date(y, 1, 1), sos - 10) as s, least(make_date(y, 12, 31), eos + 10) as e from w),
k as (select *, coalesce(sos is not null and eos is not null and s < e, false) as known from v)
select o_orderkey, case when known then s else make_date(y, 1, 1) end as start_day, case when known then e else make_date(y, 12, 31) end as end_day, known from k""")
def k10(spark, d):
    o = table(spark, d, "orders").selectExpr("o_orderkey", "case when o_orderkey % 9 = 0 then null else cast(o_orderdate as date) end as sos", "date_add(cast(o_orderdate as date), cast(o_orderkey % 200 as int) - 20) as eos", "year(o_orderdate) as y")
    return o.withColumn("w", X.season_window(F.col("sos"), F.col("eos"), F.col("y"), 10)).select("o_orderkey", F.col("w.start").alias("start_day"), F.col("w.end").alias("end_day"), F.col("w.known").alias("known"))


@query("k11_floor_days", "select event_id, cast(floor((epoch_us(ts) - epoch_us(timestamp '2024-01-10 12:00:00')) / 86400000000) as bigint) as days from events")
def k11(spark, d):
    return table(spark, d, "events").select("event_id", X.floor_days(F.col("ts"), F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")).alias("days"))


@query("k14_date_names", "select o_orderkey, 'S2_' || strftime(o_orderdate, '%Y%m%d') as name from orders")
def k14(spark, d):
    return table(spark, d, "orders").select("o_orderkey", X.date_name("S2_", F.col("o_orderdate")).alias("name"))


@query("k12_utm_epsg", sql("fields", "select field_id, (floor((x0 / 20000.0 * 360 - 180 + 180) / 6) + 1 + case when y0 / 20000.0 * 180 - 90 >= 0 then 32600 else 32700 end)::int as epsg from fields"))
def k12(spark, d):
    from .views import fields

    return fields(spark, d).select("field_id", X.utm_epsg(F.col("x0") / 20000.0 * 360 - 180, F.col("y0") / 20000.0 * 180 - 90).alias("epsg"))


@query("k19_year", "select o_orderkey, case when o_orderkey % 2 = 0 then year(o_orderdate) else 2020 end::int as y from orders")
def k19(spark, d):
    o = table(spark, d, "orders").withColumn("year", F.when(F.col("o_orderkey") % 2 == 0, F.year("o_orderdate")))
    return o.select("o_orderkey", X.year_of(o, "year", 2020).alias("y"))
