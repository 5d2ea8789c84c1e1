"""Queries on projections and warped rasters."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldloom.functions import geometry as G
from fieldloom.functions import projection as J
from fieldloom.functions.shared import spread
from fieldloom.operators import joins
from fieldloom.operators import warp as W

from .queries_chips import UTM_X, UTM_Y
from .registry import query
from .views import chips, fields, rasters, shapes, sql

# points and shapes over Brazil: 20,000 units are 30 degrees, from (-70, -30)
LON, LAT = "({x} * 0.0015::double - 70)", "({y} * 0.0015::double - 30)"
POLY = """&ell as (select 6378137.0::double as a, (1 / 298.257222101::double) * (2 - 1 / 298.257222101::double) as e2),
pt as (select field_id, radians({lon} + 54) as lam, radians({lat}) as phi from fields),
mn as (select *, a / sqrt(1 - e2 * pow(sin(phi), 2)) as n, lam * sin(phi) as e,
  a * ((1 - e2 / 4 - 3 * pow(e2, 2) / 64 - 5 * pow(e2, 3) / 256) * phi - (3 * e2 / 8 + 3 * pow(e2, 2) / 32 + 45 * pow(e2, 3) / 1024) * sin(2 * phi) + (15 * pow(e2, 2) / 256 + 45 * pow(e2, 3) / 1024) * sin(4 * phi) - 35 * pow(e2, 3) / 3072 * sin(6 * phi)) as m from pt, ell)
select field_id, round(5000000 + case when phi = 0 then a * lam else n / tan(phi) * sin(e) end, 3) as x, round(10000000 + case when phi = 0 then 0 else m + n / tan(phi) * (1 - cos(e)) end, 3) as y from mn"""


def _points(spark, d):
    return fields(spark, d).selectExpr("field_id", "x0 * 0.0015D - 70 as lon", "y0 * 0.0015D - 30 as lat")


@query("e9_polyconic", sql("fields", POLY.format(lon=LON.format(x="x0"), lat=LAT.format(y="y0"))))
def e9_polyconic(spark, d):
    x, y = J.polyconic(F.col("lon"), F.col("lat"))
    return _points(spark, d).select("field_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


def _back(crs):
    def run(spark, d):
        to, back = J.system(crs)
        x, y = to(F.col("lon"), F.col("lat"))
        p = spread(_points(spark, d)).select("field_id", x.alias("x"), y.alias("y"))
        lon, lat = back(F.col("x"), F.col("y"))
        # 0.000001 degrees, without -0
        return p.select("field_id", (F.round(lon, 6) + 0.0).alias("lon"), (F.round(lat, 6) + 0.0).alias("lat"))

    return run


BACK = "select field_id, round({lon}, 6)::double as lon, round({lat}, 6) + 0.0::double as lat from fields".format(lon=LON.format(x="x0"), lat=LAT.format(y="y0"))
query("e9_polyconic_round_trip", sql("fields", BACK))(_back("EPSG:5880"))
query("e9_albers_round_trip", sql("fields", BACK))(_back("BRAZIL:ALBERS"))

# Albers keeps areas: a strip of a degree cell between two parallels has the area of the ellipsoid's zone
ALBERS = """&ell as (select 6378137.0::double as a, (1 / 298.257222101::double) * (2 - 1 / 298.257222101::double) as e2),
k as (select *, sqrt(e2) as e, sin(radians(-12)) as s1, sin(radians(-32)) as s2 from ell),
q as (select *, (1 - e2) * (s1 / (1 - e2 * s1 * s1) - ln((1 - e * s1) / (1 + e * s1)) / (2 * e)) as q1, (1 - e2) * (s2 / (1 - e2 * s2 * s2) - ln((1 - e * s2) / (1 + e * s2)) / (2 * e)) as q2,
  (1 - s1 * s1) / (1 - e2 * s1 * s1) as m1, (1 - s2 * s2) / (1 - e2 * s2 * s2) as m2 from k),
n as (select *, (m1 - m2) / (q2 - q1) as n from q),
c as (select *, m1 + n * q1 as c from n),
p as (select field_id, i, c.*, radians(p[1] * 0.0015::double - 70 + 54) as lam, sin(radians(p[2] * 0.0015::double - 30)) as s from corners, c),
r as (select *, a * sqrt(c - n * (1 - e2) * (s / (1 - e2 * s * s) - ln((1 - e * s) / (1 + e * s)) / (2 * e))) / n as rho from p),
xy as (select field_id, i, rho * sin(n * lam) as x, a * sqrt(c) / n - rho * cos(n * lam) as y from r)
select u.field_id, round(abs(sum(u.x * v.y - v.x * u.y)) / 2 / 1e6, 3)::double as km2 from xy u join xy v on u.field_id = v.field_id and v.i = u.i + 1 group by 1"""


@query("e9_albers_areas", sql("shapes", ALBERS))
def e9_albers(spark, d):
    degrees = F.transform("ring", lambda p: F.struct((p["x"] * 0.0015 - 70).alias("x"), (p["y"] * 0.0015 - 30).alias("y")))
    s, _ = J.projected(shapes(spark, d).select("field_id", degrees.alias("ring")), "ring", None, if_missing="EPSG:4674", target="BRAZIL:ALBERS")
    return s.select("field_id", F.round(G.ring_area(F.col("ring")) / 1e6, 3).alias("km2"))


# bands of 8 x 8 pixels of 10 m, 16 a row, in UTM zone 23 south; the target in degrees, as many pixels
WARP = """&ell as (select e2, e2 / (1 - e2) as ep from (select (1 / 298.257223563::double) * (2 - 1 / 298.257223563::double) as e2)),
src as (select (chip // 16) * 8 + r as row, (chip % 16) * 8 + c as col, q from rasters),
size as (select max(row) + 1 as h from src),
t as (select row, col, -45.9175::double + (col + 0.5::double) * 0.00009::double as lon, -11.7565::double + (row + 0.5::double) * -0.00009::double as lat from (select unnest(range(h)) as row from size), (select unnest(range(128)) as col)),
f as (select row, col, ({x} - 400000) / 10 - 0.5 as fc, ({y} - 8700000) / -10 - 0.5 as fr from t, ell),
n as (select f.*, i, j, abs(1 - i - (fc - floor(fc))) * abs(1 - j - (fr - floor(fr))) as w from f, (select unnest([0, 1]) as i), (select unnest([0, 1]) as j)),
v as (select n.row, n.col, sum(w * q) / sum(w) as v from n join src s on s.col = floor(fc) + i and s.row = floor(fr) + j where w > 0 group by 1, 2)
select f.row, f.col, round(v, 3) as v from f join v using (row, col) join src s on s.col = floor(fc + 0.5) and s.row = floor(fr + 0.5)"""


@query("r2_warp", sql("rasters", WARP.format(x=UTM_X.format(lon="lon", lat="lat"), y=UTM_Y.format(lon="lon", lat="lat"))))
def r2_warp(spark, d):
    b = rasters(spark, d)
    # one number
    height = b.agg(F.max(F.floor(F.col("chip") / 16)).alias("last")).first().last * 8 + 8
    band = F.transform(F.array_sort(F.collect_list(F.struct("r", "c", "q"))), lambda s: s["q"].cast("double"))
    # 0 stands for none in the result, so values are moved by a million and back
    tiles = b.groupBy("chip").agg(band.alias("band")).selectExpr("chip % 16 as gx", "chip div 16 as gy", "transform(band, v -> v + 1000000) as band")
    done = W.warp(tiles, W.Grid("EPSG:32723", 400000.0, 8700000.0, 10.0, -10.0), 8, W.Grid("EPSG:4326", -45.9175, -11.7565, 0.00009, -0.00009), 128, int(height), block=32)
    return W.pixels_of(done, 32).filter("v <> 0").select("row", "col", F.round(F.col("v") - 1000000, 3).alias("v"))


# fields in degrees, chips of 14.5 km in UTM zone 23 south; boxes become four corners, and two convex shapes are apart if a side of one has the other beyond it
J17 = """&ell as (select e2, e2 / (1 - e2) as ep from (select (1 / 298.257223563::double) * (2 - 1 / 298.257223563::double) as e2)),
g as (select field_id, unnest([0, 1, 2, 3]) as k, unnest([x0, x1, x1, x0]) / 20000.0::double - 47 as lon, unnest([y0, y0, y1, y1]) / 20000.0::double - 12 as lat from fields),
p as (select field_id, k, {x} as x, {y} as y from g, ell),
c as (select chip_id, 280000 + x0 // 2560 * 14500.0::double as x0, 8672000 + y0 // 2560 * 14500.0::double as y0, 280000 + x1 // 2560 * 14500.0::double as x1, 8672000 + y1 // 2560 * 14500.0::double as y1 from chips),
b as (select field_id, min(x) as lx, min(y) as ly, max(x) as hx, max(y) as hy from p group by 1),
n as (select field_id, c.* from b join c on lx <= x1 and x0 <= hx and ly <= y1 and y0 <= hy),
s as (select n.field_id, n.chip_id, max(case when greatest((v.x - u.x) * (y0 - u.y) - (v.y - u.y) * (x0 - u.x), (v.x - u.x) * (y0 - u.y) - (v.y - u.y) * (x1 - u.x), (v.x - u.x) * (y1 - u.y) - (v.y - u.y) * (x0 - u.x), (v.x - u.x) * (y1 - u.y) - (v.y - u.y) * (x1 - u.x)) < 0 then 1 else 0 end) as apart
  from n join p u on u.field_id = n.field_id join p v on v.field_id = n.field_id and v.k = (u.k + 1) % 4 group by 1, 2),
a as (select u.field_id, abs(sum(u.x * v.y - v.x * u.y)) / 2 as area from p u join p v on v.field_id = u.field_id and v.k = (u.k + 1) % 4 group by 1)
select field_id, chip_id, round(area / 10000, 3) as hectares from s join a using (field_id) where apart = 0"""


@query("j17_projected_fields", sql("fields chips", J17.format(x=UTM_X.format(lon="lon", lat="lat"), y=UTM_Y.format(lon="lon", lat="lat"))))
def j17_projected(spark, d):
    degrees = F.transform(G.box_ring(*G.box()), lambda p: F.struct((p["x"] / 20000.0 - 47).alias("x"), (p["y"] / 20000.0 - 12).alias("y")))
    f = fields(spark, d).select("field_id", degrees.alias("ring"))
    side = lambda c, at: f"{at} + {c} div 2560 * 14500.0D as {c}"
    c = chips(spark, d).selectExpr("chip_id", side("x0", 280000), side("y0", 8672000), side("x1", 280000), side("y1", 8672000), "'EPSG:32723' as crs")
    met = joins.fields_in_chips(f, c, "EPSG:4326", 0.05)
    return met.select("field_id", "chip_id", F.round(G.ring_area(F.col("ring")) / 10000, 3).alias("hectares"))
