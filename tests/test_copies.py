"""Sets of shapes with copies: each different shape meets the others once, results are those of the literal pairs."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fieldloom.functions import expressions as X
from fieldloom.functions import geometry as G
from fieldloom.operators import agreement as A
from fieldloom.operators import joins, raster

BOXES = "id bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint"
RINGS = "id bigint, ring array<struct<x:double,y:double>>"


def boxes(seed, n):
    r = random.Random(seed)
    forms = [(x, y, x + r.randint(20, 60), y + r.randint(20, 60)) for x, y in ((r.randint(0, 60), r.randint(0, 60)) for _ in range(5))]
    return [(k, *r.choice(forms)) for k in range(n)]


def ring(x0, y0, x1, y1):
    return [{"x": float(x), "y": float(y)} for x, y in ((x0, y0), (x1, y0), (x0 + 1, y1), (x0, y0))]


def test_halves_go_to_the_even_digit(spark):
    sizes = [1152, 1157, 1029, 5 * 1024 + 128, 1048576 + 131072, 7]
    got = [r.s for r in spark.createDataFrame([(n,) for n in sizes], "n bigint").select(X.human_bytes(F.col("n")).alias("s")).collect()]
    assert got == [f"{n / 1024:.2f} KB" if 1024 <= n < 1048576 else f"{n / 1048576:.2f} MB" if n >= 1048576 else f"{n:.2f} B" for n in sizes]


def test_boxes_with_copies(spark):
    # 70 copies of a form go beyond one row of keys
    a, b = boxes(1, 200) + [(500 + k, 0, 0, 30, 30) for k in range(70)], boxes(2, 150) + [(900 + k, 5, 5, 35, 35) for k in range(70)]
    left, right = spark.createDataFrame(a, BOXES), spark.createDataFrame(b, BOXES)

    def shared(p, q):
        return max(0, min(p[3], q[3]) - max(p[1], q[1])) * max(0, min(p[4], q[4]) - max(p[2], q[2]))

    size = lambda p: (p[3] - p[1]) * (p[4] - p[2])
    touch = [(p, q, shared(p, q)) for p in a for q in b if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]]
    pairs = A.pair_measures(left, right, 16)
    assert sorted((r.l_id, r.r_id, r.shared_area) for r in pairs.collect()) == sorted((p[0], q[0], s) for p, q, s in touch)
    best, match = {}, {}
    for p, q, s in touch:
        iou = s / (size(p) + size(q) - s)
        if iou > 0:
            best[p[0]] = min(best.get(p[0], (0.0, 0)), (-iou, q[0]))
        if iou > 0.5:
            match[p[0]] = min(match.get(p[0], q[0]), q[0])
    assert sorted((r.l_id, -r.iou, r.r_id) for r in A.best_boxes(left, right, 16).collect()) == sorted((k, *v) for k, v in best.items())
    assert {r.l_id: r.r_id for r in A.box_matches(left, right, 16).collect()} == match
    assert A.pair_counts(left, right, 16).agg(F.sum("n")).first()[0] == len(touch)
    assert A.pair_counts(left, right, 16).count() <= 6 * 6
    areas = A.pair_counts(left, right, 16).groupBy("shared_area").agg(F.sum("n").alias("n"))
    assert A.quantiles(areas, "shared_area", [0.1, 0.5], weight="n").first() == A.quantiles(pairs, "shared_area", [0.1, 0.5]).first()


def _steps(df):
    """Names of the plan's steps, the last one first, and the whole line of each."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        df.sparkSession.conf.unset("spark.sql.adaptive.enabled")
    return [line.lstrip(" :+-*()0123456789") for line in lines]


def test_label_measures_are_rounded_once_for_all_copies(spark, data):
    steps = _steps(entry.queries()["j9_label_measures"](spark, data))
    told_apart = max(k for k, line in enumerate(steps) if line.startswith("Generate explode(l_ids"))
    assert all(k > told_apart for k, line in enumerate(steps) if "round(" in line) and any("round(" in line for line in steps)
    # no side is held whole, and what is met goes on pair by pair
    assert any(line.startswith("SortMergeJoin") for line in steps) and not any(line.startswith("Broadcast") for line in steps)
    assert steps[told_apart + 1].startswith("Coalesce")


def test_overlay_areas_are_measured_before_copies_are_told_apart(spark, data):
    steps = _steps(entry.queries()["e3_overlay_areas"](spark, data))
    told_apart = max(k for k, line in enumerate(steps) if line.startswith("Generate explode(l_ids"))
    # only columns that are shown go through it
    assert "symdiff_area" in steps[told_apart] and "iou" not in steps[told_apart]
    assert any(line.startswith("SortMergeJoin") for line in steps) and not any(line.startswith("Broadcast") for line in steps)


def test_shape_measures_are_rounded_once_for_all_copies(spark, data):
    steps = _steps(entry.queries()["j9_shape_measures"](spark, data))
    told_apart = max(k for k, line in enumerate(steps) if line.startswith("Generate explode(l_ids"))
    assert all(k > told_apart for k, line in enumerate(steps) if "round(" in line) and any("round(" in line for line in steps)
    # middles, which it does not show, are not worked out
    assert not any("_mid" in line or "centroid" in line for line in steps)


def test_rings_are_gathered_by_their_text(spark):
    forms = [ring(0, 0, 5, 5), ring(0, 0, 5, 5 + 2**-50), ring(0, 0, 5, 1e17), ring(0, 0, 5, 1e17 + 16), None]
    rows = [(10 * k + m, forms[m]) for k in range(70) for m in range(len(forms))]
    got = joins.gathered(spark.createDataFrame(rows, RINGS), ["ring"], "id", "ids")
    assert got.columns == ["ring", "ids"] and max(len(r.ids) for r in got.collect()) == 64
    key = lambda r: None if r is None else tuple((p["x"], p["y"]) for p in r)
    assert sorted((i, key(r.ring)) for r in got.collect() for i in r.ids) == sorted((i, key(r)) for i, r in rows)
    assert got.count() == 10
    # arrays of numbers would be made normal for each comparison
    assert not any("transform(" in line for line in _steps(got) if line.startswith("Sort"))


def test_rounded_is_round(spark):
    rng = np.random.default_rng(7)
    some = [*(rng.random(2000) * 10.0 ** rng.integers(-9, 12, 2000)), *(rng.integers(0, 10**7, 2000) / 2e6), *((rng.integers(0, 10**9, 2000) + 0.5) / 1e6), 0.0, 1e-300, 1e300, 0.0000125, 2.5e-7, 5e-7]
    values = [float(v) for v in (*some, *(-v for v in some))] + [float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (2, 6):
        assert df.filter(~X.rounded(F.col("v"), digits).eqNullSafe(F.round("v", digits))).count() == 0


def test_rings_with_copies(spark):
    a = [(b[0], ring(*b[1:])) for b in boxes(3, 60)]
    b = [(b[0], ring(*(v + 3 for v in b[1:]))) for b in boxes(4, 50) + boxes(3, 60)]
    b = [(k, r) for k, (_, r) in enumerate(b)]
    left, right = spark.createDataFrame(a, RINGS), spark.createDataFrame(b, RINGS)
    pairs = A.ring_measures(left, right, 16).withColumn("iou", F.round("iou", 6)).cache()
    met = left.crossJoin(right.select(F.col("id").alias("r"), F.col("ring").alias("s"))).filter(G.rings_touch(F.col("ring"), F.col("s")))
    assert sorted((r.l_id, r.r_id) for r in pairs.collect()) == sorted((r.id, r.r) for r in met.collect())
    plain = A.best_overlap(pairs.filter("shared_area > 0.001")).select("l_id", "r_id", "iou")
    assert sorted(A.best_rings(left, right, 16, 0.001).collect()) == sorted(plain.collect())
    assert sorted(A.ring_matches(left, right, 16).collect()) == sorted(A.matches(pairs, 0.5).select("l_id", "r_id", "iou").collect())


def test_rings_meet_in_blocks(spark, monkeypatch):
    a, b = ([(k, ring(*form[1:])) for k, form in enumerate(boxes(seed, 40))] for seed in (21, 22))
    b += [(40 + k, ring(x, 0, x + 9, 7)) for k, x in enumerate(range(0, 130, 10))]
    # its right corner is a corner of the first
    x, y = (int(a[0][1][0][k]) for k in "xy")
    b.append((90, ring(x - 9, y, x, y + 7)))
    left, right = spark.createDataFrame(a, RINGS), spark.createDataFrame(b, RINGS)
    points = lambda r: np.array([(p["x"], p["y"]) for p in r])
    shared = {(k, m): G.shared_area(points(p), points(q)) for k, p in a for m, q in b}
    met = left.crossJoin(right.select(F.col("id").alias("r"), F.col("ring").alias("s"))).filter(G.rings_touch(F.col("ring"), F.col("s")))
    touch = sorted((r.id, r.r) for r in met.collect())
    found = lambda df: sorted((r.l_id, r.r_id, round(r.shared_area, 6)) for r in df.collect())
    # all in one bin: one row has them all
    forms = A._ring_forms(left, right)
    assert A.block_pairs(*forms, 1000).count() == 1
    monkeypatch.setattr(A, "POINTS", 16)
    assert A.block_pairs(*forms, 1000).count() > 8
    for cell in (1000, 32):
        assert found(A.ring_measures(left, right, cell)) == [(*k, round(shared[k], 6)) for k in touch]
        assert found(A.ring_measures(left, right, cell, 0.001)) == [(*k, round(v, 6)) for k, v in sorted(shared.items()) if v > 0.001]
    assert any(shared[k] < 1e-9 for k in touch)


def test_points_with_copies(spark):
    b = boxes(5, 40)
    points = [(k, (k * 7) % 50 + 0.25, (k * 3) % 50 + 0.5, k) for k in range(400)]
    fields, p = spark.createDataFrame([(x[0], ring(*x[1:])) for x in b], RINGS), spark.createDataFrame(points, "p bigint, x double, y double, v bigint")
    literal = p.crossJoin(fields).filter(G.point_in_ring(F.col("x"), F.col("y"), F.col("ring")))
    want = sorted((r.p, r.id) for r in literal.collect())
    assert sorted((r.p, r.id) for r in joins.points_in_rings(p, fields, 16).collect()) == want
    totals = joins.ring_totals(p, fields, "id", 16, "v")
    assert sorted(totals.collect()) == sorted(literal.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total")).collect())
    parts = fields.select("ring", F.array("ring").alias("holes"))
    assert joins.points_in_parts(p, parts, 16).count() == 0
    assert joins.points_in_parts(p, fields.withColumn("holes", F.array().cast("array<array<struct<x:double,y:double>>>")), 16).count() == len({k for k, _ in want})
    zones = spark.createDataFrame(b, "id bigint, z_x0 bigint, z_y0 bigint, z_x1 bigint, z_y1 bigint")
    assert sorted(joins.zonal_totals(p, zones, "id", 16, "v").collect()) == sorted(joins.zonal(p, zones, 16).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total")).collect())
    outside = A.points_to_fields(p.select(F.col("p").alias("id"), F.col("x").cast("bigint"), F.col("y").cast("bigint")), spark.createDataFrame(b, BOXES), 16)
    least = {}
    for k, x, y, _ in points:
        held = [q[0] for q in b if q[1] <= int(x) <= q[3] and q[2] <= int(y) <= q[4]]
        for f in held or [None]:
            least[f] = min(least.get(f, k), k)
    assert {r.field_id: r.point_id for r in outside.collect()} == least


def test_masks_with_copies(spark):
    r = random.Random(12)
    forms = [[{"x": float(x), "y": float(y)} for x, y in ((a, b), (a + w, b + 1), (a + w // 2, b + h), (a, b))] for a, b, w, h in ((r.randint(-5, 30), r.randint(-5, 30), r.randint(4, 15), r.randint(4, 15)) for _ in range(7))]
    fields = spark.createDataFrame([(k % 2, k + 1, forms[r.randrange(7)]) for k in range(60)] + [(0, 99, None)], "chip int, instance int, ring array<struct<x:double,y:double>>")
    pixels = spark.createDataFrame([(chip, y, x, x * 2 + 0.25, y * 2 + 0.5) for chip in range(3) for y in range(18) for x in range(18)], "chip int, r int, c int, x double, y double")
    pairs = pixels.join(fields.filter("ring is not null"), "chip")
    inside, away = G.point_in_ring(F.col("x"), F.col("y"), F.col("ring")), G.distance_to_ring(F.col("x"), F.col("y"), F.col("ring"))
    top, edge = {}, set()
    for p in pairs.select("chip", "r", "c", "instance", inside.alias("i"), (F.round(away, 6) <= 1.5).alias("n")).collect():
        if p.i:
            top[p.chip, p.r, p.c] = max(top.get((p.chip, p.r, p.c), 0), p.instance)
        if p.n:
            edge.add((p.chip, p.r, p.c))
    every = [(k, y, x) for k in range(3) for y in range(18) for x in range(18)]
    found = lambda df: sorted(map(tuple, df.collect()))
    assert found(raster.rasterize_rings(pixels, fields, 8)) == [(*k, top.get(k, 0)) for k in every]
    assert found(raster.ribbon(pixels, fields, 8, 1.5)) == sorted(edge)
    assert found(raster.three_class_mask(pixels, fields, 8, 1.5)) == [(*k, 2 if k in edge else int(k in top)) for k in every]
    assert found(raster.three_class_mask(pixels, fields, 8, 1.5, inner_first=True)) == [(*k, 1 if k in top else 2 * (k in edge)) for k in every]
    # pixels meet a form once, whoever has it
    met = raster._places(pixels, fields, 8, 1.5)
    assert "max(instance" in met._jdf.queryExecution().optimizedPlan().toString() and top and edge - set(top)


def test_rings_meet_as_they_touch(spark):
    r = random.Random(13)

    def shape():
        x, y = r.randint(0, 12), r.randint(0, 12)
        return ring(x, y, x + r.randint(1, 6), y + r.randint(1, 6))

    rows = [(k, shape(), shape()) for k in range(300)] + [(900, None, shape()), (901, shape(), None)]
    df = spark.createDataFrame(rows, "id int, l_ring array<struct<x:double,y:double>>, r_ring array<struct<x:double,y:double>>")
    got = df.select("id", F.coalesce(G.rings_touch(F.col("l_ring"), F.col("r_ring")), F.lit(False)).alias("t"), G.rings_meet(F.col("l_ring"), F.col("r_ring")).alias("m"), G.polygon_shared_area(F.col("l_ring"), F.col("r_ring")).alias("a")).collect()
    assert all(x.t == x.m and (x.m or x.a < 1e-9) for x in got) and len({x.m for x in got}) == 2
    pairs = joins.ring_join(df.select("id", "l_ring"), df.select(F.col("id").alias("other"), "r_ring"), 4)
    assert "arrow" in pairs._jdf.queryExecution().toString().lower()
