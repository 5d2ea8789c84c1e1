"""Operators against literal loops and hand-made edge cases."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldloom.functions import expressions as X
from fieldloom.functions import geometry as G
from fieldloom.operators import agreement, grid, joins, ledger, manifest, merge, metrics, raster, scenes, score
from fieldloom.sources import files, synthetic, tiff, vector
from fieldloom.streaming import chips as stream

LADDER = [1, 2, 5, 10, 20]


def make_scenes(rng, tiles=25):
    out, k = [], 0
    for tile in range(tiles):
        for _ in range(rng.randint(0, 14)):
            k += 1
            out.append((tile, k, dt.datetime(2021, 1, 1) + dt.timedelta(days=rng.randint(0, 250), seconds=rng.choice([0, 1, 86399])), rng.choice([None, 0, 1, 3, 5, 12, 19, 20, 30])))
    return out + [(None, 9999, dt.datetime(2021, 1, 1), 0)]


def literal_pair(items, months, ladder):
    need = round(30 * months)
    items = sorted(items, key=lambda s: (s[2], s[1]))
    cloud = lambda s: 100 if s[3] is None else s[3]
    for th in ladder:
        best = None
        for a in items:
            inner = None
            for b in items:
                if b[2] >= a[2] and (b[2] - a[2]).days >= need and cloud(a) < th and cloud(b) < th:
                    if inner is None or (cloud(b), b[2], b[1]) < (cloud(inner), inner[2], inner[1]):
                        inner = b
            if inner:
                gap = (inner[2] - a[2]).days
                k = (cloud(a) + cloud(inner), -gap, a[2], a[1])
                if best is None or k < best[0]:
                    best = (k, (float(th), a[1], inner[1], k[0], gap))
        if best:
            return best[1]
    return None


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_best_pair_is_the_loop(spark, seed):
    rows = make_scenes(random.Random(seed))
    df = spark.createDataFrame(rows, "tile int, scene_id int, ts timestamp_ntz, cloud int")
    got = {r.tile: (r.rung, r.s1, r.s2, r.cloud_sum, r.gap_days) for r in scenes.best_pair(df, 2, LADDER).collect()}
    want = {t: p for t in range(25) if (p := literal_pair([r for r in rows if r[0] == t], 2, LADDER))}
    assert got == want


def literal_two_pairs(items, clouds, gaps):
    """Rung by rung: scenes of that cloud or less, all pairs in order, the first two that are far enough apart."""
    for cloud, gap in zip(clouds, gaps, strict=True):
        fit = sorted((s for s in items if s[3] <= cloud), key=lambda s: (s[2], s[1]))
        pairs = []
        for i in range(len(fit)):
            for j in range(i + 1, len(fit)):
                if abs((fit[j][2] - fit[i][2]).days) >= gap * 30:
                    pairs.append((float(cloud), fit[i][1], fit[j][1]))
                    if len(pairs) == 2:
                        return dict(enumerate(pairs, 1))
    return None


@pytest.mark.parametrize("gaps", [[2, 2, 2, 2, 2], [6, 5, 4, 3, 1], [0, 0, 0, 0, 0], [1, 2, 3, 4, 5]])
def test_first_two_pairs_is_the_loop(spark, gaps):
    rows = [(t, k, ts, 0 if c is None else c) for t, k, ts, c in make_scenes(random.Random(9)) if t is not None]
    got = {}
    for r in scenes.first_two_pairs(spark.createDataFrame(rows, "tile int, scene_id int, ts timestamp_ntz, cloud int"), list(zip(LADDER, gaps, strict=True))).collect():
        got.setdefault(r.tile, {})[r.n] = (r.rung, r.s1, r.s2)
    want = {t: p for t in range(25) if (p := literal_two_pairs([r for r in rows if r[0] == t], LADDER, gaps))}
    assert got == want and len(want) > 5


def test_a_cloud_equal_to_the_rung_is_in(spark):
    rows = [(1, k, dt.datetime(2021, 1, 1) + dt.timedelta(days=91 * k), 1.0) for k in range(3)]
    got = scenes.first_two_pairs(spark.createDataFrame(rows, "tile int, scene_id int, ts timestamp_ntz, cloud double"), [(1, 3)])
    assert sorted((r.n, r.s1, r.s2) for r in got.collect()) == [(1, 0, 1), (2, 0, 2)]


def test_the_target_day_is_reached_in_seconds(spark):
    at = dt.datetime(2021, 1, 1) + dt.timedelta(days=99 + 45)
    rows = [(1, 1, at - dt.timedelta(hours=66), 0.0, 100, 2021), (1, 2, at + dt.timedelta(hours=71), 0.0, 100, 2021), (2, 3, at - dt.timedelta(hours=66), 0.011, 100, 2021), (2, 4, at + dt.timedelta(hours=71), 0.01, 100, 2021)]
    df = spark.createDataFrame(rows, "chip int, scene_id int, ts timestamp_ntz, cloud_fraction double, doy int, year int")
    assert sorted(tuple(r) for r in scenes.tiers(df, False).collect()) == [(1, 1, 1), (2, 4, 1)]
    assert sorted(tuple(r) for r in scenes.tiers(df, False, target_cloud=0.02).collect()) == [(1, 1, 1), (2, 3, 1)]


def test_class_weights_are_of_the_classes_present(spark):
    df = spark.createDataFrame([(0,)] * 300 + [(1,)] * 100 + [(7,)] * 50 + [(-100,)] * 9, "t int")
    assert {r.cls: round(r.weight, 9) for r in metrics.class_weights(df, "t", 3, ignore=-100).collect()} == {0: 0.25, 1: 0.75, 2: 1e-5}
    assert {r.cls: round(r.weight, 9) for r in metrics.class_weights(df, "t", 3, ignore=0).collect()} == {0: 1e-5, 1: 1.0, 2: 1e-5}
    assert {r.weight for r in metrics.class_weights(df.filter("t < 0"), "t", 3, ignore=-100).collect()} == {1e-5}


def test_least_confident_with_agriculture(spark):
    rows = [(1, 5.0, 9.0, 0.5), (2, 1.0, float("nan"), 0.3), (3, 2.0, 20.0, 0.2), (4, 0.5, 1.0, 0.19)]
    s = spark.createDataFrame(rows, "chip int, confidence_mean double, confidence_mean_ag double, lc_ag_frac double")
    assert [r.chip for r in score.least_confident(s, 2, "chip", least_ag=0.2).collect()] == [2, 3]


def test_score_lines_are_python_s(spark):
    rows = [(1, 'a"b\\', 0.5, None), (2, None, float("nan"), float("inf")), (3, "é", 1e-7, -2.0)]
    got = [r.line for r in score.score_lines(spark.createDataFrame(rows, "id int, name string, a double, b double"), "id", "name", "a", "b").collect()]
    assert [repr(json.loads(x)) for x in got] == [repr(dict(zip(("id", "name", "a", "b"), r, strict=True))) for r in rows]


def test_best_window_is_the_loop(spark):
    rng = np.random.default_rng(4)
    px, want = [], {}
    for chip in range(4):
        m = rng.random((14, 17)) < 0.3
        px += [(chip, r, c, int(m[r, c])) for r in range(14) for c in range(17)]
        want[chip] = min((int(m[r : r + 6, c : c + 7].sum()), r, c) for r in range(9) for c in range(11))
    df = spark.createDataFrame(px, "chip int, r int, c int, bad int")
    assert {r.chip: (r.bad, r.r, r.c) for r in raster.best_window(df, 6, 7).collect()} == want


def test_box_join_counts_each_pair_once(spark):
    rng = random.Random(3)
    box = lambda k: (k, x := rng.randint(-50, 300), y := rng.randint(-50, 300), x + rng.randint(0, 120), y + rng.randint(0, 120))  # noqa: E731, F821
    a = [box(i) for i in range(80)] + [(900, 0, 0, 90, 90), (901, -10, -10, 400, 400)]
    b = [box(i) for i in range(80)] + [(900, 90, 90, 100, 100), (901, 90, 0, 95, 30)]
    la = spark.createDataFrame(a, "a int, l_x0 int, l_y0 int, l_x1 int, l_y1 int")
    rb = spark.createDataFrame(b, "b int, r_x0 int, r_y0 int, r_x1 int, r_y1 int")
    got = sorted((r.a, r.b) for r in joins.box_join(la, rb, 30).collect())
    assert got == sorted((p[0], q[0]) for p in a for q in b if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4])
    assert (900, 900) in got and (900, 901) in got  # a corner and an edge touch


def test_union_area_counts_overlaps_once(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for k in range(6):
        seen = np.zeros((60, 60), dtype=bool)
        for _ in range(rng.randint(1, 9)):
            x, y = rng.randint(0, 40), rng.randint(0, 40)
            w, h = rng.randint(1, 20), rng.randint(1, 20)
            rows.append((k, x, y, x + w, y + h))
            seen[x : x + w, y : y + h] = True
        want[k] = int(seen.sum())
    df = spark.createDataFrame(rows, "k int, x0 int, y0 int, x1 int, y1 int")
    assert {r.k: r.cov_area for r in grid.union_area(df, "k").collect()} == want


def test_split_hash(spark):
    df = spark.createDataFrame([("chip_1",)], "id string")
    salt = "s"
    want = int(hashlib.sha1(f"{salt}::chip_1".encode()).hexdigest()[:8], 16) / 16**8
    assert df.select(X.split_fraction(F.col("id"), salt)).first()[0] == want
    with pytest.raises(ValueError):
        X.split_name(F.col("id"), salt, 0.5, 0.2, 0.2)


def test_names(spark):
    rows = ["", None, "7", "a1", "-12x", "--", "é9"]
    got = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "i int, v string").orderBy("i").select(X.chip_name(F.col("v"))).collect()]
    assert got == ["chip_unknown", "chip_unknown", "chip_7", "a1", "chip_12", "chip_0", "é9"]
    stems = spark.createDataFrame([("a\\b\\c.TIF",), ("x/y.tiff",), ("z",)], "p string").select(X.stem(F.col("p"))).collect()
    assert [r[0] for r in stems] == ["c", "y", "z"]


@pytest.mark.parametrize("columns,want", [(["chip_id", "x"], "chip_id"), (["CHIP_ID"], "CHIP_ID"), (["cell_id"], "cell_id"), (["cellid"], "cellid"), (["ChipId"], "ChipId"), (["a"], None), ([], None)])
def test_id_column(columns, want):
    assert X.resolve_id_column(columns) == want
    assert X.resolve_id_column([*columns, "Mine"], "mine") == "Mine"


def test_days_and_windows(spark):
    df = spark.range(1)
    day = lambda y, n: df.select(X.doy_to_date(F.lit(y), F.lit(n))).first()[0]
    assert [day(2023, n) for n in (0, 1, 365, 366)] == [dt.date(2023, 1, 1), dt.date(2023, 1, 1), dt.date(2023, 12, 31), dt.date(2024, 1, 1)]
    assert day(2024, 366) == dt.date(2024, 12, 31)
    t = spark.createDataFrame([(dt.datetime(2021, 1, 2, 23), dt.datetime(2021, 1, 3, 22, 59, 59))], "a timestamp_ntz, b timestamp_ntz")
    assert t.select(X.floor_days(F.col("b"), F.col("a")), X.floor_days(F.col("a"), F.col("b"))).first() == (0, -1)
    w = spark.createDataFrame([(dt.date(2021, 11, 1), dt.date(2021, 2, 1)), (None, dt.date(2021, 2, 1)), (dt.date(2021, 1, 3), dt.date(2021, 12, 30))], "s date, e date")
    got = [r.w.asDict() for r in w.select(X.season_window(F.col("s"), F.col("e"), F.lit(2021), 10).alias("w")).collect()]
    full = (dt.date(2021, 1, 1), dt.date(2021, 12, 31))
    assert [(g["start"], g["end"], g["known"]) for g in got] == [(*full, False), (*full, False), (*full, True)]


def test_quartiles_are_interpolated(spark):
    v = [1, 2, 2, 2, 3, 4, 5, 6, 7, 50]
    got = agreement.quartiles(spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)], "i int, v double"), "v").orderBy("i").collect()
    assert [r.quartile for r in got] == [0, 0, 0, 0, 1, 2, 2, 3, 3, 3] == pd.qcut(pd.Series(v), 4, labels=False).tolist()


def test_mode_and_iou_edges(spark):
    px = spark.createDataFrame([(1, v) for v in (3, 3, 1, 1, 7, 0, 0, 0)], "z int, v int")
    assert score.zonal_mode(px, "z", "v").first().mode == 1
    half = spark.createDataFrame([(1, 1, 0.5), (2, 1, 0.51)], "l_id int, r_id int, iou double")
    assert [r.l_id for r in agreement.matches(half, 0.5).collect()] == [2]
    with pytest.raises(ValueError):
        agreement.matches(half, 0.4)


def test_chip_without_fields(spark):
    chips = grid.fishnet(spark, 0, 0, 30, 20, 10)
    fields = spark.createDataFrame([(1, 1, 1, 3, 3), (2, 2, 2, 4, 29)], "field_id int, x0 int, y0 int, x1 int, y1 int")
    got = {r.aoi_id: (r.n_fields, r.has_fields, r.parts) for r in manifest.manifest(chips, fields, 10, "s", (0.8, 0.1, 0.1)).collect()}
    assert len(got) == 6 and got[0][0] == 2 and [p.field_id for p in got[0][2]] == [1, 2] and got[5] == (0, False, None)
    manifest.check_manifest(manifest.manifest(chips, fields, 10, "s", (0.8, 0.1, 0.1)))
    with pytest.raises(ValueError):
        manifest.check_manifest(chips.withColumnRenamed("chip_id", "aoi_id"))


def test_polygon_overlay(spark):
    rng = np.random.default_rng(2)
    for _ in range(12):
        a = np.sort(rng.random(9) * 2 * np.pi)
        p = np.c_[np.cos(a), np.sin(a)] * rng.uniform(0.3, 1, 9)[:, None]
        b = np.sort(rng.random(7) * 2 * np.pi)
        q = np.c_[np.cos(b), np.sin(b)] * rng.uniform(0.3, 1, 7)[:, None] + 0.3
        xs = (np.arange(500) + 0.5) / 500 * 3 - 1.5
        gx, gy = np.meshgrid(xs, xs)

        def inside(poly):
            r = np.roll(poly, -1, axis=0)
            hit = np.zeros(gx.shape, dtype=int)
            for (x1, y1), (x2, y2) in zip(poly, r, strict=True):
                cross = (y1 > gy) != (y2 > gy)
                hit += cross & (gx < (x2 - x1) * (gy - y1) / np.where(y2 == y1, 1, y2 - y1) + x1)
            return hit % 2 == 1

        want = (inside(p) & inside(q)).sum() * (3 / 500) ** 2
        assert abs(G.shared_area(p, q) - want) < 0.01


def test_geometry_numbers(spark):
    sq = [{"x": 0.0, "y": 0.0}, {"x": 4.0, "y": 0.0}, {"x": 4.0, "y": 2.0}, {"x": 0.0, "y": 2.0}, {"x": 0.0, "y": 0.0}]
    far = [{"x": p["x"] + 3, "y": p["y"]} for p in sq]
    df = spark.createDataFrame([(sq, far)], "a array<struct<x: double, y: double>>, b array<struct<x: double, y: double>>")
    r = df.select(
        G.ring_area(F.col("a")), G.ring_length(F.col("a")), G.hausdorff("a", "b"), G.polygon_shared_area("a", "b"), G.orientation("a"),
        G.point_in_ring(F.lit(1.0), F.lit(1.0), F.col("a")), G.point_in_ring(F.lit(5.0), F.lit(1.0), F.col("a")), G.distance_to_ring(F.lit(5.0), F.lit(1.0), F.col("a")),
    ).first()
    assert r[0] == 8 and r[1] == 12 and r[2] == 3 and r[3] == pytest.approx(2) and r[4] == pytest.approx(math.atan2(2, 4)) and r[5] and not r[6] and r[7] == 1
    bent = [(p["x"], p["y"]) for p in sq]
    assert len(G.simplify_points(np.array([*bent[:2], (4.0, 1.0), *bent[2:]]), 0.1)) == 5
    eq = df.select(G.utm(F.lit(-45.0), F.lit(0.0), F.lit(23)).alias("p")).first().p
    assert eq.x == pytest.approx(500000) and eq.y == pytest.approx(0)


def test_raster_arrays():
    v = np.arange(12.0).reshape(3, 4)
    assert np.allclose(raster.bilinear(v, 3, 4), v) and np.allclose(raster.bilinear(v, 5, 7)[::2, ::2], v)
    gap = v.copy()
    gap[1, 1] = -1
    assert raster.fill_gaps(gap, gap == -1)[1, 1] == pytest.approx(5)
    assert (raster.fill_gaps(np.full((2, 2), 7.0), np.ones((2, 2), dtype=bool)) == 7).all()
    assert raster.regions(np.array([[1, 1, 0], [0, 1, 0], [1, 0, 1]])).tolist() == [[1, 1, 2], [3, 1, 2], [4, 5, 6]]
    assert raster.farthest_points(np.array([[0, 0], [1, 0], [9, 0], [4, 0]]), 3) == [0, 2, 3]


def test_uint16_rules(spark):
    one = lambda kind, lo, hi, doc=False: spark.range(1).select(X.uint16_action(F.lit(kind), F.lit(lo), F.lit(hi), doc)).first()[0]
    assert [one("uint16", 0, 9), one("float32", 0.0, 1.0), one("float32", -1e-7, 1.0), one("int32", -5, 9), one("float32", 0.0, 1.0, True)] == ["skip", "cast", "scale", "clip", "scale"]
    vals = spark.createDataFrame([(float("nan"),), (float("inf"),), (-3.0,), (7.9,), (70000.0,)], "v double")
    assert [r[0] for r in vals.select(raster.to_uint16(F.col("v"), F.lit("clip"))).collect()] == [0, 65535, 0, 7, 65535]


def test_merge_of_weights(spark):
    w = lambda v, b: [("w", i, float(v)) for i in range(16)] + [("b", i, float(b)) for i in range(4)]
    base = spark.createDataFrame(w(0, 0), "key string, idx int, v double")
    tuned = spark.createDataFrame([(1, *r) for r in w(2, 1)] + [(2, *r) for r in w(-3, 0.5)], "ckpt int, key string, idx int, v double")
    t = merge.task_vectors(base, tuned)
    of = lambda df: {r.key: r.v for r in df.collect()}
    assert of(merge.magnitude_max(t)) == {"w": -3, "b": 1}
    assert of(merge.apply(base, merge.magnitude_max(t), 0.5))["w"] == -1.5 and of(merge.total(t))["w"] == -1
    tie = spark.createDataFrame([(1, "w", 0, 2.0), (2, "w", 0, -2.0)], "ckpt int, key string, idx int, v double")
    assert of(merge.magnitude_max(tie)) == {"w": 2}
    kinds = spark.createDataFrame([("a", "4", "float32"), ("n", "1", "int64")], "key string, shape string, kind string")
    assert [r.key for r in merge.mergeable(kinds, kinds).collect()] == ["a"]


def test_edge_weights_match_reflected_blur(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 3, (9, 8))
    px = [(0, r, c, int(y[r, c])) for r in range(9) for c in range(8)]
    got = metrics.edge_weights(spark.createDataFrame(px, "chip int, r int, c int, y int"), 9, 8, 4.0).collect()
    padded = np.pad((y == 2).astype(float), 3, mode="reflect")
    kernel = np.zeros((7, 7))
    for i, j, k in metrics.gaussian_kernel():
        kernel[i + 3, j + 3] = k
    for r in got:
        assert r.weight == pytest.approx(1 + 4 * (padded[r.r : r.r + 7, r.c : r.c + 7] * kernel).sum())


def test_ledger_and_checksums(spark):
    listed = ledger.checksum_lines(spark.createDataFrame([(hashlib.md5(b"x").hexdigest() + "  a b.txt",), ("nonsense",), ("0" * 32 + " gone",)], "value string"))
    ok = ledger.checksums_ok(listed, spark.createDataFrame([("a b.txt", bytearray(b"x"))], "path string, content binary")).collect()
    assert {r.path: r.ok for r in ok} == {"a b.txt": True, "gone": False}


def test_sources_round_trip(spark, tmp_path):
    doc = '{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"id": 3, "Shape_Area": 1.5}, "geometry": {"type": "Polygon", "coordinates": [[[0,0],[2,0],[2,1],[0,1],[0,0]]]}}, {"type": "Feature", "properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[5,5],[6,5],[6,6],[5,5]]],[[[7,7],[8,7],[8,8],[7,7]]]]}}, {"type": "Feature", "properties": {}, "geometry": null}, {"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [1,2]}}]}'
    (tmp_path / "f.geojson").write_text(doc)
    got = vector.read_geojson(spark, str(tmp_path / "f.geojson")).orderBy("idx", "part").collect()
    assert [(r.idx, r.part, r.x0, r.y1) for r in got] == [(0, 0, 0.0, 1.0), (1, 0, 5.0, 6.0), (1, 1, 7.0, 8.0)] and got[0].properties["id"] == "3"
    f = synthetic.fields(spark)
    assert f.count() == 12 and f.exceptAll(synthetic.fields(spark)).count() == 0 and f.filter("x1 - x0 between 0.002 and 0.0091").count() == 12
    vector.write_geojson(f.withColumn("ring", G.box_ring(*G.box())), str(tmp_path / "out"), ["field_id"])
    assert vector.read_lines(spark, str(tmp_path / "out")).filter("size(ring) = 5").count() == 12
    c = synthetic.chips(spark)
    enc = c.select("chip", tiff.encode_bands(16, 16)("window_a", F.lit(0.0), F.lit(0.0)).alias("content")).collect()
    for r in enc:
        (tmp_path / f"{r.chip}.tif").write_bytes(r.content)
    (tmp_path / "broken.TIF").write_bytes(b"nothing")
    assert sorted(r.name for r in files.list_rasters(spark, str(tmp_path)).collect()) == ["broken.TIF", "chip_0.tif", "chip_1.tif"]
    back = {r.path.rsplit("/", 1)[1]: r for r in tiff.read_rasters(files.read_contents(spark, str(tmp_path), "*.{tif,TIF}")).collect()}
    assert back["broken.TIF"].error and back["chip_0.tif"].n_bands == 4 and back["chip_0.tif"].step == 10.0
    assert [[int(v) for v in b] for b in back["chip_0.tif"].bands] == c.filter("chip = 'chip_0'").first().window_a


def test_stream_adds_each_chip_once(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    df = spark.createDataFrame([("a", 1), ("b", 2)], "chip string, v int")
    df.write.parquet(src)
    for _ in range(2):
        stream.ingest(stream.read_new(spark, src, "chip string, v int"), out, state).awaitTermination()
    spark.createDataFrame([("b", 9), ("c", 3)], "chip string, v int").write.mode("append").parquet(src)
    stream.ingest(stream.read_new(spark, src, "chip string, v int"), out, state).awaitTermination()
    assert sorted((r.chip, r.v) for r in spark.read.parquet(out).collect()) == [("a", 1), ("b", 2), ("c", 3)]


def test_consensus_and_scores(spark):
    px = spark.createDataFrame([(1, 10.0, 1, True), (1, 20.0, 0, False), (2, 5.0, 2, False)], "chip int, conf double, pred int, ag boolean")
    s = {r.chip: r for r in score.chip_scores(px).collect()}
    assert s[1].confidence_std == 5 and s[1].metric_all == 0 and math.isnan(s[2].confidence_mean_ag) and s[2].metric_all == -1 and s[2].metric_interiors == 0
    assert score.least_confident(score.chip_scores(px), 5, "chip", least_ag=0.2).count() == 1


def test_quantiles_are_numpy_s(spark):
    rng = random.Random(21)
    for values in ([5.0], [1.0, 2.0], [rng.gauss(0, 1) for _ in range(997)], [float(rng.randint(0, 3)) for _ in range(500)], [rng.expovariate(1e-6) for _ in range(300)] + [1e12]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,), (math.nan,)], "v double").repartition(3)
        at = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
        assert list(agreement.quantiles(df, "v", at).first()) == pytest.approx(np.quantile(values, at).tolist(), rel=1e-12)
        assert list(agreement.quantiles(df, "v", at, cells=3).first()) == pytest.approx(np.quantile(values, at).tolist(), rel=1e-12)
    assert list(agreement.quantiles(df.limit(0), "v", [0.5]).first()) == [None]


def test_rings_touch_is_a_shared_area_or_contact(spark):
    rng = random.Random(22)

    def star(cx, cy):
        n = rng.randint(3, 9)
        p = [(cx + r * math.cos(a), cy + r * math.sin(a)) for a, r in ((2 * math.pi * i / n, rng.uniform(1, 6)) for i in range(n))]
        return [*p, p[0]]

    pairs = [(star(0, 0), star(rng.uniform(-9, 9), rng.uniform(-9, 9))) for _ in range(200)]
    box = lambda a, b, c, d: [(a, b), (c, b), (c, d), (a, d), (a, b)]
    edge = [(box(0, 0, 2, 2), box(2, 0, 4, 2), True), (box(0, 0, 2, 2), box(2, 2, 3, 3), True), (box(0, 0, 9, 9), box(3, 3, 4, 4), True), (box(3, 3, 4, 4), box(0, 0, 9, 9), True), (box(0, 0, 1, 1), box(1.01, 0, 2, 1), False)]
    rows = [(i, a, b) for i, (a, b) in enumerate(pairs)] + [(1000 + i, [tuple(map(float, q)) for q in a], [tuple(map(float, q)) for q in b]) for i, (a, b, _) in enumerate(edge)]
    df = spark.createDataFrame(rows, "id int, a array<struct<x: double, y: double>>, b array<struct<x: double, y: double>>")
    got = {r.id: r.t for r in df.select("id", G.rings_touch(F.col("a"), F.col("b")).alias("t")).collect()}
    for i, (a, b) in enumerate(pairs):
        assert got[i] == (G.shared_area(np.array(a), np.array(b)) > 1e-12), i
    assert [got[1000 + i] for i in range(len(edge))] == [t for *_, t in edge]


def test_chip_names_are_not_trimmed(spark):
    given = {" abc": "chip_0", "abc ": "abc ", " 12a3": "chip_123", "": "chip_unknown", None: "chip_unknown", "Éa1": "Éa1", "  ": "chip_0"}
    got = spark.createDataFrame([(k,) for k in given], "v string").select("v", X.chip_name(F.col("v")).alias("n")).collect()
    assert {r.v: r.n for r in got} == given


def test_uint16_action_by_target(spark):
    rows = [("uint16", 0.0, 60000.0), ("uint16", 0.0, 300.0), ("int32", 5.0, 200.0), ("float32", 0.0, 1.0), ("float32", -1e-7, 1.0), ("int16", -5.0, 5.0)]
    df = spark.createDataFrame(rows, "k string, a double, b double")
    act = lambda **how: [r[0] for r in df.select(X.uint16_action(F.col("k"), F.col("a"), F.col("b"), **how)).collect()]
    assert act() == ["skip", "skip", "cast", "cast", "scale", "clip"]
    assert act(target=(0, 255)) == ["clip", "clip", "cast", "cast", "scale", "clip"]
    assert act(documented=True) == ["skip", "skip", "cast", "scale", "scale", "clip"]


def test_common_kind_is_numpy_s(spark):
    kinds = ["uint8", "int8", "uint16", "int16", "uint32", "int32", "uint64", "int64", "float16", "float32", "float64"]
    df = spark.createDataFrame([(a, b) for a in kinds for b in kinds], "a string, b string")
    assert {(r.a, r.b): r.k for r in df.select("a", "b", X.common_kind(F.col("a"), F.col("b")).alias("k")).collect()} == {(a, b): np.result_type(np.dtype(a), np.dtype(b)).name for a in kinds for b in kinds}


def test_id_set_and_window_folder(spark):
    layer = spark.createDataFrame([("a\\b/x1.TIF",), ("x2.tiff",), ("x2.tiff",), (None,)], "FileName string")
    assert {r.stem for r in manifest.id_set(layer).collect()} == {"x1", "x2"}
    assert manifest.id_set(None) is None and manifest.id_set(spark.range(2).toDF("n")) is None
    assert manifest.only_present(layer, layer.limit(0), "FileName").count() == 0 and manifest.restrict(layer, layer.limit(0), "FileName").count() == 4


@pytest.mark.parametrize("name", sorted(metrics.NAMED))
def test_named_losses_without_pixels_are_zero(spark, name):
    df = spark.createDataFrame([(1, 0, 0, c, 0.5, int(c == 1), 1) for c in range(2)], "chip int, r int, c int, cls int, p double, y int, truth int")
    got = metrics.loss(df, name, ignore=1, **({"rows": 1, "cols": 1} if name == "pixel_weighted_ce" else {})).first().loss
    assert got == pytest.approx(0.0)
    assert math.isfinite(metrics.loss(df, name, **({"rows": 1, "cols": 1} if name == "pixel_weighted_ce" else {})).first().loss)


def test_unknown_loss_is_an_error(spark):
    with pytest.raises(ValueError, match="no loss is named"):
        metrics.loss(spark.range(1), "hinge")


@pytest.mark.parametrize("kind", ["uint8", "uint16", "int16", "float32"])
@pytest.mark.parametrize("tile", [None, 16, 32])
def test_tiff_tiles_windows_and_differences(kind, tile):
    rng = np.random.default_rng(3)
    b = (rng.integers(0, 250, (3, 41, 37)) - (100 if kind == "int16" else 0)).astype(kind)
    for predictor in (1, 2) if kind != "float32" else (1,):
        blob = tiff.encode(b, 500000.0, 9000000.0, 10.0, tile, predictor, 32723, 0)
        about = tiff.info(blob)
        assert (about["width"], about["height"], about["count"], about["dtype"], about["tile"], about["epsg"], about["nodata"]) == (37, 41, 3, kind, tile, 32723, 0.0)
        assert (tiff.decode(blob)[0] == b).all()
        got, corner = tiff.decode(blob, (10, 5, 20, 100), [2, 0])
        assert (got == b[[2, 0], 10:30, 5:]).all() and corner == (500050.0, 8999900.0, 10.0)
        assert tiff.decode(blob, (41, 0, 5, 5))[0].shape == (3, 0, 5)


def test_raster_writer_skips_what_is_there(spark, tmp_path):
    rows = [("a", 2, 3, [[1.0] * 6, [2.0] * 6], 0.0, 0.0, 10.0, 32723), ("b", 2, 3, [[3.0] * 6, [4.0] * 6], 5.0, 5.0, 10.0, None)]
    df = spark.createDataFrame(rows, "name string, rows int, cols int, bands array<array<double>>, x0 double, y0 double, step double, epsg int")
    root = f"file://{tmp_path}/out"
    assert all(r.written for r in tiff.write_rasters(df, root, tile=16).collect()) and not any(r.written for r in tiff.write_rasters(df, root, tile=16).collect())
    got = {r.path.rpartition("/")[2]: r.bands for r in tiff.read_rasters(files.read_contents(spark, f"{tmp_path}/out", "*.tif"), window=(1, 1, 1, 2), bands=[1]).collect()}
    assert got == {"a.tif": [[2.0, 2.0]], "b.tif": [[4.0, 4.0]]}


def test_profiles():
    like = {"driver": "X", "dtype": "uint16", "width": 300, "height": 200, "count": 4, "nodata": 0, "photometric": "rgb", "predictor": 3}
    assert tiff.output_profile(like, 100, 500) == {"driver": "GTiff", "dtype": "uint16", "width": 100, "height": 500, "count": 4, "nodata": 0, "photometric": "rgb", "compress": "deflate", "tiled": True, "blockxsize": 100, "blockysize": 256, "predictor": 2}
    assert "tiled" not in tiff.output_profile(like, 9, 9, compress=None) and "predictor" not in tiff.output_profile(like, 9, 9, compress=None)
    assert tiff.mask_profile(like, "uint8") == {"driver": "GTiff", "dtype": "uint8", "width": 300, "height": 200, "count": 1, "nodata": 0, "compress": "deflate", "tiled": True, "blockxsize": 256, "blockysize": 200}
    assert "nodata" not in tiff.prediction_profile(like, "float32") and tiff.prediction_profile(like, "float32")["count"] == 1


def test_geoparquet_round_trip(spark, tmp_path):
    ring = lambda *p: [{"x": float(x), "y": float(y)} for x, y in (*p, p[0])]
    a, hole, b = ring((0, 0), (9, 0), (9, 9)), ring((1, 1), (2, 1), (2, 2)), ring((20, 5), (30, 5), (25, 9))
    rows = [(1, [[a, hole]]), (2, [[a], [b]]), (3, None)]
    df = spark.createDataFrame(rows, "id int, parts array<array<array<struct<x: double, y: double>>>>")
    vector.write_geoparquet(df, f"{tmp_path}/g.parquet")
    got = {r.id: r for r in vector.read_geoparquet(spark, f"{tmp_path}/g.parquet").collect()}
    plain = lambda parts: None if parts is None else [[[{"x": p["x"], "y": p["y"]} for p in r] for r in q] for q in parts]
    assert {k: plain(r.parts) for k, r in got.items()} == {k: plain(p) for k, p in rows}
    assert (got[2].x0, got[2].y0, got[2].x1, got[2].y1) == (0.0, 0.0, 30.0, 9.0) and got[3].x0 is None
    big_endian_z = b"\x00\x00\x00\x03\xeb" + b"\x00\x00\x00\x01" + b"\x00\x00\x00\x04" + b"".join(__import__("struct").pack(">ddd", x, y, 7.0) for x, y in ((0, 0), (1, 0), (1, 1), (0, 0)))
    assert vector._read_wkb(big_endian_z) == [[[{"x": float(x), "y": float(y)} for x, y in ((0, 0), (1, 0), (1, 1), (0, 0))]]]
    assert vector._read_wkb(b"\x01\x01\x00\x00\x00" + b"\x00" * 16) is None


def test_weights_round_trip(spark, tmp_path):
    rows = [("a", "2", "float32", [1.0, 2.0]), ("b", "1", "int64", [3.0]), ("c", "", "float32", None)]
    merge.save_weights(spark.createDataFrame(rows, "key string, shape string, kind string, values array<double>"), f"{tmp_path}/w")
    back = merge.load_weights(spark, f"{tmp_path}/w")
    assert {r.key for r in back.collect()} == {"a", "b"} and sorted((r.key, r.idx, r.v) for r in merge.long_weights(back).collect()) == [("a", 0, 1.0), ("a", 1, 2.0)]


def test_stage_samples(spark):
    df = spark.createDataFrame([(i, "train" if i % 3 else "val") for i in range(30)], "idx int, split string")
    fit = [r.idx for r in manifest.stage_samples(df, "fit", "idx", 5).collect()]
    assert sorted(fit) == [i for i in range(30) if i % 3] and fit != sorted(fit) and fit == [r.idx for r in manifest.stage_samples(df.repartition(4), "fit", "idx", 5).collect()]
    assert [r.idx for r in manifest.stage_samples(df, "validate", "idx").collect()] == list(range(0, 30, 3))


def test_regions_are_the_flood_fill():
    rng = np.random.default_rng(6)
    for _ in range(60):
        v = rng.integers(0, rng.integers(1, 4) + 1, (rng.integers(1, 13), rng.integers(1, 13)))
        want, k = np.zeros(v.shape, dtype=int), 0
        for r, c in np.ndindex(*v.shape):
            if want[r, c]:
                continue
            k += 1
            todo = [(r, c)]
            while todo:
                i, j = todo.pop()
                if 0 <= i < v.shape[0] and 0 <= j < v.shape[1] and not want[i, j] and v[i, j] == v[r, c]:
                    want[i, j] = k
                    todo += [(i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)]
        assert raster.regions(v).tolist() == want.tolist()


def test_stacks_of_bands_are_resampled_together(spark, monkeypatch):
    v = np.random.default_rng(6).normal(size=(9, 3, 4))
    assert np.array_equal(raster.bilinear(v, 5, 7), np.array([raster.bilinear(b, 5, 7) for b in v]))
    rows = [(k, None if k in (0, 4) else b.ravel().tolist()) for k, b in enumerate(v)]
    for most in (raster.STACKED, 24):
        monkeypatch.setattr(raster, "STACKED", most)
        got = spark.createDataFrame(rows, "k int, band array<double>").coalesce(1).select("k", raster.resample(3, 4, 5, 7)(F.col("band")).alias("v")).collect()
        assert all(r.v is None if rows[r.k][1] is None else np.array_equal(r.v, raster.bilinear(v[r.k], 5, 7).ravel()) for r in got) and len(got) == 9
