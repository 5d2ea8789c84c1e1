"""Data sources, batches, projections and warping against plain loops."""

from __future__ import annotations

import datetime as dt
import json
import math
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.functions import geometry as G
from fieldloom.functions import planar as P
from fieldloom.functions import projection as J
from fieldloom.operators import agreement, batches
from fieldloom.operators import warp as W
from fieldloom.sources import catalogue, cube


@pytest.fixture(scope="module")
def scenes():
    rng = random.Random(2)
    out = [(k, rng.choice(["20LKP", "21HUB", "1/2 %"]), dt.datetime(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 500), seconds=rng.randint(0, 86399), microseconds=k), float(rng.choice([0, 5, 10, 20])), 0.0, float(k), 0.0, float(k + 1), 1.0) for k in range(400)]
    return [*out, (400, "21HUB", dt.datetime(2020, 3, 1), None, None, None, None, None, None), (401, "21HUB", dt.datetime(2020, 2, 29, 23, 59, 59, 999999), 5.0, 0.0, 0.0, 0.0, 1.0, 1.0)]


def test_catalogue_filters_reach_the_source(spark, scenes, tmp_path):
    root = f"file://{tmp_path}/catalogue"
    catalogue.write_catalogue(spark.createDataFrame([*scenes, (900, None, dt.datetime(2020, 1, 1), 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)], catalogue.SCHEMA), root)
    every = catalogue.read_catalogue(spark, root, bytes=1)
    assert sorted(map(tuple, every.collect()), key=str) == sorted(scenes, key=str)
    folders = len({(s[1], s[2].strftime("%Y-%m")) for s in scenes})
    assert every.rdd.getNumPartitions() == folders
    part = every.filter("tile = '21HUB' and ts >= timestamp_ntz '2020-03-01' and ts < timestamp_ntz '2020-05-01' and cloud <= 10 and scene_id % 3 = 1")
    assert part.rdd.getNumPartitions() == 2
    assert sorted(r.scene_id for r in part.collect()) == sorted(s[0] for s in scenes if s[1] == "21HUB" and dt.datetime(2020, 3, 1) <= s[2] < dt.datetime(2020, 5, 1) and s[3] is not None and s[3] <= 10 and s[0] % 3 == 1)
    # what the source has taken is no longer filtered by Spark; what it cannot do is
    plan = part._jdf.queryExecution().executedPlan().toString()
    left = [line for line in plan.splitlines() if " Filter (" in line]
    assert len(left) == 1 and "cloud" not in left[0] and "tile" not in left[0] and "%" in left[0]
    assert every.filter("tile in ('20LKP', 'none') and ts = timestamp_ntz '2020-03-01'").count() == 0
    assert every.filter("tile = 'none'").count() == 0


def test_catalogue_packs_folders(spark, scenes, tmp_path):
    catalogue.write_catalogue(spark.createDataFrame(scenes, catalogue.SCHEMA), f"{tmp_path}/c")
    assert catalogue.read_catalogue(spark, f"{tmp_path}/c").rdd.getNumPartitions() == 1
    assert catalogue.read_catalogue(spark, f"{tmp_path}/c").filter("cloud > 5").count() == sum(s[3] is not None and s[3] > 5 for s in scenes)


def test_cube_is_whole_or_not_there(spark, tmp_path):
    rows = [(n, [float(n * 12 + i) for i in range(12)], [n % 2] * 6, f"é {n}" if n else None) for n in range(7)]
    schema = "position long, image array<double>, mask array<int>, meta string"
    at = f"file://{tmp_path}/cube.zarr"
    cube.write_cube(spark.createDataFrame(rows, schema).repartition(3), at, 2, 2, 3, text=10)
    info = json.load(open(tmp_path / "cube.zarr/images/.zarray"))
    assert info["shape"] == [7, 2, 2, 3] and info["chunks"] == [1, 2, 2, 3] and info["dtype"] == "<f4"
    assert np.frombuffer(zlib.decompress(open(tmp_path / "cube.zarr/images/5.0.0.0", "rb").read()), "<f4").tolist() == rows[5][1]
    assert sorted((r.position, r["values"][0]) for r in cube.read_cube(spark, at, "meta").collect()) == [(n, m or "") for n, _, _, m in rows]
    assert sorted((r.position, r["values"]) for r in cube.read_cube(spark, at, "masks").collect()) == [(n, [float(x) for x in m]) for n, _, m, _ in rows]
    before = sorted(os.listdir(tmp_path))
    with pytest.raises(Exception, match="shape"):
        cube.write_cube(spark.createDataFrame([*rows[:6], (6, [1.0], [1], "x")], schema).repartition(3), f"file://{tmp_path}/other", 2, 2, 3, text=10)
    with pytest.raises(Exception, match="numbered"):
        cube.write_cube(spark.createDataFrame(rows[1:], schema), f"file://{tmp_path}/other", 2, 2, 3, text=10)
    with pytest.raises(Exception, match="cube.zarr"):
        cube.write_cube(spark.createDataFrame(rows, schema), at, 2, 2, 3, text=10)
    assert sorted(os.listdir(tmp_path)) == before
    cube.write_cube(spark.createDataFrame(rows[:2], schema), at, 2, 2, 3, overwrite=True, text=10)
    assert cube.read_cube(spark, at, "images").count() == 2 and sorted(os.listdir(tmp_path)) == before


@pytest.mark.parametrize("parts", [1, 4, 40])
def test_batches_are_a_literal_order(spark, parts):
    rows = [(k * 7 % 501, "train" if k % 3 else "val", k) for k in range(501)]
    df = spark.createDataFrame(rows, "id long, split string, x int").repartition(parts)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        val = batches.batches(df, "validate", "id", 16).collect()
        fit = batches.batches(df, "fit", "id", 16, seed=5, drop_last=True).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    ids = sorted(i for i, s, _ in rows if s == "val")
    assert sorted((r.position, r.batch, r.place, r.id) for r in val) == [(n, n // 16, n % 16, i) for n, i in enumerate(ids)]
    train = [i for i, s, _ in rows if s == "train"]
    hashed = {r.id: r.h for r in spark.createDataFrame([(i,) for i in train], "id long").select("id", F.xxhash64(F.lit(5), F.lit(0), "id").alias("h")).collect()}
    order = sorted(train, key=lambda i: (hashed[i], i))
    assert sorted((r.batch, r.place, r.id) for r in fit) == [(n // 16, n % 16, i) for n, i in enumerate(order) if n // 16 < len(order) // 16]


def test_positions_with_ties_and_nothing(spark):
    df = spark.createDataFrame([(1, "a")] * 9 + [(None, "b")], "id long, x string")
    assert sorted(r.position for r in batches.positions(df, [F.col("id")]).collect()) == list(range(10))
    assert batches.positions(df.filter("x = 'c'"), [F.col("id")]).count() == 0
    with pytest.raises(ValueError):
        batches.batches(df, "predict", "id", 4)


@pytest.mark.parametrize("crs", ["EPSG:5880", "BRAZIL:ALBERS", "EPSG:32723", "EPSG:32622", "EPSG:4326"])
def test_projections_there_and_back(spark, crs):
    rng = random.Random(3)
    mid = {"EPSG:32723": -45, "EPSG:32622": -51}.get(crs)
    points = [(rng.uniform(mid - 3, mid + 3) if mid else rng.uniform(-74, -34), rng.uniform(-34, -1) if crs != "EPSG:32622" else rng.uniform(0, 5)) for _ in range(200)] + [(-51.0 if mid != -45 else -45.0, 0.0)]
    to, back = J.system(crs)
    x, y = to(np.array([p[0] for p in points]), np.array([p[1] for p in points]), J.ARRAYS)
    df = spark.createDataFrame(points, "lon double, lat double").select("lon", "lat", *[c.alias(n) for c, n in zip(to(F.col("lon"), F.col("lat")), "xy", strict=True)])
    df = df.select("*", *[c.alias(n) for c, n in zip(back(F.col("x"), F.col("y")), "uv", strict=True)])
    for r, a, b in zip(df.collect(), x, y, strict=True):
        assert math.isclose(r.x, a, abs_tol=1e-6) and math.isclose(r.y, b, abs_tol=1e-6)
        assert abs(r.u - r.lon) < 1e-6 and abs(r.v - r.lat) < 1e-6


def test_the_choice_of_a_system(spark):
    ring = [{"x": -50.0, "y": -10.0}, {"x": -49.9, "y": -10.0}, {"x": -49.9, "y": -9.9}, {"x": -50.0, "y": -10.0}]
    df = spark.createDataFrame([(1, ring), (2, None)], "id int, ring array<struct<x:double,y:double>>")
    with pytest.raises(ValueError):
        J.projected(df, "ring", None)
    assert J.projected(df, "ring", None, if_missing="EPSG:4326")[1] == "EPSG:5880"
    assert J.projected(df, "ring", "EPSG:4326", target="EPSG:32723")[1] == "EPSG:32723"
    got, crs = J.projected(df, "ring", "EPSG:4326", brazil=False)
    assert crs == "EPSG:32722"
    a, b = J.utm(np.array([p["x"] for p in ring]), np.array([p["y"] for p in ring]), 22, True, J.ARRAYS)
    assert [(round(p.x, 4), round(p.y, 4)) for p in got.filter("id = 1").first().ring] == [(round(u, 4), round(v, 4)) for u, v in zip(a, b, strict=True)]
    assert J.projected(got, "ring", crs, brazil=False)[1] == crs
    assert J.zone_of(-54.0, 0.0) == "EPSG:32622" and J.zone_of(179.9, -1.0) == "EPSG:32760"
    with pytest.raises(ValueError):
        J.system("EPSG:2154")


def literal_warp(whole, source, target, width, height, nodata):
    out = np.zeros((height, width))
    for row in range(height):
        for col in range(width):
            x, y = J.convert(*target.centres(np.array([float(col)]), np.array([float(row)])), target.crs, source.crs, J.ARRAYS)
            c, r = (float(v[0]) for v in source.place(x, y))
            at = lambda j, i: whole[j][i] if 0 <= j < len(whole) and 0 <= i < len(whole[0]) and whole[j][i] != nodata else None
            if at(math.floor(r + 0.5), math.floor(c + 0.5)) is None:
                continue
            total = weight = 0.0
            for j in (0, 1):
                for i in (0, 1):
                    v = at(math.floor(r) + j, math.floor(c) + i)
                    w = abs(1 - i - (c - math.floor(c))) * abs(1 - j - (r - math.floor(r)))
                    if v is not None:
                        total, weight = total + v * w, weight + w
            out[row, col] = total / weight
    return out


@pytest.mark.parametrize("case", ["shift", "degrees", "coarse"])
def test_warp_is_the_loop(spark, case):
    rng = np.random.default_rng(6)
    whole = rng.integers(1, 3000, (20, 30)).astype(float)
    whole[3:5, 7:9] = -1
    source = W.Grid("EPSG:32723", 400000.0, 8700000.0, 10.0, -10.0)
    target, width, height = {
        "shift": (W.Grid("EPSG:32723", 400003.0, 8700007.5, 10.0, -10.0), 33, 22), "degrees": (W.Grid("EPSG:4326", -45.9176, -11.7563, 0.00009, -0.00009), 34, 24), "coarse": (W.Grid("EPSG:32723", 399980.0, 8700020.0, 35.0, -35.0), 9, 7),
    }[case]
    tiles = [(k, gx, gy, whole[gy * 10 : gy * 10 + 10, gx * 10 : gx * 10 + 10].ravel().tolist()) for k in ("a", "b") for gx in range(3) for gy in range(2)]
    df = spark.createDataFrame(tiles, "scene string, gx int, gy int, band array<double>")
    got = W.pixels_of(W.warp(df, source, 10, target, width, height, block=16, key="scene", nodata=-1.0), 16).collect()
    want = literal_warp(whole.tolist(), source, target, width, height, -1)
    for k in ("a", "b"):
        mine = np.zeros((height, width))
        for r in got:
            if r.key == k:
                mine[r.row, r.col] = r.v
        assert np.abs(mine - want).max() < 1e-6 and (want > 0).sum() > 20
    # the area of interest, and whole numbers
    x, y = target.centres(np.array([2.0, 6.0]), np.array([1.0, 5.0]))
    box = [(x[0] - 1e-6, y[0] + 1e-6), (x[1] + 1e-6, y[0] + 1e-6), (x[1] + 1e-6, y[1] - 1e-6), (x[0] - 1e-6, y[1] - 1e-6)]
    cut = W.pixels_of(W.warp(df.filter("scene = 'a'"), source, 10, target, width, height, block=16, nodata=-1.0, aoi=box, whole=True), 16).filter("v <> 0").collect()
    inside = np.zeros((height, width), bool)
    inside[1:6, 2:7] = True
    assert {(r.row, r.col): r.v for r in cut} == {(int(i), int(j)): float(np.rint(want[i, j])) for i, j in zip(*np.nonzero(inside & (want > 0)), strict=True)}


def test_shared_areas_are_unions_missing_parts():
    rng = np.random.default_rng(5)
    a, b, want = [], [], []
    while len(want) < 150:
        pair = []
        for _ in range(2):
            k = rng.integers(3, 9)
            t = np.sort(rng.random(k)) * 2 * np.pi
            r = np.rint(np.stack((np.cos(t), np.sin(t)), 1) * rng.integers(5, 200, (k, 1)) + rng.integers(0, 200, 2)).astype(np.int64)
            pair.append(r if len(r) and P.area(r) > 0 else None)
        if any(r is None for r in pair):
            continue
        big = [r * 10**5 for r in pair]
        areas = [sum(P.area(x) for x in P.rings(*P.boundary(r, np.roll(r, -1, axis=0), odd=True))) / 1e10 for r in big]
        if any(abs(s - P.area(r)) > 1e-3 for s, r in zip(areas, pair, strict=True)):
            continue  # crosses itself
        union = sum(P.area(x) for x in P.rings(*P.boundary(np.concatenate(big), np.concatenate([np.roll(r, -1, axis=0) for r in big])))) / 1e10
        a.append(np.concatenate((pair[0], pair[0][:1])).astype(float))
        b.append(pair[1][::-1].astype(float))
        want.append(sum(areas) - union)
    assert np.abs(G.shared_areas(a, b) - want).max() < 0.01
    assert G.shared_areas([], []).tolist() == [] and G.shared_areas([np.zeros((0, 2)), a[0]], [b[0], np.zeros((0, 2))]).tolist() == [0.0, 0.0]


def test_labels_keep_their_row_without_a_field(spark):
    ring = lambda x, y, s: [{"x": float(u), "y": float(v)} for u, v in ((x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y))]
    schema = "id int, ring array<struct<x:double,y:double>>"
    labels = spark.createDataFrame([(1, ring(0, 0, 10)), (2, ring(500, 500, 5))], schema)
    fields = spark.createDataFrame([(7, ring(5, 0, 10)), (8, ring(0, 0, 10)), (9, ring(10, 10, 5))], schema)
    got = sorted(((r.label_id, r.field_id, r.shared_area, r.iou) for r in agreement.labelled_fields(labels, fields, 50).collect()), key=str)
    assert got == [(1, 7, 50.0, 1 / 3), (1, 8, 100.0, 1.0), (1, 9, 0.0, 0.0), (2, None, None, None)]
    pairs = agreement.ring_measures(labels, fields, 50)
    assert agreement.object_counts(labels, fields, pairs).first() == (1, 2, 1)


def test_fields_meet_chips_of_other_systems(spark):
    from fieldloom.operators import joins

    lonlat = lambda x, y, s: [{"x": float(u), "y": float(v)} for u, v in ((x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y))]
    rng = random.Random(9)
    rows = [(k, lonlat(rng.uniform(-48.3, -47.7), rng.uniform(-12.1, -11.9), rng.uniform(0.001, 0.03))) for k in range(60)] + [(99, None)]
    chips = []
    for k in range(12):
        zone = 22 if k % 2 else 23
        x, y = J.utm(np.array([rng.uniform(-48.2, -47.8)]), np.array([rng.uniform(-12.05, -11.95)]), zone, True, J.ARRAYS)
        chips.append((k, float(x[0]), float(y[0]), float(x[0]) + 2560, float(y[0]) + 2560, f"EPSG:327{zone}"))
    f = spark.createDataFrame(rows, "field_id int, ring array<struct<x:double,y:double>>")
    c = spark.createDataFrame(chips, "chip_id int, x0 double, y0 double, x1 double, y1 double, crs string")
    got = {(r.field_id, r.chip_id): r.ring for r in joins.fields_in_chips(f, c, "EPSG:4326", 0.05).collect()}
    want = {}
    for k, ring in rows[:-1]:
        for chip, x0, y0, x1, y1, crs in chips:
            x, y = J.convert(np.array([p["x"] for p in ring]), np.array([p["y"] for p in ring]), "EPSG:4326", crs, J.ARRAYS)
            p = np.stack((x, y), axis=1)
            box = np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])
            if G.shared_area(p, box) > 1e-6:
                want[k, chip] = p
    assert set(got) == set(want) and len(want) > 5
    assert all(np.abs(np.array([(p.x, p.y) for p in got[k]]) - want[k]).max() < 1e-6 for k in want)


@pytest.mark.parametrize("reach", [2, 50])
def test_gaps_are_filled_from_four_sides(reach):
    from fieldloom.operators.raster import fill_gaps

    rng = np.random.default_rng(reach)
    v = rng.uniform(0, 100, (9, 11))
    bad = rng.random((9, 11)) < 0.6
    bad[4] = True
    got = fill_gaps(v, bad, reach)
    for r in range(9):
        for c in range(11):
            if not bad[r, c]:
                assert got[r, c] == v[r, c]
                continue
            total = weight = 0.0
            for dr, dc in ((0, 1), (0, -1), (1, 0), (-1, 0)):
                for d in range(1, reach + 1):
                    y, x = r + dr * d, c + dc * d
                    if not (0 <= y < 9 and 0 <= x < 11):
                        break
                    if not bad[y, x]:
                        total, weight = total + v[y, x] / d, weight + 1 / d
                        break
            assert math.isclose(got[r, c], total / weight if weight else v[r, c])


def test_zones_without_pixels_are_sampled(spark):
    from fieldloom.operators import score

    box = lambda x, y, s: [{"x": float(u), "y": float(v)} for u, v in ((x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y))]
    zones = spark.createDataFrame([(1, box(0, 0, 10)), (2, box(20, 20, 4)), (3, box(40, 40, 4)), (4, box(60, 60, 4))], "zone int, ring array<struct<x:double,y:double>>")
    pixels = spark.createDataFrame([(1, 7), (1, 7), (1, 3), (2, 0)], "zone int, doy int")
    cells = spark.createDataFrame([(2, 2, 99), (4, 4, 0), (0, 0, 5)], "row int, col int, doy int")
    assert sorted(tuple(r) for r in score.zonal_or_sampled(pixels, zones, cells, "doy", 0.0, 0.0, 10.0).collect()) == [(1, 7, False), (2, 99, True), (3, None, True), (4, None, True)]


def test_cube_with_several_samples_a_chunk(spark, tmp_path):
    rows = [(n, [float(n * 10 + k) for k in range(8)], [n % 3, 1, 0, n % 2], None if n == 5 else f"s{n}") for n in range(11)]
    kind = "position bigint, image array<double>, mask array<int>, meta string"
    path = f"file://{tmp_path}/cube"
    cube.write_cube(spark.createDataFrame(rows, kind).repartition(5), path, 2, 2, 2, text=6, each=4)
    assert len([f for f in os.listdir(tmp_path / "cube" / "images") if f[0].isdigit()]) == 3
    with open(tmp_path / "cube" / "masks" / "0.0.0", "rb") as f:
        assert np.frombuffer(zlib.decompress(f.read()), "u1").reshape(4, 2, 2)[2].ravel().tolist() == rows[2][2]
    with open(tmp_path / "cube" / "images" / ".zarray") as f:
        assert json.load(f)["chunks"] == [4, 2, 2, 2]
    read = {a: {r.position: r["values"] for r in cube.read_cube(spark, path, a).collect()} for a in ("images", "masks", "meta")}
    assert read["images"] == {n: i for n, i, _, _ in rows} and read["masks"] == {n: [float(x) for x in m] for n, _, m, _ in rows}
    assert read["meta"] == {n: [t or ""] for n, _, _, t in rows}
    for wrong in ([r for r in rows if r[0] != 2], [*rows, rows[3]]):
        with pytest.raises(Exception):  # noqa: B017
            cube.write_cube(spark.createDataFrame(wrong, kind), f"file://{tmp_path}/wrong", 2, 2, 2, text=6, each=4)
        assert not os.path.exists(tmp_path / "wrong")
