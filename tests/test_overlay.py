"""Unions, repair and outlines against grids of points and flood fills."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.functions import planar as P
from fieldloom.operators import overlay, raster

RING = "array<struct<x:double,y:double>>"


def inside(ring, x, y):
    """Even-odd rule, edge by edge."""
    p, hit = [(q["x"], q["y"]) for q in ring], False
    for (ax, ay), (bx, by) in zip(p[:-1], p[1:], strict=True):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            hit = not hit
    return hit


def closed(*points):
    return [{"x": float(x), "y": float(y)} for x, y in (*points, points[0])]


def crowd(rng, n, width=100):
    out = []
    for _ in range(n):
        x, y, kind = rng.randrange(width), rng.randrange(width), rng.randrange(4)
        a, b = rng.randint(4, 30), rng.randint(4, 30)
        ring = [[(x, y), (x + a, y), (x + a, y + b), (x, y + b)], [(x, y + b), (x + a, y), (x + 2 * a, y + b), (x + a, y + 2 * b)], [(x, y), (x + a, y), (x, y + b)], [(x, y), (x + 2 * a, y), (x + 2 * a, y + b), (x + a, y + b), (x + a, y + 2 * b), (x, y + 2 * b)]][kind]
        out.append(closed(*(ring if rng.random() < 0.5 else ring[::-1])))
    return out


@pytest.mark.parametrize("cell,pieces", [(1000.0, 2000), (37.0, 2000), (20.0, 3)])
def test_dissolve_covers_what_the_polygons_cover(spark, monkeypatch, cell, pieces):
    monkeypatch.setattr(overlay, "PIECES", pieces)
    rng = random.Random(int(cell))
    rings = crowd(rng, 60)
    rows = [(i, r) for i, r in enumerate([*rings, rings[0], rings[0], None, [], closed((1, 1), (5, 5), (9, 9))])]
    parts = overlay.dissolve(spark.createDataFrame(rows, f"field_id int, ring {RING}"), cell=cell).collect()
    points = [(rng.uniform(-5, 165), rng.uniform(-5, 165)) for _ in range(700)]
    for x, y in points:
        n = sum(inside(p.ring, x, y) and not any(inside(h, x, y) for h in p.holes) for p in parts)
        assert n == any(inside(r, x, y) for r in rings)
    # of a shell all area lies to the left, holes turn the other way
    for p in parts:
        assert P.area(np.array([(q["x"] * 1e5, q["y"] * 1e5) for q in p.ring[:-1]]).round().astype(np.int64)) > 0
        assert all(P.area(np.array([(q["x"] * 1e5, q["y"] * 1e5) for q in h[:-1]]).round().astype(np.int64)) < 0 for h in p.holes)


def test_dissolve_by_key_with_holes_and_touching_corners(spark):
    frame = [closed((0, 0), (30, 0), (30, 10), (0, 10)), closed((0, 20), (30, 20), (30, 30), (0, 30)), closed((0, 0), (10, 0), (10, 30), (0, 30)), closed((20, 0), (30, 0), (30, 30), (20, 30))]
    island = [closed((12, 12), (18, 12), (18, 18), (12, 18))]
    corner = [closed((30, 30), (40, 30), (40, 40), (30, 40))]
    rows = [("a", r) for r in frame + island + corner] + [("b", frame[0]), (None, frame[1])]
    got = overlay.dissolve(spark.createDataFrame(rows, f"k string, ring {RING}"), by="k", cell=7.0).collect()
    assert sorted((str(p.by), round(p.area, 6), len(p.ring) - 1, len(p.holes)) for p in got) == [("None", 300.0, 4, 0), ("a", 36.0, 4, 0), ("a", 100.0, 4, 0), ("a", 800.0, 4, 1), ("b", 300.0, 4, 0)]


def test_dissolve_of_nothing(spark):
    assert overlay.dissolve(spark.createDataFrame([], f"field_id int, ring {RING}")).count() == 0


def test_repair(spark):
    square = [(0, 0), (10, 0), (10, 10), (0, 10)]
    rows = [("bow tie", closed((0, 0), (10, 10), (10, 0), (0, 10))), ("spike", closed((0, 0), (10, 0), (10, 10), (5, 10), (5, 20), (5, 10), (0, 10))), ("twice", closed(*square, *square)),
            ("loop", closed(*square, (0, 0), (2, 2), (2, 8), (8, 8), (8, 2), (2, 2))), ("open", [{"x": float(x), "y": float(y)} for x, y in square]), ("flat", closed((0, 0), (5, 5), (9, 9))), ("none", None), ("nan", closed((0, 0), (float("nan"), 1), (2, 2)))]
    got = overlay.repaired(spark.createDataFrame(rows, f"name string, ring {RING}")).collect()
    assert sorted((r.name, r.part, round(r.area, 6), len(r.holes)) for r in got) == [("bow tie", 0, 25.0, 0), ("bow tie", 1, 25.0, 0), ("loop", 0, 64.0, 1), ("open", 0, 100.0, 0), ("spike", 0, 100.0, 0), ("twice", 0, 100.0, 0)]


def test_repaired_stars_are_odd_windings(spark):
    rng = random.Random(4)
    rows = [(i, closed(*[(rng.uniform(0, 50), rng.uniform(0, 50)) for _ in range(rng.randint(4, 11))])) for i in range(25)]
    parts = {}
    for r in overlay.repaired(spark.createDataFrame(rows, f"id int, ring {RING}")).collect():
        parts.setdefault(r.id, []).append(r)
    for i, ring in rows:
        for _ in range(200):
            x, y = rng.uniform(0, 50), rng.uniform(0, 50)
            assert inside(ring, x, y) == any(inside(p.ring, x, y) and not any(inside(h, x, y) for h in p.holes) for p in parts.get(i, []))


@pytest.mark.parametrize("side", [4, 6, 24])
def test_regions_are_the_flood_fill_across_bands(spark, side):
    rng = np.random.default_rng(side)
    whole = rng.integers(0, 3, (24, 24)).astype(float)
    whole[5:18, 5:18] = 1.0
    whole[9:13, 8:15] = 2.0
    whole[0, 0] = np.nan
    n = 24 // side
    rows = [(gx, gy, whole[gy * side : (gy + 1) * side, gx * side : (gx + 1) * side].ravel().tolist()) for gx in range(n) for gy in range(n)]
    got = overlay.mosaic_regions(spark.createDataFrame(rows, "gx int, gy int, band array<double>"), side).collect()
    want, seen = [], np.zeros((24, 24), bool)
    for r in range(24):
        for c in range(24):
            if not seen[r, c] and not np.isnan(whole[r, c]):
                stack, size = [(r, c)], 0
                seen[r, c] = True
                while stack:
                    y, x = stack.pop()
                    size += 1
                    for v, u in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
                        if 0 <= v < 24 and 0 <= u < 24 and not seen[v, u] and whole[v, u] == whole[r, c]:
                            seen[v, u] = True
                            stack.append((v, u))
                want.append((whole[r, c], float(size)))
    assert sorted((p.by, p.area) for p in got) == sorted(want)
    assert any(p.holes for p in got)
    # every pixel lies in the one region of its value
    for r in range(24):
        for c in range(24):
            hits = [p.by for p in got if inside(p.ring, c + 0.5, r + 0.5) and not any(inside(h, c + 0.5, r + 0.5) for h in p.holes)]
            assert hits == ([] if np.isnan(whole[r, c]) else [whole[r, c]])


@pytest.mark.parametrize("block", [4, 8])
def test_regions_go_on_from_block_to_block(spark, monkeypatch, block):
    rng = np.random.default_rng(block)
    whole = rng.integers(0, 2, (16, 16)).astype(float)
    whole[2:14, 2:14] = 1.0
    whole[5:11, 5:11] = 0.0
    whole[7:9, 7:9] = 1.0
    rows = [(gx, gy, whole[gy * 4 + 4 : gy * 4 + 8, gx * 4 + 4 : gx * 4 + 8].ravel().tolist()) for gx in range(-1, 3) for gy in range(-1, 3)]
    bands = spark.createDataFrame([*rows, (9, 9, None)], "gx int, gy int, band array<double>")
    named = lambda found: sorted((p.by, p.area, sorted(min((q.x, q.y) for q in h) for h in p.holes), min((q.x, q.y) for q in p.ring)) for p in found)
    at_once = named(overlay.mosaic_regions(bands, 4).collect())
    monkeypatch.setattr(overlay, "BLOCK", block)
    assert named(overlay.mosaic_regions(bands, 4).collect()) == at_once
    assert sum(a for _, a, *_ in at_once) == 256 and any(h for *_, h, _ in at_once)


def test_regions_of_one_band(spark):
    band = [0.0, 1, 1, 0, 1, 0, 1, 1, 1, 1, 1, 0, 0, 0, 0, 1]
    got = overlay.region_polygons(spark.createDataFrame([(7, [float(x) for x in band])], "chip long, band array<double>"), 4, 4).collect()
    assert sorted((p.chip, p.value, p.area, len(p.holes)) for p in got if p.value == 1) == [(7, 1.0, 1.0, 0), (7, 1.0, 8.0, 1)]


def test_regions_of_many_bands_are_outlined_together(spark, monkeypatch):
    rng = np.random.default_rng(3)
    bands = [rng.choice([0.0, 1.0, 2.0, np.nan], 25).tolist() for _ in range(40)]
    kind = "chip long, band array<double>"
    rows = [(98, [float("nan")] * 25), *enumerate(bands), (99, None)]
    got = {}
    for p in overlay.region_polygons(spark.createDataFrame(rows, kind).coalesce(1), 5, 5).collect():
        got.setdefault(p.chip, []).append(p)
    monkeypatch.setattr(overlay, "PIXELS", 1)
    alone = {}
    for p in overlay.region_polygons(spark.createDataFrame(rows, kind).coalesce(1), 5, 5).collect():
        alone.setdefault(p.chip, []).append(p)
    # a null band has no regions, nor has one without values
    assert got == alone and set(got) == set(range(40))
    for k, b in enumerate(bands):
        v = np.array(b).reshape(5, 5)
        for r in range(5):
            for c in range(5):
                hits = [p.value for p in got[k] if inside(p.ring, c + 0.5, r + 0.5) and not any(inside(h, c + 0.5, r + 0.5) for h in p.holes)]
                assert hits == ([] if np.isnan(v[r, c]) else [v[r, c]])


def test_farthest_points_are_the_greedy_loop(spark):
    rng = random.Random(8)
    rows = [(f, rng.randrange(50), rng.randrange(50)) for f in range(6) for _ in range(rng.randint(1, 40))]
    got = {}
    for r in raster.sample_points(spark.createDataFrame(rows, "field_id long, px long, py long"), 10).orderBy("field_id", "rank").collect():
        got.setdefault(r.field_id, []).append((r.px, r.py))
    for f in range(6):
        left = sorted((x, y) for k, x, y in rows if k == f)
        chosen = [left[0]]
        while len(chosen) < min(10, len(left)):
            gap = [min(((x - u) ** 2 + (y - v) ** 2) ** 0.5 for u, v in chosen) for x, y in left]
            if max(gap) == 0:
                break
            chosen.append(left[gap.index(max(gap))])
        assert got[f] == chosen


def test_columns_of_the_results(spark):
    assert overlay.repaired(spark.createDataFrame([(1, closed((0, 0), (4, 0), (4, 4)), 2.5)], f"part_of int, ring {RING}, w double")).select("part_of", "w", F.size("ring").alias("n")).first() == (1, 2.5, 4)


def test_ribbons_are_what_is_near_the_outline(spark):
    rng = random.Random(12)
    rings = [closed((0, 0), (40, 0), (40, 30), (0, 30)), closed((0, 0), (40, 5), (20, 30), (15, 12)), closed((0, 0), (3, 0), (3, 3), (0, 3))]
    rows = [*enumerate(rings), (7, None), (8, closed((1, 1), (1, 1))), (9, [])]
    got = {}
    for r in overlay.ribbons(spark.createDataFrame(rows, f"id int, ring {RING}"), 4.0, quarter=32).collect():
        got.setdefault(r.id, []).append(r)
    assert set(got) == {0, 1, 2} and [len(got[i]) for i in range(3)] == [1, 1, 1] and not got[2][0].holes

    def gap(ring, x, y):
        best = 1e9
        for p, q in zip(ring[:-1], ring[1:], strict=True):
            dx, dy = q["x"] - p["x"], q["y"] - p["y"]
            t = max(0.0, min(1.0, ((x - p["x"]) * dx + (y - p["y"]) * dy) / (dx * dx + dy * dy)))
            best = min(best, ((x - p["x"] - t * dx) ** 2 + (y - p["y"] - t * dy) ** 2) ** 0.5)
        return best

    for i, ring in enumerate(rings):
        for _ in range(300):
            x, y = rng.uniform(-6, 46), rng.uniform(-6, 36)
            d = gap(ring, x, y)
            if abs(d - 4.0) > 0.01:
                part = got[i][0]
                assert (d < 4.0) == (inside(part.ring, x, y) and not any(inside(h, x, y) for h in part.holes))


def test_simplified_neighbours_share_their_border(spark):
    from fieldloom.operators.simplify import simplify_shared

    rng, n = random.Random(5), 5
    corner = {(i, j): (100.0 * i + rng.uniform(-20, 20), 100.0 * j + rng.uniform(-20, 20)) for i in range(n + 1) for j in range(n + 1)}
    sides = {}

    def side(a, b):
        key = (min(a, b), max(a, b))
        if key not in sides:
            (px, py), (qx, qy) = corner[key[0]], corner[key[1]]
            sides[key] = [(px + (qx - px) * t / 9 + rng.uniform(-6, 6), py + (qy - py) * t / 9 + rng.uniform(-6, 6)) for t in range(1, 9)]
        return sides[key] if key[0] == a else sides[key][::-1]

    rows = []
    for i in range(n):
        for j in range(n):
            c = [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)]
            p = [x for a, b in zip(c, [*c[1:], c[0]], strict=True) for x in [corner[a], *side(a, b)]]
            k = rng.randrange(len(p))
            p = p[k:] + p[:k]
            rows.append((i * n + j, closed(*(p if rng.random() < 0.5 else p[::-1]))))
    island = closed(*[(2000 + 30 * np.cos(t), 30 * np.sin(t)) for t in np.arange(40) * np.pi / 20])
    rows += [(900, island), (901, [*island[7:-1], *island[:8]]), (902, None)]
    got = {r.id: r.ring for r in simplify_shared(spark.createDataFrame(rows, f"id int, ring {RING}").repartition(5), "id", "ring", 10.0).collect()}
    assert got[902] is None and {(p.x, p.y) for p in got[900]} == {(p.x, p.y) for p in got[901]} and 4 < len(got[900]) < 20
    was, now = sum(len(r) for k, r in rows if k < 900), sum(len(r) for k, r in got.items() if k < 900)
    assert now < was * 0.6
    # every edge inside the lattice belongs to two cells, so the cells cover the same without gaps or overlaps
    count = {}
    for k in range(n * n):
        for p, q in zip(got[k][:-1], got[k][1:], strict=True):
            e = tuple(sorted([(p.x, p.y), (q.x, q.y)]))
            count[e] = count.get(e, 0) + 1
    assert max(count.values()) == 2
    lone = {e for e, c in count.items() if c == 1}
    ends = {}
    for p, q in lone:
        ends[p], ends[q] = ends.get(p, 0) + 1, ends.get(q, 0) + 1
    assert set(ends.values()) == {2}
    # corners where three or more sides meet stay
    points = {(p.x, p.y) for k in range(n * n) for p in got[k]}
    assert all(corner[i, j] in points for i in range(n + 1) for j in range(n + 1) if not (i in (0, n) and j in (0, n)))


def test_shared_borders_are_found_without_a_window(spark):
    from fieldloom.operators.simplify import simplify_shared

    cells = [(10 * j + i, closed((i, j), (i + 0.5, j + 0.01 * (i + j)), (i + 1, j), (i + 1, j + 1), (i, j + 1))) for i in range(4) for j in range(4)]
    done = simplify_shared(spark.createDataFrame(cells, f"id int, ring {RING}"), "id", "ring", 0.2)
    # edges are counted before the shuffle, and no task sorts all of them
    assert "Window" not in done._jdf.queryExecution().toString()
    assert sorted(r.id for r in done.collect() if r.ring) == sorted(k for k, _ in cells)
