"""Boxes as column expressions; polygons as arrays of points, with NumPy behind Arrow where SQL cannot say it."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import projection

RING = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))


# boxes: four columns each


def box(prefix: str = "") -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(f"{prefix}{c}") for c in ("x0", "y0", "x1", "y1"))


def box_area(b) -> Column:
    return (b[2] - b[0]) * (b[3] - b[1])


def box_touches(a, b) -> Column:
    """Boxes share at least a point."""
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


def box_intersection(a, b) -> Column:
    w, h = F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.when((w > 0) & (h > 0), w * h).otherwise(w * 0)


def box_contains(outer, inner, slack: float = 0.0) -> Column:
    return (outer[0] - slack <= inner[0]) & (outer[1] - slack <= inner[1]) & (outer[2] + slack >= inner[2]) & (outer[3] + slack >= inner[3])


def agreement(a_area: Column, b_area: Column, shared: Column) -> dict[str, Column]:
    """Measures of two shapes by their areas: union, symmetric difference, iou, dice, relative area difference; null where undefined."""
    union = a_area + b_area - shared
    return {
        "union_area": union,
        "symdiff_area": a_area + b_area - 2 * shared,
        "iou": F.when(union > 0, shared / union),
        "dice": F.when(a_area + b_area > 0, 2 * shared / (a_area + b_area)),
        "area_diff": F.when(a_area > 0, F.abs(a_area - b_area) / a_area),
    }


def centroid_distance(a, b) -> Column:
    return F.hypot((a[0] + a[2]) / 2 - (b[0] + b[2]) / 2, (a[1] + a[3]) / 2 - (b[1] + b[3]) / 2)


# rings: closed arrays of points


def _next(ring: Column) -> Column:
    return F.slice(ring, F.lit(2), F.size(ring) - 1)


def ring_area(ring: Column) -> Column:
    """Unsigned shoelace area of a closed ring."""
    cross = F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), _next(ring), lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v)) / 2


def ring_length(ring: Column) -> Column:
    part = F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), _next(ring), lambda p, q: F.hypot(p["x"] - q["x"], p["y"] - q["y"]))
    return F.aggregate(part, F.lit(0.0), lambda s, v: s + v)


def ring_centroid(ring: Column) -> Column:
    """Struct (x, y) by moments; null for a ring without area."""
    a, b = F.slice(ring, F.lit(1), F.size(ring) - 1), _next(ring)
    cross = F.zip_with(a, b, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    mx = F.zip_with(a, b, lambda p, q: (p["x"] + q["x"]) * (p["x"] * q["y"] - q["x"] * p["y"]))
    my = F.zip_with(a, b, lambda p, q: (p["y"] + q["y"]) * (p["x"] * q["y"] - q["x"] * p["y"]))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, v: s + v)
    return F.when(total(cross) != 0, F.struct((total(mx) / (3 * total(cross))).alias("x"), (total(my) / (3 * total(cross))).alias("y")))


def ring_bounds(ring: Column) -> Column:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))


def affine_ring(ring: Column, a: float, b: float, c: float, d: float, e: float, f: float) -> Column:
    """Pixel to map coordinates for each vertex; null for fewer than three different vertices."""
    moved = F.transform(ring, lambda p: F.struct((a * p["x"] + b * p["y"] + c).alias("x"), (d * p["x"] + e * p["y"] + f).alias("y")))
    return F.when(F.size(F.array_distinct(moved)) >= 3, moved)


def repair_ring(ring: Column) -> Column:
    """Repeated neighbours dropped, closed, null if degenerate (fewer than 3 corners or no area)."""
    start = F.slice(ring, F.lit(1), F.lit(0))
    clean = F.aggregate(ring, start, lambda s, p: F.when((F.size(s) > 0) & (F.try_element_at(s, F.lit(-1)) == p), s).otherwise(F.concat(s, F.array(p))))
    closed = F.when(F.element_at(clean, 1) == F.element_at(clean, -1), clean).otherwise(F.concat(clean, F.array(F.element_at(clean, 1))))
    return F.when((F.size(ring) >= 3) & (F.size(closed) >= 4) & (ring_area(closed) > 0), closed)


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd rule: crossings of a ray to the right."""
    a, b = F.slice(ring, F.lit(1), F.size(ring) - 1), _next(ring)
    cuts = F.zip_with(a, b, lambda p, q: F.when(((p["y"] > y) != (q["y"] > y)) & (x < (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"]), 1).otherwise(0))
    return F.aggregate(cuts, F.lit(0), lambda s, v: s + v) % 2 == 1


def distance_to_ring(x: Column, y: Column, ring: Column) -> Column:
    """Distance from a point to the nearest edge."""
    a, b = F.slice(ring, F.lit(1), F.size(ring) - 1), _next(ring)

    def edge(p: Column, q: Column) -> Column:
        dx, dy = q["x"] - p["x"], q["y"] - p["y"]
        n = dx * dx + dy * dy
        t = F.when(n > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - p["x"]) * dx + (y - p["y"]) * dy) / n))).otherwise(0.0)
        return F.hypot(x - p["x"] - t * dx, y - p["y"] - t * dy)

    return F.array_min(F.zip_with(a, b, edge))


def _edges(ring: Column) -> Column:
    return F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), _next(ring), lambda p, q: F.struct(p.alias("p"), q.alias("q")))


def _turn(p: Column, q: Column, r: Column) -> Column:
    """Sign of the turn from pq to r."""
    return F.signum((q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"]))


def _between(p: Column, q: Column, r: Column) -> Column:
    """r in the box of pq."""
    return (r["x"] >= F.least(p["x"], q["x"])) & (r["x"] <= F.greatest(p["x"], q["x"])) & (r["y"] >= F.least(p["y"], q["y"])) & (r["y"] <= F.greatest(p["y"], q["y"]))


def edges_meet(e: Column, f: Column) -> Column:
    """Two edges (p, q) share a point."""
    a, b = _turn(e["p"], e["q"], f["p"]), _turn(e["p"], e["q"], f["q"])
    c, d = _turn(f["p"], f["q"], e["p"]), _turn(f["p"], f["q"], e["q"])
    on = ((a == 0) & _between(e["p"], e["q"], f["p"])) | ((b == 0) & _between(e["p"], e["q"], f["q"])) | ((c == 0) & _between(f["p"], f["q"], e["p"])) | ((d == 0) & _between(f["p"], f["q"], e["q"]))
    return ((a * b < 0) & (c * d < 0)) | on


def rings_touch(a: Column, b: Column) -> Column:
    """Two simple polygons share at least a point: edges meet, or one lies inside the other."""
    crossing = F.exists(_edges(a), lambda e: F.exists(_edges(b), lambda f: edges_meet(e, f)))
    held = lambda r, s: point_in_ring(F.element_at(r, 1)["x"], F.element_at(r, 1)["y"], s)
    return crossing | held(a, b) | held(b, a)


# NumPy geometry


def _points(ring) -> np.ndarray:
    if ring is None:
        return np.zeros((0, 2))
    return np.array([(p["x"], p["y"]) for p in ring], dtype=float).reshape(-1, 2)


def clip_convex(subject: np.ndarray, clip: np.ndarray) -> np.ndarray:
    """The part of an open polygon inside a convex, counter-clockwise one (Sutherland-Hodgman)."""
    out = subject
    for p, q in zip(clip, np.roll(clip, -1, axis=0), strict=True):
        if not len(out):
            break
        side = (q[0] - p[0]) * (out[:, 1] - p[1]) - (q[1] - p[1]) * (out[:, 0] - p[0])
        got = []
        for i in range(len(out)):
            a, b, sa, sb = out[i - 1], out[i], side[i - 1], side[i]
            if (sa >= 0) != (sb >= 0):
                got.append(a + (b - a) * (sa / (sa - sb)))
            if sb >= 0:
                got.append(b)
        out = np.array(got).reshape(-1, 2)
    return out


def signed_area(p: np.ndarray) -> float:
    if len(p) < 3:
        return 0.0
    q = np.roll(p, -1, axis=0)
    return float((p[:, 0] * q[:, 1] - q[:, 0] * p[:, 1]).sum() / 2)


def _joined(rings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The points of all rings, and how many each has."""
    return np.concatenate([np.zeros((0, 2)), *rings]), np.array([len(r) for r in rings], np.int64)


def arrow_rings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The same of an Arrow column of rings, without an object a point; null is an empty ring."""
    x, y = column.flatten().flatten()
    return np.stack((x.to_numpy(zero_copy_only=False), y.to_numpy(zero_copy_only=False)), axis=1).astype(float), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _flat_edges(xy: np.ndarray, size: np.ndarray, origin: np.ndarray) -> tuple[np.ndarray, ...]:
    """Edges of all rings, those straight up left out: ring, x from left to right, y at both ends, and the sign with which the area below counts."""
    # a ring without three points has no area
    p = xy[np.repeat(size > 2, size)]
    n, size = len(size), np.where(size > 2, size, 0)
    if not len(p):
        return tuple(np.zeros(0) for _ in range(6))
    ring = np.repeat(np.arange(n), size)
    p = p - origin[ring]
    last = np.cumsum(size)[size > 0] - 1
    after = np.arange(len(p)) + 1
    after[last] -= size[size > 0]
    q = p[after]
    turn = np.sign(np.bincount(ring, p[:, 0] * q[:, 1] - q[:, 0] * p[:, 1], n))[ring]
    right = q[:, 0] > p[:, 0]
    keep = q[:, 0] != p[:, 0]
    l, r = np.where(right[:, None], p, q)[keep], np.where(right[:, None], q, p)[keep]
    # of a ring that turns left, edges to the right have the area above them
    return ring[keep], l[:, 0], r[:, 0], l[:, 1], r[:, 1], (np.where(right, -1.0, 1.0) * turn)[keep]


def _edge_pairs(ka: np.ndarray, kb: np.ndarray, block: int):
    """Places of edges of one pair of rings (ka and kb: the pair of each edge, ascending), in blocks."""
    lo, hi = np.searchsorted(kb, ka, side="left"), np.searchsorted(kb, ka, side="right")
    done = np.cumsum(hi - lo)
    start = 0
    while start < len(ka):
        stop = max(start + 1, int(np.searchsorted(done, (done[start - 1] if start else 0) + block, side="right")))
        count = (hi - lo)[start:stop]
        i = np.repeat(np.arange(start, stop), count)
        yield i, np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + lo[i]
        start = stop


def _corners(xy: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The least x and y of each ring; infinite for an empty one."""
    out = np.full((len(size), 2), np.inf)
    if len(xy):
        out[size > 0] = np.minimum.reduceat(xy, (np.cumsum(size) - size)[size > 0], axis=0)
    return out


def _shared(a: tuple, b: tuple, block: int = 1_000_000) -> np.ndarray:
    n = len(a[1])
    origin = np.minimum(_corners(*a), _corners(*b))
    origin = np.where(np.isfinite(origin), origin, 0.0)
    out = np.zeros(n)
    ka, al, ar, ayl, ayr, sa = _flat_edges(*a, origin)
    kb, bl, br, byl, byr, sb = _flat_edges(*b, origin)
    if not len(ka) or not len(kb):
        return out
    for i, j in _edge_pairs(ka, kb, block):
        l, r = np.maximum(al[i], bl[j]), np.minimum(ar[i], br[j])
        meet = r > l
        i, j, l, r = i[meet], j[meet], l[meet], r[meet]
        fa = lambda x: ayl[i] + (ayr[i] - ayl[i]) * ((x - al[i]) / (ar[i] - al[i]))  # noqa: B023, E731
        fb = lambda x: byl[j] + (byr[j] - byl[j]) * ((x - bl[j]) / (br[j] - bl[j]))  # noqa: B023, E731
        a0, a1, b0, b1 = fa(l), fa(r), fb(l), fb(r)
        d0, d1 = a0 - b0, a1 - b1
        cross = d0 * d1 < 0
        t = np.where(cross, d0 / np.where(cross, d0 - d1, 1.0), 1.0)
        at = a0 + (a1 - a0) * t
        low = (r - l) * ((np.minimum(a0, b0) + np.where(cross, at, np.minimum(a1, b1))) * t + np.where(cross, (at + np.minimum(a1, b1)) * (1 - t), 0.0)) / 2
        out += np.bincount(ka[i], sa[i] * sb[j] * low, n)
    return np.maximum(out, 0.0)


def shared_areas(a: list[np.ndarray], b: list[np.ndarray], block: int = 1_000_000) -> np.ndarray:
    """Areas common to pairs of simple polygons, all pairs at once.

    A polygon is the signed sum of what lies below its edges, so what two share is the sum over pairs of their edges of what lies below both: the integral of
    the lower of two straight lines.
    """
    return _shared(_joined(a), _joined(b), block)


def _touching(a: tuple, b: tuple, block: int = 1_000_000) -> np.ndarray:
    """rings_touch for pairs of closed rings, all pairs at once."""
    n = len(a[1])
    out = np.zeros(n, bool)

    def edges(xy, size):
        begins = np.ones(len(xy), bool)
        begins[np.cumsum(size)[size > 0] - 1] = False
        k = np.flatnonzero(begins)
        return np.repeat(np.arange(n), size)[k], xy[k], xy[k + 1]

    (ka, p, q), (kb, u, v) = edges(*a), edges(*b)
    turn = lambda p, q, r: np.sign((q[:, 0] - p[:, 0]) * (r[:, 1] - p[:, 1]) - (q[:, 1] - p[:, 1]) * (r[:, 0] - p[:, 0]))
    near = lambda p, q, r: ((r >= np.minimum(p, q)) & (r <= np.maximum(p, q))).all(axis=1)
    for i, j in _edge_pairs(ka, kb, block):
        close = ((np.minimum(p[i], q[i]) <= np.maximum(u[j], v[j])) & (np.minimum(u[j], v[j]) <= np.maximum(p[i], q[i]))).all(axis=1)
        i, j = i[close], j[close]
        e, f, g, h = p[i], q[i], u[j], v[j]
        s, t, c, d = turn(e, f, g), turn(e, f, h), turn(g, h, e), turn(g, h, f)
        on = ((s == 0) & near(e, f, g)) | ((t == 0) & near(e, f, h)) | ((c == 0) & near(g, h, e)) | ((d == 0) & near(g, h, f))
        out[ka[i[((s * t < 0) & (c * d < 0)) | on]]] = True
    for (xy, size), (k, e, f) in ((a, (kb, u, v)), (b, (ka, p, q))):
        # the first point of one, by a ray through the edges of the other
        first = np.full((n, 2), np.nan)
        first[size > 0] = xy[(np.cumsum(size) - size)[size > 0]]
        x, y = first[k, 0], first[k, 1]
        with np.errstate(divide="ignore", invalid="ignore"):
            cut = ((e[:, 1] > y) != (f[:, 1] > y)) & (x < (f[:, 0] - e[:, 0]) * (y - e[:, 1]) / (f[:, 1] - e[:, 1]) + e[:, 0])
        out |= (np.bincount(k[cut], minlength=n) % 2 == 1) & (size > 0)
    return out


def _at(rings: tuple[np.ndarray, np.ndarray], places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rings at these places."""
    xy, size = rings
    n = size[places]
    return xy[np.repeat((np.cumsum(size) - size)[places] - np.cumsum(n) + n, n) + np.arange(n.sum())], n


#: What bounds leave open by rounding, relative and absolute.
SLACK = 1e-6


def _near(a: dict, b: dict, spot: tuple[int, int], cell: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of polygons of two blocks whose bounds share a point, in the bin that holds the lower-left corner of what they share."""
    met = True
    for lo, hi, at in (("x0", "x1", spot[0]), ("y0", "y1", spot[1])):
        met &= (a[lo][:, None] <= b[hi]) & (b[lo] <= a[hi][:, None])
        # neither begins after the bin, one begins in it
        met &= (np.floor(a[lo] / cell) == at)[:, None] | (np.floor(b[lo] / cell) == at)
    return np.nonzero(met)


def _most(a: dict, b: dict, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Upper bound of the iou of pairs of polygons: they share no more than their bounds do, nor more than the smaller of them."""
    w, h = (np.minimum(a[hi][i], b[hi][j]) - np.maximum(a[lo][i], b[lo][j]) for lo, hi in (("x0", "x1"), ("y0", "y1")))
    p, q = a["area"][i], b["area"][j]
    shared = np.minimum(np.maximum(w, 0) * np.maximum(h, 0), np.minimum(p, q))
    union = p + q - shared
    known = union > 0
    return np.where(known, shared / np.where(known, union, 1.0), 1.0) * (1 + SLACK) + SLACK


def _outlines(rings: tuple, corner: np.ndarray) -> tuple[np.ndarray, ...]:
    """_flat_edges of a block from one corner: where each ring's edges begin and how many they are, then of each edge both x, the y on the left, slope and sign."""
    xy, size = rings
    ring, l, r, yl, yr, sign = _flat_edges(xy, size, np.broadcast_to(corner, (len(size), 2)))
    count = np.bincount(ring.astype(np.int64), minlength=len(size))
    return np.cumsum(count) - count, count, l, r, yl, (yr - yl) / (r - l), sign


def _shared_at(a: tuple, b: tuple, u: np.ndarray, v: np.ndarray, block: int = 16_384) -> np.ndarray:
    """shared_areas of the pairs of rings at u and v of two blocks (`_outlines`), some `block` pairs of edges at a time: few enough to stay near the processor."""
    (abegin, acount, al, ar, ay, am, sa), (bbegin, bcount, bl, br, by, bm, sb) = a, b
    out = np.zeros(len(u))
    done = np.cumsum(acount[u] * bcount[v])
    start = 0
    while start < len(u):
        stop = max(start + 1, int(np.searchsorted(done, (done[start - 1] if start else 0) + block, side="right")))
        na, nb = acount[u[start:stop]], bcount[v[start:stop]]
        # each edge of the left one, then with each of the right one
        of = np.repeat(np.arange(stop - start), na)
        i = np.arange(len(of)) + np.repeat(abegin[u[start:stop]] - np.cumsum(na) + na, na)
        n = nb[of]
        j = np.arange(n.sum()) + np.repeat(bbegin[v[start:stop]][of] - np.cumsum(n) + n, n)
        of, i = np.repeat(of, n), np.repeat(i, n)
        l, r = np.maximum(al[i], bl[j]), np.minimum(ar[i], br[j])
        meet = np.flatnonzero(r > l)
        of, i, j, l, r = of[meet], i[meet], j[meet], l[meet], r[meet]
        wide, ma, mb = r - l, am[i], bm[j]
        a0, b0 = ay[i] + ma * (l - al[i]), by[j] + mb * (l - bl[j])
        a1, b1 = a0 + ma * wide, b0 + mb * wide
        d0, d1 = a0 - b0, a1 - b1
        # the lower one of both ends; where they cross, the triangle above as well
        low = np.minimum(a0, b0) + np.minimum(a1, b1)
        cross = np.flatnonzero(d0 * d1 < 0)
        p, q = np.abs(d0[cross]), np.abs(d1[cross])
        low[cross] += p * q / (p + q)
        out[start:stop] = np.bincount(of, sa[i] * sb[j] * low * wide / 2, stop - start)
        start = stop
    return np.maximum(out, 0.0)


def block_overlaps(cell: float, left: list[str], right: list[str], low: str | None, first: bool, touch: bool, far: bool, rows: int = 65_536):
    """For rows of two blocks of polygons in one bin: the pairs that share an area, or only touch (touch), with columns of either side, both areas, the shared one and the distance of their middles (far).

    Bounds are compared for the blocks at once, what is left by its edges. low, first: see `agreement._ring_pairs`."""

    def side(column: pa.Array, p: str) -> tuple[pa.StructArray, dict, tuple]:
        held = column.flatten()
        number = lambda c: c.to_numpy(zero_copy_only=False).astype(float)
        known = {k: number(held.field(f"_{p}{k}")) for k in ("x0", "y0", "x1", "y1", "area")}
        if far:
            known["mx"], known["my"] = map(number, held.field(f"_{p}mid").flatten())
        return held, known, arrow_rings(held.field(f"{p}ring"))

    def pairs(spot, l, r):
        (lheld, a, lrings), (rheld, b, rrings) = side(l, "l_"), side(r, "r_")
        i, j = _near(a, b, spot, cell)
        if first:
            order = np.lexsort((-_most(a, b, i, j), i))
            order = order[np.diff(i[order], prepend=-1) > 0]
            i, j = i[order], j[order]
        elif low:
            some = _most(a, b, i, j) >= lheld.field(low).to_numpy(zero_copy_only=False)[i]
            i, j = i[some], j[some]
        corner = np.array(spot) * cell
        a["edges"], b["edges"] = _outlines(lrings, corner), _outlines(rrings, corner)
        for start in range(0, len(i), rows):
            u, v = i[start : start + rows], j[start : start + rows]
            area = _shared_at(a["edges"], b["edges"], u, v)
            met = area > 0
            if touch:
                # an area far above the error of rounding needs no test of edges
                extent = [np.maximum(a[hi][u], b[hi][v]) - np.minimum(a[lo][u], b[lo][v]) for lo, hi in (("x0", "x1"), ("y0", "y1"))]
                met = area > 1e-6 * extent[0] * extent[1]
                open_ = np.flatnonzero(~met)
                met[open_] = _touching(_at(lrings, u[open_]), _at(rrings, v[open_]))
            u, v, area = u[met], v[met], area[met]
            of = lambda held, names, at: [held.field(c).take(pa.array(at)) for c in names]
            columns = [*of(lheld, left, u), *of(rheld, right, v), *of(lheld, ["_l_area"], u), *of(rheld, ["_r_area"], v), pa.array(area)]
            if far:
                columns.append(pa.array(np.hypot(a["mx"][u] - b["mx"][v], a["my"][u] - b["my"][v]), from_pandas=True))
            yield pa.RecordBatch.from_arrays(columns, names=[*left, *right, "_l_area", "_r_area", "shared_area", *["centroid_distance"] * far])

    def run(batches):
        for batch in batches:
            x, y = (batch.column(k).to_pylist() for k in ("_gx", "_gy"))
            for k in range(batch.num_rows):
                yield from pairs((x[k], y[k]), batch.column("_l_block").slice(k, 1), batch.column("_r_block").slice(k, 1))

    return run


@F.arrow_udf(T.BooleanType())
def rings_meet(a: pa.Array, b: pa.Array) -> pa.Array:
    """rings_touch for a batch of pairs at once; a null ring touches none."""
    return pa.array(_touching(arrow_rings(a), arrow_rings(b)))


def _in_and_near(x: np.ndarray, y: np.ndarray, xy: np.ndarray, size: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Whether points lie inside closed rings, and whether within reach of their outlines: a point and a ring each."""
    n = len(size)
    begins = np.ones(len(xy), bool)
    begins[np.cumsum(size)[size > 0] - 1] = False
    k = np.flatnonzero(begins)
    of, px, py, qx, qy = np.repeat(np.arange(n), size)[k], xy[k, 0], xy[k, 1], xy[k + 1, 0], xy[k + 1, 1]
    u, v, dx, dy = x[of] - px, y[of] - py, qx - px, qy - py
    with np.errstate(divide="ignore", invalid="ignore"):
        cut = ((py > y[of]) != (qy > y[of])) & (x[of] < dx * v / dy + px)
        long = dx * dx + dy * dy
        t = np.where(long > 0, np.clip((u * dx + v * dy) / long, 0.0, 1.0), 0.0)
    near = np.zeros(n, bool)
    near[of[np.round(np.hypot(u - t * dx, v - t * dy), 6) <= reach]] = True
    return np.bincount(of[cut], minlength=n) % 2 == 1, near


def ring_places(reach: float):
    """For a point (x, y) and a ring: 1 if it lies inside, plus 2 if it lies within reach of the outline (to six digits); a batch at once."""

    @F.arrow_udf(T.IntegerType())
    def run(x: pa.Array, y: pa.Array, ring: pa.Array) -> pa.Array:
        number = lambda c: c.to_numpy(zero_copy_only=False).astype(float)
        inside, near = _in_and_near(number(x), number(y), *arrow_rings(ring), reach)
        return pa.array(inside + 2 * near, pa.int32())

    return lambda x, y, ring: run(x.cast("double"), y.cast("double"), ring)


def shared_area(a: np.ndarray, b: np.ndarray) -> float:
    """Area common to two simple polygons."""
    return float(shared_areas([a], [b])[0])


@F.arrow_udf(T.DoubleType())
def polygon_shared_area(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array(_shared(arrow_rings(a), arrow_rings(b)))


@F.pandas_udf(T.DoubleType())
def hausdorff(a: pd.Series, b: pd.Series) -> pd.Series:
    """Discrete Hausdorff distance between the vertices of two rings."""

    def one(p: np.ndarray, q: np.ndarray) -> float:
        if not len(p) or not len(q):
            return math.nan
        far, near = 0.0, np.full(len(q), np.inf)
        step = max(1, 1_000_000 // len(q))
        for k in range(0, len(p), step):
            # a block of the distances at a time
            d = np.hypot(p[k : k + step, None, 0] - q[None, :, 0], p[k : k + step, None, 1] - q[None, :, 1])
            far, near = max(far, float(d.min(1).max())), np.minimum(near, d.min(0))
        return max(far, float(near.max()))

    return pd.Series([one(_points(p), _points(q)) for p, q in zip(a, b, strict=True)], dtype=float)


def _hull(p: np.ndarray) -> np.ndarray:
    pts = sorted(map(tuple, p))
    if len(set(pts)) < 3:
        return np.array(sorted(set(pts)), dtype=float).reshape(-1, 2)

    def half(points):
        out = []
        for q in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    return np.array(half(pts) + half(pts[::-1]), dtype=float)


def rotated_rectangle(p: np.ndarray) -> np.ndarray:
    """Corners of the smallest rectangle, at any angle, that holds the points."""
    hull = _hull(p)
    best, corners = math.inf, hull
    for a, b in zip(hull, np.roll(hull, -1, axis=0), strict=True):
        n = math.hypot(*(b - a))
        if not n:
            continue
        u = (b - a) / n
        turn = np.array([u, [-u[1], u[0]]])
        q = hull @ turn.T
        lo, hi = q.min(0), q.max(0)
        if (area := float(np.prod(hi - lo))) < best:
            best, corners = area, np.array([lo, [hi[0], lo[1]], hi, [lo[0], hi[1]]]) @ turn
    return corners


@F.pandas_udf(T.DoubleType())
def orientation(ring: pd.Series) -> pd.Series:
    """atan2(height, width) of the bounds of the smallest rotated rectangle."""

    def one(p: np.ndarray) -> float:
        if len(p) < 3:
            return math.nan
        c = rotated_rectangle(p)
        return math.atan2(float(np.ptp(c[:, 1])), float(np.ptp(c[:, 0])))

    return pd.Series([one(_points(p)) for p in ring], dtype=float)


@F.pandas_udf(RING)
def clip_to_box(ring: pd.Series, x0: pd.Series, y0: pd.Series, x1: pd.Series, y1: pd.Series) -> pd.Series:
    """The part of a ring inside a box; null if none."""

    def one(p, a, b, c, d):
        p = p[:-1] if len(p) > 1 and (p[0] == p[-1]).all() else p
        got = clip_convex(p, np.array([[a, b], [c, b], [c, d], [a, d]], dtype=float)) if len(p) >= 3 else p[:0]
        if len(got) < 3:
            return None
        return [{"x": float(x), "y": float(y)} for x, y in [*got, got[0]]]

    return pd.Series([one(_points(p), *b) for p, *b in zip(ring, x0, y0, x1, y1, strict=True)], dtype=object)


def simplify_points(p: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas-Peucker on a line of points, without recursion."""
    keep, todo = np.zeros(len(p), dtype=bool), [(0, len(p) - 1)]
    if len(p):
        keep[[0, -1]] = True
    while todo:
        i, j = todo.pop()
        if j <= i + 1:
            continue
        a, b = p[i], p[j]
        n = math.hypot(*(b - a))
        q = p[i + 1 : j] - a
        d = np.abs((b - a)[0] * q[:, 1] - (b - a)[1] * q[:, 0]) / n if n else np.hypot(q[:, 0], q[:, 1])
        k = int(d.argmax())
        if d[k] > tolerance:
            keep[i + 1 + k] = True
            todo += [(i, i + 1 + k), (i + 1 + k, j)]
    return p[keep]


def simplify(tolerance: float):
    @F.pandas_udf(RING)
    def run(ring: pd.Series) -> pd.Series:
        return pd.Series([[{"x": float(x), "y": float(y)} for x, y in simplify_points(_points(p), tolerance)] for p in ring], dtype=object)

    return run


def utm(lon: Column, lat: Column, zone: Column) -> Column:
    """Struct (x, y): transverse Mercator on WGS84 by the usual series to the sixth order; north of the equator without offset."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep = e2 / (1 - e2)
    phi, lam = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    n = a / F.sqrt(1 - e2 * F.pow(F.sin(phi), 2))
    t, c, big = F.pow(F.tan(phi), 2), ep * F.pow(F.cos(phi), 2), F.cos(phi) * lam
    m = a * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi
        - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * F.sin(2 * phi)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * F.sin(4 * phi)
        - (35 * e2**3 / 3072) * F.sin(6 * phi)
    )
    x = k0 * n * (big + (1 - t + c) * F.pow(big, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep) * F.pow(big, 5) / 120) + 500000
    y = k0 * (m + n * F.tan(phi) * (big * big / 2 + (5 - t + 9 * c + 4 * c * c) * F.pow(big, 4) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep) * F.pow(big, 6) / 720))
    return F.struct(x.alias("x"), F.when(lat >= 0, y).otherwise(y + 10_000_000).alias("y"))


def utm_inverse(x: Column, y: Column, zone: Column, south: bool) -> Column:
    """Struct (lon, lat) in degrees: the inverse of `utm`, by the usual footpoint series."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep, e1 = e2 / (1 - e2), (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    mu = (y - (10_000_000 if south else 0)) / k0 / (a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    foot = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + (151 * e1**3 / 96) * F.sin(6 * mu) + (1097 * e1**4 / 512) * F.sin(8 * mu)
    w = 1 - e2 * F.pow(F.sin(foot), 2)
    n, r = a / F.sqrt(w), a * (1 - e2) / F.pow(w, 1.5)
    t, c, d = F.pow(F.tan(foot), 2), ep * F.pow(F.cos(foot), 2), (x - 500000) / (n * k0)
    lat = foot - n * F.tan(foot) / r * (d * d / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * ep) * F.pow(d, 4) / 24 + (61 + 90 * t + 298 * c + 45 * t * t - 252 * ep - 3 * c * c) * F.pow(d, 6) / 720)
    lon = (d - (1 + 2 * t + c) * F.pow(d, 3) / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * ep + 24 * t * t) * F.pow(d, 5) / 120) / F.cos(foot)
    return F.struct((F.degrees(lon) + zone * 6 - 183).alias("lon"), F.degrees(lat).alias("lat"))


@F.pandas_udf(T.StructType([T.StructField(k, T.DoubleType()) for k in ("x0", "y0", "x1", "y1")]))
def _projected_bounds(x0: pd.Series, y0: pd.Series, x1: pd.Series, y1: pd.Series, zone: pd.Series, points: pd.Series) -> pd.DataFrame:
    a, b, c, d = (v.to_numpy(dtype=float)[:, None] for v in (x0, y0, x1, y1))
    zone, n = zone.to_numpy(dtype=float)[:, None], int(points.iloc[0]) if len(points) else 1
    s = np.arange(n + 1)[None] / n
    lon = np.concatenate((a + (c - a) * s, a + (c - a) * s, a + 0 * s, c + 0 * s), axis=1)
    lat = np.concatenate((b + 0 * s, d + 0 * s, b + (d - b) * s, b + (d - b) * s), axis=1)
    x, y = projection.utm(lon, lat, zone, False, projection.ARRAYS)
    y = np.where(lat >= 0, y, y + 10_000_000)
    out = pd.DataFrame({"x0": x.min(axis=1), "y0": y.min(axis=1), "x1": x.max(axis=1), "y1": y.max(axis=1)})
    return out.astype(object).where(out.notna(), None) if out.isna().any(axis=None) else out


def densified_bounds(x0: Column, y0: Column, x1: Column, y1: Column, zone: Column, points: int = 21) -> Column:
    """Bounds of a lon/lat box after projection, from `points` + 1 samples on each edge."""
    return _projected_bounds(*[c.cast("double") for c in (x0, y0, x1, y1, zone)], F.lit(points))
