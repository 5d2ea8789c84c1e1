"""Unions of polygons, repair of self-crossing ones and outlines of pixel regions, as rings with holes.

Polygons are cut at the lines of a grid of cells and each cell is solved alone (functions/planar). What bounds the area inside a cell is kept as
paths from border to border; pieces that lie on a border are cancelled against those of the cell across, and the paths are linked end to end by
joins. A ring is put together in one row, as it has to be returned; its label comes from pointer jumping over its paths, so the number of
rounds grows with the logarithm of their number.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.functions import planar as P
from fieldloom.functions.shared import settled, spread

from .raster import least_labels, stacked

PIECES = 2_000  # polygons of one cell that are solved together
LEVELS = 30  # doublings of a cell's side
RINGS = "array<struct<x:double,y:double>>"
PARTS = f"ring {RINGS}, holes array<{RINGS}>, area double"
PATH = "kind string, xs array<bigint>, ys array<bigint>"


def _open(ring, grid: float) -> np.ndarray | None:
    """A ring of points as whole numbers of `grid`, first point not repeated, turning left; null if it has no area."""
    if ring is None or len(ring) < 3 or any(p is None for p in ring):
        return None
    xy = np.array([(p["x"], p["y"]) for p in ring], dtype=float)
    if not np.isfinite(xy).all():
        return None
    p = np.rint(xy / grid).astype(np.int64)
    p = p[(p != np.roll(p, 1, axis=0)).any(axis=1)]
    if len(p) < 3:
        return None
    size = P.area(p)
    return None if size == 0 else p if size > 0 else p[::-1]


def _points(ring: np.ndarray, grid: float) -> list[dict]:
    every = np.concatenate((ring, ring[:1])).astype(float) * grid
    return [{"x": x, "y": y} for x, y in every.tolist()]


def _frame(rows: list, *columns: str) -> pd.DataFrame:
    # Arrow takes empty columns only if pandas does not think that they are numbers
    return pd.DataFrame(rows, columns=list(columns), dtype=object)


def _cut(cell: int, grid: float):
    def run(frames):
        for df in frames:
            rows = []
            for k, ring in zip(df["by"], df["ring"], strict=True):
                r = _open(ring, grid)
                if r is not None:
                    rows += [(k, gx, gy, part[:, 0].tolist(), part[:, 1].tolist()) for gx, gy, part in P.cells(P.split_at_lines(r, cell), cell)]
            yield _frame(rows, "by", "gx", "gy", "xs", "ys")

    return run


#: Polygons that are united at first, and unions at each further step.
FIRST, NEXT = 32, 6


def _united(df: pd.DataFrame, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The boundary of the union: of some at a time, then of what these leave, so that what lies deep inside is dropped before it meets the rest."""
    rings = sorted({(tuple(x), tuple(y)) for x, y in zip(df["xs"], df["ys"], strict=True)})
    rings = [np.array(r, np.int64).T - base for r in rings]
    found, n = [(r, np.roll(r, -1, axis=0)) for r in rings], FIRST
    while True:
        found = [P.boundary(np.concatenate([a for a, _ in found[k : k + n]]), np.concatenate([b for _, b in found[k : k + n]])) for k in range(0, len(found), n)]
        if len(found) == 1:
            return found[0]
        n = NEXT


def _solve(cell: int, last: bool):
    """One cell: the boundary of its union, as rings again or, at last, as paths between its borders and pieces on them."""

    def run(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        gx, gy = int(df["gx"].iloc[0]), int(df["gy"].iloc[0])
        base = np.array([gx, gy], np.int64) * cell
        a, b = _united(df, base)
        rows = []
        if not last:
            rows = [("ring", r) for r in P.rings(a, b)]
        else:
            rows = _paths(a, b, cell)
        by = df["by"].iloc[0]
        return _frame([(by, gx, gy, k, (r[:, 0] + base[0]).tolist(), (r[:, 1] + base[1]).tolist()) for k, r in rows], "by", "gx", "gy", "kind", "xs", "ys")

    return run


def _paths(a: np.ndarray, b: np.ndarray, cell: int) -> list[tuple[str, np.ndarray]]:
    border = lambda p: ((p == 0) | (p == cell)).any(axis=1)
    on = ((a == b) & ((a == 0) | (a == cell))).any(axis=1)
    inner = np.flatnonzero(~on)
    paths, closed = P.chains(a[inner], b[inner], border(b[inner]))
    rows = [("seam", np.stack((a[k], b[k]))) for k in np.flatnonzero(on).tolist()]
    rows += [("path", r) for r in paths]
    return rows + [("ring", r) for walk in closed for r in P.loops(list(map(tuple, walk.tolist())))]


def _cancelled(seams: DataFrame, cell: int) -> DataFrame:
    """What only one side of each border covers: the pieces on a line, with their directions, summed up along it."""
    x, y = F.col("xs"), F.col("ys")
    level = y[0] == y[1]
    a, b = F.when(level, x[0]).otherwise(y[0]), F.when(level, x[1]).otherwise(y[1])
    way = F.when(a < b, 1).otherwise(-1)
    ends = seams.select("by", level.alias("level"), F.when(level, y[0]).otherwise(x[0]).alias("line"), F.floor(F.least(a, b) / cell).alias("along"),
                        F.explode(F.array(F.struct(F.least(a, b).alias("at"), way.alias("turn")), F.struct(F.greatest(a, b).alias("at"), (-way).alias("turn")))).alias("e"))
    line = ["by", "level", "line", "along"]
    steps = ends.groupBy(*line, "e.at").agg(F.sum("e.turn").alias("turn"))
    ordered = W.partitionBy(*line).orderBy("at")
    net = steps.withColumn("net", F.sum("turn").over(ordered)).withColumn("to", F.lead("at").over(ordered)).filter("net <> 0 and to is not null")
    along = F.when(F.col("net") > 0, F.array("at", "to")).otherwise(F.array("to", "at"))
    across = F.array("line", "line")
    return net.select("by", F.when(F.col("level"), along).otherwise(across).alias("xs"), F.when(F.col("level"), across).otherwise(along).alias("ys"))


def _labelled(arcs: DataFrame) -> DataFrame:
    """arcs (by, id, next) with `label`, the smallest id of the ring that each belongs to: pointers double until no label changes."""
    now = settled(arcs.select("by", "id", F.col("next").alias("to"), F.col("id").alias("label")), "labels")
    while True:
        far = now.select(F.col("by").alias("_b"), F.col("id").alias("_i"), F.col("to").alias("_t"), F.col("label").alias("_l"))
        step = now.join(far, F.col("by").eqNullSafe(F.col("_b")) & (F.col("to") == F.col("_i")))
        step = step.select("by", "id", F.col("_t").alias("to"), F.least("label", "_l").alias("label"), (F.col("_l") < F.col("label")).alias("moved"))
        step = settled(step, "labels")
        now = step.drop("moved")
        if step.filter("moved").isEmpty():
            return now.drop("to")


def _assemble(batches):
    """Each row's paths put together from the smallest id along `next`, and cut into rings where they meet themselves."""
    for batch in batches:
        by, xs, ys = [], [], []
        for k, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            name = lambda i: (i["x"], i["y"], i["u"], i["v"])
            path = {name(p["id"]): p for p in parts}
            at, walk = min(path), []
            while at in path:
                p = path.pop(at)
                walk += zip(p["xs"][:-1], p["ys"][:-1], strict=True)
                at = name(p["next"])
            for r in P.loops(walk):
                by.append(k)
                xs.append(r[:, 0].tolist())
                ys.append(r[:, 1].tolist())
        yield pa.record_batch([pa.array(by, batch.schema.field(0).type), pa.array(xs, pa.list_(pa.int64())), pa.array(ys, pa.list_(pa.int64()))], names=["by", "xs", "ys"])


def link_paths(found: DataFrame, cell: int, kind: str) -> DataFrame:
    """Rings (by, xs, ys) from what the cells left (by, kind, xs, ys; kind: ring, seam or path). kind (the argument): the type of `by`."""
    found = settled(found, "paths")
    x, y = F.col("xs"), F.col("ys")
    seams = _cancelled(found.filter("kind = 'seam'"), cell)
    arcs = found.filter("kind = 'path'").select("by", "xs", "ys").unionByName(seams)
    n = F.size("xs")
    end = lambda k: F.struct(F.element_at("xs", k).alias("x"), F.element_at("ys", k).alias("y"))
    away = lambda p, q: F.atan2(q["y"] - p["y"], q["x"] - p["x"])
    ident = F.struct(x[0].alias("x"), y[0].alias("y"), x[1].alias("u"), y[1].alias("v"))
    arcs = settled(arcs.filter(n > 1).withColumn("id", ident), "arcs")
    starts = arcs.select("by", end(1).alias("p"), away(end(1), end(2)).alias("angle"), F.col("id").alias("begins"), F.lit(None).cast(arcs.schema["id"].dataType).alias("ends"))
    stops = arcs.select("by", end(-1).alias("p"), away(end(-1), end(-2)).alias("angle"), F.lit(None).cast(arcs.schema["id"].dataType).alias("begins"), F.col("id").alias("ends"))
    # round each point: a path that ends is followed by the last that begins before it, turning left
    point = W.partitionBy("by", "p")
    before = F.last("begins", ignorenulls=True).over(point.orderBy("angle").rowsBetween(W.unboundedPreceding, -1))
    final = F.max(F.when(F.col("begins").isNotNull(), F.struct("angle", "begins"))).over(point)
    pairs = starts.unionByName(stops).withColumn("next", F.coalesce(before, final["begins"])).filter("ends is not null")
    pairs = settled(pairs.select("by", F.col("ends").alias("id"), "next"), "pairs")
    labels = _labelled(pairs.filter("next is not null"))
    same = lambda a, b: a["by"].eqNullSafe(b["by"]) & (a["id"] == b["id"])
    whole = arcs.join(pairs, same(arcs, pairs)).join(labels, same(arcs, labels)).select(arcs["by"], arcs["id"], "next", "label", "xs", "ys")
    # a ring is one row, as it has to be returned
    parts = whole.groupBy("by", "label").agg(F.collect_list(F.struct("id", "next", "xs", "ys")).alias("parts")).select("by", "parts")
    rings = parts.mapInArrow(_assemble, f"by {kind}, xs array<bigint>, ys array<bigint>")
    return found.filter("kind = 'ring'").select("by", "xs", "ys").unionByName(rings)


def _measured(grid: float, kind: str):
    def run(frames):
        for df in frames:
            rows = []
            for k, x, y in zip(df["by"], df["xs"], df["ys"], strict=True):
                r = np.stack((np.asarray(x, np.int64), np.asarray(y, np.int64)), axis=1)
                rows.append((k, P.area(r), *(int(v) for v in (*r.min(axis=0), *r.max(axis=0))), x, y))
            yield _frame(rows, "by", "size", "x0", "y0", "x1", "y1", "xs", "ys")

    return run, f"by {kind}, size double, x0 bigint, y0 bigint, x1 bigint, y1 bigint, xs array<bigint>, ys array<bigint>"


def _around(batches):
    """Shells and holes that may lie in them: those that do."""
    for batch in batches:
        out = {"hole": [], "shell": [], "size": []}
        for shell, size, xs, ys, near in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ring = np.stack((np.array(xs, np.int64), np.array(ys, np.int64)), axis=1)
            base = ring.min(axis=0)
            mid = np.array([(h["mx"], h["my"]) for h in near], np.int64) - 2 * base
            for h, inside in zip(near, P.holds(ring - base, mid).tolist(), strict=True):
                if inside:
                    out["hole"].append(h["hole"])
                    out["shell"].append(shell)
                    out["size"].append(size)
        yield pa.record_batch([pa.array(out["hole"], pa.string()), pa.array(out["shell"], pa.string()), pa.array(out["size"], pa.float64())], names=list(out))


def polygons(rings: DataFrame, cell: int, grid: float, kind: str) -> DataFrame:
    """Rings (by, xs, ys) as parts: by, ring, holes, area. A hole goes to the smallest shell around it, found by its bounds and then by its edges."""
    run, schema = _measured(grid, kind)
    rings = settled(rings.mapInPandas(run, schema).withColumn("id", F.struct("by", "size", "x0", "y0", "x1", "y1", F.xxhash64("xs", "ys").alias("h"))), "rings")
    shells, holes = rings.filter("size > 0"), rings.filter("size < 0")
    # bins of cell * 2^level: a shell goes to the level of its own width, where it covers two bins a side at most; a hole asks all levels
    wide = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0")).cast("double")
    level = F.least(F.greatest(F.ceil(F.log2(wide / cell)), F.lit(0)), F.lit(LEVELS)).cast("int")
    bins = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / F.col("width")), F.floor(F.col(b) / F.col("width"))))
    s = shells.select(F.col("id").alias("shell"), F.col("by").alias("_by"), F.col("size").alias("_s"), *[F.col(c).alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")])
    s = s.withColumn("level", level).withColumn("width", F.lit(cell) * F.pow(F.lit(2.0), F.col("level"))).withColumn("gx", bins("_x0", "_x1")).withColumn("gy", bins("_y0", "_y1"))
    h = holes.select(F.col("id").alias("hole"), "by", "size", "x0", "y0", "x1", "y1", (F.col("xs")[0] + F.col("xs")[1]).alias("mx"), (F.col("ys")[0] + F.col("ys")[1]).alias("my"))
    h = h.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS)))).withColumn("_width", F.lit(cell) * F.pow(F.lit(2.0), F.col("_level")))
    h = h.withColumns({"_gx": F.floor(F.col("x0") / F.col("_width")), "_gy": F.floor(F.col("y0") / F.col("_width"))})
    near = h.join(s, (F.col("level") == F.col("_level")) & (F.col("gx") == F.col("_gx")) & (F.col("gy") == F.col("_gy")) & F.col("by").eqNullSafe(F.col("_by")))
    near = near.filter("x0 >= _x0 and y0 >= _y0 and x1 <= _x1 and y1 <= _y1 and _s > -size").select("hole", "shell", "mx", "my")
    asked = near.groupBy(F.to_json("shell").alias("shell")).agg(F.collect_list(F.struct(F.to_json("hole").alias("hole"), "mx", "my")).alias("near"))
    pairs = shells.select(F.to_json("id").alias("shell"), "size", "xs", "ys").join(asked, "shell")
    inside = pairs.select("shell", "size", "xs", "ys", "near").mapInArrow(_around, "hole string, shell string, size double")
    owner = inside.groupBy("hole").agg(F.min_by("shell", "size").alias("shell"))
    scale = lambda c: F.transform(F.concat(F.col(c), F.slice(F.col(c), 1, 1)), lambda v: v * F.lit(float(grid)))
    shown = F.zip_with(scale("xs"), scale("ys"), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    drawn = rings.select("by", "size", F.to_json("id").alias("k"), shown.alias("ring"))
    held = drawn.filter("size < 0").join(owner, F.col("k") == F.col("hole")).groupBy("shell").agg(F.collect_list("ring").alias("holes"), F.sum("size").alias("gone"))
    out = drawn.filter("size > 0").join(held, F.col("k") == F.col("shell"), "left")
    area = (F.col("size") + F.coalesce("gone", F.lit(0.0))) * float(grid) * float(grid)
    return out.select("by", "ring", F.coalesce("holes", F.array().cast(f"array<{RINGS}>")).alias("holes"), area.alias("area"))


def dissolve(fields: DataFrame, ring: str = "ring", by: str | Column | None = None, cell: float = 2560.0, grid: float = 1e-5) -> DataFrame:
    """The union of polygons (of each `by`) as parts without common edges: by, ring, holes, area.

    Coordinates are rounded to `grid`; a cell is to be narrower than 2^29 of it. A cell with very many polygons is first solved in shares of some 2,000,
    dealt by hash, and then from what these leave. Parts that touch in a point stay apart. Null, empty and flat rings add nothing; rings turn either way.
    """
    side = int(round(cell / grid))
    if not 1 < side < P.LIMIT:
        raise ValueError("a cell has to be between 1 and 2^29 grid steps wide")
    by = F.lit(None).cast("int") if by is None else F.col(by) if isinstance(by, str) else by
    given = fields.select(by.alias("by"), F.col(ring).alias("ring"))
    kind = given.schema["by"].dataType.simpleString()
    # copies add nothing to a union
    pieces = settled(spread(given.distinct()).mapInPandas(_cut(side, grid), f"by {kind}, gx bigint, gy bigint, xs array<bigint>, ys array<bigint>"), "pieces")
    count = pieces.groupBy(F.col("by").alias("_b"), F.col("gx").alias("_x"), F.col("gy").alias("_y")).agg(F.ceil(F.count(F.lit(1)) / PIECES).alias("shares")).filter("shares > 1")
    full = pieces.join(count, F.col("by").eqNullSafe(F.col("_b")) & (F.col("gx") == F.col("_x")) & (F.col("gy") == F.col("_y")), "left").drop("_b", "_x", "_y")
    schema = f"by {kind}, gx bigint, gy bigint, {PATH}"
    share = F.pmod(F.xxhash64("xs", "ys"), F.col("shares"))
    crowded = full.filter("shares is not null").withColumn("share", share).groupBy("by", "gx", "gy", "share").applyInPandas(_solve(side, False), schema)
    rest = full.filter("shares is null").select("by", "gx", "gy", "xs", "ys").unionByName(crowded.select("by", "gx", "gy", "xs", "ys"))
    found = rest.groupBy("by", "gx", "gy").applyInPandas(_solve(side, True), schema)
    return polygons(link_paths(found.select("by", "kind", "xs", "ys"), side, kind), side, grid, kind)


def repaired(fields: DataFrame, ring: str = "ring", grid: float = 1e-5) -> DataFrame:
    """fields with their polygons made valid: a row for each part, with `part` (0 .. by falling area), `ring`, `holes`, `area`.

    A ring that crosses itself becomes the area that it goes round an odd number of times: bow ties fall apart, edges there and back vanish, a loop inside
    becomes a hole; a ring that runs several times round counts once. Rows that have no area are dropped (null, empty and flat rings too).
    """

    def form_parts():
        @lru_cache(FORMS)
        def solve(form: bytes) -> list:
            p = np.frombuffer(form, np.int64).reshape(-1, 2)
            a, b = P.boundary(p, np.roll(p, -1, axis=0), odd=True)
            return P.with_holes(P.rings(a, b))

        return lambda points: _parts(points, grid, solve)

    return _with_parts(fields, ring, form_parts)


#: Forms that a task remembers.
FORMS = 2_000


def _with_parts(fields: DataFrame, ring: str, form_parts) -> DataFrame:
    """fields with a row for each part that a function makes of a ring: (ring, holes, area), and their number from 0. form_parts makes that function, for a task."""

    def run(frames):
        # a form that comes again, wherever it lies, is solved once
        parts = form_parts()
        for df in frames:
            at, rows = [], []
            for i, points in enumerate(df[ring]):
                found = parts(points)
                at += [i] * len(found)
                rows += [(k, *part) for k, part in enumerate(found)]
            out = df.drop(columns=[ring]).iloc[at].reset_index(drop=True)
            yield pd.concat([out, _frame(rows, "part", ring, "holes", "area")], axis=1)

    rest = [f"{f.name} {f.dataType.simpleString()}" for f in fields.schema.fields if f.name != ring]
    return spread(fields.select(*[c for c in fields.columns if c != ring], ring)).mapInPandas(run, ", ".join([*rest, "part int", f"{ring} {RINGS}", f"holes array<{RINGS}>", "area double"]))


def _shown(found, base: np.ndarray, grid: float) -> list[tuple]:
    """Shells with holes in map units, by falling area."""
    sized = [(_points(s + base, grid), [_points(h + base, grid) for h in holes], (P.area(s) + sum(P.area(h) for h in holes)) * grid * grid) for s, holes in found]
    return sorted(sized, key=lambda x: -x[2])


def _parts(points, grid: float, solve) -> list[tuple]:
    if points is None or len(points) < 3 or any(p is None for p in points):
        return []
    xy = np.array([(p["x"], p["y"]) for p in points], dtype=float)
    if not np.isfinite(xy).all():
        return []
    p = np.rint(xy / grid).astype(np.int64)
    base = p.min(axis=0)
    if (p.max(axis=0) - base >= P.LIMIT).any():
        raise ValueError("a polygon is wider than 2^29 grid steps; choose a coarser grid")
    return _shown(solve((p - base).tobytes()), base, grid)


def _capsule(a: np.ndarray, b: np.ndarray, distance: float, quarter: int) -> np.ndarray:
    """All points within a distance of a straight line, its ends in `quarter` steps a quarter turn."""
    along = np.arctan2(b[1] - a[1], b[0] - a[0])
    turn = along - np.pi / 2 + np.arange(2 * quarter + 1) * (np.pi / 2 / quarter)
    arc = distance * np.stack((np.cos(turn), np.sin(turn)), axis=1)
    return np.concatenate((b + arc, a - arc))


def ribbons(fields: DataFrame, distance: float, ring: str = "ring", grid: float = 1e-5, quarter: int = 8) -> DataFrame:
    """fields with what lies within a distance of each polygon's outline: a row for each part, with `part`, `ring`, `holes`, `area`.

    The outline is buffered edge by edge, ends and corners round in `quarter` steps a quarter turn (so the area falls short by
    1 - sin(t) / t of the round parts, t = pi / 2 / quarter), and the pieces united. Null, empty and single-point rings are dropped.
    """
    if not distance > 0:
        raise ValueError("a ribbon has a width above 0")

    def parts(points, solve) -> list[tuple]:
        if points is None or any(p is None for p in points):
            return []
        xy = np.array([(p["x"], p["y"]) for p in points], dtype=float).reshape(-1, 2)
        if len(xy) < 2 or not np.isfinite(xy).all():
            return []
        pieces = [np.rint(_capsule(a, b, distance, quarter) / grid).astype(np.int64) for a, b in zip(xy[:-1], xy[1:], strict=True) if (a != b).any()]
        if not pieces:
            return []
        base = np.concatenate(pieces).min(axis=0)
        if (np.concatenate(pieces).max(axis=0) - base >= P.LIMIT).any():
            raise ValueError("a polygon is wider than 2^29 grid steps; choose a coarser grid")
        return _shown(solve((np.concatenate(pieces) - base).tobytes()), base, grid)

    # every piece has as many points
    points = 2 * (2 * quarter + 1)

    def form_parts():
        @lru_cache(FORMS)
        def solve(form: bytes) -> list:
            p = np.frombuffer(form, np.int64).reshape(-1, points, 2)
            a, b = P.boundary(p.reshape(-1, 2), np.roll(p, -1, axis=1).reshape(-1, 2))
            return P.with_holes(P.rings(a, b))

        return lambda ring: parts(ring, solve)

    return _with_parts(fields, ring, form_parts)


#: The sides of a pixel: the neighbour across (row, column) and both ends (x, y); the pixel lies to the left of each.
SIDES = [((-1, 0), (0, 0), (1, 0)), ((0, 1), (1, 0), (1, 1)), ((1, 0), (1, 1), (0, 1)), ((0, -1), (0, 1), (0, 0))]


#: Pixels that are outlined at once, and pixels a side of the blocks of a mosaic.
PIXELS, BLOCK = 65_536, 128


def _sides(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The directed edges around the regions of a stack of bands (bands, rows, cols): pixel (its place in the stack) and both ends (x, y in its band). NaN pixels have none."""
    around = np.pad(v, ((0, 0), (1, 1), (1, 1)), constant_values=np.nan)
    rows, cols = v.shape[1:]
    pixel, a, b = [], [], []
    for (dr, dc), p, q in SIDES:
        edge = np.flatnonzero((v != around[:, 1 + dr : 1 + dr + rows, 1 + dc : 1 + dc + cols]) & ~np.isnan(v))
        at = np.stack((edge % cols, edge // cols % rows), axis=1)
        pixel.append(edge)
        a.append(at + p)
        b.append(at + q)
    return tuple(np.concatenate(k).astype(np.int64) for k in (pixel, a, b))


def _whole_rings(a: np.ndarray, b: np.ndarray, region: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rings of pixel edges (one plane a region): the points of all, and the number of points, the region and the signed area of each; points within straight lines go."""
    if not len(a):
        return np.zeros((0, 2), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    order, size = P.walks(P.following(a, b, region))
    xy, ring = a[order], np.repeat(np.arange(len(size)), size)
    begin = np.cumsum(size) - size
    # a walk that meets itself is cut there
    extent = xy.max(axis=0) + 1
    spot = np.sort((ring * extent[0] + xy[:, 0]) * extent[1] + xy[:, 1])
    again = np.zeros(len(size), bool)
    again[spot[1:][spot[1:] == spot[:-1]] // extent.prod()] = True
    found = region[order[begin]]
    cut = [(found[k], r) for k in np.flatnonzero(again).tolist() for r in P.loops(list(map(tuple, xy[begin[k] : begin[k] + size[k]].tolist())))]
    before = np.arange(len(order)) - 1
    before[begin] += size
    way = b[order] - xy
    keep = (way != way[before]).any(axis=1) & ~again[ring]
    xy = np.concatenate([xy[keep], *[r for _, r in cut]])
    number = np.concatenate((np.bincount(ring[keep], minlength=len(size))[~again], [len(r) for _, r in cut])).astype(np.int64)
    found = np.concatenate((found[~again], [k for k, _ in cut])).astype(np.int64)
    after = np.arange(len(xy)) + 1
    after[np.cumsum(number) - 1] -= number
    cross = xy[:, 0] * xy[after, 1] - xy[after, 0] * xy[:, 1]
    return xy, number, found, np.add.reduceat(cross, np.cumsum(number) - number) / 2


def _closed(xy: np.ndarray, number: np.ndarray) -> pa.Array:
    """Open rings as an Arrow column of closed ones."""
    begin = np.cumsum(number) - number
    at = np.insert(np.arange(len(xy)), np.cumsum(number), begin)
    points = pa.StructArray.from_arrays([pa.array(xy[at, k].astype(float)) for k in (0, 1)], names=["x", "y"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(number + 1))), pa.int32()), points)


def _picked(xy: np.ndarray, number: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rings of these numbers, in this order."""
    begin, n = (np.cumsum(number) - number)[order], number[order]
    return xy[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())], n


def _region_parts(xy: np.ndarray, number: np.ndarray, region: np.ndarray, area: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array, pa.Array]:
    """Regions with their one shell each: region, ring, holes, area. All edges of a region are its own pixels', so its holes need no search."""
    shells, holes = np.flatnonzero(area > 0), np.flatnonzero(area < 0)
    shells, holes = shells[np.argsort(region[shells], kind="stable")], holes[np.argsort(region[holes], kind="stable")]
    of = region[shells]
    held = np.bincount(np.searchsorted(of, region[holes]), minlength=len(of))
    # without rings bincount gives whole numbers
    total = np.bincount(np.searchsorted(of, region), area, len(of)).astype(float)
    gaps = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(held))), pa.int32()), _closed(*_picked(xy, number, holes)))
    return of, _closed(*_picked(xy, number, shells)), gaps, pa.array(total)


def region_polygons(bands: DataFrame, rows: int, cols: int, key: str = "chip", band: str = "band") -> DataFrame:
    """Outlines of the regions of equal values, each band alone: key, value, ring, holes, area in pixels (x: columns, y: rows).

    Regions join by edges, not by corners. NaN pixels are in none, null bands have none. A task holds one band, or as many as have PIXELS pixels.
    """
    many = max(1, PIXELS // (rows * cols))

    def run(batches):
        for batch in batches:
            batch = batch.filter(batch.column(1).is_valid())
            for at in range(0, batch.num_rows, many):
                keys, v = batch.column(0).slice(at, many), stacked(batch.column(1).slice(at, many), rows, cols)
                pixel, a, b = _sides(v)
                of, ring, holes, area = _region_parts(*_whole_rings(a, b, least_labels(v).ravel()[pixel]))
                yield pa.record_batch([keys.take(pa.array(of // (rows * cols))), pa.array(v.ravel()[of]), ring, holes, area], names=[key, "value", "ring", "holes", "area"])

    kind = bands.schema[key].dataType.simpleString()
    return bands.select(key, F.col(band).cast("array<double>")).mapInArrow(run, f"{key} {kind}, value double, {PARTS}")


def mosaic_regions(bands: DataFrame, side: int, band: str = "band") -> DataFrame:
    """Outlines of the regions of equal values over a mosaic of square bands (gx, gy: column and row of the band): by (the value), ring, holes, area.

    Bands are gathered to blocks of some BLOCK pixels a side. A region that stays off the border of its block is outlined there; of one that goes on from block
    to block each leaves paths from border to border, which are linked as those of `dissolve` are.
    """
    many = max(1, BLOCK // side)
    wide = many * side

    def run(batches):
        for batch in batches:
            for gx, gy, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                v = np.full((1, wide, wide), np.nan)
                held = cells.values
                for x, y, w in zip(held.field("x").to_pylist(), held.field("y").to_pylist(), stacked(held.field("band"), side, side), strict=True):
                    v[0, y * side : (y + 1) * side, x * side : (x + 1) * side] = w
                pixel, a, b = _sides(v)
                label, v = least_labels(v)[0], v.ravel()
                border = np.unique(np.concatenate((label[0], label[-1], label[:, 0], label[:, -1])))
                region, base = label.ravel()[pixel], np.array([gx, gy], np.int64) * wide
                open_ = np.isin(region, border)
                inner = ~open_
                xy, *more = _whole_rings(a[inner], b[inner], region[inner])
                of, ring, holes, area = _region_parts(xy + base, *more)
                none = pa.nulls(len(of), pa.list_(pa.int64()))
                yield pa.record_batch([pa.array(v[of]), pa.array(["part"] * len(of), pa.string()), none, none, ring, holes, area], names=FOUND)
                rows = []
                for value in np.unique(v[pixel[open_]]).tolist():
                    mine = open_ & (v[pixel] == value)
                    rows += [(value, k, w + base) for k, w in _paths(a[mine], b[mine], wide)]
                number = pa.array(np.concatenate(([0], np.cumsum([len(w) for *_, w in rows]))), pa.int32())
                points = np.concatenate([np.zeros((0, 2), np.int64), *[w for *_, w in rows]])
                xs, ys = (pa.ListArray.from_arrays(number, pa.array(points[:, k])) for k in (0, 1))
                none = [pa.nulls(len(rows), t) for t in (ring.type, holes.type, area.type)]
                yield pa.record_batch([pa.array([k for k, *_ in rows], pa.float64()), pa.array([k for _, k, _ in rows], pa.string()), xs, ys, *none], names=FOUND)

    block = lambda c: F.floor(F.col(c) / many).alias(c)
    place = lambda c: F.pmod(F.col(c), F.lit(many)).cast("bigint")
    held = F.struct(place("gx").alias("x"), place("gy").alias("y"), F.col(band).cast("array<double>").alias("band"))
    blocks = bands.filter(F.col(band).isNotNull()).groupBy(block("gx"), block("gy")).agg(F.collect_list(held).alias("cells"))
    found = settled(blocks.mapInArrow(run, f"by double, {PATH}, {PARTS}"), "blocks")
    inside = found.filter("kind = 'part'").select("by", "ring", "holes", "area")
    return inside.unionByName(polygons(link_paths(found.filter("kind <> 'part'").select("by", "kind", "xs", "ys"), wide, "double"), wide, 1.0, "double"))


#: Columns of what a block of a mosaic leaves.
FOUND = ["by", "kind", "xs", "ys", "ring", "holes", "area"]
