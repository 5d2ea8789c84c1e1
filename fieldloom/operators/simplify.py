"""Simplification of polygons that keeps common borders common."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.geometry import simplify_points


def _arc(p: np.ndarray, tolerance: float) -> np.ndarray:
    """An arc simplified in one direction, whichever way it is given: neighbours that share it keep the same points."""
    back = p.tolist() > p[::-1].tolist()
    out = simplify_points(p[::-1] if back else p, tolerance)
    return out[::-1] if back else out


def _ring(p: np.ndarray, fixed: np.ndarray, tolerance: float) -> np.ndarray | None:
    """An open ring simplified between its fixed points; one without any between its least point and the one farthest from it."""
    at = np.flatnonzero(fixed)
    if not len(at):
        first = min(range(len(p)), key=lambda k: tuple(p[k]))
        gap = np.hypot(*(p - p[first]).T)
        far = np.flatnonzero(gap == gap.max())
        at = np.array(sorted({first, min(far.tolist(), key=lambda k: tuple(p[k]))}))
    p = np.roll(p, -at[0], axis=0)
    at = [*(at - at[0]).tolist(), len(p)]
    p = np.concatenate((p, p[:1]))
    parts = [_arc(p[a : b + 1], tolerance)[:-1] for a, b in zip(at[:-1], at[1:], strict=True)]
    out = np.concatenate(parts)
    return np.concatenate((out, out[:1])) if len(out) > 2 else None


def simplify_shared(polygons: DataFrame, key: str, ring: str, tolerance: float) -> DataFrame:
    """polygons (key unique) with their rings simplified within a tolerance; borders of neighbours stay the same on both sides, without gaps.

    Edges are counted by their two points. A point where other than two different edges meet, or where the polygons along them change, is a junction
    and stays. Between junctions each side simplifies the same points in the same direction. Neighbours have to share their points exactly. A ring of which less than
    three points are left becomes null; rows without a ring keep null.
    """
    point = lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))
    rows = polygons.filter(F.col(ring).isNotNull()).select(F.col(key).alias("_k"), F.posexplode(F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1), lambda p, q: F.struct(point(p).alias("p"), point(q).alias("q")))).alias("_i", "_e"))
    rows = rows.filter("_e.p <> _e.q").select("_k", "_i", "_e.p", "_e.q", F.least("_e.p", "_e.q").alias("_a"), F.greatest("_e.p", "_e.q").alias("_b"))
    # one row an edge; the polygons along it, as one number
    edges = rows.groupBy("_a", "_b").agg(F.sum(F.xxhash64("_k").bitwiseAND(F.lit(0xFFFFFFFFFFFF))).alias("_own"))
    ends = edges.select(F.explode(F.array("_a", "_b")).alias("v"), "_own")
    junctions = ends.groupBy("v").agg(((F.count(F.lit(1)) != 2) | (F.min("_own") != F.max("_own"))).alias("fixed"))
    held = rows.select("_k", "_i", "p").join(junctions, F.col("p") == F.col("v")).groupBy("_k").agg(F.array_sort(F.collect_list(F.struct("_i", "p", "fixed"))).alias("_ps"))

    def run(frames):
        for df in frames:
            out = []
            for k, ps in zip(df["_k"], df["_ps"], strict=True):
                p = np.array([(x["p"]["x"], x["p"]["y"]) for x in ps], dtype=float)
                r = _ring(p, np.array([x["fixed"] for x in ps], bool), tolerance)
                out.append((k, None if r is None else [{"x": x, "y": y} for x, y in r.tolist()]))
            yield pd.DataFrame(out, columns=["_k", "_ring"], dtype=object)

    kind = polygons.schema[key].dataType.simpleString()
    done = held.mapInPandas(run, f"_k {kind}, _ring array<struct<x:double,y:double>>")
    return polygons.drop(ring).join(done, F.col(key) == F.col("_k"), "left").drop("_k").withColumnRenamed("_ring", ring)
