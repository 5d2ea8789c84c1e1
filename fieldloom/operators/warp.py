"""Rasters from one coordinate system and grid to another.

The source is a mosaic of square tiles, one row a tile. Each block of the target asks for the tiles that its pixels fall on, their neighbours for the
interpolation included; tiles and blocks meet in one equi-join, and a block is put together and sampled in the task that has it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.functions import projection as J


@dataclass(frozen=True)
class Grid:
    """Pixels of a raster: the outer corner of the first one, and the steps to the next column and row (dy is below 0 where rows go south)."""

    crs: str
    x0: float
    y0: float
    dx: float
    dy: float

    def centres(self, col: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.x0 + (col + 0.5) * self.dx, self.y0 + (row + 0.5) * self.dy

    def place(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Column and row, 0 at the middle of the first pixel."""
        return (x - self.x0) / self.dx - 0.5, (y - self.y0) / self.dy - 0.5


def _wanted(source: Grid, target: Grid, bx: int, by: int, block: int, width: int, height: int) -> tuple[np.ndarray, np.ndarray, tuple[int, int]]:
    """Places in the source of a block's pixels (flat, row by row), and the block's size."""
    cols, rows = np.arange(bx * block, min((bx + 1) * block, width)), np.arange(by * block, min((by + 1) * block, height))
    c, r = (g.ravel().astype(float) for g in np.meshgrid(cols, rows))
    x, y = J.convert(*target.centres(c, r), target.crs, source.crs, J.ARRAYS)
    return *source.place(x, y), (len(rows), len(cols))


def _needs(source: Grid, target: Grid, block: int, width: int, height: int, side: int):
    across = -(-width // block)

    def run(frames):
        for df in frames:
            out = []
            for k in df["id"].tolist():
                c, r, _ = _wanted(source, target, k % across, k // across, block, width, height)
                ok = np.isfinite(c) & np.isfinite(r)
                c, r = np.floor(c[ok]).astype(np.int64), np.floor(r[ok]).astype(np.int64)
                tiles = np.unique(np.concatenate([np.stack(((c + i) // side, (r + j) // side), axis=1) for i in (0, 1) for j in (0, 1)]), axis=0) if len(c) else np.zeros((0, 2), np.int64)
                out += [(k % across, k // across, gx, gy) for gx, gy in tiles.tolist()]
            yield pd.DataFrame(out, columns=["bx", "by", "gx", "gy"])

    return run


def _inside(ring: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    hit = np.zeros(x.shape, bool)
    for (ax, ay), (bx, by) in zip(ring, np.roll(ring, -1, axis=0), strict=True):
        if ay != by:
            hit ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
    return hit


def _sampled(source: Grid, target: Grid, block: int, width: int, height: int, side: int, nodata: float | None, aoi, whole: bool):
    def run(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        name, bx, by = df["key"].iloc[0], int(df["bx"].iloc[0]), int(df["by"].iloc[0])
        c, r, (rows, cols) = _wanted(source, target, bx, by, block, width, height)
        gx0, gy0 = int(df["gx"].min()), int(df["gy"].min())
        # one more line all round, so that a neighbour off the tiles is simply missing
        view = np.full(((int(df["gy"].max()) - gy0 + 1) * side + 2, (int(df["gx"].max()) - gx0 + 1) * side + 2), np.nan)
        for gx, gy, band in zip(df["gx"], df["gy"], df["band"], strict=True):
            b = np.asarray(band, dtype=float).reshape(side, side)
            y, x = (int(gy) - gy0) * side + 1, (int(gx) - gx0) * side + 1
            view[y : y + side, x : x + side] = np.where(b == nodata, np.nan, b) if nodata is not None else b
        c, r = c - gx0 * side + 1, r - gy0 * side + 1
        out = np.zeros(rows * cols)
        at = np.flatnonzero(np.isfinite(c) & np.isfinite(r) & (c >= 0) & (r >= 0) & (c < view.shape[1] - 1) & (r < view.shape[0] - 1))
        c, r = c[at], r[at]
        c0, r0 = np.floor(c).astype(np.int64), np.floor(r).astype(np.int64)
        total, weight = np.zeros(len(at)), np.zeros(len(at))
        for i in (0, 1):
            for j in (0, 1):
                v = view[r0 + j, c0 + i]
                w = np.where(np.isnan(v), 0.0, np.abs(1 - i - (c - c0)) * np.abs(1 - j - (r - r0)))
                total += np.where(w > 0, v, 0.0) * w
                weight += w
        held = ~np.isnan(view[np.floor(r + 0.5).astype(np.int64), np.floor(c + 0.5).astype(np.int64)]) & (weight > 0)
        out[at[held]] = total[held] / weight[held]
        if aoi is not None:
            x, y = (g.ravel() for g in np.meshgrid(np.arange(cols, dtype=float) + bx * block, np.arange(rows, dtype=float) + by * block))
            out[~_inside(np.asarray(aoi, dtype=float), *target.centres(x, y))] = 0.0
        if whole:
            out = np.clip(np.rint(out), 0, 65535)
        return pd.DataFrame({"key": [name], "bx": [bx], "by": [by], "rows": [rows], "cols": [cols], "band": [out.tolist()]})

    return run


def warp(
    tiles: DataFrame, source: Grid, side: int, target: Grid, width: int, height: int, block: int = 256, key: str | None = None, nodata: float | None = None, aoi: list[tuple[float, float]] | None = None, whole: bool = False
) -> DataFrame:
    """Bilinear samples of a mosaic on another grid: key, bx, by (column and row of the block), rows, cols, band (row by row).

    tiles: gx, gy (column and row of the tile), band (side x side values, row by row) and, if named, key (one raster each). Pixels without a value (nodata,
    NaN, missing tile) have no weight; a target pixel whose centre falls on none of value becomes 0, as do those with their centre outside `aoi` (corners in the target's
    system). whole: rounded to even and held within 0 .. 65535. Blocks that no tile reaches are left out.
    """
    spark = tiles.sparkSession
    named = F.col(key) if key else F.lit(None).cast("int")
    given = tiles.select(named.alias("key"), F.col("gx").cast("long").alias("gx"), F.col("gy").cast("long").alias("gy"), F.col("band").cast("array<double>").alias("band"))
    blocks = -(-width // block) * -(-height // block)
    needs = spark.range(blocks).mapInPandas(_needs(source, target, block, width, height, side), "bx long, by long, gx long, gy long")
    kind = given.schema["key"].dataType.simpleString()
    done = needs.join(given, ["gx", "gy"]).groupBy("key", "bx", "by").applyInPandas(_sampled(source, target, block, width, height, side, nodata, aoi, whole), f"key {kind}, bx long, by long, rows int, cols int, band array<double>")
    return done


def pixels_of(blocks: DataFrame, block: int) -> DataFrame:
    """Blocks as one row a pixel: key, row, col, v."""
    flat = blocks.select("key", "bx", "by", "cols", F.posexplode("band").alias("pos", "v"))
    return flat.select("key", (F.col("by") * block + F.floor(F.col("pos") / F.col("cols"))).alias("row"), (F.col("bx") * block + F.col("pos") % F.col("cols")).alias("col"), "v")
