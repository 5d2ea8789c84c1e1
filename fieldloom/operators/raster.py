"""Raster operators on pixel tables (one row a pixel) and on arrays (one row a band)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.functions import geometry as G

# windows on pixel tables


def integral(pixels: DataFrame, value: str = "bad") -> DataFrame:
    """Summed-area table: chip, r, c, total of all values up to and including the pixel."""
    row = W.partitionBy("chip", "r").orderBy("c").rowsBetween(W.unboundedPreceding, 0)
    col = W.partitionBy("chip", "c").orderBy("r").rowsBetween(W.unboundedPreceding, 0)
    return pixels.withColumn("_row", F.sum(value).over(row)).withColumn("total", F.sum("_row").over(col)).select("chip", "r", "c", "total")


def best_window(pixels: DataFrame, height: int, width: int, value: str = "bad") -> DataFrame:
    """The window of least total for each chip, the first in row-major order among equals (chip, bad, r, c)."""
    across = W.partitionBy("chip", "r").orderBy("c").rowsBetween(0, width - 1)
    down = W.partitionBy("chip", "c").orderBy("r").rowsBetween(0, height - 1)
    p = pixels.withColumn("_a", F.sum(value).over(across)).withColumn("_w", F.count(F.lit(1)).over(across))
    p = p.withColumn("_s", F.sum("_a").over(down)).withColumn("_h", F.count(F.lit(1)).over(down)).filter((F.col("_w") == width) & (F.col("_h") == height))
    return p.groupBy("chip").agg(F.min(F.struct(F.col("_s").alias("bad"), "r", "c")).alias("m")).select("chip", "m.bad", "m.r", "m.c")


def invalid(value: Column, nodata: float | None) -> Column:
    """NaN, or equal to nodata where one is defined."""
    bad = F.isnan(value.cast("double"))
    return bad if nodata is None else bad | (value == nodata)


def standard_action(width: Column, height: Column, bands: Column, bad: Column, exists: Column, side: int = 256, need: int = 4) -> Column:
    """What brings a chip to side x side without gaps."""
    exact, large = (width == side) & (height == side), (width >= side) & (height >= side)
    return (
        F.when(exists, "skip_exists").when(bands != need, "skip_bands").when(exact & (bad == 0), "keep").when(exact, "fill_only")
        .when(large & (bad == 0), "crop_only").when(large, "crop_then_fill").otherwise("pad_then_fill")
    )


# bands as arrays


def stack(a: Column, b: Column) -> Column:
    """Bands of the first window, then of the second."""
    return F.concat(a, b)


def split_stack(bands: Column, n: int = 4) -> tuple[Column, Column]:
    return F.slice(bands, 1, n), F.slice(bands, n + 1, n)


def to_uint16(x: Column, action: Column) -> Column:
    """Values by the action of expressions.uint16_action: NaN is 0, infinities the bounds, decimals are cut."""
    clean = F.when(F.isnan(x), 0.0).otherwise(x)
    scaled = F.when(action == "scale", clean * 65535.0).otherwise(clean)
    return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(65535.0), scaled))).cast("int")


def round_clip(x: Column) -> Column:
    """Half to even, then 0..65535."""
    return F.least(F.greatest(F.rint(x), F.lit(0.0)), F.lit(65535.0)).cast("int")


def normalize(x: Column, how: str = "by_10000", divisor: Column | None = None) -> Column:
    """Reflectance by a fixed divisor (by_10000, by_3000), or by one drawn for each sample (random, 1,500 to 4,500)."""
    if how == "random":
        return x / divisor
    return x / {"by_10000": 10000.0, "by_3000": 3000.0}[how]


def random_divisor(key: Column, seed: int) -> Column:
    """1,500 to 4,500 by a seeded hash of the sample's key, the same in every run."""
    return 1500.0 + 3000.0 * F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1_000_003)) / 1_000_003


def remap_unlabeled(y: Column, edge: Column, unlabeled: int = 3) -> Column:
    """Labels stay on the labelled margin only; elsewhere they are unlabeled."""
    return F.when(edge > 0, y).otherwise(unlabeled)


def softmax(logits: Column) -> Column:
    top = F.array_max(logits)
    e = F.transform(logits, lambda x: F.exp(x - top))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda s, x: s + x))


def confidence(logits: Column) -> Column:
    """Struct (confidence, class): the largest probability and the first class that has it."""
    return F.struct((1 / F.aggregate(logits, F.lit(0.0), lambda s, x: s + F.exp(x - F.array_max(logits)))).alias("confidence"), (F.array_position(logits, F.array_max(logits)) - 1).cast("int").alias("class"))


def mask_three(instance: Column, near_edge: Column) -> Column:
    """Background 0, interior 1, boundary 2; the boundary is drawn over the interior."""
    return F.when(near_edge, 2).when(instance > 0, 1).otherwise(0)


def mask_three_inner(instance: Column, near_edge: Column) -> Column:
    """The other variant: boundary only where there is no interior."""
    return F.when(instance > 0, 1).when(near_edge, 2).otherwise(0)


def rasterize(chip_pixels: DataFrame, fields: DataFrame, cell: float) -> DataFrame:
    """Instance id of each pixel by its centre (x, y): the highest id among the boxes that hold it, 0 without any.

    fields: chip, instance and a box. Overlaps go to the later instance.
    """
    f = fields.select(F.col("chip").alias("_chip"), "instance", *[F.col(k).alias(f"z_{k}") for k in ("x0", "y0", "x1", "y1")])
    p = chip_pixels.withColumns({"_gx": F.floor(F.col("x") / cell), "_gy": F.floor(F.col("y") / cell)})
    cover = lambda a, b: F.explode(F.sequence(F.floor(a / cell), F.floor(b / cell)))
    f = f.withColumn("_hx", cover(F.col("z_x0"), F.col("z_x1"))).withColumn("_hy", cover(F.col("z_y0"), F.col("z_y1")))
    on = (F.col("chip") == F.col("_chip")) & (F.col("_gx") == F.col("_hx")) & (F.col("_gy") == F.col("_hy"))
    on = on & (F.col("x") >= F.col("z_x0")) & (F.col("x") < F.col("z_x1")) & (F.col("y") >= F.col("z_y0")) & (F.col("y") < F.col("z_y1"))
    return p.join(f, on, "left").groupBy("chip", "r", "c").agg(F.coalesce(F.max("instance"), F.lit(0)).alias("instance"))


def _places(chip_pixels: DataFrame, fields: DataFrame, cell: float, reach: float) -> DataFrame:
    """For each pixel that lies in a polygon of its chip or within reach of its outline: chip, r, c, instance (the highest that holds it, else null) and edge.

    Pixels meet the polygons whose bounds, widened by reach, hold their centres. Equal polygons of a chip meet once."""
    b = G.ring_bounds(F.col("ring"))
    forms = fields.groupBy(F.col("chip").alias("_chip"), "ring").agg(F.max("instance").alias("instance"))
    f = forms.select("*", b.alias("b")).select("_chip", "instance", "ring", *[(F.col(f"b.{k}") + (reach if k[1] == "1" else -reach)).alias(f"z_{k}") for k in ("x0", "y0", "x1", "y1")])
    p = chip_pixels.withColumns({"_gx": F.floor(F.col("x") / cell), "_gy": F.floor(F.col("y") / cell)})
    cover = lambda a, b: F.explode(F.sequence(F.floor(a / cell), F.floor(b / cell)))
    f = f.withColumn("_hx", cover(F.col("z_x0"), F.col("z_x1"))).withColumn("_hy", cover(F.col("z_y0"), F.col("z_y1")))
    on = (F.col("chip") == F.col("_chip")) & (F.col("_gx") == F.col("_hx")) & (F.col("_gy") == F.col("_hy"))
    on = on & (F.col("x") >= F.col("z_x0")) & (F.col("x") <= F.col("z_x1")) & (F.col("y") >= F.col("z_y0")) & (F.col("y") <= F.col("z_y1"))
    met = p.join(f, on).select("chip", "r", "c", "instance", G.ring_places(reach)(F.col("x"), F.col("y"), F.col("ring")).alias("_place"))
    return met.groupBy("chip", "r", "c").agg(F.max(F.when(F.col("_place") % 2 == 1, F.col("instance"))).alias("instance"), F.max(F.col("_place") >= 2).alias("edge")).filter("instance is not null or edge")


def _placed(chip_pixels: DataFrame, fields: DataFrame, cell: float, reach: float) -> DataFrame:
    found = _places(chip_pixels, fields, cell, reach)
    return chip_pixels.select("chip", "r", "c").join(found, ["chip", "r", "c"], "left").select("chip", "r", "c", F.coalesce("instance", F.lit(0)).alias("instance"), F.coalesce("edge", F.lit(False)).alias("edge"))


def rasterize_rings(chip_pixels: DataFrame, fields: DataFrame, cell: float) -> DataFrame:
    """Instance id of each pixel by its centre (x, y): the highest id among the polygons (chip, instance, ring) that hold it, 0 without any."""
    return _placed(chip_pixels, fields, cell, 0.0).select("chip", "r", "c", "instance")


def ribbon(chip_pixels: DataFrame, fields: DataFrame, cell: float, reach: float) -> DataFrame:
    """Pixels (chip, r, c) whose centre lies within reach of the outline of a polygon of their chip; corners are round."""
    return _places(chip_pixels, fields, cell, reach).filter("edge").select("chip", "r", "c")


def three_class_mask(chip_pixels: DataFrame, fields: DataFrame, cell: float, reach: float, inner_first: bool = False) -> DataFrame:
    """Background 0, interior 1 and boundary ribbon 2 of polygons, the boundary over the interior or, with inner_first, under it."""
    mask = (mask_three_inner if inner_first else mask_three)(F.col("instance"), F.col("edge"))
    return _placed(chip_pixels, fields, cell, reach).select("chip", "r", "c", mask.alias("cls"))


def edge_crops(side: int, crop: int) -> dict[str, tuple[int, int]]:
    """Row and column where each corner crop begins."""
    far = side - crop
    return {"tl": (0, 0), "tr": (0, far), "bl": (far, 0), "br": (far, far)}


def crop_pixels(pixels: DataFrame, side: int, crop: int) -> DataFrame:
    """Pixels once for each corner crop that holds them (corner), and whether all four do (shared)."""
    corners = edge_crops(side, crop)
    arr = F.array(*[F.struct(F.lit(k).alias("corner"), F.lit(r).alias("r0"), F.lit(c).alias("c0")) for k, (r, c) in corners.items()])
    far = side - crop
    shared = F.col("r").between(far, crop - 1) & F.col("c").between(far, crop - 1)
    p = pixels.withColumn("k", F.explode(arr)).filter(F.col("r").between(F.col("k.r0"), F.col("k.r0") + crop - 1) & F.col("c").between(F.col("k.c0"), F.col("k.c0") + crop - 1))
    return p.withColumn("corner", F.col("k.corner")).withColumn("shared", shared).drop("k")


def mosaic(pixels: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """The value of the layer on top (the highest order) for each pixel."""
    return pixels.groupBy(*by).agg(F.max_by(value, order).alias(value))


def median_composite(pixels: DataFrame, by: list[str], value: str) -> DataFrame:
    return pixels.groupBy(*by).agg(F.median(value).alias("median"))


# NumPy on whole bands


def bilinear(values: np.ndarray, rows: int, cols: int) -> np.ndarray:
    """Linear re-interpolation of a band (or a stack of them: bands, rows, cols) to rows x cols samples from the first to the last coordinate."""
    height, width = values.shape[-2:]
    r, c = np.linspace(0, height - 1, rows), np.linspace(0, width - 1, cols)
    r0, c0 = np.minimum(r.astype(int), max(height - 2, 0)), np.minimum(c.astype(int), max(width - 2, 0))
    r1, c1 = np.minimum(r0 + 1, height - 1), np.minimum(c0 + 1, width - 1)
    fr, fc = (r - r0)[:, None], (c - c0)[None]
    v = values.astype(float)
    up, low = v[..., r0, :], v[..., r1, :]
    return (up[..., c0] * (1 - fc) + up[..., c1] * fc) * (1 - fr) + (low[..., c0] * (1 - fc) + low[..., c1] * fc) * fr


def fill_gaps(values: np.ndarray, bad: np.ndarray, reach: int = 50) -> np.ndarray:
    """Gaps by inverse distance from the nearest valid pixel in each of the four directions within reach; unreached ones stay."""
    out, ok = values.astype(float).copy(), ~bad
    total, weight = np.zeros(values.shape), np.zeros(values.shape)
    for axis, flip in ((0, False), (0, True), (1, False), (1, True)):
        v, g = (np.flip(x, axis) if flip else x for x in (values.astype(float), ok))
        n = v.shape[axis]
        at = np.expand_dims(np.arange(n), 1 - axis) * np.ones_like(v)
        last = np.maximum.accumulate(np.where(g, at, -1), axis=axis)
        dist = at - last
        near = np.take_along_axis(v, np.maximum(last, 0).astype(int), axis=axis)
        use = (last >= 0) & (dist > 0) & (dist <= reach)
        w = np.where(use, 1 / np.maximum(dist, 1), 0.0)
        add, w = w * np.where(use, near, 0.0), w
        if flip:
            add, w = np.flip(add, axis), np.flip(w, axis)
        total, weight = total + add, weight + w
    fill = bad & (weight > 0)
    out[fill] = (total / np.where(weight > 0, weight, 1))[fill]
    return np.rint(out) if np.issubdtype(values.dtype, np.integer) else out


def _band_udf(work):
    @F.pandas_udf("array<double>")
    def run(band: pd.Series) -> pd.Series:
        return pd.Series([work(np.asarray(b, dtype=float)) if b is not None else None for b in band], dtype=object)

    return run


def _stack_udf(work, rows: int, cols: int):
    """work on stacks of bands (bands, rows, cols) of some STACKED pixels, all bands of a stack at once; null for a null band."""
    many = max(1, STACKED // (rows * cols))

    @F.arrow_udf("array<double>")
    def run(band: pa.Array) -> pa.Array:
        given = band.is_valid()
        held = band.filter(given)
        done = []
        for k in range(0, len(held), many):
            out = work(stacked(held.slice(k, many), rows, cols))
            out = out.reshape(len(out), -1)
            done.append(pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * out.shape[1], pa.int32()), pa.array(out.ravel())))
        found = pa.concat_arrays(done) if done else pa.array([], pa.list_(pa.float64()))
        if len(held) == len(band):
            return found
        place = np.cumsum(given.to_numpy(zero_copy_only=False)) - 1
        return found.take(pa.array(place, mask=~given.to_numpy(zero_copy_only=False)))

    return lambda band: run(band.cast("array<double>"))


#: Pixels that are worked on at once.
STACKED = 65_536


def stacked(bands: pa.Array, rows: int, cols: int) -> np.ndarray:
    """An Arrow column of bands, none of them null, as one array; a null pixel is NaN."""
    if any(n != rows * cols for n in bands.value_lengths().to_pylist()):
        raise ValueError(f"a band has {rows} x {cols} pixels")
    return bands.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, rows, cols)


def resample(rows: int, cols: int, new_rows: int, new_cols: int):
    return _stack_udf(lambda b: bilinear(b, new_rows, new_cols), rows, cols)


def scaled_places(n: int, new: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For `new` samples of n pixels, pixel middles on pixel middles: the pixels on either side and the share of the second."""
    at = np.maximum((np.arange(new) + 0.5) * (n / new) - 0.5, 0)
    low = np.minimum(at.astype(int), n - 1)
    return low, np.minimum(low + 1, n - 1), at - low


def rescale(rows: int, cols: int, new_rows: int, new_cols: int, nearest: bool = False):
    """Bands on a finer or coarser grid of the same extent: linear between pixel middles, or (for classes) the pixel at the start of each new one."""

    def work(b: np.ndarray) -> np.ndarray:
        v = b.reshape(rows, cols)
        if nearest:
            return v[np.arange(new_rows) * rows // new_rows][:, np.arange(new_cols) * cols // new_cols].ravel()
        (r0, r1, fr), (c0, c1, fc) = scaled_places(rows, new_rows), scaled_places(cols, new_cols)
        fr, fc = fr[:, None], fc[None]
        return ((v[r0][:, c0] * (1 - fc) + v[r0][:, c1] * fc) * (1 - fr) + (v[r1][:, c0] * (1 - fc) + v[r1][:, c1] * fc) * fr).ravel()

    return _band_udf(work)


def fill(rows: int, cols: int, nodata: float, reach: int = 50):
    def work(b: np.ndarray) -> np.ndarray:
        v = b.reshape(rows, cols)
        return fill_gaps(v, np.isnan(v) | (v == nodata), reach).ravel()

    return _band_udf(work)


def pad(rows: int, cols: int, side: int, value: float):
    """The band in the top-left corner of a square."""

    def work(b: np.ndarray) -> np.ndarray:
        out = np.full((side, side), float(value))
        out[:rows, :cols] = b.reshape(rows, cols)
        return out.ravel()

    return _band_udf(work)


def sharpen(v: np.ndarray, factor: float) -> np.ndarray:
    """Away from (factor above 1) or towards (below 1) a 3 x 3 smoothing whose centre counts 5 of 13; the border stays."""
    soft = v.copy()
    if min(v.shape) > 2:
        around = sum(v[1 + i : v.shape[0] - 1 + i, 1 + j : v.shape[1] - 1 + j] for i in (-1, 0, 1) for j in (-1, 0, 1))
        soft[1:-1, 1:-1] = (around + 4 * v[1:-1, 1:-1]) / 13
    return soft + (v - soft) * factor


def augment(rows: int, cols: int, turn: int = 0, flip_h: bool = False, flip_v: bool = False, brightness: float = 1.0, sharpness: float = 1.0, crop: tuple[int, int, int, int] | None = None):
    """Quarter turns, flips, sharpness, brightness, and a crop (row, column, height, width) brought back to the full size."""

    def work(b: np.ndarray) -> np.ndarray:
        v = np.rot90(b.reshape(rows, cols), turn)
        v = v[:, ::-1] if flip_h else v
        v = v[::-1] if flip_v else v
        v = sharpen(np.ascontiguousarray(v), sharpness) if sharpness != 1.0 else v
        if crop is not None:
            r, c, height, width = crop
            v = bilinear(v[r : r + height, c : c + width], *v.shape)
        return (v * brightness).ravel()

    return _band_udf(work)


def least_labels(values: np.ndarray) -> np.ndarray:
    """For each pixel of a stack of bands (bands, rows, cols) the number of the first pixel of its 4-neighbour region of one value; a NaN pixel is alone.

    Every pixel takes the least label of its equal neighbours and then that label's own, until nothing changes.
    """
    label = np.arange(values.size).reshape(values.shape)
    across, down = values[:, :, 1:] == values[:, :, :-1], values[:, 1:] == values[:, :-1]
    a = np.r_[label[:, :, :-1][across], label[:, :-1][down]]
    b = np.r_[label[:, :, 1:][across], label[:, 1:][down]]
    flat = label.ravel()
    while True:
        low = np.minimum(flat[a], flat[b])
        new = flat.copy()
        # the roots of both ends hang on the lower one
        np.minimum.at(new, flat[a], low)
        np.minimum.at(new, flat[b], low)
        while (deeper := new[new]).tobytes() != new.tobytes():
            new = deeper
        if (new == flat).all():
            return flat.reshape(values.shape)
        flat = new


def regions(values: np.ndarray) -> np.ndarray:
    """Labels of connected 4-neighbour regions of one value, numbered in row-major order of their first pixel from 1."""
    _, place = np.unique(least_labels(values[None]), return_inverse=True)
    return (place + 1).reshape(values.shape)


def polygonize(rows: int, cols: int):
    """Labels of the regions of a band; one chip at a time, so a chip is what a task has to hold."""
    return _band_udf(lambda b: regions(b.reshape(rows, cols)).ravel().astype(float))


def farthest_points(points: np.ndarray, most: int = 10) -> list[int]:
    """Indices of a greedy farthest-point sample from the first on; the lowest index among equals."""
    if not len(points):
        return []
    chosen, near = [0], np.hypot(*(points - points[0]).T)
    while len(chosen) < min(most, len(points)):
        k = int(near.argmax())
        if near[k] == 0:
            break
        chosen.append(k)
        near = np.minimum(near, np.hypot(*(points - points[k]).T))
    return chosen


def sample_points(points: DataFrame, most: int = 10) -> DataFrame:
    """points: field_id, px, py. The greedy sample of each field (field_id, rank, px, py); a field's lattice is bounded by its own area."""

    def run(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["px", "py"], kind="stable").reset_index(drop=True)
        at = farthest_points(df[["px", "py"]].to_numpy(dtype=float), most)
        got = df.loc[at, ["field_id", "px", "py"]].copy()
        got.insert(1, "rank", range(1, len(at) + 1))
        return got

    return points.select("field_id", "px", "py").groupBy("field_id").applyInPandas(run, "field_id bigint, rank bigint, px bigint, py bigint")
