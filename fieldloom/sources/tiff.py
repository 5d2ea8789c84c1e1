"""Multi-band rasters as TIFF bytes, by the public TIFF 6.0 and GeoTIFF layouts: planar strips or tiles, deflated, with or without differencing."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sample format and bits by kind, fixed values.
KINDS = {"uint8": (1, 8), "uint16": (1, 16), "uint32": (1, 32), "int16": (2, 16), "int32": (2, 32), "float32": (3, 32), "float64": (3, 64)}
_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 12: 8, 16: 8}
_CODE = {1: "B", 3: "H", 4: "I", 12: "d", 16: "Q"}


def output_profile(like: dict, width: int, height: int, count: int | None = None, compress: str | None = "deflate", block: int = 256) -> dict:
    """A profile for a new raster: that of another one with this size, tiled and differenced if it is compressed, plain strips if not."""
    out = {k: v for k, v in like.items() if k not in ("compress", "tiled", "blockxsize", "blockysize", "predictor")}
    out |= {"driver": "GTiff", "width": width, "height": height}
    if count is not None:
        out["count"] = count
    if compress:
        out |= {"compress": compress, "tiled": True, "blockxsize": min(block, width), "blockysize": min(block, height)}
        if str(out.get("dtype", "uint8")).startswith(("uint", "int", "float")):
            out["predictor"] = 2
    return out


def mask_profile(like: dict, dtype: str, nodata: int = 0) -> dict:
    """A profile for a mask of one band over the same raster."""
    out = output_profile(like, like.get("width", 256), like.get("height", 256), count=1)
    out.pop("photometric", None)
    out.pop("predictor", None)
    return out | {"dtype": dtype, "nodata": nodata}


def prediction_profile(like: dict, dtype: str) -> dict:
    """A profile for one band of classes (uint8) or confidences (float32) with the chip's georeference and no nodata value."""
    return {k: v for k, v in like.items() if k != "nodata"} | {"driver": "GTiff", "count": 1, "dtype": dtype}


def _differ(a: np.ndarray) -> np.ndarray:
    """Each sample less the one to its left, modulo its range."""
    out = a.copy()
    with np.errstate(over="ignore"):
        out[:, 1:] = a[:, 1:] - a[:, :-1]
    return out


def encode(bands: np.ndarray, x0: float = 0.0, y0: float = 0.0, step: float = 1.0, tile: int | None = None, predictor: int = 1, epsg: int | None = None, nodata: float | None = None) -> bytes:
    """bands: [band, row, column]. x0, y0: the outer corner at the top left. tile: side of square tiles (a multiple of 16), else one strip a band.

    predictor 2 stores differences (whole numbers only). epsg: a code below 32768 of a projected or, if it is 4000 to 4999, geographic system.
    """
    n, rows, cols = bands.shape
    fmt, bits = KINDS[bands.dtype.name]
    if predictor == 2 and fmt == 3:
        raise ValueError("floats are not differenced")
    if tile and tile % 16:
        raise ValueError("tiles are multiples of 16")
    if tile:
        down, across = -(-rows // tile), -(-cols // tile)
        padded = np.zeros((n, down * tile, across * tile), dtype=bands.dtype)
        padded[:, :rows, :cols] = bands
        blocks = [padded[k, i * tile : (i + 1) * tile, j * tile : (j + 1) * tile] for k in range(n) for i in range(down) for j in range(across)]
    else:
        blocks = list(bands)
    packed = [zlib.compress(np.ascontiguousarray(_differ(b) if predictor == 2 else b, dtype=b.dtype.newbyteorder("<")).tobytes()) for b in blocks]
    out, offsets = bytearray(b"II*\0\0\0\0\0"), []
    for s in packed:
        offsets.append(len(out))
        out += s + b"\0" * (len(s) % 2)
    sizes = [len(s) for s in packed]
    tags = [(256, 4, [cols]), (257, 4, [rows]), (258, 3, [bits] * n), (259, 3, [8]), (262, 3, [1]), (277, 3, [n]), (284, 3, [2]), (339, 3, [fmt] * n)]
    tags += [(322, 4, [tile]), (323, 4, [tile]), (324, 4, offsets), (325, 4, sizes)] if tile else [(273, 4, offsets), (278, 4, [rows]), (279, 4, sizes)]
    if predictor == 2:
        tags.append((317, 3, [2]))
    tags += [(33550, 12, [step, step, 0.0]), (33922, 12, [0.0, 0.0, 0.0, x0, y0, 0.0])]
    if epsg is not None:
        geographic = 4000 <= epsg < 5000
        tags.append((34735, 3, [1, 1, 0, 3, 1024, 0, 1, 2 if geographic else 1, 1025, 0, 1, 1, 2048 if geographic else 3072, 0, 1, epsg]))
    if nodata is not None:
        tags.append((42113, 2, list(f"{nodata:g}".encode() + b"\0")))
    entries = b""
    tags.sort()
    for tag, kind, values in tags:
        raw = struct.pack(f"<{len(values)}{_CODE.get(kind, 'B')}", *values)
        if len(raw) > 4:
            at, raw_at = len(out), raw + b"\0" * (len(raw) % 2)
            out += raw_at
            raw = struct.pack("<I", at)
        entries += struct.pack("<HHI", tag, kind, len(values)) + raw.ljust(4, b"\0")
    struct.pack_into("<I", out, 4, len(out))
    return bytes(out + struct.pack("<H", len(tags)) + entries + b"\0\0\0\0")


def _tags(blob: bytes) -> dict:
    if blob[:4] != b"II*\0":
        raise ValueError("not a little-endian TIFF")
    at = struct.unpack_from("<I", blob, 4)[0]
    tags = {}
    for i in range(struct.unpack_from("<H", blob, at)[0]):
        tag, kind, n = struct.unpack_from("<HHI", blob, at + 2 + 12 * i)
        where = at + 10 + 12 * i
        if n * _SIZE.get(kind, 8) > 4:
            where = struct.unpack_from("<I", blob, where)[0]
        if kind == 2:
            tags[tag] = (blob[where : where + n].rstrip(b"\0").decode("latin-1"),)
        elif kind in _CODE:
            tags[tag] = struct.unpack_from(f"<{n}{_CODE[kind]}", blob, where)
    return tags


def info(blob: bytes) -> dict:
    """width, height, count, dtype, x0, y0, step, tile, epsg and nodata of a TIFF; the last three None if there are none."""
    t = _tags(blob)
    kind = next(k for k, v in KINDS.items() if v == (t.get(339, (1,))[0], t[258][0]))
    tie, scale, keys = t.get(33922, (0.0,) * 6), t.get(33550, (1.0,) * 3), t.get(34735, ())
    epsg = next((keys[i + 3] for i in range(4, len(keys), 4) if keys[i] in (2048, 3072)), None)
    return {"width": t[256][0], "height": t[257][0], "count": t.get(277, (1,))[0], "dtype": kind, "x0": tie[3], "y0": tie[4], "step": scale[0], "tile": t.get(322, (None,))[0], "epsg": epsg, "nodata": float(t[42113][0]) if 42113 in t else None}


def decode(blob: bytes, window: tuple[int, int, int, int] | None = None, bands: list[int] | None = None) -> tuple[np.ndarray, tuple[float, float, float]]:
    """Bands and (x0, y0, step) of a TIFF in strips or tiles, band by band or pixel by pixel, deflated or plain.

    window: first row, first column, height and width, cut at the raster's edge; only the blocks that it meets are unpacked. bands: from 0.
    """
    t, about = _tags(blob), info(blob)
    cols, rows, n, kind = about["width"], about["height"], about["count"], np.dtype(about["dtype"]).newbyteorder("<")
    planar, packed, predictor = n == 1 or t.get(284, (1,))[0] == 2, t.get(259, (1,))[0], t.get(317, (1,))[0]
    if packed not in (1, 8, 32946) or predictor not in (1, 2):
        raise ValueError("this packing is not known")
    wide, high = (about["tile"], t[323][0]) if about["tile"] else (cols, t.get(278, (rows,))[0])
    offsets, sizes = (t[324], t[325]) if about["tile"] else (t[273], t[279])
    across, down = -(-cols // wide), -(-rows // high)
    r0, c0, h, w = window or (0, 0, rows, cols)
    r1, c1 = min(rows, r0 + h), min(cols, c0 + w)
    r0, c0 = max(r0, 0), max(c0, 0)
    wanted = list(range(n)) if bands is None else bands
    out = np.zeros((len(wanted), max(r1 - r0, 0), max(c1 - c0, 0)), dtype=kind)

    def block(k: int, tall: int) -> np.ndarray:
        raw = blob[offsets[k] : offsets[k] + sizes[k]]
        raw = zlib.decompress(raw) if packed != 1 else raw
        a = np.frombuffer(raw, dtype=kind).reshape(tall, wide, 1 if planar else n)
        return np.cumsum(a, axis=1, dtype=kind) if predictor == 2 else a

    for i in range(max(r0, 0) // high, -(-r1 // high) if r1 > r0 else 0):
        tall = high if about["tile"] else min(high, rows - i * high)
        for j in range(c0 // wide, -(-c1 // wide) if c1 > c0 else 0):
            a, b = max(r0, i * high), min(r1, i * high + tall)
            c, d = max(c0, j * wide), min(c1, (j + 1) * wide)
            place = (slice(a - r0, b - r0), slice(c - c0, d - c0))
            cut = (slice(a - i * high, b - i * high), slice(c - j * wide, d - j * wide))
            if planar:
                for z, band in enumerate(wanted):
                    out[z][place] = block((band * down + i) * across + j, tall)[(*cut, 0)]
            else:
                got = block(i * across + j, tall)
                for z, band in enumerate(wanted):
                    out[z][place] = got[(*cut, band)]
    return out, (about["x0"] + c0 * about["step"], about["y0"] - r0 * about["step"], about["step"])


def read_rasters(contents: DataFrame, window: tuple[int, int, int, int] | None = None, bands: list[int] | None = None) -> DataFrame:
    """(path, content), whole or a window and some bands of each, to path, n_bands, rows, cols, x0, y0, step, bands; or an error for a file that cannot be read."""
    schema = pa.schema([("path", pa.string()), ("n_bands", pa.int32()), ("rows", pa.int32()), ("cols", pa.int32()), ("x0", pa.float64()), ("y0", pa.float64()), ("step", pa.float64()), ("bands", pa.list_(pa.list_(pa.float64()))), ("error", pa.string())])

    def run(batches):
        for batch in batches:
            for path, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    b, (x0, y0, step) = decode(blob, window, bands)
                    row = [path, *b.shape, x0, y0, step, b.reshape(len(b), -1).astype(float).tolist(), None]
                except (ValueError, KeyError, StopIteration, struct.error, zlib.error) as e:
                    row = [path, None, None, None, None, None, None, None, str(e) or type(e).__name__]
                yield pa.record_batch([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    return contents.select("path", "content").mapInArrow(run, "path string, n_bands int, rows int, cols int, x0 double, y0 double, step double, bands array<array<double>>, error string")


def encode_bands(rows: int, cols: int, kind: str = "uint16", step: float = 10.0):
    """A column function: (bands array<array<...>>, x0, y0) to TIFF bytes."""
    @F.pandas_udf("binary")
    def run(bands: pd.Series, x0: pd.Series, y0: pd.Series) -> pd.Series:
        return pd.Series([encode(np.array([np.asarray(b) for b in bs]).reshape(-1, rows, cols).astype(kind), x, y, step) for bs, x, y in zip(bands, x0, y0, strict=True)], dtype=object)

    return run


def write_rasters(rasters: DataFrame, folder: str, dtype: str = "uint16", tile: int | None = 256, predictor: int = 2, overwrite: bool = False) -> DataFrame:
    """Write a GeoTIFF for each row (name, rows, cols, bands, x0, y0, step, epsg) under a folder that all executors reach; returns name and written.

    A file that is there stays unless overwrite is set. It is written under a name of its own and then renamed, so a task that runs again leaves no half file.
    """
    schema = pa.schema([("name", pa.string()), ("written", pa.bool_())])

    def run(batches):
        for batch in batches:
            done = []
            for name, rows, cols, bands, x0, y0, step, epsg in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, at = pyarrow.fs.FileSystem.from_uri(f"{folder}/{name}.tif")
                if not overwrite and fs.get_file_info(at).type != pyarrow.fs.FileType.NotFound:
                    done.append(False)
                    continue
                fs.create_dir(at.rpartition("/")[0], recursive=True)
                values = np.array(bands, dtype=float).reshape(-1, rows, cols).astype(dtype)
                with fs.open_output_stream(at + ".part") as out:
                    out.write(encode(values, x0, y0, step, tile, 1 if dtype.startswith("float") else predictor, epsg))
                fs.move(at + ".part", at)
                done.append(True)
            yield pa.record_batch([batch.column(0), pa.array(done, pa.bool_())], schema=schema)

    return rasters.select("name", "rows", "cols", "bands", "x0", "y0", "step", "epsg").mapInArrow(run, "name string, written boolean")
