"""Vector tables: GeoJSON and Parquet in and out."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.functions.geometry import RING, ring_bounds

FEATURE = (
    "struct<type: string, features: array<struct<type: string, properties: map<string, string>, "
    "geometry: struct<type: string, coordinates: string>>>>"
)
#: Columns that are dropped on reading, whatever their case, fixed values.
HELPER_COLUMNS = ("shape_area", "shape_length", "shape_leng")


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """One row for each polygon part of each feature: idx (feature, from 0), part, properties, rings, x0, y0, x1, y1.

    Features without a polygonal geometry are dropped, as are empty ones.
    """
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", FEATURE).alias("d"))
    f = doc.select(F.posexplode("d.features").alias("idx", "f")).select("idx", F.col("f.properties").alias("properties"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("c"))
    f = f.filter(F.col("kind").isin("Polygon", "MultiPolygon"))
    ring = "array<array<array<double>>>"
    parts = F.when(F.col("kind") == "Polygon", F.array(F.from_json("c", ring))).otherwise(F.from_json("c", f"array<{ring}>"))
    f = f.select("idx", "properties", F.posexplode(parts).alias("part", "rings")).filter(F.size("rings") > 0)
    point = lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
    f = f.withColumn("rings", F.transform("rings", lambda r: F.transform(r, point)))
    return f.withColumn("b", ring_bounds(F.col("rings")[0])).select("idx", "part", "properties", "rings", "b.*")


def write_geojson(df: DataFrame, path: str, properties: list[str], ring: str = "ring") -> None:
    """One feature a line (newline-delimited GeoJSON), replacing what is there."""
    coords = F.transform(ring, lambda p: F.array(p["x"], p["y"]))
    props = F.struct(*properties) if properties else F.create_map()
    feature = F.struct(F.lit("Feature").alias("type"), props.alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(coords).alias("coordinates")).alias("geometry"))
    df.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Features written by write_geojson: properties and ring."""
    one = "struct<properties: map<string, string>, geometry: struct<type: string, coordinates: array<array<array<double>>>>>"
    got = spark.read.text(path).select(F.from_json("value", one).alias("f"))
    return got.select(F.col("f.properties").alias("properties"), F.transform(F.col("f.geometry.coordinates")[0], lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))).alias("ring"))


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.lower() in HELPER_COLUMNS])


def write_grid(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _wkb(points: list) -> bytes:
    return struct.pack("<I", len(points)) + b"".join(struct.pack("<dd", p["x"], p["y"]) for p in points)


@F.pandas_udf(T.BinaryType())
def to_wkb(parts: pd.Series) -> pd.Series:
    """Polygons (array of rings, outer first) as one WKB geometry: a Polygon, or a MultiPolygon of several; null for none."""

    def polygon(rings) -> bytes:
        return struct.pack("<BII", 1, 3, len(rings)) + b"".join(_wkb(r) for r in rings)

    def one(polygons):
        if polygons is None or not len(polygons):
            return None
        if len(polygons) == 1:
            return polygon(polygons[0])
        return struct.pack("<BII", 1, 6, len(polygons)) + b"".join(map(polygon, polygons))

    return pd.Series([one(p) for p in parts], dtype=object)


def _read_wkb(blob: bytes) -> list | None:
    """Polygons of a WKB Polygon or MultiPolygon in either byte order, further dimensions left out; None for another kind."""
    at = 0

    def number(form: str, order: str):
        nonlocal at
        got = struct.unpack_from(order + form, blob, at)
        at += struct.calcsize(order + form)
        return got

    def geometry():
        nonlocal at
        order = "<" if blob[at] == 1 else ">"
        at += 1
        kind = number("I", order)[0]
        if kind & 0x20000000:
            at += 4  # a reference system
        extra = (kind & 0xC0000000).bit_count() + {0: 0, 1: 1, 2: 1, 3: 2}.get((kind & 0xFFFF) // 1000, 0)
        kind = (kind & 0xFFFF) % 1000
        if kind == 3:
            rings = []
            for _ in range(number("I", order)[0]):
                flat = [number(f"{2 + extra}d", order) for _ in range(number("I", order)[0])]
                rings.append([{"x": p[0], "y": p[1]} for p in flat])
            return [rings] if rings else []
        if kind == 6:
            return [p for _ in range(number("I", order)[0]) for p in geometry() or []]
        return None

    return geometry()


@F.pandas_udf(T.ArrayType(T.ArrayType(RING)))
def from_wkb(blobs: pd.Series) -> pd.Series:
    """Polygons of WKB geometries; null for null, empty and other kinds."""
    return pd.Series([(_read_wkb(bytes(b)) or None) if b is not None else None for b in blobs], dtype=object)


def read_geoparquet(spark: SparkSession, path: str, geometry: str = "geometry") -> DataFrame:
    """A table whose geometry column holds WKB: polygons (parts, null for others) and bounds x0, y0, x1, y1 in its place."""
    df = spark.read.parquet(path).withColumn("parts", from_wkb(F.col(geometry))).drop(geometry)
    every = F.flatten(F.flatten("parts"))
    return df.withColumn("_b", F.when(F.col("parts").isNotNull(), ring_bounds(every))).select("*", *[F.col(f"_b.{k}") for k in ("x0", "y0", "x1", "y1")]).drop("_b")


def write_geoparquet(df: DataFrame, path: str, parts: str = "parts", geometry: str = "geometry") -> None:
    """The table with its polygons as WKB in a geometry column, replacing what is there."""
    df.withColumn(geometry, to_wkb(F.col(parts))).drop(parts).write.mode("overwrite").parquet(path)
