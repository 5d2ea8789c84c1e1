"""Map projections, the same formulas for columns and for NumPy arrays, and the choice of a projected system.

Systems by code: EPSG:4326 and EPSG:4674 (degrees), EPSG:326zz and EPSG:327zz (UTM), EPSG:5880 (Brazil Polyconic) and BRAZIL:ALBERS. WGS 84 and SIRGAS
2000 are taken as one datum. Formulas are those of Snyder's "Map Projections, a Working Manual"; where the inverse has none, Newton steps are.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _repeat_column(start: Column, step, n: int) -> Column:
    # a lambda's variable stands for the whole value, so the expression does not grow with the steps
    return F.aggregate(F.array_repeat(F.lit(0), n), start, lambda v, _: step(v))


def _repeat_array(start, step, n: int):
    for _ in range(n):
        start = step(start)
    return start


COLUMNS = SimpleNamespace(
    sin=F.sin, cos=F.cos, tan=F.tan, sqrt=F.sqrt, log=F.log, asin=F.asin, atan2=F.atan2, power=lambda x, k: F.pow(x, F.lit(k)), where=lambda c, a, b: F.when(c, a).otherwise(b), repeat=_repeat_column, pi=math.pi,
)
ARRAYS = SimpleNamespace(sin=np.sin, cos=np.cos, tan=np.tan, sqrt=np.sqrt, log=np.log, asin=np.arcsin, atan2=np.arctan2, power=np.power, where=np.where, repeat=_repeat_array, pi=math.pi)


@dataclass(frozen=True)
class Ellipsoid:
    a: float
    flat: float

    @property
    def e2(self) -> float:
        return self.flat * (2 - self.flat)


#: Fixed values.
WGS84, GRS80 = Ellipsoid(6378137.0, 1 / 298.257223563), Ellipsoid(6378137.0, 1 / 298.257222101)


def _arc(e2: float) -> list[float]:
    """Factors of phi, sin 2 phi, sin 4 phi, sin 6 phi in the length of the meridian."""
    return [1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256, -(3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024), 15 * e2**2 / 256 + 45 * e2**3 / 1024, -35 * e2**3 / 3072]


def meridian(phi, e2: float, m):
    c = _arc(e2)
    return c[0] * phi + c[1] * m.sin(2 * phi) + c[2] * m.sin(4 * phi) + c[3] * m.sin(6 * phi)


def utm(lon, lat, zone: int, south: bool, m=COLUMNS):
    """Transverse Mercator of a zone; south adds 10,000 km to y."""
    k0, e2, a = 0.9996, WGS84.e2, WGS84.a
    ep = e2 / (1 - e2)
    phi, lam = lat * (m.pi / 180), (lon - (zone * 6 - 183)) * (m.pi / 180)
    n = a / m.sqrt(1 - e2 * m.power(m.sin(phi), 2))
    t, c, big = m.power(m.tan(phi), 2), ep * m.power(m.cos(phi), 2), m.cos(phi) * lam
    x = k0 * n * (big + (1 - t + c) * m.power(big, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep) * m.power(big, 5) / 120) + 500000
    y = k0 * (a * meridian(phi, e2, m) + n * m.tan(phi) * (big * big / 2 + (5 - t + 9 * c + 4 * c * c) * m.power(big, 4) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep) * m.power(big, 6) / 720))
    return x, y + (10_000_000 if south else 0)


def utm_inverse(x, y, zone: int, south: bool, m=COLUMNS):
    k0, e2, a = 0.9996, WGS84.e2, WGS84.a
    ep, e1 = e2 / (1 - e2), (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    mu = (y - (10_000_000 if south else 0)) / k0 / (a * _arc(e2)[0])
    foot = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * m.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * m.sin(4 * mu) + (151 * e1**3 / 96) * m.sin(6 * mu) + (1097 * e1**4 / 512) * m.sin(8 * mu)
    w = 1 - e2 * m.power(m.sin(foot), 2)
    n, r = a / m.sqrt(w), a * (1 - e2) / m.power(w, 1.5)
    t, c, d = m.power(m.tan(foot), 2), ep * m.power(m.cos(foot), 2), (x - 500000) / (n * k0)
    lat = foot - n * m.tan(foot) / r * (d * d / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * ep) * m.power(d, 4) / 24 + (61 + 90 * t + 298 * c + 45 * t * t - 252 * ep - 3 * c * c) * m.power(d, 6) / 720)
    lon = (d - (1 + 2 * t + c) * m.power(d, 3) / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * ep + 24 * t * t) * m.power(d, 5) / 120) / m.cos(foot)
    return lon * (180 / m.pi) + (zone * 6 - 183), lat * (180 / m.pi)


#: Brazil Polyconic: origin (0, -54), false easting and northing; Brazil Albers: parallels -12 and -32, the same origin, none. Fixed values.
POLYCONIC = {"lon_0": -54.0, "x_0": 5_000_000.0, "y_0": 10_000_000.0}
ALBERS = {"lon_0": -54.0, "lat_0": 0.0, "lat_1": -12.0, "lat_2": -32.0}
STEPS = 8


def polyconic(lon, lat, m=COLUMNS):
    """American polyconic on GRS 80."""
    e2, a = GRS80.e2, GRS80.a
    phi, lam = lat * (m.pi / 180), (lon - POLYCONIC["lon_0"]) * (m.pi / 180)
    s = m.where(phi == 0, phi * 0 + 1.0, m.sin(phi))
    n, e = a / m.sqrt(1 - e2 * s * s), lam * s
    cot = m.cos(phi) / s
    x = m.where(phi == 0, a * lam, n * cot * m.sin(e))
    y = m.where(phi == 0, phi * 0, a * meridian(phi, e2, m) + n * cot * (1 - m.cos(e)))
    return x + POLYCONIC["x_0"], y + POLYCONIC["y_0"]


def polyconic_inverse(x, y, m=COLUMNS):
    e2, a, k = GRS80.e2, GRS80.a, _arc(GRS80.e2)
    u, v = (x - POLYCONIC["x_0"]) / a, (y - POLYCONIC["y_0"]) / a
    level = v == 0
    at = m.where(level, v * 0 + 0.1, v)
    b = u * u + at * at

    def step(phi):
        c = m.sqrt(1 - e2 * m.power(m.sin(phi), 2)) * m.tan(phi)
        ma = meridian(phi, e2, m)
        slope = k[0] + 2 * k[1] * m.cos(2 * phi) + 4 * k[2] * m.cos(4 * phi) + 6 * k[3] * m.cos(6 * phi)
        up = at * (c * ma + 1) - ma - (ma * ma + b) * c / 2
        down = e2 * m.sin(2 * phi) * (ma * ma + b - 2 * at * ma) / (4 * c) + (at - ma) * (c * slope - 2 / m.sin(2 * phi)) - slope
        return phi - up / down

    phi = m.repeat(at, step, STEPS)
    c = m.sqrt(1 - e2 * m.power(m.sin(phi), 2)) * m.tan(phi)
    lam = m.asin(u * c) / m.sin(phi)
    return m.where(level, u, lam) * (180 / m.pi) + POLYCONIC["lon_0"], m.where(level, v, phi) * (180 / m.pi)


def _q(s, e2: float, log):
    e = math.sqrt(e2)
    return (1 - e2) * (s / (1 - e2 * s * s) - log((1 - e * s) / (1 + e * s)) / (2 * e))


def _albers() -> tuple[float, float, float]:
    e2, rad = GRS80.e2, math.pi / 180
    s0, s1, s2 = (math.sin(ALBERS[k] * rad) for k in ("lat_0", "lat_1", "lat_2"))
    m1, m2 = ((1 - s * s) / (1 - e2 * s * s) for s in (s1, s2))
    n = (m1 - m2) / (_q(s2, e2, math.log) - _q(s1, e2, math.log))
    c = m1 + n * _q(s1, e2, math.log)
    return n, c, GRS80.a * math.sqrt(c - n * _q(s0, e2, math.log)) / n


def albers(lon, lat, m=COLUMNS):
    """Albers equal-area conic on GRS 80."""
    n, c, r0 = _albers()
    r = GRS80.a * m.sqrt(c - n * _q(m.sin(lat * (m.pi / 180)), GRS80.e2, m.log)) / n
    t = n * (lon - ALBERS["lon_0"]) * (m.pi / 180)
    return r * m.sin(t), r0 - r * m.cos(t)


def albers_inverse(x, y, m=COLUMNS):
    n, c, r0 = _albers()
    e2, a, sign = GRS80.e2, GRS80.a, 1.0 if n > 0 else -1.0
    dy = r0 - y
    q = (c - (x * x + dy * dy) * n * n / (a * a)) / n
    t = m.atan2(sign * x, sign * dy)

    def step(phi):
        s = m.sin(phi)
        w = 1 - e2 * s * s
        return phi + w * w / (2 * m.cos(phi)) * ((q - _q(s, e2, m.log)) / (1 - e2))

    phi = m.repeat(m.asin(q / 2), step, STEPS)
    return ALBERS["lon_0"] + t / n * (180 / m.pi), phi * (180 / m.pi)


GEOGRAPHIC = ("EPSG:4326", "EPSG:4674")


def system(crs: str):
    """(from degrees, to degrees) of a system; each takes two coordinates and the kind of mathematics."""
    name = crs.upper()
    zone = re.fullmatch(r"EPSG:32([67])(\d\d)", name)
    if name in GEOGRAPHIC:
        same = lambda x, y, m=COLUMNS: (x, y)
        return same, same
    if zone and 1 <= int(zone[2]) <= 60:
        n, south = int(zone[2]), zone[1] == "7"
        return (lambda x, y, m=COLUMNS: utm(x, y, n, south, m)), (lambda x, y, m=COLUMNS: utm_inverse(x, y, n, south, m))
    if name == "EPSG:5880":
        return polyconic, polyconic_inverse
    if name == "BRAZIL:ALBERS":
        return albers, albers_inverse
    raise ValueError(f"no projection is known for {crs}")


def convert(x, y, source: str, target: str, m=COLUMNS):
    """Coordinates from one system to another, by way of degrees."""
    if source.upper() == target.upper():
        return x, y
    return system(target)[0](*system(source)[1](x, y, m), m)


def convert_ring(ring: Column, source: str, target: str) -> Column:
    """A ring with every corner converted."""
    if source.upper() == target.upper():
        return ring

    def one(p: Column) -> Column:
        x, y = convert(p["x"], p["y"], source, target)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(ring, one)


def zone_of(lon: float, lat: float) -> str:
    """The UTM zone of a point, north of the equator 326zz, else 327zz."""
    return f"EPSG:{(32600 if lat >= 0 else 32700) + math.floor((lon + 180) / 6) + 1}"


def projected(df: DataFrame, ring: str, crs: str | None, if_missing: str | None = None, target: str | None = None, brazil: bool = True) -> tuple[DataFrame, str]:
    """df with its rings in a system of metres, and that system.

    A missing system is if_missing, or an error. Then: the target if there is one, else Brazil's polyconic system if asked, else, for degrees, the UTM zone of
    the middle of all bounds (one row goes to the driver), else as it is.
    """
    crs = crs or if_missing
    if crs is None:
        raise ValueError("the polygons have no coordinate system; give one in if_missing")
    if target is None and brazil:
        target = "EPSG:5880"
    if target is None and crs.upper() in GEOGRAPHIC:
        xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
        b = df.agg(F.min(F.array_min(xs)).alias("x0"), F.max(F.array_max(xs)).alias("x1"), F.min(F.array_min(ys)).alias("y0"), F.max(F.array_max(ys)).alias("y1")).first()
        target = crs if b.x0 is None else zone_of((b.x0 + b.x1) / 2, (b.y0 + b.y1) / 2)
    target = target or crs
    return df.withColumn(ring, convert_ring(F.col(ring), crs, target)), target


def convert_rings(source: str):
    """A function of (ring, system) to the ring in that system, each row with its own; rows of one system are converted together. Null stays null."""

    def work(rings: pd.Series, systems: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(rings), index=rings.index, dtype=object)
        for crs, rows in rings[rings.notna() & systems.notna()].groupby(systems):
            size = np.array([len(r) for r in rows])
            x, y = (np.array([p[c] for r in rows for p in r], dtype=float) for c in "xy")
            x, y = convert(x, y, source, crs, ARRAYS)
            flat = [{"x": a, "y": b} for a, b in zip(np.broadcast_to(x, y.shape).tolist(), y.tolist(), strict=True)]
            for i, a, n in zip(rows.index, np.cumsum(size) - size, size, strict=True):
                out[i] = flat[a : a + n]
        return out

    return F.pandas_udf(work, "array<struct<x:double,y:double>>")


def bounds_in(target: str, steps: int = 21):
    """A function of (x0, y0, x1, y1, system) to the bounds (x0, y0, x1, y1) of that box in another system, from points along its sides."""

    def work(x0: pd.Series, y0: pd.Series, x1: pd.Series, y1: pd.Series, systems: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame(np.nan, index=x0.index, columns=["x0", "y0", "x1", "y1"])
        t = np.linspace(0, 1, steps + 1)
        for crs, rows in systems.groupby(systems):
            a, b, c, d = (v[rows.index].to_numpy(float)[:, None] for v in (x0, y0, x1, y1))
            xs, ys = a + (c - a) * t, b + (d - b) * t
            x, y = convert(np.concatenate((xs, xs, a + 0 * t, c + 0 * t), axis=1), np.concatenate((b + 0 * t, d + 0 * t, ys, ys), axis=1), crs, target, ARRAYS)
            out.loc[rows.index] = np.stack((x.min(axis=1), y.min(axis=1), x.max(axis=1), y.max(axis=1)), axis=1)
        return out

    return F.pandas_udf(work, "x0 double, y0 double, x1 double, y1 double")
