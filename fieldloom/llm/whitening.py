"""Embedding whitening: covariance of whole-number vectors, its leading eigenvectors, projection to unit variance.

The number of vectors and their sums are exact. The covariance is summed over tasks from blocks that are centred before they are multiplied, and
blocks are merged with their means, row by row, so no task ever holds more than one d x d matrix. Its eigenvectors are found on the driver, whose
work depends on the dimension d alone: Householder reflections to a tridiagonal matrix, bisection on Sturm counts for the leading
eigenvalues, inverse iteration for their vectors, made orthogonal within clusters of close values. The projection is
broadcast (d x k) and every vector projected where it is read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OFFSET = 1_000_000
HELD = 2.0**40
ROWS = 2_000


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Diagonal and off-diagonal of Q'VQ, and the Householder vectors of Q in the order in which they were applied."""
    a, d, reflectors = v.astype(float).copy(), len(v), []
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0 or not x[1:].any():
            continue
        x[0] += norm if x[0] >= 0 else -norm
        x /= np.linalg.norm(x)
        # A - 2 x w' - 2 w x' with w = Ax - (x'Ax) x, on the rest of the matrix
        a[k + 1 :, k:] -= 2 * np.outer(x, x @ a[k + 1 :, k:])
        a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ x, x)
        reflectors.append((k + 1, x))
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def count_below(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eigenvalues below each of the values `at`: negative pivots of T - at (Sturm's count)."""
    square, tiny = off**2, np.finfo(float).tiny / np.finfo(float).eps
    pivot, n = diag[0] - at, np.zeros(len(at), int)
    for i in range(len(diag)):
        if i:
            pivot = diag[i] - at - square[i - 1] / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        n += pivot < 0
    return n


def leading_values(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection of all their intervals at once."""
    pad = np.concatenate(([0.0], np.abs(off), [0.0]))
    reach = pad[:-1] + pad[1:]
    lo, hi = np.full(k, (diag - reach).min()), np.full(k, (diag + reach).max())
    rank = len(diag) - 1 - np.arange(k)
    for _ in range(2000):
        mid = lo + (hi - lo) / 2
        if not ((mid > lo) & (mid < hi)).any():
            break
        # the rank-th value (from 0, rising) lies below mid if more than rank values do
        under = count_below(diag, off, mid) > rank
        lo, hi = np.where(under, lo, mid), np.where(under, mid, hi)
    return lo + (hi - lo) / 2


def _solve(diag: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, floor: float) -> np.ndarray:
    """(T - shift) y = b by elimination with row exchanges; pivots smaller than floor are set to it."""
    n = len(diag)
    u = np.zeros((n, 3))
    x, row = b.copy(), np.array([diag[0] - shift, off[0] if n > 1 else 0.0, 0.0])
    for i in range(n - 1):
        below = np.array([off[i], diag[i + 1] - shift, off[i + 1] if i + 2 < n else 0.0])
        if abs(below[0]) > abs(row[0]):
            row, below = below, row
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(row[0]) < floor:
            row[0] = floor
        u[i] = row
        f = below[0] / row[0]
        x[i + 1] -= f * x[i]
        row = np.array([below[1] - f * row[1], below[2] - f * row[2], 0.0])
    u[-1] = [row[0] if abs(row[0]) >= floor else floor, 0.0, 0.0]
    for i in range(n - 1, -1, -1):
        x[i] = (x[i] - (u[i, 1] * x[i + 1] if i + 1 < n else 0) - (u[i, 2] * x[i + 2] if i + 2 < n else 0)) / u[i, 0]
        if abs(x[i]) > 1e200:
            x *= 1e-200
    return x


def tridiagonal_vectors(diag: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors (columns) for the values by inverse iteration; within a cluster of close values each is held orthogonal to those before it."""
    n, eps = len(diag), np.finfo(float).eps
    scale = max(np.abs(diag).max() + 2 * np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    rng, out, cluster, before = np.random.default_rng(7), np.zeros((n, len(values))), 0, None
    for j, value in enumerate(values):
        if before is not None and before - value > 1e-3 * scale:
            cluster = j
        # equal values are told apart a little
        shift = min(value, values[j - 1] - eps * scale) if j > cluster else value
        y = rng.standard_normal(n)
        for _ in range(5):
            y = _solve(diag, off, shift, y / np.linalg.norm(y), eps * scale)
            for _ in range(2):
                y -= out[:, cluster:j] @ (out[:, cluster:j].T @ y)
            y /= np.linalg.norm(y)
        out[:, j], before = y, value
    return out


def leading_components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a covariance; values that rounding could have made are left out."""
    d = len(v)
    if not d or not np.trace(v) > 0:
        return np.zeros(0), np.zeros((d, 0))
    diag, off, reflectors = tridiagonal(v)
    values = leading_values(diag, off, min(k, d))
    values = values[values > 64 * d * np.finfo(float).eps * values[0]]
    vectors = tridiagonal_vectors(diag, off, values)
    for first, x in reversed(reflectors):
        vectors[first:] -= 2 * np.outer(x, x @ vectors[first:])
    values = np.einsum("ik,ik->k", vectors, v @ vectors)
    # one sign for all rows and runs: the largest entry is positive
    top = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[top, np.arange(len(values))] < 0, -1.0, 1.0)


def whole(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Keys of the rows whose vector (second column) has finite entries alone, floor(64 c) of them padded with zeros, and their lengths."""
    keys, col = batch.column(0), batch.column(1)
    size = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(float)
    row = np.repeat(np.arange(len(size)), size)
    good = col.is_valid().to_numpy(zero_copy_only=False) & (np.bincount(row, ~np.isfinite(flat), len(size)) == 0)
    width = int(size[good].max(initial=0))
    out = np.zeros((int(good.sum()), width), np.int64)
    take = good[row]
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    with np.errstate(over="ignore"):
        y = np.clip(np.floor(64 * flat[take]), -HELD, HELD)
    out[(np.cumsum(good) - 1)[row[take]], place[take]] = y.astype(np.int64)
    return keys.filter(pa.array(good)), out, size[good]


def _sums(batches):
    total, n = [], 0
    for batch in batches:
        y = whole(batch)[1]
        n += len(y)
        total += [0] * (y.shape[1] - len(total))
        for j, s in enumerate(y.sum(axis=0).tolist()):
            total[j] += s
    yield pa.record_batch([pa.array([-1, *range(len(total))], pa.int32()), pa.array([str(n), *map(str, total)])], names=["pos", "total"])


def _merge(one: tuple, two: tuple) -> tuple:
    """Of two parts (n, mean, rows of summed products about the mean, the places of these rows), the whole."""
    n, mean, rows, at = one
    m, other, more, _ = two
    step = other - mean
    return n + m, mean + step * (m / (n + m)), rows + more + np.outer(step[at], step) * (n * m / (n + m)), at


def _products(project):
    """Products of centred blocks: a task's rows i of its matrix, with its n and means."""

    def run(batches):
        held = None
        for batch in batches:
            x = project(whole(batch)[1])
            if len(x):
                mean = x.mean(axis=0)
                c = x - mean
                part = (len(x), mean, c.T @ c, np.arange(x.shape[1]))
                held = part if held is None else _merge(held, part)
        if held is not None:
            n, mean, rows, _ = held
            yield pa.record_batch([pa.array(range(len(rows)), pa.int32()), pa.array([n] * len(rows), pa.int64()), pa.array([mean.tolist()] * len(rows)), pa.array(rows.tolist())], names=["i", "n", "mean", "row"])

    return run


def _add_up(batches):
    held, now = None, None

    def done():
        return pa.record_batch([pa.array([now], pa.int32()), pa.array([held[0]], pa.int64()), pa.array([held[2][0].tolist()])], names=["i", "n", "row"])

    for batch in batches:
        for i, n, mean, row in zip(*batch.columns, strict=True):
            i = i.as_py()
            part = (n.as_py(), mean.values.to_numpy(), row.values.to_numpy()[None, :], np.array([i]))
            if i != now:
                if held:
                    yield done()
                held, now = part, i
            else:
                held = _merge(held, part)
    if held:
        yield done()


def _covariance(given: DataFrame, project, d: int) -> np.ndarray:
    """Covariance (divisor n) of the projected vectors; the driver receives d rows of d numbers."""
    parts = given.mapInArrow(_products(project), "i int, n bigint, mean array<double>, row array<double>")
    rows = parts.repartition("i").sortWithinPartitions("i").mapInArrow(_add_up, "i int, n bigint, row array<double>").collect()
    out = np.zeros((d, d))
    for r in rows:
        out[r.i] = np.array(r.row) / r.n
    return (out + out.T) / 2


def _centred(n: int, sums: list[int]):
    """x - S / n from floor(64 c): whole part and rest of the mean apart, so nothing is lost in large numbers."""
    base = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])

    def project(y: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(y), len(base)), np.int64)
        wide[:, : y.shape[1]] = y
        return (wide - base) - rest

    return project


def _deviation(y: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n y - S)^2 of each row, exact; null beyond 63 bits."""
    s = np.array(sums, object)
    rough = np.abs(n * y.astype(float) - s.astype(float)).max(initial=0.0)
    if len(sums) * rough * rough < 2.0**62 and n * float(np.abs(y).max(initial=0)) < 2.0**62:
        return ((n * y - s.astype(np.int64)) ** 2).sum(axis=1).tolist()
    every = [sum((n * a - b) ** 2 for a, b in zip(row, sums, strict=True)) for row in y.tolist()]
    return [x if x < 2**63 else None for x in every]


def _whiten(sent, n: int, sums: list[int], explained: list[float], error: float):
    def run(batches):
        weights, k = sent.value, len(explained)
        centre = _centred(n, sums)
        for batch in batches:
            keys, y, _ = whole(batch)
            for a in range(0, len(y), ROWS):
                x = np.zeros((min(ROWS, len(y) - a), len(sums)), np.int64)
                x[:, : y.shape[1]] = y[a : a + ROWS]
                m = len(x)
                yield pa.record_batch(
                    [
                        keys.slice(a, m).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                        pa.array(np.full(m * k, n), pa.int64()),
                        pa.array(_deviation(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array((centre(x) @ weights).reshape(-1)),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 32) -> DataFrame:
    """key, component (1 .. k by falling variance), n, deviation, whitened, explained, identity_error for each vector and component.

    Rows whose vector is null or holds a null, NaN or infinite entry are dropped. Of an entry c, x = floor(64 c) + 1,000,000 counts. Three passes
    gather the sums, the covariance and the covariance of what was whitened; they run when this is called, and their results travel
    with the plan. Covariances have divisor n.

    Edge cases: directions without variance (up to rounding: 64 d eps of the largest) have no component, so one vector, or copies of one, give no
    rows, as does an empty table; shorter vectors (an empty one too) count as filled up with zeros; floor(64 c) is held within +-2^40; a deviation beyond 63 bits is null;
    null keys stay; repeated rows are vectors of their own; other columns are ignored, whatever their names. Keys keep their type. The driver
    and each task hold d x d numbers.
    """
    spark = table.sparkSession
    given = table.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    kind = given.schema["key"].dataType
    out = T.StructType([T.StructField("key", kind), *T._parse_datatype_string("component int, n bigint, deviation bigint, whitened double, explained double, identity_error double").fields])
    totals = given.mapInArrow(_sums, "pos int, total string").groupBy("pos").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    # one row a dimension
    found = {r.pos: int(r.total) for r in totals.collect()}
    n = found.pop(-1, 0)
    sums = [found[j] for j in range(len(found))]
    centre = _centred(n, sums) if n else None
    covariance = _covariance(given, centre, len(sums)) if n and sums else np.zeros((0, 0))
    values, vectors = leading_components(covariance, k)
    if not len(values):
        return spark.createDataFrame([], out)
    sent = spark.sparkContext.broadcast(vectors / np.sqrt(values))
    white = _covariance(given, lambda y: centre(y) @ sent.value, len(values))
    error = float(np.abs(white - np.eye(len(values))).max())
    explained = (values / np.trace(covariance)).tolist()
    return given.mapInArrow(_whiten(sent, n, sums, explained, error), out)
