"""Chip scores for active learning, and selections by them."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.functions import geometry as G


def zonal_mode(pixels: DataFrame, zone: str, value: str) -> DataFrame:
    """The most frequent positive value of each zone (the smallest among equals)."""
    counts = pixels.filter(F.col(value) > 0).groupBy(zone, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(zone).agg(F.max_by(value, F.struct("n", -F.col(value))).alias("mode"))


def zonal_or_sampled(pixels: DataFrame, zones: DataFrame, cells: DataFrame, value: str, x_start: float, y_start: float, step: float) -> DataFrame:
    """The mode of each zone (zone, mode, sampled); of a zone without any positive pixel the raster's value at its centroid, null if that is not positive either.

    pixels: zone, value; zones: zone, ring; cells: row, col, value, one row a pixel of the raster whose first one starts at x_start, y_start.
    """
    modes = zonal_mode(pixels, "zone", value)
    empty = zones.join(modes, "zone", "left_anti").withColumn("_c", G.ring_centroid(F.col("ring"))).select("zone", F.col("_c.x").alias("_x"), F.col("_c.y").alias("_y"))
    at = empty.withColumns({"row": F.floor((F.col("_y") - y_start) / step).cast("bigint"), "col": F.floor((F.col("_x") - x_start) / step).cast("bigint")})
    found = at.join(cells.filter(F.col(value) > 0).select(F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col"), F.col(value).alias("mode")), ["row", "col"], "left")
    return modes.select("zone", "mode", F.lit(False).alias("sampled")).unionByName(found.select("zone", "mode", F.lit(True).alias("sampled")))


def cloud_fraction(pixels: DataFrame, zone: str, scl: str = "scl") -> DataFrame:
    """Share of cloud classes 8 and 9 among valid pixels (class not 0); null where none is valid."""
    valid = F.count_if(F.col(scl) != 0)
    return pixels.groupBy(zone).agg((F.count_if(F.col(scl).isin(8, 9)) / F.nullif(valid, F.lit(0))).alias("cloud_fraction"))


def clear(prob: str = "prob", scl: str = "scl"):
    """Pixels free of cloud: probability below 30 and none of the classes 3, 8, 9, 10, 11."""
    return (F.col(prob) < 30) & ~F.col(scl).isin(3, 8, 9, 10, 11)


#: Land-cover classes that count as agriculture, fixed values.
AGRICULTURE = [9, 14, 15, 18, 19, 20, 21, 35, 36, 39, 40, 41, 46, 47, 48, 57, 58, 62]


def chip_scores(pixels: DataFrame, chip: str = "chip") -> DataFrame:
    """pixels: chip, conf, pred (0 background, 1 interior, 2 boundary), ag (boolean). Means, population deviation, fractions and differences.

    confidence_mean_ag is NaN (not null) where no pixel is agriculture.
    """
    n = F.count(F.lit(1))
    ag = F.count_if("ag") / n
    every, inner = F.count_if(F.col("pred") > 0) / n, F.count_if(F.col("pred") == 1) / n
    return pixels.groupBy(chip).agg(
        F.avg("conf").alias("confidence_mean"),
        F.stddev_pop("conf").alias("confidence_std"),
        F.coalesce(F.avg(F.when(F.col("ag"), F.col("conf"))), F.lit(float("nan"))).alias("confidence_mean_ag"),
        ag.alias("lc_ag_frac"),
        every.alias("pred_frac_all"),
        inner.alias("pred_frac_interiors"),
        (ag - every).alias("metric_all"),
        (ag - inner).alias("metric_interiors"),
    )


def padding_ok(zeros, total, most: float = 0.15):
    """The share of zero samples over all bands is small enough."""
    return zeros / total <= most


def most_discrepant(scores: DataFrame, metric: str, n: int, key: str) -> DataFrame:
    """The n largest by absolute value, by key among equals (a partial sort on each task, merged)."""
    return scores.orderBy(F.abs(F.col(metric)).desc(), key).limit(n)


def least_confident(scores: DataFrame, n: int, key: str, least_ag: float | None = None) -> DataFrame:
    """The n least confident over all their pixels, by key among equals; only chips with enough agriculture where that is asked."""
    if least_ag is not None:
        scores = scores.filter(F.col("lc_ag_frac") >= least_ag)
    return scores.orderBy("confidence_mean", key).limit(n)


def seeded(key: str, seed: int):
    """An order of keys by a seeded hash, the same in every run and engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows chosen by a seeded hash of the key: the same rows in every run."""
    return df.orderBy(seeded(key, seed), key).limit(n)


def score_lines(scores: DataFrame, *columns: str):
    """Each row's scores as one JSON object; a number that is none is written as NaN, without quotes (as Python's json does)."""
    fields = []
    for c in columns:
        name, kind = F.lit(json.dumps(c) + ":"), scores.schema[c].dataType
        # to_json of a one-field object, without its braces and name, writes any other value
        value = F.regexp_extract(F.to_json(F.struct(F.col(c).alias("v")), {"ignoreNullFields": "false"}), r'(?s)^\{"v":(.*)\}$', 1)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            value = F.when(F.isnan(c), "NaN").when(F.col(c) == float("inf"), "Infinity").when(F.col(c) == float("-inf"), "-Infinity").otherwise(value)
        fields.append(F.concat(name, value))
    return scores.withColumn("line", F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")))


def disjoint_split(df: DataFrame, key: str, seed: int, sizes: dict[str, int]) -> DataFrame:
    """Rows of disjoint seeded samples of these sizes, with the sample's name in `part`."""
    total = sum(sizes.values())
    ranked = seeded_sample(df, key, total, seed)
    # `total` rows
    ranked = ranked.withColumn("_rn", F.row_number().over(W.orderBy(seeded(key, seed), key)))
    part, upto = F.lit(None).cast("string"), total
    for name, size in reversed(list(sizes.items())):
        part = F.when(F.col("_rn") <= upto, name) if upto == total else F.when(F.col("_rn") <= upto, name).otherwise(part)
        upto -= size
    return ranked.withColumn("part", part).drop("_rn")
