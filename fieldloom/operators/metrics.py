"""Segmentation metrics and losses as aggregates over (pixel, class, probability, truth) tables."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def object_scores(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """Precision, recall and F1; 0 where a denominator is."""
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    return {"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)}


def confusion(df: DataFrame, truth: str = "y", pred: str = "p", ignore: int | None = None) -> DataFrame:
    if ignore is not None:
        df = df.filter(F.col(truth) != ignore)
    return df.groupBy(F.col(truth).alias("y"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall and Jaccard of each class in the truth or the prediction (cls, tp, fp, fn, ...), 0 where undefined."""
    hit = F.col("y") == F.col("p")
    sides = counts.select(
        F.explode(F.array(F.struct(F.col("y").alias("cls"), F.when(hit, F.col("n")).otherwise(0).alias("tp"), F.lit(0).cast("bigint").alias("fp"), F.when(hit, 0).otherwise(F.col("n")).alias("fn")),
                          F.struct(F.col("p").alias("cls"), F.lit(0).cast("bigint").alias("tp"), F.when(hit, 0).otherwise(F.col("n")).alias("fp"), F.lit(0).cast("bigint").alias("fn")))).alias("s")
    ).select("s.*")
    got = sides.groupBy("cls").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return got.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "jaccard": ratio(tp, tp + fp + fn)})


def overall(metrics: DataFrame) -> DataFrame:
    """Macro means over the classes present, and micro accuracy."""
    return metrics.agg(F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"), F.avg("jaccard").alias("macro_jaccard"), (F.sum("tp") / F.sum(F.col("tp") + F.col("fn"))).alias("micro"))


def consensus(crops: DataFrame, by: str) -> DataFrame:
    """crops: by, r, c, corner, cls over the shared overlap of four crops. Share of pixels on which all four agree."""
    pixel = crops.groupBy(by, "r", "c").agg((F.min("cls") == F.max("cls")).cast("int").alias("same"), F.count(F.lit(1)).alias("n")).filter("n = 4")
    return pixel.groupBy(by).agg(F.avg("same").alias("consensus"))


#: The weight of a class without pixels, fixed value.
ABSENT = 1e-5


def inverse_frequency(n: Column, total: Column) -> Column:
    """Weight of a class of n pixels: its inverse share, where those of the classes present sum to 1 (total: sum of 1 / n over them)."""
    return F.when(n > 0, 1 / (n * total)).otherwise(F.lit(ABSENT))


def class_weights(df: DataFrame, cls: str, n_classes: int, ignore: int | None = None) -> DataFrame:
    """Inverse frequencies of classes 0 .. n_classes - 1 (cls, weight): those of the classes present sum to 1, the others weigh 1e-5.

    Pixels of the ignored class and of classes out of range count nowhere.
    """
    spark, kept = df.sparkSession, df.filter(F.col(cls).between(0, n_classes - 1))
    if ignore is not None:
        kept = kept.filter(F.col(cls) != ignore)
    counts = kept.groupBy(F.col(cls).cast("int").alias("cls")).agg(F.count(F.lit(1)).alias("n"))
    every = spark.range(n_classes).select(F.col("id").cast("int").alias("cls")).join(counts, "cls", "left")
    # one row a class
    return every.withColumn("total", F.sum(1 / F.col("n")).over(W.partitionBy())).select("cls", inverse_frequency(F.col("n"), F.col("total")).alias("weight"))


# losses: each an aggregate column over one row a pixel and class (p probability, y 0 or 1), or one row a pixel


def cross_entropy(p_true: Column, weight: Column) -> Column:
    """Weighted mean of -ln p of the true class."""
    return F.sum(-weight * F.ln(F.greatest(p_true, F.lit(1e-12)))) / F.sum(weight)


def _sums(p: Column, y: Column) -> tuple[Column, Column, Column]:
    return F.sum(p * y), F.sum(p * (1 - y)), F.sum((1 - p) * y)


def tversky_focal(p: Column, y: Column, alpha: float = 0.7, gamma: float = 1.33, smooth: float = 1.0) -> Column:
    tp, fp, fn = _sums(p, y)
    return F.pow(1 - (tp + smooth) / (tp + alpha * fn + (1 - alpha) * fp + smooth), 1 / gamma)


def tversky(p: Column, y: Column, alpha: float, beta: float, smooth: float = 1.0) -> Column:
    tp, fp, fn = _sums(p, y)
    return 1 - (tp + smooth) / (tp + alpha * fp + beta * fn + smooth)


def dice(p: Column, y: Column, smooth: float = 1.0) -> Column:
    tp, fp, fn = _sums(p, y)
    return 1 - (2 * tp + smooth) / (2 * tp + fp + fn + smooth)


def jaccard(p: Column, y: Column, smooth: float = 1.0) -> Column:
    tp, fp, fn = _sums(p, y)
    return 1 - (tp + smooth) / (tp + fp + fn + smooth)


def focal(p_true: Column, gamma: float = 2.0) -> Column:
    return F.avg(-F.pow(1 - p_true, F.lit(gamma)) * F.ln(F.greatest(p_true, F.lit(1e-12))))


def log_cosh_dice(p: Column, y: Column) -> Column:
    return F.ln(F.cosh(dice(p, y)))


def tanimoto_fractal(p: Column, y: Column, depth: int = 5, smooth: float = 1e-5) -> Column:
    """One minus the mean of the fractal Tanimoto coefficient and that of the complement."""

    def side(a: Column, b: Column) -> Column:
        tpl, tpp, tll = F.sum(a * b), F.sum(a * a), F.sum(b * b)
        terms = [1 / (2.0**d * (tpp + tll) - (2.0 ** (d + 1) - 1) * tpl + smooth) for d in range(depth)]
        return (tpl + smooth) * sum(terms[1:], terms[0]) / depth

    return 1 - (side(p, y) + side(1 - p, 1 - y)) / 2


#: Loss by name; each takes (p, y) of one class and gives an aggregate.
LOSSES = {
    "tversky_focal": tversky_focal,
    "tversky": lambda p, y: tversky(p, y, 0.3, 0.7),
    "dice": dice,
    "jaccard": jaccard,
    "log_cosh_dice": log_cosh_dice,
    "tanimoto": tanimoto_fractal,
}


def multiclass(df: DataFrame, name: str, weights: dict[int, float] | None = None, ignore: int | None = None) -> DataFrame:
    """df: cls, p, y, truth. The weighted sum of a loss over classes (uniform by default); pixels of the ignored truth left out, 0 if none is left."""
    if ignore is not None:
        df = df.filter(F.col("truth") != ignore)
    each = df.groupBy("cls").agg(LOSSES[name](F.col("p"), F.col("y")).alias("loss"))
    if weights:
        pairs = F.map_from_arrays(F.array(*[F.lit(k) for k in weights]), F.array(*[F.lit(float(v)) for v in weights.values()]))
        return each.agg(F.coalesce(F.sum(F.col("loss") * F.coalesce(pairs[F.col("cls")], F.lit(0.0))), F.lit(0.0)).alias("loss"))
    return each.agg(F.coalesce(F.avg("loss"), F.lit(0.0)).alias("loss"))


def gaussian_kernel(size: int = 7, sigma: float = 3.0) -> list[tuple[int, int, float]]:
    half = size // 2
    raw = {(i, j): math.exp(-(i * i + j * j) / (2 * sigma * sigma)) for i in range(-half, half + 1) for j in range(-half, half + 1)}
    total = sum(raw.values())
    return [(i, j, v / total) for (i, j), v in sorted(raw.items())]


def edge_weights(pixels: DataFrame, rows: int, cols: int, scale: float, size: int = 7, sigma: float = 3.0) -> DataFrame:
    """pixels: chip, r, c, y. Weight 1 + scale * blur of (y = 2) by a Gaussian stencil with reflected borders.

    Each boundary pixel spreads to its neighbours; one at the border also through its reflections.
    """
    taps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k")) for i, j, k in gaussian_kernel(size, sigma)])

    def images(v: Column, n: int) -> Column:
        return F.array_distinct(F.array(v, -v, 2 * (n - 1) - v))

    spread = pixels.filter("y = 2").withColumn("rr", F.explode(images(F.col("r"), rows))).withColumn("cc", F.explode(images(F.col("c"), cols))).withColumn("t", F.explode(taps))
    spread = spread.select("chip", (F.col("rr") - F.col("t.i")).alias("r"), (F.col("cc") - F.col("t.j")).alias("c"), F.col("t.k").alias("k"))
    blur = spread.filter(F.col("r").between(0, rows - 1) & F.col("c").between(0, cols - 1)).groupBy("chip", "r", "c").agg(F.sum("k").alias("blur"))
    return pixels.join(blur, ["chip", "r", "c"], "left").withColumn("weight", 1 + scale * F.coalesce("blur", F.lit(0.0))).drop("blur")


# the losses by the names that training configurations use; df has a row for each pixel and class: cls, p, y (0 or 1), truth, and for the
# pixel-weighted one chip, r and c


def _present(each: Column, y: Column) -> Column:
    """A class loss, 0 for a class without pixels."""
    return F.when(F.sum(y) > 0, each).otherwise(F.lit(0.0))


def _overlap(kind: str, p: Column, y: Column, alpha: float = 0.5, beta: float = 0.5, eps: float = 1e-7) -> Column:
    """One minus Jaccard, Dice or Tversky overlap without smoothing, the denominator at least eps."""
    tp, fp, fn = _sums(p, y)
    top, below = {"jaccard": (tp, tp + fp + fn), "dice": (2 * tp, 2 * tp + fp + fn), "tversky": (tp, tp + alpha * fp + beta * fn)}[kind]
    return _present(1 - top / F.greatest(below, F.lit(eps)), y)


def _mapped(values: dict[int, float] | None, default: float) -> Column:
    if not values:
        return F.lit(default)
    return F.coalesce(reduce(lambda c, kv: c.when(F.col("cls") == kv[0], float(kv[1])), values.items(), F.when(F.lit(False), 0.0)), F.lit(default))


def _mean_over(df: DataFrame, each: Column, weights: dict[int, float] | None = None) -> DataFrame:
    """The mean of a class loss over the classes or, with weights, its weighted sum; 0 without pixels."""
    by = df.groupBy("cls").agg(each.alias("loss"))
    total = F.sum(F.col("loss") * _mapped(weights, 0.0)) if weights else F.avg("loss")
    return by.agg(F.coalesce(total, F.lit(0.0)).alias("loss"))


def _entropy(df: DataFrame, weights: dict[int, float] | None, **_) -> DataFrame:
    w = _mapped(weights, 1.0)
    return df.filter("y = 1").agg(F.coalesce(cross_entropy(F.col("p"), w), F.lit(0.0)).alias("loss"))


def _pixel_weighted(df: DataFrame, weights: dict[int, float] | None, rows: int, cols: int, pixel_weight_scale: float = 1.0, every: DataFrame | None = None, **_) -> DataFrame:
    """Cross-entropy by the weights of edge_weights, which see all pixels, those of the ignored class too."""
    pixel = (df if every is None else every).filter("y = 1").select("chip", "r", "c", F.col("truth").alias("y"))
    w = edge_weights(pixel, rows, cols, pixel_weight_scale).select("chip", "r", "c", "weight")
    true = df.filter("y = 1").join(w, ["chip", "r", "c"])
    return true.agg(F.coalesce(F.sum(-F.ln(F.greatest("p", F.lit(1e-12))) * _mapped(weights, 1.0) * F.col("weight")) / F.sum("weight"), F.lit(0.0)).alias("loss"))


def _focal(df: DataFrame, gamma: float = 2.0, **_) -> DataFrame:
    """Class by class against the rest, each divided by the sum of its focal factors, and added up."""
    q = F.greatest(F.when(F.col("y") == 1, F.col("p")).otherwise(1 - F.col("p")), F.lit(1e-12))
    factor = F.pow(1 - q, F.lit(gamma))
    by = df.groupBy("cls").agg((F.avg(-factor * F.ln(q)) / F.greatest(F.sum(factor), F.lit(1e-6))).alias("loss"))
    return by.agg(F.coalesce(F.sum("loss"), F.lit(0.0)).alias("loss"))


def _class(kind: str):
    def run(df: DataFrame, alpha: float = 0.5, beta: float = 0.5, **_) -> DataFrame:
        return _mean_over(df, _overlap(kind, F.col("p"), F.col("y"), alpha, beta))

    return run


def _custom_tversky(df: DataFrame, weights: dict[int, float] | None = None, alphas: dict[int, float] | None = None, betas: dict[int, float] | None = None, alpha: float = 0.5, beta: float = 0.5, per_class: bool = False, **_) -> DataFrame:
    """One alpha and beta for all classes, or with per_class their own and a weighted sum (0.33, 0.34, 0.33 by default)."""
    if not per_class:
        return _class("tversky")(df, alpha=alpha, beta=beta)
    tp, fp, fn = _sums(F.col("p"), F.col("y"))
    sums = df.groupBy("cls").agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), F.sum("y").alias("n"))
    each = 1 - F.col("tp") / F.greatest(F.col("tp") + _mapped(alphas, 0.5) * F.col("fp") + _mapped(betas, 0.5) * F.col("fn"), F.lit(1e-7))
    weighted = F.when(F.col("n") > 0, each).otherwise(0.0) * _mapped(weights or {0: 0.33, 1: 0.34, 2: 0.33}, 0.0)
    return sums.agg(F.coalesce(F.sum(weighted), F.lit(0.0)).alias("loss"))


def _log_cosh(df: DataFrame, weights: dict[int, float] | None = None, **_) -> DataFrame:
    """ln cosh of the mean Dice loss."""
    return _mean_over(df, _overlap("dice", F.col("p"), F.col("y")), weights).select(F.ln(F.cosh("loss")).alias("loss"))


def _ftnmt(df: DataFrame, weights: dict[int, float] | None = None, depth: int = 5, **_) -> DataFrame:
    return _mean_over(df, tanimoto_fractal(F.col("p"), F.col("y"), depth), weights)


def _tversky_focal(df: DataFrame, weights: dict[int, float] | None = None, **_) -> DataFrame:
    return _mean_over(df, tversky_focal(F.col("p"), F.col("y"), 0.7, 1.33, 1.0), weights)


def _local_tversky(df: DataFrame, **_) -> DataFrame:
    """The Tversky-focal loss, each class weighted by its inverse frequency among the pixels at hand (class_weights)."""
    by = df.groupBy("cls").agg(tversky_focal(F.col("p"), F.col("y"), 0.7, 1.33, 1.0).alias("each"), F.sum("y").alias("n"))
    # one row a class
    total = F.sum(F.when(F.col("n") > 0, 1 / F.col("n"))).over(W.partitionBy())
    return by.withColumn("weight", inverse_frequency(F.col("n"), total)).agg(F.coalesce(F.sum(F.col("each") * F.col("weight")), F.lit(0.0)).alias("loss"))


def _blend(a, wa: float, b, wb: float):
    def run(df: DataFrame, **how) -> DataFrame:
        x, y = a(df, **how).withColumnRenamed("loss", "_a"), b(df, **how).withColumnRenamed("loss", "_b")
        # one row each
        return x.crossJoin(y).select((wa * F.col("_a") + wb * F.col("_b")).alias("loss"))

    return run


def _tversky_ce(df: DataFrame, tversky_weight: float = 0.5, **how) -> DataFrame:
    return _blend(_tversky_focal, tversky_weight, _entropy, 1 - tversky_weight)(df, **how)


#: The loss names of training configurations.
NAMED = {
    "ce": _entropy,
    "pixel_weighted_ce": _pixel_weighted,
    "jaccard": _class("jaccard"),
    "focal": _focal,
    "tversky": _class("tversky"),
    "dice": _class("dice"),
    "ce+dice": _blend(_entropy, 1.0, _class("dice"), 1.0),
    "logcoshdice": _log_cosh,
    "logcoshdice+ce": _blend(_log_cosh, 0.5, _entropy, 0.5),
    "ftnmt": _ftnmt,
    "ce+ftnmt": _blend(_entropy, 0.5, _ftnmt, 0.5),
    "localtversky": _local_tversky,
    "tversky_ce": _tversky_ce,
    "customtversky": _custom_tversky,
}


def loss(df: DataFrame, name: str, weights: dict[int, float] | None = None, ignore: int | None = None, **how) -> DataFrame:
    """One row with the loss of that name (NAMED), over pixels whose truth is not `ignore`; 0 if none is left. weights: by class."""
    if name not in NAMED:
        raise ValueError(f"no loss is named {name}; there are {', '.join(sorted(NAMED))}")
    kept = df if ignore is None else df.filter(F.col("truth") != ignore)
    if name == "pixel_weighted_ce":
        how["every"] = df
    if name in ("jaccard", "focal", "tversky", "dice", "localtversky"):
        return NAMED[name](kept, **how)
    return NAMED[name](kept, weights=weights, **how)
