"""Secret scans: known forms of secrets, and a battery of randomness tests for the rest.

A long token is a discovery if it looks drawn uniformly from the alphabet of its inferred encoding.
For each token three statistics are computed: chi-squared of its symbols against
uniformity, runs above and below the middle of the alphabet, and serial correlation at lag one. Each gives a p-value under two
hypotheses, and the three of a hypothesis are combined by Fisher's method:

* ordinary text, whose symbols repeat, so its chi-squared grows with the length and longer random tokens give smaller p-values, and whose runs
  and serial correlation are spread more widely than chance spreads them. This is the null hypothesis of the discovery: a Benjamini-Hochberg bound over all
  tokens of the corpus, read off a histogram of the combined p-values, controls the share of false discoveries;
* uniform draws, two-sided. A token that these refute (an alphabet in order, one symbol after another) is no discovery.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .linededup import row_id
from .scratch import Scratch

# Forms of secrets, fixed values: kind, pattern, least length and of which group.
FORMS = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
]
BASE = [k for k, *_ in FORMS]
# Alphabets by encoding, fixed values, tried in this order.
ALPHABETS = [
    ("hex", r"\A[0-9a-f]+\z", "0123456789abcdef"),
    ("HEX", r"\A[0-9A-F]+\z", "0123456789ABCDEF"),
    ("base32", r"\A[A-Z2-7]+\z", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", r"\A[0-9a-z]+\z", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base64", r"\A[A-Za-z0-9+/]+\z", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", r"", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
]
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
# Sum of squared letter frequencies that ordinary text has at least, a fixed value (random letters of 26: 0.038).
COINCIDENCE = 0.055
# Standard deviations of the runs and serial statistics of ordinary text; of uniform draws they are 1. Fixed values.
TEXT_SPREAD = 2.5
BINS = 400


def _found(text: Column, kind: str, pattern: str) -> Column:
    """Struct of kind, the matches in order and the lengths of the text before, between and after them."""
    got = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.when(F.size(got) > 0, F.transform(F.split(text, pattern, -1), F.length))
    return F.struct(F.lit(kind).alias("kind"), got.alias("found"), gaps.alias("gaps"))


def _ln_tail(x: Column) -> Column:
    """ln of the normal distribution's upper tail for x of 0 or more, right to some 12 digits: a series below 2, the continued fraction of Mills' ratio above."""
    density = -x * x / 2 - 0.5 * math.log(2 * math.pi)
    terms = F.aggregate(F.sequence(F.lit(1), F.lit(40)), F.struct(x.alias("term"), x.alias("sum")), lambda s, k: F.struct((s["term"] * x * x / (2 * k + 1)).alias("term"), (s["sum"] + s["term"] * x * x / (2 * k + 1)).alias("sum")))
    near = F.ln(0.5 - F.exp(density) * terms["sum"])
    far = density - F.ln(x + F.aggregate(F.sequence(F.lit(60), F.lit(1), F.lit(-1)), F.lit(0.0), lambda s, k: k / (x + s)))
    return F.when(x < 2, near).otherwise(far)


def _ln_lower(z: Column) -> Column:
    """ln of the distribution below z."""
    tail = _ln_tail(F.abs(z))
    return F.when(z < 0, tail).otherwise(F.log1p(-F.exp(tail)))


def _ln_two_sided(z: Column) -> Column:
    """ln of the probability of more than |z| on either side."""
    return F.least(math.log(2) + _ln_tail(F.abs(z)), F.lit(0.0))


def _ln_within(z: Column) -> Column:
    """ln of the probability of less than |z| on either side."""
    return F.ln(F.greatest(-F.expm1(_ln_two_sided(z)), F.lit(1e-12)))


def _fisher(*ln_p: Column) -> Column:
    """ln of the combined p-value of three: minus twice the sum of their logarithms is chi-squared with 6 degrees of freedom."""
    half = -sum(ln_p[1:], ln_p[0])
    return -half + F.ln(1 + half + half * half / 2)


def battery(tokens: DataFrame, token: str) -> DataFrame:
    """tokens plus encoding, z_text, z_chi, z_runs and z_serial (the statistics in standard deviations, chi-squared under either hypothesis),
    and ln_text and ln_random, the logarithms of the combined p-values.

    Of a constant or very short token some statistics are undefined; they come out as 0.
    """
    t = F.col(token)
    choice = F.lit(len(ALPHABETS) - 1)
    for i in reversed(range(len(ALPHABETS) - 1)):
        choice = F.when(t.rlike(ALPHABETS[i][1]), i).otherwise(choice)
    out = tokens.withColumn("_e", choice)
    names, letters = F.array(*[F.lit(a[0]) for a in ALPHABETS]), F.array(*[F.lit(a[2]) for a in ALPHABETS])
    out = out.withColumn("encoding", F.element_at(names, F.col("_e") + 1)).withColumn("_a", F.element_at(letters, F.col("_e") + 1))
    # symbols as numbers; the few foreign to the alphabet count as its first
    out = out.withColumn("_x", F.transform(F.filter(F.split(t, ""), lambda c: c != ""), lambda c: F.greatest(F.instr(F.col("_a"), c) - 1, F.lit(0)).cast("double")))
    out = out.withColumn("_n", F.size("_x").cast("double")).withColumn("_k", F.length("_a").cast("double"))
    zero = F.lit(0.0)
    squares = F.aggregate(F.array_distinct("_x"), zero, lambda s, c: s + F.pow(F.size(F.filter("_x", lambda x: x == c)).cast("double"), 2))
    out = out.withColumn("_chi", squares * F.col("_k") / F.col("_n") - F.col("_n"))
    excess = F.col("_k") * COINCIDENCE - 1
    excess = F.greatest(excess, F.lit(0.6))
    mean = (F.col("_k") - 1) + (F.col("_n") - 1) * excess
    spread = F.sqrt(2 * (F.col("_k") - 1) + 4 * F.col("_n") * excess)
    out = out.withColumn("z_text", (F.col("_chi") - mean) / spread)
    # chi-squared to a normal deviate by the cube root (Wilson and Hilferty)
    free = F.col("_k") - 1
    out = out.withColumn("z_chi", (F.cbrt(F.col("_chi") / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free)))
    high = F.transform("_x", lambda x: (x >= F.col("_k") / 2).cast("int"))
    out = out.withColumn("_h", high).withColumn("_h1", F.aggregate("_h", F.lit(0), lambda s, x: s + x).cast("double"))
    pairs = F.zip_with(F.slice("_h", F.lit(1), F.size("_h") - 1), F.slice("_h", F.lit(2), F.size("_h") - 1), lambda a, b: (a != b).cast("int"))
    out = out.withColumn("_r", 1 + F.aggregate(pairs, F.lit(0), lambda s, x: s + x))
    both = 2 * F.col("_h1") * (F.col("_n") - F.col("_h1"))
    var = both * (both - F.col("_n")) / (F.col("_n") * F.col("_n") * (F.col("_n") - 1))
    out = out.withColumn("z_runs", F.coalesce(F.when(var > 0, (F.col("_r") - 1 - both / F.col("_n")) / F.sqrt(var)), zero))
    # sums of x, x squared and neighbours' products: deviations from the mean follow from them, and no mean is worked out symbol by symbol
    lagged = F.zip_with(F.slice("_x", F.lit(1), F.size("_x") - 1), F.slice("_x", F.lit(2), F.size("_x") - 1), lambda a, b: a * b)
    total = lambda c, f: F.aggregate(c, zero, lambda s, x: s + f(x))
    out = out.withColumns({"_s": total(F.col("_x"), lambda x: x), "_q": total(F.col("_x"), lambda x: x * x), "_l": total(lagged, lambda x: x), "_b": F.element_at("_x", 1) + F.element_at("_x", -1)})
    m = F.col("_s") / F.col("_n")
    top, low = F.col("_l") - m * (2 * F.col("_s") - F.col("_b")) + (F.col("_n") - 1) * m * m, F.col("_q") - F.col("_s") * m
    out = out.withColumn("z_serial", F.coalesce(F.when(low > 0, top / low * F.sqrt("_n")), zero))
    out = out.withColumn("ln_text", _fisher(_ln_lower(F.col("z_text")), _ln_within(F.col("z_runs") / TEXT_SPREAD), _ln_within(F.col("z_serial") / TEXT_SPREAD)))
    out = out.withColumn("ln_random", _fisher(*[_ln_two_sided(F.col(z)) for z in ("z_chi", "z_runs", "z_serial")]))
    return out.drop("_e", "_a", "_x", "_n", "_k", "_chi", "_h", "_h1", "_r", "_s", "_q", "_l", "_b")


def discover(tested: DataFrame, rate: float = 0.01, refuted: float = 0.001) -> DataFrame:
    """Rows of tested that are discoveries at this false-discovery rate and whose randomness is not refuted at the level `refuted`.

    Benjamini-Hochberg: the largest bin edge p with p * (number of tokens) <= rate * (tokens up to p). The histogram has BINS + 1 rows
    of -log10 p in steps of 0.1, whatever the size of the corpus, so its one threshold row is broadcast.
    """
    step = F.least(F.floor(F.col("ln_text") * (-10 / math.log(10))), F.lit(BINS)).cast("int")
    # written, for the statistics are read several times and a filter on them would repeat their expressions
    tested = Scratch(tested.sparkSession, "battery").write(tested, "tested")
    binned = tested.withColumn("_bin", step)
    hist = binned.groupBy("_bin").agg(F.count(F.lit(1)).alias("n"))
    edges = hist.select(F.collect_list(F.struct("_bin", "n")).alias("b"), F.sum("n").alias("m"))
    upto = F.transform("b", lambda e: F.struct(e["_bin"].alias("bin"), F.aggregate(F.filter("b", lambda o: o["_bin"] >= e["_bin"]), F.lit(0).cast("long"), lambda s, o: s + o["n"]).alias("c")))
    passing = F.filter(upto, lambda e: F.pow(F.lit(10.0), -e["bin"] / 10.0) * F.col("m") <= rate * e["c"])
    limit = edges.select(F.array_min(F.transform(passing, lambda e: e["bin"])).alias("_limit"))
    return binned.join(F.broadcast(limit), F.col("_bin") >= F.col("_limit")).filter(F.col("ln_random") >= math.log(refuted)).drop("_bin", "_limit")


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: float = 0.01) -> DataFrame:
    """One row for each row of docs: key, spans (array of start, order, kind, end; code points, end exclusive, in order).

    Known forms come first, leftmost and non-overlapping for each kind. Tokens that the battery discovers are added as
    kind `random` unless a span of a known form holds them.

    Edge cases: null and empty texts have no spans; repeated rows have equal spans; a null key is kept; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    body = F.coalesce(F.col(text), F.lit(""))
    kinds = [_found(body, k, p) for k, p, *_ in FORMS if k != "hex"] + [_found(body, "hex", r"[0-9a-f]{32,}"), _found(body, "random", TOKEN)]
    rows = scratch.write(docs.select(F.col(key).alias("key"), *row_id(F.col(key), F.col(text)), F.filter(F.array(*kinds), lambda k: F.size(k["found"]) > 0).alias("kinds")), "rows")
    each = rows.filter(F.size("kinds") > 0).select("d", "t", F.explode("kinds").alias("k")).select("d", "t", "k.kind", F.posexplode(F.arrays_zip("k.found", "k.gaps")).alias("i", "m"))
    each = each.filter(F.col("m.found").isNotNull()).select("d", "t", "kind", "i", F.col("m.found").alias("found"), F.col("m.gaps").alias("gap")).distinct()
    upto = "sum(gap + length(found)) over (partition by d, t, kind order by i)"
    spans = each.withColumn("end", F.expr(upto)).withColumn("start", F.col("end") - F.length("found"))
    spans = scratch.write(spans.select("d", "t", "kind", "found", "start", "end"), "spans")
    order = F.when(F.col("kind") == BASE[0], 0).when(F.col("kind") == BASE[1], 1).when(F.col("kind") == BASE[2], 2).otherwise(3).alias("order")
    value = F.regexp_extract("found", FORMS[0][1], 2)
    known = spans.filter(
        (F.col("kind").isin("access", "hex") & (F.length("found") >= F.when(F.col("kind") == "access", 16).otherwise(32))) | ((F.col("kind") == "assign") & (F.length(value) >= 8))
    ).drop("found")
    known = scratch.write(known, "known")
    new = discover(battery(spans.filter(F.col("kind") == "random"), "found").drop("found"), rate).select("d", "t", "kind", "start", "end")
    # in order of start, known spans first: one that begins at or before a new span and reaches its end holds it
    every = known.withColumn("known", F.lit(1)).unionByName(new.withColumn("known", F.lit(0)))
    sweep = W.partitionBy("d", "t").orderBy("start", F.col("known").desc()).rowsBetween(W.unboundedPreceding, 0)
    every = every.withColumn("_far", F.max(F.when(F.col("known") == 1, F.col("end"))).over(sweep))
    every = every.filter((F.col("known") == 1) | F.col("_far").isNull() | (F.col("_far") < F.col("end")))
    got = every.groupBy(F.col("d").alias("d1"), F.col("t").alias("t1")).agg(F.array_sort(F.collect_list(F.struct("start", order, "kind", "end"))).alias("spans"))
    empty = F.expr("cast(array() as array<struct<start: bigint, order: int, kind: string, end: bigint>>)")
    return rows.join(got, (F.col("d") == F.col("d1")) & (F.col("t") == F.col("t1")), "left").select("key", F.coalesce("spans", empty).alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
