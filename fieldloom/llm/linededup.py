"""Line dedup: a line that many documents share stays only in the first of them.

Line keys become hashes, range-partitioned and sorted by hash, document and position, so that the first
occurrence of each hash streams past before the others. What comes back for each document is not
text but a sparse bitmap of the lines it loses; `apply_bitmaps` cuts the text by it, and only texts that lose lines are shuffled for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import Scratch, small_side
from .text import ascii_lower

STRIP = " \t\n\x0b\x0c\r"
NO_KEY = (1 << 63) - 1
BUCKET_BITS, SLICE_ROWS = 16, 50_000


def lines(text: Column) -> Column:
    """The \\n-split lines; null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(STRIP)))


def row_id(key: Column, text: Column) -> list[Column]:
    return [F.coalesce(key.cast("long"), F.lit(NO_KEY)).alias("d"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("t")]


def line_bitmaps(docs: DataFrame, key: str, text: str, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """One row (d, t, dropped) for each document that loses lines.

    d, t: the key and a hash of the text; dropped: array of (word, mask), mask having a bit for each
    lost line among lines 64 * word .. 64 * word + 63.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of at least
    min_chars code points found under at least min_docs document keys are lost by all documents but
    the one with the smallest key, which keeps every occurrence.

    Occurrences are counted in 2^16 buckets of the hash. A bucket with more than SLICE_ROWS and twice its share of them, such as that of a line
    that fills a large part of the rows, is dealt over as many slices by document as its count asks for; each slice
    streams its own first occurrences, at most one row for each line and slice goes on to the aggregation, and lost lines are found slice by slice.

    Edge cases: rows with one document key are one document; a null key is a document that sorts last; null and empty
    texts have one empty line; an empty table gives an empty table; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    at = docs.select(*row_id(F.col(key), F.col(text)), F.posexplode(lines(F.col(text))).alias("pos", "line"))
    keyed = at.select("d", "t", "pos", line_key(F.col("line")).alias("k")).filter(F.length("k") >= min_chars)
    occ = scratch.write(
        keyed.select("d", "t", "pos", F.xxhash64("k").alias("h"), F.xxhash64(F.lit("second"), "k").alias("h2")), "occ"
    )
    bucket = F.shiftrightunsigned("h", 64 - BUCKET_BITS)
    counts = scratch.write(occ.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")), "counts")
    share = max(SLICE_ROWS, 2 * (counts.agg(F.sum("n")).first()[0] or 0) >> BUCKET_BITS)
    hot = counts.select("bucket", F.ceil(F.col("n") / F.lit(share)).alias("slices")).filter("slices > 1")
    # 2^16 rows at most
    dealt = occ.withColumn("bucket", bucket).join(F.broadcast(hot), "bucket", "left").withColumn("slices", F.coalesce("slices", F.lit(1).cast("long")))
    dealt = dealt.select("h", "h2", "d", "t", "pos", "slices", F.pmod(F.xxhash64("d"), F.col("slices")).alias("slice"))
    sliced = (
        dealt.select("h", "h2", "slices", "d", "pos", "slice")
        .repartitionByRange("h", "h2", "slice")
        .sortWithinPartitions("h", "h2", "slice", "d", "pos")
    )
    stream = W.partitionBy("h", "h2", "slice").orderBy("d", "pos")
    firsts = (
        sliced.withColumn("before", F.lag("d").over(stream))
        .filter(F.col("before").isNull() | (F.col("before") != F.col("d")))
        .groupBy("h", "h2", "slices")
        .agg(F.min("d").alias("first"), F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs)
        .select("h", "h2", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
    )
    firsts = scratch.write(firsts, "firsts")
    lost = dealt.join(firsts, ["h", "h2", "slice"]).filter(F.col("d") > F.col("first"))
    masks = lost.groupBy("d", "t", F.shiftright("pos", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("mask")
    )
    maps = masks.groupBy("d", "t").agg(F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("dropped"))
    maps = scratch.write(maps, "maps")
    scratch.drop("occ")
    scratch.drop("firsts")
    return maps


def apply_bitmaps(docs: DataFrame, maps: DataFrame, key: str, text: str) -> DataFrame:
    """docs plus n_lines, n_dropped and kept_text.

    A document that loses no line has its own text as kept_text (null as empty); one that loses all has an empty one.
    New columns replace any of the same name; all others pass unchanged.
    """
    d, t = row_id(F.col(key), F.col(text))
    maps = maps.select(F.col("d").alias("__line_d"), F.col("t").alias("__line_t"), F.col("dropped").alias("__line_b"))
    same = (F.col("__line_rd") == F.col("__line_d")) & (F.col("__line_rt") == F.col("__line_t"))
    ids = small_side(maps.select("__line_d", "__line_t"))
    rows = docs.withColumns({"__line_rd": d, "__line_rt": t})
    whole = rows.join(ids, same, "left_anti").withColumn("__line_m", F.lit(None).cast("map<int,bigint>"))
    # by a shuffle at any size: both sides grow with the corpus
    cut = rows.join(ids, same, "left_semi").join(maps.hint("shuffle_hash"), same).withColumn("__line_m", F.map_from_entries("__line_b")).drop("__line_d", "__line_t", "__line_b")
    joined = whole.unionByName(cut).withColumn("__line_l", lines(F.col(text)))

    def stays(_line: Column, i: Column) -> Column:
        mask = F.coalesce(F.try_element_at(F.col("__line_m"), F.shiftright(i, 6)), F.lit(0).cast("long"))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), i.bitwiseAND(F.lit(63)))
        return mask.bitwiseAND(bit) == 0

    kept = F.when(F.col("__line_m").isNull(), F.col("__line_l")).otherwise(F.filter("__line_l", stays))
    joined = joined.withColumn("__line_k", kept)
    return joined.withColumns(
        {
            "n_lines": F.size("__line_l").cast("long"),
            "n_dropped": (F.size("__line_l") - F.size("__line_k")).cast("long"),
            "kept_text": F.array_join("__line_k", "\n"),
        }
    ).drop("__line_m", "__line_rd", "__line_rt", "__line_l", "__line_k")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    return apply_bitmaps(docs, line_bitmaps(docs, key, text, min_chars, min_docs), key, text)
