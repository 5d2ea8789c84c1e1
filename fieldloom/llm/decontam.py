"""Benchmark decontamination: find test items inside documents by size-partitioned MinHash containment.

The signature of an item is its smallest shingle hashes. A document that holds `threshold` of an
item's n shingles misses fewer than n - ceil(threshold * n) + 1 of them, so it holds one of as many smallest ones: a
signature of that length, which follows from the item's size class, loses no match however long the
document is. Matches of a signature hash are verified by counting shared shingles, compared as text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import ascii_lower, words


def _windows(at: str, width: int, of) -> Column:
    """`of` each window of `width` words of the array column; none if it is shorter."""
    n = F.size(at)
    return F.when(n >= width, F.transform(F.sequence(F.lit(1), n - width + 1), lambda i: of(F.slice(at, i, width)))).otherwise(F.array())


def _hashes(at: str, width: int) -> Column:
    return _windows(at, width, F.xxhash64)


def _texts(at: str, width: int) -> Column:
    return _windows(at, width, lambda w: F.array_join(w, " "))


def _of_width(at: str, widths: list[int], windows) -> Column:
    """Windows of the column's own width k: the smaller of its size and the largest of `widths`."""
    return reduce(lambda c, k: c.when(F.col("k") == k, windows(at, k)), widths, F.when(F.lit(False), F.array())).otherwise(F.array())


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    width: int = 5,
    threshold: float = 0.75,
) -> DataFrame:
    """One row (doc_id, item_id, n_item, n_shared) for each document that holds `threshold` of an item's
    distinct shingles of `width` words (A-Z lower-cased). Keys come back under these names.

    Signature rows join document shingles as the size of the item table allows: under Spark's broadcast
    threshold they are sent to the documents, beyond it both are shuffled by hash.

    Edge cases: an item of fewer words than `width` has its whole sequence as its one shingle, and documents are
    searched for it by windows of as many words; without words or text an item or document has no shingle and matches nothing; null keys are kept
    as keys, and keys may be of any type that compares; repeated rows give one result row, the largest n_shared; other columns are
    ignored; empty tables give no rows.
    """
    scratch = Scratch(docs.sparkSession, "leaks")
    need = F.ceil(F.col("n_item") * F.lit(threshold) - F.lit(1e-9)).cast("int")
    items = items.select(F.col(item_key).alias("item_id"), words(ascii_lower(F.col(item_text))).alias("w")).filter(F.size("w") > 0)
    items = scratch.write(items.withColumn("k", F.least(F.size("w"), F.lit(width))), "given")
    # as many as `width` at most; few tables hold items of under five words, and without any there is one width
    widths = sorted(r[0] for r in items.select("k").distinct().collect())
    items = (
        items.withColumn("s", F.array_distinct(_of_width("w", widths, _texts)))
        .select("item_id", "k", "s", F.size("s").alias("n_item"), F.array_sort(F.array_distinct(_of_width("w", widths, _hashes))).alias("hs"))
        .withColumn("need", need)
    )
    items = scratch.write(items, "items")
    # size classes: documents of a class below the item's need cannot hold it
    signature = items.select(
        "item_id", "k", "need", F.explode(F.slice("hs", F.lit(1), F.col("n_item") - F.col("need") + 1)).alias("h")
    )
    signature = scratch.write(signature, "signature")
    base = docs.select(F.col(key).alias("doc_id"), words(ascii_lower(F.col(text))).alias("w"))
    every = F.concat(*[_hashes("w", k) for k in widths]) if widths else F.array().cast("array<bigint>")
    shingles = base.select("doc_id", F.size("w").alias("n_words"), F.explode(every).alias("h"))
    pairs = shingles.join(signature, "h").filter(F.greatest(F.col("n_words") - F.col("k") + 1, F.lit(1)) >= F.col("need"))
    pairs = scratch.write(pairs.select("doc_id", "item_id").distinct(), "pairs")
    p = pairs.groupBy(F.col("doc_id").alias("p_doc")).agg(F.collect_set(F.struct("item_id")).alias("p_items"))
    held = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(p, F.col("doc_id").eqNullSafe(F.col("p_doc")))
    # a text is split into shingles once, then its candidate items follow
    held = held.withColumn("w", words(ascii_lower(F.col("text")))).withColumns({f"s{k}": _texts("w", k) for k in widths})
    held = held.select("doc_id", *[f"s{k}" for k in widths], F.explode("p_items.item_id").alias("p_item"))
    full = held.join(items.select("item_id", "k", "s", "n_item", "need"), F.col("p_item").eqNullSafe(F.col("item_id")))
    full = full.withColumn("n_shared", F.size(F.array_intersect("s", _of_width("w", widths, lambda _, k: F.col(f"s{k}")))))
    # the bound comes after the aggregation: as a filter on the pairs it would be pushed below the projection and split
    # the text again for each shingle
    found = full.groupBy("doc_id", "item_id", "n_item", "need").agg(F.max("n_shared").alias("n_shared"))
    return found.filter(F.col("n_shared") >= F.col("need")).drop("need")
