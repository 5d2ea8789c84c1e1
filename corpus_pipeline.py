"""From raw documents to a training mixture, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet and rereads it as the
docs of the next. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm import decontam, fertility, linededup, mixing, parityjoin
from fieldloom.llm.queries import VOCABULARIES
from fieldloom.llm.scratch import Scratch, small_side
from fieldloom.llm.text import word_count

# Tokenisers are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def _without(docs: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """docs less the rows whose key and text hash are in gone (d, t). Equal rows share their fate."""
    gone = Scratch(docs.sparkSession, name).write(gone.selectExpr("d as __gone_d", "t as __gone_t").distinct(), "gone")
    d, t = linededup.row_id(F.col("doc_id"), F.col("text"))
    same = (d == F.col("__gone_d")) & (t == F.col("__gone_t"))
    return docs.join(small_side(gone), same, "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie outside the fertility bands go.

    Null, empty and white-space texts have no words and go; a null language is judged by its script; repeated rows share
    their fate, rows that share only a key do not; an empty table stays empty; further columns pass, whatever their names.
    """
    d, t = linededup.row_id(F.col("doc_id"), F.col("text"))
    judged = fertility.quality(docs.select("text", "lang", d, t), VOCABULARIES, carry=["d", "t"])
    return _without(docs, judged.filter(~F.col("kept")), "rejected")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go, and with them a document that has no word left, such as an exact copy.

    A document that loses no line stays as it is, with or without words, and a null text stays null; rows with one key are one document, so
    repeated rows do not cut each other; a null key stands last; an empty table stays empty; n_chars follows the text.
    """
    done = linededup.dedup_lines(docs)
    kept = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    done = done.filter((F.col("n_dropped") == 0) | (word_count(F.col("kept_text")) > 0))
    return done.withColumn("n_chars", F.length(kept).cast("long")).withColumn("text", kept).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one stays: the smallest doc_id, then the smallest text hash, of equal rows any one.

    Texts without words are linked with nothing and stay; null keys stand last; an empty table stays empty; further columns pass.
    """
    joined = parityjoin.jaccard_components(docs, width=5, num=3, den=4).filter("group is not null")
    rows = Scratch(spark, "near").write(joined.groupBy("group", "d", "t").agg(F.count(F.lit(1)).alias("n")), "rows")
    first = rows.groupBy("group").agg(F.min(F.struct("d", "t")).alias("first"))
    later = rows.join(first, "group").filter(F.struct("d", "t") != F.col("first"))
    docs = _without(docs, later, "near")
    # equal rows of a key and text that stay
    again = Scratch(spark, "again").write(rows.filter("n > 1").select(F.col("d").alias("__d"), F.col("t").alias("__t")).distinct(), "again")
    d, t = linededup.row_id(F.col("doc_id"), F.col("text"))
    named = docs.withColumns({"__row_d": d, "__row_t": t})
    same = (F.col("__row_d") == F.col("__d")) & (F.col("__row_t") == F.col("__t"))
    once = named.join(small_side(again), same, "left_semi").dropDuplicates(["__row_d", "__row_t"])
    return named.join(small_side(again), same, "left_anti").unionByName(once).drop("__row_d", "__row_t")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Rows that share only their key with such a document stay; null and empty texts hold nothing and stay, as they are no item's; an
    empty table or benchmark changes nothing; further columns pass.
    """
    d, t = linededup.row_id(F.col("doc_id"), F.col("text"))
    leaks = decontam.find_leaks(docs.select(F.struct(d, t).alias("row"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), key="row")
    return _without(docs, leaks.select("doc_id.d", "doc_id.t"), "leaked")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with how often (copies), their source's target and how many words that makes (taken).

    Null is a source of its own; rows of one key and source are taken or left together; texts without words make no words and come along
    with their hash; an empty table stays empty; columns of the three new names are replaced.
    """
    plan = mixing.mix_plan(docs, "doc_id", "source", word_count(F.col("text")), weights=(5, 2, 1), share=1.0, cap=3.0)
    new = ["copies", "target"]
    chosen = plan.filter("copies > 0").select(F.col("key").alias("__key"), F.col("source").alias("__of"), *[F.col(c).alias(f"__{c}") for c in new]).distinct()
    chosen = Scratch(spark, "mixed").write(chosen, "chosen")
    joined = docs.join(small_side(chosen), F.col("doc_id").eqNullSafe(F.col("__key")) & F.col("source").eqNullSafe(F.col("__of")))
    own = [c for c in docs.columns if c not in (*new, "taken")]
    taken = (F.col("__copies") * word_count(F.col("text"))).alias("taken")
    return joined.select(*own, *[F.col(f"__{c}").alias(c) for c in new], taken)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("source mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of `documents`. What a stage has written for itself is deleted once its result stands, and the result once the next one does."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        with Scratch.passing():
            docs = scratch.write(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            scratch.drop(f"stage{k - 1}")
    return docs
