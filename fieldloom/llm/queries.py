"""The registered queries of this subpackage: each runs its operator over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import chat, decontam, fertility, idplanes, linededup, lmscore, mixing, parityjoin, periodic, secrets, subdedup, warc, whitening
from .text import word_count, words


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    plan = mixing.mix_plan(docs, "doc_id", "source", word_count(F.col("text")), weights=(5, 2, 1), share=1.0, cap=3.0)
    return plan.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


TOKENIZERS = "/opt/tokenizers"


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score_documents(_table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model", folds=7, fold=2)


VOCABULARIES = [f"{TOKENIZERS}/piece_bpe_32k.model", f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken"]


def op3_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fertility.quality(_table(spark, sf_dir, "documents"), VOCABULARIES, carry=["doc_id"])
    return done.select("doc_id", *fertility.BASE, "base_failed", "kept", *fertility.names(VOCABULARIES))


def op4_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = parityjoin.jaccard_components(_table(spark, sf_dir, "documents"), width=5, num=3, den=4)
    return done.select("doc_id", "n_shingles", "component_id")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "random")

    def n(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("key").alias("doc_id"),
        *[n(k) for k in secrets.BASE],
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = linededup.dedup_lines(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = warc.round_trip(_table(spark, sf_dir, "pages"), least=100)
    return done.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = subdedup.remove_repeats(_table(spark, sf_dir, "documents"), width=13)
    return done.select(F.col("key").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


EXTRA_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA_CONVERSATION, T._parse_datatype_string("conv_id bigint, turn bigint, role string, text string"))
    nodes = turns.unionByName(extra).selectExpr(
        "conv_id as tree", "row_number() over (partition by conv_id order by turn, role, text) as node", "1.0D as score", "role", "text"
    )
    nodes = nodes.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
    done = chat.format_paths(chat.choose_paths(nodes, top=1))
    read = done.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.encode("formatted", "UTF-8"), F.col("loss_spans")))
    turn_text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turn_text, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op11_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), k=32).withColumnRenamed("key", "vec_id")


def op12_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = idplanes.round_trip(_table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", end_id=2)
    return done.select(F.col("key").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def planted_period(key: Column, text: Column) -> Column:
    """The text; of every tenth document (crc32 of the key ends in 0) with words its words, from some place on with a period."""
    h, w = F.crc32(key.cast("string")), words(text)
    n = F.size(w)
    g = F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), times)), F.lit(1), n - a)
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), F.array_join(F.concat(F.slice(w, F.lit(1), a), tail), " ")).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    done = periodic.collapse_runs(docs, text=planted_period(F.col("doc_id"), F.col("text")), least=12)
    # greatest length, then smallest start, then smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return done.withColumn("best", best).select(
        F.col("key").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.back")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.less")).alias("period"),
        F.expr("(1000 * best.length) div (-best.less)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


def queries() -> dict:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
