"""Chat formatting: reply trees to conversations with a loss mask.

Paths are found by self-joins that double: after round k every node knows its ancestor 2^k steps up and the sum of
scores on the way, so a tree of depth n takes about log2(n) joins. Leaves rank by the score of their
path; going back down the same rounds marks the nodes of each chosen path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import Scratch

# Control strings of the template, fixed values.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]"]


def escape(text: Column) -> Column:
    """No control string is left: backslashes double, and one goes in after the first character of each control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(c[0] + "\\" + c[1:])), CONTROL, text)


def unescape(text: Column) -> Column:
    text = reduce(lambda t, c: F.replace(t, F.lit(c[0] + "\\" + c[1:]), F.lit(c)), CONTROL, text)
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    """Roles end at the first line feed, so theirs become a control string of their own."""
    return F.replace(escape(role), F.lit("\n"), F.lit("[\\NL]"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("[\\NL]"), F.lit("\n")))


def choose_paths(nodes: DataFrame, top: int = 1) -> DataFrame:
    """The nodes of the `top` best root-to-leaf paths of each tree.

    nodes: tree, node, parent (null at a root), score (null: 0), any more. Returns the nodes' columns plus rank
    (1 for the best leaf) and depth (0 at the root), in place of columns of these names. Leaves rank by the sum of scores on their
    path, then the smaller node. Several roots in a tree are ranked together.

    Edge cases: tree and node must identify a row; nodes of a cycle, and those that hang from one, never reach a root, so no path
    holds them, and the other paths of the tree are as without them; a parent that does not exist makes its child a root; a null tree is
    a tree of its own; an empty table gives an empty table.
    """
    scratch = Scratch(nodes.sparkSession, "paths")
    base = nodes.select(F.col("tree").alias("t"), F.col("node").alias("v"), F.col("parent").alias("p"), F.coalesce("score", F.lit(0.0)).cast("double").alias("s"))
    have = base.select(F.col("t").alias("t1"), F.col("v").alias("v1"))
    on = (F.col("t").eqNullSafe(F.col("t1"))) & (F.col("p") == F.col("v1"))
    # up: the ancestor 2^k steps above, null beyond the root; total: scores from v to just below it; steps so far
    now = scratch.write(
        base.join(have, on, "left").select("t", "v", F.col("v1").alias("up"), F.col("s").alias("total"), F.lit(1).alias("depth")), "up0"
    )
    parents = now.select("t", F.col("up").alias("v")).filter("v is not null").distinct()
    rounds = [now]
    # after k rounds nodes look 2^k steps up, and no path is longer than its tree is large: what still moves then is held by a cycle
    largest = base.groupBy("t").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    while 1 << (len(rounds) - 1) <= largest and not rounds[-1].filter("up is not null").isEmpty():
        a = rounds[-1]
        b = a.select(F.col("t").alias("t1"), F.col("v").alias("v1"), F.col("up").alias("up1"), F.col("total").alias("total1"), F.col("depth").alias("depth1"))
        # nodes that have reached their root take no part
        moving = a.filter("up is not null").join(b, F.col("t").eqNullSafe(F.col("t1")) & (F.col("up") == F.col("v1")))
        moved = moving.select("t", "v", F.col("up1").alias("up"), (F.col("total") + F.col("total1")).alias("total"), (F.col("depth") + F.col("depth1")).alias("depth"))
        step = moved.unionByName(a.filter("up is null"))
        rounds.append(scratch.write(step, f"up{len(rounds)}"))
    ends = rounds[-1].filter("up is null").select("t", "v", "total", (F.col("depth") - 1).alias("depth"))
    pv = parents.select(F.col("t").alias("t1"), F.col("v").alias("v1"))
    leaves = ends.join(pv, F.col("t").eqNullSafe(F.col("t1")) & (F.col("v") == F.col("v1")), "left_anti")
    best = W.partitionBy("t").orderBy(F.col("total").desc(), "v")
    path = leaves.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select("t", "v", "rank")
    for k in range(len(rounds) - 2, -1, -1):
        up = rounds[k].filter("up is not null").select(F.col("t").alias("t1"), F.col("v").alias("v1"), "up")
        above = path.join(up, F.col("t").eqNullSafe(F.col("t1")) & (F.col("v") == F.col("v1"))).select("t", F.col("up").alias("v"), "rank")
        path = scratch.write(path.unionByName(above), f"path{k}")
    path = path.join(ends.select(F.col("t").alias("t1"), F.col("v").alias("v1"), "depth"), F.col("t").eqNullSafe(F.col("t1")) & (F.col("v") == F.col("v1"))).select("t", "v", "rank", "depth")
    path = path.withColumnsRenamed({"t": "__path_t", "v": "__path_v"})
    kept = nodes.drop("rank", "depth")
    return kept.join(path, F.col("tree").eqNullSafe(F.col("__path_t")) & (F.col("node") == F.col("__path_v"))).drop("__path_t", "__path_v")


def format_paths(chosen: DataFrame) -> DataFrame:
    """One conversation for each tree and rank: (tree, rank, n_turns, formatted, loss_spans).

    chosen: tree, rank, depth, role, text. A turn of the assistant is `<s> role \\n text </s>`, any other `[INST] role \\n
    text [/INST]`, role and text escaped (null as empty). loss_spans: (start, length) in UTF-8 bytes of each assistant text in the formatted one.
    The offsets come from a running sum over turns, so a long conversation costs no more a turn than a short one.
    """
    ours = F.coalesce(F.col("role"), F.lit("")) == "assistant"
    head = F.concat(F.when(ours, F.lit("<s> ")).otherwise(F.lit("[INST] ")), _escape_role(F.coalesce(F.col("role"), F.lit(""))), F.lit("\n"))
    body = escape(F.coalesce(F.col("text"), F.lit("")))
    tail = F.when(ours, F.lit(" </s>")).otherwise(F.lit(" [/INST]"))
    turns = chosen.select("tree", "rank", "depth", ours.alias("ours"), head.alias("head"), body.alias("body"), tail.alias("tail"))
    turns = turns.select(
        "tree", "rank", "depth", "ours", F.octet_length("head").alias("hl"), F.octet_length("body").alias("bl"), F.concat("head", "body", "tail").alias("piece")
    )
    before = W.partitionBy("tree", "rank").orderBy("depth").rowsBetween(W.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(F.octet_length("piece")).over(before), F.lit(0)) + F.col("hl"))
    span = F.when(F.col("ours"), F.struct(F.col("at").alias("start"), F.col("bl").cast("long").alias("length")))
    got = turns.groupBy("tree", "rank").agg(F.array_sort(F.collect_list(F.struct("depth", "piece"))).alias("p"), F.array_sort(F.collect_list(span)).alias("loss_spans"))
    return got.select("tree", "rank", F.size("p").cast("long").alias("n_turns"), F.array_join("p.piece", "").alias("formatted"), "loss_spans")


def read_turns(formatted: Column) -> Column:
    """Back from the formatted text: array of (role, text)."""
    pieces = F.filter(F.split(formatted, r" (?:\[/INST\]|</s>)"), lambda x: x != "")

    def turn(piece: Column) -> Column:
        inner = F.regexp_replace(piece, r"\A(?:\[INST\]|<s>) ", "")
        cut = F.instr(inner, F.lit("\n"))
        return F.struct(_unescape_role(inner.substr(F.lit(1), cut - 1)).alias("role"), unescape(inner.substr(cut + 1, F.length(inner))).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted_bytes: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted_bytes, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string"))), ""
    )
