"""Chat formatting of reply trees, in DataFrame operations only.

Root-to-leaf paths are enumerated by iterated self-joins with doubling: after k joins a message knows its ancestor 2**k
replies up and the score in between, so a thread of n replies takes log2(n) joins of narrow rows (ids and numbers, no
text). Leaves are ranked by the mean score of their path; the chosen paths are then expanded by the same jump tables, each
ancestor reached exactly once, and only then joined with texts and formatted.

The template marks a turn as `<|im_start|>role NEWLINE text <|im_end|> NEWLINE`. Control strings of this and other common
templates inside a text get a backslash after their first sign, a backslash is doubled and a line end in a role is marked,
so that no control string stands literally in a text and `parse` gives back what went in. The loss mask is a list of
segments, each with its flag; the segments joined are the formatted text.

Defined results: null texts and roles count as empty; null tree ids form one tree; messages that name a missing parent are
roots; messages on a cycle have no root and are in no path; equal scores go to the leaf with the smallest id; messages of
one turn follow by role, then text; repeated rows are turns of their own; an empty table gives no conversation; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._spark import MIN_LONG, Work

START, END = "<|im_start|>", "<|im_end|>"
#: Control strings that texts must not hold literally (fixed values): START, END, <|endoftext|>, <s>, </s>, <<SYS>>,
#: <</SYS>>, [INST], [/INST].
CONTROL = r"<(?=\|(?:im_start|im_end|endoftext)\|>|/?s>|</?SYS>>)|\[(?=/?INST\])"
LEARNED = ("assistant",)


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\\n")), CONTROL, r"$0\\")


def paths(nodes: DataFrame, work: Work, top: int = 1) -> DataFrame:
    """(tree, leaf, rank, node, depth): the `top` best root-to-leaf paths of every tree, depth 0 at the root.

    nodes: tree, node, parent, score; (tree, node) is unique."""
    s = nodes.select("tree", "node", F.col("parent").alias("hop"), F.lit(1).cast("long").alias("dist"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total"))
    known = nodes.select("tree", F.col("node").alias("hop"), F.lit(True).alias("there"))
    s = s.join(known, ["tree", "hop"], "left").withColumn("hop", F.when(F.col("there"), F.col("hop"))).drop("there")
    # a step writes only messages that weren't at their root before it; what has got there is done
    jumps = [work.keep(s, "jump0")]
    done = jumps[0].where("hop IS NULL")
    most = jumps[0].count()
    for k in range(max(1, most).bit_length() + 1):
        open_ = jumps[-1].where("hop IS NOT NULL")
        if open_.isEmpty():
            break
        up = done.unionByName(open_).select("tree", F.col("node").alias("hop"), F.col("hop").alias("far"), F.col("dist").alias("d2"), F.col("total").alias("t2"))
        further = open_.join(up, ["tree", "hop"], "left").select(
            "tree", "node", F.col("far").alias("hop"), (F.col("dist") + F.coalesce("d2", F.lit(0))).alias("dist"), (F.col("total") + F.coalesce("t2", F.lit(0.0))).alias("total")
        )
        jumps.append(work.keep(further, f"jump{k + 1}"))
        done = done.unionByName(jumps[-1].where("hop IS NULL"))
    rooted = done.withColumn("score", F.col("total") / F.col("dist"))
    parents = nodes.where("parent IS NOT NULL").select("tree", F.col("parent").alias("node"))
    leaves = rooted.join(parents, ["tree", "node"], "left_anti")
    if top == 1:  # one value a tree, combined before the shuffle
        best = leaves.groupBy("tree").agg(F.max(F.struct("score", (-F.col("node")).alias("minus"), "dist")).alias("b"))
        chosen = best.select("tree", (-F.col("b.minus")).alias("leaf"), F.lit(1).alias("rank"), F.col("b.dist").alias("dist"))
    else:
        w = W.partitionBy("tree").orderBy(F.desc("score"), "node")
        chosen = leaves.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select("tree", F.col("node").alias("leaf"), "rank", "dist")
    on = chosen.select("tree", "leaf", "rank", F.col("leaf").alias("node"), (F.col("dist") - 1).alias("depth"))
    for k, jump in enumerate(jumps[:-1]):  # every distance from the leaf is one sum of distinct powers of two
        step = jump.where("hop IS NOT NULL").select("tree", "node", "hop")
        on = on.unionByName(on.join(step, ["tree", "node"]).select("tree", "leaf", "rank", F.col("hop").alias("node"), (F.col("depth") - 2**k).alias("depth")))
        on = work.keep(on, f"path{k}")
    return on


def formatted(nodes: DataFrame, work: Work | None = None, top: int = 1, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """tree, leaf, rank, n_turns, segments array<struct<text, loss>>, formatted: one conversation a chosen path.

    nodes: tree, node, parent, score, role, text."""
    work = work or Work(nodes.sparkSession, "chat")
    on = paths(nodes, work, top)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = nodes.select("tree", "node", F.concat(F.lit(START), escape_role(role), F.lit("\n")).alias("head"), escape(text).alias("body"), role.isin(*learned).alias("loss"))
    rows = on.join(turn, ["tree", "node"])
    grouped = rows.groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list(F.struct("depth", "head", "body", "loss"))).alias("turns"))
    close = F.lit(END + "\n")
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                F.struct(t["head"].alias("text"), F.lit(False).alias("loss")), F.struct(t["body"].alias("text"), t["loss"].alias("loss")), F.struct(close.alias("text"), F.lit(False).alias("loss"))
            ),
        )
    )
    out = grouped.select("tree", "leaf", "rank", F.size("turns").cast("long").alias("n_turns"), segments.alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def parse(text: Column) -> Column:
    """array<struct<role, text>> of the turns in a formatted text."""

    def turn(part: Column) -> Column:
        role = F.regexp_extract(part, r"(?s)^([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n", 1)
        at = F.length(role) + 2
        body = F.substring(part, at, F.length(part) - at + 1 - len(END) - 1)
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    # parts by the mark that no escaped text holds; the first, before the first mark, is empty
    parts = F.split(text, r"<\|im_start\|>")
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def loss_text(segments: Column) -> Column:
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def threads(messages: DataFrame) -> DataFrame:
    """Nodes of a table of plain conversations (conv_id, turn, role, text): each turn replies to the one before.

    A conversation's turns are numbered over one narrow row a turn (its number of messages, no text); only messages of one turn are
    ordered by role and text, so texts are dealt by conversation and turn, and a long conversation is in many tasks."""
    tree, blank, turn = F.coalesce(F.col("conv_id").cast("long"), F.lit(MIN_LONG)), F.col("turn").isNull(), F.coalesce("turn", F.lit(0))
    m = messages.select(tree.alias("tree"), blank.alias("blank"), turn.alias("turn"), "role", "text")
    before = F.sum("k").over(W.partitionBy("tree").orderBy(F.desc("blank"), "turn").rowsBetween(W.unboundedPreceding, -1))
    places = m.groupBy("tree", "blank", "turn").agg(F.count("*").alias("k")).select("tree", "blank", "turn", F.coalesce(before, F.lit(0)).alias("before"))
    tied = F.row_number().over(W.partitionBy("tree", "blank", "turn").orderBy(F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()))
    numbered = m.withColumn("tied", tied).join(places, ["tree", "blank", "turn"]).withColumn("node", F.col("before") + F.col("tied"))
    return numbered.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(1.0).alias("score"), "role", "text")


def report(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the formatted output."""
    work = Work(conversations.sparkSession, "chat")
    nodes = work.keep(threads(conversations), "nodes")
    out = formatted(nodes, work)
    turns = F.array_join(F.transform(parse(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = loss_text(F.col("segments"))
    return out.select(
        F.when(F.col("tree") != MIN_LONG, F.col("tree")).alias("conv_id"),
        F.size(parse(F.col("formatted"))).cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
