"""Chat formatting of reply trees.

Messages form trees (a message and the message it answers). Iterative
self-joins double the distance of every message's pointer, so a path of n
messages takes log2(n) rounds: the first pass sums scores from the root to each
message, the branches (leaves) of a tree are ranked by that sum, and a second
pass walks back from the chosen leaves to enumerate their root-to-leaf paths.
Each path becomes one conversation.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage, with_columns_checked

# The template: markers around each turn. Texts never hold '<' or '[' once escaped.
TURN, END = "<|turn|>", "<|end|>\n"
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;")]


def escape(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def escape_role(role: Column) -> Column:
    """The role stands on a line of its own."""
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def chains(messages: DataFrame) -> DataFrame:
    """Conversations by turn, ``(conv_id, turn, role, text)``, as reply trees without branches.

    Each row answers the row before it; rows with equal turns are ordered by
    role and text, and a null turn comes first. Null roles and texts are empty. The score is the
    length of assistant texts.
    """
    rows = with_columns_checked(messages, "conv_id", "turn", "role", "text").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return rows.withColumn("msg", place.cast("long")).select(
        F.col("conv_id").alias("tree"), "msg", F.when(F.col("msg") > 1, F.col("msg") - 1).alias("parent"), "role", "text",
        F.when(F.col("role") == "assistant", F.length("text")).otherwise(0).cast("double").alias("score"))


def _at(left: DataFrame, on: str, right: DataFrame) -> DataFrame:
    """``left`` with the pointer (``up2``, ``part2``) of the message that column ``on`` names; rows without one go."""
    right = right.select(F.col("tkey").alias("t2"), F.col("msg").alias("m2"), F.col("up").alias("up2"), F.col("part").alias("part2"))
    return left.join(right, (left.tkey == right.t2) & (left[on] == right.m2)).drop("t2", "m2")


def paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """The ``branches`` best root-to-leaf paths of each tree: ``(tkey, leaf, rank, msg, dist)``.

    ``nodes``: ``(tkey, msg, parent, score)``. A parent that is not there makes
    a root. Messages whose answers form a circle have no leaf and no path.
    """
    there = nodes.select(F.col("tkey").alias("t2"), F.col("msg").alias("m2"))
    real = nodes.join(there, (nodes.tkey == there.t2) & (nodes.parent == there.m2), "left")
    # part: the scores from a message up to its pointer; without a pointer, up to the root
    table = stage(real.select("tkey", "msg", F.col("m2").alias("up"), F.col("score").alias("part")))
    longest = table.groupBy("tkey").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    done, live = table.where("up IS NULL"), table.where("up IS NOT NULL")
    steps = [live]  # the pointers 1, 2, 4, ... messages up, of messages that deep
    while (1 << (len(steps) - 1)) < longest and live.limit(1).count():
        farther = _at(live, "up", table).select("tkey", "msg", F.col("up2").alias("up"), (F.col("part") + F.col("part2")).alias("part"))
        table = stage(done.unionByName(farther))
        done, live = table.where("up IS NULL"), table.where("up IS NOT NULL")
        steps.append(live)
    parents = nodes.where("parent IS NOT NULL").select(F.col("tkey").alias("t2"), F.col("parent").alias("m2")).distinct()
    leaves = done.join(parents, (done.tkey == parents.t2) & (done.msg == parents.m2), "left_anti")
    best = Window.partitionBy("tkey").orderBy(F.desc("part"), "msg")
    walk = (leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
            .select("tkey", F.col("msg").alias("leaf"), "rank", "msg", F.lit(0).cast("long").alias("dist")))
    for k, step in enumerate(steps):
        farther = _at(walk, "msg", step).select("tkey", "leaf", "rank", F.col("up2").alias("msg"), (F.col("dist") + (1 << k)).alias("dist"))
        walk = stage(walk.unionByName(farther))
    return walk


def format_trees(messages: DataFrame, branches: int = 1) -> DataFrame:
    """One row for each chosen path: ``(tree, rank, formatted, mask)``.

    ``messages``: ``(tree, msg, parent, role, text, score)``, ``msg`` unique in its
    tree; other columns are not read. ``mask`` lists the spans ``(start, len)`` in code points of
    ``formatted`` that carry loss: each assistant text, in order. A null tree
    is a tree of its own; an empty table gives an empty result.
    """
    rows = stage(with_columns_checked(messages, "tree", "msg", "parent", "role", "text", "score").withColumn(
        "tkey", F.coalesce(F.concat(F.lit("t"), F.col("tree").cast("string")), F.lit("null"))))
    chosen = paths(rows.select("tkey", "msg", "parent", "score"), branches)
    head = F.concat(F.lit(TURN), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    turns = chosen.join(rows.select("tkey", "tree", "msg", "role", "text"), ["tkey", "msg"]).select(
        "tkey", "tree", "leaf", "rank", "dist", head.alias("head"), body.alias("body"), (F.col("role") == "assistant").alias("loss"))
    length = F.length("head") + F.length("body") + len(END)
    before = Window.partitionBy("tkey", "leaf").orderBy(F.desc("dist")).rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn("start", F.coalesce(F.sum(length).over(before), F.lit(0)) + F.length("head"))
    item = F.struct((-F.col("dist")).alias("at"), F.concat("head", "body", F.lit(END)).alias("piece"), "loss", "start",
                    F.length("body").alias("len"))
    grouped = placed.groupBy("tkey", "leaf", "rank").agg(F.first("tree").alias("tree"), F.array_sort(F.collect_list(item)).alias("turns"))
    return grouped.select(
        "tree", "rank", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].cast("long").alias("start"), t["len"].cast("long").alias("len"))).alias("mask"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation as ``array<struct<role, text>>``."""
    pieces = F.array_remove(F.split(formatted, r"<\|turn\|>"), "")

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        skip = F.length(role) + 1
        text = F.substring(piece, skip + 1, F.length(piece) - skip - len(END))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(mask, lambda s: unescape(F.substring(formatted, s["start"].cast("int") + 1, s["len"].cast("int")))), "")
