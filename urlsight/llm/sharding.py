"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

A row's key is the hash of its text, so copies start at the same point of the
ring and go to the first virtual node clockwise. Every shard has a quota (row
counts at most one apart); rows that meet a full shard go on clockwise to the
next shard that has room.

Rows are never ordered globally. They are counted for each arc of the ring (one
arc per virtual node, a fixed number), the arcs' counts are dealt to the shards, and
each row finds its place from its rank within its arc. A rank is the rows in the
arc's lower buckets plus the rank within the bucket, so an arc with a third of
all rows (one text copied) is still sorted in many small parts.
"""
from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage, with_columns_checked

CELLS = 1 << 14  # the ring's resolution
VIRTUAL_NODES = 64  # for each shard
BUCKET_ROWS = 20_000  # one bucket for this many rows of the table, in each arc


def values(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small fixed table from driver values."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def ring(spark: SparkSession, shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[dict]:
    """The arcs in ring order: the cell that ends each arc, and its shard (``shards * virtual_nodes`` rows)."""
    nodes = spark.range(shards * virtual_nodes).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).cast("long").alias("replica"))
    placed = nodes.withColumn("cell", F.pmod(F.xxhash64("shard", "replica"), F.lit(CELLS)).cast("int"))
    rows = placed.groupBy("cell").agg(F.min("shard").alias("shard")).orderBy("cell").collect()
    return [{"arc": i, "cell": r.cell, "shard": r.shard} for i, r in enumerate(rows)]


def clockwise(arcs: list[dict], shards: int) -> list[list[int]]:
    """For each arc, the distinct shards met clockwise from it, then those that lost all their nodes to others."""
    order = [a["shard"] for a in arcs]
    found = []
    for i in range(len(order)):
        found.append(list(dict.fromkeys([*order[i:], *order[:i], *range(shards)])))
    return found


def deal(arcs: list[dict], counts: dict[int, int], quotas: list[int]) -> list[dict]:
    """Which ranks of each arc go to which shard, and their first slot there."""
    room, slots = list(quotas), [0] * len(quotas)
    ways = clockwise(arcs, len(quotas))
    waiting = [(a["arc"], 0, counts.get(a["arc"], 0)) for a in arcs]
    pieces = []
    for step in range(len(quotas)):
        over = []
        for arc, start, n in waiting:
            if not n:
                continue
            shard = ways[arc][step]
            took = min(n, room[shard])
            if took:
                pieces.append({"arc": arc, "start": start, "until": start + took, "shard": shard, "base": slots[shard]})
                room[shard] -= took
                slots[shard] += took
            if n > took:
                over.append((arc, start + took, n - took))
        waiting = over
    if waiting:
        raise ValueError("the quotas are less than the rows")
    return pieces


def assign(docs: DataFrame, shards: int = 16) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)``, one row for each row of ``docs``.

    ``size`` is the UTF-8 bytes of the text plus one (null text: one, CRC of no
    bytes). Null ids, repeated rows and empty texts are placed like others;
    equal rows may swap places among themselves only. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    arcs = ring(spark, shards)
    cells = [dict(arc=a["arc"], low=(arcs[i - 1]["cell"] + 1 if i else 0), high=a["cell"]) for i, a in enumerate(arcs)]
    if arcs[-1]["cell"] < CELLS - 1:  # past the last node: on to the first
        cells.append(dict(arc=0, low=arcs[-1]["cell"] + 1, high=CELLS - 1))
    lookup = values(spark, cells, "arc int, low int, high int").select("arc", F.explode(F.sequence("low", "high")).alias("cell"))

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = with_columns_checked(docs, "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(CELLS)).cast("int").alias("cell"),
        F.xxhash64("doc_id", F.lit("order within an arc")).alias("mix"))
    # at most CELLS rows: bounded, whatever the table
    rows = stage(rows.join(F.broadcast(lookup), "cell").drop("cell"))
    total = rows.count()
    buckets = max(16, -(-total // BUCKET_ROWS))
    rows = rows.withColumn("bucket", F.pmod("mix", F.lit(buckets).cast("long")))

    loads = stage(rows.groupBy("arc", "bucket").agg(F.count("*").alias("n")))
    # one row for each arc
    counts = {r.arc: r.n for r in loads.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    # at most arcs * shards rows
    pieces = values(spark, deal(arcs, counts, quotas), "arc int, start long, until long, shard int, base long")

    before = Window.partitionBy("arc").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = loads.select("arc", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("arc", "bucket").orderBy("mix", "doc_id", "text_crc32", "size")
    ranked = (rows.withColumn("place", F.row_number().over(within) - 1).join(offsets, ["arc", "bucket"])
              .withColumn("rank", F.col("offset") + F.col("place")))
    placed = ranked.join(F.broadcast(pieces), "arc").where("rank >= start AND rank < until")
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("start")).alias("slot"))
