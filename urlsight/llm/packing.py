"""Best-fit packing of documents into training sequences, with conflicts.

Documents are dealt into groups of about ``GROUP_ROWS`` rows; each group is one
bounded task that packs its rows, longest first. Bins are kept in the order of
their residual space and carry two bitmaps: the sources and the duplicate
clusters they hold. A piece goes to the bin with the least space that is enough
(successor search), passing on to the next larger residual until a bin is
compatible; without any, it opens a bin. Compatible: the bin has no piece of the
same duplicate cluster, and fewer than ``per_source`` of the same source.
"""
from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import bounded_batches, stage

CAPACITY = 2048  # words in a bin
PER_SOURCE = 2  # pieces of one source in a bin
GROUP_ROWS = 2048
SCHEMA = "doc_id long, source string, piece int, start_word long, n_words long, bin string, bin_offset long"


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int, per_source: int) -> list[tuple[int, int]]:
    """``(bin, offset)`` of each piece; the pieces come in the order in which they are placed."""
    source_at: dict = {}
    times: dict = {}
    for c in clusters:
        times[c] = times.get(c, 0) + 1
    cluster_at: dict = {}
    order: list[tuple[int, int]] = []  # (residual, bin), ascending
    held_sources: list[int] = []
    held_clusters: list[int] = []
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters):
        # each source owns ``per_source`` bits; no source, no conflict
        low = per_source * source_at.setdefault(source, len(source_at)) if source is not None else None
        mine = ((1 << per_source) - 1) << low if low is not None else 0
        bit = 1 << cluster_at.setdefault(cluster, len(cluster_at)) if cluster is not None and times[cluster] > 1 else 0
        at = bisect_left(order, (size, -1))
        while at < len(order):
            b = order[at][1]
            if not held_clusters[b] & bit and (not mine or held_sources[b] & mine != mine):
                break
            at += 1
        if at < len(order):
            residual, b = order.pop(at)
        else:
            residual, b = capacity, len(held_sources)
            held_sources.append(0)
            held_clusters.append(0)
        placed.append((b, capacity - residual))
        insort(order, (residual - size, b))
        held_clusters[b] |= bit
        if mine:
            free = mine & ~held_sources[b]
            held_sources[b] |= free & -free  # the lowest free bit of the source
    return placed


def pack_group(rows: pd.DataFrame, capacity: int, per_source: int) -> pd.DataFrame:
    """All pieces of one group of documents. Full pieces of long documents get bins of their own."""
    rows = rows.sort_values(["n_words", "place"], ascending=[False, True])
    pieces = []  # (doc_id, source, cluster, piece, start, size)
    for r in rows.itertuples(index=False):
        n = int(r.n_words)
        doc = None if pd.isna(r.doc_id) else int(r.doc_id)
        for k, start in enumerate(range(0, n, capacity)):
            pieces.append((doc, r.source, r.cluster, k, start, min(capacity, n - start)))
    pieces.sort(key=lambda p: -p[5])
    full = sum(p[5] == capacity for p in pieces)
    found = [(i, 0) for i in range(full)]
    found += [(b + full, o) for b, o in best_fit([p[5] for p in pieces[full:]], [p[1] for p in pieces[full:]],
                                                 [p[2] for p in pieces[full:]], capacity, per_source)]
    group = int(rows["group"].iloc[0])
    out = pd.DataFrame([(p[0], p[1], p[3], p[4], p[5], f"{group}-{b}", o) for p, (b, o) in zip(pieces, found)],
                       columns=["doc_id", "source", "piece", "start_word", "n_words", "bin", "bin_offset"])
    return out.astype({"doc_id": "Int64"})


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def _near(rows: DataFrame) -> DataFrame:
    """``rows`` with the component of each fingerprint instead of the fingerprint as ``cluster``."""
    fps = stage(rows.groupBy(F.col("cluster").alias("fp")).agg(F.min("doc_id").alias("first_doc")))
    roots = simhash.canonical(fps).select(F.col("fp").alias("cluster"), "root")
    return rows.join(roots, "cluster").select("doc_id", "source", "n_words", F.col("root").alias("cluster"))


def pack(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, group_rows: int = GROUP_ROWS,
         cluster: Column | None = None, shingle: int | None = None) -> DataFrame:
    """Pieces of all documents with their bins: ``(doc_id, source, piece, start_word, n_words, bin, bin_offset)``.

    A document of more than ``capacity`` words is cut into full pieces and a rest.
    ``cluster`` names the duplicate cluster of a row; without it, rows with
    the same words in lower case are one cluster. ``shingle`` (words) makes near
    copies clusters: rows whose texts' SimHash fingerprints are linked, at most
    three bits apart, as in ``simhash.components`` but for each row, whatever its id. Rows without words (null or
    blank text) have nothing to pack and get one row with a null bin. A null
    source has no conflicts; repeated rows are packed each; an empty table gives
    an empty result.
    """
    if "source" not in docs.columns:
        docs = docs.withColumn("source", F.lit(None).cast("string"))
    if shingle is not None and cluster is not None:
        raise ValueError("give cluster or shingle")
    if shingle is not None:
        bounded_batches(docs.sparkSession)
        # words and fingerprint come out of one pass over the text
        info = simhash.measured_column(F.col("text"), shingle)
        slim = docs.select("doc_id", "source", info.alias("i")).select("doc_id", "source", "i.n_words", F.col("i.fp").alias("cluster"))
    elif cluster is not None:
        slim = docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("n_words"), cluster.cast("long").alias("cluster"))
    else:
        # one variable holds the words, so the text is split once
        info = F.get(F.transform(F.array(words(F.col("text"))), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), F.xxhash64(F.lower(F.array_join(w, " "))).alias("same"))), F.lit(0))
        slim = docs.select("doc_id", "source", info.alias("i")).select("doc_id", "source", "i.n_words", F.col("i.same").alias("cluster"))
    rows = stage(slim.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "n_words", "cluster"))
    if shingle is not None:
        rows = stage(_near(rows))
    groups = max(1, -(-rows.count() // group_rows))
    # a row's place in the written table: even groups, whatever ids repeat
    placed = rows.withColumn("place", F.monotonically_increasing_id())
    placed = placed.withColumn("group", F.pmod(F.xxhash64("place"), F.lit(groups).cast("long")))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        return pack_group(part, capacity, per_source)

    packed = placed.where("n_words > 0").groupBy("group").applyInPandas(run, SCHEMA)
    nothing = rows.where("n_words = 0").selectExpr(
        "doc_id", "source", "0 AS piece", "0L AS start_word", "0L AS n_words", "CAST(NULL AS STRING) AS bin", "CAST(NULL AS BIGINT) AS bin_offset")
    return packed.unionByName(nothing)
