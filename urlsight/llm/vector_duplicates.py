"""Near-duplicate vectors by product quantisation over coarse inverted lists.

A bounded sample fits coarse centres and, on the residuals, one code book for
each subspace. Every vector is put into the inverted list of its nearest centre as
a code, and looks for partners in all lists whose centre is near enough to hold
one (``probe_floor``). Inside a list, distances are asymmetric: one table of products
of the query's subvectors with the code books, looked up by the codes of the list.
The quantisation error of each vector is known, so a look-up bounds the true cosine:
what stays below the threshold by its bound is passed over without loss, all
else is compared exactly in double precision.

Lists and the queries that come to them are cut into chunks, so no task holds a
list whole. No pairs are written: a task returns the number of links of each
query, and for each connected vector one pointer to another of its component.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import bounded_batches, stage, with_columns_checked
from .components import connected_components

SAMPLE_ROWS = 65_536     # vectors that fit centres and code books, at most (about)
LIST_ROWS = 256          # vectors of a list, on average
MOST_LISTS = 16_384
CHUNK = 8_192            # vectors and queries of a task, each
SUBSPACES, CODES = 16, 256
APART = 0.8              # cosine that no two first centres pass
SPREAD = 3.0             # standard deviations of a partner's noise that a probe allows for


@dataclass
class Quantiser:
    """Coarse centres and one code book a subspace, in single precision; bounded by ``MOST_LISTS`` and ``CODES``."""
    centres: np.ndarray
    columns: list[np.ndarray]
    books: list[np.ndarray]

    @property
    def dims(self) -> int:
        return self.centres.shape[1]


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres ** 2).sum(axis=1) / 2
    return np.concatenate([(x[i:i + 4096] @ centres.T - half).argmax(axis=1) for i in range(0, len(x), 4096)])


def _k_means(x: np.ndarray, centres: np.ndarray, rounds: int) -> np.ndarray:
    for _ in range(rounds):
        own = _nearest(x, centres)
        order = np.argsort(own, kind="stable")
        ids, first = np.unique(own[order], return_index=True)
        centres = centres.copy()
        centres[ids] = np.add.reduceat(x[order], first) / np.diff([*first, len(x)])[:, None]
    return centres


def fit(sample: np.ndarray, lists: int) -> Quantiser:
    """From unit vectors. First centres are far from each other, so a group of near copies gets one list, not many."""
    x = sample.astype(np.float32)
    picked = np.zeros((0, x.shape[1]), np.float32)
    for i in range(0, len(x), 512):
        if len(picked) >= lists:
            break
        part = x[i:i + 512]
        for row in part[(part @ picked.T).max(axis=1, initial=-1) < APART]:
            if len(picked) < lists and (picked @ row).max(initial=-1) < APART:
                picked = np.vstack([picked, row])
    centres = _k_means(x, picked, 4)
    norms = np.linalg.norm(centres, axis=1, keepdims=True)
    centres = centres / np.where(norms > 0, norms, 1)
    rest = (x - centres[(x @ centres.T).argmax(axis=1)])[:16_384]
    columns = [c for c in np.array_split(np.arange(x.shape[1]), SUBSPACES) if len(c)]
    books = []
    for c in columns:
        part = np.ascontiguousarray(rest[:, c])
        books.append(_k_means(part, part[np.linspace(0, len(part) - 1, min(CODES, len(part))).astype(int)], 6))
    return Quantiser(centres, columns, books)


def probe_floor(best: np.ndarray, threshold: float, dims: int) -> np.ndarray:
    """Cosine to a centre from which its list is probed by a vector with cosine ``best`` to its own centre.

    A partner at the threshold has about the same best cosine; turned towards the query it keeps ``threshold`` of
    it, plus noise of variance ``(1 - threshold ** 2) / dims`` in directions that have nothing to do with the centre.
    """
    return np.minimum(best, threshold * best - SPREAD * math.sqrt((1 - threshold ** 2) / dims))


def _units(blobs: Iterable[bytes], width: type, dims: int) -> np.ndarray:
    blobs = list(blobs)
    out = np.zeros((len(blobs), dims))
    for i, b in enumerate(blobs):
        v = np.frombuffer(b, width)
        out[i, :len(v)] = v
    out /= np.abs(out).max(axis=1, keepdims=True)    # so that no square overflows
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def encode(x: np.ndarray, model: Quantiser, threshold: float) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """List, codes and probed lists of unit vectors."""
    x = x.astype(np.float32)
    near = x @ model.centres.T
    own = near.argmax(axis=1)
    floor = probe_floor(near.max(axis=1), threshold, model.dims)
    rest = x - model.centres[own]
    codes = np.stack([_nearest(np.ascontiguousarray(rest[:, c]), b) for c, b in zip(model.columns, model.books)], axis=1).astype(np.uint8)
    return own, codes, [np.flatnonzero(row >= f) for row, f in zip(near, floor)]


def _indexed(model, width: type, threshold: float) -> Callable:
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            if len(rows):
                vec = [np.asarray(v, width).tobytes() for v in rows["vec"]]
                own, codes, probes = encode(_units(vec, width, model.value.dims), model.value, threshold)
                yield pd.DataFrame({"node": rows["node"], "copies": rows["copies"], "vec": vec, "list": own.astype(np.int32),
                                    "codes": [c.tobytes() for c in codes], "probes": [p.astype(np.int32) for p in probes]})
    return run


def linked_in_list(centre: np.ndarray, model: Quantiser, codes: np.ndarray, x: np.ndarray, lengths: np.ndarray, copies: np.ndarray,
                   queries: np.ndarray, query_lengths: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(links, pointer, root)``: for each query its number of links in the list, weighted by copies, and a linked
    vector (-1: none); for each vector of the list the smallest position that the queries connect it to."""
    guess = centre + np.concatenate([b[codes[:, m]] for m, b in enumerate(model.books)], axis=1)
    size = (guess ** 2).sum(axis=1)
    error = x - guess
    along = (error * guess).sum(axis=1) / np.where(size > 0, size, 1)
    across = np.sqrt(np.maximum((error ** 2).sum(axis=1) - along ** 2 * size, 0))
    links, pointer, root = np.zeros(len(queries), np.int64), np.full(len(queries), -1), np.arange(len(x))
    for i in range(0, len(queries), 256):
        q = queries[i:i + 256]
        seen = np.repeat((q @ centre)[:, None], len(x), axis=1)
        for m, (c, b) in enumerate(zip(model.columns, model.books)):
            seen += (q[:, c] @ b.T)[:, codes[:, m]]
        highest = seen * (1 + along) + across * np.sqrt(np.maximum(1 - seen ** 2 / np.where(size > 0, size, 1), 0))
        highest[:, size <= 0] = 1
        open_ = (highest >= threshold - 1e-4) & (query_lengths[i:i + 256, None] == lengths)
        held = np.flatnonzero(open_.any(axis=0))
        if not len(held):
            continue
        linked = open_[:, held] & (q @ x[held].T >= threshold)
        links[i:i + 256] = linked @ copies[held]
        for r in np.flatnonzero(linked.any(axis=1)):
            at = held[linked[r]]
            pointer[i + r] = at[0]
            roots = np.unique(root[at])
            if len(roots) > 1:
                root[np.isin(root, roots)] = roots[0]
    return links, pointer, root


def _compared(model, width: type, threshold: float) -> Callable:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own, asked = rows[~rows["asks"]], rows[rows["asks"]]
        out = {"node": [], "links": [], "other": []}
        if len(own) and len(asked):
            m = model.value
            x, q = (_units(part["vec"], width, m.dims) for part in (own, asked))
            codes = np.frombuffer(b"".join(own["codes"]), np.uint8).reshape(len(own), -1)
            nodes, asking = own["node"].to_numpy(), asked["node"].to_numpy()
            links, pointer, root = linked_in_list(m.centres[key[0]].astype(float), m, codes, x, own["vec"].map(len).to_numpy(),
                                                  own["copies"].to_numpy(), q, asked["vec"].map(len).to_numpy(), threshold)
            hit, moved = pointer >= 0, root != np.arange(len(root))
            out = {"node": np.concatenate([asking[hit], nodes[moved]]), "links": np.concatenate([links[hit], np.zeros(moved.sum(), np.int64)]),
                   "other": np.concatenate([nodes[root[pointer[hit]]], nodes[root[moved]]])}
        return pd.DataFrame(out).astype("int64")
    return run


def usable(vec: Column) -> Column:
    """Whether a vector has a direction: not null, no null or non-finite component, not zero."""
    sound = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(sound & F.exists(vec, lambda v: v != 0), F.lit(False))


def links(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """``(id, n_links, component_id, kept)``: one row for each row of ``rows``.

    Vectors are linked if their cosine is ``threshold`` or more; ``n_links``
    counts other rows linked directly, ``component_id`` is the smallest id reachable.
    Equal vectors are one vector with a count inside. Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing, nor do
    vectors of different lengths. A row without id takes part, but never names a
    component, and is never kept. Repeated rows stay repeated; an empty table
    gives an empty result.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold lies above 0 and up to 1")
    spark = rows.sparkSession
    slim = with_columns_checked(rows, id_col, vec_col).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    width = np.float32 if isinstance(slim.schema["vec"].dataType, ArrayType) and isinstance(slim.schema["vec"].dataType.elementType, FloatType) else np.float64
    slim = slim.withColumn("vec", F.col("vec").cast("array<float>" if width is np.float32 else "array<double>"))
    sound = slim.where(usable(F.col("vec")))
    grouped = stage(sound.groupBy("vec").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
                    .withColumn("node", F.monotonically_increasing_id()))
    counted = grouped.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dims")).first()
    alone = slim.where(~usable(F.col("vec"))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    if counted["n"]:
        found = node_links(grouped, counted["n"], counted["dims"], width, threshold)
        # the vector itself is the key: a copied one is a skewed key with one row on the other side
        nodes = grouped.select("vec", "node").join(found, "node").drop("node")
        alone = alone.unionAll(sound.join(nodes, "vec").select("id", "n_links", "component_id"))
    return alone.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def node_links(grouped: DataFrame, n: int, dims: int, width: type, threshold: float) -> DataFrame:
    """Distinct ``(node, vec, copies, least)`` -> ``(node, n_links, component_id)``."""
    spark = grouped.sparkSession
    bounded_batches(spark, 2_000)
    part = 1 << 20
    take = math.ceil(min(1.0, SAMPLE_ROWS / n) * part)
    sample = grouped.where(F.pmod(F.xxhash64("vec"), F.lit(part)) < take).select("vec").toPandas()["vec"]
    if not len(sample):
        sample = grouped.select("vec").limit(1).toPandas()["vec"]
    x = _units([np.asarray(v, width).tobytes() for v in sample], width, dims)
    model = spark.sparkContext.broadcast(fit(x, min(MOST_LISTS, math.ceil(n / LIST_ROWS))))
    index = stage(grouped.select("node", "copies", "vec").mapInPandas(
        _indexed(model, width, threshold), "node long, copies long, vec binary, list int, codes binary, probes array<int>"))

    asks = index.select("node", "vec", F.explode("probes").alias("list"))
    # one row for each list: bounded by MOST_LISTS
    cut = stage(index.groupBy("list").agg(F.count("*").alias("rows")).join(asks.groupBy("list").agg(F.count("*").alias("asking")), "list")
                .select("list", F.ceil(F.col("rows") / CHUNK).cast("int").alias("own_chunks"), F.ceil(F.col("asking") / CHUNK).cast("int").alias("ask_chunks")))
    salt = F.abs(F.hash("node"))
    own = index.join(F.broadcast(cut), "list").select(
        "list", (salt % F.col("own_chunks")).alias("own_chunk"), F.explode(F.sequence(F.lit(0), F.col("ask_chunks") - 1)).alias("ask_chunk"),
        F.lit(False).alias("asks"), "node", "copies", "vec", "codes")
    asked = asks.join(F.broadcast(cut), "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("own_chunks") - 1)).alias("own_chunk"), (salt % F.col("ask_chunks")).alias("ask_chunk"),
        F.lit(True).alias("asks"), "node", F.lit(0).cast("long").alias("copies"), "vec", F.lit(None).cast("binary").alias("codes"))
    met = stage(own.unionByName(asked).groupBy("list", "own_chunk", "ask_chunk").applyInPandas(
        _compared(model, width, threshold), "node long, links long, other long"))
    links_ = met.groupBy("node").agg((F.sum("links") - 1).alias("n_links"))
    joined = connected_components(met.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")))
    rooted = stage(grouped.select("node", "least").join(joined, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return stage(rooted.join(least, "root").join(links_, "node").select("node", "n_links", "component_id"))
