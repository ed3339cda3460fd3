"""Quality classifier: Naive Bayes support vectors (NB-SVM).

Each document becomes the set of its hashed n-grams (bytes, orders 1 to 4) plus
indicators for its length and its share of repeated word windows. An indicator
is scaled by the log ratio of its counts in the two classes; a linear model with hinge
loss is fitted on the scaled, length-normalised vectors by dual coordinate
descent. The class counts cover every labelled training row; the model itself is
fitted on a bounded sample of them (``SAMPLE_PER_CLASS``, smallest id hashes).
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, checked_broadcast, with_columns_checked
from .quality_rules import repeated_words

DIMS = 1 << 17
SAMPLE_PER_CLASS = 2000
SHAPE = 1 << 10  # the last indexes: length and repetition indicators
ORDERS = (1, 2, 3, 4)
EPOCHS, COST, SMOOTH = 40, 1.0, 1.0
PIECE = 1 << 20  # bytes hashed at once


def features(text: bytes | None, seen: np.ndarray) -> np.ndarray:
    """The sorted indicator indexes of one whole text. ``seen``: ``DIMS`` false flags, left false."""
    text = text or b""
    for begin in range(0, len(text), PIECE):
        codes = np.frombuffer(text[begin:begin + PIECE + ORDERS[-1] - 1], np.uint8).astype(np.uint32)
        gram = np.zeros(len(codes), np.uint32)
        for n in ORDERS:
            gram = (gram[:len(codes) - n + 1] << np.uint32(8)) | codes[n - 1:]
            mixed = (gram ^ np.uint32(n * 0x9E3779B9 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0xC2B2AE35)
            seen[(mixed >> np.uint32(8)) % np.uint32(DIMS - SHAPE)] = True
    words = text.split()
    again = repeated_words(words)
    at = DIMS - SHAPE
    seen[at + min(63, int(2 * math.log2(len(words) + 1)))] = True
    seen[at + 64 + (again * 16 // len(words) if words else 17)] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found.astype(np.int32)


@dataclass
class Model:
    ratio: np.ndarray  # log-count ratio of each indicator
    weight: np.ndarray
    bias: float
    slope: float  # of the logistic curve from margin to score
    shift: float

    def margin(self, found: np.ndarray) -> float:
        scaled = self.ratio[found]
        norm = float(np.sqrt(scaled @ scaled)) or 1.0
        return float(scaled @ self.weight[found]) / norm + self.bias

    def score(self, found: np.ndarray) -> float:
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, self.slope * self.margin(found) + self.shift))))


def descend(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Hinge-loss weights and bias by dual coordinate descent; classes weigh the same in total."""
    values = []
    for found in rows:
        scaled = ratio[found]
        values.append((scaled / (float(np.sqrt(scaled @ scaled)) or 1.0)).astype(np.float32))
    signs = np.where(labels > 0, 1.0, -1.0)
    share = {s: max(1, int((signs == s).sum())) for s in (1.0, -1.0)}
    limit = np.array([COST * len(rows) / (2 * share[s]) for s in signs])
    diagonal = np.array([float(v @ v) + 1.0 for v in values])  # one more input is always 1
    alpha, weight, bias = np.zeros(len(rows)), np.zeros(len(ratio)), 0.0
    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in order.permutation(len(rows)):
            found, value = rows[i], values[i]
            slack = signs[i] * (float(value @ weight[found]) + bias) - 1.0
            new = min(max(alpha[i] - slack / diagonal[i], 0.0), limit[i])
            step = (new - alpha[i]) * signs[i]
            if step:
                weight[found] += step * value
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weight, bias


def calibrate(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through ``(margin, label)``, by Newton's method."""
    slope, shift = 1.0, 0.0
    n_pos, n_neg = max(1.0, weights[labels > 0].sum()), max(1.0, weights[labels <= 0].sum())
    goal = np.where(labels > 0, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -500, 500)))
        g = weights * (p - goal)
        h = weights * p * (1 - p) + 1e-9
        a, b, c = (h * margins * margins).sum() + 1e-6, (h * margins).sum(), h.sum() + 1e-6
        ga, gb = (g * margins).sum() + 1e-6 * slope, g.sum()
        det = a * c - b * b
        da, db = (c * ga - b * gb) / det, (a * gb - b * ga) / det
        slope, shift = slope - da, shift - db
        if abs(da) + abs(db) < 1e-8:
            break
    return float(max(slope, 1e-3)), float(shift)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether CRC-32 of the id as text leaves ``part`` modulo ``parts``; rows without id are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(True))


def _counts(train: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(DIMS, bool), np.zeros((2, DIMS), np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                total[label][features(text.as_py(), seen)] += 1
        at = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[0][at]), pa.array(total[1][at])], ["at", "n0", "n1"])

    slim = train.select(F.col("text").cast("binary").alias("text"), "label")
    found = slim.mapInArrow(run, "at int, n0 long, n1 long")
    return found.groupBy("at").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def fit(docs: DataFrame, labels: DataFrame, label: str, usable: Column, sample_per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fit on the rows of ``docs`` that ``labels`` covers and ``usable`` (a condition on ``doc_id``) allows.

    ``labels``: ``(doc_id, <label>)``; null labels are ignored, and of several labels
    of one id the smallest counts. Without rows of both classes the model is
    constant: the share of label 1 (one half without any row).
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    known = (with_columns_checked(labels, "doc_id", label).where(F.col(label).isNotNull() & usable)
             .groupBy("doc_id").agg(F.min(F.when(F.col(label) > 0, 1).otherwise(0)).alias("label")))
    train = with_columns_checked(docs, "doc_id", "text").join(checked_broadcast(known), "doc_id")
    counts = _counts(train).toPandas()  # at most DIMS rows
    per_class = np.zeros((2, DIMS))
    per_class[0][counts["at"]], per_class[1][counts["at"]] = counts["n0"], counts["n1"]
    sizes = dict.fromkeys((0, 1), 0) | {r.label: r.n for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not (sizes[0] and sizes[1]):
        share = sizes[1] / max(1, sizes[0] + sizes[1]) if sizes[0] + sizes[1] else 0.5
        shift = math.log((share + 1e-6) / (1 - share + 1e-6))
        return Model(np.zeros(DIMS), np.zeros(DIMS), 0.0, 1.0, shift)
    smooth = per_class + SMOOTH
    smooth /= smooth.sum(axis=1, keepdims=True)
    ratio = np.where(per_class.any(axis=0), np.log(smooth[1] / smooth[0]), 0.0)

    mixed = F.xxhash64("doc_id", F.lit("sample"))
    chosen = [known.where(F.col("label") == c).orderBy(mixed, "doc_id").limit(sample_per_class) for c in (0, 1)]
    ids = checked_broadcast(chosen[0].unionByName(chosen[1]))  # at most two samples
    sample = (with_columns_checked(docs, "doc_id", "text").join(ids, "doc_id").groupBy("doc_id").agg(F.first("text").alias("text"), F.first("label").alias("label")))

    @F.pandas_udf("binary")
    def indexes(texts: pd.Series) -> pd.Series:
        seen = np.zeros(DIMS, bool)
        return pd.Series([features(t, seen).tobytes() for t in texts])

    got = sample.select("doc_id", "label", indexes(F.col("text").cast("binary")).alias("found")).toPandas().sort_values("doc_id")
    rows = [np.frombuffer(x, np.int32) for x in got["found"]]
    y = got["label"].to_numpy()
    del got
    if not 0 < y.sum() < len(y):
        return Model(np.zeros(DIMS), np.zeros(DIMS), 0.0, 1.0, math.log(sizes[1] / sizes[0]))
    weight, bias = descend(rows, y, ratio)
    # margins of rows that a fold's model hasn't seen, weighted as the classes stand in all training rows
    folds, margins = np.arange(len(y)) % 3, np.zeros(len(y))
    for k in range(3):
        inside = np.flatnonzero(folds != k)
        if 0 < y[inside].sum() < len(inside):
            w, b = descend([rows[i] for i in inside], y[inside], ratio)
            part = Model(ratio, w, b, 1.0, 0.0)
            for i in np.flatnonzero(folds == k):
                margins[i] = part.margin(rows[i])
    stands = np.where(y > 0, sizes[1] / max(1, y.sum()), sizes[0] / max(1, (1 - y).sum()))
    slope, shift = calibrate(margins, y, stands * len(y) / stands.sum())
    return Model(ratio, weight, bias, slope, shift)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text as a new column; null and empty texts have a score too."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # arrays of DIMS numbers: a fixed size

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        seen, fitted = np.zeros(DIMS, bool), shared.value
        return pd.Series([fitted.score(features(t, seen)) for t in texts], dtype="float64")

    return docs.withColumn(name, run(F.col("text").cast("binary")))
