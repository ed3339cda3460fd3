"""The binned training table that all histogram learners share.

Bin edges are quantiles of a mergeable sketch, one aggregate over all rows
(``percentile_approx``: rank error of at most ``1 / ACCURACY`` of the rows). Every
feature has at most 254 edges, so 255 bins, and one more for missing values: a
row is one byte a feature. The table is written once and read by every learner.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.rdd import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

BINS = 255
MISSING = 255
ACCURACY = 10_000
BLOCK_ROWS = 65_536
MOST_ROWS = 50_000          # of a task that holds its rows' values
# of a task that scans blocks of bytes: a scan is short beside the start of a task, and a task too many a core costs a second wave
FEW_ROWS, SCANNED_ROWS = 32_768, 262_144


@dataclass
class Binned:
    """``table`` is ``(label, weight, bins)``; value ``x`` of feature ``f`` has bin ``count(edges[f] < x)``."""
    table: DataFrame
    edges: list[np.ndarray]

    @property
    def offsets(self) -> np.ndarray:
        """Where each feature's bins begin in a histogram of all of them; the last entry is the total."""
        return np.concatenate([[0], np.cumsum([len(e) + 2 for e in self.edges])]).astype(np.int64)


def quantile_edges(data: DataFrame, bins: int = BINS) -> list[np.ndarray]:
    """At most ``bins - 1`` edges a feature: distinct quantiles below the maximum (NaN left out)."""
    if not 2 <= bins <= BINS:
        raise ValueError(f"between 2 and {BINS} bins")
    x = data.select(vector_to_array("features").alias("x"))
    width = x.select(F.size("x")).first()
    if width is None:
        raise ValueError("no training rows")
    ranks = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    known = [F.when(~F.isnan(F.col("x")[i]), F.col("x")[i]) for i in range(width[0])]
    found = x.agg(*[F.percentile_approx(c, ranks, ACCURACY) for c in known], *[F.max(c) for c in known]).first()
    quantiles, highest = found[:width[0]], found[width[0]:]
    return [np.unique([v for v in q or [] if v < top]).astype(float) for q, top in zip(quantiles, highest)]


def bin_codes(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for f, e in enumerate(edges):
        out[:, f] = np.searchsorted(e, x[:, f], side="left")
        out[np.isnan(x[:, f]), f] = MISSING
    return out


def binned(data: DataFrame, bins: int = BINS) -> Binned:
    """``(label, features[, weight])`` -> the written table of bytes; without ``weight`` every row counts one."""
    edges = quantile_edges(data, bins)
    weight = F.col("weight").cast("double") if "weight" in data.columns else F.lit(1.0)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                codes = bin_codes(np.stack(part["x"].to_numpy()), edges)
                yield pd.DataFrame({"label": part["label"], "weight": part["weight"], "bins": [r.tobytes() for r in codes]})

    rows = data.select(F.col("label").cast("double").alias("label"), weight.alias("weight"), vector_to_array("features").alias("x"))
    return Binned(written(rows.mapInPandas(run, "label double, weight double, bins binary")), edges)


def blocks(table: DataFrame, class_weights: tuple[float, float] = (1.0, 1.0)) -> RDD:
    """``(number, bins, label, weight)`` arrays of up to ``BLOCK_ROWS`` rows, kept by the executors; a row's weight counts times that of its class.

    A lost block is read again from the written table. Histograms are sums of one array a
    block, which DataFrame aggregates would take apart into a row for each bin.
    """
    def run(part: int, rows: Iterator) -> Iterator[tuple]:
        number, held = part << 20, []

        def block() -> tuple:
            codes = np.frombuffer(b"".join(r[2] for r in held), np.uint8).reshape(len(held), -1)
            label = np.array([r[0] for r in held])
            return number, codes, label, np.array([r[1] for r in held]) * np.where(label > 0, class_weights[1], class_weights[0])

        for row in rows:
            held.append(row)
            if len(held) == BLOCK_ROWS:
                yield block()
                number, held = number + 1, []
        if held:
            yield block()

    return spread(table.select("label", "weight", "bins"), FEW_ROWS, SCANNED_ROWS).rdd.mapPartitionsWithIndex(run).persist()


def spread(table: DataFrame, few: int, most: int) -> DataFrame:
    """A table that is scanned again and again, in even tasks: as many as cores, but none of less than about ``few`` rows or more than ``most``."""
    n = table.count()
    tasks = max(1, math.ceil(n / most), min(table.sparkSession.sparkContext.defaultParallelism, math.ceil(n / few)))
    return table.repartition(tasks) if tasks > 1 else table.coalesce(1)
