"""Coalition attribution for any model on given rows (E5).

A row's attribution is the weighted least squares fit of what the model says when
only some of the row's features are known and the others come from background rows.
All rows are explained by the same coalitions, so the normal equations are
solved once; each row then needs the mean score of each coalition over the background,
which is one aggregate of scored rows. With all ``2 ** features - 2`` coalitions the
result are the exact Shapley values.
"""
from __future__ import annotations

import math
from collections.abc import Callable
from itertools import combinations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

BACKGROUND_ROWS = 100
SCORED_ROWS_PER_TASK = 200_000


def coalitions(width: int, most: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Masks ``(n, width)`` and their kernel weights, neither empty nor whole.

    The smallest and largest coalitions weigh most: whole sizes are taken as long as ``most``
    has room for them; the others are drawn by weight, each with its complement.
    """
    share = {k: (width - 1) / (k * (width - k)) for k in range(1, width)}      # of all coalitions of k features
    masks: dict[tuple, float] = {}
    left, sizes = most, list(range(1, width // 2 + 1))
    while sizes:
        k = sizes[0]
        both = {k, width - k}
        number = sum(math.comb(width, j) for j in both)
        if number > left:
            break
        for j in both:
            for some in combinations(range(width), j):
                masks[some] = share[j] / math.comb(width, j)
        left -= number
        sizes.pop(0)
    if sizes and left >= 2:
        draw = np.random.default_rng(seed)
        rest = np.array([share[k] + (share[width - k] if 2 * k != width else 0) for k in sizes])
        drawn: dict[tuple, int] = {}
        for k in draw.choice(sizes, left // 2, p=rest / rest.sum()):
            some = np.sort(draw.choice(width, k, replace=False))
            for part in (some, np.setdiff1d(np.arange(width), some)):
                drawn[tuple(part.tolist())] = drawn.get(tuple(part.tolist()), 0) + 1
        for some, n in drawn.items():
            masks[some] = rest.sum() * n / sum(drawn.values())
    out = np.zeros((len(masks), width), bool)
    for row, some in zip(out, masks):
        row[list(some)] = True
    return out, np.array(list(masks.values()))


def solver(masks: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``(width - 1, n)``: all attributions but the last from the coalitions' scores; the last follows from their sum."""
    z = masks[:, :-1].astype(float) - masks[:, -1:]
    gram = z.T @ (weights[:, None] * z)
    return np.linalg.pinv(gram) @ (z * weights[:, None]).T


def coalition_attribution(rows: DataFrame, background: DataFrame, score: Callable[[DataFrame], DataFrame], key: str, names: list[str],
                          most: int = 512, seed: int = 42) -> DataFrame:
    """``(row_id, feature, value, attribution)`` of every row of ``rows``.

    ``rows`` has ``key`` and ``features``; ``background`` has ``features``, a bounded sample (``BACKGROUND_ROWS``
    by default in the queries). ``score`` adds a column ``value`` to rows with ``features``.
    A row's attributions sum to its score less the mean score of the background.
    """
    width = len(names)
    if width < 2:
        raise ValueError("at least two features")
    masks, weights = coalitions(width, most, seed)
    known = np.vstack([masks, np.zeros(width, bool), np.ones(width, bool)])     # the last two: the background, the row itself
    sample = [[float(v) for v in r[0]] for r in background.select(vector_to_array("features")).collect()]   # bounded by the caller
    if not sample:
        raise ValueError("the background has no rows")
    spark = rows.sparkSession
    given = written(rows.select(F.col(key).alias("row_id"), vector_to_array("features").alias("x")))
    tables = spark.createDataFrame([(known.tolist(), sample)], "masks array<array<boolean>>, sample array<array<double>>")
    tasks = max(1, math.ceil(given.count() * len(known) * len(sample) / SCORED_ROWS_PER_TASK))
    pairs = (given.repartition(tasks, "row_id").crossJoin(F.broadcast(tables))         # one row: all coalitions and the background
             .select("row_id", "x", "sample", F.posexplode("masks").alias("coalition", "mask"))
             .select("row_id", "coalition", "x", "mask", F.explode("sample").alias("other")))
    mixed = F.transform("x", lambda v, i: F.when(F.get("mask", i), v).otherwise(F.get("other", i)))
    scored = score(pairs.select("row_id", "coalition", array_to_vector(mixed).alias("features")))
    means = scored.groupBy("row_id", "coalition").agg(F.avg("value").alias("value"))
    # as many numbers a row as there are coalitions
    said = written(means.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("coalition", "value"))).alias("said"))
                   .select("row_id", F.col("said.value").alias("said")))
    n, solve = len(masks), solver(masks, weights)
    parts = spark.createDataFrame([(solve.tolist(), (solve @ masks[:, -1]).tolist(), solve.sum(axis=1).tolist())],
                                  "solve array<array<double>>, last array<double>, base array<double>")
    total = F.get("said", F.lit(n + 1)) - F.get("said", F.lit(n))
    first = F.transform("solve", lambda line, j: F.aggregate(F.zip_with(line, F.slice("said", 1, n), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
                        - F.get("said", F.lit(n)) * F.get("base", j) - total * F.get("last", j))
    fitted = said.crossJoin(F.broadcast(parts)).select("row_id", first.alias("first"), total.alias("total"))
    whole = F.concat("first", F.array(F.col("total") - F.aggregate("first", F.lit(0.0), lambda a, b: a + b)))
    label = F.array(*[F.lit(n_) for n_ in names])
    out = fitted.select("row_id", whole.alias("parts")).join(given, "row_id").select(
        "row_id", F.explode(F.arrays_zip(label.alias("feature"), F.col("x").alias("value"), F.col("parts").alias("attribution"))).alias("a"))
    return out.select("row_id", "a.feature", "a.value", "a.attribution")


def model_score(model, margin: bool = False) -> Callable[[DataFrame], DataFrame]:
    """What a fitted model says: the probability of class 1, or its margin."""
    from .score import class_scores

    def run(df: DataFrame) -> DataFrame:
        return class_scores(model.transform(df)).withColumn("value", F.col("margin") if margin else F.coalesce("p", "margin"))
    return run
