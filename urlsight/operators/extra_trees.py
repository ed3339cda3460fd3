"""Extremely randomised trees (M2): one random threshold for each of a node's drawn features.

All trees grow a level at a time. One pass over the blocks finds the smallest
and largest value of the drawn features in each open node, a threshold is drawn uniformly
between them, and one more pass counts the classes on both sides of every
threshold; the best by weighted Gini becomes the split. No two nodes share a
threshold, and every tree sees all rows. Features that are constant in a node
don't count as drawn; while all are, the next ones of its own order are tried.
"""
from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.rdd import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .binning import MOST_ROWS, spread

BLOCK_ROWS = 16_384
FEW_ROWS = 8_192    # of a task
CUT = 8             # levels after which the rows' places are written to the checkpoint folder
MOST = 1 << 22      # numbers that one pass brings to the driver


@dataclass
class RandomTree:
    """Nodes in arrays; ``feature`` -1 is a leaf; values up to the threshold go left; ``share`` is the weighted share of class 1."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def leaf(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        open_ = np.flatnonzero(self.feature[at] >= 0)
        while len(open_):
            node = at[open_]
            at[open_] = np.where(x[open_, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            open_ = open_[self.feature[at[open_]] >= 0]
        return at


@dataclass
class _Open:
    """A node that may be split: class sums (weight of 0, weight of 1, rows, rows of class 1) and how often features were drawn for it."""
    tree: int
    node: int
    sums: np.ndarray
    tried: int = 0


def _blocks(data: DataFrame) -> RDD:
    def run(rows: Iterator) -> Iterator[tuple]:
        held = []

        def block() -> tuple:
            return np.array([r[2] for r in held], float), np.array([r[0] for r in held]), np.array([r[1] for r in held])

        for row in rows:
            held.append(row)
            if len(held) == BLOCK_ROWS:
                yield block()
                held = []
        if held:
            yield block()

    weight = F.col("weight").cast("double") if "weight" in data.columns else F.lit(1.0)
    rows = data.select(F.col("label").cast("double"), weight, vector_to_array("features"))
    return spread(rows, FEW_ROWS, MOST_ROWS).rdd.mapPartitions(run)


def _combined(state: RDD, run: Callable, op: Callable) -> np.ndarray:
    def part(items: Iterator[tuple]) -> Iterator[np.ndarray]:
        total = None
        for item in items:
            got = run(*item)
            total = got if total is None else op(total, got)
        if total is not None:
            yield total

    return state.mapPartitions(part).treeReduce(op)


def drawn(seed: int, node: _Open, width: int, k: int) -> np.ndarray:
    """The next ``2 k`` features of the node's own random order."""
    order = np.random.default_rng([seed, node.tree, node.node]).permutation(width)
    return np.take(order, range(2 * k * node.tried, 2 * k * (node.tried + 1)), mode="clip")


def thresholds(seed: int, node: _Open, features: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For the first ``k`` features that vary in the node: their numbers (padded with -1) and one uniform threshold each."""
    vary = np.flatnonzero(low < high)
    vary = vary[np.sort(np.unique(features[vary], return_index=True)[1])][:k]
    at = np.random.default_rng([seed, node.tree, node.node, node.tried + 1]).uniform(low[vary], high[vary])
    at = np.where(at < high[vary], at, low[vary])
    out, cut = np.full(k, -1), np.zeros(k)
    out[:len(vary)], cut[:len(vary)] = features[vary], at
    return out, cut


def _gini(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(2 * a * b, a + b, out=np.zeros_like(a), where=a + b > 0)


class ExtraTrees:
    def __init__(self, weight_col: str | None, numTrees: int, minInstancesPerNode: int, maxDepth: int, seed: int = 42):
        self.weight_col, self.trees, self.least, self.depth, self.seed = weight_col, numTrees, minInstancesPerNode, maxDepth, seed

    def fit(self, data: DataFrame) -> "ExtraTreesModel":
        ensure_checkpoint_dir(data.sparkSession)
        data = data.withColumn("weight", F.col(self.weight_col)) if self.weight_col else data.drop("weight")
        trees = self.trees
        state = _blocks(data).map(lambda b: (*b, np.zeros((len(b[0]), trees), np.int32))).persist()
        first = _combined(state, lambda x, label, weight, at: np.array(
            [(weight * (label <= 0)).sum(), (weight * (label > 0)).sum(), len(label), (label > 0).sum(), x.shape[1]]), lambda a, b: np.append(a[:4] + b[:4], a[4]))
        width, k = int(first[4]), max(1, int(math.sqrt(first[4])))
        grown = [{"feature": [-1], "threshold": [0.0], "left": [0], "right": [0], "share": [first[1] / max(first[0] + first[1], 1e-300)]} for _ in range(trees)]
        level = [_Open(t, 0, first[:4]) for t in range(trees)]
        for depth in range(self.depth):
            level = [n for n in level if 0 < n.sums[3] < n.sums[2] and n.sums[2] >= 2 * self.least]
            if not level:
                break
            splits, after = [], []
            while level:     # again only for nodes all of whose drawn features were constant
                again, size = [], max(1, MOST // (4 * k))
                for i in range(0, len(level), size):
                    some, more = self.split(state, level[i:i + size], width, k)
                    splits += some
                    again += more
                level = again
            for n, feature, cut, left, right in splits:
                tree = grown[n.tree]
                pair = len(tree["feature"]), len(tree["feature"]) + 1
                tree["feature"][n.node], tree["threshold"][n.node], tree["left"][n.node], tree["right"][n.node] = feature, cut, *pair
                for child, sums in zip(pair, (left, right)):
                    for name, empty in (("feature", -1), ("threshold", 0.0), ("left", 0), ("right", 0), ("share", sums[1] / (sums[0] + sums[1]))):
                        tree[name].append(empty)
                    after.append(_Open(n.tree, child, sums))
            level = after
            moved = state.map(_moved(splits, grown)).persist()
            if depth % CUT == CUT - 1:
                moved.checkpoint()
            moved.count()
            state.unpersist()
            state = moved
        state.unpersist()
        return ExtraTreesModel([RandomTree(**{name: np.array(v) for name, v in t.items()}) for t in grown])

    def split(self, state: RDD, nodes: list[_Open], width: int, k: int) -> tuple[list[tuple], list[_Open]]:
        """``(node, feature, threshold, sums left, sums right)`` of those that a threshold divides, and the nodes to try again."""
        features = np.stack([drawn(self.seed, n, width, k) for n in nodes])
        spread = _combined(state, _spread(nodes, features), np.minimum)
        made = [thresholds(self.seed, n, f, s[:2 * k], -s[2 * k:], k) for n, f, s in zip(nodes, features, spread)]
        chosen, cuts = np.stack([m[0] for m in made]), np.stack([m[1] for m in made])
        sides = _combined(state, _sides(nodes, chosen, cuts), np.add)
        splits, again = [], []
        for n, f, cut, left in zip(nodes, chosen, cuts, sides):
            if f[0] < 0:
                n.tried += 1
                if 2 * k * n.tried < width:
                    again.append(n)
                continue
            right = n.sums - left
            fit = (f >= 0) & (left[:, 2] >= self.least) & (right[:, 2] >= self.least)
            if fit.any():
                impurity = np.where(fit, _gini(left[:, 0], left[:, 1]) + _gini(right[:, 0], right[:, 1]), np.inf)
                best = int(impurity.argmin())
                splits.append((n, int(f[best]), float(cut[best]), left[best], right[best]))
        return splits, again


def _places(nodes: list[_Open]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each tree its open nodes and their positions in ``nodes``."""
    by_tree: dict[int, list[tuple[int, int]]] = {}
    for i, n in enumerate(nodes):
        by_tree.setdefault(n.tree, []).append((n.node, i))
    return {t: tuple(np.array(sorted(v)).T) for t, v in by_tree.items()}


def _held(at: np.ndarray, nodes: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that lie in one of the sorted ``nodes``, in the order of those, with the nodes' positions."""
    found = np.minimum(np.searchsorted(nodes, at), len(nodes) - 1)
    rows = np.flatnonzero(nodes[found] == at)
    rows = rows[np.argsort(found[rows], kind="stable")]
    return rows, place[found[rows]]


def _spread(nodes: list[_Open], features: np.ndarray) -> Callable:
    places = _places(nodes)

    def run(x, label, weight, at):
        out = np.full((len(features), 2 * features.shape[1]), np.inf)
        for tree, (ids, place) in places.items():
            rows, into = _held(at[:, tree], ids, place)
            if len(rows):
                first = np.flatnonzero(np.diff(into, prepend=-1))
                values = x[rows[:, None], features[into]]
                out[into[first]] = np.minimum.reduceat(np.hstack([values, -values]), first)
        return out
    return run


def _sides(nodes: list[_Open], features: np.ndarray, cuts: np.ndarray) -> Callable:
    places = _places(nodes)

    def run(x, label, weight, at):
        out = np.zeros((*features.shape, 4))
        for tree, (ids, place) in places.items():
            rows, into = _held(at[:, tree], ids, place)
            if len(rows):
                first = np.flatnonzero(np.diff(into, prepend=-1))
                left = x[rows[:, None], features[into]] <= cuts[into]
                y, w = label[rows] > 0, weight[rows]
                each = np.stack([w * ~y, w * y, np.ones(len(y)), y], axis=1)
                out[into[first]] = np.add.reduceat(left[:, :, None] * each[:, None, :], first)
        return out
    return run


def _moved(splits: list[tuple], grown: list[dict]) -> Callable:
    by_tree: dict[int, list[tuple]] = {}
    for n, feature, cut, *_ in splits:
        by_tree.setdefault(n.tree, []).append((n.node, feature, cut, grown[n.tree]["left"][n.node], grown[n.tree]["right"][n.node]))
    tables = {t: tuple(np.array(c) for c in zip(*sorted(v))) for t, v in by_tree.items()}

    def run(b: tuple) -> tuple:
        x, label, weight, at = b
        at = at.copy()
        for tree, (nodes, feature, cut, left, right) in tables.items():
            found = np.minimum(np.searchsorted(nodes, at[:, tree]), len(nodes) - 1)
            rows = np.flatnonzero(nodes[found] == at[:, tree])
            i = found[rows]
            at[rows, tree] = np.where(x[rows, feature[i]] <= cut[i], left[i], right[i])
        return x, label, weight, at
    return run


@dataclass
class ExtraTreesModel:
    trees: list[RandomTree]

    def shares(self, x: np.ndarray) -> np.ndarray:
        return np.mean([t.share[t.leaf(x)] for t in self.trees], axis=0)

    def transform(self, df: DataFrame) -> DataFrame:
        """Mean of the trees' class shares as the forest's probability."""
        model = self

        @F.pandas_udf("double")
        def share(x: pd.Series) -> pd.Series:
            return pd.Series(model.shares(np.stack(x.to_numpy())) if len(x) else [], dtype="float64")

        out = df.withColumn("__share", share(vector_to_array("features")))
        p = F.col("__share")
        return out.withColumn("probability", array_to_vector(F.array(1 - p, p))).withColumn("prediction", (p > 0.5).cast("double")).drop("__share")

    def to_json(self) -> list[str]:
        return [json.dumps({name: values.tolist() for name, values in vars(t).items()}) for t in self.trees]

    @staticmethod
    def from_json(parts: list[str]) -> "ExtraTreesModel":
        return ExtraTreesModel([RandomTree(**{name: np.array(v) for name, v in json.loads(p).items()}) for p in parts])
