"""Second-order gradient boosting and boosted stumps over the binned table (M3, M4, M5, M7, M8).

One pass over the blocks gives the gradient and hessian histograms of all open
nodes at once (one distributed sum of arrays); splits are found from those sums
on the driver, which holds at most ``leaves x bins`` numbers. Only the smaller child
of a split is counted, its sibling is the difference to the parent. Three
ways to grow a tree:

* ``level``: every node of a level is split,
* ``leaf``: best first; the number of leaves bounds the tree, not its depth,
* ``symmetric``: one split for all nodes of a level, by the sum of their gains.

Margins are part of the blocks: a tree makes new blocks from the old ones, and
every ``CUT`` trees they are written to the checkpoint folder, so lineage stays
short and lost blocks are computed again. Up to ``WAITING`` trees that took one pass each are
made up for in the passes themselves, which costs less than new blocks.

Successive trees often begin with the same splits, so the pass for a root also counts what several
of the last trees went on to ask for (``OFTEN`` of ``LATEST``). A tree that grows like them takes one pass,
whatever its depth; any other node is counted by a pass of its own.

A table of no more rows than a task takes
(``MOST_ROWS``) needs no job for each pass: its one task sums its blocks and grows
``TREES_A_JOB`` trees a job by the same code, starting from the trees there are.
"""
from __future__ import annotations

import copy
import heapq
import json
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.rdd import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .binning import BINS, MISSING, MOST_ROWS, Binned, binned, blocks

CUT = 25
TREES_A_JOB = 50
LEAST_GAIN = 1e-12
LATEST, OFTEN = 16, 3
WAITING = 5


@dataclass
class Tree:
    """Nodes in arrays; ``feature`` -1 is a leaf. Bins up to ``bin`` go left, missing ones where ``lost`` says."""
    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    lost: list[bool] = field(default_factory=lambda: [False])   # missing values go left
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bin_: int, threshold: float, lost: bool) -> tuple[int, int]:
        pair = len(self.feature), len(self.feature) + 1
        for name, empty in (("feature", -1), ("bin", 0), ("threshold", 0.0), ("lost", False), ("left", 0), ("right", 0), ("value", 0.0)):
            getattr(self, name).extend([empty, empty])
        self.feature[node], self.bin[node], self.threshold[node], self.lost[node] = feature, bin_, threshold, lost
        self.left[node], self.right[node] = pair
        return pair

    def route(self, x: np.ndarray, bins: bool, at: np.ndarray | None = None) -> np.ndarray:
        """The leaf of every row of bin codes or of raw values, from the root or from the nodes ``at``."""
        feature, left, right = np.array(self.feature), np.array(self.left), np.array(self.right)
        limit, lost = np.array(self.bin if bins else self.threshold), np.array(self.lost)
        at = np.zeros(len(x), np.int32) if at is None else at
        open_ = np.flatnonzero(feature[at] >= 0)
        while len(open_):
            node = at[open_]
            v = x[open_, feature[node]]
            goes_left = np.where(v == MISSING if bins else np.isnan(v), lost[node], v <= limit[node])
            at[open_] = np.where(goes_left, left[node], right[node])
            open_ = open_[feature[at[open_]] >= 0]
        return at


@dataclass
class Settings:
    rounds: int
    learning_rate: float
    growth: str = "level"              # level | leaf | symmetric
    max_depth: int | None = None
    max_leaves: int | None = None
    l2: float = 0.0
    least_hessian: float = 0.0         # of a child
    least_rows: int = 1                # of a child
    row_share: float = 1.0             # of the rows, drawn for each tree
    feature_share: float = 1.0         # of the features, drawn for each tree
    from_average: bool = True          # start from the log odds of the mean label
    seed: int = 42

    def __post_init__(self):
        if self.growth not in ("level", "leaf", "symmetric") or (self.growth != "leaf" and not self.max_depth) or (
                self.growth == "leaf" and not self.max_leaves):
            raise ValueError("level and symmetric growth need max_depth, leaf growth needs max_leaves")


def sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -700, 700)))


def histogram(codes: np.ndarray, node: np.ndarray, stats: list[np.ndarray], features: np.ndarray, offsets: np.ndarray, nodes: int) -> np.ndarray:
    """Sums of ``stats`` for each (node, feature, bin); rows with a negative node are left out."""
    rows = np.flatnonzero(node >= 0)
    place, stats = node[rows].astype(np.int64), [s[rows] for s in stats]
    out = np.zeros((nodes, len(stats), int(offsets[-1])))
    for f in features:
        begin, end = int(offsets[f]), int(offsets[f + 1])
        size, column = end - begin, codes[rows, f]
        at = place * size + np.where(column == MISSING, size - 1, column)
        for k, s in enumerate(stats):
            out[:, k, begin:end] = np.bincount(at, s, nodes * size).reshape(nodes, size)
    return out


class Layout:
    """Where the bins of the drawn features lie in a histogram, for all splits at once."""

    def __init__(self, offsets: np.ndarray, features: np.ndarray):
        sizes = np.diff(offsets)
        self.offsets, self.features = offsets, features
        self.feature = np.repeat(np.arange(len(sizes)), sizes)
        self.start = np.repeat(offsets[:-1], sizes)
        self.missing = np.repeat(offsets[1:] - 1, sizes)
        self.bin = np.arange(offsets[-1]) - self.start
        # a split stands after every bin but the last; the last column is for missing values
        self.possible = (self.bin < np.repeat(sizes - 2, sizes)) & np.isin(self.feature, features)
        self.any = slice(int(offsets[features[0]]), int(offsets[features[0] + 1]))   # one feature's bins hold all rows

    def gains(self, h: np.ndarray, s: Settings) -> np.ndarray:
        """Gains ``(2, bins)`` of all splits of one node, missing values right and left; -inf where a child is too small."""
        run = np.concatenate([np.zeros((3, 1)), h.cumsum(axis=1)], axis=1)
        left = run[:, 1:] - run[:, self.start]
        whole = h[:, self.any].sum(axis=1, keepdims=True)
        out = []
        for lost in (0, 1):
            l = left + lost * h[:, self.missing]
            r = whole - l
            fit = self.possible & (np.minimum(l[2], r[2]) > max(s.least_rows, 1) - 0.5) & (np.minimum(l[1], r[1]) >= s.least_hessian)
            a, b = l[1] + s.l2, r[1] + s.l2
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = l[0] ** 2 / a + r[0] ** 2 / b - whole[0] ** 2 / (whole[1] + s.l2)
                # the same without the difference of large sums: its rounding grows with the rows and
                # passes for a gain where all rows have one gradient
                sure = a * b / (a + b) * (l[0] / a - r[0] / b) ** 2 - s.l2 * whole[0] ** 2 / ((a + b) * (whole[1] + s.l2))
            out.append(np.where(fit & np.isfinite(gain) & ((sure > LEAST_GAIN) | (gain <= LEAST_GAIN)), gain, -np.inf))
        return np.stack(out)

    def best(self, gains: np.ndarray) -> tuple | None:
        """``(gain, feature, bin, missing left)``; ties: first feature, first bin, missing right."""
        at = int(gains.max(axis=0).argmax())
        lost = bool(gains[1, at] > gains[0, at])
        gain = float(gains[int(lost), at])
        return (gain, int(self.feature[at]), int(self.bin[at]), lost) if gain > LEAST_GAIN else None


def summed(rdd: RDD, run: Callable) -> list:
    """Element-wise sums of what ``run`` gives for each block."""
    def part(items: Iterator[tuple]) -> Iterator[list]:
        total = None
        for item in items:
            got = run(*item)
            total = got if total is None else [a + b for a, b in zip(total, got)]
        if total is not None:
            yield total

    # a second stage pays only for many tasks
    return rdd.mapPartitions(part).treeReduce(lambda a, b: [x + y for x, y in zip(a, b)], depth=1 if rdd.getNumPartitions() <= 16 else 2)


class Rows:
    """A block of rows with their margins and, while a task grows a tree, their gradients and places in it."""

    def __init__(self, block: tuple, start: float):
        self.number, codes, self.label, self.weight = block
        self.codes, self.margin = np.asfortranarray(codes), np.full(len(codes), start)

    def move(self, tree: Tree) -> None:
        self.margin += np.array(tree.value)[tree.route(self.codes, True)]

    def loss(self) -> list[float]:
        """The sums of weighted losses and of weights."""
        p = sigmoid(self.margin)
        return [-(self.weight * np.log(np.clip(np.where(self.label > 0, p, 1 - p), 1e-15, 1))).sum(), self.weight.sum()]

    def begin(self, s: Settings, number: int) -> None:
        p, n = sigmoid(self.margin), len(self.margin)
        self.stats, self.at = [self.weight * (p - self.label), self.weight * p * (1 - p), np.ones(n)], np.zeros(n, np.int32)
        self.drawn = np.random.default_rng([s.seed, number, self.number]).random(n) < s.row_share if s.row_share < 1 else None

    def places(self, tree: Tree, place: np.ndarray) -> np.ndarray:
        """What ``place`` says of each row's leaf, for a tree or what it has grown to since."""
        self.at = tree.route(self.codes, True, self.at)
        at = place[self.at]
        return at if self.drawn is None else np.where(self.drawn, at, -1)

    def count(self, at: np.ndarray, features: np.ndarray, offsets: np.ndarray, nodes: int) -> np.ndarray:
        return histogram(self.codes, at, self.stats, features, offsets, nodes)


class Grower:
    """One tree: asks for histograms of a wave of nodes and splits them by the settings.

    ``counted(tree, place, nodes)`` gives the histograms of ``nodes`` leaves, numbered by ``place``.
    """

    MOST = 1 << 21     # numbers that one pass sums

    def __init__(self, counted: Callable, offsets: np.ndarray, edges: list[np.ndarray], s: Settings, features: np.ndarray):
        self.counted, self.offsets, self.edges, self.s = counted, offsets, edges, s
        self.layout = Layout(offsets, features)
        self.tree, self.hists, self.sums, self.depth = Tree(), {}, {}, {0: 0}

    def count(self, nodes: list[int]) -> list[np.ndarray]:
        """Histograms of some leaves of the tree, as a rule from one pass."""
        most = max(1, self.MOST // (3 * int(self.offsets[-1])))
        if len(nodes) > most:
            return self.count(nodes[:most]) + self.count(nodes[most:])
        place = np.full(len(self.tree.feature), -1)
        place[nodes] = np.arange(len(nodes))
        return list(self.counted(self.tree, place, len(nodes)))

    def hold(self, node: int, h: np.ndarray) -> None:
        self.hists[node] = h
        self.sums[node] = h[:, self.layout.any].sum(axis=1)

    def open(self, pairs: list[tuple[int, int, int]]) -> None:
        """Histograms of the children of split nodes: the smaller child is counted, the other is the rest of its parent.

        A child that no split could divide gets none; if neither could be divided, the pair isn't counted.
        """
        pairs = [p for p in pairs if any(self.divisible(c) for c in p[1:])]
        if not pairs:
            return
        counted = [(n, *sorted((l, r), key=lambda c: self.sums[c][2])) for n, l, r in pairs]
        for (node, small, large), h in zip(counted, self.count([c[1] for c in counted])):
            self.hists[small], self.hists[large] = h, self.hists.pop(node) - h

    def divisible(self, node: int) -> bool:
        g, h, n = self.sums[node]
        return n >= 2 * max(self.s.least_rows, 1) and h >= 2 * self.s.least_hessian and (
            self.s.max_depth is None or self.depth[node] < self.s.max_depth)

    def apply(self, node: int, split: tuple) -> tuple[int, int, int]:
        """Splits a node; the sums of its children follow from its histogram."""
        _, f, b, lost = split
        left, right = self.tree.split(node, f, b, float(self.edges[f][b]), lost)
        bins = self.hists[node][:, self.offsets[f]:self.offsets[f + 1]]
        self.sums[left] = bins[:, :b + 1].sum(axis=1) + (bins[:, -1] if lost else 0)
        self.sums[right] = self.sums[node] - self.sums[left]
        self.depth[left] = self.depth[right] = self.depth[node] + 1
        return node, left, right

    def grown(self) -> Tree:
        self.hold(0, self.count([0])[0])
        {"level": self.by_level, "leaf": self.by_leaf, "symmetric": self.symmetric}[self.s.growth]()
        for node, f in enumerate(self.tree.feature):
            if f < 0:
                g, h, _ = self.sums[node]
                self.tree.value[node] = float(-self.s.learning_rate * g / (h + self.s.l2)) if h + self.s.l2 > 1e-12 else 0.0
        return self.tree

    def gains(self, node: int) -> np.ndarray | None:
        return self.layout.gains(self.hists[node], self.s) if node in self.hists else None

    def best(self, node: int) -> tuple | None:
        gains = self.gains(node)
        return None if gains is None else self.layout.best(gains)

    def by_level(self) -> None:
        level = [0]
        while pairs := [self.apply(node, split) for node in level if (split := self.best(node))]:
            self.open(pairs)
            level = [child for _, *children in pairs for child in children]

    def symmetric(self) -> None:
        level = [0]
        while known := [gains for n in level if (gains := self.gains(n)) is not None]:
            # a node that the split would leave without rows on a side adds nothing
            split = self.layout.best(sum(np.maximum(g, 0) for g in known))
            if not split:
                return
            pairs = [self.apply(node, split) for node in level if node in self.hists]
            self.open(pairs)
            level = [child for _, *children in pairs for child in children]

    def by_leaf(self) -> None:
        """Best first. A pass opens the children of every waiting leaf, so there are about as many passes as the tree is deep, not as it has leaves.

        Splits are made ahead in a tree of their own; only those taken from the queue enter the result.
        """
        result, order, queue, opened, same = Tree(), 0, [], {}, {0: 0}      # same: node ahead -> node of the result

        def wait(node: int) -> None:
            nonlocal order
            if split := self.best(node):
                heapq.heappush(queue, (-split[0], order, node, split))
                order += 1

        wait(0)
        leaves = 1
        while queue and leaves < self.s.max_leaves:
            _, _, node, split = queue[0]
            if node not in opened:
                pairs = [self.apply(n, sp) for _, _, n, sp in sorted(queue)[:self.s.max_leaves - leaves] if n not in opened]
                self.open(pairs)
                opened.update((n, children) for n, *children in pairs)
            heapq.heappop(queue)
            _, f, b, lost = split
            for child, into in zip(opened[node], result.split(same[node], f, b, float(self.edges[f][b]), lost)):
                same[child] = into
                wait(child)
            leaves += 1
        self.sums = {into: self.sums[n] for n, into in same.items()}
        self.tree = result


class Booster:
    """Boosted trees for log loss; ``fit`` takes ``(label, features[, weight])`` or a table binned before."""

    def __init__(self, settings: Settings, bins: int = BINS):
        self.settings, self.bins = settings, bins

    def fit(self, data: DataFrame | Binned, class_weights: tuple[float, float] = (1.0, 1.0)) -> "BoostedTrees":
        s = self.settings
        data = data if isinstance(data, Binned) else binned(data, self.bins)
        ensure_checkpoint_dir(data.table.sparkSession)
        base = blocks(data.table, class_weights)
        total, positive, rows = summed(base, lambda _, codes, label, weight: [weight.sum(), (weight * label).sum(), len(label)])
        start = 0.0
        if s.from_average and 0 < positive < total:
            start = float(np.log(positive / (total - positive)))
        every = np.arange(len(data.edges))
        some, draw = max(1, round(s.feature_share * len(every))), np.random.default_rng(s.seed)
        drawn = [every if some == len(every) else np.sort(draw.choice(every, some, replace=False)) for _ in range(s.rounds)]
        if rows <= MOST_ROWS:
            trees, losses = [], []
            together = base.coalesce(1)
            while len(trees) < s.rounds:
                (more, after), = together.mapPartitions(
                    _grown(s, data.offsets, data.edges, trees, drawn[len(trees):len(trees) + TREES_A_JOB], start)).collect()
                trees, losses = trees + more, losses + after
            base.unpersist()
        else:
            trees, losses = _by_passes(base, data, s, drawn, start)
        return BoostedTrees(trees, start, losses, asdict(s))


def _by_passes(base: RDD, data: Binned, s: Settings, drawn: list[np.ndarray], start: float) -> tuple[list[Tree], list[float]]:
    """The trees of a table of many blocks, one job for each pass; losses are summed with the histograms of the next tree's root."""
    state = base.map(lambda b: (Rows(b, start),)).persist()
    trees, losses, kept, latest, waiting = [], [], [base], [], []
    for number, features in enumerate(drawn):
        passes = _Passes(state, waiting, data.offsets, s, number, features, _often(latest, Grower.MOST // (3 * int(data.offsets[-1]))))
        tree = Grower(passes, data.offsets, data.edges, s, features).grown()
        losses.append(passes.loss)
        for old in kept:       # the new blocks are there now
            old.unpersist()
        kept = []
        trees.append(tree)
        latest, waiting = [passes.calls, *latest][:LATEST], [*waiting, tree]
        if passes.jobs > 1 or len(waiting) >= WAITING or (number + 1) % CUT == 0:
            kept, state, waiting = [state], state.map(_moved(waiting)).persist(), []
        if (number + 1) % CUT == 0:
            state.checkpoint()
    loss, weight = summed(state.map(_moved(waiting)), lambda block: block.loss())
    for old in (*kept, state):
        old.unpersist()
    return trees, [*losses[1:], float(loss / weight)]


class _Passes:
    """Counts the nodes of one tree by jobs over all blocks; ``loss`` is that before the tree.

    The root's job also counts the calls in ``guess``. A call that comes as guessed is answered from there, any
    other by a job of its own; blocks count it in the same way, so the sums are the same.
    """

    def __init__(self, state: RDD, waiting: list[Tree], offsets: np.ndarray, s: Settings, number: int, features: np.ndarray, guess: list[dict]):
        self.state, self.what, self.loss = state, (waiting, offsets, s, number, features), 0.0
        self.guess, self.calls, self.known, self.jobs = guess, {}, {}, 0

    def __call__(self, tree: Tree, place: np.ndarray, nodes: int) -> np.ndarray:
        key = (*map(tuple, (tree.feature, tree.bin, tree.lost, tree.left)), place.tobytes())
        first, self.calls[key] = not self.calls, (copy.deepcopy(tree), place, nodes)     # the tree goes on growing
        if key not in self.known:
            # those of the guess that begin with the root hold its call
            parts = self.guess if first and any(key in part for part in self.guess) else [{key: self.calls[key]}]
            self.known.update(zip([k for part in parts for k in part], self.job([list(part.values()) for part in parts])))
        return self.known[key]

    def job(self, parts: list[list[tuple]]) -> list[np.ndarray]:
        """The histograms of the calls of some trees, each tree's in the order of its growth."""
        waiting, offsets, s, number, features = self.what
        self.jobs += 1

        def run(block: Rows) -> list:
            for tree in waiting:
                block.move(tree)
            block.begin(s, number)
            loss, done, out = block.loss(), [], []
            for calls in parts:
                block.at = np.zeros(len(block.margin), np.int32)
                for tree, place, nodes in calls:
                    at = block.places(tree, place)
                    # other splits may part the rows in the same way
                    h = next((h for other, h in done if h.shape[0] == nodes and np.array_equal(other, at)), None)
                    if h is None:
                        done.append((at, h := block.count(at, features, offsets, nodes)))
                    out.append(h)
            return [*out, *loss]

        *hists, loss, weight = summed(self.state, run)
        self.loss = float(loss / weight)
        return hists


def _often(latest: list[dict], most: int) -> list[dict]:
    """The calls that at least ``OFTEN`` of the ``latest`` trees made, the last tree's first, of ``most`` nodes in all; each once."""
    times, out, taken = Counter(key for calls in latest for key in calls), [], set()
    for calls in latest:
        part = {}
        for key, call in calls.items():
            if times[key] >= OFTEN and key not in taken and call[2] <= most:
                part[key], most = call, most - call[2]
                taken.add(key)
        if part:
            out.append(part)
    return out


def _moved(trees: list[Tree]) -> Callable:
    def run(item: tuple) -> tuple:
        for tree in trees:
            item[0].move(tree)
        return item
    return run


def _grown(s: Settings, offsets: np.ndarray, edges: list[np.ndarray], known: list[Tree], drawn: list[np.ndarray], start: float) -> Callable:
    """All blocks of a table of one task -> the trees after the ``known`` ones, with the loss after each."""
    def run(blocks_: Iterator[tuple]) -> Iterator[tuple]:
        rows, trees, losses = [Rows(b, start) for b in blocks_], [], []
        for tree in known:
            for block in rows:
                block.move(tree)
        for number, features in enumerate(drawn, len(known)):
            for block in rows:
                block.begin(s, number)
            trees.append(Grower(lambda tree, place, nodes: sum(b.count(b.places(tree, place), features, offsets, nodes) for b in rows),
                                offsets, edges, s, features).grown())
            for block in rows:
                block.move(trees[-1])
            loss, weight = np.sum([b.loss() for b in rows], axis=0)
            losses.append(float(loss / weight))
        yield trees, losses
    return run


@dataclass
class BoostedTrees:
    trees: list[Tree]
    start: float
    losses: list[float]         # weighted log loss on the training rows after each tree
    settings: dict

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for tree in self.trees:
            out += np.array(tree.value)[tree.route(x, False)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``rawPrediction``, ``probability`` and ``prediction``; trees are applied to whole Arrow batches."""
        model = self

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            return pd.Series(model.margins(np.stack(x.to_numpy())) if len(x) else [], dtype="float64")

        m = margin(vector_to_array("features"))
        out = df.withColumn("rawPrediction", m)
        p = 1 / (1 + F.exp(-F.col("rawPrediction")))
        return (out.withColumn("probability", array_to_vector(F.array(1 - p, p)))
                .withColumn("prediction", (F.col("rawPrediction") > 0).cast("double"))
                .withColumn("rawPrediction", array_to_vector(F.array(-F.col("rawPrediction"), F.col("rawPrediction")))))

    def to_json(self) -> list[str]:
        """What is not a tree, then each tree."""
        return [json.dumps({"start": self.start, "losses": self.losses, "settings": self.settings}), *(json.dumps(asdict(t)) for t in self.trees)]

    @staticmethod
    def from_json(parts: list[str]) -> "BoostedTrees":
        return BoostedTrees([Tree(**json.loads(p)) for p in parts[1:]], **json.loads(parts[0]))


# ------------------------------------------------------------------ AdaBoost
def best_stump(h: np.ndarray, offsets: np.ndarray, edges: list[np.ndarray]) -> tuple[tuple, float, float]:
    """``((feature, threshold, left class, right class), error, total)`` by weighted Gini from class sums ``(2, bins)``.

    Missing values go right. Ties: first feature, first bin; without any gain one class everywhere.
    """
    first = h[:, offsets[0]:offsets[1]].sum(axis=1)
    total, best = first.sum(), None
    gini = lambda a, b: np.divide(2 * a * b, a + b, out=np.zeros_like(a), where=a + b > 0)
    whole = float(gini(first[:1], first[1:])[0])
    for f, e in enumerate(edges):
        sums = h[:, offsets[f]:offsets[f + 1]]
        left = sums[:, :-1].cumsum(axis=1)[:, :-1]
        right = first[:, None] - left
        gain = whole - gini(left[0], left[1]) - gini(right[0], right[1])
        if len(gain) and gain.max() > (best[0] if best else LEAST_GAIN * max(total, 1e-300)):
            b = int(gain.argmax())
            best = (float(gain[b]), f, b, left[:, b], right[:, b])
    if best is None:
        c = float(first[1] > first[0])
        return (0, float("inf"), c, c), float(first.min()), float(total)
    _, f, b, left, right = best
    sides = [float(side[1] > side[0]) for side in (left, right)]
    return (f, float(edges[f][b]), *sides), float(left.min() + right.min()), float(total)


def boosted_stumps(data: Binned, rounds: int, learning_rate: float, class_weights: tuple[float, float] = (1.0, 1.0)) -> list[tuple[tuple, float]]:
    """Discrete AdaBoost: ``((feature, threshold, left, right), alpha)`` of each round.

    The weights are part of the blocks; one weighted histogram aggregate a round gives both the stump and its error.
    """
    ensure_checkpoint_dir(data.table.sparkSession)
    offsets, features = data.offsets, np.arange(len(data.edges))
    base = blocks(data.table, class_weights)
    state = base.map(lambda b: (*b, b[3])).persist()
    stumps, kept = [], [base]
    for number in range(rounds):
        def run(_, codes, label, weight, mass):
            zero = np.zeros(len(label), np.int64)
            return [histogram(codes, zero, [mass * (label <= 0), mass * (label > 0)], features, offsets, 1)[0]]

        stump, miss, total = best_stump(summed(state, run)[0], offsets, data.edges)
        for old in kept:
            old.unpersist()
        kept = [state]
        error = miss / total if total else 0.0
        if error <= 0 or error >= 0.5:
            if error <= 0 or not stumps:
                stumps.append((stump, 1.0))
            break
        alpha = learning_rate * float(np.log((1 - error) / error))
        stumps.append((stump, alpha))
        state = state.map(_reweighted(stump, alpha, data.edges, total * (1 + (np.exp(alpha) - 1) * error))).persist()
        if (number + 1) % CUT == 0:
            state.checkpoint()
    for old in (*kept, state):
        old.unpersist()
    return stumps


def _reweighted(stump: tuple, alpha: float, edges: list[np.ndarray], total: float) -> Callable:
    f, threshold, left, right = stump
    last = int(np.searchsorted(edges[f], threshold, side="left")) if np.isfinite(threshold) else MISSING

    def run(b: tuple) -> tuple:
        said = np.where(b[1][:, f] <= last, left, right)
        return (*b[:4], b[4] * np.where(said != (b[2] > 0), np.exp(alpha), 1.0) / total)
    return run
