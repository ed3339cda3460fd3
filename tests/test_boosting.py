"""Histogram learners against brute-force searches over the same rows."""
import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from urlsight.operators import binning, boosting, encode, zoo
from urlsight.operators.boosting import Booster, Settings
from urlsight.operators.extra_trees import ExtraTrees

ROWS = 1000


def make(n=ROWS, seed=3, missing=0.0):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 40, n).astype(float), rng.normal(size=n).round(1), rng.integers(0, 2, n).astype(float), rng.gamma(2, 3, n).round()], axis=1)
    y = ((x[:, 0] > 17) ^ (x[:, 1] > 0.3) | (rng.random(n) < 0.1)).astype(float)
    w = np.where(y > 0, 1.5, 0.75)
    if missing:
        lost = rng.random(n) < missing
        x[lost, 1] = np.nan
        y[lost] = 1.0
    return x, y, w


def frame(spark, x, y, w, parts=3):
    rows = [(float(a), float(b), [float(v) for v in r]) for a, b, r in zip(y, w, x)]
    df = spark.createDataFrame(rows, "label double, weight double, x array<double>")
    return df.repartition(parts).select("label", "weight", array_to_vector("x").alias("features"))


class Plain:
    """One tree by trying every split of every node on the rows themselves."""

    def __init__(self, x, y, w, edges, s, margin):
        p = 1 / (1 + np.exp(-margin))
        self.x, self.g, self.h, self.edges, self.s = x, w * (p - y), w * p * (1 - p), edges, s

    def score(self, rows):
        return self.g[rows].sum() ** 2 / (self.h[rows].sum() + self.s.l2)

    def gain(self, rows, f, cut, lost):
        v = self.x[rows, f]
        left = np.where(np.isnan(v), lost, v <= cut)
        sides = rows[left], rows[~left]
        if min(map(len, sides)) < max(self.s.least_rows, 1) or min(self.h[r].sum() for r in sides) < self.s.least_hessian:
            return -math.inf, sides
        return sum(map(self.score, sides)) - self.score(rows), sides

    def best(self, rows):
        found = None
        for f, edges in enumerate(self.edges):
            for cut in edges:
                for lost in (False, True):
                    gain, sides = self.gain(rows, f, cut, lost)
                    if gain > max(1e-9, found[0] + 1e-9 if found else 0):
                        found = (gain, f, cut, sides)
        return found

    def value(self, rows):
        return -self.s.learning_rate * self.g[rows].sum() / (self.h[rows].sum() + self.s.l2)

    def level(self, rows, depth=0):
        found = self.best(rows) if depth < self.s.max_depth else None
        return {tuple(rows): self.value(rows)} if not found else self.level(found[3][0], depth + 1) | self.level(found[3][1], depth + 1)

    def leaf(self, rows):
        leaves, order = [rows], []
        while len(leaves) < self.s.max_leaves:
            options = [(b[0], -i, b) for i, r in enumerate(leaves) if (b := self.best(r))]
            if not options:
                break
            _, i, b = max(options, key=lambda o: o[0])
            order.append((b[1], float(b[2])))
            leaves[-i:-i + 1] = b[3]
        return {tuple(r): self.value(r) for r in leaves}, order

    def symmetric(self, rows):
        leaves = [rows]
        for _ in range(self.s.max_depth):
            best = None
            for f, edges in enumerate(self.edges):
                for cut in edges:
                    gains = [self.gain(r, f, cut, False) for r in leaves]
                    total = sum(max(g, 0) for g, _ in gains)
                    if total > max(1e-9, best[0] + 1e-9 if best else 0):
                        best = (total, f, cut)
            if not best:
                break
            v = self.x[:, best[1]] <= best[2]
            leaves = [side for r in leaves for side in (r[v[r]], r[~v[r]])]
        return {tuple(r): self.value(r) for r in leaves if len(r)}


def values(model, x):
    return model.margins(x) - model.start


def expect(leaves, n):
    out = np.zeros(n)
    for rows, v in leaves.items():
        out[list(rows)] = v
    return out


@pytest.fixture(scope="module")
def data(spark):
    x, y, w = make()
    return x, y, w, binning.binned(frame(spark, x, y, w))


def plain(data, s):
    x, y, w, b = data
    start = math.log((w * y).sum() / (w * (1 - y)).sum()) if s.from_average else 0.0
    return Plain(x, y, w, b.edges, s, np.full(len(y), start))


def test_edges_are_quantiles_within_the_stated_rank_error(spark):
    v = np.random.default_rng(1).normal(size=20_000)
    df = spark.createDataFrame([(float(i % 2), [float(a), 7.0, float(i % 3)]) for i, a in enumerate(v)], "label double, x array<double>").select(
        "label", array_to_vector("x").alias("features"))
    e = binning.quantile_edges(df)
    assert len(e[0]) == 254 and len(e[1]) == 0 and list(e[2]) == [0.0, 1.0]
    ranks = np.searchsorted(np.sort(v), e[0], side="right") / len(v)
    assert np.abs(ranks - np.arange(1, 255) / 255).max() <= 1 / binning.ACCURACY + 1 / len(v)


def test_no_cut_of_bins_to_the_rows(spark):
    df = spark.createDataFrame([(float(i % 2), [float(i)]) for i in range(200)], "label double, x array<double>").select("label", array_to_vector("x").alias("features"))
    assert len(binning.quantile_edges(df)[0]) == 199       # every distinct value but the last


def test_codes():
    got = binning.bin_codes(np.array([[1.0], [2.0], [2.5], [9.0], [np.nan]]), [np.array([1.0, 2.0])])
    assert got[:, 0].tolist() == [0, 1, 2, 2, binning.MISSING]


def test_level_growth_equals_brute_force(data):
    s = Settings(1, 0.3, "level", max_depth=4, l2=1.0, least_hessian=1.0)
    model = Booster(s).fit(data[3])
    assert values(model, data[0]) == pytest.approx(expect(plain(data, s).level(np.arange(ROWS)), ROWS), abs=1e-9)


def test_leaf_growth_takes_splits_best_first(data):
    s = Settings(1, 0.3, "leaf", max_leaves=13, least_rows=20, least_hessian=1e-3)
    model = Booster(s).fit(data[3])
    leaves, order = plain(data, s).leaf(np.arange(ROWS))
    tree = model.trees[0]
    assert values(model, data[0]) == pytest.approx(expect(leaves, ROWS), abs=1e-9)
    split = sorted((tree.left[i], (f, tree.threshold[i])) for i, f in enumerate(tree.feature) if f >= 0)   # children are numbered in order
    assert [what for _, what in split] == order
    assert tree.feature.count(-1) == 13


def test_symmetric_growth_shares_one_split_a_level(data):
    s = Settings(1, 0.3, "symmetric", max_depth=3, l2=3.0, from_average=False)
    model = Booster(s).fit(data[3])
    assert values(model, data[0]) == pytest.approx(expect(plain(data, s).symmetric(np.arange(ROWS)), ROWS), abs=1e-9)
    splits = {(f, t) for f, t in zip(model.trees[0].feature, model.trees[0].threshold) if f >= 0}
    assert len(splits) <= 3


def test_rounds_follow_the_margins_and_losses_fall(data):
    s = Settings(30, 0.2, "level", max_depth=3, l2=1.0)      # past a written round (CUT)
    x, y, w, b = data
    model = Booster(s).fit(b)
    margin, losses = np.full(ROWS, model.start), []
    for _ in range(3):
        margin += expect(Plain(x, y, w, b.edges, s, margin).level(np.arange(ROWS)), ROWS)
        p = 1 / (1 + np.exp(-margin))
        losses.append(-(w * np.log(np.where(y > 0, p, 1 - p))).sum() / w.sum())
    assert model.losses[:3] == pytest.approx(losses, abs=1e-9)
    assert len(model.losses) == 30 and all(a > b_ for a, b_ in zip(model.losses, model.losses[1:]))


def test_rows_and_features_are_drawn_for_each_tree(data):
    model = Booster(Settings(12, 0.2, "level", max_depth=2, row_share=0.5, feature_share=0.5)).fit(data[3])
    used = [{f for f in t.feature if f >= 0} for t in model.trees]
    assert all(len(u) <= 2 for u in used) and len(set().union(*used)) > 2
    again = Booster(Settings(12, 0.2, "level", max_depth=2, row_share=0.5, feature_share=0.5)).fit(data[3])
    assert again.trees == model.trees


def test_missing_values_go_where_they_gain_most(spark):
    x, y, w = make(missing=0.2)
    b = binning.binned(frame(spark, x, y, w))
    s = Settings(1, 0.3, "level", max_depth=3, l2=1.0)
    model = Booster(s).fit(b)
    assert values(model, x) == pytest.approx(expect(plain((x, y, w, b), s).level(np.arange(ROWS)), ROWS), abs=1e-9)
    df = frame(spark, x, y, w)
    got = model.transform(df).selectExpr("prediction = label AS ok").groupBy("ok").count().collect()
    assert sum(r["count"] for r in got) == ROWS


GROWTHS = [Settings(9, 0.3, "level", max_depth=4, l2=1.0, feature_share=0.5), Settings(9, 0.3, "leaf", max_leaves=9), Settings(9, 0.3, "symmetric", max_depth=3)]


@pytest.mark.parametrize("s", GROWTHS, ids=lambda s: s.growth)
def test_passes_over_many_blocks_grow_the_trees_of_one_task(data, monkeypatch, s):
    monkeypatch.setattr(boosting, "TREES_A_JOB", 4)
    one = Booster(s).fit(data[3])
    monkeypatch.setattr(binning, "FEW_ROWS", 200)
    monkeypatch.setattr(boosting, "MOST_ROWS", 500)
    monkeypatch.setattr(boosting.Grower, "MOST", 1)             # a pass for each node
    many = Booster(s).fit(data[3])
    assert [t.feature for t in many.trees] == [t.feature for t in one.trees] and len(many.losses) == len(one.losses) == 9
    assert many.margins(data[0]) == pytest.approx(one.margins(data[0]))
    assert many.losses == pytest.approx(one.losses)


def test_a_fit_takes_a_few_jobs(spark, data):
    sc = spark.sparkContext
    sc.setJobGroup("few-jobs", "")
    try:
        Booster(Settings(60, 0.2, "level", max_depth=3)).fit(data[3])
        assert len(sc.statusTracker().getJobIdsForGroup("few-jobs")) < 10
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("s", [Settings(12, 0.1, "level", max_depth=2), Settings(12, 0.1, "leaf", max_leaves=4), Settings(12, 0.1, "symmetric", max_depth=2)],
                         ids=lambda s: s.growth)
def test_a_tree_that_grows_as_those_before_takes_one_pass(spark, monkeypatch, s):
    x, _, w = make()
    y = ((x[:, 0] > 17) & (x[:, 2] > 0)).astype(float)          # the same two splits in every tree
    b = binning.binned(frame(spark, x, y, w))
    one = Booster(s).fit(b)
    monkeypatch.setattr(binning, "FEW_ROWS", 200)
    monkeypatch.setattr(boosting, "MOST_ROWS", 500)
    passes, summed = [], boosting.summed
    monkeypatch.setattr(boosting, "summed", lambda rdd, run: passes.append(run) or summed(rdd, run))
    many = Booster(s).fit(b)
    assert [t.feature for t in many.trees] == [t.feature for t in one.trees] and one.trees[0].feature.count(-1) > 2
    assert many.margins(x) == pytest.approx(one.margins(x)) and many.losses == pytest.approx(one.losses)
    # the class sums and the last loss, the first trees level by level, one pass for each of the others
    assert len(passes) <= 2 + 3 * boosting.OFTEN + (s.rounds - boosting.OFTEN)


@pytest.mark.parametrize("cuts", [(17, 17), (17, 20)], ids=["as guessed", "otherwise"])
def test_a_guess_answers_its_calls_and_no_others(data, monkeypatch, cuts):
    s, offsets, features = Settings(1, 0.1, "level", max_depth=4), data[3].offsets, np.arange(4)
    state = binning.blocks(data[3].table).map(lambda b: (boosting.Rows(b, 0.0),))

    def call(cut):
        tree = boosting.Tree()
        if cut:
            tree.split(0, 0, cut, float(cut), False)
        return tree, np.array([-1, 0, 1] if cut else [0]), 2 if cut else 1

    before = boosting._Passes(state, [], offsets, s, 0, features, [])
    for cut in (None, cuts[0]):
        before(*call(cut))
    guess = boosting._often([before.calls] * boosting.OFTEN, 10)
    assert [len(part) for part in guess] == [2] and not boosting._often([before.calls] * (boosting.OFTEN - 1), 10)
    assert [len(part) for part in boosting._often([before.calls] * boosting.OFTEN, 2)] == [1]
    guessed, without = (boosting._Passes(state, [], offsets, s, 0, features, g) for g in (guess, []))
    jobs, job = [], boosting._Passes.job
    monkeypatch.setattr(boosting._Passes, "job", lambda self, parts: jobs.append(self) or job(self, parts))
    for cut in (None, cuts[1]):
        assert (guessed(*call(cut)) == without(*call(cut))).all()
    assert jobs.count(guessed) == len(set(cuts)) and jobs.count(without) == 2


@pytest.mark.parametrize("l2", [0.0, 3.0])
def test_rows_of_one_gradient_are_not_split_by_rounding(l2):
    rng = np.random.default_rng(1)
    offsets = np.arange(0, 27 * 20, 20)
    n = np.zeros((26, 20))
    for f in range(26):
        n[f, :19] = rng.multinomial(120_000, rng.dirichlet(np.ones(19)))
    n = n.reshape(-1)
    for g, h in ((-0.5, 0.25), (0.377, 0.2349), (-1e-3, 9.99e-4)):
        # sums of so many terms are off by some last digits, each in its own way
        off = 1 + rng.normal(0, 1e-14, (2, len(n)))
        layout = boosting.Layout(offsets, np.arange(26))
        gains = layout.gains(np.stack([n * g * off[0], n * h * off[1], n]), Settings(1, 0.1, max_depth=2, l2=l2))
        assert layout.best(gains) is None


def test_scans_take_tasks_by_the_work_in_them(spark):
    def tasks(rows):
        return binning.spread(spark.range(rows), binning.FEW_ROWS, binning.SCANNED_ROWS).rdd.getNumPartitions()

    cores = spark.sparkContext.defaultParallelism
    assert tasks(1000) == 1
    assert tasks(60_000) == 2
    assert tasks(cores * 60_000) == cores       # one wave


def test_class_weights_equal_row_weights(spark):
    x, y, w = make()
    s = Settings(3, 0.2, "leaf", max_leaves=6)
    one = Booster(s).fit(binning.binned(frame(spark, x, y, w)))
    two = Booster(s).fit(binning.binned(frame(spark, x, y, np.ones(len(y)))), (0.75, 1.5))
    assert one.margins(x) == pytest.approx(two.margins(x))


def test_one_class_and_one_row(spark):
    x, y, w = make(20)
    for rows in (20, 1):
        model = Booster(Settings(2, 0.1, "level", max_depth=2)).fit(frame(spark, x[:rows], np.ones(rows), np.ones(rows)))
        assert len(model.trees) == 2 and np.isfinite(model.margins(x)).all()
    with pytest.raises(ValueError, match="no training rows"):
        Booster(Settings(2, 0.1, "level", max_depth=2)).fit(frame(spark, x, y, w).limit(0))
    with pytest.raises(ValueError):
        Settings(2, 0.1, "leaf")


def plain_stumps(x, y, edges, rounds, rate):
    w, out = np.ones(len(y)), []
    gini = lambda r: 2 * w[r & (y > 0)].sum() * w[r & (y == 0)].sum() / w[r].sum() if w[r].sum() else 0.0
    for _ in range(rounds):
        every, best = np.ones(len(y), bool), None
        for f, cuts in enumerate(edges):
            for cut in cuts:
                left = x[:, f] <= cut
                gain = gini(every) - gini(left) - gini(~left)
                if gain > max(1e-12, best[0] + 1e-12 if best else 0):
                    best = (gain, f, cut, left)
        _, f, cut, left = best
        says = [float(w[r & (y > 0)].sum() > w[r & (y == 0)].sum()) for r in (left, ~left)]
        miss = np.where(left, *says) != y
        error = w[miss].sum() / w.sum()
        alpha = rate * math.log((1 - error) / error)
        out.append(((f, float(cut), *says), alpha))
        w = w * np.where(miss, math.exp(alpha), 1.0)
    return out


def test_boosted_stumps_equal_brute_force(spark):
    x, y, _ = make(300, seed=9)
    b = binning.binned(frame(spark, x, y, np.ones(len(y))))
    got = boosting.boosted_stumps(b, 27, 0.5)
    want = plain_stumps(x, y, b.edges, 27, 0.5)
    assert [s for s, _ in got] == [s for s, _ in want]
    assert [a for _, a in got] == pytest.approx([a for _, a in want])


def test_ordered_target_sees_no_label_of_its_own(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice("aaaaabbc"), float(rng.random() < 0.4)) for i in range(200)]
    make_ = lambda r: spark.createDataFrame(r, "row long, tld string, label double")
    coded, stats = encode.ordered_target(make_(rows), "tld", "label", "row", "stat", strength=2.0)
    got = {r["row"]: r["stat"] for r in coded.collect()}
    order = {r["row"]: (r["h"], r["row"]) for r in make_(rows).select("row", F.xxhash64(F.lit(42), "row").alias("h")).collect()}
    prior = sum(r[2] for r in rows) / len(rows)
    for i, t, _ in rows:
        before = [r[2] for r in rows if r[1] == t and order[r[0]] < order[i]]
        assert got[i] == pytest.approx((sum(before) + 2 * prior) / (len(before) + 2))
    for t, s in ((r["tld"], r["stat"]) for r in stats.collect()):
        own = [r[2] for r in rows if r[1] == t]
        assert s == pytest.approx((sum(own) + 2 * prior) / (len(own) + 2))


def test_the_ordered_table_is_written(spark):
    rows = spark.createDataFrame([(i, i % 2, "ab"[i % 3 == 0]) for i in range(60)], "url_len int, label int, tld string")
    vocab, names = zoo.prepare(rows, numeric=["url_len"])
    data, names, known = zoo.ordered_table(rows, vocab, names)
    assert names == ["url_len", zoo.CATEGORY] and set(known) >= {"a", "b"} and data.count() == 60
    assert "Window" not in data._jdf.queryExecution().optimizedPlan().toString()       # its readers don't sum again


def test_extra_trees_draw_thresholds_between_the_bounds_of_each_node(spark):
    x, y, w = make(400)
    df = frame(spark, x, y, w)
    model = ExtraTrees("weight", 40, 2, 30).fit(df)
    places = []
    for t in model.trees:
        rows = {0: np.arange(len(x))}
        for node, f in enumerate(t.feature):
            here = rows[node]
            share = w[here][y[here] > 0].sum() / w[here].sum()
            assert t.share[node] == pytest.approx(share)
            if f < 0:
                assert len(here) < 4 or len(set(y[here])) == 1 or len(here) >= 2
                continue
            v = x[here, f]
            assert v.min() <= t.threshold[node] < v.max()
            if f == 1 and len(np.unique(v)) > 10:
                places.append((t.threshold[node] - v.min()) / (v.max() - v.min()))
            rows[t.left[node]], rows[t.right[node]] = here[v <= t.threshold[node]], here[v > t.threshold[node]]
            assert min(len(rows[t.left[node]]), len(rows[t.right[node]])) >= 2
    cuts = [c for t in model.trees for f, c in zip(t.feature, t.threshold) if f == 1]
    assert len(set(cuts)) == len(cuts)                                     # no shared edges
    roots = [t.feature[0] for t in model.trees]
    assert len(set(roots)) > 1 and len(places) > 30 and min(places) < 0.3 < 0.7 < max(places)
    scored = model.transform(df).selectExpr("avg(cast(prediction = label AS int)) AS a").first()[0]
    assert scored > 0.9
    again = ExtraTrees("weight", 40, 2, 30).fit(frame(spark, x, y, w, parts=1))
    assert all((a.feature == b.feature).all() and np.allclose(a.threshold, b.threshold) for a, b in zip(model.trees, again.trees))


def test_extra_trees_of_constant_features_are_leaves(spark):
    x, y, w = make(30)
    x[:] = 1.0
    model = ExtraTrees(None, 5, 2, 30).fit(frame(spark, x, y, w))
    assert [len(t.feature) for t in model.trees] == [1] * 5
    assert model.trees[0].share[0] == pytest.approx(y.mean())
