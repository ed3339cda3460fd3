"""Metric operators: bucketed running sums vs plain windows, symmetry, golden rows, brute force."""
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from urlsight.operators import metrics as M
from urlsight.operators.cumulative import running_sums
from urlsight.sources import tables as T

from .conftest import SF_MID

# Ten published comparison rows (tp, fp, tn, fn and the metrics
# they imply): accuracy, precision, recall, F1, MCC.
GOLDEN = [
    ("HistGradientBoosting", 3203, 359, 19640, 116, 0.9796294707950939, 0.89921392476137, 0.9650497137692076, 0.9309693358523471, 0.9198279328905697),
    ("LightGBM", 3202, 320, 19679, 117, 0.9812591131314864, 0.9091425326519024, 0.9647484181982525, 0.9361204502265751, 0.9257102374353477),
    ("CatBoost", 3186, 316, 19683, 133, 0.9807444892357835, 0.9097658480868075, 0.9599276890629708, 0.9341738747984166, 0.9233621538094524),
    ("XGBoost", 3180, 267, 19732, 139, 0.9825885581953855, 0.9225413402959095, 0.9581199156372401, 0.9399940880874963, 0.9300429643606971),
    ("ExtraTrees", 3174, 474, 19525, 145, 0.9734539840466593, 0.8700657894736842, 0.9563121422115095, 0.9111525764317496, 0.8969715848339158),
    ("RandomForest", 3166, 317, 19682, 153, 0.9798438974183035, 0.9089865058857307, 0.9539017776438686, 0.9309026756836225, 0.9194780595686298),
    ("LogisticRegression", 3164, 993, 19006, 155, 0.9507676473110901, 0.7611258118835699, 0.9532991865019584, 0.846441947565543, 0.8249114609144673),
    ("Bagging", 3086, 155, 19844, 233, 0.9833604940389399, 0.9521752545510644, 0.9297981319674601, 0.9408536585365853, 0.9312627916389732),
    ("GradientBoosting", 2904, 132, 19867, 415, 0.9765417274208765, 0.9565217391304348, 0.8749623380536307, 0.9139260424862313, 0.9015759285925296),
    ("AdaBoost", 2465, 243, 19756, 854, 0.9529547988678274, 0.9102658788774003, 0.7426935824043387, 0.817985730877717, 0.7966915470697935),
]


def test_golden_rows(spark):
    counts = spark.createDataFrame([g[:5] for g in GOLDEN], "model string, tp long, fp long, tn long, fn long")
    got = {r["model"]: r for r in M.class_metrics_from_counts(counts).collect()}
    for name, *_, acc, prec, rec, f1, mcc in GOLDEN:
        r = got[name]
        assert (r["accuracy"], r["precision_phish"], r["recall_phish"], r["f1_phish"], r["mcc"]) == \
            pytest.approx((acc, prec, rec, f1, mcc), abs=1e-12)


def test_golden_ranking(spark):
    rows = [(g[0], g[5], g[7], g[8]) for g in GOLDEN]
    df = spark.createDataFrame(rows, "model string, accuracy double, recall_phish double, f1_phish double")
    ranked = [r["model"] for r in M.rank_models(df).orderBy("rank").collect()]
    assert ranked == [g[0] for g in GOLDEN]  # the reference's table is already in that order


def test_reference_values_at_sf001(spark):
    auc = M.auc_metrics(M.curve(T.scored(spark, SF_MID))).first()
    ll = M.log_loss(T.scored(spark, SF_MID)).first()
    assert auc["roc_auc"] == pytest.approx(0.49898975411067237, abs=1e-12)
    assert auc["pr_auc"] == pytest.approx(0.3335712442102398, abs=1e-12)
    assert ll["log_loss"] == pytest.approx(0.961844, abs=1e-6)


def test_ranged_running_sums_equal_plain_window(spark):
    d = M.score_table(T.scored_models(spark, SF_MID))
    got = running_sums(d, "model", "p", ["pos", "neg"], rows_per_range=7)   # forces many ranges
    w = Window.partitionBy("model").orderBy(F.desc("p"))
    plain = d.select("*", F.sum("pos").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_pos"),
                     F.sum("neg").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_neg"),
                     F.lead("pos").over(w).alias("next_pos"), F.lead("neg").over(w).alias("next_neg"))
    cols = ["model", "p", "pos", "neg", "cum_pos", "cum_neg", "next_pos", "next_neg"]
    assert got.select(cols).exceptAll(plain.select(cols)).count() == 0
    assert plain.select(cols).exceptAll(got.select(cols)).count() == 0


def test_auc_brute_force_and_symmetry(spark):
    rows = [("m", y, p) for y, p in [(1, .9), (0, .8), (1, .8), (0, .3), (1, .3), (0, .1), (0, .3), (1, .95)]]
    sc = spark.createDataFrame(rows, "model string, y int, p double").withColumn("yhat", (F.col("p") >= .5).cast("int"))
    auc = M.auc_metrics(M.curve(sc, rows_per_range=2)).first()["roc_auc"]
    pos = [p for _, y, p in rows if y == 1]
    neg = [p for _, y, p in rows if y == 0]
    brute = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg)) / (len(pos) * len(neg))
    assert auc == pytest.approx(brute)
    flipped = sc.withColumn("p", 1 - F.col("p"))
    assert M.auc_metrics(M.curve(flipped)).first()["roc_auc"] == pytest.approx(1 - brute)


def test_roc_points_drop_collinear(spark):
    # scores with identical (pos, neg) steps are collinear and dropped
    rows = [("m", 1, .9), ("m", 1, .8), ("m", 1, .7), ("m", 0, .6), ("m", 0, .5)]
    sc = spark.createDataFrame(rows, "model string, y int, p double").withColumn("yhat", F.lit(1))
    pts = M.roc_points(M.curve(sc)).orderBy(F.col("threshold").desc_nulls_first()).collect()
    assert [(r["fpr"], r["tpr"]) for r in pts] == [(0.0, 0.0), (0.0, 1 / 3), (0.0, 1.0), (1.0, 1.0)]


def test_exact_quantiles_match_numpy(spark):

    from urlsight.operators.selection import exact_quantiles
    rng = np.random.default_rng(1)
    vals = np.round(rng.normal(size=3000), 2)
    grp = rng.integers(0, 3, size=3000)
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(grp, vals)], "g int, value double")
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], [0.1, 0.25, 0.5, 0.75, 0.9]).collect()}
    for g in range(3):
        exp = np.quantile(vals[grp == g], [0.1, 0.25, 0.5, 0.75, 0.9])
        assert [got[g][f"q{i}"] for i in range(5)] == pytest.approx(list(exp), abs=1e-9)


@pytest.mark.parametrize("values", [
    [5.0], [1.0, 2.0], [3.0] * 40, [-1e300, -1.0, -1e-300, 0.0, 5e-324, 1e-320, 1e-300, 1e-9, 1.0, 1.0 + 2 ** -52, 1e9, 1.7e308],
    [float(i) ** 9 for i in range(-60, 60)], [2.0 ** -i for i in range(1000)], [float("-inf"), -5.0, 1.0, float("inf"), float("inf")]])
def test_exact_quantiles_of_any_range(spark, values):
    """Ranks are found whatever the values; the order statistics themselves are compared."""
    from urlsight.operators.selection import exact_quantiles
    n = len(values)
    probs = [0.0, 1.0] + [i / (n - 1) for i in range(1, min(n - 1, 9))]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "value double").repartition(3)
    got = exact_quantiles(df.withColumn("g", F.lit(None).cast("int")), ["g"], probs).collect()
    assert len(got) == 1 and got[0]["g"] is None
    for i, q in enumerate(probs):
        want = sorted(values)[int((n - 1) * q)]
        if math.isfinite(want) and (n - 1) * q == int((n - 1) * q):
            assert got[0][f"q{i}"] == want


def test_exact_quantiles_put_nan_above_all(spark):
    from urlsight.operators.selection import exact_quantiles
    df = spark.createDataFrame([(1, float(i)) for i in range(5)] + [(1, float("nan"))] * 2 + [(2, float("nan"))], "g int, value double")
    got = {r.g: r for r in exact_quantiles(df, ["g"], [0.5, 1.0]).collect()}
    assert got[1].q0 == 3.0 and math.isnan(got[1].q1) and math.isnan(got[2].q0)
    assert exact_quantiles(df.where("false"), ["g"], [0.5]).count() == 0


def test_quantile_passes_move_counts_not_values(spark, monkeypatch):
    """What crosses the network are bins: far fewer rows than values."""
    from urlsight.operators import selection
    moved = []
    monkeypatch.setattr(selection, "written", lambda df, w=selection.written: moved.append(w(df)) or moved[-1])
    df = spark.range(200_000).selectExpr("0 AS g", "sqrt(id) AS value")
    r = selection.exact_quantiles(df, ["g"], [0.25, 0.5]).first()
    v = np.sqrt(np.arange(200_000.0))
    assert (r.q0, r.q1) == pytest.approx((np.quantile(v, 0.25), np.quantile(v, 0.5)), abs=1e-12)
    assert max(t.count() for t in moved) <= 2 * 4 * selection.BINS


def test_hot_score_group_is_collapsed(spark):
    """A third of all rows share one score: the distinct-score table has one row for it,
    and the metrics equal a pandas brute force."""
    import numpy as np
    n = 3000
    df = spark.range(n).select(
        F.lit("m").alias("model"), (F.col("id") % 5 == 0).cast("int").alias("y"),
        F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise((F.col("id") % 97) / 97.0).alias("p"))
    df = df.withColumn("yhat", (F.col("p") >= 0.5).cast("int"))
    d = M.score_table(df)
    assert d.where(F.col("p") == 0.5).first()["pos"] + d.where(F.col("p") == 0.5).first()["neg"] >= n // 3
    got = M.auc_metrics(M.curve(df, rows_per_range=10)).first()
    pdf = df.toPandas()
    pos, neg = pdf[pdf.y == 1].p.to_numpy(), pdf[pdf.y == 0].p.to_numpy()
    greater = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert got["roc_auc"] == pytest.approx(greater / (len(pos) * len(neg)))
    order = np.argsort(-pdf.p.to_numpy(), kind="stable")
    ys, ps = pdf.y.to_numpy()[order], pdf.p.to_numpy()[order]
    ap, tp, fp, i = 0.0, 0, 0, 0
    while i < len(ps):
        j = i
        while j < len(ps) and ps[j] == ps[i]:
            j += 1
        dp = ys[i:j].sum()
        tp += dp
        fp += (j - i) - dp
        ap += dp / len(pos) * tp / (tp + fp)
        i = j
    assert got["pr_auc"] == pytest.approx(ap)


def test_more_than_a_thousand_groups_and_null_groups(spark):
    d = spark.range(6000).select(
        F.when(F.col("id") % 1500 != 7, F.col("id") % 1500).alias("g"), (F.col("id") % 2).alias("h"),
        F.col("id").cast("double").alias("v"), (F.col("id") % 5 + 1).alias("n"))
    got = running_sums(d, ["g", "h"], "v", ["n"], descending=False, rows_per_range=100)
    w = Window.partitionBy("g", "h").orderBy("v")
    plain = d.select("*", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_n"), F.lead("n").over(w).alias("next_n"),
                     F.sum("n").over(Window.partitionBy("g", "h")).alias("all_n"))
    assert got.count() == 6000 and got.exceptAll(plain).count() == 0


def test_null_scores_are_refused_and_reported(spark):
    sc = spark.createDataFrame([("m", 1, 0.5), ("m", 0, None), ("m", None, 0.1)], "model string, y int, p double")
    assert M.unscored(sc).collect() == [("m", 1, 1)]
    for bad in (sc.where("y IS NOT NULL"), sc.where("p IS NOT NULL")):
        with pytest.raises(Exception, match="scored rows hold NULL"):
            M.log_loss(bad).collect()
        with pytest.raises(Exception, match="scored rows hold NULL"):
            M.curve(bad).collect()


def test_correlation_is_pairwise_complete(spark):
    import pandas as pd

    from urlsight.operators.eda import correlation_matrix
    rows = [(1.0, 2.0, 5.0, 1.0), (2.0, 1.0, None, 1.0), (3.0, 5.0, 2.0, 1.0), (4.0, 0.5, None, 1.0), (5.0, 1.5, 9.0, 1.0)]
    exp = pd.DataFrame(rows, columns=list("abck"), dtype=float).corr()
    got = {(r.feature_a, r.feature_b): r["corr"] for r in correlation_matrix(
        spark.createDataFrame(rows, "a double, b double, c double, k double"), list("abck")).collect()}
    assert len(got) == 16
    for (a, b), v in got.items():
        assert v is None if pd.isna(exp.loc[a, b]) else v == pytest.approx(exp.loc[a, b], abs=1e-6)


def test_null_labels_keep_their_rows(spark):
    from urlsight.operators import eda
    df = spark.createDataFrame([(float(i), None if i % 3 == 0 else i % 2) for i in range(30)], "x double, label int")
    box = {r.label: r for r in eda.box_stats(df, ["x"]).collect()}
    assert set(box) == {None, 0, 1} and box[None].median == 13.5
    dens = eda.histogram(df, ["x"], bins=3, density=True).collect()
    assert sum(r.n for r in dens) == 30 and sum(r.n for r in dens if r.label is None) == 10
