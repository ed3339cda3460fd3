"""Scoring rules, contributions and tips."""
import pytest
from pyspark.sql import functions as F

from urlsight.operators import explain as E
from urlsight.operators import score as S


def test_verdict_rules(spark):
    df = spark.createDataFrame([(0.29,), (0.5,), (0.4999,), (0.61,), (1.0,)], "p double")
    rows = {r["p"]: r for r in S.with_verdict(df).collect()}
    assert rows[0.29]["risk_score"] == 28 and rows[0.29]["risk_band"] == "low"   # int truncation like Python
    assert rows[0.5]["verdict"] == "phishing" and rows[0.4999]["verdict"] == "safe"
    assert rows[0.61]["risk_band"] == "high" and rows[1.0]["gauge_position"] == 100
    assert rows[0.5]["recommendation"] == S.RECOMMENDATION_PHISHING


def test_contributions_stable_and_filtered(spark):
    names = ["a", "tld_len", "b", "tld_com", "tld_other", "c"]
    df = spark.createDataFrame([(1, 2.0, 3, 2.0, 1, 0, 0.0005)], "id int, a double, tld_len int, b double, "
                               "tld_com int, tld_other int, c double")
    got = [(r["feature"], r["score"]) for r in E.top_contributions(df, names, "id").orderBy("rank").collect()]
    # a and b tie at 2.0: column order kept; tld_len/tld_com score 0.5; tld_other inactive; c below 0.001
    assert got == [("a", 2.0), ("b", 2.0), ("tld_len", 0.5), ("tld_com", 0.5)]


def test_tips_default_and_https_rule(spark):
    df = spark.createDataFrame([(1, 1, "is_https", 1.0, 1.0), (1, 2, "url_len", 40.0, 40.0), (1, 3, "weird", 2.0, 2.0)],
                               "id int, rank long, feature string, value double, score double")
    tips = {r["feature"]: r["tip"] for r in E.with_tips(df, spark).collect()}
    assert tips["url_len"] == E.SECURITY_TIPS["url_len"]
    assert tips["weird"] == "Unusual value in 'weird' — review before trusting this site."
    assert tips["is_https"].startswith("Unusual value")   # HTTPS tip only when HTTPS is absent


def test_linear_attribution_sums_to_centered_margin(spark):
    df = spark.createDataFrame([(i, float(i), float(i % 3)) for i in range(20)], "id int, x double, z double")
    coef = {"x": F.lit(0.5), "z": F.lit(-2.0)}
    attr = E.linear_attribution(df, "id", ["x", "z"], coef=coef)
    per_row = attr.groupBy("row_id").agg(F.sum("attribution").alias("s"))
    stats = df.agg(F.avg("x").alias("mx"), F.stddev_pop("x").alias("sx"), F.avg("z").alias("mz"),
                   F.stddev_pop("z").alias("sz")).first()
    for r in per_row.collect():
        i = r["row_id"]
        exp = 0.5 * (i - stats["mx"]) / stats["sx"] - 2.0 * ((i % 3) - stats["mz"]) / stats["sz"]
        assert r["s"] == pytest.approx(exp)


def test_row_local_explanations_equal_the_joined_ones(spark):
    df = spark.createDataFrame([(1, 1.0, 40.0, 2.0), (2, 0.0, 0.0, 0.0), (3, 0.0, 3.0, 9.0)], "id int, is_https double, url_len double, weird double")
    names = ["is_https", "url_len", "weird"]
    got = {r.id: r for r in E.explained(df, names).collect()}
    joined = {}
    for r in E.with_tips(E.top_contributions(df, names, "id"), spark).orderBy("id", "rank").collect():
        joined.setdefault(r.id, []).append(f"{r.display} · value signal {r.score:.2f} — {r.tip}")
    assert {i: r.explanation for i, r in got.items()} == {1: joined[1], 2: [E.NO_SIGNAL_TEXT], 3: joined[3]}
    assert [got[i].top_trigger for i in (1, 2, 3)] == ["Url Len", None, "Weird"]


def test_null_probability_has_no_verdict(spark):
    r = S.with_verdict(spark.createDataFrame([(None,)], "p double")).first()
    assert [r.verdict, r.probability, r.risk_score, r.gauge_position, r.risk_band, r.recommendation] == [None] * 6


# ------------------------------------------------------------------ coalition attribution (E5)
def _vectors(spark, x):
    from pyspark.ml.functions import array_to_vector
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<double>").select("id", array_to_vector("x").alias("features"))


def _expression(text):
    """A model over ``x[0]``, ``x[1]``, ... as SQL."""
    from pyspark.ml.functions import vector_to_array
    return lambda df: df.withColumn("x", vector_to_array("features")).withColumn("value", F.expr(text)).drop("x")


def test_coalitions_give_exact_shapley_values_by_enumeration(spark):
    import itertools
    import math

    import numpy as np

    from urlsight.operators.coalitions import coalition_attribution, coalitions
    d, rng = 8, np.random.default_rng(0)
    x, bg = rng.normal(size=(3, d)).round(2), rng.normal(size=(4, d)).round(2)
    f = lambda v: v[0] * v[1] + math.sin(v[2]) * v[3] - (v[4] > 0) * v[5] + v[6]      # noqa: E731  x[7] has no effect
    text = "x[0] * x[1] + sin(x[2]) * x[3] - IF(x[4] > 0, x[5], 0) + x[6]"
    assert len(coalitions(d, 254)[0]) == 254
    got = {(r.row_id, r.feature): r.attribution for r in coalition_attribution(
        _vectors(spark, x), _vectors(spark, bg), _expression(text), "id", [f"f{j}" for j in range(d)], most=254).collect()}
    for i, row in enumerate(x):
        value = {s: np.mean([f(np.where(np.isin(np.arange(d), s), row, b)) for b in bg]) for k in range(d + 1) for s in itertools.combinations(range(d), k)}
        for j in range(d):
            want = sum(math.factorial(len(s)) * math.factorial(d - len(s) - 1) / math.factorial(d) * (value[tuple(sorted((*s, j)))] - value[s])
                       for s in value if j not in s)
            assert got[i, f"f{j}"] == pytest.approx(want, abs=1e-9)
    assert got[0, "f7"] == pytest.approx(0, abs=1e-9)


def test_drawn_coalitions_keep_the_sum_and_come_in_pairs(spark):
    import numpy as np

    from urlsight.operators.coalitions import coalition_attribution, coalitions
    masks, weights = coalitions(20, 120)
    assert len(masks) <= 120 and (weights > 0).all() and not masks.all(axis=1).any() and masks.any(axis=1).all()
    assert {tuple(m) for m in masks} == {tuple(~m) for m in masks}
    assert {int(m.sum()) for m in masks if m.sum() in (1, 19)} == {1, 19} and sum(m.sum() == 1 for m in masks) == 20
    x = np.random.default_rng(1).normal(size=(5, 20)).round(2)
    text = "exp(x[0] / 4) * x[1] + x[2] - x[3]"
    rows = coalition_attribution(_vectors(spark, x), _vectors(spark, x[:3]), _expression(text), "id", [f"f{j}" for j in range(20)], most=120).collect()
    f = lambda v: np.exp(v[:, 0] / 4) * v[:, 1] + v[:, 2] - v[:, 3]     # noqa: E731
    for i in range(5):
        assert sum(r.attribution for r in rows if r.row_id == i) == pytest.approx(f(x)[i] - f(x[:3]).mean())
    assert {r.feature: r.value for r in rows if r.row_id == 2} == {f"f{j}": x[2, j] for j in range(20)}


def test_coalitions_of_a_logistic_model_equal_its_linear_attribution(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    from urlsight.operators.coalitions import coalition_attribution, model_score
    df = spark.createDataFrame([(i, float(i % 2 if i % 5 else 1), float(i), float(i * i % 7), float(i % 3)) for i in range(40)],
                               "id long, label double, a double, b double, c double")
    x = df.select("id", "label", array_to_vector(F.array("a", "b", "c")).alias("features"))
    model = LogisticRegression(regParam=0.1).fit(x)
    got = {(r.row_id, r.feature): r.attribution for r in coalition_attribution(x, x, model_score(model, margin=True), "id", ["a", "b", "c"]).collect()}
    sd = df.agg(*[F.stddev_pop(n).alias(n) for n in "abc"]).first()
    coef = {n: F.lit(float(model.coefficients[j] * sd[n])) for j, n in enumerate("abc")}      # of standardised inputs
    want = {(r.row_id, r.feature): r.attribution for r in E.linear_attribution(df, "id", ["a", "b", "c"], coef=coef).collect()}
    assert got == pytest.approx(want, abs=1e-9)


def test_permutation_importance_without_windows_over_all(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    from urlsight.operators import split as K
    from urlsight.operators.attribution import permutation_importance
    df = spark.range(200).selectExpr("id", "cast(id % 2 AS double) AS label", "id % 2 + (id % 7) / 10 AS a", "cast(id % 5 AS double) AS b")
    x = K.hash_sample(df, "id", 100).select("id", "label", "sample_rank", array_to_vector(F.array(F.col("a").cast("double"), "b")).alias("features"))
    got = {r.feature: r for r in permutation_importance(LogisticRegression().fit(x), x, "id", ["a", "b"]).collect()}
    assert got["a"].auc_drop > 0.2 and abs(got["b"].auc_drop) < 0.05 and got["a"].log_loss_increase > 0
