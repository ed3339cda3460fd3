"""Registered model queries: trainers, comparison, batch scoring, explanations.

All use the reference's settings. The label of the given URLs is a rule over two
features, so a model that has learned it makes no error on the held-out rows: its confusion
counts, accuracy, precision, recall, F1, areas and correlation are known to SQL. What
SQL can't know (log loss, seconds, probabilities, triggers, sentences, losses) is in
queries of its own, ``*_rows`` and ``model_report``; the queries without that ending
return keys, verdicts and whether the score columns agree.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.url import TEXT_FEATURES
from ..operators import explain as E
from ..operators import score as S
from ..operators import split as K
from ..operators import zoo as Z
from ..operators.encode import encode, qcol
from ..operators.metrics import rank_models
from ..session import written
from ..sources import tables as T
from . import oracle_views as V
from .encode_queries import _split_sql


def _split(spark: SparkSession, d: str):
    # Every trainer job re-reads the split table: write it once.
    df = written(K.stratified_split(T.weak_labelled_urls(spark, d), "page_id"))
    return df.where(F.col("split") == "train"), df.where(F.col("split") == "test")


def _fitted(spark: SparkSession, d: str, name: str):
    train, test = _split(spark, d)
    vocab_model, names = Z.prepare(train)
    data = Z.training_table(train, vocab_model, names)
    return Z.fit_one(Z.TRAINERS[name], train, vocab_model, names, assembled=data), data, test


AREAS = ["model", "held_out_positives", "held_out_negatives", "roc_auc", "pr_auc"]
KNOWN = ["model", "tp", "fp", "tn", "fn", "accuracy", "precision_phish", "recall_phish", "f1_phish", "roc_auc", "pr_auc", "mcc"]


def ranking(metrics: DataFrame) -> DataFrame:
    """What holds for bootstrap trees too, whose threshold may miss a held-out row: the areas, and the counts of the classes."""
    return metrics.select("*", (F.col("tp") + F.col("fn")).alias("held_out_positives"), (F.col("tn") + F.col("fp")).alias("held_out_negatives")).select(*AREAS)


def train_bagging(spark: SparkSession, d: str) -> DataFrame:
    fm, _, test = _fitted(spark, d, "Bagging")
    return ranking(Z.evaluate(fm, test))


def _train_one(name: str):
    def q(spark: SparkSession, d: str) -> DataFrame:
        fm, _, test = _fitted(spark, d, name)
        return Z.evaluate(fm, test).select(*KNOWN)
    return q


def stationarity(fm, data: DataFrame) -> float:
    """Largest weighted score equation of a fitted logistic model, with its penalty (0 at the optimum)."""
    from pyspark.ml.functions import vector_to_array
    lr = fm.model.stages[1]
    rows = fm.model.transform(data.withColumn("weight", Z.balanced_weight(data)))
    w, p, x = F.col("weight"), vector_to_array("probability")[1], vector_to_array("scaled")
    k = len(lr.coefficients)
    g = rows.agg(F.sum(w).alias("w"), F.sum(w * (p - F.col("label"))).alias("b"),
                 *[F.sum(w * (p - F.col("label")) * x[i]).alias(f"g{i}") for i in range(k)]).first()
    lam = lr.getRegParam()
    return max(abs(g["b"] / g["w"]), *[abs(g[f"g{i}"] / g["w"] + lam * c) for i, c in enumerate(lr.coefficients)])


def train_logistic(spark: SparkSession, d: str) -> DataFrame:
    fm, data, test = _fitted(spark, d, "LogisticRegression")
    return Z.evaluate(fm, test).select(*KNOWN, F.lit(stationarity(fm, data) < 1e-6).alias("at_optimum"))


def _all_models(spark: SparkSession, d: str) -> DataFrame:
    """The metric rows of all ten models: one that can't be fitted is an error, not a row less."""
    _, _, metrics, _ = Z.train_all(*_split(spark, d), skip_failed=False)
    return metrics


def model_comparison(spark: SparkSession, d: str) -> DataFrame:
    """All ten models side by side on the held-out rows (``model_report`` has every metric)."""
    return ranking(_all_models(spark, d))


def model_report(spark: SparkSession, d: str) -> DataFrame:
    """The ranking of all ten models with log loss and train seconds."""
    return rank_models(_all_models(spark, d))


def agrees(threshold: float = S.THRESHOLD) -> Column:
    """Whether verdict, percent, risk score and band follow from the probability."""
    p = F.col("p_phishing")
    return ((F.col("verdict") == F.when(p >= threshold, "phishing").otherwise("safe")) & (F.abs(F.col("probability") - 100 * p) <= 0.005000001)
            & (F.col("risk_score") == F.floor(100 * p)) & (F.col("risk_band") == F.when(p < 0.3, "low").when(p < 0.6, "medium").otherwise("high")))


def batch_score_rows(spark: SparkSession, d: str) -> DataFrame:
    """Every page URL -> features -> model -> verdict columns (input columns kept)."""
    fm, _, _ = _fitted(spark, d, "LogisticRegression")
    return S.with_verdict(fm.score(T.url_features(spark, d), ["page_id", "url"]))


def batch_score(spark: SparkSession, d: str) -> DataFrame:
    return batch_score_rows(spark, d).select("page_id", "url", "verdict", agrees().alias("agrees"))


def explain_scores_rows(spark: SparkSession, d: str) -> DataFrame:
    """V3 re-aimed at a table: verdict, risk band, top trigger and explanation per URL, all row-local."""
    fm, _, _ = _fitted(spark, d, "LogisticRegression")
    enc = encode(T.url_features(spark, d), fm.vocab_model.getVocabulary(), keep=["page_id"])
    keep = ["page_id", *fm.feature_names]
    x = Z.assemble(enc, fm.feature_names, ["page_id"]).select("page_id", "features", *[
        F.col(n).alias(f) for n, f in zip(Z.internal_names(len(fm.feature_names)), fm.feature_names)])
    scored = S.class_scores(fm.model.transform(x)).select(*[qcol(c) for c in keep], "p", "prediction")
    out = E.explained(S.with_verdict(scored), fm.feature_names)
    return out.select("page_id", "verdict", "probability", "risk_score", "risk_band", "p_phishing", "top_trigger", "explanation", "recommendation")


def explain_scores(spark: SparkSession, d: str) -> DataFrame:
    return explain_scores_rows(spark, d).select(
        "page_id", "verdict", agrees().alias("agrees"), F.col("top_trigger").isNotNull().alias("has_trigger"),
        (F.size("explanation") >= 1).alias("has_text"))


def loss_curve_rows(spark: SparkSession, d: str) -> DataFrame:
    fm, _, _ = _fitted(spark, d, "CatBoost")
    return Z.loss_curve(spark, fm.model)


def loss_curve(spark: SparkSession, d: str) -> DataFrame:
    """One row per iteration, and whether the loss fell from that of the one before (the first: from a coin's)."""
    before = F.coalesce(F.lag("log_loss").over(Window.orderBy("iteration")), F.lit(math.log(2)))     # 300 rows
    return loss_curve_rows(spark, d).select("iteration", (F.col("log_loss") <= before).alias("fell"))


def permutation_importance(spark: SparkSession, d: str) -> DataFrame:
    """E5: model-agnostic importance of every feature for the logistic model, on a 2,000-row held-out sample (K2)."""
    from ..operators.attribution import permutation_importance as perm
    fm, _, test = _fitted(spark, d, "LogisticRegression")
    sample = K.hash_sample(test, "page_id", 2000)
    x = Z.assemble(encode(sample, fm.vocab_model.getVocabulary(), keep=["page_id", "label", "sample_rank"]), fm.feature_names, ["page_id", "label", "sample_rank"])
    return perm(fm.model, x, "page_id", fm.feature_names)


def coalition_attribution_rows(spark: SparkSession, d: str) -> DataFrame:
    """E5: what each feature adds to the logistic model's probability of held-out rows (K2), against the background (K3)."""
    from ..operators.coalitions import BACKGROUND_ROWS, coalition_attribution, model_score
    fm, _, test = _fitted(spark, d, "LogisticRegression")
    sample, background = (fm.design(K.hash_sample(test, "page_id", n), ["page_id"]) for n in (2000, BACKGROUND_ROWS))
    return coalition_attribution(sample, background, model_score(fm.model), "page_id", fm.feature_names, most=256)


def train_logistic_docs(spark: SparkSession, d: str) -> DataFrame:
    """M10 + V16 on documents: scaled logistic regression on the lexical
    features of whole texts, toxicity label supplied with the data."""
    sp = written(K.stratified_split(T.labelled_docs(spark, d), "doc_id"))
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    x = Z.sized(written(Z.assemble(train, TEXT_FEATURES, ["label"]).select(F.col("label").cast("double").alias("label"), "features")))
    fm = Z.fit_one(Z.TRAINERS["LogisticRegression"], train, None, TEXT_FEATURES, assembled=x)
    pred = S.class_scores(fm.model.transform(Z.assemble(test, TEXT_FEATURES, ["doc_id", "label"])))
    scored = written(pred.select(F.lit("LogisticRegression").alias("model"), F.col("label").cast("int").alias("y"), "p",
                                 F.col("prediction").cast("int").alias("yhat"), F.lit(True).alias("has_p")))
    m = Z.evaluate_scored(scored, {"LogisticRegression": fm.train_seconds})
    # the lexical features say little about toxicity, so SQL knows the counts of the classes only
    return m.select("model", (F.col("tp") + F.col("fn")).alias("held_out_positives"), (F.col("tn") + F.col("fp")).alias("held_out_negatives"))


TRAINED = {
    "train_random_forest": "RandomForest", "train_extra_trees": "ExtraTrees", "train_gbt_deep": "XGBoost",
    "train_gbt_leafy": "LightGBM", "train_gbt_balanced": "CatBoost", "train_gbt": "GradientBoosting",
    "train_gbt_hist": "HistGradientBoosting", "train_adaboost": "AdaBoost",
}

QUERIES = {
    **{q: _train_one(name) for q, name in TRAINED.items()},
    "train_bagging": train_bagging,
    "train_logistic": train_logistic,
    "train_logistic_docs": train_logistic_docs,
    "permutation_importance": permutation_importance,
    "coalition_attribution_rows": coalition_attribution_rows,
    "model_comparison": model_comparison,
    "batch_score": batch_score,
    "explain_scores": explain_scores,
    "loss_curve": loss_curve,
    "model_report": model_report,
    "batch_score_rows": batch_score_rows,
    "explain_scores_rows": explain_scores_rows,
    "loss_curve_rows": loss_curve_rows,
}

# ----------------------------------------------------------------- oracle SQL
_UF = f"WITH {V.url_features_view()}"
_HELD = """count(*) FILTER (WHERE label = 1 AND split = 'test') AS held_out_positives,
       count(*) FILTER (WHERE label = 0 AND split = 'test') AS held_out_negatives"""


def _learned(models: list[str], more: str = "") -> str:
    """The metrics of models that have learned the rule, on the split's held-out rows."""
    names = ", ".join(f"'{m}'" for m in models)
    return f"""SELECT m.model, held_out_positives AS tp, 0 AS fp, held_out_negatives AS tn, 0 AS fn, 1.0 AS accuracy, 1.0 AS precision_phish,
        1.0 AS recall_phish, 1.0 AS f1_phish, 1.0 AS roc_auc, 1.0 AS pr_auc, 1.0 AS mcc{more}
        FROM (SELECT {_HELD} FROM ({_split_sql(f"{_UF}, {V.WEAK_LABELLED}", "wl", "page_id")})) h, (SELECT unnest([{names}]) AS model) m"""


def _ranked(models: list[str]) -> str:
    return f"SELECT model, tp AS held_out_positives, tn AS held_out_negatives, roc_auc, pr_auc FROM ({_learned(models)})"


_LEARNED = "CASE WHEN is_https = 0 AND query_len > 0 THEN 'phishing' ELSE 'safe' END AS verdict"

ORACLE = {
    **{q: _learned([name]) for q, name in TRAINED.items()},
    "train_logistic": _learned(["LogisticRegression"], ", true AS at_optimum"),
    "train_logistic_docs": f"""SELECT 'LogisticRegression' AS model, {_HELD}
        FROM ({_split_sql(f"WITH {V.labelled_docs_view()}", "ld", "doc_id")})""",
    "train_bagging": _ranked(["Bagging"]),
    "model_comparison": _ranked(list(Z.TRAINERS)),
    # the label is a rule over the URL, and the model learns it
    "batch_score": f"{_UF} SELECT page_id, url, {_LEARNED}, true AS agrees FROM uf",
    "explain_scores": f"{_UF} SELECT page_id, {_LEARNED}, true AS agrees, true AS has_trigger, true AS has_text FROM uf",
    "loss_curve": f"SELECT CAST(i AS INTEGER) AS iteration, true AS fell FROM range(1, {Z.CATBOOST['rounds'] + 1}) t(i)",
}

