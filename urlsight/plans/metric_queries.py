"""Registered metric queries over the scored long table."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..sources import tables as T
from . import oracle_views as V


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (oracle hygiene for aggregated values)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if f.dataType.simpleString() == "double"
                       else F.col(f.name) for f in df.schema.fields])


def _sm(s, d):
    return T.scored_models(s, d)


def _suite(s, d):
    return M.metric_suite(_sm(s, d))


def _roc(s, d):
    return rounded(M.roc_points(M.curve(_sm(s, d))))


def _model_card(s, d):
    scored = _sm(s, d)
    cv = M.curve(scored)
    pts = M.roc_points(cv).groupBy("model").agg(F.count(F.lit(1)).alias("n_roc_points"))
    suite = M.metric_suite(scored, cv=cv)
    # a confusion matrix always has its four cells
    return rounded(suite.join(pts, "model").select(
        "model", "roc_auc", "accuracy", "n_roc_points", F.lit(4).cast("long").alias("n_confusion_cells"), "tp", "fp", "tn", "fn"))


QUERIES = {
    "confusion": lambda s, d: M.confusion_long(_sm(s, d)),
    "class_metrics": lambda s, d: rounded(M.class_metrics_from_counts(M.confusion_counts(_sm(s, d)))),
    "roc_auc": lambda s, d: rounded(M.auc_metrics(M.curve(_sm(s, d))).select("model", "roc_auc")),
    "pr_auc": lambda s, d: rounded(M.auc_metrics(M.curve(_sm(s, d))).select("model", "pr_auc")),
    "log_loss": lambda s, d: rounded(M.log_loss(_sm(s, d))),
    "roc_curve": _roc,
    "roc_curve_with_baseline": lambda s, d: _roc(s, d).unionByName(M.random_baseline(s)),
    "threshold_for_recall": lambda s, d: rounded(M.threshold_for_recall(M.curve(_sm(s, d)), 0.95)),
    "metric_suite": lambda s, d: rounded(_suite(s, d)),
    "metric_report": lambda s, d: M.metric_report(_suite(s, d)),
    "model_ranking": lambda s, d: rounded(M.rank_models(_suite(s, d)).select(
        "model", "recall_phish", "f1_phish", "accuracy", "rank", "is_best")),
    "metric_bars": lambda s, d: M.metric_bars(_suite(s, d)),
    "model_card": _model_card,
}

# ----------------------------------------------------------------- oracle SQL
_SC = f"WITH {V.scored_models_view()}"
_D = """d AS (SELECT model, p, CAST(sum(y) AS BIGINT) AS pos, CAST(count(*) - sum(y) AS BIGINT) AS neg
       FROM sc WHERE p IS NOT NULL GROUP BY model, p)"""
_CV = """cv AS (SELECT d.*, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
              lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg,
              sum(pos) OVER (PARTITION BY model) AS n_pos, sum(neg) OVER (PARTITION BY model) AS n_neg
       FROM d WINDOW w AS (PARTITION BY model ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
_CURVE = f"{_SC}, {_D}, {_CV}"
_AUC = """auc AS (SELECT model,
    sum(CAST(neg AS DOUBLE) * (CAST(cum_pos AS DOUBLE) - CAST(pos AS DOUBLE) / 2))
      / CASE WHEN any_value(n_pos) * any_value(n_neg) <> 0 THEN CAST(any_value(n_pos) AS DOUBLE) * CAST(any_value(n_neg) AS DOUBLE) END AS roc_auc,
    sum(CAST(pos AS DOUBLE) * CAST(cum_pos AS DOUBLE) / CAST(cum_pos + cum_neg AS DOUBLE))
      / CASE WHEN any_value(n_pos) <> 0 THEN CAST(any_value(n_pos) AS DOUBLE) END AS pr_auc
  FROM cv GROUP BY model)"""
_CNT = """cnt AS (SELECT model, count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp, count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp,
       count(*) FILTER (WHERE y = 0 AND yhat = 0) AS tn, count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn FROM sc GROUP BY model)"""
_CM = """cm AS (SELECT model,
    CASE WHEN tp + fp + tn + fn <> 0 THEN CAST(tp + tn AS DOUBLE) / (tp + fp + tn + fn) ELSE 0.0 END AS accuracy,
    CASE WHEN tp + fp <> 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision_phish,
    CASE WHEN tp + fn <> 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall_phish,
    CASE WHEN 2 * tp + fp + fn <> 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1_phish,
    CASE WHEN sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)) <> 0
         THEN (CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn) / sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn))
         ELSE 0.0 END AS mcc, tp, fp, tn, fn FROM cnt)"""
_LL = f"""ll AS (SELECT model, -avg(y * ln(least(greatest(p, {V.LOG_LOSS_EPS}), 1 - {V.LOG_LOSS_EPS}))
                 + (1 - y) * ln(1 - least(greatest(p, {V.LOG_LOSS_EPS}), 1 - {V.LOG_LOSS_EPS}))) AS log_loss FROM sc GROUP BY model)"""
_SUITE = f"""{_CURVE}, {_AUC}, {_CNT}, {_CM}, {_LL},
suite AS (SELECT cm.model, accuracy, precision_phish, recall_phish, f1_phish, roc_auc, pr_auc, mcc, log_loss, tp, fp, tn, fn
          FROM cm JOIN auc USING (model) JOIN ll USING (model)),
ranked AS (SELECT *, row_number() OVER (ORDER BY recall_phish DESC, f1_phish DESC, accuracy DESC, model ASC) AS rank FROM suite)"""
_PTS = """pts AS (SELECT model, NULL::DOUBLE AS threshold, 0.0 AS fpr, 0.0 AS tpr FROM (SELECT DISTINCT model FROM cv)
  UNION ALL
  SELECT model, p, CASE WHEN n_neg <> 0 THEN CAST(cum_neg AS DOUBLE) / n_neg END, CASE WHEN n_pos <> 0 THEN CAST(cum_pos AS DOUBLE) / n_pos END
  FROM cv WHERE (cum_pos = pos AND cum_neg = neg) OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg)"""
_R6 = "round({0}, 6) AS {0}"


def _r(*cols):
    return ", ".join(_R6.format(c) for c in cols)


ORACLE = {
    "confusion": f"""{_SC}, {_CNT} SELECT model, y_true, y_pred, n FROM cnt,
        LATERAL (VALUES (0, 0, tn), (0, 1, fp), (1, 0, fn), (1, 1, tp)) AS t(y_true, y_pred, n)""",
    "class_metrics": f"{_SC}, {_CNT}, {_CM} SELECT model, {_r('accuracy', 'precision_phish', 'recall_phish', 'f1_phish', 'mcc')}, tp, fp, tn, fn FROM cm",
    "roc_auc": f"{_CURVE}, {_AUC} SELECT model, {_r('roc_auc')} FROM auc",
    "pr_auc": f"{_CURVE}, {_AUC} SELECT model, {_r('pr_auc')} FROM auc",
    "log_loss": f"{_SC}, {_LL} SELECT model, {_r('log_loss')} FROM ll",
    "roc_curve": f"{_CURVE}, {_PTS} SELECT model, {_r('threshold', 'fpr', 'tpr')} FROM pts",
    "roc_curve_with_baseline": f"""{_CURVE}, {_PTS} SELECT model, {_r('threshold', 'fpr', 'tpr')} FROM pts
        UNION ALL SELECT 'random', NULL::DOUBLE, 0.0, 0.0 UNION ALL SELECT 'random', NULL::DOUBLE, 1.0, 1.0""",
    "threshold_for_recall": f"""{_CURVE} SELECT model, round(max(p), 6) AS threshold,
        round(arg_max(CAST(cum_pos AS DOUBLE) / n_pos, p), 6) AS tpr,
        round(arg_max(CASE WHEN n_neg <> 0 THEN CAST(cum_neg AS DOUBLE) / n_neg END, p), 6) AS fpr
        FROM cv WHERE n_pos > 0 AND CAST(cum_pos AS DOUBLE) / n_pos >= 0.95 GROUP BY model""",
    "metric_suite": f"""{_SUITE} SELECT model, {_r('accuracy', 'precision_phish', 'recall_phish', 'f1_phish', 'roc_auc',
        'pr_auc', 'mcc', 'log_loss')}, tp, fp, tn, fn FROM suite""",
    "metric_report": f"""{_SUITE} SELECT model, round_even(accuracy * 100, 2) AS accuracy_pct,
        round_even(precision_phish * 100, 2) AS precision_phish_pct, round_even(recall_phish * 100, 2) AS recall_phish_pct,
        round_even(f1_phish * 100, 2) AS f1_phish_pct, round_even(roc_auc, 4) AS roc_auc, round_even(pr_auc, 4) AS pr_auc,
        round_even(mcc, 4) AS mcc, round_even(log_loss, 4) AS log_loss, tp, fp, tn, fn, rank, rank = 1 AS is_best FROM ranked""",
    "model_ranking": f"""{_SUITE} SELECT model, {_r('recall_phish', 'f1_phish', 'accuracy')}, rank, rank = 1 AS is_best FROM ranked""",
    "metric_bars": f"""{_SUITE}, lg AS (UNPIVOT (SELECT model, accuracy, recall_phish, f1_phish, roc_auc FROM suite)
        ON accuracy, recall_phish, f1_phish, roc_auc INTO NAME metric VALUE value)
        SELECT metric, model, round(value, 6) AS value,
               row_number() OVER (PARTITION BY metric ORDER BY value ASC, model ASC) AS position FROM lg""",
    "model_card": f"""{_SUITE}, {_PTS}, np AS (SELECT model, count(*) AS n_roc_points FROM pts GROUP BY model)
        SELECT model, {_r('roc_auc', 'accuracy')}, n_roc_points, CAST(4 AS BIGINT) AS n_confusion_cells, tp, fp, tn, fn
        FROM suite JOIN np USING (model)""",
}
