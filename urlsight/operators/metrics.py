"""Classification metrics as DataFrame queries.

Input: the scored long table ``(model, y, p, yhat)``. Everything is grouped
by ``model``; scores are first collapsed to one row per (model, score)
with a partial aggregate, so a hot score or a class with a third of all
rows costs one row, and the ordered work runs on the distinct-score table
through :func:`cumulative.running_sums` (ranges, no one-task window).
Rows without a score or a class are refused by :func:`unscored`, not dropped.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cumulative import ROWS_PER_RANGE, running_sums

LOG_LOSS_EPS = 2.220446049250313e-16  # float64 machine epsilon (clip for log loss)


def unscored(scored: DataFrame) -> DataFrame:
    """Rows per model that no ordered metric can use (NULL score or class); one row per model."""
    return scored.groupBy("model").agg(F.count_if(F.col("p").isNull()).alias("n_null_score"),
                                       F.count_if(F.col("y").isNull()).alias("n_null_class"))


def _present(column: str):
    """The column, or an error that names it when a row holds NULL there."""
    return F.coalesce(F.col(column), F.raise_error(F.lit(f"scored rows hold NULL in {column}; see unscored()"))
                      .cast("double" if column == "p" else "int"))


def score_table(scored: DataFrame) -> DataFrame:
    """(model, p, pos, neg): one row per distinct score. A NULL score or class is an error."""
    rows = scored.select("model", _present("p").alias("p"), _present("y").alias("y"))
    return rows.groupBy("model", "p").agg(
        F.sum("y").cast("long").alias("pos"), (F.count(F.lit(1)) - F.sum("y")).cast("long").alias("neg"))


def curve(scored: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Distinct scores in descending order with running TP/FP and class totals."""
    c = running_sums(score_table(scored), "model", "p", ["pos", "neg"], descending=True, rows_per_range=rows_per_range)
    return c.withColumnsRenamed({"all_pos": "n_pos", "all_neg": "n_neg"})


def confusion_counts(scored: DataFrame) -> DataFrame:
    """V5: tp/fp/tn/fn per model (zero cells included), one aggregate pass."""
    y, yh = F.col("y"), F.col("yhat")
    return scored.groupBy("model").agg(
        F.count_if((y == 1) & (yh == 1)).alias("tp"), F.count_if((y == 0) & (yh == 1)).alias("fp"),
        F.count_if((y == 0) & (yh == 0)).alias("tn"), F.count_if((y == 1) & (yh == 0)).alias("fn"))


def confusion_long(scored: DataFrame) -> DataFrame:
    """Confusion matrix as (model, y_true, y_pred, n)."""
    c = confusion_counts(scored)
    cells = F.array(*[F.struct(F.lit(t).alias("y_true"), F.lit(p).alias("y_pred"), F.col(n).alias("n"))
                      for t, p, n in [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]])
    return c.select("model", F.explode(cells).alias("c")).select("model", "c.*")


def _ratio(num, den):
    return F.when(den != 0, num / den).otherwise(F.lit(0.0))


def class_metrics_from_counts(c: DataFrame) -> DataFrame:
    """V6-V9, V12 from the four counts (double arithmetic, 0 on zero division)."""
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    mcc_den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return c.select(
        "model",
        _ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision_phish"),
        _ratio(tp, tp + fn).alias("recall_phish"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_phish"),
        _ratio(tp * tn - fp * fn, mcc_den).alias("mcc"),
        "tp", "fp", "tn", "fn")


def auc_metrics(cv: DataFrame) -> DataFrame:
    """V10 (ROC-AUC, ties count half) and V11 (average precision) per model."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    ctp, cfp = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    P, N = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    return cv.groupBy("model").agg(
        (F.sum(neg * (ctp - pos / 2)) / F.when(F.first(P) * F.first(N) != 0, F.first(P) * F.first(N))).alias("roc_auc"),
        (F.sum(pos * ctp / (ctp + cfp)) / F.when(F.first(P) != 0, F.first(P))).alias("pr_auc"))


def log_loss(scored: DataFrame, eps: float = LOG_LOSS_EPS) -> DataFrame:
    """Mean binary cross-entropy with p clipped to [eps, 1 - eps]. A NULL score or class is an error."""
    p = F.least(F.greatest(_present("p"), F.lit(eps)), F.lit(1 - eps))
    y = _present("y").cast("double")
    return scored.groupBy("model").agg((-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"))


def roc_points(cv: DataFrame, drop_intermediate: bool = True) -> DataFrame:
    """ROC curve (model, threshold, fpr, tpr) with the origin point.

    A point is dropped when both neighbours are collinear with it along the
    fp and tp axes (second differences 0), which on the distinct-score
    table means: the next score has the same (pos, neg) counts as this one.
    The origin row has a NULL threshold (the reference uses +inf).
    """
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    last = F.col("next_pos").isNull()
    keep = first | last | (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    pts = cv.where(keep) if drop_intermediate else cv
    fpr = F.when(F.col("n_neg") != 0, F.col("cum_neg") / F.col("n_neg"))
    tpr = F.when(F.col("n_pos") != 0, F.col("cum_pos") / F.col("n_pos"))
    body = pts.select("model", F.col("p").alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr"))
    # the row where the running sums begin: one for each model, without another pass over the scores
    origin = cv.where(first).select(
        "model", F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(body)


def random_baseline(spark: SparkSession) -> DataFrame:
    """The diagonal of a random classifier as two rows."""
    return spark.range(2).select(F.lit("random").alias("model"), F.lit(None).cast("double").alias("threshold"),
                                 F.col("id").cast("double").alias("fpr"), F.col("id").cast("double").alias("tpr"))


def threshold_for_recall(cv: DataFrame, target: float = 0.95) -> DataFrame:
    """Z3: the highest score threshold whose recall reaches ``target``."""
    tpr = F.col("cum_pos") / F.col("n_pos")
    ok = cv.where((F.col("n_pos") > 0) & (tpr >= F.lit(target)))
    return ok.groupBy("model").agg(
        F.max("p").alias("threshold"),
        F.max_by(tpr, F.col("p")).alias("tpr"),
        F.max_by(F.col("cum_neg") / F.when(F.col("n_neg") != 0, F.col("n_neg")), F.col("p")).alias("fpr"))


def metric_suite(scored: DataFrame, rows_per_range: int = ROWS_PER_RANGE, cv: DataFrame | None = None) -> DataFrame:
    """One row per model with the full metric set (A4 without train time).

    ``cv``: the curve of the same rows, if it is there already.
    """
    cm = class_metrics_from_counts(confusion_counts(scored))
    auc = auc_metrics(curve(scored, rows_per_range) if cv is None else cv)
    ll = log_loss(scored)
    return cm.join(auc, "model").join(ll, "model").select(
        "model", "accuracy", "precision_phish", "recall_phish", "f1_phish", "roc_auc", "pr_auc",
        "mcc", "log_loss", "tp", "fp", "tn", "fn")


RATE_METRICS = ["accuracy", "precision_phish", "recall_phish", "f1_phish"]
SCORE_METRICS = ["roc_auc", "pr_auc", "mcc", "log_loss"]


def rank_models(metrics: DataFrame) -> DataFrame:
    """Recall desc, F1 desc, accuracy desc (model name breaks ties)."""
    from pyspark.sql import Window
    # one row per model: a single ordered partition of that small table is fine
    w = Window.orderBy(F.desc("recall_phish"), F.desc("f1_phish"), F.desc("accuracy"), F.asc("model"))
    return metrics.withColumn("rank", F.row_number().over(w).cast("long")) \
        .withColumn("is_best", F.col("rank") == 1)


def metric_report(metrics: DataFrame) -> DataFrame:
    """Display scaling (percent, 2 dp; scores 4 dp) and best flag."""
    ranked = rank_models(metrics)
    return ranked.select(
        "model", *[F.bround(F.col(c) * 100, 2).alias(f"{c}_pct") for c in RATE_METRICS],
        *[F.bround(c, 4).alias(c) for c in SCORE_METRICS], "tp", "fp", "tn", "fn", "rank", "is_best")


def metric_bars(metrics: DataFrame, names: tuple = ("accuracy", "recall_phish", "f1_phish", "roc_auc")) -> DataFrame:
    """Models ascending by each metric."""
    from pyspark.sql import Window
    long = metrics.select("model", *[F.col(c).cast("double") for c in names]).unpivot(
        "model", list(names), "metric", "value")
    w = Window.partitionBy("metric").orderBy(F.asc("value"), F.asc("model"))
    return long.select("metric", "model", F.round("value", 6).alias("value"),
                       F.row_number().over(w).cast("long").alias("position"))
