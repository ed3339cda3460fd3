"""Verdicts, risk scores and batch KPIs.

All verdict logic is column arithmetic on the probability, so it runs in the
same whole-stage-codegen stage as the model transform that produced it.
"""
from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values that must equal the reference -----------------------------
THRESHOLD = 0.5            # verdict is phishing when p >= THRESHOLD
LOW_BAND_BELOW = 0.3       # p < 0.3 -> low risk
MEDIUM_BAND_BELOW = 0.6    # p < 0.6 -> medium risk, else high
VERDICT_PHISHING = "phishing"
VERDICT_SAFE = "safe"
RECOMMENDATION_PHISHING = ("Do not enter credentials, payment info, or personal data on this site. "
                           "Verify the URL through official channels before interacting.")
RECOMMENDATION_SAFE = ("This URL appears legitimate. Always remain cautious and verify the "
                       "certificate, domain spelling, and content before entering sensitive information.")
# ---------------------------------------------------------------------------


def verdict(p: Column, threshold: float = THRESHOLD) -> Column:
    """P11: 'phishing' when p >= threshold (inclusive), 'safe' below it, NULL without a probability."""
    return F.when(p >= F.lit(threshold), F.lit(VERDICT_PHISHING)).when(p < F.lit(threshold), F.lit(VERDICT_SAFE))


def probability_pct(p: Column) -> Column:
    """Percent with 2 decimals, half-even like NumPy."""
    return F.bround(p * 100, 2)


def risk_score(p: Column) -> Column:
    """Truncated percent of the unrounded probability."""
    return (p * 100).cast("int")


def gauge_position(p: Column) -> Column:
    """Risk score clamped to 0..100."""
    return F.when(p.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(100), risk_score(p))))


def risk_band(p: Column, low: float = LOW_BAND_BELOW, medium: float = MEDIUM_BAND_BELOW) -> Column:
    """Low / medium / high, NULL without a probability."""
    return F.when(p < F.lit(low), F.lit("low")).when(p < F.lit(medium), F.lit("medium")).when(p.isNotNull(), F.lit("high"))


def recommendation(v: Column) -> Column:
    """Advice text per verdict, NULL without one."""
    return F.when(v == F.lit(VERDICT_PHISHING), F.lit(RECOMMENDATION_PHISHING)).when(v.isNotNull(), F.lit(RECOMMENDATION_SAFE))


def with_verdict(df: DataFrame, p_col: str = "p", threshold: float = THRESHOLD) -> DataFrame:
    """P11-P14 + E3 as extra columns.

    Rows without a probability get the verdict of the model's ``prediction``, if
    there is one, and no percent, risk score or band.
    """
    p = F.col(p_col)
    v = verdict(p, threshold)
    if "prediction" in df.columns:
        v = F.coalesce(v, F.when(F.col("prediction") == 1, F.lit(VERDICT_PHISHING)).when(F.col("prediction") == 0, F.lit(VERDICT_SAFE)))
    return df.select("*", v.alias("verdict"), probability_pct(p).alias("probability"),
                     risk_score(p).alias("risk_score"), gauge_position(p).alias("gauge_position"),
                     risk_band(p).alias("risk_band"), (1 - p).alias("p_safe"), p.alias("p_phishing"),
                     recommendation(v).alias("recommendation"))


def class_scores(pred: DataFrame) -> DataFrame:
    """V1/V4: ``p``, the class-1 probability of a fitted model's output, and ``margin``, its ranking score.

    A model without probabilities has ``p`` NULL: its raw margin is no
    probability, and its class is ``prediction``, never a threshold on the margin.
    """
    raw = vector_to_array("rawPrediction")[1] if "rawPrediction" in pred.columns else F.lit(None).cast("double")
    p = vector_to_array("probability")[1] if "probability" in pred.columns else F.lit(None).cast("double")
    return pred.withColumn("p", p).withColumn("margin", raw)


def batch_kpis(scored: DataFrame, p_col: str = "p", threshold: float = THRESHOLD) -> DataFrame:
    """Counts, shares and mean percent probability in one aggregate."""
    p = F.col(p_col)
    n = F.count(F.lit(1))
    n_ph = F.count_if(p >= F.lit(threshold))
    n_safe = F.count_if(p < F.lit(threshold))  # rows without a probability are in n alone
    return scored.agg(
        n.alias("n"), n_ph.alias("n_phishing"), n_safe.alias("n_safe"),
        F.round(F.try_divide(n_ph * 100.0, n), 6).alias("pct_phishing"),
        F.round(F.try_divide(n_safe * 100.0, n), 6).alias("pct_safe"),
        F.round(F.avg(probability_pct(p)), 6).alias("mean_probability"))


def score_histogram(scored: DataFrame, p_col: str = "p", bins: int = 20) -> DataFrame:
    """Equal-width bins of the percent probability over [0, 100]."""
    prob = probability_pct(F.col(p_col))
    width = 100.0 / bins
    b = F.greatest(F.lit(0), F.least(F.floor(prob / F.lit(width)), F.lit(bins - 1))).cast("int")
    agg = scored.where(F.col(p_col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return agg.select("bin", (F.col("bin") * width).alias("bin_lo"), ((F.col("bin") + 1) * width).alias("bin_hi"), "n")
