"""Per-URL explanations and attribution summaries.

Per-row work (contribution ranking) is done inside each row with array
functions, so it needs no shuffle; per-feature summaries are two-stage
aggregates over the long attribution table.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.url import display_name
from .encode import qcol

# --- Fixed values that must equal the reference -----------------------------
TLD_SLOT_SCORE = 0.5      # score of an active tld_* column ("magnitude" mode)
MIN_SCORE = 0.001         # contributions below this are not explained
TOP_K = 6                 # contributions shown per URL
SECURITY_TIPS = {
    "is_ip": "This site uses an IP address instead of a domain name — a common phishing indicator.",
    "url_len": "The URL is unusually long — long URLs are often used to hide redirects or payloads.",
    "is_https": "This site does not use HTTPS — modern legitimate sites almost always encrypt traffic.",
    "qm_cnt": "An unusually high number of '?' characters in the URL — often indicates many query parameters carrying malicious payloads.",
    "amp_cnt": "Many '&' characters in the URL — heavy query strings are common in phishing redirects.",
    "eq_cnt": "Many '=' characters in the URL — used to inject script payloads or session hijack tokens.",
    "dot_cnt": "Many dots in the URL — sub-domain abuse is a classic obfuscation technique.",
    "dash_cnt": "Many dashes in the URL — often used to mimic legitimate brand names (e.g., 'paypal-secure-login').",
    "under_cnt": "Many underscores in the URL — uncommon in legitimate domains, often used in obfuscated URLs.",
    "special_cnt": "High number of special characters — typically indicates encoded payloads.",
    "digit_cnt": "High number of digits in the URL — phishing URLs frequently embed numbers to evade filters.",
    "subdom_cnt": "Many sub-domains — attackers stack sub-domains to mimic legitimate organizations.",
    "tld_other": "An unusual or rare top-level domain — many phishing sites use obscure TLDs.",
    "slash_cnt": "Many slashes in the URL — long redirect chains are a hallmark of phishing links.",
    "path_len": "An unusually long path — phishing pages often hide deep inside directory structures.",
    "query_len": "Long query string — frequently used to carry attack payloads.",
    "entropy": "High URL entropy — random-looking character distribution is a known obfuscation signal.",
    "letter_ratio": "Unusual letter ratio — extreme values often indicate obfuscated URLs.",
    "digit_ratio": "High digit ratio — URLs heavy in digits are often machine-generated phishing links.",
    "spec_ratio": "High special-character ratio — encoded payloads and obfuscation.",
}
DEFAULT_TIP = "Unusual value in '{feature}' — review before trusting this site."
SENTENCE = ("{display}", " · value signal ", "{score}", " — ", "{tip}")   # the parts of one sentence
NO_SIGNAL_TEXT = "No single dominant signal — the URL closely matches legitimate patterns."
# ---------------------------------------------------------------------------


def contribution_score(name: str, value: Column) -> Column | None:
    """E1 'magnitude' rule: abs(value); any column starting with 'tld_'
    (including tld_len, Q15) scores 0.5 when positive and is left out otherwise."""
    if name.startswith("tld_"):
        return F.when(value > 0, F.lit(TLD_SLOT_SCORE))
    return F.abs(value).cast("double")


def ranked_contributions(feature_names: list[str], k: int = TOP_K, min_score: float = MIN_SCORE) -> Column:
    """The ``k`` largest contributions of a row (ties keep column order),
    without those below ``min_score``; ranked inside the row, no shuffle."""
    items = []
    for pos, name in enumerate(feature_names):
        v = qcol(name).cast("double")
        s = contribution_score(name, v)
        items.append(F.struct(s.alias("score"), F.lit(-pos).alias("neg_pos"),
                              F.lit(name).alias("feature"), v.alias("value")))
    arr = F.filter(F.array(*items), lambda x: x["score"].isNotNull())
    return F.filter(F.slice(F.sort_array(arr, asc=False), 1, k), lambda x: x["score"] >= F.lit(min_score))


def top_contributions(encoded: DataFrame, feature_names: list[str], key: str, k: int = TOP_K,
                      min_score: float = MIN_SCORE) -> DataFrame:
    """The ranked contributions in long form: key, rank, feature, display, value, score."""
    rows = encoded.select(key, F.posexplode(ranked_contributions(feature_names, k, min_score)).alias("i", "c"))
    return rows.select(key, (F.col("i") + 1).cast("long").alias("rank"), F.col("c.feature").alias("feature"),
                       display_name(F.col("c.feature")).alias("display"), F.col("c.value").alias("value"),
                       F.col("c.score").alias("score"))


def tip_of(feature: Column, value: Column) -> Column:
    """The tip of a contribution from a literal map; the HTTPS tip only without HTTPS (Q16)."""
    tips = F.create_map(*[F.lit(x) for item in SECURITY_TIPS.items() for x in item])
    found = F.when((feature == "is_https") & (value == 1), F.lit(None).cast("string")).otherwise(F.try_element_at(tips, feature))
    return F.coalesce(found, F.replace(F.lit(DEFAULT_TIP), F.lit("{feature}"), feature))


def explained(scored: DataFrame, feature_names: list[str]) -> DataFrame:
    """E1-E3 for rows that carry their features: top trigger and sentence list as columns, all inside the row."""
    def sentence(c: Column) -> Column:
        parts = {"{display}": display_name(c["feature"]), "{score}": F.format_string("%.2f", c["score"]), "{tip}": tip_of(c["feature"], c["value"])}
        return F.concat(*[parts.get(x, F.lit(x)) for x in SENTENCE])

    top = scored.withColumn("__top", ranked_contributions(feature_names))
    text = F.when(F.size("__top") == 0, F.array(F.lit(NO_SIGNAL_TEXT))).otherwise(F.transform("__top", sentence))
    return top.withColumns({"top_trigger": display_name(F.get("__top", F.lit(0))["feature"]), "explanation": text}).drop("__top")


def tips_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SECURITY_TIPS.items()), "feature string, tip string")


def with_tips(contribs: DataFrame, spark: SparkSession) -> DataFrame:
    """Tip per contribution via a broadcast left join (20-row table)
    with the default text for features without one. The HTTPS tip applies
    only when the URL does not use HTTPS (Q16)."""
    tips = F.broadcast(tips_table(spark).withColumnRenamed("feature", "tip_feature"))
    cond = (F.col("feature") == F.col("tip_feature")) & ~((F.col("feature") == "is_https") & (F.col("value") == 1))
    j = contribs.join(tips, cond, "left")
    default = F.replace(F.lit(DEFAULT_TIP), F.lit("{feature}"), F.col("feature"))
    return j.withColumn("tip", F.coalesce(F.col("tip"), default)).drop("tip_feature")


def linear_attribution(df: DataFrame, key: str, features: list[str], coef: dict[str, Column] | None = None,
                       label_col: str = "label") -> DataFrame:
    """E5: exact attribution of a linear model on standardized inputs,
    ``coef_j * (x_j - mean_j) / sd_j`` in long form (row_id, feature, value, attribution).

    Without ``coef`` the coefficients are the per-feature label
    correlations, computed in the same aggregate pass as the means and
    standard deviations (one row, broadcast). Constant features get 0.
    """
    aggs = []
    for c in features:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"__m_{c}"), F.stddev_pop(x).alias(f"__s_{c}")]
        if coef is None:
            y = F.col(label_col).cast("double")
            aggs += [F.covar_pop(x, y).alias(f"__c_{c}"), F.stddev_pop(y).alias(f"__sy_{c}")]
    stats = df.agg(*aggs)
    j = df.select(key, *features).crossJoin(F.broadcast(stats))
    cols = []
    for c in features:
        s = F.col(f"__s_{c}")
        z = F.when(s != 0, (F.col(c) - F.col(f"__m_{c}")) / s)
        if coef is None:
            den = s * F.col(f"__sy_{c}")
            w = F.when(den != 0, F.col(f"__c_{c}") / den)
        else:
            w = coef[c]
        cols.append(F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                             F.coalesce(w * z, F.lit(0.0)).alias("attribution")))
    return j.select(F.col(key).alias("row_id"), F.explode(F.array(*cols)).alias("a")).select(
        "row_id", "a.feature", "a.value", "a.attribution")


def mean_abs_attribution(attr: DataFrame, k: int = 20) -> DataFrame:
    """Mean |attribution| per feature, ranked, top ``k``."""
    agg = attr.groupBy("feature").agg(F.round(F.avg(F.abs("attribution")), 6).alias("mean_abs_attribution"))
    # one row per feature: ordering that small table in one partition is fine
    w = Window.orderBy(F.desc("mean_abs_attribution"), F.asc("feature"))
    ranked = agg.withColumn("rank", F.row_number().over(w).cast("long"))
    return ranked.where(F.col("rank") <= k)


def beeswarm(attr: DataFrame, k: int = 10) -> DataFrame:
    """The attribution points of the ``k`` most important features
    (k-row feature table broadcast into a semi join)."""
    top = mean_abs_attribution(attr, k).select("feature")
    return attr.join(F.broadcast(top), "feature", "left_semi")
