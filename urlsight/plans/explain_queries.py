"""Registered scoring-rule and explanation queries."""
from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.url import NUMERIC_FEATURES
from ..operators import encode as N
from ..operators import explain as E
from ..operators import score as S
from ..operators import split as K
from ..operators import zoo as Z
from ..operators.coalitions import BACKGROUND_ROWS, coalition_attribution
from ..sources import tables as T
from . import oracle_views as V
from .encode_queries import ORACLE as ENC_ORACLE
from .encode_queries import _vocab_list

FEATS = NUMERIC_FEATURES


def _verdict_rules(s, d):
    sc = T.scored(s, d)
    return S.with_verdict(sc).select("y", "p", "verdict", "probability", "risk_score", "gauge_position",
                                     "risk_band", "p_safe", "p_phishing", "recommendation")


def _encoded(s, d):
    vocab = _vocab_list(s, d, 50)
    return N.encode(T.url_features(s, d), vocab, keep=["page_id"]), N.feature_names(vocab)


def _top(s, d):
    enc, names = _encoded(s, d)
    return E.top_contributions(enc, names, "page_id")


def _attr(s, d):
    return E.linear_attribution(T.labelled_urls(s, d), "page_id", FEATS)


def _linear_coalitions(s, d):
    """E5 of a linear model (label correlations over standard deviations): explained rows K2, background K3."""
    rows = T.labelled_urls(s, d)
    x = [F.col(c).cast("double") for c in FEATS]
    stats = rows.agg(*[F.covar_pop(c, F.col("label").cast("double")).alias(f"c{i}") for i, c in enumerate(x)],
                     *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(x)], F.stddev_pop("label").alias("sy")).first()    # one row
    coef = [(stats[f"c{i}"] / (stats[f"v{i}"] * stats["sy"])) if stats[f"v{i}"] and stats["sy"] else 0.0 for i in range(len(FEATS))]

    def score(df):
        terms = F.zip_with(vector_to_array("features"), F.array(*[F.lit(float(c)) for c in coef]), lambda a, b: a * b)
        return df.withColumn("value", F.aggregate(terms, F.lit(0.0), lambda a, b: a + b))

    sample, background = (Z.assemble(K.hash_sample(rows, "page_id", n), FEATS, ["page_id"]) for n in (2000, BACKGROUND_ROWS))
    found = coalition_attribution(sample, background, score, "page_id", FEATS, most=128)
    return found.withColumn("attribution", F.round("attribution", 6) + 0.0)


QUERIES = {
    "verdict_rules": _verdict_rules,
    "batch_kpis": lambda s, d: S.batch_kpis(T.scored(s, d)),
    "score_histogram": lambda s, d: S.score_histogram(T.scored(s, d)),
    "top_contributions": lambda s, d: _top(s, d),
    "tip_join": lambda s, d: E.with_tips(_top(s, d), s).select("page_id", "rank", "feature", "display", "score", "tip"),
    "linear_attribution": lambda s, d: _attr(s, d).withColumn("attribution", F.round("attribution", 6)),
    "mean_abs_attribution": lambda s, d: E.mean_abs_attribution(_attr(s, d)),
    "beeswarm": lambda s, d: E.beeswarm(_attr(s, d)).withColumn("attribution", F.round("attribution", 6)),
    "coalition_attribution": _linear_coalitions,
    "class_weights": lambda s, d: Z.with_class_weights(T.labelled_urls(s, d)).select(
        "page_id", "label", "w_balanced", "w_pos"),
}

# ----------------------------------------------------------------- oracle SQL
_SC = f"WITH {V.scored_view()}"
_PROB = "round_even(p * 100, 2)"
_ENC = ENC_ORACLE["encoded_features"]  # long encoded table SELECT (starts with WITH uf ...)


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_TIPS = ", ".join(f"({_sql_str(k)}, {_sql_str(v)})" for k, v in E.SECURITY_TIPS.items())
_DISPLAY = ("CASE WHEN starts_with(feature, 'tld_') THEN replace(feature, 'tld_', 'TLD: ') "
            "ELSE array_to_string(list_transform(string_split(replace(feature, '_', ' '), ' '), "
            "lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') END")
_TOP = f"""enc AS ({_ENC}),
sc AS (SELECT page_id, pos, feature, value,
              CASE WHEN starts_with(feature, 'tld_') THEN CASE WHEN value > 0 THEN 0.5 END ELSE abs(value) END AS score
       FROM enc),
rk AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pos ASC) AS rank FROM sc WHERE score IS NOT NULL),
top AS (SELECT page_id, rank, feature, {_DISPLAY} AS display, value, score FROM rk WHERE rank <= 6 AND score >= 0.001)"""
_ATTR = f"""{V.url_features_view()}, {V.LABELLED},
lg AS (UNPIVOT (SELECT page_id, label, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in FEATS)} FROM lu)
       ON {', '.join(FEATS)} INTO NAME feature VALUE value),
st AS (SELECT feature, avg(value) AS m, stddev_pop(value) AS s, covar_pop(value, label) AS c, stddev_pop(label) AS sy
       FROM lg GROUP BY feature),
attr AS (SELECT page_id AS row_id, lg.feature, value,
                coalesce(CASE WHEN s * sy <> 0 THEN c / (s * sy) END * CASE WHEN s <> 0 THEN (value - m) / s END, 0.0) AS attribution
         FROM lg JOIN st ON lg.feature = st.feature),
mabs AS (SELECT feature, mean_abs_attribution,
                row_number() OVER (ORDER BY mean_abs_attribution DESC, feature ASC) AS rank
         FROM (SELECT feature, round(avg(abs(attribution)), 6) AS mean_abs_attribution FROM attr GROUP BY feature))"""

ORACLE = {
    "verdict_rules": f"""{_SC} SELECT y, p, CASE WHEN p >= 0.5 THEN 'phishing' ELSE 'safe' END AS verdict,
        {_PROB} AS probability, CAST(trunc(p * 100) AS INTEGER) AS risk_score,
        greatest(0, least(100, CAST(trunc(p * 100) AS INTEGER))) AS gauge_position,
        CASE WHEN p < 0.3 THEN 'low' WHEN p < 0.6 THEN 'medium' ELSE 'high' END AS risk_band,
        1 - p AS p_safe, p AS p_phishing,
        CASE WHEN p >= 0.5 THEN {_sql_str(S.RECOMMENDATION_PHISHING)} ELSE {_sql_str(S.RECOMMENDATION_SAFE)} END AS recommendation
        FROM sc""",
    "batch_kpis": f"""{_SC} SELECT count(*) AS n, count(*) FILTER (WHERE p >= 0.5) AS n_phishing,
        count(*) FILTER (WHERE p < 0.5) AS n_safe,
        round(count(*) FILTER (WHERE p >= 0.5) * 100.0 / count(*), 6) AS pct_phishing,
        round(count(*) FILTER (WHERE p < 0.5) * 100.0 / count(*), 6) AS pct_safe,
        round(avg({_PROB}), 6) AS mean_probability FROM sc""",
    "score_histogram": f"""{_SC} SELECT bin, bin * 5.0 AS bin_lo, (bin + 1) * 5.0 AS bin_hi, count(*) AS n FROM
        (SELECT CAST(greatest(0, least(floor({_PROB} / 5.0), 19)) AS INTEGER) AS bin FROM sc WHERE p IS NOT NULL)
        GROUP BY bin""",
    "top_contributions": f"WITH {_TOP} SELECT * FROM top",
    "tip_join": f"""WITH {_TOP}, tips(tip_feature, tip) AS (VALUES {_TIPS})
        SELECT page_id, rank, feature, display, score,
               coalesce(tip, replace({_sql_str(E.DEFAULT_TIP)}, '{{feature}}', feature)) AS tip
        FROM top LEFT JOIN tips ON feature = tip_feature AND NOT (feature = 'is_https' AND value = 1)""",
    "linear_attribution": f"WITH {_ATTR} SELECT row_id, feature, value, round(attribution, 6) AS attribution FROM attr",
    "mean_abs_attribution": f"WITH {_ATTR} SELECT * FROM mabs WHERE rank <= 20",
    "beeswarm": f"""WITH {_ATTR} SELECT row_id, feature, value, round(attribution, 6) AS attribution FROM attr
        WHERE feature IN (SELECT feature FROM mabs WHERE rank <= 10)""",
    "coalition_attribution": f"""WITH {_ATTR},
        ranked AS (SELECT page_id, row_number() OVER (ORDER BY md5('42:' || page_id), page_id) AS r FROM lu),
        bg AS (SELECT feature, avg(value) AS mb FROM lg JOIN ranked USING (page_id) WHERE r <= 100 GROUP BY feature)
        SELECT page_id AS row_id, lg.feature, value,
               round(coalesce(CASE WHEN s * sy <> 0 THEN c / (s * sy) END * (value - mb) / CASE WHEN s <> 0 THEN s END, 0.0), 6) + 0.0 AS attribution
        FROM lg JOIN ranked USING (page_id) JOIN st ON lg.feature = st.feature JOIN bg ON lg.feature = bg.feature WHERE r <= 2000""",
    "class_weights": f"""WITH {V.url_features_view()}, {V.LABELLED},
        c AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total FROM lu GROUP BY label)
        SELECT page_id, label, CAST(total AS DOUBLE) / (2 * n) AS w_balanced,
               CASE WHEN label = 1 THEN 100000.0 / 16600 ELSE 1.0 END AS w_pos
        FROM lu JOIN c USING (label)""",
}
