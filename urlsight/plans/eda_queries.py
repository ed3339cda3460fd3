"""Registered exploratory-statistics queries."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.url import NUMERIC_FEATURES, TEXT_FEATURES
from ..operators import eda
from ..sources import tables as T
from . import oracle_views as V

FEATS = NUMERIC_FEATURES


def _lu(spark, d):
    return T.labelled_urls(spark, d)


def _docs_labels(spark, d) -> DataFrame:
    docs = T.table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(T.table(spark, d, "labels"), "doc_id", "left")


QUERIES = {
    "labelled_urls": lambda s, d: _lu(s, d),
    "label_values": lambda s, d: eda.label_values(_lu(s, d)),
    "label_domain_violations": lambda s, d: eda.label_domain_violations(
        T.table(s, d, "labels"), ["quality", "toxic"]),
    "drop_null_rows": lambda s, d: eda.drop_null_rows(_docs_labels(s, d)),
    "null_profile": lambda s, d: eda.null_profile(_docs_labels(s, d)),
    "dataset_kpis": lambda s, d: eda.dataset_kpis(_lu(s, d), FEATS),
    "class_balance": lambda s, d: eda.class_balance(_lu(s, d)),
    "corr_matrix": lambda s, d: eda.correlation_matrix(_lu(s, d), FEATS + ["label"]),
    "label_correlation": lambda s, d: eda.label_correlation(_lu(s, d), FEATS),
    "class_means": lambda s, d: eda.class_means(_lu(s, d), FEATS),
    "describe": lambda s, d: eda.describe(_lu(s, d), FEATS),
    "feature_histogram": lambda s, d: eda.histogram(_lu(s, d), FEATS, bins=60),
    "feature_density": lambda s, d: eda.histogram(_lu(s, d), FEATS, bins=100, density=True),
    "feature_box": lambda s, d: eda.box_stats(_lu(s, d), FEATS),
    # The same statistics on documents with their supplied toxicity label.
    "doc_label_correlation": lambda s, d: eda.label_correlation(T.labelled_docs(s, d), TEXT_FEATURES),
    "doc_class_means": lambda s, d: eda.class_means(T.labelled_docs(s, d), TEXT_FEATURES),
    "doc_describe": lambda s, d: eda.describe(T.labelled_docs(s, d), TEXT_FEATURES),
    "doc_class_balance": lambda s, d: eda.class_balance(T.labelled_docs(s, d)),
}

# ----------------------------------------------------------------- oracle SQL
_LU = f"WITH {V.url_features_view()}, {V.LABELLED}"
_LD = f"WITH {V.labelled_docs_view()}"


def _long(src: str, feats: list[str], ids: str) -> str:
    sel = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in feats)
    return f"lg AS (UNPIVOT (SELECT {ids}, {sel} FROM {src}) ON {', '.join(feats)} INTO NAME feature VALUE value)"


def _corr(x: str, y: str) -> str:
    return (f"round(CASE WHEN stddev_pop({x}) * stddev_pop({y}) <> 0 THEN covar_pop({x}, {y}) / "
            f"(stddev_pop({x}) * stddev_pop({y})) END, 6)")


def _label_corr(prefix: str, src: str, feats: list[str]) -> str:
    return f"""{prefix}, {_long(src, feats, 'label')},
c AS (SELECT feature, {_corr('value', 'label')} AS corr FROM lg GROUP BY feature)
SELECT feature, corr, abs(corr) AS abs_corr,
       CASE WHEN corr > 0 THEN 'positive' WHEN corr < 0 THEN 'negative' ELSE 'zero' END AS direction, rank
FROM (SELECT *, row_number() OVER (ORDER BY abs(corr) DESC NULLS LAST, feature ASC) AS rank FROM c)
WHERE rank <= 15"""


def _class_means(prefix: str, src: str, feats: list[str]) -> str:
    l0 = "avg(CASE WHEN label = 0 THEN value END)"
    l1 = "avg(CASE WHEN label = 1 THEN value END)"
    return f"""{prefix}, {_long(src, feats, 'label')}
SELECT feature, round({l0}, 6) AS mean_legitimate, round({l1}, 6) AS mean_phishing,
       round(CASE WHEN {l0} <> 0 THEN {l1} / {l0} END, 2) AS ratio FROM lg GROUP BY feature"""


def _describe(prefix: str, src: str, feats: list[str]) -> str:
    return f"""{prefix}, {_long(src, feats, '1 AS one')}
SELECT feature, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q25,
       round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75,
       round(max(value), 6) AS max FROM lg GROUP BY feature"""


def _class_balance(prefix: str, src: str) -> str:
    return f"""{prefix}, c AS (SELECT label, count(*) AS n FROM {src} GROUP BY label)
SELECT label, CASE WHEN label = 1 THEN 'Phishing' WHEN label = 0 THEN 'Legitimate' END AS class, n,
       round(n / sum(n) OVER (), 6) AS share FROM c"""


def _hist(bins: int, density: bool) -> str:
    w = f"((vmax - vmin) / {bins})"
    dens = ""
    if density:
        dens = f""", round(CASE WHEN {w} > 0 THEN n / (sum(n) OVER (PARTITION BY feature, label) * {w}) END, 6) AS density"""
    return f"""{_LU}, {_long('lu', FEATS, 'label')},
r AS (SELECT feature, min(value) AS vmin, max(value) AS vmax FROM lg GROUP BY feature),
bb AS (SELECT lg.feature, label, vmin, vmax,
              CAST(CASE WHEN vmax = vmin THEN 0 ELSE least(floor((value - vmin) / {w}), {bins - 1}) END AS INTEGER) AS bin
       FROM lg JOIN r ON lg.feature = r.feature WHERE value IS NOT NULL),
cnt AS (SELECT feature, label, bin, vmin, vmax, count(*) AS n FROM bb GROUP BY ALL)
SELECT feature, label, bin, round(vmin + bin * {w}, 6) AS bin_lo, round(vmin + (bin + 1) * {w}, 6) AS bin_hi, n{dens}
FROM cnt"""


_NP_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]
_DL = "dl AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"

ORACLE = {
    "labelled_urls": f"{_LU} SELECT * FROM lu",
    "label_values": f"{_LU} SELECT DISTINCT label FROM lu",
    "label_domain_violations": """SELECT count(*) AS n_rows,
        count(*) FILTER (WHERE quality IS NULL OR quality NOT IN (0, 1)) AS quality_violations,
        count(*) FILTER (WHERE toxic IS NULL OR toxic NOT IN (0, 1)) AS toxic_violations FROM labels""",
    "drop_null_rows": f"WITH {_DL} SELECT * FROM dl WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _NP_COLS),
    "null_profile": f"WITH {_DL} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column, count(*) AS n_rows, count(*) - count({c}) AS n_null FROM dl" for c in _NP_COLS),
    "dataset_kpis": f"""{_LU} SELECT count(*) AS n_rows, CAST({len(FEATS)} AS BIGINT) AS n_features,
        count(*) FILTER (WHERE label = 1) AS n_phishing, count(*) FILTER (WHERE label = 0) AS n_legitimate FROM lu""",
    "class_balance": _class_balance(_LU, "lu"),
    "corr_matrix": f"""{_LU}, {_long('lu', FEATS + ['label'], 'page_id')}
        SELECT a.feature AS feature_a, b.feature AS feature_b, {_corr('a.value', 'b.value')} AS corr
        FROM lg a JOIN lg b ON a.page_id = b.page_id GROUP BY a.feature, b.feature""",
    "label_correlation": _label_corr(_LU, "lu", FEATS),
    "class_means": _class_means(_LU, "lu", FEATS),
    "describe": _describe(_LU, "lu", FEATS),
    "feature_histogram": _hist(60, False),
    "feature_density": _hist(100, True),
    "feature_box": f"""{_LU}, {_long('lu', FEATS, 'label')},
        q AS (SELECT feature, label, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                     quantile_cont(value, 0.75) AS q3 FROM lg GROUP BY feature, label),
        f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM q)
        SELECT f.feature, f.label, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
               round(iqr, 6) AS iqr, round(lo_fence, 6) AS lo_fence, round(hi_fence, 6) AS hi_fence,
               round(min(CASE WHEN value >= lo_fence THEN value END), 6) AS whisker_lo,
               round(max(CASE WHEN value <= hi_fence THEN value END), 6) AS whisker_hi,
               count(*) FILTER (WHERE value < lo_fence OR value > hi_fence) AS n_outliers
        FROM lg JOIN f ON lg.feature = f.feature AND lg.label = f.label
        GROUP BY f.feature, f.label, q1, median, q3, iqr, lo_fence, hi_fence""",
    "doc_label_correlation": _label_corr(_LD, "ld", TEXT_FEATURES),
    "doc_class_means": _class_means(_LD, "ld", TEXT_FEATURES),
    "doc_describe": _describe(_LD, "ld", TEXT_FEATURES),
    "doc_class_balance": _class_balance(_LD, "ld"),
}
