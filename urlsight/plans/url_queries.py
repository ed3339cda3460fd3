"""Registered queries over URL features."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.url import CHAR_COUNTS, NUMERIC_FEATURES, display_name, with_url_features
from ..sources import tables as T
from . import oracle_views as V

COUNT_COLS = ["url_len", "dom_len", "tld_len", "letter_cnt", "digit_cnt", "special_cnt",
              *CHAR_COUNTS.keys(), "path_len", "query_len"]
PART_COLS = ["host", "path", "query", "is_https", "is_ip", "dom", "tld", "subdom_cnt"]
RATIO_COLS = ["letter_ratio", "digit_ratio", "spec_ratio"]


def scan_pages(spark: SparkSession, d: str) -> DataFrame:
    """Projected scan; html is only measured, never carried."""
    return T.table(spark, d, "pages").select(
        "page_id", "url", F.length("html").cast("long").alias("html_chars"))


def url_parts(spark: SparkSession, d: str) -> DataFrame:
    pages = T.table(spark, d, "pages").select("page_id", "url")
    return with_url_features(pages, keep_parts=True).select("page_id", *PART_COLS)


def url_counts(spark: SparkSession, d: str) -> DataFrame:
    return T.url_features(spark, d).select("page_id", *COUNT_COLS)


def url_ratios(spark: SparkSession, d: str) -> DataFrame:
    return T.url_features(spark, d).select("page_id", *RATIO_COLS)


def url_entropy(spark: SparkSession, d: str) -> DataFrame:
    return T.url_features(spark, d).select("page_id", "entropy")


def url_features(spark: SparkSession, d: str) -> DataFrame:
    return T.url_features(spark, d)


def features_long(spark: SparkSession, d: str) -> DataFrame:
    """(page_id, feature, value) for the 22 numeric features, display name added."""
    uf = T.url_features(spark, d).select(
        "page_id", *[F.col(c).cast("double").alias(c) for c in NUMERIC_FEATURES])
    long = uf.unpivot("page_id", NUMERIC_FEATURES, "feature", "value")
    return long.withColumn("display", display_name(F.col("feature")))


def top_tlds(spark: SparkSession, d: str, k: int = 20) -> DataFrame:
    """G3 (+ minimum slice): TLD frequency top-k with https share and mean entropy.

    Two-stage hash aggregate (partial per partition, tiny final), then
    TakeOrderedAndProject for the top-k.
    """
    uf = T.url_features(spark, d)
    agg = uf.groupBy("tld").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("is_https"), 6).alias("https_share"),
        F.round(F.avg("entropy"), 6).alias("mean_entropy"))
    return agg.orderBy(F.desc("n"), F.asc("tld")).limit(k)


def doc_lexical_features(spark: SparkSession, d: str) -> DataFrame:
    """The same character-level counts, ratios and entropy over whole document texts."""
    from ..functions.url import with_text_features
    docs = T.table(spark, d, "documents").select("doc_id", "text")
    return with_text_features(docs, "text").drop("text")


QUERIES = {
    "scan_pages": scan_pages,
    "doc_lexical_features": doc_lexical_features,
    "url_parts": url_parts,
    "url_counts": url_counts,
    "url_ratios": url_ratios,
    "url_entropy": url_entropy,
    "url_features": url_features,
    "features_long": features_long,
    "top_tlds": top_tlds,
}

_UF = "WITH " + V.url_features_view()

_DISPLAY = ("CASE WHEN starts_with(feature, 'tld_') THEN replace(feature, 'tld_', 'TLD: ') "
            "ELSE array_to_string(list_transform(string_split(replace(feature, '_', ' '), ' '), "
            "lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') END")

_DOCS_LEX = ",\n       ".join(V.lexical_sql("t", "length(t)"))

ORACLE = {
    "doc_lexical_features": f"""SELECT b.*, e.entropy FROM
        (SELECT doc_id, CAST(length(t) AS INTEGER) AS text_len, {_DOCS_LEX}
         FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)) b
        JOIN {V.entropy_sql("documents", "doc_id", "text")} e USING (doc_id)""",
    "scan_pages": "SELECT page_id, url, CAST(length(html) AS BIGINT) AS html_chars FROM pages",
    "url_parts": V.url_parts_sql("pages"),
    "url_counts": f"{_UF} SELECT page_id, {', '.join(COUNT_COLS)} FROM uf",
    "url_ratios": f"{_UF} SELECT page_id, {', '.join(RATIO_COLS)} FROM uf",
    "url_entropy": f"{_UF} SELECT page_id, entropy FROM uf",
    "url_features": f"{_UF} SELECT * FROM uf",
    "features_long": f"""{_UF}, lg AS (UNPIVOT (SELECT page_id, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in NUMERIC_FEATURES)} FROM uf)
        ON {', '.join(NUMERIC_FEATURES)} INTO NAME feature VALUE value)
        SELECT page_id, feature, value, {_DISPLAY} AS display FROM lg""",
    "top_tlds": f"""{_UF} SELECT tld, count(*) AS n, round(avg(is_https), 6) AS https_share,
        round(avg(entropy), 6) AS mean_entropy FROM uf GROUP BY tld ORDER BY n DESC, tld ASC LIMIT 20""",
}
