"""Registered encoding and sampling queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.url import NUMERIC_FEATURES
from ..operators import encode as N
from ..operators import split as K
from ..sources import tables as T
from . import oracle_views as V

FEATS = NUMERIC_FEATURES


def _vocab_list(spark, d, top_n):
    # <= top_n rows: the bounded encoder state
    return [r["tld"] for r in N.tld_vocabulary(T.url_features(spark, d), top_n=top_n).collect()]


def _bucketed(spark, d, top_n):
    uf = T.url_features(spark, d)
    return uf.select("page_id", "tld", N.bucket_tld(F.col("tld"), _vocab_list(spark, d, top_n)).alias("tld_bucket"))


def _semi(spark, d, top_n, anti):
    uf = T.url_features(spark, d)
    return N.in_vocabulary(uf, N.tld_vocabulary(uf, top_n=top_n), anti=anti).select("page_id", "tld")


QUERIES = {
    "tld_vocab": lambda s, d: N.tld_vocabulary(T.url_features(s, d)),
    "tld_bucketed": lambda s, d: _bucketed(s, d, 50),
    "tld_bucketed_top2": lambda s, d: _bucketed(s, d, 2),
    "tld_in_vocab": lambda s, d: _semi(s, d, 2, False),
    "tld_not_in_vocab": lambda s, d: _semi(s, d, 2, True),
    "tld_coverage": lambda s, d: N.coverage(T.url_features(s, d), _vocab_list(s, d, 50)),
    "tld_coverage_top2": lambda s, d: N.coverage(T.url_features(s, d), _vocab_list(s, d, 2)),
    "encoded_features": lambda s, d: N.encoded_long(T.url_features(s, d), _vocab_list(s, d, 50), "page_id"),
    "scaled_features": lambda s, d: N.standardize(T.url_features(s, d), FEATS, ["page_id"]),
    "stratified_split": lambda s, d: K.stratified_split(T.labelled_urls(s, d), "page_id").select(
        "page_id", "label", "split"),
    "doc_stratified_split": lambda s, d: K.stratified_split(T.labelled_docs(s, d), "doc_id").select(
        "doc_id", "label", "split"),
    "hash_sample": lambda s, d: K.hash_sample(T.url_features(s, d), "page_id", 2000).select("page_id", "sample_rank"),
    "background_sample": lambda s, d: K.hash_sample(T.url_features(s, d), "page_id", 100).select(
        "page_id", "sample_rank"),
    "preview": lambda s, d: K.preview(T.table(s, d, "pages").select("page_id", "url"), "page_id", 10),
}

_UF = f"WITH {V.url_features_view()}"


def _vocab_sql(top_n: int) -> str:
    return f"""v AS (SELECT row_number() OVER (ORDER BY n DESC, tld ASC) AS rank, tld, n FROM
        (SELECT coalesce(tld, '') AS tld, count(*) AS n FROM uf GROUP BY 1) ORDER BY n DESC, tld ASC LIMIT {top_n})"""


def _bucket_sql(top_n: int) -> str:
    return f"""{_UF}, {_vocab_sql(top_n)}
SELECT page_id, tld, CASE WHEN coalesce(tld, '') IN (SELECT tld FROM v) THEN coalesce(tld, '') ELSE 'other' END AS tld_bucket
FROM uf"""


def _coverage_sql(top_n: int) -> str:
    return f"""{_UF}, {_vocab_sql(top_n)}
SELECT (SELECT count(*) FROM v) AS vocab_size,
       count(*) FILTER (WHERE coalesce(tld, '') IN (SELECT tld FROM v)) AS covered_rows, count(*) AS total_rows,
       round(count(*) FILTER (WHERE coalesce(tld, '') IN (SELECT tld FROM v)) / count(*), 6) AS coverage FROM uf"""


_POS = ", ".join(f"('{c}', {i})" for i, c in enumerate(FEATS))


def _split_sql(prefix: str, src: str, key: str) -> str:
    return f"""{prefix}
SELECT {key}, label, CASE WHEN rn <= round(0.2 * n) THEN 'test' ELSE 'train' END AS split
FROM (SELECT {key}, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || {key}), {key}) AS rn,
             count(*) OVER (PARTITION BY label) AS n FROM {src})"""


ORACLE = {
    "tld_vocab": f"{_UF}, {_vocab_sql(50)} SELECT * FROM v",
    "tld_bucketed": _bucket_sql(50),
    "tld_bucketed_top2": _bucket_sql(2),
    "tld_in_vocab": f"{_UF}, {_vocab_sql(2)} SELECT page_id, tld FROM uf WHERE coalesce(tld, '') IN (SELECT tld FROM v)",
    "tld_not_in_vocab": f"{_UF}, {_vocab_sql(2)} SELECT page_id, tld FROM uf WHERE coalesce(tld, '') NOT IN (SELECT tld FROM v)",
    "tld_coverage": _coverage_sql(50),
    "tld_coverage_top2": _coverage_sql(2),
    "encoded_features": f"""{_UF}, {_vocab_sql(50)},
pos(feature, pos) AS (VALUES {_POS}),
num AS (UNPIVOT (SELECT page_id, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in FEATS)} FROM uf)
        ON {', '.join(FEATS)} INTO NAME feature VALUE value)
SELECT page_id, CAST(pos AS INTEGER) AS pos, feature, value FROM num JOIN pos USING (feature)
UNION ALL
SELECT page_id, CAST({len(FEATS) - 1} + v.rank AS INTEGER), 'tld_' || v.tld, CAST(coalesce(uf.tld, '') = v.tld AS DOUBLE)
FROM uf CROSS JOIN v
UNION ALL
SELECT page_id, CAST({len(FEATS)} + (SELECT count(*) FROM v) AS INTEGER), 'tld_other',
       CAST(coalesce(tld, '') NOT IN (SELECT tld FROM v) AS DOUBLE) FROM uf""",
    "scaled_features": f"""{_UF} SELECT page_id, {', '.join(
        f'round(CASE WHEN stddev_pop({c}) OVER () <> 0 THEN ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END, 6) AS {c}'
        for c in FEATS)} FROM uf""",
    "stratified_split": _split_sql(f"{_UF}, {V.LABELLED}", "lu", "page_id"),
    "doc_stratified_split": _split_sql(f"WITH {V.labelled_docs_view()}", "ld", "doc_id"),
    "hash_sample": f"""{_UF} SELECT page_id, row_number() OVER (ORDER BY md5('42:' || page_id), page_id) AS sample_rank
        FROM uf ORDER BY sample_rank LIMIT 2000""",
    "background_sample": f"""{_UF} SELECT page_id, row_number() OVER (ORDER BY md5('42:' || page_id), page_id) AS sample_rank
        FROM uf ORDER BY sample_rank LIMIT 100""",
    "preview": "SELECT page_id, url FROM pages ORDER BY page_id LIMIT 10",
}
