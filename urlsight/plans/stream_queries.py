"""Registered streaming queries."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import tables as T
from ..streaming import stream as Z
from .model_queries import _LEARNED, _UF, _fitted, agrees


def stream_score_rows(spark: SparkSession, d: str) -> DataFrame:
    """Pages as a file stream -> features -> model -> verdicts, drained
    with availableNow into a parquet sink under the checkpoint folder."""
    fm, _, _ = _fitted(spark, d, "LogisticRegression")
    urls = Z.stream_table(spark, d, "pages").select("page_id", "url")
    scored = Z.score_stream(urls, fm, ["page_id", "url"])
    sink, ckpt = Z._scratch(spark, "stream_score"), Z._scratch(spark, "stream_score-ckpt")
    Z.run_available_now(scored, sink, ckpt)
    return spark.read.parquet(sink)


def stream_score(spark: SparkSession, d: str) -> DataFrame:
    return stream_score_rows(spark, d).select("page_id", "url", "verdict", agrees().alias("agrees"))


# The events of a table span one month, in any order.
DISORDER = "31 days"

QUERIES = {
    "windowed_verdicts": lambda s, d: Z.windowed_verdicts(T.table(s, d, "events")),
    "windowed_verdicts_stream": lambda s, d: Z.windowed_verdicts_stream(s, d, DISORDER),
    # hours instead of a month: late rows are kept
    "windowed_verdicts_late": lambda s, d: Z.windowed_verdicts_keeping_late(s, d, "1 hour").drop("n_late"),
    "stream_score": stream_score,
    "stream_score_rows": stream_score_rows,
}

_WINDOWED_SQL = """SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
        CASE WHEN least(value / 100.0, 1.0) >= 0.5 THEN 'phishing' ELSE 'safe' END AS verdict, count(*) AS n
        FROM events GROUP BY ALL"""

ORACLE = {
    "stream_score": f"{_UF} SELECT page_id, url, {_LEARNED}, true AS agrees FROM uf",
    "windowed_verdicts": _WINDOWED_SQL,
    # the update-mode stream ends in the same state as the batch twin
    "windowed_verdicts_stream": _WINDOWED_SQL,
    "windowed_verdicts_late": _WINDOWED_SQL,
}
