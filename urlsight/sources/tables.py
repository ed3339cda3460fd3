"""Readers for the driver tables and the fixture views built on them.

Each view is a lazy DataFrame over parquet, so Catalyst prunes columns and
pushes filters into the scan. See FIXTURES.md section C for definitions.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.url import with_text_features, with_url_features

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def url_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL features over ``pages.url`` keyed by ``page_id``."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return with_url_features(pages, "url")


def labelled_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url_features`` + an arbitrary label with the class share of the reference."""
    return url_features(spark, sf_dir).withColumn(
        "label", (F.col("page_id") % 7 == 0).cast("int"))


def weak_labelled_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url_features`` + a learnable label (plain http with a query string)."""
    return url_features(spark, sf_dir).withColumn(
        "label", ((F.col("is_https") == 0) & (F.col("query_len") > 0)).cast("int"))


def labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with a supplied toxicity label and lexical features of the whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("int").alias("label"))
    # labels covers a subset of documents; let AQE pick broadcast vs shuffle by size.
    return with_text_features(docs.join(labels, "doc_id", "inner"), "text").drop("text")


# Score columns of the synthetic "models" in the scored long table.
# Each is a deterministic function of lineitem columns with values in [0, 1].
SCORE_MODELS = {
    "quantity": ("l_quantity", 51.0),
    "discount": ("l_discount", 0.1),
    "tax": ("l_tax", 0.08),
}


def scored(spark: SparkSession, sf_dir: str, models: list[str] | None = None) -> DataFrame:
    """A3 long table ``(model, y, p, yhat)`` over ``lineitem`` (no unique key).

    With the default, only the ``quantity`` model (FIXTURES.md ``scored``).
    """
    models = models or ["quantity"]
    li = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_quantity", "l_discount", "l_tax")
    y = (F.col("l_returnflag") == "R").cast("int")
    # One scan for all models: each row fans out to one (model, p) pair per model.
    pairs = F.array(*[F.struct(F.lit(m).alias("model"),
                               (F.col(SCORE_MODELS[m][0]) / F.lit(SCORE_MODELS[m][1])).cast("double").alias("p"))
                      for m in models])
    out = li.select(y.alias("y"), F.explode(pairs).alias("s")).select("s.model", "y", "s.p")
    return out.select("model", "y", "p", (F.col("p") >= 0.5).cast("int").alias("yhat"))


def scored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir, list(SCORE_MODELS))
