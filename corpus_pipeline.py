"""The text pipeline: documents -> rules -> classifier -> near-duplicates -> decontamination -> packed bins.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet and read again as the next stage's ``docs``. Stages 1 to 4
drop whole rows and return the columns of ``documents``; the last returns a row for
each piece of a document with its bin.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsight.llm import decontaminate, packing, quality_model, quality_rules, registry, simhash
from urlsight.llm.common import stage, table


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the policy go."""
    return quality_rules.keep(docs, registry.POLICY)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half go. The model learns from the labelled documents of the table."""
    rows = docs.select(F.struct("*").alias("row"), "text")      # whatever the columns are called
    return quality_model.score(rows, registry.quality_classifier(spark, sf_dir)).where("score >= 0.5").select("row.*")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id."""
    return simhash.representatives(docs, registry.SHINGLE_WORDS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining documents, cut into pieces and packed."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("near duplicates", near_duplicates_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None  # the classifier, the fingerprints and the tiling are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir))
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)


QUERIES = {"pipeline": pipeline}
ORACLE: dict[str, str] = {}
