"""Helpers shared by the text operators."""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.tables import table

__all__ = ["batches_of", "bounded_batches", "checked_broadcast", "discard", "free_shuffles", "stage", "table", "with_columns_checked", "word_lists"]


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()`` (survives lost executors) but stays
    columnar and compressed, so later jobs read only the columns they use.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stage_path = path
    return out


def discard(staged: DataFrame) -> None:
    """Deletes the files of a table made by ``stage`` that nothing reads any more."""
    spark = staged.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(staged.stage_path)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def bounded_batches(spark: SparkSession, rows: int = 500) -> None:
    """Whole documents travel in Arrow batches: keep each batch small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete shuffle files that no plan refers to any more.

    It does so when the driver collects its garbage, by itself every half an hour; a loop of large shuffles can't wait.
    """
    spark._jvm.System.gc()


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs inside, then as before."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def with_columns_checked(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so extra or clashing columns of the input never matter."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*names)


def word_lists(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text, in lists from about ``size`` bytes each."""
    if len(text) <= size:
        yield text.split()
        return
    begin = 0
    while begin < len(text):
        end = min(len(text), begin + size)
        while end < len(text) and text[end] not in b"\x20\x09\x0a\x0b\x0c\x0d":
            end += 1
        yield text[begin:end].split()
        begin = end


def checked_broadcast(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """``df``, a slim table, to be broadcast if it has at most ``rows`` rows; else it is joined by a shuffle."""
    staged = stage(df)
    return F.broadcast(staged) if staged.count() <= rows else staged
