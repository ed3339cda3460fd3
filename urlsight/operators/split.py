"""Hash-based splitting and sampling (K1-K4).

Every row gets ``md5('<seed>:<key>')`` as its random order, so the split is
reproducible in Spark and in SQL, survives recomputation after executor
loss, and needs no ``rand()``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_HEX_DIGITS = 4  # 65,536 hash buckets per class


def hash_order(key: Column, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def stratified_split(df: DataFrame, key_col: str, label_col: str = "label", test_fraction: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Per class, the ``round(test_fraction * n_class)`` rows with the
    smallest hash go to 'test', the rest to 'train'. ``key_col`` must be unique.

    No task ever sees a whole class: rows are counted per (class, hash
    bucket) with a partial aggregate; the cumulative count over the bucket
    table (<= 65,536 rows per class) locates the one boundary bucket per
    class; only that bucket's rows are ranked to find the exact threshold
    hash. The final tag is a map-only comparison against a per-class
    threshold table (one row per class, broadcast).
    """
    h = hash_order(F.col(key_col), seed)
    hashed = df.withColumn("_h", h).withColumn(
        "_b", F.conv(F.substring("_h", 1, BUCKET_HEX_DIGITS), 16, 10).cast("int"))
    per_bucket = hashed.groupBy(label_col, "_b").agg(F.count(F.lit(1)).alias("_n"))
    wc = Window.partitionBy(label_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    per_bucket = (per_bucket
                  .withColumn("_cum", F.sum("_n").over(wc))
                  .withColumn("_tot", F.sum("_n").over(Window.partitionBy(label_col)))
                  .withColumn("_k", F.round(F.col("_tot") * F.lit(test_fraction)).cast("long")))
    before = F.col("_cum") - F.col("_n")
    boundary = per_bucket.where((before < F.col("_k")) & (F.col("_k") <= F.col("_cum"))) \
        .select(label_col, "_b", (F.col("_k") - before).alias("_r"))
    in_boundary = hashed.select(label_col, "_b", "_h", key_col).join(F.broadcast(boundary), [label_col, "_b"])
    wr = Window.partitionBy(label_col).orderBy("_h", key_col)
    thresholds = (in_boundary.withColumn("_rn", F.row_number().over(wr))
                  .where(F.col("_rn") == F.col("_r")).select(label_col, F.col("_h").alias("_th")))
    tagged = hashed.join(F.broadcast(thresholds), label_col, "left")
    is_test = F.coalesce(F.col("_h") <= F.col("_th"), F.lit(False))
    return tagged.withColumn("split", F.when(is_test, "test").otherwise("train")).drop("_h", "_b", "_th")


def hash_sample(df: DataFrame, key_col: str, n: int = 2000, seed: int = 42) -> DataFrame:
    """K2/K3: the ``n`` rows with the smallest hash (top-k, no full sort).

    ``TakeOrderedAndProject`` keeps at most ``n`` rows per partition; the
    rank is numbered on the <= n survivors.
    """
    h = hash_order(F.col(key_col), seed)
    top = df.withColumn("_h", h).orderBy("_h", key_col).limit(n)
    w = Window.orderBy("_h", key_col)
    return top.withColumn("sample_rank", F.row_number().over(w).cast("long")).drop("_h")


def preview(df: DataFrame, order_col: str, n: int = 10) -> DataFrame:
    """K4: first ``n`` rows in key order."""
    return df.orderBy(order_col).limit(n)
