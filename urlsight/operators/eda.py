"""Exploratory statistics (G1-G14, P1, P2, P10, T3, W4) as DataFrame jobs.

Design rule: every statistic is an aggregate with a map-side partial step
(count/avg/covar/percentile buffers), so a hot class or a constant feature
never lands in one task. Wide results are built from one aggregated row by
``unpivot``/``explode`` on the driver-free side; no ``Window`` without a
partition key runs over raw rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .cumulative import join_on
from .selection import exact_quantiles, sent

CLASS_NAMES = {0: "Legitimate", 1: "Phishing"}


def class_name(label: Column) -> Column:
    """P10: 0/1 -> display class name."""
    return F.when(label == 1, F.lit(CLASS_NAMES[1])).when(label == 0, F.lit(CLASS_NAMES[0]))


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows with any null (counts are reported by ``null_profile``)."""
    return df.na.drop("any")


def label_domain_violations(df: DataFrame, label_cols: list[str], allowed=(0, 1)) -> DataFrame:
    """One row with the number of rows outside ``allowed`` per label column."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in label_cols:
        aggs.append(F.count_if(F.col(c).isNull() | ~F.col(c).isin(*allowed)).alias(f"{c}_violations"))
    return df.agg(*aggs)


def dataset_kpis(df: DataFrame, feature_cols: list[str], label_col: str = "label") -> DataFrame:
    """G1: row count, feature count and per-class counts in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(feature_cols)).cast("long").alias("n_features"),
        F.count_if(F.col(label_col) == 1).alias("n_phishing"),
        F.count_if(F.col(label_col) == 0).alias("n_legitimate"))


def class_balance(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Class counts and share of total.

    The share uses the total of the (2-row) aggregated table via a cross join
    with its one-row sum, so no unpartitioned window runs over data rows.
    """
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return (counts.crossJoin(F.broadcast(total))
            .select("label", class_name(F.col("label")).alias("class"), "n",
                    F.round(F.col("n") / F.col("total"), 6).alias("share")))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column, one aggregate pass then unpivot."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = row.unpivot("__n", cols, "column", "n_null")
    return long.select("column", F.col("__n").alias("n_rows"), "n_null")


def _pair_sums(k: int, shift: list[float]):
    """Arrow-batch function: per task, the sums of every column pair over the rows where both are set."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        total = np.zeros((4, k, k))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - shift
            here = ~np.isnan(x)
            x = np.where(here, x, 0.0)
            here = here.astype(float)
            # n, sum of a, sum of a squared (rows where b is set too), sum of a times b
            total += np.stack([here.T @ here, x.T @ here, (x * x).T @ here, x.T @ x])
        i, j = np.divmod(np.arange(k * k, dtype=np.int32), np.int32(k))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), *[pa.array(t.ravel()) for t in total]],
                                         ["i", "j", "n", "sa", "saa", "sab"])
    return run


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson matrix in long form (feature_a, feature_b, corr), pairwise complete.

    Every pair uses the rows where both columns are set, as ``DataFrame.corr``
    does in pandas. Each task turns its rows into k x k sums with matrix
    products, and the sums are added up: nothing is cached, and k x k
    rows a task are shuffled. Values are shifted by the column minimum (one plain
    aggregate before). A pair with a constant column gives NULL.
    """
    k = len(cols)
    x = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    least = x.agg(*[F.min(F.nanvl(f"x{i}", F.lit(None).cast("double"))) for i in range(k)]).first()
    sums = x.mapInArrow(_pair_sums(k, [v or 0.0 for v in least]), "i int, j int, n double, sa double, saa double, sab double")
    s = sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "saa", "sab")])
    t = s.select(F.col("i").alias("tj"), F.col("j").alias("ti"), F.col("sa").alias("sb"), F.col("saa").alias("sbb"))
    both = s.join(t, (s.i == t.ti) & (s.j == t.tj))
    n = F.col("n")
    var = lambda q, m: F.when((n > 1) & (F.col(q) - F.col(m) * F.try_divide(F.col(m), n) > 1e-12 * F.col(q)),
                              F.col(q) - F.col(m) * F.try_divide(F.col(m), n))
    corr = (F.col("sab") - F.col("sa") * F.try_divide(F.col("sb"), n)) / F.sqrt(var("saa", "sa") * var("sbb", "sb"))
    corr = F.when(F.col("i") == F.col("j"), F.when(var("saa", "sa").isNotNull(), F.lit(1.0))).otherwise(F.round(corr, 6))
    names = F.array(*[F.lit(c) for c in cols])
    return both.select(F.get(names, F.col("i")).alias("feature_a"), F.get(names, F.col("j")).alias("feature_b"), corr.alias("corr"))


def label_correlation(df: DataFrame, cols: list[str], label_col: str = "label", k: int | None = 15) -> DataFrame:
    """Correlation of each feature with the label, ranked by |corr|."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        y = F.col(label_col).cast("double")
        aggs.append(F.struct(F.lit(c).alias("feature"), F.covar_pop(x, y).alias("cov"),
                             F.stddev_pop(x).alias("sx"), F.stddev_pop(y).alias("sy")).alias(c))
    row = df.agg(*aggs)
    long = row.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("s")).select("s.*")
    corr = F.when(F.col("sx") * F.col("sy") != 0, F.col("cov") / (F.col("sx") * F.col("sy")))
    out = long.select("feature", F.round(corr, 6).alias("corr"))
    out = out.select("feature", "corr", F.abs("corr").alias("abs_corr"),
                     F.when(F.col("corr") > 0, "positive").when(F.col("corr") < 0, "negative")
                     .otherwise("zero").alias("direction"))
    # k rows at most (k << data): a single-partition ordering of the ranked list is fine.
    from pyspark.sql import Window
    w = Window.orderBy(F.desc_nulls_last("abs_corr"), F.asc("feature"))
    out = out.withColumn("rank", F.row_number().over(w).cast("long"))
    return out.where(F.col("rank") <= k) if k else out


def class_means(df: DataFrame, cols: list[str], label_col: str = "label") -> DataFrame:
    """Per-feature class means and phishing/legitimate ratio (0 -> NULL)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs.append(F.struct(
            F.lit(c).alias("feature"),
            F.avg(F.when(F.col(label_col) == 0, x)).alias("mean_legitimate"),
            F.avg(F.when(F.col(label_col) == 1, x)).alias("mean_phishing")).alias(c))
    long = df.agg(*aggs).select(F.explode(F.array(*[F.col(c) for c in cols])).alias("s")).select("s.*")
    ratio = F.when(F.col("mean_legitimate") != 0, F.col("mean_phishing") / F.col("mean_legitimate"))
    return long.select("feature", F.round("mean_legitimate", 6).alias("mean_legitimate"),
                       F.round("mean_phishing", 6).alias("mean_phishing"),
                       F.round(ratio, 2).alias("ratio"))


def to_long(df: DataFrame, cols: list[str], ids: list[str]) -> DataFrame:
    """(ids..., feature, value double) for the given numeric columns."""
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot(ids, cols, "feature", "value")


def describe(df: DataFrame, cols: list[str], exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Count, mean, sample sd, min, linear quartiles, max per feature.

    ``exact`` uses :func:`selection.exact_quantiles` (values are counted, not moved);
    ``exact=False`` uses the ``percentile_approx`` sketch (one pass).
    """
    long = to_long(written(df.select(*cols)) if exact else df, cols, [])
    moments = long.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        *([] if exact else [F.percentile_approx("value", [0.25, 0.5, 0.75], accuracy).alias("q")]))
    if exact:
        q = exact_quantiles(long, ["feature"], [0.25, 0.5, 0.75])
        # one row per feature on each side
        moments = moments.join(q, "feature", "left").select(
            "*", F.array("q0", "q1", "q2").alias("q")).drop("q0", "q1", "q2")
    return moments.select(
        "feature", "count", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"),
        F.round("min", 6).alias("min"), F.round(F.col("q")[0], 6).alias("q25"),
        F.round(F.col("q")[1], 6).alias("q50"), F.round(F.col("q")[2], 6).alias("q75"),
        F.round("max", 6).alias("max"))


def _ranges(long: DataFrame) -> DataFrame:
    return long.groupBy("feature").agg(F.min("value").alias("vmin"), F.max("value").alias("vmax"))


def histogram(df: DataFrame, cols: list[str], label_col: str = "label", bins: int = 60,
              density: bool = False) -> DataFrame:
    """Equal-width bins per feature and class.

    Pass 1 finds min/max per feature (tiny table, broadcast); pass 2 buckets
    with arithmetic and counts with a two-stage aggregate.
    """
    long = to_long(df, cols, [label_col])
    rng = _ranges(long)
    width = (F.col("vmax") - F.col("vmin")) / F.lit(bins)
    b = F.when(F.col("vmax") == F.col("vmin"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("vmin")) / width), F.lit(bins - 1))).cast("int")
    binned = long.where(F.col("value").isNotNull()).join(F.broadcast(rng), "feature") \
        .select("feature", F.col(label_col).alias("label"), b.alias("bin"), "vmin", "vmax")
    counts = binned.groupBy("feature", "label", "bin", "vmin", "vmax").agg(F.count(F.lit(1)).alias("n"))
    w = (F.col("vmax") - F.col("vmin")) / F.lit(bins)
    cols_out = ["feature", "label", "bin",
                F.round(F.col("vmin") + F.col("bin") * w, 6).alias("bin_lo"),
                F.round(F.col("vmin") + (F.col("bin") + 1) * w, 6).alias("bin_hi"), "n"]
    if not density:
        return counts.select(*cols_out)
    totals = counts.groupBy("feature", "label").agg(F.sum("n").alias("n_class"))
    dens = F.when(w > 0, F.col("n") / (F.col("n_class") * w))
    out = join_on(counts, totals, ["feature", "label"]).select(  # a NULL label is a class of its own
        *cols_out, F.round(dens, 6).alias("density"))
    return out


def box_stats(df: DataFrame, cols: list[str], label_col: str = "label") -> DataFrame:
    """Quartiles, 1.5*IQR fences, whisker ends and outlier count per feature and class."""
    long = to_long(written(df.select(label_col, *cols)), cols, [label_col]).withColumnRenamed(label_col, "label")
    q = exact_quantiles(long, ["feature", "label"], [0.25, 0.5, 0.75]).select(
        "feature", "label", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
        .withColumn("lo_fence", F.col("q1") - 1.5 * F.col("iqr")) \
        .withColumn("hi_fence", F.col("q3") + 1.5 * F.col("iqr"))
    # one row a group is sent to the values; a NULL label is a class of its own
    j = join_on(long, sent(q), ["feature", "label"])
    v = F.col("value")
    agg = j.groupBy("feature", "label", "q1", "median", "q3", "iqr", "lo_fence", "hi_fence").agg(
        F.min(F.when(v >= F.col("lo_fence"), v)).alias("whisker_lo"),
        F.max(F.when(v <= F.col("hi_fence"), v)).alias("whisker_hi"),
        F.count_if((v < F.col("lo_fence")) | (v > F.col("hi_fence"))).alias("n_outliers"))
    return agg.select("feature", "label", *[F.round(c, 6).alias(c) for c in
                                            ["q1", "median", "q3", "iqr", "lo_fence", "hi_fence",
                                             "whisker_lo", "whisker_hi"]], "n_outliers")


def label_values(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Distinct label values."""
    return df.select(F.col(label_col).alias("label")).distinct()
