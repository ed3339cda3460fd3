"""Order statistics by repeated histograms: values are counted, never sorted, ranged or moved.

Every wanted rank starts with the interval from the smallest to the largest
value of its group. A pass counts the values of all open intervals in ``BINS``
bins, with the smallest and largest value of each, and a rank goes on in the bin that
holds it; it is found when that bin holds one value. Only bin counts cross the network. Passes
divide an interval evenly and by magnitude in turn, so the number of
passes is bounded by the bits of a double, whatever the values; two or three are usual.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .cumulative import join_on

BINS = 4096
SENT_ROWS = 100_000      # rows of a table that is sent to every task, at most


def sent(df: DataFrame, rows: int = SENT_ROWS) -> DataFrame:
    """``df``, written; to be broadcast if it has at most ``rows`` rows, else joined as Spark sees fit."""
    table = written(df)
    return F.broadcast(table) if table.count() <= rows else table


def _place(v: Column, lo: Column, hi: Column, even: bool) -> Column:
    """The bin of a value between ``lo`` and ``hi``: by its distance from ``lo``, or by that of its magnitude."""
    def size(x: Column) -> Column:
        return F.when(x == 0, F.lit(0.0)).otherwise(F.signum(x) * F.least(F.log2(F.abs(x)) + 1075, F.lit(2101.0)))     # infinity above all

    # halves, so that no difference overflows
    a, b, c = (v / 2, lo / 2, hi / 2) if even else (size(v), size(lo), size(hi))
    share = F.when(c > b, (a - b) / (c - b)).otherwise(F.lit(0.0))
    return F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")


def exact_quantiles(long: DataFrame, group_cols: list[str], probs: list[float]) -> DataFrame:
    """Exact linear-interpolated quantiles (numpy 'linear', SQL quantile_cont) of ``value`` for each group.

    ``long`` is scanned once a pass: give a written table. NULL values don't count, NaN is above all numbers, and
    groups (NULL is one) may be of any number. Output: group columns + ``q0, q1, ...`` (one column per prob).
    """
    value, nan = F.col("value"), F.isnan("value")
    rows = long.where("value IS NOT NULL").select(*group_cols, "value")
    spans = rows.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"), F.count_if(~nan).alias("_m"),
                                          F.min(F.when(~nan, value)).alias("lo"), F.max(F.when(~nan, value)).alias("hi"))
    places = F.array(*[F.struct(F.lit(2 * i + up).alias("place"), F.least(F.floor((F.col("_n") - 1) * F.lit(float(q))) + up, F.col("_n") - 1).cast("long").alias("rank"))
                       for i, q in enumerate(probs) for up in (0, 1)])
    wanted = spans.select(*group_cols, "_n", "_m", "lo", "hi", F.explode(places).alias("w")).select(
        *group_cols, "_n", "lo", "hi", "w.place", "w.rank", F.lit(0).cast("long").alias("below"),
        F.when(F.col("w.rank") >= F.col("_m"), F.lit(float("nan"))).when(F.col("lo") == F.col("hi"), F.col("lo")).alias("found"))
    wanted, even = written(wanted), True
    while wanted.where("found IS NULL").limit(1).count():
        open_ = wanted.where("found IS NULL")
        intervals = sent(open_.groupBy(*group_cols).agg(F.collect_set(F.struct("lo", "hi")).alias("spans")))     # two for each prob at most
        inside = join_on(rows.where(~nan), intervals, group_cols).select(*group_cols, "value", F.explode("spans").alias("s")).select(*group_cols, "value", "s.*") \
            .where((value >= F.col("lo")) & (value <= F.col("hi")))
        bins = inside.groupBy(*group_cols, "lo", "hi", _place(value, F.col("lo"), F.col("hi"), even).alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
        keys = [*group_cols, "lo", "hi"]
        over = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)      # BINS rows at most
        counted = written(bins.select(*keys, "n", "least", "most", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before")))
        met = join_on(open_, counted, keys).where((F.col("rank") >= F.col("below") + F.col("before")) & (F.col("rank") < F.col("below") + F.col("before") + F.col("n")))
        closer = met.select(*group_cols, "_n", F.col("least").alias("lo"), F.col("most").alias("hi"), "place", "rank",
                            (F.col("below") + F.col("before")).alias("below"), F.when(F.col("least") == F.col("most"), F.col("least")).alias("found"))
        wanted, even = written(wanted.where("found IS NOT NULL").unionByName(closer)), not even
    picked = wanted.groupBy(*group_cols).agg(F.first("_n").alias("_n"), *[F.max(F.when(F.col("place") == j, F.col("found"))).alias(f"_v{j}") for j in range(2 * len(probs))])
    out = []
    for i, q in enumerate(probs):
        h = (F.col("_n") - 1) * F.lit(float(q))
        low, high = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}")
        out.append(F.when((h == F.floor(h)) | (low == high), low).otherwise(low + (h - F.floor(h)) * (high - low)).alias(f"q{i}"))
    return picked.select(*group_cols, *out)
