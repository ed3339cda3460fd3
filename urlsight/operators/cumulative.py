"""Running sums in score order without a one-task window.

A plain ``sum() over (partition by model order by score)`` puts every
distinct score of a model into one task. Here the table of distinct (group,
score) rows is written once to the shared folder and cut into ranges of
(group, score): a group of any size spans as many ranges as it needs, and any
number of small groups share one. Then

1. window sums inside each (range, group): each task holds one range;
2. one row for each (range, group) with its total and first value gives the
   sums of the earlier ranges and the first value of the next one;
3. those rows are joined back by (range, group).

No bound, bucket or group list passes through the driver, and the plan has
the same form at every size; only the number of ranges follows the row count.
"""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

ROWS_PER_RANGE = 2_000_000


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality of the key columns of two tables."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join that keeps the left table's key columns."""
    names = {k: f"__right_{i}" for i, k in enumerate(keys)}
    renamed = right.withColumnsRenamed(names)
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[n]) for k, n in names.items()])
    return left.join(renamed, cond, how).drop(*names.values())


def running_sums(d: DataFrame, groups: str | list[str], score_col: str, value_cols: list[str],
                 descending: bool = True, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Adds ``cum_<v>`` (inclusive running sum in score order), ``next_<v>`` (value of
    the next score, NULL on the last) and ``all_<v>`` (sum over the group) for each value.

    ``d`` must have one row per (group, score): aggregate ties first, which
    also removes any hot-score skew. Groups may be null and of any number.
    """
    groups = [groups] if isinstance(groups, str) else list(groups)
    d = written(d)
    ranges = max(1, math.ceil(d.count() / rows_per_range))
    # the range number is written with the row, so no later job cuts the table anew
    cut = written(d.repartitionByRange(ranges, *groups, score_col).withColumn("_range", F.spark_partition_id()))
    keys = ["_range", *groups]
    way = (lambda c: c.desc()) if descending else (lambda c: c.asc())
    w = Window.partitionBy(*keys).orderBy(way(F.col(score_col)))
    local = cut.select("*", *[F.sum(v).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_in_{v}")
                              for v in value_cols],
                       *[F.lead(v).over(w).alias(f"_after_{v}") for v in value_cols])
    first = F.max_by if descending else F.min_by
    totals = cut.groupBy(*keys).agg(*[F.sum(v).alias(f"_total_{v}") for v in value_cols],
                                    *[first(v, F.col(score_col)).alias(f"_first_{v}") for v in value_cols])
    over = Window.partitionBy(*groups).orderBy(way(F.col("_range")))
    earlier = totals.select(
        *keys, *[F.coalesce(F.sum(f"_total_{v}").over(over.rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0)).alias(f"_before_{v}") for v in value_cols],
        *[F.lead(f"_first_{v}").over(over).alias(f"_next_{v}") for v in value_cols],
        *[F.sum(f"_total_{v}").over(Window.partitionBy(*groups)).alias(f"all_{v}") for v in value_cols])
    j = join_on(local, earlier, keys)
    return j.select(*[F.col(c) for c in d.columns],
                    *[(F.col(f"_in_{v}") + F.col(f"_before_{v}")).alias(f"cum_{v}") for v in value_cols],
                    *[F.coalesce(F.col(f"_after_{v}"), F.col(f"_next_{v}")).alias(f"next_{v}") for v in value_cols],
                    *[F.col(f"all_{v}") for v in value_cols])
