"""Latest row per key (E1 / F2), global top-k (F1) and comparison with a group mean."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The first row per ``key`` under ``order`` (e.g. newest first, ties by id).

    ``row_number() = 1`` lets Spark insert a WindowGroupLimit before the shuffle, so each map task
    forwards at most one row per key: a key with a third of all rows still shuffles one row per task.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """the first ``k`` rows under a total order (planned as TakeOrderedAndProject: each task
    keeps its own top ``k``; the limit is the feature of the report)."""
    return df.orderBy(*order).limit(k)


def compare_to_group_mean(
    df: DataFrame,
    group: str,
    value: str,
    mean_name: str,
    flag_name: str,
    fixed_groups: bool = False,
    known: DataFrame | None = None,
) -> DataFrame:
    """Attach the mean of ``value`` over each ``group`` and flag rows strictly above it.

    The mean is a ``groupBy`` with partial aggregation, not a Window: a Window over few groups would
    send every row of a group to one task. ``known`` restricts the means to the group keys of a
    dimension; rows whose group is null or outside it get a null mean and flag. The means are broadcast
    by hint only for ``fixed_groups`` (a fixed label set); else Spark sizes the join, and ``df`` stays
    on the left, where AQE skew-join can split a hot group.

    The flag compares exactly, ``value * n > sum`` in decimals; the mean shown is that sum divided as double.
    """
    # ``df`` feeds both this branch and the join below; Spark reuses its shuffles where the plans agree.
    # A null group's mean never matches in the join.
    means = df.groupBy(group).agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_n"))
    if known is not None:
        means = means.join(known.select(group), group, "left_semi")
    out = df.join(F.broadcast(means) if fixed_groups else means, group, "left")
    mean = F.col("_sum").cast("double") / F.col("_n").cast("double")
    above = F.col(value).cast("decimal(24,2)") * F.col("_n").cast("decimal(14,0)") > F.col("_sum").cast("decimal(38,2)")
    return out.withColumn(mean_name, mean).withColumn(flag_name, above).drop("_sum", "_n")
