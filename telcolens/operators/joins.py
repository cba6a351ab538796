"""Join helpers (C1, C2): attaching subscriber names and per-subscriber parts after aggregation.

Rules the reports follow:
  * facts are aggregated to the join key before any join (no fan-out, map-side partial aggregation);
  * joins are sized by Spark (the static threshold on file statistics, then AQE on actual shuffle
    sizes); beyond the bounds the join stays a shuffle join and AQE splits skewed partitions.
    Building a query runs no job (but for the segment report's checkpoint). Hints appear only where the row count is bounded by construction (a
    top-k key list, the five age-band means);
  * the many-rows side of a join is the left (streamed) side, so a hot key is never buffered and
    AQE skew-join can split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAME_COLUMNS = ("name", "surname")


def attach_names(df: DataFrame, subscribers: DataFrame, key: str = "subscribers_id") -> DataFrame:
    """Left-join subscriber names onto a per-subscriber result; orphan ids keep null names."""
    names = subscribers.select(F.col("subscribers_id").alias(key), *NAME_COLUMNS)
    return df.join(names, key, "left")


def for_each_subscriber(subscribers: DataFrame, *parts: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Every subscriber, left-joined with per-subscriber aggregates (each has one row per id).

    All parts are keyed by ``subscribers_id``; Spark keeps the hash partitioning across the chain,
    so each part is shuffled once and the joins run without further exchanges.
    """
    out = subscribers.select("subscribers_id", *NAME_COLUMNS, *extra)
    for p in parts:
        out = out.join(p, "subscribers_id", "left")
    return out
