"""Ordered text roll-up per key (e.g. all SMS contents of a subscriber, oldest first).

Two phases keep a heavy key spread over many tasks: first per (key, time bucket), then per key over
the bucket strings. Buckets are truncations of the leading order column, so concatenating bucket
strings in bucket order equals one ordered concatenation. Nulls are skipped, as in ``listagg``.

``ordered_concat_rows`` bounds a part by rows instead: it numbers a key's rows in order without bringing them together, by counts of
nested time buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_concat_parts(
    df: DataFrame,
    key: str,
    text: str,
    time_col: str,
    tie_col: str,
    out_text: str,
    out_count: str,
    sep: str = "; ",
    bucket_unit: str = "hour",
    part_col: str = "part_start",
) -> DataFrame:
    """Phase 1: per (``key``, time bucket): the bucket start (``part_col``, timestamp_ntz), the row
    count and the non-null ``text`` joined by ``sep`` in (``time_col``, ``tie_col``) order.

    Reading a key's parts in ``part_col`` order gives its whole ordered text; no part holds more than
    one bucket of one key, so even a key with a third of all rows is spread over many groups."""
    sep_sql = sep.replace("'", "''")
    return (
        df.select(key, text, time_col, tie_col)
        .withColumn(part_col, F.date_trunc(bucket_unit, F.col(time_col)).cast("timestamp_ntz"))
        .groupBy(key, part_col)
        .agg(
            F.count(F.lit(1)).alias(out_count),
            F.expr(
                f"listagg({text}, '{sep_sql}') WITHIN GROUP "
                f"(ORDER BY {time_col} ASC NULLS FIRST, {tie_col} ASC NULLS FIRST)"
            ).alias(out_text),
        )
    )


def ordered_concat(
    df: DataFrame,
    key: str,
    text: str,
    time_col: str,
    tie_col: str,
    out_text: str,
    out_count: str,
    sep: str = "; ",
    bucket_unit: str = "hour",
) -> DataFrame:
    """Per ``key``: ``out_count`` rows and their non-null ``text`` joined by ``sep`` in
    (``time_col``, ``tie_col``) order -- phase 1, then one concatenation of the bucket strings."""
    sep_sql = sep.replace("'", "''")
    parts = ordered_concat_parts(df, key, text, time_col, tie_col, "_part", "_n", sep, bucket_unit, "_bucket")
    return parts.groupBy(key).agg(
        F.sum("_n").cast("bigint").alias(out_count),
        F.expr(f"listagg(_part, '{sep_sql}') WITHIN GROUP (ORDER BY _bucket ASC NULLS FIRST)").alias(out_text),
    )


# Before any time: the bucket of rows without one, which come first.
NO_TIME = "TIMESTAMP_NTZ '0001-01-01 00:00:00'"


def running_count(df: DataFrame, key: str, time_col: str, tie_col: str, out: str) -> DataFrame:
    """``df`` with the number (from 0) of each row among its ``key``'s rows in (time, tie) order, nulls first.

    A key's rows never meet: rows are counted by (key, second) with map-side partial sums; a running sum over the seconds of an hour (at
    most 3,601 rows a group) and one over the hours of a key (one row for each hour with data) say how many rows come before
    a second; and only rows of one key and second are numbered next to each other. The rows are shuffled once, by (key, second), which
    serves the numbering and the join with the counts. Null keys are a key of their own."""
    time = F.coalesce(F.col(time_col).cast("timestamp_ntz"), F.expr(NO_TIME))
    second, hour = F.date_trunc("second", time).cast("timestamp_ntz"), F.date_trunc("hour", F.col("_second")).cast("timestamp_ntz")
    own = df.withColumn("_second", second)
    seconds = own.groupBy(key, "_second").agg(F.count(F.lit(1)).alias("_n")).withColumn("_hour", hour)
    hours = seconds.groupBy(key, "_hour").agg(F.sum("_n").alias("_n"))

    def before(*by: str, order: str) -> Column:
        rows = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(rows), F.lit(0))

    hours = hours.select(F.col(key).alias("_key"), F.col("_hour").alias("_of"), before(key, order="_hour").alias("_before_hour"))
    seconds = seconds.withColumn("_in_hour", before(key, "_hour", order="_second"))
    seconds = seconds.join(hours, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_hour") == F.col("_of")))
    starts = seconds.select(F.col(key).alias("_key"), F.col("_second").alias("_at"), (F.col("_before_hour") + F.col("_in_hour")).alias("_start"))
    order = Window.partitionBy(key, "_second").orderBy(F.col(time_col).asc_nulls_first(), F.col(tie_col).asc_nulls_first())
    numbered = own.withColumn("_place", F.row_number().over(order) - 1)
    joined = numbered.join(starts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_second") == F.col("_at")))
    return joined.select(*df.columns, (F.col("_start") + F.col("_place")).cast("long").alias(out))


def ordered_concat_rows(
    df: DataFrame,
    key: str,
    text: str,
    time_col: str,
    tie_col: str,
    out_text: str,
    out_count: str,
    rows: int,
    sep: str = "; ",
    part_col: str = "part_no",
) -> DataFrame:
    """Per (``key``, ``part_col`` from 0): the text of the key's next ``rows`` rows (the last part: the rest), whatever their times,
    so a part is bounded by rows even where a third of all rows are one key's in one hour. Reading the parts in order gives the whole text."""
    sep_sql = sep.replace("'", "''")
    numbered = running_count(df.select(key, text, time_col, tie_col), key, time_col, tie_col, "_number")
    return (
        numbered.withColumn(part_col, F.floor(F.col("_number") / rows).cast("long"))
        .groupBy(key, part_col)
        .agg(
            F.count(F.lit(1)).alias(out_count),
            F.expr(f"listagg({text}, '{sep_sql}') WITHIN GROUP (ORDER BY _number)").alias(out_text),
        )
    )
