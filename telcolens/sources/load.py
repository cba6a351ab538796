"""Loading (A2), load-time defaults (A3), the phone lookup at load (C4) and batch append.

* A column **omitted** from a batch gets its declared default (the batch's ``load_ts`` for
  ``sysdate`` columns, ``'ACTIVE'`` / ``'UNSOLVED'`` for status columns); a column **present** with a
  null value stays null. Defaults are never applied with ``coalesce``.
* Present columns are cast to the declared types; comments are attached as column metadata.
* Fact tables are appended partitioned by the month of their event time; the reports' windows add
  the month predicate (``timewin.restrict``) next to the timestamp predicate, so they prune.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telcolens.functions.timewin import MONTH_COLUMN, AsOf, month_predicate, ts_lit  # noqa: F401
from telcolens.operators.lookup import LOOKUP_ID, enrich_receiver_phone
from telcolens.sources.schemas import SYSDATE, TABLES

# Columns a batch may carry only for load-time work (dropped after it).
LOAD_ONLY = {LOOKUP_ID: T.LongType()}


def conform(df: DataFrame, table: str, load_ts: AsOf | Column) -> DataFrame:
    """A3: declared column order and types; defaults for omitted columns only.

    ``load_ts`` is the batch's load time: a fixed value, or a column such as the micro-batch time."""
    spec = TABLES[table]
    present = set(df.columns)
    load_col = load_ts if isinstance(load_ts, Column) else ts_lit(load_ts)
    cols: list[Column] = []
    for c in spec.columns:
        meta = {"comment": c.comment} if c.comment else {}
        if c.name in present:
            v = F.col(c.name).cast(c.dtype)
        elif c.default == SYSDATE:
            v = load_col
        elif c.default is not None:
            v = F.lit(c.default).cast(c.dtype)
        else:
            v = F.lit(None).cast(c.dtype)
        cols.append(v.alias(c.name, metadata=meta))
    extra = [F.col(k) for k in LOAD_ONLY if k in present]
    return df.select(*cols, *extra)


def from_rows(
    spark: SparkSession,
    table: str,
    columns: Sequence[str],
    rows: Iterable[Sequence[object]],
    load_ts: AsOf,
) -> DataFrame:
    """A2: literal rows with a named column subset (as an ``insert`` names its columns)."""
    spec = TABLES[table]
    fields = [
        T.StructField(c, LOAD_ONLY[c] if c in LOAD_ONLY else spec.column(c).dtype, True) for c in columns
    ]
    return conform(spark.createDataFrame(list(rows), T.StructType(fields)), table, load_ts)


def read_table(
    spark: SparkSession,
    path: str,
    table: str,
    load_ts: AsOf,
    fmt: str = "parquet",
    columns: Sequence[str] | None = None,
    null_value: str | None = None,
) -> DataFrame:
    """A2: read one table's batch with the declared types (never inferred), then apply A3.

    ``columns`` names the columns the files carry; by default they are taken from the files (footer or
    header), so a column that the files omit gets its default and one that they hold keeps its nulls.
    Values that don't fit the declared type are an error; ``null_value`` is the text that CSV files
    use for null, if any."""
    spec = TABLES[table]
    declared = {c.name: c.dtype for c in spec.columns} | LOAD_ONLY
    if columns is None:
        there = spark.read.option("header", "true").format(fmt).load(path).columns
        # CSV fields go by position, so undeclared ones are read (as text) and dropped.
        names = there if fmt == "csv" else [c for c in there if c in declared]
    else:
        names = list(columns)
    schema = T.StructType([T.StructField(c, declared.get(c, T.StringType()), True) for c in names])
    reader = spark.read.schema(schema)
    if fmt == "csv":
        # H1: dates arrive as 'YYYY-MM-DD' text, times as 'YYYY-MM-DD HH:MM:SS'.
        reader = (
            reader.option("header", "true")
            .option("dateFormat", "yyyy-MM-dd")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .option("mode", "FAILFAST")
        )
        reader = reader if null_value is None else reader.option("nullValue", null_value)
    return conform(reader.format(fmt).load(path), table, load_ts)


def resolve_lookups(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """C4 at load: fill call receivers given as "phone of subscriber k", then drop the lookup id."""
    out = dict(tables)
    calls = out.get("calls")
    if calls is not None and LOOKUP_ID in calls.columns:
        out["calls"] = enrich_receiver_phone(calls, out["subscribers"]).drop(LOOKUP_ID)
    return out


def with_month(df: DataFrame, table: str) -> DataFrame:
    """The partition column of a fact table: first day of the event's month."""
    ts = TABLES[table].event_time
    if ts is None:
        return df
    return df.withColumn(MONTH_COLUMN, F.to_date(F.date_trunc("month", F.col(ts))))


def append(df: DataFrame, table: str, path: str) -> None:
    """One batch append per table; facts are partitioned by event month.

    Rows are rebalanced by month first, so a month gets few files, and a large month several."""
    out = with_month(df, table)
    if TABLES[table].event_time is None:
        out.write.mode("append").parquet(path)
    else:
        out.hint("rebalance", MONTH_COLUMN).write.mode("append").partitionBy(MONTH_COLUMN).parquet(path)


# The subscriber key of every table that carries one (the bucketing column of the co-located layout).
SUBSCRIBER_KEY: dict[str, str] = {
    "subscribers": "subscribers_id",
    "address": "subscribers_id",
    "calls": "caller_id",
    "sms_informations": "sender_id",
    "payments": "subscribers_id",
    "complaints_and_support_requests": "subscribers_id",
    "technical_data": "subscribers_id",
}


def save_bucketed(df: DataFrame, table: str, path: str, buckets: int, name: str | None = None) -> str:
    """Co-located layout: store a subscriber-keyed table as a catalog table bucketed (and sorted) by
    its subscriber column, ``buckets`` the same for every table.

    Reports then aggregate per subscriber and join the per-subscriber parts with no shuffle: the
    bucketed scans already satisfy the hash clustering of the group-bys and joins."""
    key = SUBSCRIBER_KEY[table]
    name = name or table
    (
        df.repartition(buckets, key)  # one file per bucket
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .format("parquet")
        .saveAsTable(name)
    )
    return name
