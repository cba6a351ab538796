"""Continuous load: new batch files of one table are conformed and appended as they arrive.

This is the batch append (A8) run as a Structured Streaming query: a file source over a landing
folder (rows with a named column subset, as an ``insert`` names its columns), the same conform step
(A3: declared types, defaults only for omitted columns, ``sysdate`` = the micro-batch's load time),
the phone lookup for calls (C4, a stream-static left join), and a Parquet file sink partitioned by
event month for fact tables. The file sink's commit log plus the checkpoint make each landing file
count exactly once, also when an executor or the driver is lost mid-batch.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from telcolens.operators.lookup import LOOKUP_ID, enrich_receiver_phone
from telcolens.session import ensure_checkpoint_dir
from telcolens.sources.load import LOAD_ONLY, MONTH_COLUMN, conform, with_month
from telcolens.sources.schemas import TABLES


def landing_schema(table: str, columns: Sequence[str]) -> T.StructType:
    spec = TABLES[table]
    return T.StructType(
        [T.StructField(c, LOAD_ONLY[c] if c in LOAD_ONLY else spec.column(c).dtype, True) for c in columns]
    )


def ingest_stream(
    spark: SparkSession,
    table: str,
    landing_dir: str,
    columns: Sequence[str],
    fmt: str = "parquet",
    subscribers: DataFrame | None = None,
) -> DataFrame:
    """The conformed stream of one table's landing files (not started)."""
    reader = spark.readStream.schema(landing_schema(table, columns)).format(fmt)
    if fmt == "csv":
        reader = (
            reader.option("header", "true")
            .option("dateFormat", "yyyy-MM-dd")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .option("mode", "FAILFAST")
        )
    raw = reader.load(landing_dir)
    load_ts = F.current_timestamp().cast("timestamp_ntz")  # sysdate: fixed per micro-batch
    out = conform(raw, table, load_ts)
    if LOOKUP_ID in out.columns:
        if subscribers is None:
            raise ValueError("calls with receiver lookups need the subscribers table")
        out = enrich_receiver_phone(out, subscribers).drop(LOOKUP_ID)
    return with_month(out, table)


def start_ingest(
    spark: SparkSession,
    table: str,
    landing_dir: str,
    target_dir: str,
    columns: Sequence[str],
    fmt: str = "parquet",
    checkpoint: str | None = None,
    subscribers: DataFrame | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start appending ``table``'s landing files to ``target_dir``.

    The checkpoint defaults to ``<spark.checkpoint.dir>/ingest/<table>`` (the cluster's shared folder).
    ``available_now`` processes what has landed and stops; otherwise the query keeps running.
    """
    if checkpoint is None:
        checkpoint = os.path.join(ensure_checkpoint_dir(spark), "ingest", table)
    df = ingest_stream(spark, table, landing_dir, columns, fmt, subscribers)
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if TABLES[table].event_time is not None:
        writer = writer.partitionBy(MONTH_COLUMN)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(target_dir)
