"""Reading tables, shared folders and small numeric helpers of the corpus operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of an Arrow batch that a task holds at once: texts can be long.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Sets the session's Arrow batches to BATCH_ROWS rows at most, because a
    batch of whole texts must fit in a Python worker."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows; and Python workers that find this package where the driver found it (a
    cluster gets it with ``--py-files`` or an installation, as any package)."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``.

    Where that is unset, a local-mode session (tests) gets one of its own; a cluster gets an error,
    because another machine could not read a machine-local folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="telcolens-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    if "://" not in root and not root.startswith("file:"):
        # A path without a scheme is one of the cluster's file system, for Spark and for Python workers alike.
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(root)
        whole = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
        root = root if whole.startswith("file:") else whole
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, readable after any executor is lost."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: str | Column, remainder: int) -> Column:
    """True where crc32(doc_id as text) mod 5 is ``remainder``; a null id is never held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(5)) == remainder, F.lit(False))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def sorted_sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, ascending, and the sums of each value over equal keys."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return (k[at], *(np.add.reduceat(v[order], at) for v in values))


def binary(column: pa.ChunkedArray | pa.Array, dtype) -> list[np.ndarray]:
    """A binary column as arrays of ``dtype``."""
    return [np.frombuffer(x.as_buffer(), dtype) for x in column]


def batches(rows: Iterator[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of at most ``size`` rows."""
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)
