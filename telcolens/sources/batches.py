"""A batch of several tables is visible as a whole or not at all.

A batch writes each of its tables into a folder of its own below ``<root>/<table>`` and then commits by one manifest file below
``<root>/_commits``, which names these folders. Readers read the folders that manifests name and no others, so a batch that failed between two tables,
at any point before its manifest, leaves nothing behind that a reader sees. The manifest is written under another name and renamed, which is atomic and
fails where the name is taken: of two attempts at one batch id, one is committed, and a batch that is sent again changes nothing.

Facts are partitioned by event month below their batch, as ``load.append`` writes them, so windows prune (``timewin.restrict``). A manifest
is a few hundred bytes; readers list them on the driver, one a batch. ``vacuum`` removes folders of attempts that no manifest names.

``check_batch`` holds a batch's keys against all committed batches. A committed folder's key filter is written once, from its key columns, below
``<root>/_keys`` under the folder's name; a filter that is lost or was never written is made again from the folder.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from telcolens.functions.timewin import MONTH_COLUMN
from telcolens.operators import key_filters
from telcolens.sources.load import with_month
from telcolens.sources.schemas import TABLES

COMMITS = "_commits"
KEYS = "_keys"
BATCH_COLUMN = "batch"


def _hadoop(spark: SparkSession, path: str):
    """The file system of ``path`` as Spark resolves it, and the path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _hadoop(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file that appears whole; False where there is one already."""
    jvm = spark.sparkContext._jvm
    folder, name = path.rsplit("/", 1)
    fs, temporary = _hadoop(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    fs.mkdirs(_hadoop(spark, folder)[1])
    stream = fs.create(temporary, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    target = _hadoop(spark, path)[1]
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:  # without the option to overwrite
        context.rename(temporary, target, options)
    except Exception:
        fs.delete(temporary, False)
        if fs.exists(target):
            return False
        raise
    return True


def _check_id(batch_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id) or batch_id.startswith("."):
        raise ValueError(f"a batch id has letters, digits, '_', '-' and '.', and begins with no '.': {batch_id!r}")
    return batch_id


def committed(spark: SparkSession, root: str) -> dict[str, dict[str, str]]:
    """Batch id -> table -> folder name, of all committed batches."""
    names = [n for n in _names(spark, f"{root}/{COMMITS}") if n.endswith(".json") and not n.startswith(".")]
    return {n.removesuffix(".json"): json.loads(_read_text(spark, f"{root}/{COMMITS}/{n}")) for n in names}


def stage_batch(root: str, batch_id: str, tables: Mapping[str, DataFrame]) -> dict[str, str]:
    """Writes a batch's tables, visible to nobody yet: table -> folder name."""
    folders = {}
    for name, df in tables.items():
        folder = f"{BATCH_COLUMN}={_check_id(batch_id)}.{uuid.uuid4().hex}"
        out = with_month(df, name)
        if TABLES[name].event_time is None:
            out.write.parquet(f"{root}/{name}/{folder}")
        else:
            out.hint("rebalance", MONTH_COLUMN).write.partitionBy(MONTH_COLUMN).parquet(f"{root}/{name}/{folder}")
        folders[name] = folder
    return folders


def append_batch(spark: SparkSession, root: str, batch_id: str, tables: Mapping[str, DataFrame]) -> bool:
    """Appends the conformed ``tables`` as one batch. False, and no change, where the batch is committed already."""
    manifest = f"{root}/{COMMITS}/{_check_id(batch_id)}.json"
    fs, p = _hadoop(spark, manifest)
    if fs.exists(p):
        return False
    return _publish(spark, manifest, json.dumps(stage_batch(root, batch_id, tables)))


def read_committed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows of ``table`` in all committed batches, with the event month of a fact."""
    month = [T.StructField(MONTH_COLUMN, T.DateType())] if TABLES[table].event_time else []
    schema = T.StructType([*TABLES[table].schema.fields, *month])
    folders = [f[table] for f in committed(spark, root).values() if table in f]
    if not folders:
        return spark.createDataFrame([], schema)
    full = T.StructType([*schema.fields, T.StructField(BATCH_COLUMN, T.StringType())])
    base = f"{root}/{table}"
    return spark.read.schema(full).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders]).drop(BATCH_COLUMN)


def stored_filters(spark: SparkSession, root: str, order: Mapping[key_filters.Space, int], capacity: int = key_filters.CAPACITY) -> DataFrame:
    """The merged key filters of all committed batches, in the spaces ``order``. ``capacity``: distinct keys a space is to hold in all;
    filters written with another one stay in use beside the new."""
    blocks, found = key_filters.blocks_for(capacity), committed(spark, root)
    parts = [spark.createDataFrame([], "space int, blocks long, block long, bits binary")]
    for (table, cols), space in order.items():
        base = f"{root}/{KEYS}/{table}/{'.'.join(cols)}"
        for folder in (f[table] for f in found.values() if table in f):
            done = [n for n in _names(spark, f"{base}/{folder}") if "_SUCCESS" in _names(spark, f"{base}/{folder}/{n}")]
            if not done:
                rows = spark.read.schema(TABLES[table].schema).parquet(f"{root}/{table}/{folder}")
                key_filters.key_filter(key_filters.keys_of(rows, 0, cols), blocks).drop("space").write.mode("overwrite").parquet(f"{base}/{folder}/{blocks}")
        paths = [f"{base}/{f[table]}/*" for f in found.values() if table in f]
        if paths:
            bits = spark.read.schema("blocks long, block long, bits binary").parquet(*paths)
            parts.append(bits.selectExpr(f"{space} AS space", "blocks", "block", "bits"))
    return key_filters.merged(reduce(DataFrame.unionByName, parts))


def check_batch(
    spark: SparkSession,
    root: str,
    batch: Mapping[str, DataFrame],
    keys: Mapping[str, tuple[str, ...]],
    fks: Iterable[tuple[str, str, str, str]] = (),
    capacity: int = key_filters.CAPACITY,
) -> tuple[DataFrame, DataFrame | None]:
    """A4 and A5 of a batch before it is appended, against all committed batches and itself: the violated primary keys and the
    orphans per foreign key (None without ``fks``), as the full checks give them on the union, for the keys and rows of the batch."""
    fks = list(fks)
    pk_order, fk_order = key_filters.spaces(keys), key_filters.spaces({}, fks)
    history = {t: read_committed(spark, root, t) for t, _ in {**pk_order, **fk_order}}
    pk = key_filters.batch_pk_violations(batch, history, stored_filters(spark, root, pk_order, capacity), keys)
    if not any(fk[0] in batch for fk in fks):
        return pk, None
    return pk, key_filters.batch_fk_summary(batch, history, stored_filters(spark, root, fk_order, capacity), fks)


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Removes the folders that no manifest names, and returns them. Not to be run while a batch is being written."""
    named = {(t, f) for tables in committed(spark, root).values() for t, f in tables.items()}
    gone = [f"{t}/{f}" for t in TABLES for f in _names(spark, f"{root}/{t}") if f.startswith(f"{BATCH_COLUMN}=") and (t, f) not in named]
    for f in gone:
        fs, p = _hadoop(spark, f"{root}/{f}")
        fs.delete(p, True)
    return gone
