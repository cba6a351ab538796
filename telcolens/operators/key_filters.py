"""A4 / A5 for one batch against all history, at the cost of the batch.

Each batch leaves a Bloom filter of its key values behind. It is a table of blocks (``space``, ``block``, ``bits``): a key's hash names a block
of 32,768 bits and ``PLACES`` places in it. Filters of one number of blocks merge by OR. A new batch's distinct keys meet
the merged blocks in one equal join, so what is shuffled is the batch's keys and the filter, about ``BITS_A_KEY`` bits a key of the capacity.

A key that misses is new for certain. Hits are confirmed against the key columns of history: they are broadcast to its scan, where their size in bytes is
checked and small (``CONFIRM_BYTES``), so history's rows are read but not shuffled; without hits history is not read at all. Beyond that bound
history's keys are shuffled to the hits. The results are exact on each of these ways; a filter past its capacity has more hits to confirm and misses none.

A space is a set of keys of its own: a table with its key columns. Keys are texts that tell all values and nulls apart (``key_code``).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telcolens.operators.quality import as_parent_key, key_text
from telcolens.session import ensure_checkpoint_dir

BLOCK_BITS = 32768  # of Spark's bitmap functions
PLACES = 4
BITS_A_KEY = 16
CAPACITY = 1 << 20
CONFIRM_BYTES = 64 << 20

Space = tuple[str, tuple[str, ...]]


def blocks_for(capacity: int) -> int:
    """The number of blocks, a power of two, that holds ``capacity`` keys with about one false hit in 400."""
    return 1 << max(0, math.ceil(math.log2(capacity * BITS_A_KEY / BLOCK_BITS)))


def key_code(parts: Iterable[str]) -> Column:
    """One text for the SQL expressions ``parts`` of a key; different values, nulls included, give different texts."""
    return F.expr("concat(" + ", ".join(f"coalesce(concat(length(CAST({p} AS STRING)), ':', CAST({p} AS STRING)), 'n')" for p in parts) + ")")


def keys_of(df: DataFrame, space: int, cols: Iterable[str]) -> DataFrame:
    return df.select(F.lit(space).alias("space"), key_code(f"`{c}`" for c in cols).alias("key"))


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("key"), blocks).alias("block")


def _places() -> Column:
    second = F.xxhash64("key", F.lit(1))
    return F.array(*[F.shiftrightunsigned(second, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(PLACES)])


def key_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter of ``keys`` (space, key): (space, blocks, block, bits). A key that fills a third of the rows is one block's bits in each task."""
    placed = keys.select("space", _block(F.lit(blocks)), F.explode(_places()).alias("place"))
    bits = placed.groupBy("space", "block").agg(F.bitmap_construct_agg("place").alias("bits"))
    return bits.select("space", F.lit(blocks).cast("long").alias("blocks"), "block", "bits")


def merged(filters: DataFrame) -> DataFrame:
    return filters.groupBy("space", "blocks", "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def maybe_known(keys: DataFrame, filters: DataFrame) -> DataFrame:
    """The rows of ``keys`` (space, key: distinct) that a filter holds, and few others. ``filters`` are merged."""
    sizes = sorted(r["blocks"] for r in filters.select("blocks").distinct().collect())  # powers of two: a few numbers
    if not sizes:
        return keys.limit(0)
    asked = keys.withColumn("_blocks", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes])))
    asked = asked.withColumn("_block", _block(F.col("_blocks")))
    held = filters.select(F.col("space").alias("_space"), F.col("blocks").alias("_blocks"), F.col("block").alias("_block"), "bits")
    met = asked.join(held, (F.col("space") == F.col("_space")) & (asked["_blocks"] == held["_blocks"]) & (asked["_block"] == held["_block"]))
    byte = "CAST(conv(hex(substring(bits, CAST(p DIV 8 + 1 AS INT), 1)), 16, 10) AS INT)"
    hit = met.withColumn("_places", _places()).where(F.expr(f"forall(_places, p -> getbit({byte}, CAST(p % 8 AS INT)) = 1)"))
    hit = hit.select(*keys.columns)
    return hit if len(sizes) == 1 else hit.dropDuplicates(["space", "key"])


def confirmed(history: DataFrame, hits: DataFrame, limit: int = CONFIRM_BYTES) -> DataFrame:
    """(space, key, n_rows): how often history (space, key) really holds each of ``hits`` (space, key: distinct, written)."""
    size = hits.agg(F.coalesce(F.sum(F.octet_length("key") + 24), F.lit(0)).alias("b")).head()["b"]
    if not size:
        return hits.select("space", "key", F.lit(0).cast("long").alias("n_rows")).limit(0)
    wanted = hits.select("space", "key")
    if size <= limit:
        history = history.join(F.broadcast(wanted), ["space", "key"], "left_semi")
        return history.groupBy("space", "key").agg(F.count(F.lit(1)).alias("n_rows"))
    # Counted before the join, so a hot key is a row a task.
    return history.groupBy("space", "key").agg(F.count(F.lit(1)).alias("n_rows")).join(wanted, ["space", "key"], "left_semi")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def batch_pk_violations(
    batch: Mapping[str, DataFrame], history: Mapping[str, DataFrame], filters: DataFrame, keys: Mapping[str, tuple[str, ...]], limit: int = CONFIRM_BYTES
) -> DataFrame:
    """A4 for the keys that ``batch`` holds: those that repeat in history and batch together, or have a null part: (table_name,
    key_value, n_rows), as ``pk_violations`` gives for the union. ``filters`` (merged) hold history's keys in the spaces of
    ``spaces(keys)``. Tables that the batch lacks are passed over."""
    order = spaces(keys)
    names = [n for n in keys if n in batch]
    parts = []
    for name in names:
        cols = keys[name]
        null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
        coded = batch[name].select(
            F.lit(order[name, cols]).alias("space"),
            key_code(f"`{c}`" for c in cols).alias("key"),
            key_text(cols).alias("key_value"),
            null.alias("has_null"),
        )
        parts.append(coded.groupBy("space", "key", "key_value", "has_null").agg(F.count(F.lit(1)).alias("own")))
    counted = _union(parts)
    ensure_checkpoint_dir(counted.sparkSession)
    counted = counted.checkpoint()
    hits = maybe_known(counted.select("space", "key"), filters).checkpoint()
    old = confirmed(_union([keys_of(history[n], order[n, keys[n]], keys[n]) for n in names]), hits, limit)
    both = counted.join(old, ["space", "key"], "left")
    total = (F.col("own") + F.coalesce("n_rows", F.lit(0))).alias("n_rows")
    table = F.element_at(F.create_map(*[F.lit(x) for n in names for x in (order[n, keys[n]], n)]), F.col("space"))
    return both.select(table.alias("table_name"), "key_value", total, "has_null").where("n_rows > 1 OR has_null").drop("has_null")


def batch_fk_summary(
    batch: Mapping[str, DataFrame], history: Mapping[str, DataFrame], filters: DataFrame, fks: Iterable[tuple[str, str, str, str]], limit: int = CONFIRM_BYTES
) -> DataFrame:
    """A5 for the child rows of ``batch``: one row per foreign key whose child is in the batch, as ``fk_summary`` gives for these
    children and the parents of history and batch together. ``filters`` hold the parents' keys in the spaces of ``spaces({}, fks)``."""
    fks = list(fks)
    order = spaces({}, fks)
    here = [(i, fk) for i, fk in enumerate(fks) if fk[0] in batch]
    by_child: dict[str, list[str]] = {}
    for i, (child, column, parent, pcol) in here:
        key = as_parent_key(column, batch[child].schema[column].dataType, history[parent].schema[pcol].dataType)
        by_child.setdefault(child, []).append(f"{i}, {order[parent, (pcol,)]}, {key}")
    found = _union([batch[c].selectExpr(f"stack({len(x)}, {', '.join(x)}) AS (fk, space, text)") for c, x in by_child.items()])
    counted = found.where("text IS NOT NULL").groupBy("fk", "space", "text").agg(F.count(F.lit(1)).alias("n_rows"))
    counted = counted.withColumn("key", key_code(["text"])).drop("text")
    parents = dict.fromkeys((p, pcol) for _, (_, _, p, pcol) in here)
    own = [keys_of(batch[p], order[p, (c,)], (c,)) for p, c in parents if p in batch]
    if own:
        counted = counted.join(_union(own).distinct().withColumn("_own", F.lit(True)), ["space", "key"], "left").where("_own IS NULL").drop("_own")
    ensure_checkpoint_dir(counted.sparkSession)
    open_ = counted.checkpoint()  # without a parent in the batch itself
    hits = maybe_known(open_.select("space", "key").distinct(), filters).checkpoint()
    old = confirmed(_union([keys_of(history[p], order[p, (c,)], (c,)) for p, c in parents]), hits, limit).withColumnRenamed("n_rows", "_parents")
    orphans = open_.join(old, ["space", "key"], "left").where("_parents IS NULL").groupBy("fk")
    orphans = orphans.agg(F.sum("n_rows").cast("bigint").alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys"))
    values = ", ".join(f"({i}, '{c}', '{col}', '{p}')" for i, (c, col, p, _) in here)
    meta = counted.sparkSession.sql(f"SELECT * FROM VALUES {values} AS m(fk, table_name, column_name, parent_table)")
    zero = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("orphan_rows", "orphan_keys")]
    return meta.join(orphans, "fk", "left").select("table_name", "column_name", "parent_table", *zero)


def spaces(keys: Mapping[str, tuple[str, ...]], fks: Iterable[tuple[str, str, str, str]] = ()) -> dict[Space, int]:
    """The number of each set of keys that the checks look up: the primary keys, then the parents of the foreign keys."""
    wanted = [*keys.items(), *((p, (c,)) for _, _, p, c in fks)]
    return {s: i for i, s in enumerate(dict.fromkeys((t, tuple(c)) for t, c in wanted))}


def history_filter(history: Mapping[str, DataFrame], order: Mapping[Space, int], capacity: int = CAPACITY) -> DataFrame:
    """The filter of all the spaces ``order`` of given tables: one pass over the key columns."""
    return key_filter(_union([keys_of(history[t], i, cols) for (t, cols), i in order.items()]), blocks_for(capacity))
