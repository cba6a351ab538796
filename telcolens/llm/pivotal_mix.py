"""Mixing sources to target weights by pivotal dependent rounding.

Sources by code point (null last) weigh 1, 2, 3, repeating, and share all words. A source's target stops at
``MOST`` times its own words; the excess is shared again by weight among the others until no source is
above. Every document of a source should then be taken ``target / source words`` times: a whole number of
copies plus a fraction. The fractions are rounded together:

* two documents i, j of a source with sizes w and fractions p exchange mass so that w_i p_i + w_j p_j stays
  the same, in one of the two directions by a random draw, until one fraction is 0 or 1 (expectations stay);
* the one left goes on to the next document; a block of documents leaves at most one fraction;
* the residues of ``FAN`` blocks meet in the next level of a reduction tree, until one is left per source,
  which is rounded by a draw.

So the words taken of a source differ from its target by less than one document, while each document is
taken with the wanted expectation. Blocks, their order and the draws come from hashes of the seed and of what a row is (doc_id, size, text,
rank among equal rows) and from nothing else, such as places in a task's rows: reruns agree on any cluster and layout.

Nulls: a null text has size 0; a null source is a source of its own. Documents without words are taken
``floor(copies)`` times plus a draw of their own. Repeated rows are documents of their own, told apart by a
rank among the rows that agree in doc_id, source, size and text (which of them has which rank makes no difference). Very long texts
are counted whole. Ties of hashes aside, no two rows share a place in the order. An empty table gives no rows. Only doc_id, text
and source are read by name, from the given frame; the stage carries rows as one column, so no name clashes.

Scale: texts are read once, for their sizes; everything else moves (doc_id, source, size) rows. Blocks hold
about ``LEAF`` rows whatever the size of a source, so a source with a third of all rows is spread over many
tasks. Source totals (one row per source, the mix's own configuration) are the only rows that go to the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from telcolens.llm.common import table, written

WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3.0
LEAF, FAN = 256, 64
SEED = 20240201


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, most: float = MOST) -> list[tuple[str | None, float]]:
    """The target of each source. ``sizes``: (source, words), one row per source."""
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    size = np.array([float(n) for _, n in order])
    weight = np.array([weights[i % len(weights)] for i in range(len(order))])
    target, free = np.zeros(len(order)), size > 0
    left = size.sum()
    while free.any():
        share = left * weight / weight[free].sum()
        over = free & (share > most * size)
        if not over.any():
            target[free] = share[free]
            break
        target[over] = most * size[over]
        left -= target[over].sum()
        free &= ~over
    return [(s, float(t)) for (s, _), t in zip(order, target)]


def pivot(rows: Iterator[tuple], out: list, seed: int) -> None:
    """Rounds one block. rows: (unit, size, fraction, place); appends (row, fraction) with the fraction 0, 1 or, for at
    most one row, between. Draws come from the units alone, never from the places."""
    held = None
    for row in rows:
        unit, w, p, place = row
        if not 0.0 < p < 1.0:
            out.append((row, p))
            continue
        if held is None:
            held = row
            continue
        other, v, q, there = held
        ratio = w / v  # one unit of p is worth this much of q
        up, down = min(1.0 - p, q / ratio), min(p, (1.0 - q) / ratio)
        draw = zlib.crc32(repr((seed, unit, other)).encode()) / 2.0**32
        a, b = (up, -up * ratio) if draw * (up + down) < down else (-down, down * ratio)
        p, q = settle(p + a), settle(q + b)
        if 0.0 < p < 1.0:
            out.append((held, q))
            held = (unit, w, p, place)
            if 0.0 < q < 1.0:  # only by rounding of floats: leave it to the larger
                out[-1] = (out[-1][0], round(q))
        else:
            out.append((row, p))
            held = (other, v, q, there) if 0.0 < q < 1.0 else None
            if held is None:
                out.append(((other, v, q, there), q))
    if held is not None:
        out.append((held, held[2]))


def settle(p: float) -> float:
    return 0.0 if p < 1e-9 else 1.0 if p > 1 - 1e-9 else p


def round_blocks(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Rounds every (source_no, block) of sorted rows; a block may go over several batches."""
    held: list[pa.RecordBatch] = []

    def flush(part: pa.Table) -> Iterator[pa.RecordBatch]:
        source, block, unit = (part[c].to_numpy() for c in ("source_no", "block", "unit"))
        size, p = part["size"].to_numpy(), part["p"].to_numpy().copy()
        ends = np.flatnonzero((np.diff(source) != 0) | (np.diff(block) != 0)) + 1
        for a, b in zip([0, *ends], [*ends, len(p)]):
            done: list = []
            pivot(zip(unit[a:b].tolist(), size[a:b].tolist(), p[a:b].tolist(), range(a, b)), done, seed)
            for row, value in done:
                p[row[3]] = value
        at = part.schema.get_field_index("p")
        yield from part.set_column(at, part.schema.field(at), pa.array(p)).to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        whole = pa.Table.from_batches([*held, batch])
        key = [whole[c].to_numpy() for c in ("source_no", "block")]
        first = int(np.argmax((key[0] == key[0][-1]) & (key[1] == key[1][-1])))
        held = whole.slice(first).to_batches()
        if first:
            yield from flush(whole.slice(0, first))
    if held:
        yield from flush(pa.Table.from_batches(held))


def taken_copies(sized: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, ...) rows with source_size, target, copies (long) added.

    ``sized`` should be a written table: it is read for the totals and again for each level's rest."""
    spark = sized.sparkSession
    per_source = [(r[0], int(r[1]), int(r[2])) for r in sized.groupBy("source").agg(F.sum("size"), F.count(F.lit(1))).collect()]
    goal = dict(targets([(s, n) for s, n, _ in per_source]))
    rows = []
    for i, (s, n, docs) in enumerate(sorted(per_source, key=lambda x: (x[0] is None, x[0] or ""))):
        c = goal[s] / n if n else 1.0
        c = MOST if goal[s] >= MOST * n and n else c
        rows.append((i, s, n, goal[s], int(c), settle(c - int(c)), max(1, -(-docs // LEAF))))
    config = spark.createDataFrame(
        rows, "source_no int, source string, source_size long, target double, whole long, p double, blocks long"
    )
    same = sized.columns
    # One row per source: the list above has just been on the driver.
    units = sized.join(F.broadcast(config), sized["source"].eqNullSafe(config["source"])).drop(config["source"])
    key = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "size", "mark", "rank")]
    units = units.withColumn("unit", F.xxhash64(F.lit(seed), *key)).withColumn(
        "block", F.pmod(F.xxhash64(F.lit(seed + 1), *key), F.col("blocks"))
    )
    columns = [*same, "source_no", "source_size", "target", "whole", "unit", "block", "p"]
    empty = F.col("size") == 0
    draw = F.pmod(F.xxhash64(F.lit(seed + 2), *key), F.lit(1 << 30)) / float(1 << 30)
    done = [units.where(empty).withColumn("p", F.when(draw < F.col("p"), 1.0).otherwise(0.0)).select(columns)]
    level, most = units.where(~empty).select(columns), max([1, *(r[6] for r in rows)])
    while True:
        # The rounds are read again below, so each is written once.
        level = written(
            level.repartition(F.col("source_no"), F.col("block"))
            .sortWithinPartitions("source_no", "block", "unit", "doc_id")
            .mapInArrow(lambda it: round_blocks(it, seed), level.schema),
            "pivotal",
        )
        open_ = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(level.where(~open_))
        level = level.where(open_)
        if most == 1:
            break
        most = -(-most // FAN)
        level = level.withColumn("block", F.floor(F.col("block") / FAN).cast("long"))
    last = F.pmod(F.xxhash64(F.lit(seed + 3), F.col("unit")), F.lit(1 << 30)) / float(1 << 30)
    done.append(level.withColumn("p", F.when(last < F.col("p"), 1.0).otherwise(0.0)).select(columns))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.withColumn("copies", F.col("whole") + F.col("p").cast("long")).select(*same, "source_size", "target", "copies")


def sized(docs: DataFrame) -> DataFrame:
    """(no, doc_id, source, size, mark, rank) of each row, written once: later steps don't read the texts. ``no`` is a number of the
    row's own, which ``docs`` may bring along; ``mark`` is a hash of the text."""
    no = F.col("no") if "no" in docs.columns else F.monotonically_increasing_id().alias("no")
    text = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("mark")
    s = docs.select(no, "doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), text)
    return written(ranked(written(s, "sizes")), "sizes")


def ranked(s: DataFrame) -> DataFrame:
    """``rank`` (from 1) tells rows apart that are equal in doc_id, source, size and mark. Equal rows of one task are numbered next to each other, and the
    counts of earlier tasks are added, so that a third of all rows may be equal and still spread over tasks."""
    own = s.withColumn("_equal", F.xxhash64("doc_id", "source", "size", "mark")).withColumn("_task", F.shiftright("no", 33))
    earlier = Window.partitionBy("_equal").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = own.groupBy("_equal", "_task").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select("_equal", "_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    here = F.row_number().over(Window.partitionBy("_equal", "_task").orderBy("no"))
    return own.withColumn("_here", here).join(counts, ["_equal", "_task"]).select(*s.columns, (F.col("_before") + F.col("_here")).alias("rank"))


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken (copies * size)."""
    out = taken_copies(sized(docs.select("doc_id", "text", "source")), seed)
    return out.drop("no", "mark", "rank").withColumn("taken", F.col("copies") * F.col("size"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each document as many times as the mix takes it, with the columns of ``docs``. Rows are numbered and written once,
    and meet their copies by that number."""
    numbered = written(docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("no")), "numbered")
    copies = taken_copies(sized(numbered.select("no", "row.doc_id", "row.text", "row.source"))).select("no", "copies")
    taken = numbered.join(copies.where("copies > 0"), "no")
    return taken.select(F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op9: the words that the mix takes of each document."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
