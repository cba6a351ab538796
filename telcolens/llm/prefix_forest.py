"""Approximate nearest neighbours by a hash-prefix forest (LSH forest) under Euclidean distance.

Each of ``TREES`` trees gives every vector a string of ``BITS`` hash bits: the sides of random hyperplanes through the
mean of all vectors. A tree is the array of its vectors sorted by that string, cut into blocks; all vectors that share a
query's first bits lie together, a range found by binary search. A query begins in every tree at the range of all its
bits and ascends in all trees together, to ranges of shorter prefixes; candidates are ranked by exact distances on the
original vectors.

Each query stops for itself: at the level (prefix length) at which it has k candidates and would miss its true
neighbours with a mean chance of at most ``MISS``, a bound that leaves room below a tenth. Its true i-th neighbour is no farther than its i-th candidate, so the
angle between them around the mean is at most the widest one that this distance allows, given the query's distance from
the mean and the least one of all vectors; the chance follows from the collision probability 1 - angle / pi of a
bit. Until then it ascends to the longest prefix that satisfies this for the candidates found so far, but by a third of its
level at most. Below log2(trees) + 2 bits it ascends by one bit at a time, as each doubles what it meets. A query that one bit does not
satisfy goes to the root and meets all vectors. All vectors are indexed and no candidate list is cut. In data without structure queries
stop at prefixes of a few bits, in clusters at long ones.

Equal vectors are one: it carries the k + 1 smallest ids of its rows, which is all a result can show. Vectors that
are null, empty, zero or hold null or non-finite components take no part. Vectors of different lengths do not meet.
Ties go to the smaller vec_id. Repeated rows (equal id and vector) are one. Empty tables give no rows. Only vec_id and
embedding are read; rows with a null id take no part.

Scale: the index is TREES copies of the vectors, sorted once by (tree, string) and written as a table bucketed by block
(``CELL`` vectors at most), so that the levels of the ascent move queries only. A query goes to the blocks its range
lies in, by an equal join on the prefix. At the root, blocks of vectors meet blocks of queries. What leaves a task is
k + 1 rows per query and block. The driver holds the mean, the least distance from it and the levels in use (``BITS`` numbers at most).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from telcolens.llm.common import batches, shared_dir, table, written
from telcolens.llm.signature_tree import grouped

TREES, BITS = 32, 24
MISS = 0.05
CELL = 4096
SEED = 20240201


@lru_cache(maxsize=4)
def planes(dim: int, trees: int, bits: int) -> np.ndarray:
    """Normals of the hyperplanes of vectors of ``dim`` components: (dim, trees * bits)."""
    return np.random.default_rng([SEED, dim]).normal(size=(dim, trees * bits))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def by_length(part: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = np.array([len(v) for v in part.column("vector")])
    for n in np.unique(lengths):
        yield int(n), part.filter(pa.array(lengths == n))


def strings(x: np.ndarray, mean: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """The hash strings of every vector in every tree, as numbers: (vectors, trees)."""
    side = ((x - mean) @ planes(x.shape[1], trees, bits)).reshape(len(x), trees, bits) > 0
    return (side * (1 << np.arange(bits - 1, -1, -1))).sum(axis=2).astype(np.int64)


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - q) ** 2).sum(axis=1))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    some = F.exists("embedding", lambda v: v != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine & some)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(rep, ids, vector): each distinct vector, its smallest id and its ``keep`` smallest ids; written."""
    key = F.xxhash64("vector")
    # Rows beyond the smallest ids of a vector are dropped below the shuffle already.
    w = Window.partitionBy("key", "vector").orderBy("vec_id")
    first = rows.distinct().withColumn("key", key).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= keep)
    got = first.groupBy("key", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return written(got.select(F.col("ids")[0].alias("rep"), "ids", "vector"), "vectors")


def means(vectors: DataFrame) -> dict[int, np.ndarray]:
    """The mean of the vectors of each length."""

    def sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for part in parts:
            for n, rows in by_length(part):
                x = matrix(rows.column("vector"))
                count, total = held.get(n, (0, np.zeros(n)))
                held[n] = (count + len(x), total + x.sum(axis=0))
        rows = [{"dim": n, "i": i, "n": c, "v": float(v)} for n, (c, t) in held.items() for i, v in enumerate(t)]
        yield from batches(iter(rows), pa.schema([("dim", pa.int32()), ("i", pa.int32()), ("n", pa.int64()), ("v", pa.float64())]))

    got = vectors.select("vector").mapInArrow(sums, "dim int, i int, n long, v double").groupBy("dim", "i")
    out: dict[int, np.ndarray] = {}
    for r in got.agg(F.sum("v").alias("v"), F.sum("n").alias("n")).collect():  # one row per component
        out.setdefault(r["dim"], np.zeros(r["dim"]))[r["i"]] = r["v"] / r["n"]
    return out


def least_norms(vectors: DataFrame, mean: dict[int, np.ndarray]) -> dict[int, float]:
    """The least distance from the mean, of the vectors of each length."""

    def least(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [(n, float(distances(matrix(rows.column("vector")), mean[n]).min())) for n, rows in by_length(part)]
            yield pa.RecordBatch.from_pylist([{"dim": n, "v": v} for n, v in found], pa.schema([("dim", pa.int32()), ("v", pa.float64())]))

    got = vectors.select("vector").mapInArrow(least, "dim int, v double").groupBy("dim").agg(F.min("v").alias("v"))
    return {r["dim"]: r["v"] for r in got.collect()}  # one row per length


def widest(d: np.ndarray, norm: float, least: float) -> np.ndarray:
    """The widest angle around the mean to a vector at distance ``d``, if no vector is nearer to the mean than ``least``."""
    other = np.maximum(least, np.sqrt(np.maximum(0.0, norm * norm - d * d)))
    if not norm:
        return np.full(len(d), np.pi)
    cos = (norm * norm + other * other - d * d) / np.maximum(1e-300, 2 * norm * other)
    return np.where(other > 0, np.arccos(np.clip(cos, -1, 1)), np.pi)


FOUND = "q long, rep long, score double, angle double"
FOUND_ARROW = pa.schema([("q", pa.int64()), ("rep", pa.int64()), ("score", pa.float64()), ("angle", pa.float64())])


def nearest(q: int, v: np.ndarray, x: np.ndarray, ids: np.ndarray, mean: np.ndarray, least: float, k: int) -> pa.RecordBatch:
    """The k + 1 nearest of the vectors ``x`` to ``v``, with the widest angles that their distances allow."""
    d = distances(x, v)
    near = np.lexsort((ids, d))[: k + 1]
    angle = widest(d[near], float(np.linalg.norm(v - mean)), least)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(near), q)), pa.array(ids[near]), pa.array(d[near]), pa.array(angle)], schema=FOUND_ARROW)


def number_type(vectors: DataFrame) -> str:
    """Floats are kept as they are given, all else as doubles."""
    return "<f4" if isinstance(vectors.schema["vector"].dataType.elementType, T.FloatType) else "<f8"


def sorted_trees(vectors: DataFrame, mean: dict[int, np.ndarray], trees: int, bits: int) -> DataFrame:
    """The index: block, dim, tree and, sorted by string, strings, reps and vectors of the block; bucketed by block."""
    kind = number_type(vectors)

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for n, rows in by_length(part):
                x, rep = matrix(rows.column("vector")), rows.column("rep")
                of = strings(x, mean[n], trees, bits)
                raw = pa.array([v.tobytes() for v in x.astype(kind)])
                for t in range(trees):
                    columns = [pa.array(np.full(len(x), n, np.int32)), pa.array(np.full(len(x), t, np.int32)), pa.array(of[:, t]), rep, raw]
                    yield pa.RecordBatch.from_arrays(columns, ["dim", "tree", "string", "rep", "vector"])

    schema = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("tree", pa.int32()), ("strings", pa.binary()), ("reps", pa.binary()), ("vectors", pa.binary())])

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, of, size = TaskContext.get().partitionId(), 0, None, 0
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = [b"".join(x[i] for x in held) for i in range(3)]
            held.clear()
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, [(task << 32) + made, *of, *columns]))], schema)

        for part in parts:
            dim, tree, string, rep = (part.column(c).to_numpy() for c in ("dim", "tree", "string", "rep"))
            raw = part.column("vector").to_pylist()
            changes = np.flatnonzero((dim[1:] != dim[:-1]) | (tree[1:] != tree[:-1])) + 1
            for a, b in zip([0, *changes], [*changes, len(raw)]):
                while a < b:
                    now = (int(dim[a]), int(tree[a]))
                    if held and (now != of or size >= CELL):
                        yield flush()
                        made, size = made + 1, 0
                    of, e = now, min(b, a + CELL - size)
                    held.append((string[a:e].tobytes(), rep[a:e].tobytes(), b"".join(raw[a:e])))
                    a, size = e, size + e - a
        if held:
            yield flush()

    spark = vectors.sparkSession
    partitions, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"prefix_forest_{uuid.uuid4().hex}"
    dealt = vectors.select("rep", "vector").mapInArrow(deal, "dim int, tree int, string long, rep long, vector binary")
    order = ["dim", "tree", "string", "rep"]
    blocks = dealt.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    blocks = blocks.mapInArrow(cut, "block long, dim int, tree int, strings binary, reps binary, vectors binary")
    blocks.write.bucketBy(partitions, "block").option("path", shared_dir(spark, "forest")).saveAsTable(name)
    index = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files are read by the levels
    return index


def in_ranges(index: DataFrame, queries: DataFrame, mean: dict[int, np.ndarray], least: dict[int, float], k: int, trees: int, bits: int) -> DataFrame:
    """FOUND: for each query (rep, vector, level) the k + 1 nearest of each block in the range of its prefix of ``level``
    bits (itself included), in all trees."""
    levels = sorted(r["level"] for r in queries.select("level").distinct().collect())
    kind = number_type(queries)
    cell = pa.schema([("dim", pa.int32()), ("tree", pa.int32()), ("level", pa.int32()), ("prefix", pa.int64())])

    def ask(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for n, rows in by_length(part):
                if n not in mean:
                    continue
                x, level = matrix(rows.column("vector")), rows.column("level").to_numpy()
                of = strings(x, mean[n], trees, bits) >> (bits - level.astype(np.int64))[:, None]
                raw = pa.array([v.tobytes() for v in x.astype(kind)])
                for t in range(trees):
                    columns = [pa.array(np.full(len(x), n, np.int32)), pa.array(np.full(len(x), t, np.int32)), pa.array(level), pa.array(of[:, t])]
                    yield pa.RecordBatch.from_arrays([*columns, rows.column("rep"), raw], [*cell.names, "q", "vector"])

    def places(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for r in part.to_pylist():
                string = np.frombuffer(r["strings"], np.int64)
                for level in levels:
                    prefix = np.unique(string >> (bits - level))
                    columns = [np.full(len(prefix), r["dim"], np.int32), np.full(len(prefix), r["tree"], np.int32), np.full(len(prefix), level, np.int32), prefix, np.full(len(prefix), r["block"])]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*cell.names, "block"])

    key = "dim int, tree int, level int, prefix long"
    where = index.select("block", "dim", "tree", "strings").mapInArrow(places, f"{key}, block long")
    asked = queries.select("rep", "vector", "level").mapInArrow(ask, f"{key}, q long, vector binary")
    asked = asked.join(where, cell.names).select("block", "level", "prefix", "q", "vector")

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for r in left.to_pylist():
            string, ids = (np.frombuffer(r[c], np.int64) for c in ("strings", "reps"))
            x = np.frombuffer(r["vectors"], kind).reshape(len(ids), -1).astype(np.float64)
            for q, level, prefix, v in zip(*(right.column(c).to_pylist() for c in ("q", "level", "prefix", "vector"))):
                a, b = np.searchsorted(string, [prefix << (bits - level), (prefix + 1) << (bits - level)])
                out.append(nearest(q, np.frombuffer(v, kind).astype(np.float64), x[a:b], ids[a:b], mean[r["dim"]], least[r["dim"]], k))
        return pa.Table.from_batches(out, FOUND_ARROW)

    return index.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(look, FOUND)


def at_root(vectors: DataFrame, queries: DataFrame, mean: dict[int, np.ndarray], least: dict[int, float], k: int) -> DataFrame:
    """FOUND: for each query the k + 1 nearest of each block of all vectors of its length."""
    n, m = (max(1, -(-df.count() // CELL)) for df in (vectors, queries))
    own = lambda blocks: F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    size = F.size("vector").alias("dim")
    theirs = vectors.select(size, own(n).alias("a"), every(m).alias("b"), F.lit(False).alias("asks"), "rep", "vector")
    asked = queries.select(size, every(n).alias("a"), own(m).alias("b"), F.lit(True).alias("asks"), "rep", "vector")

    def look(key: tuple, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        here = [r for r in rows if not r["asks"]]
        if not here or len(here) == len(rows):
            return
        ids = np.array([r["rep"] for r in here])
        x = np.array([r["vector"] for r in here], np.float64)
        found = [nearest(r["rep"], np.array(r["vector"], np.float64), x, ids, mean[key[0]], least[key[0]], k) for r in rows if r["asks"]]
        yield from pa.Table.from_batches(found).combine_chunks().to_batches()

    both = theirs.unionByName(asked).repartition("dim", "a", "b").sortWithinPartitions("dim", "a", "b")
    return both.mapInArrow(lambda parts: grouped(parts, ["dim", "a", "b"], look), FOUND)


def ascended(found: DataFrame, queries: DataFrame, k: int, trees: int, bits: int) -> DataFrame:
    """The queries (rep, vector, level) that have to ascend after ``found``, with their next level (0: the root)."""
    w = Window.partitionBy("q").orderBy("score", "rep")
    best = found.where("q <> rep").withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
    miss = [F.avg(F.pow(1 - F.pow(1 - F.col("angle") / float(np.pi), F.lit(j)), F.lit(trees))) <= MISS for j in range(1, bits + 1)]
    state = best.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.array(*miss).alias("fine"))
    both = queries.join(state.withColumnRenamed("q", "rep"), "rep", "left")
    full = F.coalesce(F.col("n") >= k, F.lit(False))
    both = both.where(~(full & F.coalesce(F.get("fine", F.col("level") - 1), F.lit(False))))
    lower = F.floor(F.col("level") * 2 / 3).cast("int")
    fitting = F.array_max(F.transform("fine", lambda f, j: F.when(f & (j + 1 < F.col("level")), j + 1).otherwise(0)))
    after = F.when(full, F.greatest(lower, fitting)).otherwise(lower)
    near = 2 + int(np.ceil(np.log2(max(2, trees))))
    after = F.when(F.col("level") <= near, F.col("level") - 1).otherwise(F.greatest(after, F.lit(near)))
    return both.select("rep", "vector", after.cast("int").alias("level"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, trees: int = TREES, bits: int = BITS) -> DataFrame:
    """The k nearest rows of ``vectors`` to each row of ``queries`` (both vec_id, embedding), but the query's own id:
    query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    everything = distinct_vectors(usable(vectors), k + 1)
    asking = written(usable(queries).distinct().select("vec_id", "vector", F.xxhash64("vector").alias("key")), "queries")
    unique = asking.groupBy("key", "vector").agg(F.min("vec_id").alias("rep"))
    names = written(asking.join(unique, ["key", "vector"]).select("vec_id", "rep"), "asked")
    unique = written(unique.select("rep", "vector"), "unique")
    mean = means(everything)
    least = least_norms(everything, mean)
    forest = sorted_trees(everything, mean, trees, bits)
    # Rows that a level has found, of the queries that stop there.
    stopped, rising = [], written(unique.withColumn("level", F.lit(bits)), "level")
    while rising.where("level > 0").head(1):
        now = rising.where("level > 0")
        found = written(in_ranges(forest, now, mean, least, k, trees, bits).distinct(), "found")
        more = written(ascended(found, now, k, trees, bits).unionByName(rising.where("level = 0")), "level")
        stopped.append(found.join(more.select(F.col("rep").alias("q")), "q", "left_anti"))
        rising = more
    if rising.head(1):
        stopped.append(at_root(everything, rising, mean, least, k))
    w = Window.partitionBy("q").orderBy("score", "vec_id")
    ids = everything.select("rep", "ids")

    def rows(found: DataFrame) -> DataFrame:
        each = found.distinct().join(ids, "rep").select("q", "score", F.explode("ids").alias("vec_id"))
        return each.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k + 1)

    everyone = reduce(DataFrame.unionByName, stopped) if stopped else spark.createDataFrame([], FOUND)
    near = written(rows(everyone.select("q", "rep", "score")), "near")
    each = names.select(F.col("vec_id").alias("query_id"), F.col("rep").alias("q")).join(near, "q").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: the 10 nearest vectors to each vector whose id is divisible by 100."""
    rows = table(spark, sf_dir, "embeddings")
    return search(rows, rows.where(F.pmod("vec_id", F.lit(100)) == 0))
