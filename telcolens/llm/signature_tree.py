"""N-gram Jaccard join by signature trees, giving the components of its links.

A document is the set of its distinct word n-grams (shingles) as 64-bit hashes. Two documents link when
``den * intersection >= num * union`` (integers). The result is each document's component: the smallest doc_id
reachable by links. Links inside an already known component need no check, so no group of copies is expanded
into pairs, and no link between two components is missed.

1. Equal sets are one node from the start (copies collapse inside each map task already).
2. Routing, so that trees can be built apart from each other: shingles are dealt by hash into ``m`` parts. Two
   sets that link differ in at most H shingles, so they agree on at least m - H parts (equal sums of hashes). Each
   document sends a key for its fuller parts: all but m - H - 1 at most, the emptiest ones left out by a threshold
   on their count. For two documents the agreeing part with the higher threshold is sent by both. m and H depend
   on a class of sizes; a document takes part in its own class and the one below, where smaller partners are.
   Equal keys give star edges, and the components of these are the groups in which links can exist.
3. Signature trees: in each group documents are ordered by size and lowest hashes; leaves hold 16, inner nodes 8
   children. A node has the OR of its documents' token bitmaps, the range of their sizes and their least bitmap
   weight. A dual traversal prunes node pairs whose largest possible overlap is too small, or that are one
   component already; documents of surviving leaf pairs are filtered by their own bitmaps. First this is done on
   bitmaps and sizes alone, which are small: it splits the groups into those whose documents could link. (A group
   of more than ``NODES`` documents is cut into blocks, each pair of blocks a task of its own.) In the groups
   that are left, whose shingles are fetched, documents that pass are compared exactly.
4. Of these, groups of more than ``BLOCK`` shingles are cut: all are compared with the group's centre first, which
   joins most near copies; the rest are compared in blocks, rest block by block of all, each pair a task.
5. The components of the links found are computed in Spark by alternating large-star and small-star steps.

Nulls: a null or empty text has no shingles, links with nothing and is its own component. A text with fewer words
than n is one shingle. Documents with a null id take part; a component's id ignores them, and is null if all its ids
are. Repeated rows give a row each. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telcolens.llm.common import table, written
from telcolens.llm.tokens import Words, hash_words, mix

# Shingles of a group (or block) that one task compares.
BLOCK = 1 << 20
BITS = 1024
# Documents of a group that one task compares by bitmaps.
NODES = 1 << 12
LEAF, FANOUT = 16, 8
# Keys that a map task holds before it hands them over.
HELD = 1 << 19


@dataclass(frozen=True)
class Rule:
    """Shingles of ``n`` words; link when den * intersection >= num * union."""

    n: int = 5
    num: int = 80
    den: int = 100

    def largest(self, size: int) -> int:
        """The largest size that can link with ``size``."""
        return size * self.den // self.num

    def differ(self, total: int) -> int:
        """The most shingles in which two linked sets of ``total`` shingles together differ."""
        return (self.den - self.num) * total // (self.den + self.num)

    def classes(self, top: int) -> list[tuple[int, int, int, int]]:
        """(smallest, largest size, parts, differing) of each class up to size ``top`` and one more."""
        out, low = [], 1
        while True:
            high = self.largest(low)
            most = self.differ(high + self.largest(high))
            # Parts beyond those that may differ: a high rule can afford many and ask for fuller ones.
            parts = most + 1 + (most * 9 // 10 if 10 * self.num >= 9 * self.den else most * 2 // 5)
            out.append((low, high, parts, most))
            if low > top:
                return out
            low = high + 1

    def links(self, common, total):
        """Whether sets with ``common`` shingles in common, ``total`` in both together, link."""
        return self.den * common >= self.num * (total - common)


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every text, and where each text's begin."""
    h, first = words.hashes, words.first
    counts = words.counts
    rolled = np.full(len(h), np.uint64(n), np.uint64)
    for k in range(n):
        rolled[: max(0, len(h) - k)] = mix(rolled[: max(0, len(h) - k)] ^ h[k:])
    text = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(first[1:], counts) - np.arange(len(h))  # words from here to the end of the text
    whole = left >= n
    values, owner = rolled[whole], text[whole]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        ones = np.empty(len(short), np.uint64)
        for i, t in enumerate(short):
            v = np.full(1, np.uint64(counts[t]), np.uint64)
            for x in h[first[t] : first[t + 1]]:
                v = mix(v ^ x)
            ones[i] = v[0]
        values, owner = np.concatenate([values, ones]), np.concatenate([owner, short])
    order = np.argsort(values)
    order = order[np.argsort(owner[order], kind="stable")]
    values, owner = values[order], owner[order]
    if len(values):
        keep = np.concatenate([[True], (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])])
        values, owner = values[keep], owner[keep]
    return values, np.searchsorted(owner, np.arange(len(counts) + 1))


def nodes_of(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set (0: empty), the same for equal sets only, but for hash collisions."""
    size = np.diff(first)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64, out=total[1:])
    name = mix((total[first[1:]] - total[first[:-1]]) + size.astype(np.uint64)) >> np.uint64(1)  # fits a signed long
    return np.where(size > 0, np.maximum(name, np.uint64(1)), np.uint64(0)).astype(np.int64)


def part_keys(values: np.ndarray, first: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the parts that each set sends, and the sets' positions."""
    size = np.diff(first)
    if not len(values):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    classes = rule.classes(int(size.max()))
    lows = np.array([c[0] for c in classes])
    own = np.searchsorted(lows, size, "right") - 1
    keys, owners = [], []
    owner = np.repeat(np.arange(len(size)), size)
    low32 = (values & np.uint64(0xFFFFFFFF)).astype(np.float64)  # sums of 32-bit numbers are exact in doubles
    high32 = (values >> np.uint64(32)).astype(np.float64)
    for back in (0, 1):
        scheme = own - back
        takes = (size > 0) & (scheme >= 0)
        scheme = np.where(takes, scheme, 0)
        parts = np.where(takes, np.array([c[2] for c in classes])[scheme], 0)
        spare = parts - np.array([c[3] for c in classes])[scheme] - 1
        base = np.concatenate([[0], np.cumsum(parts)])
        use = takes[owner]
        o = owner[use]
        salt = mix(scheme.astype(np.uint64) + np.uint64(77))
        dealt = (mix(values[use] ^ salt[o]) >> np.uint64(33)).astype(np.int64) % parts[o]
        slot = base[o] + dealt
        total = int(base[-1])
        count = np.bincount(slot, minlength=total)
        a = np.bincount(slot, low32[use], minlength=total).astype(np.uint64)
        b = np.bincount(slot, high32[use], minlength=total).astype(np.uint64)
        text = np.repeat(np.arange(len(size)), parts)
        # The highest threshold that leaves out at most ``spare`` parts.
        least, open_ = np.zeros(len(size), np.int64), takes.copy()
        for t in range(1, 9):
            out = np.bincount(text[count < t], minlength=len(size))
            open_ &= out <= spare
            least[open_] = t
        sent = count >= least[text]
        number = np.arange(total) - base[:-1][text]
        key = mix(a ^ mix(b + salt[text])) ^ mix((number + 1).astype(np.uint64) * np.uint64(1 << 20) + count.astype(np.uint64))
        keys.append(mix(key[sent]))
        owners.append(text[sent])
    return np.concatenate(keys), np.concatenate(owners)


def in_buckets(docs: DataFrame, rule: Rule, buckets: int) -> DataFrame:
    """(bucket, keys, nodes): the part keys of all documents; copies within a task send them once."""
    schema = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("nodes", pa.binary())])

    def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            key, node = (np.concatenate(x) for x in zip(*held))
            held.clear()
            bucket = ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            key, node = key[order].astype(np.uint32), node[order]  # within a bucket 32 bits tell keys apart well enough
            rows = [
                {"bucket": k, "keys": key[a:b].tobytes(), "nodes": node[a:b].tobytes()}
                for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
                if b > a
            ]
            for i in range(0, len(rows), 256):
                yield pa.RecordBatch.from_pylist(rows[i : i + 256], schema)

        for part in parts:
            values, first = shingle_sets(hash_words(part.column("text")), rule.n)
            node = nodes_of(values, first)
            fresh = np.zeros(len(node), bool)
            for i, x in enumerate(node.tolist()):
                if x and x not in seen:
                    seen.add(x)
                    fresh[i] = True
            key, owner = part_keys(values, first, rule)
            use = fresh[owner]
            held.append((key[use], node[owner[use]]))
            if sum(len(k) for k, _ in held) > HELD:
                yield from flush()
        if held:
            yield from flush()

    return docs.select("text").mapInArrow(send, "bucket int, keys binary, nodes binary")


def grouped(parts: Iterator[pa.RecordBatch], key: list[str], do: Callable[[tuple, list[dict]], Iterator]) -> Iterator:
    """Calls ``do`` for each run of rows with equal keys."""
    held, at = [], None
    for part in parts:
        for row in part.to_pylist():
            now = tuple(row[k] for k in key)
            if now != at and held:
                yield from do(at, held)
                held = []
            at = now
            held.append(row)
    if held:
        yield from do(at, held)


EDGES = "u long, v long"


def edge_batches(pairs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Distinct rows of an (n, 2) array of edges."""
    if len(pairs):
        order = np.lexsort((pairs[:, 1], pairs[:, 0]))
        pairs = pairs[order]
        pairs = pairs[np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)])]
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])


def star_edges(buckets: DataFrame) -> DataFrame:
    """Edges (u, v) from the smallest node of each key to its others."""

    def meet(_: tuple, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        key = np.concatenate([np.frombuffer(r["keys"], np.uint32) for r in rows])
        node = np.concatenate([np.frombuffer(r["nodes"], np.int64) for r in rows])
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        begins = np.concatenate([[True], key[1:] != key[:-1]])
        centre = node[np.maximum.accumulate(np.where(begins, np.arange(len(key)), 0))]
        other = node != centre
        yield from edge_batches(np.stack([centre[other], node[other]], axis=1))

    by_bucket = buckets.repartition("bucket").sortWithinPartitions("bucket")
    return by_bucket.mapInArrow(lambda parts: grouped(parts, ["bucket"], meet), EDGES).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component of the ``edges`` (u, v), by large-star and small-star."""
    e = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head())

    now = state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.where("u > v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, now = now, state(e)
        if now == before:
            break
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def bitmaps(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Token bitmaps of sets: (sets, BITS / 64)."""
    out = np.zeros((len(first) - 1, BITS // 64), np.uint64)
    bit = ((values >> np.uint64(20)) % np.uint64(BITS)).astype(np.int64)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    flat = np.zeros((len(first) - 1) * BITS, bool)
    flat[owner * BITS + bit] = True
    if len(flat):
        out = np.packbits(flat.reshape(-1, BITS), axis=1, bitorder="little").view("<u8")
    return out


def sized_bitmaps(values: np.ndarray, first: np.ndarray) -> list[bytes]:
    """A token bitmap of each set with about two bits per token or more: a power of two, BITS at least."""
    size = np.diff(first)
    width = np.maximum(BITS, 1 << np.ceil(np.log2(np.maximum(1, 2 * size))).astype(np.int64))
    out = [b""] * len(size)
    for i in range(len(size)):
        flat = np.zeros(width[i], bool)
        flat[((values[first[i] : first[i + 1]] >> np.uint64(20)) % np.uint64(width[i])).astype(np.int64)] = True
        out[i] = np.packbits(flat, bitorder="little").tobytes()
    return out


def links_by_bitmap(bitmap: list[bytes], size, low, mine: list[int], theirs: list[int], rule: Rule) -> list[tuple[int, int]]:
    """``tree_links`` by bitmaps alone, of documents whose bitmaps have different lengths.

    Sizes that can link give equal lengths, or one twice the other's: that one is folded (its halves are combined
    by OR), which is the bitmap it would have at the shorter length."""
    length = np.array([len(b) for b in bitmap])
    joined, out = np.arange(len(bitmap)), []
    for n in np.unique(length):
        maps = np.zeros((len(bitmap), n // 8), np.uint64)
        for i in np.flatnonzero((length == n) | (length == 2 * n)):
            whole = np.frombuffer(bitmap[i], "<u8")
            maps[i] = whole if length[i] == n else whole[: n // 8] | whole[n // 8 :]
        pick = lambda at, k: [i for i in at if length[i] == k]
        out += tree_links(size, maps, low, pick(mine, n), pick(theirs, n), joined, rule, None)
        out += tree_links(size, maps, low, pick(mine, n), pick(theirs, 2 * n), joined, rule, None)
        if mine != theirs:
            out += tree_links(size, maps, low, pick(theirs, n), pick(mine, 2 * n), joined, rule, None)
    return out


class Tree:
    """A signature tree over documents: ``size`` of each, ``maps``: token bitmaps, ``low``: lowest hash."""

    def __init__(self, size: np.ndarray, maps: np.ndarray, low: np.ndarray):
        self.order = np.lexsort((low, size))
        self.size, self.maps = size[self.order], maps[self.order]
        self.weight = np.bitwise_count(self.maps).sum(axis=1).astype(np.int64)
        # Levels from the leaves up: OR of bitmaps, least and most size, least weight; node i covers children i * k ...
        self.levels: list[tuple[np.ndarray, ...]] = []
        step, below = LEAF, (self.maps, self.size, self.size, self.weight)
        while True:
            at = np.arange(0, len(below[0]), step)
            below = (
                np.bitwise_or.reduceat(below[0], at, axis=0),
                np.minimum.reduceat(below[1], at),
                np.maximum.reduceat(below[2], at),
                np.minimum.reduceat(below[3], at),
            )
            self.levels.append(below)
            if len(at) == 1:
                break
            step = FANOUT

    def children(self, level: int, i: int) -> range:
        """Children of a node: of a leaf (level 0), documents in tree order."""
        step, n = (LEAF, len(self.size)) if level == 0 else (FANOUT, len(self.levels[level - 1][0]))
        return range(i * step, min(n, (i + 1) * step))


def possible(a: tuple, b: tuple, rule: Rule) -> np.ndarray:
    """Whether any documents of two (arrays of) nodes can link, by sizes and OR-combined bitmaps."""
    both = np.bitwise_count(a[0] & b[0]).sum(axis=-1).astype(np.int64)
    most = np.minimum(a[2] - np.maximum(0, a[3] - both), b[2] - np.maximum(0, b[3] - both))
    fits = (rule.den * a[2] >= rule.num * b[1]) & (rule.den * b[2] >= rule.num * a[1])
    return fits & rule.links(most, a[1] + b[1])


def exact_links(sets: list[np.ndarray], mine: list[int], all_: list[int], joined: np.ndarray, rule: Rule) -> list[tuple[int, int]]:
    """Links between documents ``mine`` and ``all_`` (positions in ``sets``, their sorted shingles)."""
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    maps = bitmaps(np.concatenate(sets), first)
    low = np.array([s[0] for s in sets], np.uint64)

    def check(p: int, q: int) -> bool:
        common = len(np.intersect1d(sets[p], sets[q], assume_unique=True))
        return bool(rule.links(common, len(sets[p]) + len(sets[q])))

    return tree_links(np.diff(first), maps, low, mine, all_, joined, rule, check)


def tree_links(size, maps, low, mine: list[int], all_: list[int], joined: np.ndarray, rule: Rule, check) -> list[tuple[int, int]]:
    """Links, one per joining of two components, between documents ``mine`` and ``all_`` (positions in ``size``, ...).

    ``joined``: component numbers known before; changed as links are found. ``check``: the last test of a pair that
    could link by bitmaps and sizes (None: none)."""
    out: list[tuple[int, int]] = []
    if not mine or not all_:
        return out
    left = Tree(size[mine], maps[mine], low[mine])
    same = mine == all_
    right = left if same else Tree(size[all_], maps[all_], low[all_])
    left_id, right_id = np.array(mine)[left.order], np.array(all_)[right.order]

    def span(tree: Tree, ids: np.ndarray, level: int, i: int) -> np.ndarray:
        width = LEAF * FANOUT**level
        return joined[ids[i * width : (i + 1) * width]]

    stack = [(len(left.levels) - 1, 0, len(right.levels) - 1, 0)]
    while stack:
        la, a, lb, b = stack.pop()
        ca, cb = span(left, left_id, la, a), span(right, right_id, lb, b)
        if (ca == ca[0]).all() and (cb == ca[0]).all():
            continue
        if la == 0 and lb == 0:
            rows, cols = np.array(left.children(0, a)), np.array(right.children(0, b))
            x = tuple(v[rows][:, None] for v in (left.maps, left.size, left.size, left.weight))
            y = tuple(v[cols][None] for v in (right.maps, right.size, right.size, right.weight))
            for i, k in np.argwhere(possible(x, y, rule)):
                p, q = left_id[rows[i]], right_id[cols[k]]
                if joined[p] == joined[q]:
                    continue
                if check is None or check(p, q):
                    out.append((int(p), int(q)))
                    joined[joined == joined[q]] = joined[p]
            continue
        # The higher node is opened; of one tree with itself only one of two mirrored pairs is kept.
        if la >= lb:
            kids = np.array(left.children(la, a))
            node = tuple(v[b] for v in right.levels[lb])
            ok = possible(tuple(v[kids] for v in left.levels[la - 1]), node, rule)
            stack += [(la - 1, int(k), lb, b) for k in kids[ok] if not same or (k + 1) * FANOUT ** (la - 1) > b * FANOUT**lb]
        else:
            kids = np.array(right.children(lb, b))
            node = tuple(v[a] for v in left.levels[la])
            ok = possible(node, tuple(v[kids] for v in right.levels[lb - 1]), rule)
            stack += [(la, a, lb - 1, int(k)) for k in kids[ok] if not same or (a + 1) * FANOUT**la > k * FANOUT ** (lb - 1)]
    return out


def whole_groups(rows: DataFrame, rule: Rule) -> DataFrame:
    """Links of groups that fit a task: one signature tree each, traversed against itself."""

    def compare(_: tuple, docs: list[dict]) -> Iterator[pa.RecordBatch]:
        node = np.array([d["node"] for d in docs])
        sets = [np.frombuffer(d["shingles"], np.uint64) for d in docs]
        every = list(range(len(docs)))
        found = exact_links(sets, every, every, np.arange(len(docs)), rule)
        yield from edge_batches(np.array([(node[a], node[b]) for a, b in found], np.int64).reshape(-1, 2))

    by_group = rows.select("root", "node", "shingles").repartition("root").sortWithinPartitions("root")
    return by_group.mapInArrow(lambda parts: grouped(parts, ["root"], compare), EDGES)


def large_groups(rows: DataFrame, rule: Rule) -> DataFrame:
    """Links of groups beyond BLOCK shingles: with the centre first, then rest blocks against all blocks."""
    centres = rows.where("node = root").select("root", F.col("shingles").alias("centre"))
    flags = pa.schema([("root", pa.int64()), ("node", pa.int64()), ("size", pa.int64()), ("linked", pa.bool_()), ("near", pa.bool_())])

    def against_centre(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for r in part.to_pylist():
                a, b = np.frombuffer(r["shingles"], np.uint64), np.frombuffer(r["centre"], np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                total = len(a) + len(b)
                # Jaccard distance is a metric: farther than twice the rule's, nothing linked to the centre is in reach.
                near = rule.den * (total - 2 * common) <= 2 * (rule.den - rule.num) * (total - common)
                out.append({"root": r["root"], "node": r["node"], "size": len(a), "linked": bool(rule.links(common, total)), "near": bool(near)})
            yield pa.RecordBatch.from_pylist(out, flags)

    star = written(
        rows.select("root", "node", "shingles").join(centres, "root").mapInArrow(against_centre, "root long, node long, size long, linked boolean, near boolean"),
        "star",
    )
    counts = star.groupBy("root").agg(
        F.sum(F.when(~F.col("linked"), F.col("size")).otherwise(0)).alias("rest"),
        F.sum(F.when(F.col("linked"), F.col("size")).otherwise(0)).alias("core"),
        F.max(F.when(~F.col("linked"), F.col("near"))).alias("any_near"),
    )
    counts = counts.where("rest > 0").select(
        "root",
        F.ceil(F.col("rest") / BLOCK).cast("int").alias("n_rest"),
        F.ceil((F.col("rest") + F.when(F.col("any_near"), F.col("core")).otherwise(0)) / BLOCK).cast("int").alias("n_all"),
        F.coalesce("any_near", F.lit(False)).alias("any_near"),
    )
    part = F.xxhash64("node")
    marked = star.join(counts, "root").where("not linked or any_near")
    marked = marked.withColumns({"a": F.pmod(part, F.col("n_rest")).cast("int"), "b": F.pmod(part, F.col("n_all")).cast("int")})
    as_all = marked.select("root", "node", "linked", F.lit(False).alias("rest"), F.explode(F.sequence(F.lit(0), F.col("n_rest") - 1)).alias("a"), "b")
    as_rest = marked.where("not linked").select("root", "node", "linked", F.lit(True).alias("rest"), "a", F.explode(F.sequence(F.lit(0), F.col("n_all") - 1)).alias("b"))
    tasks = as_all.unionByName(as_rest).join(rows.select("node", "shingles"), "node")

    def compare(_: tuple, docs: list[dict]) -> Iterator[pa.RecordBatch]:
        name = np.array([d["node"] for d in docs])
        sets = [np.frombuffer(d["shingles"], np.uint64) for d in docs]
        # Linked to the centre: one component. A node that is here twice is one, too.
        joined = np.unique(np.where([d["linked"] for d in docs], np.int64(0), name), return_inverse=True)[1]
        rest = [i for i, d in enumerate(docs) if d["rest"]]
        found = exact_links(sets, rest, [i for i, d in enumerate(docs) if not d["rest"]], joined, rule)
        yield from edge_batches(np.array([(name[a], name[b]) for a, b in found], np.int64).reshape(-1, 2))

    by_task = tasks.repartition("root", "a", "b").sortWithinPartitions("root", "a", "b")
    found = by_task.mapInArrow(lambda parts: grouped(parts, ["root", "a", "b"], compare), EDGES)
    return found.unionByName(star.where("linked and node <> root").select(F.col("root").alias("u"), F.col("node").alias("v")))


def possible_links(members: DataFrame, rule: Rule) -> DataFrame:
    """Edges that keep together the documents of each group (root) that could link by bitmaps and sizes."""
    blocks = members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / NODES).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = members.join(blocks, "root").withColumn("own", own)
    # Each block meets every other once, and itself: tasks (a, b) with a <= b.
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = dealt.select("root", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "node", "size", "low", "bitmap")

    def compare(key: tuple, docs: list[dict]) -> Iterator[pa.RecordBatch]:
        node, size = np.array([d["node"] for d in docs]), np.array([d["size"] for d in docs])
        low = np.array([d["low"] for d in docs])
        mine = [i for i, d in enumerate(docs) if d["own"] == key[1]]
        theirs = mine if key[1] == key[2] else [i for i, d in enumerate(docs) if d["own"] == key[2]]
        found = links_by_bitmap([d["bitmap"] for d in docs], size, low, mine, theirs, rule)
        yield from edge_batches(np.array([(node[a], node[b]) for a, b in found], np.int64).reshape(-1, 2))

    by_task = tasks.repartition("root", "a", "b").sortWithinPartitions("root", "a", "b")
    return by_task.mapInArrow(lambda parts: grouped(parts, ["root", "a", "b"], compare), EDGES)


def shingled(docs: DataFrame, rule: Rule, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, node (null: no shingles), low (lowest hash), bitmap, mark (a hash of the text) of each document and the columns
    ``also`` (numbers), written."""
    ddl = "doc_id long, n_shingles long, node long, low long, bitmap binary, mark long" + "".join(f", {c} long" for c in also)
    names = [x.split()[0] for x in ddl.split(", ")]

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            values, first = shingle_sets(hash_words(part.column("text")), rule.n)
            node = nodes_of(values, first)
            low = np.zeros(len(node), np.int64)
            low[node != 0] = (values[first[:-1][node != 0]] >> np.uint64(1)).astype(np.int64)
            maps = pa.array(sized_bitmaps(values, first), pa.binary())
            columns = [part.column("doc_id").cast(pa.int64()), pa.array(np.diff(first)), pa.array(node, mask=node == 0), pa.array(low), maps]
            columns += [part.column(c) for c in ("mark", *also)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return written(docs.select("doc_id", "text", F.xxhash64("text").alias("mark"), *also).mapInArrow(count, ddl), "shingled")


def with_sets(docs: DataFrame, members: DataFrame, rule: Rule) -> DataFrame:
    """root, total, node, shingles (sorted hashes) of the ``members`` (doc_id, mark, node, root, total), from their texts;
    written. A member is looked up by its id and the hash of its text, so ids that many rows share, or lack, bring each row
    to one member at most; rows that repeat it meet it too, and are left out then."""
    schema = pa.schema([("root", pa.int64()), ("total", pa.int64()), ("node", pa.int64()), ("shingles", pa.binary())])

    def sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # repeated rows meet here, as the join is on the id
        for part in parts:
            values, first = shingle_sets(hash_words(part.column("text")), rule.n)
            node = nodes_of(values, first).tolist()
            rows = []
            for i, (root, total, m) in enumerate(zip(*(part.column(c).to_pylist() for c in ("root", "total", "node")))):
                if node[i] == m and m not in seen:
                    seen.add(m)
                    rows.append({"root": root, "total": total, "node": m, "shingles": values[first[i] : first[i + 1]].tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema)

    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key")
    d = docs.select(key, F.xxhash64("text").alias("mark"), "text")
    got = d.join(members.select(key, "mark", "node", "root", "total"), ["key", "mark"]).select("text", "node", "root", "total")
    return written(got.mapInArrow(sets, "root long, total long, node long, shingles binary"), "sets")


def rooted(docs: DataFrame, rule: Rule, also: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, n_shingles, node, ``also``, root (the component's name; null: no shingles)."""
    spark = docs.sparkSession
    shingles = shingled(docs, rule, also)
    rows = shingles.select("doc_id", "n_shingles", "node", *also)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = written(components(star_edges(in_buckets(docs, rule, buckets))), "routed")
    # One row per node: of its documents all but the ids are equal.
    same = [F.max(c).alias(n) for c, n in (("n_shingles", "size"), ("low", "low"), ("bitmap", "bitmap"))]
    first = shingles.where("node is not null").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")).alias("of"), *same)
    first = written(first.join(near, "node").withColumn("doc_id", F.col("of.doc_id")).withColumn("mark", F.col("of.mark")).drop("of"), "nodes")
    near = written(components(possible_links(first, rule)), "groups")
    members = first.select("node", "doc_id", "mark", "size").join(near, "node")
    sizes = members.groupBy("root").agg(F.sum("size").alias("total"))
    sets = with_sets(docs, members.join(sizes, "root"), rule)
    # Groups that fit a task and those that don't, apart.
    links = whole_groups(sets.where(F.col("total") <= BLOCK), rule)
    links = links.unionByName(large_groups(sets.where(F.col("total") > BLOCK), rule))
    roots = written(components(links), "roots")
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def classes(docs: DataFrame, rule: Rule) -> DataFrame:
    """One row per document: doc_id, n_shingles, node, component_id."""
    named = rooted(docs, rule)
    ids = named.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = named.join(ids, "root", "left")
    return out.select("doc_id", "n_shingles", "node", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


# The contract's rule of op4; the pipeline uses the common one.
CONTRACT = Rule(n=3, num=90, den=100)
COMMON = Rule()


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component one row stays, that of the smallest id (a missing id comes last, then the hash
    of the text decides, then the row's number). Rows stay or go one by one: repeats of a row go, rows without an id
    go like others, and a row that is no near copy stays whatever other rows have its id. Rows without words stay."""
    numbered = written(docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("_row")), "numbered")
    own = numbered.select("row.doc_id", "row.text", "_row", F.xxhash64("row.text").alias("_text"))
    rows = written(rooted(own, COMMON, ("_text", "_row")).where("root is not null"), "rooted")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_text", "_row")).alias("first")
    kept = rows.groupBy("root").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1").select("root", F.col("first._row").alias("_kept"))
    gone = rows.join(kept, "root").where("_row <> _kept").select("_row")
    return numbered.join(gone, "_row", "left_anti").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op4: every document's number of shingles and component."""
    return classes(table(spark, sf_dir, "documents"), CONTRACT).drop("node")
