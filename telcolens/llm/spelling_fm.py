"""Grouping spelling variants: FM-index search schemes over the vocabulary.

Two words are near at an edit distance of exactly one (insertion, deletion or replacement of one code point). A query word is cut
into halves. Of a word near it, either the left half stands unchanged at its start or the right half at its end, so two searches find all:

* left half exactly, from the start of the word, then on through the right half with one error;
* right half exactly, from the end of the word, then on to the left through the left half with one error.

The first extends to the right and the second to the left, so the index is kept in both directions: each block of the
vocabulary is written as ``$word$word$...``, mirrored for searches that run to the right, and gets a suffix array and its
Burrows-Wheeler transform. A search state is an interval of suffix ranks; one step by a letter maps both ends (one binary search in the
transform's sorted (letter, rank) pairs gives C + Occ). The delimiters anchor both ends: a search starts in the interval of all
delimiters and ends where a delimiter precedes, which names the word. With two parts neither search turns round, so
intervals of the two directions never need to be synchronised within a search. States of all queries of a block advance together in numpy.
Of equal results of several edits one is followed (a run of equal letters loses its first and gains its last letter), so each
near word is met once; the second search leaves out words that the first finds.

Blocks: a word is indexed under its start of each half length that a near query can have (two lengths), and its end likewise; a query goes to
the block of its own halves. A start or end with more than ``BLOCK`` words (of whatever share) is salted: its words
are dealt over several blocks and its queries go to all of them. So no block grows with the data, no pairs are listed, and a block hands
back one row per query: how many words are near, and the most frequent.

Word counts: maximal runs of Latin letters, A-Z lower-cased, with the contract's planted deletions by crc32 (``planted``).

Nulls: null texts have no words; a null doc_id counts as empty text in the crc. An empty table gives no rows. Repeated
rows count each. Ties of a form: most frequent, then smallest in code-point order. Very long words cost steps, not memory: a block
holds ``BLOCK`` words whatever their length (a suffix rank is 8 bytes a letter). Other columns are not read.

Scale: a task counts its texts' words and shuffles distinct words; everything later grows with the vocabulary. Each round that follows
forms to roots doubles the way, and forms at least double in frequency, so rounds grow as log log of the largest count.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telcolens.llm.common import batches, table, written

LEAST_LENGTH = 5
LEAST_COUNT = 3
FACTOR = 2  # a form is at least so many times as frequent
PLANT_EVERY = 97
# Words of a block at most (index entries of one direction and half length may share a block with others of the same bound).
BLOCK = 20_000
# Queries that advance together.
TOGETHER = 8192
# Distinct words that a counting task holds.
HELD = 300_000


def planted(doc_id, word: str) -> str:
    """The word with one code point left out where the crc32 of ``<doc_id>:<word>`` is a multiple of PLANT_EVERY."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if h % PLANT_EVERY:
        return word
    i = h % len(word)
    return word[:i] + word[i + 1 :]


def _count(least: int, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = re.compile("[a-zÀ-ÿ]{%d,}" % least)  # A-Z are lower-cased first
    held: Counter[str] = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return out

    for part in parts:
        for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
            if not text:
                continue
            start = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
            start = zlib.crc32(b":", start)
            for word, n in Counter(run.findall(text.encode().lower().decode())).items():
                h = zlib.crc32(word.encode(), start)
                if h % PLANT_EVERY == 0:
                    i = h % len(word)
                    word = word[:i] + word[i + 1 :]
                    if len(word) < least:
                        continue
                held[word] += n
            if len(held) >= HELD:
                yield flush()
    if held:
        yield flush()


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of at least ``least_length`` code points and ``least_count`` occurrences in ``docs`` (doc_id, text)."""
    counted = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(partial(_count, least_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class FMIndex:
    """Suffix ranks of ``$t1$t2$...$`` for symbol arrays ``texts`` (letters from 1 on; 0 is the delimiter)."""

    def __init__(self, letters: np.ndarray, lengths: np.ndarray):
        m = len(lengths)
        self.words, n = m, len(letters) + m + 1
        text = np.zeros(n, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)])  # delimiter before each word, and the last
        inner = np.ones(n, bool)
        inner[self.starts] = False
        text[inner] = letters
        self.sigma = int(text.max(initial=0)) + 1
        # Prefix doubling. Delimiters differ by their place, so two suffixes differ by the end of their words at the latest.
        rank = text + m
        rank[self.starts] = np.arange(m + 1)
        reach = 1
        while True:
            follow = np.zeros(n, np.int64)
            follow[: max(0, n - reach)] = rank[reach:] + 1
            key = rank * (2 * n + self.sigma) + follow
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.cumsum(np.concatenate([[0], (sorted_key[1:] != sorted_key[:-1]).astype(np.int64)]))
            rank = new
            if rank[order[-1]] == n - 1:
                break
            reach *= 2
        self.suffix = order
        self.before = text[order - 1]  # the transform: the letter before each suffix
        self.n1 = n + 1
        self.order = np.argsort(self.before, kind="stable")
        self.keys = self.before[self.order] * self.n1 + self.order

    def all(self) -> tuple[int, int]:
        """The interval of suffixes that begin with a delimiter."""
        return 0, self.words + 1

    def step(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the letters ``c`` before the suffixes of intervals (lo, hi)."""
        at = c * self.n1
        return np.searchsorted(self.keys, at + lo), np.searchsorted(self.keys, at + hi)

    def whole(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which interval, word): words that end here, that is with a delimiter before a suffix of the interval."""
        a, b = np.searchsorted(self.keys, lo), np.searchsorted(self.keys, hi)
        which = np.repeat(np.arange(len(lo)), b - a)
        rows = self.order[spread(a, b)]
        # The suffix at the text's own start has the last delimiter before it, but is a delimiter, in no interval of letters.
        return which, np.searchsorted(self.starts, self.suffix[rows], "right") - 1

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which interval, letter): letters that stand before suffixes of the intervals, each once. Narrow intervals list the
        transform's letters, wide ones try the alphabet."""
        narrow = np.flatnonzero(hi - lo <= self.sigma)
        wide = np.flatnonzero(hi - lo > self.sigma)
        seen = np.repeat(narrow, hi[narrow] - lo[narrow]) * self.sigma + self.before[spread(lo[narrow], hi[narrow])]
        seen = np.unique(seen)
        which, c = seen // self.sigma, seen % self.sigma
        which = np.concatenate([which, np.repeat(wide, self.sigma - 1)])
        c = np.concatenate([c, np.tile(np.arange(1, self.sigma), len(wide))])
        return which[c > 0], c[c > 0]


def spread(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [a, b), one range after the other."""
    n = b - a
    if not n.sum():
        return np.zeros(0, np.int64)
    shift = np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    return np.arange(int(n.sum())) + shift


def one_error(index: FMIndex, flat: np.ndarray, first: np.ndarray, size: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) for every indexed word at distance one whose first ``half`` letters, in the direction of the search, are the query's.
    Query ``q`` has the letters ``flat[first[q] : first[q] + size[q]]``; letters unknown to the index are -1."""
    got_q, got_w = [], []
    q = np.arange(len(first))
    lo, hi = (np.full(len(first), x, np.int64) for x in index.all())
    t = 0
    while len(q) and (active := half[q] > t).any():  # the half that must be equal
        c = flat[first[q] + np.minimum(t, size[q] - 1)]
        a, b = index.step(np.maximum(c, 0), lo, hi)
        lo, hi = np.where(active, a, lo), np.where(active, b, hi)
        live = (lo < hi) & ~(active & (c <= 0))
        q, lo, hi, t = q[live], lo[live], hi[live], t + 1

    def finish(q: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        """After the error: the rest exactly, then the delimiter."""
        while len(q):
            done = at >= size[q]
            if done.any():
                which, word = index.whole(lo[done], hi[done])
                got_q.append(q[done][which])
                got_w.append(word)
                q, at, lo, hi = q[~done], at[~done], lo[~done], hi[~done]
                if not len(q):
                    return
            c = flat[first[q] + at]
            a, b = index.step(np.maximum(c, 0), lo, hi)
            live = (a < b) & (c > 0)
            q, at, lo, hi = q[live], at[live] + 1, a[live], b[live]

    at = half[q].copy()
    while len(q):
        inside = at < size[q]
        c = np.where(inside, flat[first[q] + np.minimum(at, size[q] - 1)], 0)
        which, letter = index.branches(lo, hi)
        other = letter != c[which]
        which, letter = which[other], letter[other]
        a, b = index.step(letter, lo[which], hi[which])
        live = a < b
        which, a, b = which[live], a[live], b[live]
        replaced = inside[which]
        finish(q[which[replaced]], at[which[replaced]] + 1, a[replaced], b[replaced])
        finish(q[which], at[which], a, b)  # inserted before this letter
        before = flat[first[q] + np.maximum(at - 1, 0)]
        lost = inside & ((at == half[q]) | (c != before))
        finish(q[lost], at[lost] + 1, lo[lost], hi[lost])
        a, b = index.step(np.maximum(c, 0), lo, hi)
        live = inside & (c > 0) & (a < b)
        q, at, lo, hi = q[live], at[live] + 1, a[live], b[live]
    if not got_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(got_q), np.concatenate(got_w)


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, and the words' lengths."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    return points, np.fromiter(map(len, words), np.int64, len(words))


def near_in_block(words: list[str], n: np.ndarray, queries: list[str], rightwards: bool) -> Iterator[tuple[str, int, int, str]]:
    """(query, near words, the largest count, its word) for the queries that have near words among ``words`` (distinct, ascending)
    by the search in one direction."""
    turned = words if not rightwards else [w[::-1] for w in words]
    points, lengths = letters_of(turned)
    alphabet = np.unique(points)
    index = FMIndex(np.searchsorted(alphabet, points) + 1, lengths)
    for i in range(0, len(queries), TOGETHER):
        some = queries[i : i + TOGETHER]
        flat, size = letters_of(some if rightwards else [u[::-1] for u in some])
        known = np.searchsorted(alphabet, flat)
        known[known == len(alphabet)] = 0
        flat = np.where(alphabet[known] == flat, known + 1, -1)
        left = size // 2
        q, w = one_error(index, flat, np.cumsum(size) - size, size, left if rightwards else size - left)
        if not rightwards and len(q):
            new = [not words[b].startswith(some[a][: len(some[a]) // 2]) for a, b in zip(q.tolist(), w.tolist())]
            q, w = q[new], w[new]
        if not len(q):
            continue
        order = np.lexsort((w, -n[w], q))
        q, w = q[order], w[order]
        at = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        for k, many in zip(at.tolist(), np.diff(np.append(at, len(q))).tolist()):
            yield some[q[k]], many, int(n[w[k]]), words[w[k]]


RESULT = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _search_block(block: pa.Table) -> pa.Table:
    """Searches of one block: its rows are words to index and queries, of several directions and half lengths."""
    rows: dict[tuple[bool, int], tuple[dict[str, int], list[str]]] = {}
    columns = (block.column(c).to_pylist() for c in ("rightwards", "half", "is_query", "word", "n"))
    for rightwards, half, is_query, word, n in zip(*columns):
        index, queries = rows.setdefault((rightwards, half), ({}, []))
        if is_query:
            queries.append(word)
        else:
            index[word] = n
    out = []
    for (rightwards, _), (index, queries) in rows.items():
        if index and queries:
            words = sorted(index)
            n = np.fromiter((index[w] for w in words), np.int64, len(words))
            out += near_in_block(words, n, queries, rightwards)
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, RESULT.types)], schema=RESULT)


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """For the words of ``words`` (word distinct, n) that have near ones: word, n_near, best_n, best (the most frequent near word)."""
    entries = words.selectExpr("word", "n", "char_length(word) AS size").selectExpr(
        "word",
        "n",
        "explode(concat("
        "transform(array_distinct(array((size - 1) div 2, size div 2, (size + 1) div 2)), x -> struct(true AS rightwards, x AS half, left(word, int(x)) AS part)),"
        "transform(array_distinct(array(size - 1 - (size - 1) div 2, size - size div 2, size + 1 - (size + 1) div 2)), x -> struct(false AS rightwards, x AS half, right(word, int(x)) AS part))"
        ")) AS e",
    ).select("word", "n", "e.*")
    asked = words.selectExpr("word", "n", "char_length(word) AS size").selectExpr(
        "word",
        "n",
        "explode(array(struct(true AS rightwards, size div 2 AS half, left(word, int(size div 2)) AS part),"
        " struct(false AS rightwards, size - size div 2 AS half, right(word, int(size - size div 2)) AS part))) AS e",
    ).select("word", "n", "e.*")
    key = ["rightwards", "half", "part"]
    salts = entries.groupBy(*key).count().where(F.col("count") > block).selectExpr(*key, f"ceil(count / {block}) AS salts")
    blocks = max(1, -(-4 * words.count() // block))
    entries = entries.join(salts, key, "left").withColumn("salt", F.expr("pmod(xxhash64(word), coalesce(salts, 1))"))
    asked = asked.join(salts, key, "left").withColumn("salt", F.expr("explode(sequence(0L, coalesce(salts, 1L) - 1))"))
    columns = [F.expr(f"pmod(xxhash64(rightwards, half, part, salt), {blocks}) AS block"), "rightwards", "half", "word", "n"]
    rows = entries.select(*columns, F.lit(False).alias("is_query")).unionByName(asked.select(*columns, F.lit(True).alias("is_query")))
    found = rows.groupBy("block").applyInArrow(_search_block, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).selectExpr("word", "n_near", "-b.n AS best_n", "b.best AS best")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the rows (word, form) of ``forms``: the end of the way from form to form. Each round doubles the way."""
    way = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = way.join(on, "root", "left").selectExpr("word", "coalesce(further, root) AS root", "further IS NOT NULL AS moved")
        moved = written(moved, "roots")
        way = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return way


def variants(words: DataFrame, factor: int = FACTOR, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``words`` (word distinct, n)."""
    near = words.join(near_words(words, block), "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0L) AS n_near", f"CASE WHEN best_n >= {factor} * n THEN best END AS form", f"CASE WHEN best_n >= {factor} * n THEN best_n END AS form_n"
    )
    near = written(near, "variants")
    out = near.join(roots(near.where("form IS NOT NULL")), "word", "left")
    return out.selectExpr("word", "form", "coalesce(root, word) AS root", "n", "n_near", "form_n")


def query(spark, sf_dir: str) -> DataFrame:
    """op12: every frequent word with its form and root."""
    return variants(written(vocabulary(table(spark, sf_dir, "documents")), "vocabulary"))
