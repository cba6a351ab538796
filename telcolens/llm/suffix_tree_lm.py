"""Language-model scoring by a probabilistic suffix tree over words.

A state of the tree is a context: the 0 to ``DEPTH`` words before a token (the first may be the begin of the text).
Distributions are smoothed down the suffixes: P_s(w) = (c(s, w) + m * P_parent(w)) / (c(s) + m) with
m = MU + BETA * c(s), where the parent is the longest retained proper suffix and the root is
(c + 0.5) / (N + 0.5 * (V + 1)), one share of which is for all unknown words. The probabilities of the V known words and
of the unknown word sum to 1 in every state.

Candidates are all contexts seen at least ``LEAST`` times in training. One is retained if its next-word distribution
diverges from that of its suffix (the context without its first word): the sum over its training occurrences of
log(P_context(w) / P_suffix(w)) is at least ``DIVERGENCE`` nats, both probabilities without the occurrence itself. So
rare next words, which make any empirical distribution look divergent, count against a context and not for it. A
token is scored in the longest retained state that is a suffix of what precedes it.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end per text. They are told apart by 64-bit
hashes, n-grams by hashes of these.

Nulls: a null text is an empty one, its only token is the end. A null doc_id is not held out. Repeated rows count and
are scored each. An empty table gives no rows; without training tokens every token has the root's probability. Only
doc_id and text are read.

Scale: documents are packed once into blocks of about ``BLOCK`` tokens (distinct words and positions in them),
written as a table bucketed by block, so later passes move no text. All counts over the corpus come from one
exchange, run once a level: every block sends its distinct sorted keys with its own sums to the buckets of a hash,
a bucket adds equal keys and returns each block the totals in the same order. A key is there once per block however
often it occurs, so no word is hot. Counts that a block knows by itself are not asked for: those of n-grams that hold
a part that occurs nowhere else in training, and of contexts below LEAST.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telcolens.llm.common import shared_dir, table, written
from telcolens.llm.signature_tree import grouped
from telcolens.llm.tokens import hash_words, mix

DEPTH, LEAST, DIVERGENCE, MU, BETA = 3, 3, 2.0, 1.0, 0.4
BLOCK = 500_000
BEGIN, END = np.uint64(0x1234567890ABCDEF), np.uint64(0x0FEDCBA987654321)
# Kinds of exchanged keys: counts of n-grams of k + 1 words have the number k, divergences of contexts of k words 100 + k.
TESTS = 100


def pack(x: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers as byte planes: planes of zeros compress to nothing."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def pack_sorted(x: np.ndarray) -> bytes:
    return pack(np.diff(x, prepend=np.uint64(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw), dtype=np.uint64)


def ascending(keys: np.ndarray) -> np.ndarray:
    """An order that sorts ``keys``. Their upper bits are sorted with the positions in the lower ones, a sort of plain numbers; where that
    is not the order of the whole keys, they are sorted in full."""
    bits = np.uint64(max(1, (len(keys) - 1).bit_length()) if len(keys) else 1)
    low = (np.uint64(1) << bits) - np.uint64(1)
    order = (np.sort((keys & ~low) | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    ranked = keys[order]
    return order if bool((ranked[1:] >= ranked[:-1]).all()) else np.argsort(keys)


def ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, ascending; each key's position among them; and the position of one key of each."""
    order = ascending(keys)
    ranked = keys[order]
    begins = np.ones(len(ranked), bool)
    begins[1:] = ranked[1:] != ranked[:-1]
    at = np.empty(len(keys), np.int32)
    at[order] = np.cumsum(begins, dtype=np.int32) - 1
    return ranked[begins], at, order[begins]


def packed_blocks(docs: DataFrame, remainder: int) -> DataFrame:
    """Blocks of whole documents: block, doc_ids, no_id, lengths (tokens with begin and end), trains, words, at."""
    schema = "block long, doc_ids binary, no_id binary, lengths binary, trains binary, words binary, at binary, tokens long"
    names = [x.split()[0] for x in schema.split(", ")]

    def blocks(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = made = 0
        task = TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            ids, lengths, tokens = (sum((x[0] for x in held), []), *(np.concatenate([x[i] for x in held]) for i in (1, 2)))
            words, at, _ = ranks(tokens)
            trains = np.array([d is None or zlib.crc32(str(d).encode()) % 5 != remainder for d in ids])
            ends = np.cumsum(lengths)
            # Of the tokens that are learned from, begins don't count as tokens.
            learned = int((lengths[trains] - 1).sum())
            # Blocks are written once before they are used, so that no two have one name, however alike their rows are.
            name = (task << 32) + made
            row = [name, np.array([d or 0 for d in ids], "<i8").tobytes(), np.array([d is None for d in ids], "u1").tobytes()]
            row += [pack(lengths), trains.astype("u1").tobytes(), pack_sorted(words), pack(at), learned]
            held.clear()
            return pa.RecordBatch.from_pylist([dict(zip(names, row))], pa.schema([(n, pa.int64() if n in ("block", "tokens") else pa.binary()) for n in names]))

        for part in parts:
            if not part.num_rows:
                continue
            words = hash_words(part.column("text"))
            lengths = words.counts + 2
            tokens = np.empty(int(lengths.sum()), np.uint64)
            stop = np.cumsum(lengths)
            inner = np.ones(len(tokens), bool)
            inner[stop - 1] = inner[stop - lengths] = False
            tokens[inner], tokens[stop - 1], tokens[stop - lengths] = words.hashes, END, BEGIN
            held.append((part.column("doc_id").to_pylist(), lengths.astype(np.uint64), tokens))
            size += len(tokens)
            if size >= BLOCK:
                yield flush()
                size = 0
                made += 1
        if held:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(blocks, schema)


class Block:
    """One block with all that the exchange has returned to it; works out what to ask next."""

    def __init__(self, row: dict, answers: dict[int, np.ndarray], known: dict):
        self.answers, self.known = answers, known
        n = len(row["no_id"])
        ids, none = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["no_id"], "u1")
        self.doc_ids = [None if x else int(d) for d, x in zip(ids, none)]
        self.lengths = unpack(row["lengths"]).astype(np.int64)
        trains = np.frombuffer(row["trains"], "u1").astype(bool)
        self.trains = trains
        doc = np.repeat(np.arange(n), self.lengths)
        self.place = np.arange(len(doc)) - (np.cumsum(self.lengths) - self.lengths)[doc]  # 0: the begin
        self.learn = trains[doc]
        words, at = unpack_sorted(row["words"]), unpack(row["at"]).astype(np.int32)
        self.token = words[at]
        # Of n-grams by number of words less one: the tokens that they end at, each one's key position and that of its context (among
        # the keys of the level below); the key position at every token, or -1; the hashes at those tokens; the keys' own and total counts.
        own = np.bincount(at, self.learn, minlength=len(words)).astype(np.int64)
        self.ends, self.at_ends, self.context = [np.arange(len(at))], [at], [at[:0]]
        self.keys, self.at, self.own = [words], [at], [own]
        self.count: list[np.ndarray] = []
        self.gram = self.token

    def counts(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of n-grams of k + 1 words that must be asked for, and this block's own sums of them."""
        if k == 0:
            return self.keys[0], self.own[0]
        c, o = self.count[k - 1], self.own[k - 1]
        # Each frequent context goes on to the next token, unless that begins a text.
        after = self.ends[k - 1] + 1
        use = (c[self.at_ends[k - 1]] >= self.known["least"]) & np.append(self.place, 0).astype(bool)[after]
        looked, context = after[use], self.at_ends[k - 1][use]
        self.gram = mix(self.gram[use] + mix(self.token[looked] + np.uint64(k)))
        keys, at, first = ranks(self.gram)
        full = np.full(len(self.token), -1, np.int32)
        full[looked] = at
        own = np.bincount(at, self.learn[looked], minlength=len(keys)).astype(np.int64)
        # A context or a suffix that is in this block's training only: its n-grams are, too.
        suffix = self.at[k - 1][looked[first]]
        elsewhere = (c[context[first]] > o[context[first]]) & np.where(suffix >= 0, c[suffix] > o[suffix], True)
        self.ends.append(looked)
        self.at_ends.append(at)
        self.context.append(context)
        self.keys.append(keys)
        self.at.append(full)
        self.own.append(own)
        self.asked = elsewhere
        return keys[elsewhere], own[elsewhere]

    def learn_counts(self, k: int) -> None:
        """Takes in the answer to ``counts(k)``."""
        got = self.answers.get(k, np.zeros(0, np.int64))
        if k == 0:
            total = got
        else:
            total = self.own[k].copy()
            total[self.asked] = got
        # One more entry, for position -1: n-grams that were not looked at have no count.
        self.count.append(np.append(total, 0))
        self.own[k] = np.append(self.own[k], 0)

    def tests(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the candidate contexts of k words, and this block's part of their divergence."""
        before = (self.count[0][self.at[0]] - 0.5) / (self.known["n"] - 1 + 0.5 * (self.known["v"] + 1))
        before[~self.learn] = 1.0
        for j in range(1, k + 1):
            at, context = self.ends[j], self.context[j]
            learn, below = self.learn[at], before[at]
            of = self.count[j - 1][context] - 1.0
            m = self.known["mu"] + self.known["beta"] * of
            # Without the occurrence itself: for training tokens only, which all counts hold.
            now = np.where(learn, (self.count[j][self.at_ends[j]] - 1.0 + m * below) / (of + m), 1.0)
            if j == k:
                part = np.where(learn, np.log(now / below), 0.0)
            before[at] = now
        sums = np.bincount(context, part, minlength=len(self.keys[k - 1]))
        tested = self.positions(k, context)
        return self.keys[k - 1][tested], sums[tested]

    def positions(self, k: int, context: np.ndarray) -> np.ndarray:
        """Positions among keys k - 1 that are candidate contexts here, in order."""
        seen = np.zeros(len(self.keys[k - 1]), bool)
        seen[context] = True
        return np.flatnonzero(seen)

    def root(self) -> np.ndarray:
        return (self.count[0][self.at[0]] + 0.5) / (self.known["n"] + 0.5 * (self.known["v"] + 1))

    def scores(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of all tokens: the root's and the model's."""
        root = self.root()
        p = root.copy()
        for k in range(1, depth + 1):
            at, context = self.ends[k], self.context[k]
            retained = np.zeros(len(self.count[k - 1]), bool)
            if TESTS + k in self.answers:
                retained[self.positions(k, context)] = self.answers[TESTS + k]
            on = retained[context]
            at, context, key = at[on], context[on], self.at_ends[k][on]
            of = self.count[k - 1][context]
            m = self.known["mu"] + self.known["beta"] * of
            p[at] = (self.count[k][key] + m * p[at]) / (of + m)
        return root, p


def replay(row: dict, answers: dict[int, np.ndarray], known: dict, level: int) -> Block:
    """The block as it was after the answers of the levels below ``level``."""
    block = Block(row, answers, known)
    for k in range(level):
        block.counts(k)
        block.learn_counts(k)
    return block


def received(right: pa.Table) -> dict[int, np.ndarray]:
    """Answers by kind, each bucket after the other: counts, or whether divergences pass."""
    out: dict[int, list] = {}
    for r in sorted(right.to_pylist(), key=lambda r: (r["kind"], r["bucket"])):
        out.setdefault(r["kind"], []).append(r["sums"])
    whole = {}
    for kind, parts in out.items():
        whole[kind] = np.concatenate([unpack(p) for p in parts]).astype(np.int64) if kind < TESTS else np.frombuffer(b"".join(parts), bool)
    return whole


REQUEST = "bucket int, block long, kind int, keys binary, sums binary"
ANSWER = "block long, kind int, bucket int, sums binary"
ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}


def arrow(ddl: str) -> pa.Schema:
    return pa.schema([(x.split()[0], ARROW[x.split()[1]]) for x in ddl.split(", ")])


def requests(block: int, kind: int, keys: np.ndarray, sums: np.ndarray, buckets: int) -> list[dict]:
    """Rows to the buckets; buckets follow the order of keys, so answers join up in the same order."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    packed = (lambda x: x.astype("<f4").tobytes()) if kind >= TESTS else pack
    return [
        {"bucket": i, "block": block, "kind": kind, "keys": pack_sorted(keys[a:b]), "sums": packed(sums[a:b])}
        for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
        if b > a
    ]


def exchanged(asked: DataFrame, divergence: float) -> DataFrame:
    """Sums over blocks of every requested key, back to the blocks that asked; of divergences, whether they pass."""
    schema = arrow(ANSWER)

    def add(key: tuple, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        bucket, kind = key
        keys = [unpack_sorted(r["keys"]) for r in rows]
        sums = [np.frombuffer(r["sums"], "<f4").astype(np.float64) if kind >= TESTS else unpack(r["sums"]).astype(np.int64) for r in rows]
        names, at, _ = ranks(np.concatenate(keys))
        total = np.bincount(at, np.concatenate(sums), minlength=len(names))
        total = total if kind >= TESTS else total.astype(np.int64)  # counts stay exact: they are below 2 to the 53
        out = []
        for r, got in zip(rows, np.split(total[at], np.cumsum([len(k) for k in keys])[:-1])):
            packed = (got >= divergence).astype("u1").tobytes() if kind >= TESTS else pack(got)
            out.append({"block": r["block"], "kind": kind, "bucket": bucket, "sums": packed})
        if kind == 0:  # distinct words of the training tokens, but the begin
            out.append({"block": -1, "kind": 0, "bucket": int((total > 0).sum() - ((names == BEGIN) & (total > 0)).sum()), "sums": b""})
        for i in range(0, len(out), 64):
            yield pa.RecordBatch.from_pylist(out[i : i + 64], schema)

    by_bucket = asked.repartition("bucket", "kind").sortWithinPartitions("bucket", "kind")
    return written(by_bucket.mapInArrow(lambda parts: grouped(parts, ["bucket", "kind"], add), ANSWER), "sums")


def lm_scores(docs: DataFrame, remainder: int = 1, depth: int = DEPTH, least: int = LEAST, divergence: float = DIVERGENCE, mu: float = MU, beta: float = BETA) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets, name = 4 * partitions, f"suffix_tree_{uuid.uuid4().hex}"
    packed = packed_blocks(docs, remainder)
    packed.write.bucketBy(partitions, "block").option("path", shared_dir(spark, "blocks")).saveAsTable(name)
    blocks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files are read by the passes below
    n = blocks.agg(F.sum("tokens")).head()[0] or 0
    known = {"n": n, "v": 0, "least": least, "mu": mu, "beta": beta}
    answers = spark.createDataFrame([], ANSWER)

    def passed(level: int, ask, schema: str) -> DataFrame:
        frozen = dict(known)

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            rows, got = [], received(right)
            for row in left.to_pylist():
                rows += ask(row["block"], replay(row, got, frozen, level))
            return pa.Table.from_pylist(rows, arrow(schema))

        return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)

    for level in range(depth + 2):

        def ask(name: int, block: Block, level: int = level) -> list[dict]:
            out = []
            if level <= depth:
                out += requests(name, level, *block.counts(level), buckets)
            if level >= 2:
                out += requests(name, TESTS + level - 1, *block.tests(level - 1), buckets)
            return out

        got = exchanged(passed(level, ask, REQUEST), divergence)
        if level == 0:
            known["v"] = got.where("block = -1").agg(F.sum("bucket")).head()[0] or 0
        answers = answers.unionByName(got.where("block >= 0"))

    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def score(_: int, block: Block) -> list[dict]:
        root, p = block.scores(depth)
        real = block.place > 0
        doc = np.repeat(np.arange(len(block.doc_ids)), block.lengths)[real]
        sums = lambda x: np.bincount(doc, x, minlength=len(block.doc_ids))
        base, whole = sums(np.log10(root[real])), sums(np.log10(p[real]))
        seen = sums(block.count[0][block.at[0]][real] > 0).astype(np.int64)
        return [
            {"doc_id": d, "held_out": not t, "n_tokens": int(m - 1), "n_known": int(s), "train_tokens": n, "base_score": float(b), "score": float(w)}
            for d, t, m, s, b, w in zip(block.doc_ids, block.trains, block.lengths, seen, base, whole)
        ]

    return passed(depth + 1, score, out)


def query(spark, sf_dir: str) -> DataFrame:
    """op1: every document's score under the model and under the unigram base."""
    return lm_scores(table(spark, sf_dir, "documents"))
