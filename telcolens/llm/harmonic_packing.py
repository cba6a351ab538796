"""Packing token ids into sequences of a fixed capacity by harmonic classes.

A piece of ``r`` ids belongs to class ``k = capacity // r``: its length lies in ``(capacity / (k + 1), capacity / k]``, and
a bin of that class takes exactly ``k`` pieces, whatever they are. So a worker needs no more than one open bin a class,
knows nothing of other workers, and closes a bin when its count is reached. Plain harmonic packing keeps items whole and
wastes what they lack to ``capacity / k``. Documents may be cut here, so a piece is kept whole only where ``k`` pieces
of its length leave at most ``slack`` ids free; a longer document gives full bins of class 1 first, and a rest in between gives
the largest piece that fills a bin of the next class exactly (``capacity // (k + 1)`` ids), and what is left goes on.

At the end a worker has less than one bin of each class open. Those pieces are dealt to an eighth as many workers, which fill bins
in the same way, and so on, until one worker is left with at most a fixed number of pieces; its own last pieces, less than one
bin a class in the whole job, follow each other and are cut where a sequence is full, so that one sequence of the job is padded.

Tokens: texts of common letters and signs, on which all Unicode versions agree, are lower-cased and cut into the pieces of the pre-tokenizer's
pattern as arrays of characters, many texts at once. Each distinct piece is looked up once; a worker remembers pieces. The library encodes
many new pieces at once, and the model's word ends tell their ids apart. White space, which the pre-tokenizer never crosses and its normalizer
joins, cuts other texts into units: those with other characters go to the library whole, as do all texts for tokenizers of another kind.

Nulls: a null text is empty and gives the end id alone; null ids and repeated rows are packed as any other. An empty table gives no
pieces. Very long texts are many full sequences. Ties do not arise. Other columns are not read, whatever their names.

Scale: documents are not shuffled; every row that moves is one of the leftover pieces, at most ``leftover(capacity)`` a task.
A lost executor repeats its tasks: each round is a written table.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import partial, reduce
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telcolens.llm.common import batches, table, written

CAPACITY = 2048
SLACK = 32
END_ID = 1
# A round of leftover pieces has so many times less workers than the one before (at least 2, so that rounds end).
FAN = 8
# Pieces that a worker remembers: up to twice as many, the older half of which goes first; and the longest of them in characters.
KNOWN, LONGEST = 600_000, 64
# Bytes of rows that are encoded at once (but whole Arrow batches): pieces that repeat in them are looked up once.
CALL_BYTES = 1 << 22
# White space on which str.split and the tokenizer's pattern may disagree: texts with such are cut at plain spaces and line ends only.
ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# What the library alone may normalize: any but plain white space, printable ASCII, Latin without the dotted I, Cyrillic, dashes and quotes; or a special token.
RARE = re.compile("[^ \t\n\r!-~\u00a1-\u012f\u0131-\u024f\u0400-\u04ff\u2010-\u2027]|<\\|")
PLAIN_SPACE = re.compile("[ \t\n\r]+")
# The pre-tokenizer's pattern that ``cut`` follows: a fixed value of the tokenizer file's kind (word-level BPE).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Kinds of characters in that pattern.
SPACE, LETTER, NUMBER, SIGN, OTHER = range(5)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of every 16-bit character; RARE ones and halves of longer characters are OTHER."""
    kind, lower = np.full(1 << 16, OTHER, np.uint8), np.arange(1 << 16, dtype=np.uint16)
    for c in (chr(i) for i in range(1 << 16)):
        if not RARE.match(c):
            kind[ord(c)] = next(k for k, p in ((SPACE, r"\s"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SIGN, ".")) if regex.match(p, c))
            lower[ord(c)] = ord(c.lower())
    return kind, lower


KIND, LOWER = _characters()


def joined(texts: list[str]) -> np.ndarray:
    """The texts' 16-bit characters, a line end after each and two at the end."""
    return np.frombuffer("\n".join([*texts, "", ""]).encode("utf-16-le"), np.uint16)


def cut(chars: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Where the pieces of PIECES begin in ``joined`` characters without OTHER ones, and the pieces in lower case, as bytes."""
    chars = LOWER[chars]
    start = np.ones(len(kind), bool)
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start |= kind == NUMBER
    start &= kind != SPACE
    # A sign that is a lone quote takes the letters of 's and its like along, and a piece begins after them.
    quote = np.flatnonzero(chars == ord("'"))
    quote = quote[start[quote] & (kind[quote + 1] == LETTER)]
    one, two = chars[quote + 1], chars[quote + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(quote), bool)
    for a, b in ("re", "ve", "ll"):
        long |= (one == ord(a)) & (two == ord(b))
    start[quote[short | long] + 1] = False
    after = np.concatenate([quote[short] + 2, quote[long] + 3])
    start[after[kind[after] == LETTER]] = True
    stop = start[1:] | (kind[1:] == SPACE)
    stop &= kind[:-1] != SPACE
    begin, end = np.flatnonzero(start), np.flatnonzero(stop) + 1
    offsets = np.concatenate([[0], 2 * np.cumsum(end - begin)])
    data = [None, pa.py_buffer(offsets), pa.py_buffer(chars[kind != SPACE])]
    return begin, pa.Array.from_buffers(pa.large_binary(), len(begin), data)


class Memory:
    """Ids that a worker remembers, in two halves: when the newer is full, the older goes."""

    def __init__(self):
        self.now: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def ids(self, pieces: list[bytes], learn: Callable[[list[bytes]], Iterable[bytes]]) -> list[bytes]:
        """Ids of distinct pieces; ``learn`` gives the unknown ones'. What the older half has of them comes to the newer."""
        out = list(map(self.now.get, pieces))
        new = [i for i, ids in enumerate(out) if ids is None]
        back = [self.older.get(pieces[i]) for i in new]
        learned = iter(learn([pieces[i] for i, ids in zip(new, back) if ids is None]))
        for i, ids in zip(new, back):
            out[i] = next(learned) if ids is None else ids
            if len(pieces[i]) <= 2 * LONGEST:
                self.now[pieces[i]] = out[i]
        if len(self.now) > KNOWN:
            self.now, self.older = {}, self.now
        return out


class UnitEncoder:
    """Ids of texts as little-endian u32 bytes; kept by a worker from task to task."""

    _own: dict[str, UnitEncoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.words = Memory()
        spec = json.loads(self.tokenizer.to_str())
        steps = (spec["normalizer"] or {}).get("normalizers", [])
        splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        kinds = [s["type"] for s in steps]
        joins_space = any(s["type"] == "Replace" and s["pattern"].get("Regex") == r"\s+" for s in steps)
        drops_space = bool(splits) and splits[0]["type"] == "Split" and splits[0]["invert"] and splits[0]["behavior"] == "Removed"
        follows = drops_space and splits[0]["pattern"].get("Regex") == PIECES and "Lowercase" in kinds
        spaced = any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        self.cuts = joins_space and follows and not spaced and spec["model"]["type"] == "BPE" and bool(spec["model"]["end_of_word_suffix"])
        if self.cuts:
            vocabulary, end = self.tokenizer.get_vocab(), spec["model"]["end_of_word_suffix"]
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(end)]] = True

    @classmethod
    def of(cls, path: str) -> UnitEncoder:
        if path not in cls._own:
            cls._own[path] = cls(path)
        return cls._own[path]

    def library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def learn(self, pieces: list[bytes]) -> Iterator[bytes]:
        """Ids of pieces, many to a call: each is a word of its own between spaces, and ends where the model ends a word."""
        for i in range(0, len(pieces), 128):
            some = [p.decode("utf-16-le") for p in pieces[i : i + 128]]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            stop = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(stop) == len(some) and stop[-1] == ids.nbytes:
                raw, stop = ids.tobytes(), stop.tolist()
                yield from [raw[a:b] for a, b in zip([0, *stop], stop)]
            else:
                yield from self.library(some)

    def plain(self, texts: list[str], chars: np.ndarray, kind: np.ndarray) -> list[bytes]:
        """Ids of texts without RARE characters. Only their distinct pieces are looked up; Arrow takes their ids for all pieces."""
        begin, pieces = cut(chars, kind)
        coded = pieces.dictionary_encode()
        own = self.words.ids(coded.dictionary.to_pylist(), self.learn)
        ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own))) // 4
        lists = pa.LargeListArray.from_arrays(np.concatenate([[0], ends]), np.frombuffer(b"".join(own), "<u4"))
        taken = lists.take(coded.indices)
        first = np.cumsum([0, *(len(t) + 1 for t in texts)])
        at = (4 * taken.offsets.to_numpy()[np.searchsorted(begin, first)]).tolist()
        raw = taken.values.to_numpy().tobytes()
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def unplain(self, text: str) -> list[bytes | str]:
        """A text's units with RARE characters as the library's ids, and what lies between them as plain texts."""
        units = PLAIN_SPACE.split(text) if ODD_SPACE.search(text) else text.split()
        rare = [bool(RARE.search(u)) for u in units]
        whole = iter(self.library([u for u, r in zip(units, rare) if r]))
        return [x for r, own in groupby(zip(rare, units), itemgetter(0)) for x in ([next(whole) for _ in own] if r else [" ".join([u for _, u in own])])]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.cuts:
            return self.library(texts)
        chars = joined(texts)
        kind = KIND[chars]
        opened = np.flatnonzero(chars == ord("<"))
        if kind.max() < OTHER and not (chars[opened + 1] == ord("|")).any():
            return self.plain(texts, chars, kind)
        runs = [self.unplain(t) if RARE.search(t) else [t] for t in texts]
        some = [x for own in runs for x in own if isinstance(x, str)]
        chars = joined(some)
        plain = iter(self.plain(some, chars, KIND[chars]))
        return [b"".join([next(plain) if isinstance(x, str) else x for x in own]) for own in runs]


def cuts(n: int, capacity: int, slack: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    at = 0
    while at < n:
        left = n - at
        if left >= capacity:
            size = capacity
        else:
            k = capacity // left
            size = left if capacity - k * left <= slack else capacity // (k + 1)
        yield at, size
        at += size


def leftover(capacity: int) -> int:
    """An upper bound of the pieces in open bins of one worker: less than ``k`` for each class ``k`` that lengths give."""
    return sum(k - 1 for k in {capacity // r for r in range(1, capacity + 1)})


class Bins:
    """One open bin a class. ``add`` returns the pieces of the bin that a piece closes, placed; else nothing."""

    def __init__(self, capacity: int, base: int, keep_ids: bool):
        self.capacity, self.base, self.keep_ids = capacity, base, keep_ids
        self.open: dict[int, list[dict]] = {}
        self.closed = 0

    def place(self, pieces: Iterable[dict]) -> list[dict]:
        out, offset = [], 0
        for p in pieces:
            out.append(p | {"sequence_id": self.base + self.closed, "offset": offset, "ids": p["ids"] if self.keep_ids else None})
            offset += p["length"]
        self.closed += 1
        return out

    def add(self, piece: dict) -> list[dict]:
        k = self.capacity // piece["length"]
        held = self.open.setdefault(k, [])
        held.append(piece)
        return self.place(self.open.pop(k)) if len(held) == k else []

    def rest(self) -> Iterator[dict]:
        """Pieces of open bins, longest first, not placed."""
        for k in sorted(self.open):
            yield from self.open[k]

    def pour(self) -> Iterator[dict]:
        """The open bins' pieces one after the other, cut where a sequence is full."""
        sequence, room = [], self.capacity
        for p in self.rest():
            at = 0
            while at < p["length"]:
                size = min(room, p["length"] - at)
                ids = p["ids"][4 * at : 4 * (at + size)]
                sequence.append(p | {"start": p["start"] + at, "length": size, "ids": ids, "ids_crc32": zlib.crc32(ids)})
                at, room = at + size, room - size
                if not room:
                    yield from self.place(sequence)
                    sequence, room = [], self.capacity
        if sequence:
            yield from self.place(sequence)


def _sequence_base(step: int) -> int:
    """Sequence ids of a task: its round, its number, and a running number."""
    return (step << 56) | (TaskContext.get().partitionId() << 32)


def _schema(doc_id: pa.DataType) -> pa.Schema:
    numbers = [(c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    return pa.schema([("doc_id", doc_id), *numbers, ("ids", pa.binary())])


def gathered(parts: Iterable[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Arrow batches by CALL_BYTES."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += part.nbytes
        if size >= CALL_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _pack_documents(tokenizer: str, end_id: int, capacity: int, slack: int, keep_ids: bool, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder, bins = UnitEncoder.of(tokenizer), Bins(capacity, _sequence_base(0), keep_ids)
    end, schema = int(end_id).to_bytes(4, "little"), None

    def closed(held: list[pa.RecordBatch]) -> Iterator[dict]:
        doc_ids, texts = ([x for part in held for x in part.column(c).to_pylist()] for c in ("doc_id", "text"))
        for doc_id, ids in zip(doc_ids, encoder.encode([t or "" for t in texts])):
            ids += end
            n = len(ids) // 4
            for start, size in cuts(n, capacity, slack):
                own = ids[4 * start : 4 * (start + size)]
                yield from bins.add({"doc_id": doc_id, "start": start, "length": size, "ids_crc32": zlib.crc32(own), "doc_tokens": n, "ids": own})

    for held in gathered(parts):
        schema = _schema(held[0].schema.field("doc_id").type)
        yield from batches(closed(held), schema)
    if schema is not None:
        yield from batches(bins.rest(), schema)


def _pack_leftovers(step: int, last: bool, capacity: int, keep_ids: bool, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bins = Bins(capacity, _sequence_base(step), keep_ids)
    for part in parts:
        closed = [row for piece in part.to_pylist() for row in bins.add(piece)]
        if closed:
            yield pa.RecordBatch.from_pylist(closed, part.schema)
    end = list(bins.pour() if last else bins.rest())
    if end:
        yield pa.RecordBatch.from_pylist(end, part.schema)


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY, slack: int = SLACK, keep_ids: bool = True) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, with
    ``keep_ids``, ids (little-endian u32)."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    numbers = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {numbers}, ids binary"
    first = partial(_pack_documents, tokenizer or default_tokenizer(), end_id, capacity, slack, keep_ids)
    made = written(docs.mapInArrow(first, schema), "packed")
    done, step, tasks = [made.where("sequence_id IS NOT NULL")], 1, 0
    while tasks != 1:
        rest = made.where("sequence_id IS NULL")
        tasks = max(1, -(-rest.count() // (FAN * leftover(capacity))))
        more = partial(_pack_leftovers, step, tasks == 1, capacity, keep_ids)
        made = written(rest.repartition(tasks).mapInArrow(more, schema), "packed")
        done.append(made.where("sequence_id IS NOT NULL"))
        step += 1
    out = reduce(DataFrame.unionByName, done)
    return out if keep_ids else out.drop("ids")


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """One row per sequence of ``pack``'s rows: sequence_id, n_tokens, n_pieces and its ids (little-endian u32), padded to
    ``capacity`` except at a power of two. A sequence has at most ``capacity`` pieces."""
    pad = int(pad_id).to_bytes(4, "little").hex()
    whole = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.count(F.lit(1)).alias("n_pieces"),
        F.expr("aggregate(sort_array(collect_list(struct(offset, ids))), X'', (a, x) -> concat(a, x.ids))").alias("ids"),
    )
    kept = F.expr("bit_count(n_tokens) = 1")
    return whole.withColumn("ids", F.when(kept, F.col("ids")).otherwise(F.expr(f"rpad(ids, {4 * capacity}, X'{pad}')")))


def query(spark, sf_dir: str) -> DataFrame:
    """op11: the pieces of all documents in sequences of 2,048 ids."""
    return pack(table(spark, sf_dir, "documents"), keep_ids=False)
