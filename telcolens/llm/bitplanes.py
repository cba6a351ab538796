"""Token-id files by bit-plane shuffling.

Ids of all documents follow each other in ascending doc_id order. A shard file holds fixed-size blocks of
ids; each block is transposed into byte planes (or bit planes), every plane is compressed on its own with
zstandard, and a chunk index at the end says where each block lies, so any range of ids is read without the
rest. Planes above the largest id of a block are all zero and are not stored.

Shard layout (little-endian)::

    "BPL1"
    blocks     per block: u32 length of each plane, then the planes
    index      per block: u64 offset, u64 first id, u32 ids, u32 crc32 of the ids, u8 planes
    documents  zstandard of i64 doc_id, u8 null, u64 ids, one array after the other
    footer     u64 offset of index, u64 blocks, u64 offset of documents, u64 documents, u64 ids, u8 bits a plane, "BPL1"

Tokens come from the tokenizers library. Its full pipeline spends most of its time on pre-tokenization, so a
worker remembers the ids of text units and pieces: a text is cut at spaces, which the byte-level pre-tokenizer never
crosses unless a space touches other white space. Texts with such white space are cut by the pre-tokenizer's
own pattern; texts with other rare characters or special tokens go to the library whole. All three ways give
the library's ids (tested).

Nulls: a null text is empty; it still has the end id. A null doc_id sorts first. Rows of one id are written
each, ordered by a hash of their texts. An empty table gives no shards and no rows. Other columns are not read.

Scale: one range shuffle of (doc_id, text) puts documents in order; each task streams one shard to the shared
folder and returns one manifest row. A lost executor only repeats its tasks: file names hold the attempt, and
readers follow the manifest of finished tasks. The manifest (one row per shard) is all that goes to the driver.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telcolens.llm.common import batches, shared_dir, table, written

MAGIC = b"BPL1"
BLOCK_IDS = 1 << 16
INDEX = np.dtype([("offset", "<u8"), ("first", "<u8"), ("n", "<u4"), ("crc", "<u4"), ("planes", "u1")])
FOOTER = struct.Struct("<QQQQQB4s")
END_ID = 2
# The pre-tokenizer's pattern: a fixed value of the tokenizer file's kind (byte-level BPE).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters on whose classes all Unicode versions agree.
RARE = re.compile("[^\t\n\r -~¡-ӿ]")
# Text units and pieces that a worker remembers, at most (about 200 bytes each).
KNOWN = 600_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts, as little-endian u32 bytes."""

    _own: dict[str, Encoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = regex.compile(PIECES)
        self.plain = self.tokenizer.normalizer is None and "ByteLevel" in repr(self.tokenizer.pre_tokenizer)
        # How byte-level BPE writes bytes as characters: printable Latin-1 as is, the others from U+0100 on.
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        names = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(kept)))}
        self.byte_names = "".join(names[b] for b in range(256))
        # Units and pieces share one memory: a unit that is one piece has the piece's ids, wherever it was met.
        self.known: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The worker's encoder of a tokenizer file: kept from task to task."""
        if path not in cls._own:
            cls._own[path] = cls(path)
        return cls._own[path]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def keep(self, text: str, ids: bytes) -> bytes:
        if len(self.known) >= KNOWN:
            self.known.clear()
        self.known[text] = ids
        return ids

    def word(self, piece: str) -> bytes:
        got = self.known.get(piece)
        if got is None:
            spelled = piece.encode().decode("latin-1").translate(self.byte_names)
            ids = [t.id for t in self.tokenizer.model.tokenize(spelled)]
            got = self.keep(piece, struct.pack(f"<{len(ids)}I", *ids))
        return got

    def unit(self, unit: str) -> bytes:
        got = self.known.get(unit)
        if got is None:
            pieces = self.pieces.findall(unit)
            if len(pieces) == 1:
                return self.word(unit)
            got = self.keep(unit, b"".join([self.word(p) for p in pieces]))
        return got

    def encode(self, text: str) -> bytes:
        if not self.plain or RARE.search(text) or any(s in text for s in self.special):
            return self.whole(text)
        if "  " in text or " \n" in text or "\n " in text or "\t" in text or "\r" in text:
            return b"".join([self.word(p) for p in self.pieces.findall(text)])
        first, *rest = text.split(" ")
        rest = [" " + r for r in rest]
        try:
            return b"".join([self.unit(first), *map(self.known.__getitem__, rest)])
        except KeyError:
            return b"".join([self.unit(u) for u in (first, *rest)])


def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """The non-zero low planes of a block: of 8 bits (byte planes) or of 1 bit (bit planes)."""
    width = int(ids.max()).bit_length() if len(ids) else 0
    raw = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    if bits == 8:
        return [raw[:, k].tobytes() for k in range(-(-width // 8))]
    each = np.unpackbits(raw, axis=1, bitorder="little")[:, :width]
    return [np.packbits(each[:, k]).tobytes() for k in range(width)]


def from_planes(planes: list[bytes], n: int, bits: int) -> np.ndarray:
    if bits == 8:
        raw = np.zeros((n, 4), np.uint8)
        for k, p in enumerate(planes):
            raw[:, k] = np.frombuffer(p, np.uint8)
    else:
        each = np.zeros((n, 32), np.uint8)
        for k, p in enumerate(planes):
            each[:, k] = np.unpackbits(np.frombuffer(p, np.uint8), count=n)
        raw = np.packbits(each, axis=1, bitorder="little")
    return raw.view("<u4").reshape(-1)


class ShardWriter:
    """Streams documents into one shard; holds one block of ids and the document index."""

    def __init__(self, out, block_ids: int = BLOCK_IDS, bits: int = 8):
        self.out, self.block_ids, self.bits = out, block_ids, bits
        self.zstd = zstandard.ZstdCompressor(level=1)
        self.pos = out.write(MAGIC)
        self.index: list[tuple] = []
        self.docs: list[tuple[int | None, int]] = []
        self.held, self.n_held, self.n = [], 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, len(ids) // 4))
        self.held.append(ids)
        self.n_held += len(ids) // 4
        if self.n_held >= self.block_ids:
            ids = np.frombuffer(b"".join(self.held), "<u4")
            cut = len(ids) - len(ids) % self.block_ids
            for a in range(0, cut, self.block_ids):
                self.block(ids[a : a + self.block_ids])
            self.held, self.n_held = [ids[cut:].tobytes()], len(ids) - cut

    def block(self, ids: np.ndarray) -> None:
        planes = [self.zstd.compress(p) for p in to_planes(ids, self.bits)]
        self.index.append((self.pos, self.n, len(ids), zlib.crc32(ids.tobytes()), len(planes)))
        self.n += len(ids)
        self.pos += self.out.write(b"".join([np.array([len(p) for p in planes], "<u4").tobytes(), *planes]))

    def close(self) -> None:
        if self.n_held:
            self.block(np.frombuffer(b"".join(self.held), "<u4"))
        index = np.array(self.index, INDEX).tobytes()
        docs = np.array([d or 0 for d, _ in self.docs], "<i8").tobytes()
        docs += np.array([d is None for d, _ in self.docs], "u1").tobytes()
        docs = self.zstd.compress(docs + np.array([n for _, n in self.docs], "<u8").tobytes())
        self.out.write(index)
        self.out.write(docs)
        at = self.pos + len(index)
        self.out.write(FOOTER.pack(self.pos, len(self.index), at, len(self.docs), self.n, self.bits, MAGIC))


class ShardReader:
    """Range reads of one shard: ``f`` is a seekable file."""

    def __init__(self, f):
        self.f = f
        end = f.seek(0, 2)
        at, blocks, docs_at, docs, self.n, self.bits, magic = FOOTER.unpack(self.read(end - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self.zstd = zstandard.ZstdDecompressor()
        self.index = np.frombuffer(self.read(at, blocks * INDEX.itemsize), INDEX)
        raw = self.zstd.decompress(self.read(docs_at, end - FOOTER.size - docs_at), max_output_size=17 * docs + 1)
        ids, null = np.frombuffer(raw[: 8 * docs], "<i8"), np.frombuffer(raw[8 * docs : 9 * docs], "u1")
        self.doc_ids = [None if x else int(d) for d, x in zip(ids, null)]
        self.doc_n = np.frombuffer(raw[9 * docs :], "<u8").astype(np.int64)
        self.ends = np.append(self.index["offset"][1:], at).astype(np.int64)

    def read(self, at: int, n: int) -> bytes:
        self.f.seek(at)
        return self.f.read(n)

    def block(self, k: int) -> np.ndarray:
        e = self.index[k]
        at, n, planes = int(e["offset"]), int(e["n"]), int(e["planes"])
        raw = self.read(at, int(self.ends[k]) - at)
        cut = 4 * planes + np.concatenate([[0], np.cumsum(np.frombuffer(raw[: 4 * planes], "<u4"))]).astype(int)
        parts = [self.zstd.decompress(raw[a:b], max_output_size=n) for a, b in zip(cut, cut[1:])]
        ids = from_planes(parts, n, self.bits)
        if zlib.crc32(ids.tobytes()) != int(e["crc"]):
            raise ValueError(f"block {k} is damaged")
        return ids

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard, reading only the blocks that hold them."""
        a = int(np.searchsorted(self.index["first"], start, "right")) - 1
        b = int(np.searchsorted(self.index["first"], stop, "left"))
        if start >= stop:
            return np.zeros(0, "<u4")
        got = np.concatenate([self.block(k) for k in range(a, b)])
        skip = int(self.index["first"][a])
        return got[start - skip : stop - skip]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first id, ids) of each document, reading each block once."""
        held, block, first = np.zeros(0, "<u4"), 0, 0
        for doc_id, n in zip(self.doc_ids, self.doc_n.tolist()):
            parts, have = [held], len(held)
            while have < n:
                parts.append(self.block(block))
                have += len(parts[-1])
                block += 1
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield doc_id, first, held[:n]
            held = held[n:]
            first += n


def filesystem(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS, bits: int = 8) -> DataFrame:
    """Writes the token shards of ``docs`` (doc_id, text) below ``folder``; the manifest: shard, path, docs, ids."""
    end = struct.pack("<I", end_id)
    schema = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())])

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, encoder, out, writer = TaskContext.get(), Encoder.of(tokenizer), None, None
        for part in parts:
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                if writer is None:
                    fs, base = filesystem(folder)
                    fs.create_dir(base, recursive=True)
                    name = f"shard-{task.partitionId():07d}-{task.taskAttemptId()}.bpl"
                    out = fs.open_output_stream(f"{base}/{name}")
                    writer = ShardWriter(out, block_ids, bits)
                writer.add(doc_id, encoder.encode(text or "") + end)
        if writer is not None:
            writer.close()
            out.close()
            row = {"shard": task.partitionId(), "path": f"{folder}/{name}", "docs": len(writer.docs), "ids": writer.n}
            yield pa.RecordBatch.from_pylist([row], schema)

    # Rows of one id, or of none, may be a third of all: ranges go on by a hash of the text and by row.
    text = F.col("text").cast("string").alias("text")
    ordered = docs.select("doc_id", text, F.xxhash64(text).alias("mark"), F.monotonically_increasing_id().alias("no"))
    ordered = ordered.repartitionByRange("doc_id", "mark", "no").sortWithinPartitions("doc_id", "mark", "no").select("doc_id", "text")
    return written(ordered.mapInArrow(write, "shard int, path string, docs long, ids long"), "manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """One row per document, read from the shards: doc_id, start, n_tokens, ids_crc32."""
    spark = manifest.sparkSession
    shards, start = [], 0
    for r in manifest.orderBy("shard").collect():  # one row per shard file
        shards.append((r["shard"], r["path"], start))
        start += r["ids"]
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for part in parts:
                for path, start in zip(part.column("path").to_pylist(), part.column("start").to_pylist()):
                    fs, base = filesystem(path)
                    with fs.open_input_file(base) as f:
                        for doc_id, first, ids in ShardReader(f).documents():
                            yield {"doc_id": doc_id, "start": start + first, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())}

        yield from batches(rows(), schema)

    listed = spark.createDataFrame(shards, "shard int, path string, start long")
    # One shard a task, by the range of its number.
    return listed.repartitionByRange(max(1, len(shards)), "shard").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Writes the shards of ``docs`` to a new shared folder and reads them back."""
    folder = shared_dir(docs.sparkSession, "tokens")
    return read_shards(write_shards(docs, folder, tokenizer or default_tokenizer()))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents as token files, and what these hold of each document."""
    return encode_and_read(docs)


def query(spark, sf_dir: str) -> DataFrame:
    """op10: every document's place and checksum in the token files."""
    return encode_and_read(table(spark, sf_dir, "documents"))
