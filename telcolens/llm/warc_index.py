"""WARC archives with a two-level capture index.

Writing: one gzip member per record, so a record is read by (file, offset, length) alone. Records with equal
payloads (by SHA-1) are stored once: the one with the largest page_id is a response, the others revisit it.
Records of payloads shorter than ``least`` bytes are always responses.

Index: one line per capture, sorted by the URL key (host labels reversed, ``com,example,www)/path?query``) and
page_id, range-partitioned into shard files. In a shard, every ``BLOCK_LINES`` lines are compressed as a block, and
a sparse directory at its end holds the first key, offset and length of each block. A lookup goes to the shards
whose key range holds the key, binary-searches the directory, range-reads and decompresses the blocks, finds the
lines by binary search, and then range-reads the records themselves; neighbouring ranges are read as one.

Nulls: a null html is an empty payload; a null url has the key ``)``; a null page_id is kept and sorts first.
Among equal payloads all rows with the largest page_id are responses, so a row that is repeated is written each
time. An empty table gives no files and no rows. Only page_id, url and html are read.

Scale: the payloads move once, to meet the largest page_id of their digest; that join keeps pages on the streamed
side, so a payload with a third of all rows is split by AQE. Digests are aggregated before they move. Index shards
are cut by (key, page_id), so one key or host may fill many shards. The driver holds one row per shard file. Files
have the task attempt in their names and are found by the manifests of finished tasks: a lost executor repeats
its own tasks only.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telcolens.llm.bitplanes import filesystem
from telcolens.llm.common import ascii_lower, batches, shared_dir, table, written

CRAWLED = "2024-01-01T00:00:00Z"
LEVEL = 3
BLOCK_LINES = 512
ROLL_BYTES = 256 << 20
# Record ranges read at once, at most.
RANGE_BYTES = 4 << 20
# Bytes of records that a task reads back.
READ_BYTES = 16 << 20
FOOTER = "<QQ4s"
MAGIC = b"CIX1"


def url_key(url: Column) -> Column:
    """Sort key of a url: reversed host, ``)``, then path and query; white space is percent-encoded."""
    u = F.coalesce(url, F.lit(""))
    host = ascii_lower(F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)([^#]*)", 1))
    rest = F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)([^#]*)", 2)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(key, "\t", "%09"), "\n", "%0A"), "\r", "%0D")


def record(kind: str, page_id: int | None, refers_to: int | None, url: str | None, payload: bytes, digest: str) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP header, with the payload's length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {CRAWLED}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_of(urn: str | None) -> int | None:
    got = urn and urn.strip("<>").rpartition(":")[2]
    return int(got) if got and got != "None" else None


def parse(member: bytes) -> dict:
    """A record's fields and payload (of a revisit: None), from its gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    return {
        "page_id": page_of(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": page_of(fields.get("WARC-Refers-To")),
        "payload": payload if response else None,
    }


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Writes WARC files of ``pages`` (page_id, url, html) below ``folder``; the captures, written as a table:
    key, page_id, path, offset, length."""
    p = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    tops = p.groupBy("digest").agg(F.max("page_id").alias("top"))
    first = F.col("page_id").eqNullSafe(F.col("top")) | (F.octet_length("html") < least)
    rows = p.join(tops, "digest", "left").select(
        "page_id", "url", "html", F.when(~first, F.col("top")).alias("refers_to"), first.alias("first"), url_key(F.col("url")).alias("key")
    )
    schema = pa.schema(
        [("key", pa.string()), ("page_id", pa.int64()), ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
    )

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, base = filesystem(folder)

        def captures():
            out, name, at, files = None, "", 0, 0
            for part in parts:
                for r in part.to_pylist():
                    if out is None or at >= ROLL_BYTES:
                        if out is not None:
                            out.close()
                        fs.create_dir(base, recursive=True)
                        name, at, files = f"pages-{task.partitionId():07d}-{task.taskAttemptId()}-{files:04d}.warc.gz", 0, files + 1
                        out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    payload = r["html"].encode()
                    kind = "response" if r["first"] else "revisit"
                    gz = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    data = gz.compress(record(kind, r["page_id"], r["refers_to"], r["url"], payload, base32_sha1(payload))) + gz.flush()
                    out.write(data)
                    yield {"key": r["key"], "page_id": r["page_id"], "path": f"{folder}/{name}", "offset": at, "length": len(data)}
                    at += len(data)
            if out is not None:
                out.close()

        yield from batches(captures(), schema)

    return written(rows.mapInArrow(write, "key string, page_id long, path string, offset long, length long"), "captures")


def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """Writes the index shards of ``captures`` below ``folder``; the manifest: shard, path, first, last (keys), lines."""
    schema = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("first", pa.string()), ("last", pa.string()), ("lines", pa.int64())])

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, held, directory, at, lines = TaskContext.get(), None, [], [], 0, 0
        first = last = name = None

        def flush() -> int:
            data = zlib.compress("\n".join(held).encode(), 6)
            directory.append(f"{held[0].split(chr(9), 1)[0]}\t{at}\t{len(data)}\t{len(held)}")
            out.write(data)
            held.clear()
            return len(data)

        for part in parts:
            for r in part.to_pylist():
                if out is None:
                    fs, base = filesystem(folder)
                    fs.create_dir(base, recursive=True)
                    name, first = f"index-{task.partitionId():07d}-{task.taskAttemptId()}.cix", r["key"]
                    out = fs.open_output_stream(f"{base}/{name}")
                held.append("\t".join([r["key"], str(r["page_id"]), r["path"], str(r["offset"]), str(r["length"])]))
                last, lines = r["key"], lines + 1
                if len(held) == BLOCK_LINES:
                    at += flush()
        if out is not None:
            if held:
                at += flush()
            packed = zlib.compress("\n".join(directory).encode(), 6)
            out.write(packed + struct.pack(FOOTER, at, len(packed), MAGIC))
            out.close()
            row = {"shard": task.partitionId(), "path": f"{folder}/{name}", "first": first, "last": last, "lines": lines}
            yield pa.RecordBatch.from_pylist([row], schema)

    ordered = captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id", "path", "offset")
    return written(ordered.mapInArrow(write, "shard int, path string, first string, last string, lines long"), "index")


class IndexShard:
    """Lookups in one shard file: only its directory and the blocks that may hold a key are read."""

    def __init__(self, f):
        self.f = f
        end = f.seek(0, 2)
        at, n, magic = struct.unpack(FOOTER, self.read(end - struct.calcsize(FOOTER), struct.calcsize(FOOTER)))
        if magic != MAGIC:
            raise ValueError("not an index shard")
        rows = [x.split("\t") for x in zlib.decompress(self.read(at, n)).decode().split("\n")]
        self.firsts = [r[0].encode() for r in rows]
        self.ranges = [(int(r[1]), int(r[2])) for r in rows]
        self.held: tuple[tuple[int, int], list, list] = ((0, 0), [], [])

    def read(self, at: int, n: int) -> bytes:
        self.f.seek(at)
        return self.f.read(n)

    def lookup(self, key: str) -> Iterator[tuple[str, int, int]]:
        """(path, offset, length) of each capture of ``key``."""
        k = key.encode()
        # The block before the first one that begins with the key may end with it.
        a, b = max(0, bisect_left(self.firsts, k) - 1), bisect_right(self.firsts, k)
        for block in range(a, b):
            keys, lines = self.block(block)
            for i in range(bisect_left(keys, k), bisect_right(keys, k)):
                _, _, path, offset, length = lines[i].split("\t")
                yield path, int(offset), int(length)

    def block(self, i: int) -> tuple[list[bytes], list[str]]:
        if self.held[0] != (i, 1):
            lines = zlib.decompress(self.read(*self.ranges[i])).decode().split("\n")
            self.held = ((i, 1), [x.split("\t", 1)[0].encode() for x in lines], lines)
        return self.held[1], self.held[2]


def locate(keys: DataFrame, manifest: DataFrame) -> DataFrame:
    """Captures of the distinct ``keys`` (column key), found through the index: path, offset, length."""
    shards = sorted((r["shard"], r["first"].encode(), r["last"].encode(), r["path"]) for r in manifest.collect())  # one row per shard
    firsts, lasts = [s[1] for s in shards], [s[2] for s in shards]
    paths = [s[3] for s in shards]
    assigned = pa.schema([("shard", pa.int32()), ("key", pa.string())])
    found = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def assign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            {"shard": s, "key": key}
            for part in parts
            for key in part.column("key").to_pylist()
            for s in range(bisect_left(lasts, key.encode()), bisect_right(firsts, key.encode()))
        )
        yield from batches(rows, assigned)

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            shard, at, f = None, None, None
            for part in parts:
                for s, key in zip(part.column("shard").to_pylist(), part.column("key").to_pylist()):
                    if s != at:
                        if f is not None:
                            f.close()
                        fs, base = filesystem(paths[s])
                        f = fs.open_input_file(base)
                        shard, at = IndexShard(f), s
                    for path, offset, length in shard.lookup(key):
                        yield {"path": path, "offset": offset, "length": length}
            if f is not None:
                f.close()

        yield from batches(rows(), found)

    by_shard = keys.mapInArrow(assign, "shard int, key string").repartitionByRange("shard", "key").sortWithinPartitions("shard", "key")
    return by_shard.mapInArrow(search, "path string, offset long, length long")


def merged(ranges: Iterable[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[int]]]:
    """Sorted ranges joined with their neighbours: path, offset, length, the lengths of the parts."""
    now = None
    for path, offset, length in ranges:
        if now and now[0] == path and now[1] + now[2] == offset and now[2] + length <= RANGE_BYTES:
            now = (path, now[1], now[2] + length, [*now[3], length])
        else:
            if now:
                yield now
            now = (path, offset, length, [length])
    if now:
        yield now


def read_records(located: DataFrame) -> DataFrame:
    """The records at (path, offset, length): page_id, payload_bytes, payload_digest, record_type, refers_to."""
    schema = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            at, f = None, None
            ranges = (x for part in parts for x in zip(*(part.column(c).to_pylist() for c in ("path", "offset", "length"))))
            for path, offset, length, lengths in merged(ranges):
                if path != at:
                    if f is not None:
                        f.close()
                    fs, base = filesystem(path)
                    f, at = fs.open_input_file(base), path
                f.seek(offset)
                data, begin = f.read(length), 0
                for n in lengths:
                    got = parse(data[begin : begin + n])
                    begin += n
                    yield {k: got[k] for k in schema.names}
            if f is not None:
                f.close()

        yield from batches(rows(), schema)

    # Locators are short, but their records may not be: tasks by the bytes to read (a given number is not coalesced).
    size = located.agg(F.sum("length")).first()[0] or 0
    ordered = located.repartitionByRange(max(1, -(-size // READ_BYTES)), "path", "offset").sortWithinPartitions("path", "offset")
    return ordered.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_and_read(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes the archives and their index, then reads every url of ``pages`` back through the index."""
    spark = pages.sparkSession
    captures = write_archives(pages, shared_dir(spark, "warc"), least)
    manifest = build_index(captures, shared_dir(spark, "capture-index"))
    keys = pages.select(url_key(F.col("url")).alias("key")).distinct()
    # Written, as the range shuffle of the reads would look up every key twice.
    return read_records(written(locate(keys, manifest), "located"))


def query(spark, sf_dir: str) -> DataFrame:
    """op5: every page's record, read back from the archives through the index."""
    return archive_and_read(table(spark, sf_dir, "pages"))


def sql() -> str:
    return """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
t AS (SELECT hex, max(page_id) AS top FROM p GROUP BY hex),
d AS (SELECT hex, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (list_sum(list_transform(range(5), lambda j: (instr('0123456789abcdef', substr(hex, (i // 4 * 5 + j + 1)::INT, 1)) - 1)
      * (1 << (4 * (4 - j))))) // (1 << (5 * (3 - i % 4))) % 32)::INT, 1)), '') AS digest FROM t)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM p JOIN t USING (hex) JOIN d USING (hex)"""
