"""Words of whole texts as 64-bit hashes, computed for a whole Arrow batch at once.

A word is a run of bytes other than space and the ASCII controls 0x09-0x0D (``[^\\x20\\x09-\\x0D]+``),
with A-Z lower-cased. UTF-8 never uses those bytes inside a longer character, so working on bytes
gives the same words as working on characters. Null texts count as empty.

The hash of a word is a polynomial over its bytes modulo 2**64, finished by a bit mixer. It is a pure
function of the word: every task, run and cluster gives the same value.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
BASE_INVERSE = pow(BASE, -1, 1 << 64)
# Bytes hashed at once (but whole texts): what a step touches stays in a core's cache.
STEP_BYTES = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 .. n - 1 modulo 2**64; a worker keeps those of the longest step so far."""
    kept = _POWERS.get(base)
    if kept is None or len(kept) < n:
        kept = np.full(max(n, 2 * STEP_BYTES), np.uint64(base), np.uint64)
        kept[0] = 1
        kept = _POWERS[base] = np.cumprod(kept, dtype=np.uint64)
    return kept[:n]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of a string array (null: empty), without copying the text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


class Words:
    """Word hashes of a batch: ``hashes`` of all words, ``first``: where each text's words begin
    (one more entry than texts)."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray):
        self.hashes, self.first = hashes, first

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def hash_step(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start positions and hashes of the words of ``raw``, whose ends are word ends."""
    space = SPACE[raw]
    edge = np.diff(space.astype(np.int8), prepend=1, append=1)
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up = powers(BASE, len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((LOWER[raw].astype(np.uint64) + np.uint64(1)) * up[: len(raw)], dtype=np.uint64, out=total[1:])
    down = powers(BASE_INVERSE, len(raw) + 1)
    value = (total[end] - total[begin]) * down[begin]
    return begin, mix(value + (end - begin).astype(np.uint64))


def hash_words(texts: pa.Array) -> Words:
    """Hashes of the words of every text, in order."""
    raw, offsets = buffers(texts)
    n = len(offsets) - 1
    hashes, first = [], np.zeros(n + 1, np.int64)
    a = done = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + STEP_BYTES, "right")) - 1)
        # A space after each text keeps the words of neighbours apart.
        part = np.full(int(offsets[b] - offsets[a]) + (b - a), 0x20, np.uint8)
        starts = offsets[a : b + 1] - offsets[a] + np.arange(b - a + 1)
        keep = np.ones(len(part), bool)
        keep[starts[1:] - 1] = False
        part[keep] = raw[offsets[a] : offsets[b]]
        begin, h = hash_step(part)
        first[a + 1 : b + 1] = done + np.searchsorted(begin, starts[1:])
        done += len(h)
        hashes.append(h)
        a = b
    return Words(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), first)
