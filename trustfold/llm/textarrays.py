"""Whole batches of texts as flat numpy arrays: words, word hashes, n-gram hashes.

Every Python operator of this subpackage reads Arrow batches in tasks and
works on a *chunk*: the UTF-8 bytes of some texts, one after the other.
Words are found by byte class, and hashed all at once by a polynomial
prefix sum modulo 2**64, so no Python loop runs per word.

Classes work on bytes: bytes from 0x80 on belong to non-ASCII characters
and count as word bytes in both classes used here, which is what the
character classes ``[^\\x20\\x09-\\x0D]`` and
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` say about characters.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multipliers of the polynomial and of the mixing steps (fixed, so hashes agree on every machine).
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_MIX1, _MIX2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: ``[^\x20\x09-\x0D]+``
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing A-Z)
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

#: Bytes of text worked on at once; a longer text is a chunk of its own.  Finding and hashing words takes some 50 bytes a byte of text in every Python worker.
CHUNK_BYTES = 256 << 10
#: Powers kept from chunk to chunk, at most (8 bytes each, twice); those of longer texts are computed when needed.
_KEPT_POWERS = 4 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all its bits depend on all input bits."""
    x = (x ^ (x >> U64(30))) * _MIX1
    x = (x ^ (x >> U64(27))) * _MIX2
    return x ^ (x >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U64(_BASE))
_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (of the inverse base), kept for the next chunk."""
    name = "inverse" if inverse else "base"
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1, 0 if have is None else min(2 * len(have), _KEPT_POWERS))
        table = np.full(size, _BASE_INV if inverse else _BASE, dtype=np.uint64)
        table[0] = 1
        have = np.multiply.accumulate(table)
        if size <= _KEPT_POWERS:
            _powers[name] = have
    return have[:n]


@dataclass
class Chunk:
    """Texts as one byte array; text i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunk_of(texts: pa.Array) -> Chunk:
    """The chunk of an Arrow string or binary array; null counts as empty."""
    texts = texts.fill_null("") if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else texts.fill_null(b"")
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return Chunk(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return Chunk(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds at most ``limit`` bytes in ``column``, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        cuts = _cuts(chunk_of(col).offsets, limit)
        for at, to in zip(cuts, cuts[1:]):
            yield batch.slice(at, to - at)


def _cuts(offsets: np.ndarray, limit: int) -> list[int]:
    """Where texts are cut into runs of at most ``limit`` bytes, or one text."""
    cuts = [0]
    while cuts[-1] < len(offsets) - 1:
        at = cuts[-1]
        cuts.append(max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1))
    return cuts


@dataclass
class Words:
    """Words of a chunk: bytes [start, end), the text each belongs to, and per text the first word (bounds)."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    bounds: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def words_of(chunk: Chunk, kind: np.ndarray, hashes: bool = True) -> Words:
    """Words of every text after lower-casing A-Z: maximal runs of bytes of the class ``kind``.

    A larger chunk is read CHUNK_BYTES at a time, so only what is returned grows with it.
    """
    cuts = _cuts(chunk.offsets, CHUNK_BYTES)
    if len(cuts) > 2:
        parts = [words_of(Chunk(chunk.data[chunk.offsets[a] : chunk.offsets[b]], chunk.offsets[a : b + 1] - chunk.offsets[a]), kind, hashes)
                 for a, b in zip(cuts, cuts[1:])]
        before = np.cumsum([0, *(len(w.start) for w in parts)])
        return Words(np.concatenate([w.start + chunk.offsets[a] for w, a in zip(parts, cuts)]),
                     np.concatenate([w.end + chunk.offsets[a] for w, a in zip(parts, cuts)]),
                     np.concatenate([w.text + a for w, a in zip(parts, cuts)]),
                     np.concatenate([*(w.bounds[:-1] + n for w, n in zip(parts, before)), before[-1:]]),
                     np.concatenate([w.hash for w in parts]))
    low = LOWER[chunk.data]
    inside = kind[low]
    n, offsets = len(low), chunk.offsets
    first, last = inside.copy(), inside.copy()
    if n:
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edge = offsets[:-1][offsets[:-1] < offsets[1:]]  # a text's first byte begins a word even if the byte before it is one
        first[edge] = inside[edge]
        last[edge[1:] - 1] = inside[edge[1:] - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    bounds = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(len(chunk)), np.diff(bounds))
    if not hashes:
        return Words(start, end, text, bounds, np.zeros(0, np.uint64))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[low] * powers(n), out=sums[1:])
    h = (sums[end] - sums[start]) * powers(n + 1, True)[start]
    return Words(start, end, text, bounds, mix(h + (end - start).astype(np.uint64)))


def gram_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k consecutive words of one text, and the word each run begins at."""
    n = len(words.hash)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        acc = acc * U64(_BASE) + words.hash[j : n - k + 1 + j]
    at = np.flatnonzero(words.text[: n - k + 1] == words.text[k - 1 :])
    return mix(acc[at] + U64(k)), at


def run_hash(hashes: np.ndarray) -> int:
    """The hash that gram_hashes gives a run of exactly these words."""
    acc = 0
    for h in hashes.tolist():
        acc = (acc * _BASE + h) & 0xFFFFFFFFFFFFFFFF
    return int(mix(np.array([(acc + len(hashes)) & 0xFFFFFFFFFFFFFFFF], np.uint64))[0])


def signed(h: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes as Spark's long."""
    return h.view(np.int64) if h.dtype == np.uint64 else h.astype(np.uint64).view(np.int64)


def list_array(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """array<long> column: row i holds values[bounds[i]:bounds[i + 1]]."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))
