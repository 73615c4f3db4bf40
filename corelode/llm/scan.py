"""Vectorised text scanning over Arrow string columns.

Every operator that must look at each word or byte of each document goes
through this module: an Arrow batch is cut into slices of a quarter megabyte
(so that temporary arrays stay in cache and memory stays flat), and each slice
is scanned by numpy as one byte buffer.  Nothing is truncated: a document
longer than a slice is a slice of its own.

Nulls scan as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18
BATCH_ROWS = 2000
U64 = np.uint64

_MULT = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULT, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}

# Letters, digits and every byte of a multi-byte character make words.
_WORD = np.zeros(256, dtype=bool)
for _b in range(256):
    _WORD[_b] = _b >= 0x80 or chr(_b).isalnum()


def small_batches(spark) -> None:
    """Let Arrow batches have at most ``BATCH_ROWS`` rows: texts are long, and a worker holds a few batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(name, "10000"))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def _power(base: int, n: int, key: str) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept per process."""
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        out = np.full(size, U64(base), dtype=U64)
        out[0] = 1
        have = _powers[key] = np.multiply.accumulate(out, dtype=U64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads all bits."""
    h = h.astype(U64, copy=True)
    h ^= h >> U64(30)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls have no bytes."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if pa.types.is_large_string(texts.type):
        width = np.int64
    else:
        texts, width = texts.cast(pa.string()), np.int32
    offsets = np.frombuffer(texts.buffers()[1], dtype=width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch_texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes that cover the array in order."""
    n = len(batch_texts)
    sizes = pc.fill_null(pc.binary_length(batch_texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    i = 0
    while i < n:
        base = ends[i] - sizes[i]
        j = max(i + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield i, j
        i = j


@dataclass
class Words:
    """All words of a slice, in order: owner row, byte range in the slice, hash."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # index of each row's first word; rows + 1 entries


def words(texts: pa.Array, *, lower: bool = True) -> Words:
    """Words of each text: maximal runs of letters, digits and non-ASCII bytes.

    The hash of a word depends on its (lower-cased) bytes alone.
    """
    if lower:
        # case folding may change byte lengths; ranges then refer to the folded text
        texts = pc.utf8_lower(texts)
    raw, offsets = buffers(texts)
    n = len(raw)
    rows = len(offsets) - 1
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(z, z, z, np.zeros(0, U64), np.zeros(rows + 1, np.int64))
    inside = np.zeros(n + 2, dtype=np.int8)
    inside[1:-1] = _WORD[raw]
    step = np.diff(inside)
    starts = np.flatnonzero(step == 1)
    ends = np.flatnonzero(step == -1)
    # a word that runs across a border between texts is cut there
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < n)])
    if len(cuts):
        cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]
        if len(cuts):
            starts = np.sort(np.concatenate([starts, cuts]))
            ends = np.sort(np.concatenate([ends, cuts]))
    sums = np.empty(n + 1, dtype=U64)
    sums[0] = 0
    np.cumsum((raw.astype(U64) + U64(1)) * _power(_MULT, n, "up"), dtype=U64, out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power(_INVERSE, n, "down")[starts]
    h = mix(h + (ends - starts).astype(U64))
    first = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(rows), np.diff(first))
    return Words(row, starts, ends, h, first)


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of each run of n words inside one text."""
    m = len(w.hash) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    h = w.hash[:m].copy()
    for k in range(1, n):
        h = h * U64(0x100000001B3) + w.hash[k : k + m]
    at = np.flatnonzero(w.row[:m] == w.row[n - 1 :])
    return at, mix(h[at])


def bincount_rows(rows: np.ndarray, weights: np.ndarray | None, n: int) -> np.ndarray:
    return np.bincount(rows, weights=weights, minlength=n)
