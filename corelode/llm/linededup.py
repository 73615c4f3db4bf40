"""Line dedup by content-defined chunks of lines.

Every line is hashed.  A rolling hash over the last two line hashes is taken at
each line, and a chunk ends where that hash is a local minimum, so boundaries
depend on nearby lines only and move with them when text is inserted above.
Chunks have at least two lines, but for what is left at the ends of a text.

A passage of a few lines inside other text may hold no whole chunk.  So two finer
units are looked up beside the chunks of two and more lines: every two
neighbouring lines that have ``PAIR_WORDS`` words, and every single line of more
than ``LINE_WORDS`` words.

Units whose hash occurs more than once in the corpus are compared byte by byte; of
each set of equal units the one in the smallest (doc_id, line) stays, and the
lines of the others are removed.  A removed line is always still there at a
smaller place, since every unit points to a smaller one.

The texts are written once in parts and never shuffled.  The hashes of each part
are counted over the corpus, and the task that scans a part reads which of its
own hashes repeat, and later where their units stay.  There is one plan at every
size, and neither the driver nor a task holds all repeated hashes.

Defined results: a null text stays null and an empty one empty; a text may become
empty; a text that loses lines also loses a newline at its end; a line that
repeats right after itself stays once, where it is long enough for a unit; a row with
a null ``doc_id`` is left as it is; rows that repeat a ``doc_id`` are one document, so
equal units in the same lines do not count as repeats of each other; an empty
table gives an empty table.  A column named ``removed_lines`` in the input is
replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import scan, shared

PAIR_WORDS = 10
LINE_WORDS = 50


class Chunks:
    """The chunks of a slice of texts: owner row, number in the text, bytes, lines, hash."""

    def __init__(self, texts: pa.Array):
        raw, offsets = scan.buffers(texts)
        n, rows = len(raw), len(offsets) - 1
        self.raw = raw
        ends = np.flatnonzero(raw == 10)
        sizes = np.diff(offsets)
        filled = np.flatnonzero(sizes > 0)
        # a line ends after its newline, and each text ends its last line
        stop = np.union1d(ends + 1, offsets[1:][filled])
        start = np.concatenate([[0], stop[:-1]]) if len(stop) else np.zeros(0, np.int64)
        row = np.searchsorted(offsets, start, side="right") - 1
        body = stop - (raw[stop - 1] == 10) if len(stop) else stop  # without the newline
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * scan._power(scan._MULT, n, "up"), dtype=np.uint64, out=sums[1:])
        # the power of an empty line's start does not matter: its sum is zero
        h = scan.mix((sums[body] - sums[start]) * scan._power(scan._INVERSE, n + 1, "down")[start] + (body - start).astype(np.uint64))
        same_up = np.zeros(len(h), dtype=bool)
        same_up[1:] = row[1:] == row[:-1]
        roll = h.copy()
        roll[1:] = np.where(same_up[1:], scan.mix(h[1:] * np.uint64(0x100000001B3) + h[:-1]), np.uint64(2**64 - 1))
        if len(roll):
            roll[0] = np.uint64(2**64 - 1)
        big = np.full(len(roll) + 2, np.uint64(2**64 - 1))
        big[1:-1] = roll
        # the first line of a text has no pair above it and never ends a chunk by itself
        cut = same_up & (roll < big[:-2]) & np.where(np.append(same_up[1:], False), roll <= big[2:], True)
        last = np.append(~same_up[1:], True)[: len(h)]
        stop_line = np.flatnonzero(cut | last)
        first_line = np.concatenate([[0], stop_line[:-1] + 1]) if len(stop_line) else np.zeros(0, np.int64)
        self.row = row[first_line]
        self.begin, self.end = start[first_line], stop[stop_line]
        self.lines = stop_line - first_line + 1
        head = np.searchsorted(self.row, np.arange(rows))
        self.seq = np.arange(len(self.row)) - head[self.row]
        acc = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * scan._power(scan._MULT, len(h), "up"), dtype=np.uint64)])
        inverse = scan._power(scan._INVERSE, len(h), "down")

        def span(first: np.ndarray, n: np.ndarray) -> np.ndarray:
            return scan.mix((acc[first + n] - acc[first]) * inverse[first] + n.astype(np.uint64)).astype(np.int64)

        self.hash = span(first_line, self.lines)
        # units: chunks, pairs of lines, long lines; (first line, lines) of each, without repeats
        wide = raw > 32
        fresh = np.ones(n, dtype=bool)  # after white space, or at the start of a text
        fresh[1:] = ~wide[:-1]
        fresh[offsets[:-1][filled]] = True
        word = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(wide & fresh, out=word[1:])
        words = word[stop] - word[start]
        pair = np.flatnonzero(same_up[1:] & (words[1:] + words[:-1] >= PAIR_WORDS)) if len(h) else np.zeros(0, np.int64)
        pair = np.setdiff1d(pair, first_line[self.lines == 2])
        single = np.flatnonzero(words > LINE_WORDS)
        many = self.lines > 1
        self.unit_line = np.concatenate([first_line[many], pair, single])
        self.unit_lines = np.concatenate([self.lines[many], np.full(len(pair), 2), np.full(len(single), 1)]).astype(np.int64)
        self.unit_hash = span(self.unit_line, self.unit_lines)
        self.start, self.stop = start, stop
        self.unit_row = row[self.unit_line] if len(h) else self.unit_line
        self.first = np.searchsorted(row, np.arange(rows + 1))  # first line of each row

    def _bytes(self, begin: int, end: int) -> bytes:
        b = self.raw[begin:end].tobytes()
        return b[:-1] if b.endswith(b"\n") else b

    def bytes_of(self, k: int) -> bytes:
        """The lines of a chunk, without the newline that may follow them."""
        return self._bytes(self.begin[k], self.end[k])

    def unit(self, k: int) -> bytes:
        """The lines of a unit, likewise."""
        at = self.unit_line[k]
        return self._bytes(self.start[at], self.stop[at + self.unit_lines[k] - 1])

    def place(self, k: int) -> int:
        """The number of a unit's first line in its text."""
        return int(self.unit_line[k] - self.first[self.unit_row[k]])


def digest(chunk: bytes) -> bytes:
    return hashlib.md5(chunk, usedforsecurity=False).digest()


def _narrow(held: DataFrame, text: str, doc_id: str) -> DataFrame:
    return held.select(shared.ROW, F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).filter("doc_id is not null and text is not null")


def _merge(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    h, at = np.unique(np.concatenate([h for h, _ in pieces]), return_inverse=True)
    return h, np.bincount(at, weights=np.concatenate([n for _, n in pieces])).astype(np.int64)


def repeated(narrow: DataFrame) -> DataFrame:
    """(part, hash): the hashes of each part's units that occur more than once in the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for part, at in shared.parts(batch):
                texts = batch.column("text").take(pa.array(at))
                for i, j in scan.slices(texts):
                    mine = held.setdefault(part, [])
                    mine.append(np.unique(Chunks(texts.slice(i, j - i)).unit_hash, return_counts=True))
                    if len(mine) >= 32:
                        held[part] = [_merge(mine)]
        for part, pieces in held.items():
            h, n = _merge(pieces)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), part)), pa.array(h), pa.array(n)], ["part", "hash", "n"])

    # a hash has at most a row a task
    each = narrow.mapInArrow(run, "part long, hash long, n long").withColumn("total", F.sum("n").over(Window.partitionBy("hash")))
    return each.filter("total > 1").select("part", "hash")


def _sorted(rows: pa.Table | None) -> np.ndarray:
    return np.zeros(0, np.int64) if rows is None else rows["hash"].to_numpy()


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(h), dtype=bool)
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


def occurrences(narrow: DataFrame, known: shared.Side) -> DataFrame:
    """(part, hash, digest, chunk, doc_id, line): the units with a repeated hash, with their bytes."""
    kind = dict(narrow.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, at in shared.parts(batch):
                mine = batch.take(pa.array(at))
                for i, j in scan.slices(mine.column("text")):
                    c = Chunks(mine.column("text").slice(i, j - i))
                    pick = np.flatnonzero(_among(c.unit_hash, known.of(part, _sorted)))
                    chunk = [c.unit(k) for k in pick]
                    ids = mine.column("doc_id").slice(i, j - i).take(pa.array(c.unit_row[pick]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pick), part)), pa.array(c.unit_hash[pick]), pa.array([digest(b) for b in chunk], pa.binary()), pa.array(chunk, pa.binary()), ids, pa.array([c.place(k) for k in pick], pa.int32())], ["part", "hash", "digest", "chunk", "doc_id", "line"])

    return narrow.mapInArrow(run, f"part long, hash long, digest binary, chunk binary, doc_id {kind}, line int")


def keepers(seen: DataFrame) -> DataFrame:
    """(hash, digest, keep): every unit that occurs in more than one place, and the place that stays.

    Equal bytes, not equal hashes, make a group.
    """
    place = F.struct("doc_id", "line")
    groups = seen.groupBy("hash", "chunk").agg(F.min(place).alias("keep"), F.max(place).alias("last")).filter("keep <> last")
    return groups.select("hash", F.unhex(F.md5("chunk")).alias("digest"), F.col("keep.doc_id").alias("keep_doc"), F.col("keep.line").alias("keep_line"))


class Stays:
    """Where the units of a part stay, by hash (sorted) and digest."""

    def __init__(self, rows: pa.Table | None):
        self.hash = _sorted(rows)
        self.place: dict[tuple[int, bytes], tuple] = {}
        if rows is not None:
            for h, d, doc, line in zip(*(rows[c].to_pylist() for c in ("hash", "digest", "keep_doc", "keep_line"))):
                self.place[h, d] = doc, line


def _cut(texts: pa.Array, ids: pa.Array, stays: Stays) -> tuple[pa.Array, np.ndarray]:
    """The texts without the units that stay elsewhere; lines removed."""
    removed = np.zeros(len(texts), dtype=np.int64)
    changed: dict[int, str] = {}
    for i, j in scan.slices(texts):
        c = Chunks(texts.slice(i, j - i))
        gone: dict[int, set[int]] = {}
        for k in np.flatnonzero(_among(c.unit_hash, stays.hash)).tolist():
            r = int(c.unit_row[k])
            doc = ids[i + r].as_py()
            place = None if doc is None else stays.place.get((int(c.unit_hash[k]), digest(c.unit(k))))
            if place is not None and place != (doc, c.place(k)):
                at = int(c.unit_line[k])
                gone.setdefault(r, set()).update(range(at, at + int(c.unit_lines[k])))
        for r, away in gone.items():
            removed[i + r] = len(away)
            changed[i + r] = b"\n".join(c._bytes(c.start[x], c.stop[x]) for x in range(c.first[r], c.first[r + 1]) if x not in away).decode()
    if changed:
        out = texts.to_pylist()
        for r, t in changed.items():
            out[r] = t
        texts = pa.array(out, pa.string())
    return texts, removed


def clean(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with repeated units cut out of the text, and ``removed_lines``."""
    docs = docs.drop("removed_lines")
    names = docs.columns
    scan.small_batches(docs.sparkSession)
    held = shared.parted(docs.toDF(*[f"c{i}" for i in range(len(names))]), "ld-docs")
    columns = [c for c in held.columns if c != shared.ROW]
    t, d = f"c{names.index(text)}", f"c{names.index(doc_id)}"
    narrow = _narrow(held, t, d)
    seen = shared.written(occurrences(narrow, shared.Side(repeated(narrow), "ld-known", "hash")), "ld-seen")
    stays = seen.select("part", "hash", "digest").distinct().join(keepers(seen), ["hash", "digest"])
    side = shared.Side(stays, "ld-stays", "hash")
    schema = T.StructType([*[T.StructField(f.name, T.StringType() if f.name == t else f.dataType) for f in held.schema.fields if f.name != shared.ROW], T.StructField("removed_lines", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, at in shared.parts(batch):
                mine = batch.take(pa.array(at))
                texts, removed = _cut(mine.column(t).cast(pa.string()), mine.column(d), side.of(part, Stays))
                yield pa.RecordBatch.from_arrays([*(texts if c == t else mine.column(c) for c in columns), pa.array(removed)], [*columns, "removed_lines"])

    return held.mapInArrow(run, schema).toDF(*names, "removed_lines")
