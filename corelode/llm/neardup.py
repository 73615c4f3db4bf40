"""SimHash near-dedup over a byte-position inverted index with count filtering.

Each document has a 256-bit SimHash of its distinct words of three or more
bytes (of all words where it has fewer than ``MIN_FEATURES`` of those).  Two
documents are near duplicates when their fingerprints agree on at least
``MIN_SHARED`` of the 32 byte positions and differ in at most ``MAX_BITS`` bits.
A pair within ``32 - MIN_SHARED`` bits always has that many equal bytes.

The positions are dealt to ``MIN_SHARED - 1`` groups.  A pair that shares
``MIN_SHARED`` bytes shares two of one group, so posting lists keyed by the pairs
of positions inside the groups, and their two bytes, hold every pair that can
pass the count filter: the search loses none.  In a list the equal bytes of each
pair are tallied, pairs below the minimum are dropped, and the rest are verified
by their Hamming distance.

A posting is its key and the fingerprint itself; documents with equal fingerprints
are merged first, so thousands of equal copies cost one posting a list.  Lists of
more than ``SHORT`` fingerprints are searched so that no copy meets all others:
a pivot takes all that are linked to it out of the list, and only those within
reach of what it took (by the triangle inequality) are compared with them.  What
is left is split again by two more positions, of which a pair must share
``MIN_SHARED - 2`` of the 30 that remain, and so on; the work stays near
proportional while the lists grow.  Groups are the connected components of all
links.

Defined results: a null or empty text, or one without words, is a duplicate only
of texts with equal bytes (nulls of none); a row whose ``doc_id`` is null is kept
and never grouped; rows that repeat a ``doc_id`` are one document, of which
one row stays (that with the smallest text, nulls first); the document with the
smallest ``doc_id`` represents its group; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scan, shared

BYTES = 32
MAX_BITS = 40
MIN_SHARED = 9
MIN_WORD = 3
MIN_FEATURES = 8
SHORT = 256
BATCH_POSTINGS = 1 << 17
WORDS = ["f0", "f1", "f2", "f3"]

_LANES = np.zeros((256, 8), dtype=np.uint8)
for _v in range(256):
    for _k in range(8):
        _LANES[_v, _k] = (_v >> _k) & 1
_LANES = _LANES.view(np.uint64).ravel()
_ONES = np.uint64(0x0101010101010101)


def pair_keys(positions: list[int], minimum: int) -> list[tuple[int, int]]:
    """Pairs of positions of which any ``minimum`` positions hold at least one."""
    groups = max(1, minimum - 1)
    return [p for g in range(groups) for p in combinations(positions[g::groups], 2)]


def simhash(texts: pa.Array) -> np.ndarray:
    """(rows, 32) bytes; texts without words get a hash of their bytes."""
    n = len(texts)
    w = scan.words(texts)
    size = w.end - w.start
    long = size >= MIN_WORD
    enough = np.bincount(w.row[long], minlength=n) >= MIN_FEATURES
    use = long | ~enough[w.row]
    row, h = w.row[use], w.hash[use]
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    row, h = row[new], h[new]
    out = np.zeros((n, BYTES), dtype=np.uint8)
    if len(row):
        wide = np.stack([scan.mix(h + np.uint64(k * 0x51ED270B9F3)) for k in range(BYTES // 8)], axis=1)
        lanes = _LANES[wide.view(np.uint8)]
        first = np.searchsorted(row, np.arange(n + 1))
        per_row = np.diff(first)
        # lanes of eight counters each may hold 255 words; longer rows are summed in pieces
        pieces = np.maximum(1, -(-per_row // 255)) * (per_row > 0)
        begin = np.repeat(first[:-1], pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        partial = np.add.reduceat(lanes, begin, axis=0).view(np.uint8).reshape(len(begin), BYTES * 8)
        has = np.flatnonzero(per_row)
        at = (np.cumsum(pieces) - pieces)[has]
        ones = np.add.reduceat(partial.astype(np.int32), at, axis=0)
        out[has] = np.packbits(ones * 2 > per_row[has][:, None], axis=1, bitorder="little")
    bare = np.flatnonzero(np.bincount(row, minlength=n) == 0)
    if len(bare):
        import hashlib

        for r in bare:
            out[r] = np.frombuffer(hashlib.sha256((texts[int(r)].as_py() or "").encode()).digest(), dtype=np.uint8)
    return out


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp) of every row with an id and a text."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for i, j in scan.slices(texts):
                fp = simhash(texts.slice(i, j - i))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array([f.tobytes() for f in fp], pa.binary())], ["doc_id", "fp"])

    scan.small_batches(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = dict(narrow.dtypes)["doc_id"]
    return narrow.filter("doc_id is not null and text is not null").mapInArrow(make, f"doc_id {kind}, fp binary")


def _byte(position: int) -> Column:
    return F.shiftrightunsigned(WORDS[position // 8], 8 * (position % 8)).bitwiseAND(F.lit(255))


def _postings(reps: DataFrame) -> DataFrame:
    """(key, f0 .. f3): one row for each pair of positions of a group; see the module."""
    keys = [(F.lit(k << 16) + _byte(p) * 256 + _byte(q)).cast("int") for k, (p, q) in enumerate(pair_keys(list(range(BYTES)), MIN_SHARED))]
    return reps.select(F.explode(F.array(*keys)).alias("key"), *WORDS)


def equal_bytes(x: np.ndarray) -> np.ndarray:
    """Equal bytes by the XOR of fingerprints, (..., 4) words."""
    x = x | (x >> np.uint64(4))
    x = x | (x >> np.uint64(2))
    x = (x | (x >> np.uint64(1))) & _ONES
    return BYTES - ((x.sum(axis=-1, dtype=np.uint64) * _ONES) >> np.uint64(56)).astype(np.int64)


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether fingerprints pass the count filter and the verification."""
    x = a ^ b
    out = equal_bytes(x) >= MIN_SHARED
    at = np.flatnonzero(out)
    out[at] = np.bitwise_count(x[at]).sum(axis=-1, dtype=np.int64) <= MAX_BITS
    return out


def _all_pairs(key: np.ndarray, fp: np.ndarray) -> list[np.ndarray]:
    """Links within runs of equal keys: rows are compared with the next, the second next, and so on."""
    out = []
    at = np.arange(len(key) - 1)
    step = 1
    while len(at):
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        ok = at[near(fp[at], fp[at + step])]
        out.append(np.stack([ok, ok + step], axis=1))
        step += 1
    return out


def _pivot(fp: np.ndarray, out: list[np.ndarray]) -> np.ndarray:
    """Rows that are left when dense parts of a long list are linked to pivots and taken out."""
    left = np.arange(len(fp))
    while len(left) > SHORT:
        half = np.unpackbits(fp[left].view(np.uint8).reshape(len(left), -1), axis=1).mean(axis=0) > 0.5
        centre = np.packbits(half).view(np.uint64)
        pivot = left[np.argmin(np.bitwise_count(fp[left] ^ centre).sum(axis=1, dtype=np.int64))]
        distance = np.bitwise_count(fp[left] ^ fp[pivot]).sum(axis=1, dtype=np.int64)
        taken = near(fp[left], fp[pivot])
        if 8 * np.count_nonzero(taken) < len(left):
            break
        group, rest = left[taken], left[~taken]
        others = group[group != pivot]
        out.append(np.stack([np.full(len(others), pivot), others], axis=1))
        # only these can be within MAX_BITS of something that was taken
        for i in rest[distance[~taken] <= distance[taken].max() + MAX_BITS].tolist():
            hit = np.flatnonzero(near(fp[group], fp[i]))
            if len(hit):
                out.append(np.array([[group[hit[0]], i]]))
        left = rest
    return left


def links(key: np.ndarray, fp: np.ndarray, positions: list[int] | None = None, minimum: int = MIN_SHARED) -> list[np.ndarray]:
    """(i, j) links that connect what the near pairs within each run of equal keys connect.

    Of ``positions`` a near pair shares at least ``minimum``.
    """
    positions = list(range(BYTES)) if positions is None else positions
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(begin, len(key)))
    short = np.flatnonzero(np.repeat((size > 1) & (size <= SHORT), size))
    out = [short[m] for m in _all_pairs(key[short], fp[short])]
    rows: list[np.ndarray] = []
    for b, n in zip(begin[size > SHORT], size[size > SHORT]):
        mine: list[np.ndarray] = []
        rows.append(b + _pivot(fp[b : b + n], mine))
        out += [b + m for m in mine]
    if rows:
        of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        row = np.concatenate(rows)
        if minimum < 2:
            return out + [row[m] for m in _all_pairs(of, fp[row])]
        raw = fp.view(np.uint8).reshape(len(fp), BYTES)
        for p, q in pair_keys(positions, minimum):
            sub = (of << 16) + raw[row, p].astype(np.int64) * 256 + raw[row, q]
            order = np.argsort(sub, kind="stable")
            at = row[order]
            out += [at[m] for m in links(sub[order], fp[at], [x for x in positions if x not in (p, q)], minimum - 2)]
    return out


def edges(reps: DataFrame) -> DataFrame:
    """(a, b): verified links between fingerprints, enough to connect every group."""
    lists = _postings(reps).repartition("key").sortWithinPartitions("key")
    pairs = pair_keys(list(range(BYTES)), MIN_SHARED)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()

        def find(key: np.ndarray, fp: np.ndarray) -> None:
            pieces = []
            # long lists go on with the positions that their key leaves
            for k in np.unique(key >> 16):
                lo, hi = np.searchsorted(key, [k << 16, (k + 1) << 16])
                pieces += [m + lo for m in links(key[lo:hi], fp[lo:hi], [x for x in range(BYTES) if x not in pairs[k]], MIN_SHARED - 2)]
            at = np.concatenate([np.zeros((0, 2), np.int64), *pieces]).astype(np.int64)
            raw = np.ascontiguousarray(fp).view(f"V{BYTES}").ravel()
            forest.add(raw[at[:, 0]].tolist(), raw[at[:, 1]].tolist())

        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((batch.column("key").to_numpy(), np.stack([batch.column(c).to_numpy() for c in WORDS], axis=1).view(np.uint64)))
            rows += batch.num_rows
            if rows >= BATCH_POSTINGS:
                key, fp = np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held])
                whole = int(np.searchsorted(key, key[-1]))  # the last list may go on
                if whole:
                    find(key[:whole], fp[:whole])
                held, rows = [(key[whole:], fp[whole:])], 0
        if held:
            find(np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held]))
        yield from forest.stars()

    return lists.mapInArrow(search, "a binary, b binary").dropDuplicates(["a", "b"])


class Forest:
    """Links of a task, kept as one tree a component: what is shuffled is at most a row a fingerprint."""

    def __init__(self) -> None:
        self.up: dict[bytes, bytes] = {}

    def root(self, x: bytes) -> bytes:
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    def add(self, a: list[bytes], b: list[bytes]) -> None:
        for x, y in zip(a, b):
            x, y = self.root(x), self.root(y)
            if x != y:
                self.up[max(x, y)] = min(x, y)

    def stars(self, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
        """(a, b): the smallest fingerprint of each tree, and another one of it."""
        a, b = [], []
        for x in self.up:
            if (r := self.root(x)) != x:
                a.append(r), b.append(x)
        for k in range(0, max(1, len(a)), rows):
            yield pa.RecordBatch.from_arrays([pa.array(a[k : k + rows], pa.binary()), pa.array(b[k : k + rows], pa.binary())], ["a", "b"])


def components(edges_ab: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the graph can reach.

    Labels spread along links and are then replaced by their own label's label,
    so the number of rounds grows with the logarithm of the longest chain.
    """
    both = edges_ab.select("a", "b").union(edges_ab.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = shared.written(both, "nd-edges")
    label = shared.written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")), "nd-label")
    while True:
        near = both.join(label, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("seen"))
        step = label.join(near, F.col("node") == F.col("a")).select("node", F.least("root", "seen").alias("to"), F.col("root").alias("was"))
        up = label.select(F.col("node").alias("to"), F.col("root").alias("next"))
        new = shared.written(step.join(up, "to").select("node", F.least("to", "next").alias("root"), "was"), "nd-label")
        label = new.select("node", "root")
        if new.filter("root <> was").isEmpty():
            return label


def _as_words(fps: DataFrame) -> DataFrame:
    """(rep, fp, f0 .. f3): the fingerprint as four words, byte by byte from the lowest."""
    hexed = F.hex("fp")
    word = [F.concat(*[F.substring(hexed, 16 * w + 2 * b + 1, 2) for b in range(7, -1, -1)]) for w in range(4)]
    return fps.select("rep", "fp", *[F.conv(x, 16, -10).cast("long").alias(n) for x, n in zip(word, WORDS)])


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, dup_of): every document that duplicates another, with its group's representative."""
    fps = shared.written(fingerprints(docs, text, doc_id).distinct(), "nd-fps")
    reps = shared.written(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nd-reps")
    equal = fps.join(reps, "fp").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).filter("a <> b")
    found = edges(_as_words(reps))
    named = found.join(reps.select(F.col("fp").alias("a"), F.col("rep").alias("ra")), "a").join(reps.select(F.col("fp").alias("b"), F.col("rep").alias("rb")), "b")
    near_ = named.select(F.col("ra").alias("a"), F.col("rb").alias("b")).filter("a <> b")
    return components(near_.union(equal)).filter("node <> root").select(F.col("node").alias("doc_id"), F.col("root").alias("dup_of"))


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each group."""
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text, doc_id = f"c{names.index(text)}", f"c{names.index(doc_id)}"
    gone = shared.written(groups(inner, text, doc_id), "nd-gone").select(F.col("doc_id").alias(doc_id))
    kept = inner.join(gone, doc_id, "left_anti").select(*inner.columns)
    again = shared.written(inner.filter(F.col(doc_id).isNotNull()).groupBy(doc_id).count().filter("count > 1").select(doc_id), "nd-again")
    if not again.isEmpty():
        # as JSON the other columns have an order whatever their types
        least = F.struct(text, F.to_json(F.struct(*inner.columns)))
        one = kept.join(again, doc_id).groupBy(doc_id).agg(F.min_by(F.struct(*inner.columns), least).alias("r")).select("r.*")
        kept = kept.join(again, doc_id, "left_anti").select(*inner.columns).unionByName(one)
    return kept.toDF(*names)
