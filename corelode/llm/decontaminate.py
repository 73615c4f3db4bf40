"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

1. Word n-grams of the benchmark items are looked up in every position of every
   document.  All of them are seeds, however frequent: an edited copy shares
   only some n-grams with its item, and which ones cannot be told beforehand.
2. Nearby seed hits of one item share a window.  A window that lacks too many of
   the item's words for any alignment to reach the score is passed over; this
   loses nothing, and it is what idioms end at.
3. The other windows' words are aligned with the item's words by
   Smith-Waterman.  A document is contaminated by an item when the best
   alignment reaches ``MIN_SCORE`` of the score of a perfect copy, so edited and
   paraphrased copies count too.

The texts are never shuffled; only results are.  The benchmark is a stated query
set that is run against all documents in blocks: its items are dealt to blocks of
at most ``BLOCK_WORDS`` words (or one longer item), which is counted before anything
is sent, and each block is looked up in a scan of the documents.

Defined results: documents or items whose text is null, empty or without words
match nothing; items shorter than ``N`` words are matched whole, as one n-gram
of their own length; a row whose ``doc_id`` is null is never reported and always
kept; repeated rows of a document or an item give one result per pair of ids;
of equal scores the alignment that starts first is reported; with an empty table
on either side nothing matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import scan, shared

N = 3
MIN_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
BLOCK_WORDS = 2_000_000


class Benchmark:
    """The items' words, and the items and places of each n-gram."""

    def __init__(self, rows: list[tuple]):
        self.items: list[tuple[object, np.ndarray]] = []
        rows = sorted({(i, t) for i, t in rows if i is not None and t}, key=lambda r: (str(r[0]), r[1]))
        w = scan.words(pa.array([t for _, t in rows], pa.string()))
        for k, (i, _) in enumerate(rows):
            h = w.hash[w.first[k] : w.first[k + 1]]
            if len(h):
                self.items.append((i, h))
        self.sizes = sorted({min(N, len(h)) for _, h in self.items})
        grams, owner, place = [], [], []
        for k, (_, h) in enumerate(self.items):
            n = min(N, len(h))
            one = scan.Words(np.zeros(len(h), np.int64), h, h, h, np.array([0, len(h)]))
            at, g = scan.shingles(one, n)
            grams.append(g ^ np.uint64(n))
            owner.append(np.full(len(g), k))
            place.append(at)
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        g, o, p = cat(grams, np.uint64), cat(owner, np.int64), cat(place, np.int64)
        order = np.argsort(g, kind="stable")
        self.gram, self.owner, self.place = g[order], o[order], p[order]
        self._index()

    def _index(self) -> None:
        self.key = np.unique(self.gram)
        self.begin = np.searchsorted(self.gram, self.key, side="left")
        self.end = np.searchsorted(self.gram, self.key, side="right")
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[self.key & np.uint64((1 << 20) - 1)] = True

    def hits(self, w: scan.Words) -> tuple[np.ndarray, np.ndarray]:
        """(word index, index into ``key``) of each benchmark n-gram in the words."""
        ats, ks = [], []
        for n in self.sizes:
            at, h = scan.shingles(w, n)
            h = h ^ np.uint64(n)
            maybe = np.flatnonzero(self.seen[h & np.uint64((1 << 20) - 1)])
            if len(maybe) and len(self.key):
                k = np.searchsorted(self.key, h[maybe])
                k[k == len(self.key)] = 0
                ok = self.key[k] == h[maybe]
                ats.append(at[maybe[ok]])
                ks.append(k[ok])
        if not ats:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(ats), np.concatenate(ks)


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(best score, first, last) of the local alignment; the range is of ``text``."""
    m = len(text)
    best, where = 0, (0, -1)
    score = np.zeros(m + 1, dtype=np.int64)
    start = np.arange(m + 1)
    ramp = GAP * np.arange(m + 1)
    for word in item:
        diag = score[:-1] + np.where(text == word, MATCH, MISMATCH)
        up = score[1:] + GAP
        here = np.maximum(np.maximum(diag, up), 0)
        from_ = np.where(here == 0, np.arange(1, m + 1), np.where(diag >= up, start[:-1], start[1:]))
        # gaps along the text: the best of all earlier columns less one gap a step
        lifted = np.concatenate([[0], here]) - ramp
        run = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == run, np.arange(m + 1), 0))
        new = run + ramp
        origin = np.concatenate([[0], from_])
        start = np.where(new > np.concatenate([[0], here]), origin[source], origin)
        score = np.maximum(new, 0)
        start = np.where(score == 0, np.arange(m + 1), start)
        k = int(np.argmax(score))
        if score[k] > best:
            best, where = int(score[k]), (int(start[k]), k - 1)
    return best, *where


def _windows(at: np.ndarray, place: np.ndarray, size: int, limit: int) -> list[tuple[int, int]]:
    """Merged word ranges in which an item of ``size`` words hit at ``place`` can lie."""
    lo = np.maximum(0, at - 2 * place - 4)
    hi = np.minimum(limit, at + 2 * (size - place) + 4)
    order = np.argsort(lo, kind="stable")
    out: list[list[int]] = []
    for a, b in zip(lo[order].tolist(), hi[order].tolist()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def align(bench: Benchmark, hashes: np.ndarray, at: np.ndarray, owner: np.ndarray, place: np.ndarray, min_score: float) -> Iterator[tuple[int, float, int, int]]:
    """(item, score, first word, last word) of each item that the document holds."""
    for k in np.unique(owner):
        item = bench.items[k][1]
        mine = owner == k
        best = (0, 0, -1)
        need = min_score * len(item)
        for a, b in _windows(at[mine], place[mine], len(item), len(hashes)):
            if np.isin(item, hashes[a:b]).sum() < need:  # no alignment can match more words than these
                continue
            s, x, y = smith_waterman(item, hashes[a:b])
            if s > best[0]:
                best = (s, a + x, a + y)
        share = best[0] / (MATCH * len(item))
        if share >= min_score:
            yield int(k), share, best[1], best[2]


def _scan(narrow: DataFrame, work, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for i, j in scan.slices(texts):
                w = scan.words(texts.slice(i, j - i))
                yield work(batch.column("doc_id").slice(i, j - i), w)

    return narrow.mapInArrow(run, schema)


def _dealt(items: DataFrame, block_words: int) -> tuple[DataFrame, int]:
    """(the items with a column ``block``, the number of blocks); no block of several items is larger than allowed."""
    sized = shared.written(items.withColumn("words", F.size(F.split("text", r"\s+"))), "dc-items")
    words, rows = sized.agg(F.coalesce(F.sum("words"), F.lit(0)), F.count(F.lit(1))).first()
    blocks = max(1, -(-words // block_words))
    while True:
        dealt = sized.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
        if dealt.groupBy("block").agg(F.sum("words").alias("w"), F.count(F.lit(1)).alias("k")).filter((F.col("w") > block_words) & (F.col("k") > 1)).isEmpty():
            return dealt, blocks
        if blocks > 64 * rows:  # equal hashes: nothing can part them
            raise ValueError("the items cannot be dealt to blocks")
        blocks *= 2


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id", min_score: float = MIN_SCORE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) of each document that holds an item."""
    scan.small_batches(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).filter("doc_id is not null and text is not null")
    item_rows = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text")).filter("item_id is not null and text is not null").distinct()
    dealt, blocks = _dealt(item_rows, block_words)
    found: DataFrame | None = None
    for k in range(blocks):
        one = _search(narrow, dealt.filter(F.col("block") == k), min_score)
        found = one if found is None else found.unionByName(one)
    return _best(found)


def _search(narrow: DataFrame, items: DataFrame, min_score: float) -> DataFrame:
    """The same for the items of a block; several alignments of a pair may be listed."""
    item_type = items.schema["item_id"].dataType
    schema = f"doc_id {dict(narrow.dtypes)['doc_id']}, item_id {item_type.simpleString()}, score double, first_word long, last_word long"
    arrow = to_arrow_type(item_type)
    sent = narrow.sparkSession.sparkContext.broadcast(Benchmark([tuple(r) for r in items.select("item_id", "text").collect()]))

    def match(ids: pa.Array, w: scan.Words) -> pa.RecordBatch:
        b = sent.value
        at, k = b.hits(w)
        found = []
        if len(at):
            n = b.end[k] - b.begin[k]
            entry = np.repeat(b.begin[k], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(at, n)
            owner, place, row = b.owner[entry], b.place[entry], w.row[at]
            order = np.argsort(row, kind="stable")
            at, owner, place, row = at[order], owner[order], place[order], row[order]
            rows, begin = np.unique(row, return_index=True)
            for r, lo, hi in zip(rows, begin, np.append(begin[1:], len(row))):
                base = w.first[r]
                h = w.hash[base : w.first[r + 1]]
                found += [(r, *x) for x in align(b, h, at[lo:hi] - base, owner[lo:hi], place[lo:hi], min_score)]
        cols = [ids.take(pa.array([int(f[0]) for f in found], pa.int64())), pa.array([b.items[f[1]][0] for f in found], arrow), pa.array([f[2] for f in found], pa.float64()), pa.array([f[3] for f in found], pa.int64()), pa.array([f[4] for f in found], pa.int64())]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "item_id", "score", "first_word", "last_word"])

    out = shared.written(_scan(narrow, match, schema), "dc-found")
    sent.destroy()  # the driver holds one block at a time
    return out


def _best(rows: DataFrame) -> DataFrame:
    """One row for each pair of ids: the best score, then the first place."""
    top = F.max(F.struct("score", (-F.col("first_word")).alias("a"), (-F.col("last_word")).alias("b"))).alias("t")
    return rows.groupBy("doc_id", "item_id").agg(top).select("doc_id", "item_id", F.col("t.score").alias("score"), (-F.col("t.a")).alias("first_word"), (-F.col("t.b")).alias("last_word"))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", **params) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text, doc_id = f"c{names.index(text)}", f"c{names.index(doc_id)}"
    bad = shared.written(contaminated(inner, items, text, doc_id, **params).select(F.col("doc_id").alias(doc_id)).distinct(), "dc-bad")
    return inner.join(bad, doc_id, "left_anti").select(*inner.columns).toDF(*names)
