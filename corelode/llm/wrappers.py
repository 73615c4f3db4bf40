"""HTML extraction by union-free regular-expression inference.

All pages of a host are taken to come from one template.  A page is a stream of
tags and texts.  Repetition inside a page is folded: equal neighbours first, then
segments that start alike, whose bodies are aligned into one.  The folded streams
of a host are aligned one after another with the wrapper so far; where they
mismatch, the tags that only one side has become an optional group, bodies of
repeated groups are aligned in turn, and texts are slots.  The result is an
expression of tags, slots, ``( )+`` and ``( )?``, without unions.

* The streams are folded where the pages are, and only distinct folded streams
  (with counts) are shuffled, so the work per host grows with the variety of its
  pages, not with their number; a hot host is no hot task.
* The wrapper is compiled into a position automaton, which reads a page in one pass
  without backtracking; of several readings the one with the first places is
  taken.  A slot keeps all the texts it captures.
* Two streams are aligned row by row in memory proportional to their length, and
  repeats of any length and number are folded, so long pages need no limits.
* A slot that holds one and the same text wherever it occurs, on at least two pages
  of the host, is template text and is left out of the extracted text.

Defined results: pages with a null URL or one without a host share the host ``''``;
null and empty pages yield the empty text; a page that the wrapper does not match
(``matched`` is false) yields all its texts; rows that repeat are pages of
their own; scripts, styles, comments and declarations are no content; broken
tags are read as far as they go; an empty table gives an empty table.  Columns
other than id, URL and HTML are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

TABLE_CELLS = 1 << 22  # cells of an alignment that are held at once
MEMO = 1 << 12  # streams of a task whose result is remembered
TEXT = "#"
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][A-Za-z0-9:-]*)(?:\"[^\"]*\"|'[^']*'|[^'\">])*>?|([^<]+|<)", re.DOTALL | re.IGNORECASE)


def host_of(url: Column) -> Column:
    """The lower-case host of an absolute URL, or the empty string."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1))


def tokens(page: str) -> tuple[list[str], list[str]]:
    """(labels, texts): tag names and text marks in order, and the texts of the marks."""
    labels: list[str] = []
    texts: list[str] = []
    for m in _TOKEN.finditer(page):
        name = m.group(3)
        if name:
            labels.append(("/" if m.group(2) else "") + name.lower())
        elif (raw := m.group(4)) is not None:
            t = " ".join(entities.unescape(raw).split())
            if t:
                if labels and labels[-1] == TEXT:  # text around a comment is one text
                    texts[-1] += " " + t
                else:
                    labels.append(TEXT)
                    texts.append(t)
    return labels, texts


# A wrapper is a tuple of items (atom, optional group or 0); an atom is a label
# or a tuple ("+", body) of which the body is a wrapper.

Item = tuple
Wrapper = tuple


def plain(labels: list[str]) -> Wrapper:
    return tuple((x, 0) for x in labels)


def _same(a, b) -> bool:
    """Whether two atoms can be one: equal labels, or repeats that start alike."""
    return _class(a) == _class(b)


def _join_atoms(a, b):
    return a if isinstance(a, str) or a == b else ("+", align(a[1], b[1]))


def _class(atom):
    """Equal for atoms that can be one: labels, or repeats that start alike."""
    return atom if isinstance(atom, str) else ("+", _class(atom[1][0][0]))


def _scores(x: np.ndarray, y: np.ndarray, weight: np.ndarray, keep: bool) -> np.ndarray:
    """Row i: the best alignment of ``x[i:]`` with every ``y[j:]``; only row 0 unless ``keep``."""
    rows = np.zeros((len(x) + 1 if keep else 1, len(y) + 1), dtype=np.int32)
    row = rows[-1].copy()
    for i in range(len(x) - 1, -1, -1):
        new = row.copy()
        hit = np.flatnonzero(y == x[i])
        new[hit] = np.maximum(new[hit], row[hit + 1] + weight[i])
        row = np.maximum.accumulate(new[::-1])[::-1]
        if keep:
            rows[i] = row
    if not keep:
        rows[0] = row
    return rows


def _matches(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[tuple[int, int]]:
    """(i, j) of a best alignment; large tables are halved, so memory stays bounded."""
    n, m = len(x), len(y)
    if n * m > TABLE_CELLS and n > 1:
        half = n // 2
        below = _scores(x[half:], y, weight[half:], False)[0]
        above = _scores(x[:half][::-1], y[::-1], weight[:half][::-1], False)[0][::-1]
        cut = int(np.argmax(above + below))
        return _matches(x[:half], y[:cut], weight[:half]) + [(i + half, j + cut) for i, j in _matches(x[half:], y[cut:], weight[half:])]
    best = _scores(x, y, weight, True)
    out, i, j = [], 0, 0
    while i < n and j < m:
        if x[i] == y[j] and best[i, j] == best[i + 1, j + 1] + weight[i]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i, j] == best[i + 1, j]:
            i += 1
        else:
            j += 1
    return out


def align(a: Wrapper, b: Wrapper) -> Wrapper:
    """The least general of the wrappers that order both item lists."""
    if a == b:
        return a
    n, m = len(a), len(b)
    lo = 0
    while lo < n and lo < m and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < n - lo and hi < m - lo and a[n - 1 - hi] == b[m - 1 - hi]:
        hi += 1
    head, tail = a[:lo], a[n - hi :] if hi else ()
    x, y = a[lo : n - hi], b[lo : m - hi]
    kinds: dict = {}
    number = lambda w: np.array([kinds.setdefault(_class(atom), len(kinds)) for atom, _ in w], dtype=np.int32)
    weight = np.array([1 if isinstance(atom, str) else 2 for atom, _ in x], dtype=np.int32)
    # an item comes and goes with its group in ``a`` and with its group in ``b``; -1 where a side lacks it
    out: list[tuple] = []
    i = j = 0
    for p, q in [*_matches(number(x), number(y), weight), (len(x), len(y))]:
        out += [(atom, (g, -1)) for atom, g in x[i:p]]
        out += [(atom, (-1, g)) for atom, g in y[j:q]]
        if p < len(x):
            out.append((_join_atoms(x[p][0], y[q][0]), (x[p][1], y[q][1])))
        i, j = p + 1, q + 1
    both = [*((atom, (g, g)) for atom, g in head), *out, *((atom, (g, g)) for atom, g in tail)]
    return _renumber(tuple((atom, 0 if g == (0, 0) else g) for atom, g in both))


def _renumber(w: Wrapper) -> Wrapper:
    """Group ids 1, 2, ... by place; a group is a run of items that come and go together."""
    out: list[Item] = []
    last, k = 0, 0
    for atom, g in w:
        if g and g != last:
            k += 1
        out.append((atom, k if g else 0))
        last = g
    return tuple(out)


def _tandem(ids: np.ndarray, size: int) -> np.ndarray:
    """Places at which ``size`` items are followed by the same ones."""
    same = np.concatenate([[0], np.cumsum(ids[:-size] == ids[size:])])
    return np.flatnonzero(same[size:] - same[:-size] == size)


def _fold_equal(w: Wrapper) -> Wrapper:
    """Equal neighbouring groups become repeats, shortest groups first."""
    size = 1
    kinds: dict = {}
    ids = np.array([kinds.setdefault(x, len(kinds)) for x in w], dtype=np.int32)
    while size <= len(w) // 2:
        at = _tandem(ids, size)
        if not len(at):
            size += 1
            continue
        out: list[Item] = []
        done = 0
        for i in at.tolist():
            if i < done:
                continue
            k = 2
            while w[i + k * size : i + (k + 1) * size] == w[i : i + size]:
                k += 1
            out += w[done:i]
            # a repeat of a repeat is the repeat
            out.append(w[i] if size == 1 and not isinstance(w[i][0], str) else (("+", w[i : i + size]), 0))
            done = i + k * size
        w = (*out, *w[done:])
        ids = np.array([kinds.setdefault(x, len(kinds)) for x in w], dtype=np.int32)
        size = 1
    return w


def _kind(atom) -> tuple:
    """What repeats have in common whose bodies are merged before they are looked for."""
    return tuple(x if isinstance(x, str) else "+" for x, _ in atom[1][:2])


def _take(body: Wrapper, w: Wrapper, at: int) -> int:
    """How many items of ``w`` from ``at`` one pass of ``body`` takes; 0 if it does not fit."""
    i, k = at, 0
    while k < len(body):
        g, e = body[k][1], k + 1
        while g and e < len(body) and body[e][1] == g:
            e += 1
        run = w[i : i + e - k]
        fits = len(run) == e - k and all(not o and (x == atom or (not isinstance(atom, str) and not isinstance(x, str) and _kind(x) == _kind(atom))) for (x, o), (atom, _) in zip(run, body[k:e]))
        if fits:
            i += e - k
        elif not g:
            return 0
        k = e
    return i - at


def _fold_alike(w: Wrapper) -> Wrapper:
    """Segments that start with the same two tags become one repeat of their alignment."""
    while True:  # every round leaves a shorter list
        places: dict[tuple, list[int]] = {}
        for i in range(len(w) - 1):
            a, b = w[i][0], w[i + 1][0]
            if isinstance(a, str) and isinstance(b, str) and a[0] not in "/#" and b[0] not in "/#":
                places.setdefault((a, b), []).append(i)
        many = [p for p in places.values() if len(p) > 1]
        if not many:
            break
        starts = min(many, key=lambda p: (p[0], len(p)))
        body: Wrapper = w[starts[0] : starts[1]]
        for a, b in zip(starts[1:], starts[2:]):
            body = align(body, w[a:b])
        # the last segment ends where it no longer follows the body
        known = {x if isinstance(x, str) else x[1][0][0] for x, _ in body}
        end = starts[-1]
        while end < len(w) and (w[end][0] if isinstance(w[end][0], str) else w[end][0][1][0][0]) in known:
            end += 1
        body = align(body, w[starts[-1] : end])
        w = w[: starts[0]] + ((("+", _fold_equal(body)), 0),) + w[end:]
    return w


def fold(labels: list[str]) -> Wrapper:
    return _fold_alike(_fold_equal(plain(labels)))


def _bodies(w: Wrapper) -> Iterator[Wrapper]:
    for atom, _ in w:
        if not isinstance(atom, str):
            yield from _bodies(atom[1])
            yield atom[1]


def _refold(w: Wrapper, bodies: list[Wrapper]) -> Wrapper:
    """Runs that fit a repeat seen elsewhere on the host become that repeat, even a single one."""
    for body in bodies:
        out: list[Item] = []
        i = 0
        while i < len(w):
            grown, n = body, 0
            while len(body) > 1 and (k := _take(body, w, i + n)) > 1:
                grown = align(grown, w[i + n : i + n + k])  # repeats inside may differ
                n += k
            if n:
                out.append((("+", grown), 0))
                i += n
            else:
                out.append(w[i])
                i += 1
        w = tuple(out)
    return w


def infer(shapes: list[Wrapper]) -> Wrapper:
    """The wrapper of all folded streams of a host (given in a fixed order)."""
    merged: dict = {}
    for s in shapes:
        for body in _bodies(s):
            key = _kind(("+", body))
            merged[key] = align(merged[key], body) if key in merged else body
    bodies = sorted(merged.values(), key=lambda b: (len(b), repr(b)))
    wrapper: Wrapper | None = None
    for s in dict.fromkeys(_refold(s, bodies) for s in shapes):
        wrapper = s if wrapper is None else align(wrapper, s)
    # a stream whose repeats were replaced by ones that do not read it is aligned as it was
    known = Compiled(wrapper or ())
    for s in shapes:
        if known.slots_of(_labels(s)) is None:
            wrapper = align(wrapper, s)
    return wrapper or ()


def _labels(w: Wrapper) -> list[str]:
    """A stream that the wrapper matches: every repeat once, every optional group present."""
    out: list[str] = []
    for atom, _ in w:
        out += [atom] if isinstance(atom, str) else _labels(atom[1])
    return out


def expression(w: Wrapper) -> str:
    """The wrapper in readable form: tags, ``#`` slots, ``( )+`` and ``( )?``."""
    out, k = [], 0
    while k < len(w):
        g, e = w[k][1], k + 1
        while g and e < len(w) and w[e][1] == g:
            e += 1
        s = " ".join(TEXT if a == TEXT else f"<{a}>" if isinstance(a, str) else f"( {expression(a[1])} )+" for a, _ in w[k:e])
        out.append(f"( {s} )?" if g else s)
        k = e
    return " ".join(out)


class Compiled:
    """A wrapper as an automaton whose states are the places of labels in it."""

    def __init__(self, w: Wrapper):
        self.label: list[str] = []
        self.slot: list[int] = []
        self.follow: list[int] = []
        self.slots = 0
        self.first, self.last, self.empty = self._build(w)
        self.places: dict[str, int] = {}
        for p, x in enumerate(self.label):
            self.places[x] = self.places.get(x, 0) | 1 << p
        self.memo: dict[tuple, list[int] | None] = {}

    def _build(self, w: Wrapper) -> tuple[int, int, bool]:
        """(first places, last places, whether nothing matches) of a wrapper, as bits."""
        first, last, empty = 0, 0, True
        k = 0
        while k < len(w):
            g, e = w[k][1], k + 1
            while g and e < len(w) and w[e][1] == g:
                e += 1
            f1, l1, e1 = 0, 0, True
            for atom, _ in w[k:e]:
                f2, l2, e2 = self._atom(atom)
                f1, l1, e1 = self._then(f1, l1, e1, f2, l2, e2)
            first, last, empty = self._then(first, last, empty, f1, l1, e1 or bool(g))
            k = e
        return first, last, empty

    def _then(self, f1: int, l1: int, e1: bool, f2: int, l2: int, e2: bool) -> tuple[int, int, bool]:
        for p in _bits(l1):
            self.follow[p] |= f2
        return f1 | (f2 if e1 else 0), l2 | (l1 if e2 else 0), e1 and e2

    def _atom(self, atom) -> tuple[int, int, bool]:
        if isinstance(atom, str):
            p = len(self.label)
            self.label.append(atom)
            self.slot.append(self.slots if atom == TEXT else -1)
            self.slots += atom == TEXT
            self.follow.append(0)
            return 1 << p, 1 << p, False
        first, last, empty = self._build(atom[1])
        for p in _bits(last):
            self.follow[p] |= first
        return first, last, empty

    def slots_of(self, labels: list[str]) -> list[int] | None:
        """The slot of each text of a page, or None where the page does not match."""
        key = tuple(labels)
        if key not in self.memo:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[key] = self._read(labels)
        return self.memo[key]

    def _read(self, labels: list[str]) -> list[int] | None:
        if not labels:
            return [] if self.empty else None
        states = []
        now = self.first
        for x in labels:
            now &= self.places.get(x, 0)
            if not now:
                return None
            states.append(now)
            reach = 0
            for p in _bits(now):
                reach |= self.follow[p]
            now = reach
        # back from the end, the first place that leads on
        end = states[-1] & self.last
        if not end:
            return None
        at = (end & -end).bit_length() - 1
        path = [at]
        for k in range(len(labels) - 2, -1, -1):
            at = next(p for p in _bits(states[k]) if self.follow[p] >> at & 1)
            path.append(at)
        return [self.slot[p] for p in reversed(path) if self.slot[p] >= 0]


def _bits(x: int) -> Iterator[int]:
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


def _dump(w: Wrapper) -> str:
    return json.dumps(w, separators=(",", ":"))


def _load(s: str) -> Wrapper:
    fix = lambda w: tuple((a if isinstance(a, str) else ("+", fix(a[1])), g) for a, g in w)
    return fix(json.loads(s))


def _narrow(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    return pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))


def wrappers(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(host, wrapper, expression, pages): the wrapper of every host."""

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, int] = {}
        memo: dict[tuple, str] = {}
        for batch in batches:
            for host, h in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                stream = tuple(tokens(h or "")[0])
                shape = memo.get(stream)
                if shape is None:
                    if len(memo) >= MEMO:
                        memo.clear()
                    shape = memo[stream] = _dump(fold(list(stream)))
                seen[host, shape] = seen.get((host, shape), 0) + 1
        keys = list(seen)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([seen[k] for k in keys], pa.int64())], ["host", "shape", "n"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "shape"], ascending=[False, True])
        w = infer([_load(s) for s in pdf["shape"]])
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "wrapper": [_dump(w)], "expression": [expression(w)], "pages": [int(pdf["n"].sum())]})

    distinct = _narrow(pages, page_id, url, html).select(host_of(F.col("url")).alias("host"), "html").mapInArrow(shapes, "host string, shape string, n long").groupBy("host", "shape").agg(F.sum("n").alias("n"))
    return distinct.groupBy("host").applyInPandas(merge, "host string, wrapper string, expression string, pages long")


def parse(pages: DataFrame, known: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, host, matched, slots, texts, row) of every page under its host's wrapper."""
    narrow = _narrow(pages, page_id, url, html)
    kind = dict(narrow.dtypes)["page_id"]

    joined = narrow.withColumn("host", host_of(F.col("url"))).join(known.select("host", "wrapper"), "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        compiled: dict[str, Compiled] = {}
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            matched, slots, texts = [], [], []
            for h, w in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist()):
                labels, t = tokens(h or "")
                c = compiled.get(w or "[]")
                if c is None:
                    c = compiled.setdefault(w or "[]", Compiled(_load(w or "[]")))
                s = c.slots_of(labels)
                matched.append(s is not None or not labels)
                slots.append(s if s is not None else [-1] * len(t))
                texts.append(t)
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(matched), pa.array(slots, pa.list_(pa.int32())), pa.array(texts, pa.list_(pa.string())), pa.array(range(number, number + batch.num_rows), pa.int64())], ["page_id", "url", "host", "matched", "slots", "texts", "row"])
            number += batch.num_rows

    return joined.select("page_id", "url", "host", "html", "wrapper").mapInArrow(run, f"page_id {kind}, url string, host string, matched boolean, slots array<int>, texts array<string>, row long")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, host, matched, n_slots, text): the texts of each page that are not template."""
    known = shared.written(wrappers(pages, page_id, url, html), "html-wrappers")
    parsed = shared.written(parse(pages, known, page_id, url, html), "html-parsed")
    every = parsed.filter("matched").select("host", "row", F.explode(F.arrays_zip("slots", "texts")).alias("z")).select("host", "row", F.col("z.slots").alias("slot"), F.xxhash64("z.texts").alias("h"))
    fixed = every.groupBy("host", "slot").agg(F.min("h").alias("a"), F.max("h").alias("b"), F.min("row").alias("r0"), F.max("row").alias("r1"))
    fixed = shared.written(fixed.filter("a = b and r0 <> r1").groupBy("host").agg(F.collect_set("slot").alias("fixed")), "html-fixed")
    out = parsed.join(fixed, "host", "left").withColumn("fixed", F.coalesce("fixed", F.array().cast("array<int>")))
    kept = F.filter(F.arrays_zip("slots", "texts"), lambda z: ~F.array_contains(F.col("fixed"), z["slots"]))
    text = F.array_join(F.transform(kept, lambda z: z["texts"]), "\n")
    return out.select("page_id", "url", "host", "matched", F.size(F.array_distinct("slots")).alias("n_slots"), text.alias("text"))
