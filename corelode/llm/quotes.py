"""Chat formatting by quotation linking.

Messages are read as lines with a quote depth (``>``, ``> >``, ``>>`` ...).  Runs
of one depth are passages; a passage is split into paragraphs and lines, which
are normalised (case, white space and punctuation at the ends are dropped) and
hashed.  The hashes of quoted units are joined to the hashes of the units that
messages wrote themselves, so each quote names its source.

A message answers the message that its shallowest linked depth quotes most, in
characters; where it quotes none that is known, it answers the turn before it.
Sources with a smaller turn in the same conversation come first, then, for text
that the own conversation lacks, the earliest message of another conversation that
wrote it; turns of different conversations do not bind each other.  Conversations
joined by such quotes become one thread.  Each thread is written out in reply order
(each message, then its answers by turn, depth first) without quotes and attribution
lines; where messages answer each other in a circle, the first of them answers none.

A quoted unit meets at most the sources of its own conversation and one more, so
common phrases do not multiply.

Defined results: a null text is a message without words, with null text; empty
texts stay empty; a text that is all quotes becomes empty; rows whose ``conv_id``
or ``turn`` is null are threads of their own; rows that repeat (conv_id, turn) are
kept as separate messages, told apart by role and text, and answers go to the
first of them; of equal candidates the one with the larger turn wins, then the
smaller conversation; units of fewer than ``MIN_WORDS`` words link nothing; an
empty table gives an empty table.  Columns other than the four named are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import neardup, scan, shared

MIN_WORDS = 3
OUT_ROWS = 5000
_QUOTE = re.compile(r"[ \t]{0,3}((?:>[ \t]?)+)")
_ATTRIBUTION = re.compile(r"\b(wrote|writes|said|schrieb|a écrit|escribió)\s*:$", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
_EDGE = re.compile(r"^\W+|\W+$")


def lines(text: str) -> list[tuple[int, str]]:
    """(quote depth, line without its marks); attributions just above a quote are left out."""
    out: list[tuple[int, str]] = []
    for line in text.split("\n"):
        m = _QUOTE.match(line)
        out.append((m.group(1).count(">"), line[m.end() :]) if m else (0, line))
    keep = []
    for k, (depth, line) in enumerate(out):
        if (bare := line.rstrip()).endswith(":") and _ATTRIBUTION.search(bare, max(0, len(bare.rstrip(": \t")) - 16)):
            after = next((d for d, x in out[k + 1 :] if x.strip() or d > depth), depth)
            if after > depth:
                continue
        keep.append((depth, line))
    return keep


def normal(s: str) -> str:
    return _EDGE.sub("", _SPACE.sub(" ", s).strip().casefold())


def units(parsed: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """(depth, normalised unit): the paragraphs and the lines of every passage."""
    out: list[tuple[int, str]] = []
    block: list[str] = []
    level = 0

    def flush() -> None:
        if len(block) > 1:
            out.append((level, normal(" ".join(block))))
        out.extend((level, normal(x)) for x in block)
        block.clear()

    for depth, line in parsed:
        if depth != level or not line.strip():
            flush()
            level = depth
        if line.strip():
            block.append(line)
    flush()
    return [(d, u) for d, u in out if u.count(" ") + 1 >= MIN_WORDS and u]


def own_text(parsed: list[tuple[int, str]]) -> str:
    """What the message says itself."""
    if all(d == 0 for d, _ in parsed):
        return "\n".join(x for _, x in parsed)
    kept = "\n".join(x for d, x in parsed if d == 0)
    return re.sub(r"\n{3,}", "\n\n", kept).strip("\n")


def _parse(messages: DataFrame) -> DataFrame:
    """(mid, kind, depth, hash, size): kind 0 for what a message wrote, 1 for what it quotes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, kind, depth, unit = [], [], [], []
            for r, t in enumerate(batch.column("text").to_pylist()):
                for d, u in set(units(lines(t))) if t else ():
                    row.append(r), kind.append(min(d, 1)), depth.append(d), unit.append(u)
            w = _hash(unit)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("mid").take(take), batch.column("conv_id").take(take), batch.column("turn").take(take), pa.array(kind, pa.int32()), pa.array(depth, pa.int32()), pa.array(w), pa.array([len(u) for u in unit], pa.int32())], ["mid", "conv_id", "turn", "kind", "depth", "hash", "size"])

    kinds = dict(messages.dtypes)
    return messages.select("mid", "conv_id", "turn", "text").mapInArrow(run, f"mid long, conv_id {kinds['conv_id']}, turn {kinds['turn']}, kind int, depth int, hash long, size int")


def _hash(unit: list[str]) -> np.ndarray:
    """64-bit hashes of the words of each unit."""
    if not unit:
        return np.zeros(0, np.int64)
    w = scan.words(pa.array(unit))
    acc = np.zeros(len(unit), dtype=np.uint64)
    place = np.arange(len(w.row)) - w.first[w.row]
    np.add.at(acc, w.row, scan.mix(w.hash + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return scan.mix(acc).astype(np.int64)


def _numbered(messages: DataFrame) -> DataFrame:
    """The messages with ``mid``, a number fixed by being written down with them."""
    named = messages.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return shared.written(named.withColumn("mid", F.monotonically_increasing_id()), "q-messages")


def links(messages: DataFrame) -> DataFrame:
    """(mid, depth, src_conv, src_turn, chars): the sources of each message's quotes, by depth."""
    parsed = shared.written(_parse(messages), "q-units")
    own = parsed.filter("kind = 0 and conv_id is not null and turn is not null")
    quoted = parsed.filter("kind = 1 and conv_id is not null and turn is not null")
    here = own.select("hash", "conv_id", F.col("turn").alias("src_turn")).distinct()
    near = quoted.join(here, ["hash", "conv_id"]).filter("src_turn < turn").select("mid", "depth", "hash", "size", F.col("conv_id").alias("src_conv"), "src_turn")
    rest = quoted.join(near.select("mid", "depth", "hash").distinct(), ["mid", "depth", "hash"], "left_anti")
    # the earliest writer, and the earliest of another conversation than its
    place = F.struct(F.col("src_turn").alias("t"), F.col("conv_id").alias("c"))
    each = here.groupBy("hash", "conv_id").agg(F.min("src_turn").alias("src_turn"))
    first = each.groupBy("hash").agg(F.min(place).alias("one"))
    second = each.join(first, "hash").filter("conv_id <> one.c").groupBy("hash").agg(F.min(place).alias("two"))
    writers = first.join(second, "hash", "left")
    far = rest.join(writers, "hash").withColumn("src", F.when(F.col("one.c") != F.col("conv_id"), F.col("one")).otherwise(F.col("two"))).filter("src is not null").select("mid", "depth", "hash", "size", F.col("src.c").alias("src_conv"), F.col("src.t").alias("src_turn"))
    return near.unionByName(far).groupBy("mid", "depth", "src_conv", "src_turn").agg(F.sum("size").alias("chars"))


def parents(messages: DataFrame, found: DataFrame) -> DataFrame:
    """(mid, parent_conv, parent_turn) of every message that quotes a known one."""
    m = messages.select("mid", "conv_id")
    best = F.min(F.struct(F.col("depth"), (F.col("src_conv") != F.col("conv_id")).alias("away"), (-F.col("chars")).alias("c"), (-F.col("src_turn")).alias("t"), F.col("src_conv"), F.col("src_turn"))).alias("b")
    return found.join(m, "mid").groupBy("mid").agg(best).select("mid", F.col("b.src_conv").alias("parent_conv"), F.col("b.src_turn").alias("parent_turn"))


def order(rows: list[tuple]) -> list[tuple[int, object]]:
    """Reply order of a thread: (row index, depth).  Rows: (conv, turn, parent conv, parent turn) or None."""
    first: dict[tuple, int] = {}
    for k, (c, t, _, _) in enumerate(rows):
        first.setdefault((c, t), k)
    before: dict[object, tuple] = {}
    parent: list[int | None] = []
    for k in range(len(rows)):
        c, t, pc, pt = rows[k]
        up = first.get((pc, pt)) if pc is not None else None
        if up is None and before.get(c) is not None:
            up = first.get((c, before[c])) if before[c] != t else first.get((c, t)) if first[(c, t)] != k else None
        parent.append(up if up != k else None)
        before[c] = t
    # a circle is opened at its first message
    seen = [0] * len(rows)
    for k in range(len(rows)):
        at: int | None = k
        while at is not None and not seen[at]:
            seen[at] = k + 1
            at = parent[at]
        if at is not None and seen[at] == k + 1:
            circle, x = [at], parent[at]
            while x != at:
                circle.append(x)
                x = parent[x]
            parent[min(circle)] = None
    children: dict[int | None, list[int]] = defaultdict(list)
    for k, up in enumerate(parent):
        children[up].append(k)
    out: list[tuple[int, object]] = []
    stack = [(k, 0) for k in reversed(children[None])]
    while stack:
        k, depth = stack.pop()
        out.append((k, depth))
        stack += [(x, depth + 1) for x in reversed(children.get(k, []))]
    return out


def threads(conversations: DataFrame) -> DataFrame:
    """(thread_id, position, depth, conv_id, turn, role, parent_conv, parent_turn, text) in reply order."""
    messages = _numbered(conversations)
    kinds = dict(messages.dtypes)
    up = shared.written(parents(messages, links(messages)), "q-parents")
    joined = messages.join(up, "mid", "left")
    across = joined.filter("parent_conv <> conv_id").select(F.col("conv_id").alias("a"), F.col("parent_conv").alias("b")).distinct()
    thread = F.col("conv_id")
    if not across.isEmpty():
        roots = neardup.components(across)
        joined = joined.join(roots, joined["conv_id"] == roots["node"], "left").drop("node")
        thread = F.coalesce("root", "conv_id")
    joined = joined.withColumn("thread_id", thread)
    # a message without conversation or turn is a thread of its own
    joined = joined.withColumn("alone", F.when(F.col("conv_id").isNull() | F.col("turn").isNull(), F.col("mid")))

    columns = ["thread_id", "alone", "conv_id", "turn", "role", "parent_conv", "parent_turn", "text"]
    rows = joined.select(*columns).repartition("thread_id", "alone").sortWithinPartitions("thread_id", "alone", "turn", "conv_id", "role", "text")
    names = ["thread_id", "position", "depth", "conv_id", "turn", "role", "parent_conv", "parent_turn", "text"]

    def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []
        thread: list[tuple] = []
        done: list[tuple] = []

        def close() -> None:
            placed = order([(c, t, pc, pt) for _, _, c, t, _, pc, pt, _ in thread])
            for position, (k, depth) in enumerate(placed):
                root, _, c, t, role, pc, pt, text = thread[k]
                if text and ">" in text:
                    text = own_text(lines(text))
                done.append((root, position, depth, c, t, role, pc, pt, text))
            thread.clear()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(types)], names)
            done.clear()
            return out

        for batch in batches:
            kind = {c: batch.column(c).type for c in columns}
            types = [kind["thread_id"], pa.int32(), pa.int32(), kind["conv_id"], kind["turn"], pa.string(), kind["parent_conv"], kind["parent_turn"], pa.string()]
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                if thread and row[:2] != thread[0][:2]:
                    close()
                    if len(done) >= OUT_ROWS:
                        yield flush()
                thread.append(row)
        if thread:
            close()
        if done:
            yield flush()

    schema = f"thread_id {kinds['conv_id']}, position int, depth int, conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, parent_conv {kinds['conv_id']}, parent_turn {kinds['turn']}, text string"
    return rows.mapInArrow(arrange, schema)
