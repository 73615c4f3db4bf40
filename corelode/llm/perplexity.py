"""Quality rules: n-gram perplexity with language-specific bands.

An interpolated modified Kneser-Ney model over UTF-8 bytes is counted by Spark
from every document, one model per language, and kept as sorted hash arrays.
Each document gets its perplexity per word character under its language's
model; a document whose perplexity leaves its language's band is rejected.

* Counting covers all bytes of all documents.  Tasks pre-aggregate, so what is
  shuffled is one row per distinct n-gram of a task.
* Scoring has one plan at every size.  The texts are written once in parts and stay
  there; the n-grams of each part are joined to the model, and the task that scans
  a part reads its own slice of the model as a sorted hash array.  No task and no
  driver holds the whole model, and a slice is bounded by the bytes of its part.
* Lower orders use continuation counts, derived from the distinct n-grams one
  order up, so the text is read once for all orders.
* Digits count as one symbol, control characters as a space; case is kept.
* Normalising by word characters, not bytes, makes inserted symbols raise the
  perplexity even when the symbols themselves are easy to predict.
* The band of a language is the median of its log perplexities, widened by
  ``z`` robust deviations that shrink with the square root of the length and by
  a relative ``slack``.  Both sides reject: text that is too strange, and text
  that is too repetitive.

Defined results: a null language is the language ``und``; a null or empty text
has no perplexity and is rejected; a text without word characters is scored as
if it had one; rows with equal contents get equal decisions, and repeated rows
stay repeated; an empty table gives an empty table.  Columns of the input that
bear the name of an added column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import scan, shared

ORDER = 5
Z_LOW, Z_HIGH, SLACK = 5.0, 5.0, 0.03
PARTS_A_ROW = 1 << 12  # parts that one row lists for an n-gram
PIECE_BYTES = 1 << 19
BOS = 2
UNKNOWN = "und"
ADDED = ("log_ppl", "n_units", "perplexity")

_MAP = np.arange(256, dtype=np.uint8)
_MAP[:33] = 32
_MAP[127] = 32
_MAP[48:58] = 48
_UNIT = np.zeros(256, dtype=bool)
for _b in range(256):
    _UNIT[_b] = _b >= 0x80 or chr(_b).isalnum()


def _codes(texts: pa.Array, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(n-gram code at every byte, owner row of every byte, word bytes per row), once or more often.

    A text of more than ``PIECE_BYTES`` is read in pieces, so memory does not grow with its length.
    """
    raw, offsets = scan.buffers(texts)
    rows = len(offsets) - 1
    pad = order - 1
    if rows == 1 and len(raw) > PIECE_BYTES:
        before = np.full(pad, BOS, dtype=np.uint8)
        for lo in range(0, len(raw), PIECE_BYTES):
            piece = raw[lo : lo + PIECE_BYTES]
            window = np.concatenate([before, _MAP[piece]])
            code = np.zeros(len(piece), dtype=np.uint64)
            for k in range(order):
                code <<= np.uint64(8)
                code |= window[k : k + len(piece)]
            before = window[len(window) - pad :]
            yield code, np.zeros(len(piece), dtype=np.int64), np.array([np.count_nonzero(_UNIT[piece])])
        return
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    padded = np.full(len(raw) + pad * rows, BOS, dtype=np.uint8)
    at = np.arange(len(raw)) + (owner + 1) * pad
    padded[at] = _MAP[raw]
    code = np.zeros(len(raw), dtype=np.uint64)
    for back in range(pad, -1, -1):
        code <<= np.uint64(8)
        code |= padded[at - back]
    yield code, owner, np.bincount(owner, weights=_UNIT[raw], minlength=rows).astype(np.int64)


def _languages(batch: pa.RecordBatch, lang: str) -> Iterator[tuple[str, np.ndarray]]:
    values = pc.fill_null(batch.column(lang).cast(pa.string()), UNKNOWN).dictionary_encode()
    index = values.indices.to_numpy(zero_copy_only=False)
    for k, name in enumerate(values.dictionary.to_pylist()):
        yield name, np.flatnonzero(index == k)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.concatenate([c for c, _ in parts])
    counts = np.concatenate([n for _, n in parts])
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(counts, first)


def gather(held: DataFrame, order: int = ORDER, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, code, block, n, parts): how often each byte n-gram occurs in all documents, and in which parts."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str], list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for part, at in shared.parts(batch):
                mine = batch.take(pa.array(at))
                for name, rows in _languages(mine, "lang"):
                    texts = mine.column("text").take(pa.array(rows))
                    for code, _, _ in (x for i, j in scan.slices(texts) for x in _codes(texts.slice(i, j - i), order)):
                        if not len(code):
                            continue
                        code.sort()
                        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
                        pieces = held.setdefault((part, name), [])
                        pieces.append((code[first], np.diff(np.append(first, len(code)))))
                        if len(pieces) >= 16:
                            held[part, name] = [_merge(pieces)]
        for (part, name), pieces in held.items():
            codes, counts = _merge(pieces)
            for k in range(0, len(codes), 1 << 17):
                c, n = codes[k : k + (1 << 17)].astype(np.int64), counts[k : k + (1 << 17)].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), part)), pa.array([name] * len(c)), pa.array(c), pa.array(n)], ["part", "lang", "code", "n"])

    narrow = held.select(shared.ROW, F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = narrow.mapInArrow(partial, "part long, lang string, code long, n long")
    # tasks have pre-aggregated: one shuffle, then each n-gram's rows become one
    each = rows.repartition("lang", "code").withColumn("block", F.floor(F.col("part") / PARTS_A_ROW))
    return each.groupBy("lang", "code", "block").agg(F.sum("n").alias("n"), F.collect_set("part").alias("parts"))


def totals(gathered: DataFrame) -> DataFrame:
    """(lang, code, n): how often each byte n-gram occurs, over all documents."""
    return gathered.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def count_ngrams(docs: DataFrame, order: int = ORDER, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, code, n) of any table of documents."""
    scan.small_batches(docs.sparkSession)
    return totals(gather(shared.parted(docs.select(text, lang), "kn-docs"), order, text, lang))


def smooth(counts: DataFrame, order: int = ORDER) -> dict[int, DataFrame]:
    """(lang, code, ctx, p, g) by order: probability of each n-gram, and its context's weight for backing off."""
    tables = {order: shared.written(counts.withColumnRenamed("n", "c"), "kn-counts")}
    for n in range(order - 1, 0, -1):
        suffix = F.col("code").bitwiseAND(F.lit((1 << (8 * n)) - 1))
        tables[n] = tables[n + 1].groupBy("lang", suffix.alias("code")).agg(F.count(F.lit(1)).alias("c"))
    lower: DataFrame | None = None
    out: dict[int, DataFrame] = {}
    for n in range(1, order + 1):
        t = tables[n]
        of = [F.sum((F.col("c") == k).cast("long")).alias(f"t{k}") for k in (1, 2, 3, 4)]
        t4 = F.broadcast(t.groupBy("lang").agg(*of))  # one row per language
        y = F.col("t1") / F.greatest(F.col("t1") + 2 * F.col("t2"), F.lit(1))
        cut = [F.greatest(F.lit(0.0), F.least(F.lit(float(k)), k - (k + 1) * y * F.col(f"t{k + 1}") / F.greatest(F.col(f"t{k}"), F.lit(1)))) for k in (1, 2, 3)]
        disc = t4.select("lang", *[d.alias(f"d{k}") for k, d in zip((1, 2, 3), cut)])
        t = t.join(disc, "lang").withColumn("d", F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.least(F.col("d3"), F.col("c"))))
        context = F.shiftright("code", 8)
        w = Window.partitionBy("lang", "ctx")
        t = t.withColumn("ctx", context).withColumn("total", F.sum("c").over(w)).withColumn("freed", F.sum("d").over(w))
        if lower is None:
            p_low = F.lit(1 / 256)
        else:
            t = t.withColumn("suffix", F.col("code").bitwiseAND(F.lit((1 << (8 * (n - 1))) - 1)))
            low = lower.select(F.col("lang"), F.col("code").alias("suffix"), F.col("p").alias("p_low"))
            t = t.join(low, ["lang", "suffix"])
            p_low = F.col("p_low")
        p = (F.col("c") - F.col("d") + F.col("freed") * p_low) / F.col("total")
        lower = out[n] = shared.written(t.select("lang", "code", "ctx", p.alias("p"), (F.col("freed") / F.col("total")).alias("g")), f"kn-{n}")
    return out


def fit(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, ord, code, logp, backoff): the whole model from the n-gram counts.

    ``logp`` is null for a context that never ends an n-gram itself.
    """
    out: DataFrame | None = None
    for n, mine in smooth(counts, order).items():
        grams = mine.select("lang", F.lit(n).alias("ord"), "code", F.log("p").alias("logp"), F.lit(None).cast("double").alias("backoff"))
        weights = mine.groupBy("lang", F.col("ctx").alias("code")).agg(F.first("g").alias("g"))
        weights = weights.select("lang", F.lit(n - 1).alias("ord"), "code", F.lit(None).cast("double").alias("logp"), F.log("g").alias("backoff"))
        both = grams.unionByName(weights)
        out = both if out is None else out.unionByName(both)
    return out.groupBy("lang", "ord", "code").agg(F.max("logp").alias("logp"), F.max("backoff").alias("backoff"))


class SortedHashes:
    """Values by 64-bit key: a sorted key array under a table of bucket starts."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.values = [v[order] for v in values]
        self.bits = max(1, min(22, int(len(keys)).bit_length()))
        edges = np.arange((1 << self.bits) + 1, dtype=np.float64)
        top = self.keys >> np.uint64(64 - self.bits)
        self.start = np.searchsorted(top, edges[:-1].astype(np.uint64)).astype(np.int32)
        self.longest = int(np.max(np.bincount(top.astype(np.int64)), initial=1))
        self.keys = np.append(self.keys, np.uint64(2**64 - 1))
        self.values = [np.append(v, v.dtype.type(np.nan)) for v in self.values]

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each key, or that of the sentinel, whose values are NaN."""
        at = self.start[h >> np.uint64(64 - self.bits)]
        out = np.where(self.keys[at] == h, at, len(self.keys) - 1)
        left = np.flatnonzero(self.keys[at] < h)
        pos = at[left]
        for _ in range(self.longest):
            if not len(left):
                break
            pos = np.minimum(pos + 1, len(self.keys) - 1)
            here = self.keys[pos]
            hit = here == h[left]
            out[left[hit]] = pos[hit]
            more = here < h[left]
            left, pos = left[more], pos[more]
        return out


def backed_off(need: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, code, v): the log probability of each n-gram of ``need``, seen or not."""
    value, carried = F.lit(None).cast("double"), F.lit(0.0)
    for n in range(order, 0, -1):
        m = model.filter(F.col("ord") == n).select("lang", F.col("code").alias("_c"), F.col("logp").alias(f"_p{n}"))
        need = need.withColumn("_c", F.col("code").bitwiseAND(F.lit((1 << (8 * n)) - 1))).join(m, ["lang", "_c"], "left").drop("_c")
        value = F.coalesce(value, carried + F.col(f"_p{n}"))
        b = model.filter(F.col("ord") == n - 1).select("lang", F.col("code").alias("_c"), F.col("backoff").alias(f"_b{n}"))
        need = need.withColumn("_c", F.shiftright("code", 8).bitwiseAND(F.lit((1 << (8 * (n - 1))) - 1))).join(b, ["lang", "_c"], "left").drop("_c")
        carried = carried + F.coalesce(F.col(f"_b{n}"), F.lit(0.0))
    return need.select("lang", "code", F.coalesce(value, carried + float(np.log(1 / 256))).alias("v"))


def arrays(rows: pa.Table | None) -> dict[str, SortedHashes]:
    """The model's slice of a part as sorted hash arrays, one a language."""
    if rows is None:
        return {}
    lang = rows["lang"].combine_chunks().dictionary_encode()
    index = lang.indices.to_numpy()
    key, v = scan.mix(rows["code"].to_numpy().astype(np.uint64)), rows["v"].to_numpy()
    return {name: SortedHashes(key[index == k], v[index == k]) for k, name in enumerate(lang.dictionary.to_pylist())}


def _scores(held: DataFrame, gathered: DataFrame, values: DataFrame, order: int, text: str, lang: str) -> DataFrame:
    """(part, _row, lang, log_ppl, n_units) of every row; ``values`` has (lang, code, v) of all that occur."""
    known = gathered.join(values.select("lang", "code", F.col("v").cast("float").alias("v")), ["lang", "code"])
    side = shared.Side(known.select(F.explode("parts").alias("part"), "lang", "code", "v"), "kn-slices", "lang", "code")
    narrow = held.select(shared.ROW, F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, rows in shared.parts(batch):
                models = side.of(part, arrays)
                mine = batch.take(pa.array(rows))
                total, units = np.zeros(len(rows)), np.zeros(len(rows), dtype=np.int64)
                for name, at in _languages(mine, "lang"):
                    texts = mine.column("text").take(pa.array(at))
                    for i, j in scan.slices(texts):
                        for code, owner, n in _codes(texts.slice(i, j - i), order):
                            if len(code):
                                v = models[name].values[0][models[name].find(scan.mix(code))]
                                total[at[i:j]] += np.bincount(owner, weights=v, minlength=j - i)
                            units[at[i:j]] += n
                size = pc.fill_null(pc.binary_length(mine.column("text")), 0).to_numpy(zero_copy_only=False)
                nll = pa.array(-total / np.maximum(units, 1), mask=size == 0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), part)), mine.column(shared.ROW), pc.fill_null(mine.column("lang"), UNKNOWN), nll, pa.array(units)], ["part", shared.ROW, "lang", "log_ppl", "n_units"])

    return narrow.mapInArrow(scored, f"part long, {shared.ROW} long, lang string, log_ppl double, n_units long")


def _with_scores(held: DataFrame, side: shared.Side) -> DataFrame:
    """The held rows, without numbers, with ``log_ppl``, ``n_units`` and ``perplexity``."""
    names = [c for c in held.columns if c != shared.ROW]

    def table(rows: pa.Table) -> tuple[np.ndarray, pa.Table]:
        rows = rows.sort_by(shared.ROW)
        return rows[shared.ROW].to_numpy(), rows

    def attach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, at in shared.parts(batch):
                number, rows = side.of(part, table)
                mine = batch.take(pa.array(at))
                found = rows.take(pa.array(np.searchsorted(number, mine.column(shared.ROW).to_numpy()))).combine_chunks()
                cols = [found[c].chunk(0) if found[c].num_chunks else pa.array([], found[c].type) for c in ("log_ppl", "n_units")]
                yield pa.RecordBatch.from_arrays([*(mine.column(c) for c in names), *cols], [*names, "log_ppl", "n_units"])

    schema = T.StructType([*[f for f in held.schema.fields if f.name != shared.ROW], T.StructField("log_ppl", T.DoubleType()), T.StructField("n_units", T.LongType())])
    return held.mapInArrow(attach, schema).withColumn("perplexity", F.exp("log_ppl"))


def score(docs: DataFrame, model: DataFrame, order: int = ORDER, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with ``log_ppl``, ``n_units`` and ``perplexity`` under a model of any documents."""
    scan.small_batches(docs.sparkSession)
    held = shared.parted(docs.drop(*ADDED), "kn-docs")
    gathered = shared.written(gather(held, order, text, lang), "kn-grams")
    values = shared.written(backed_off(gathered.select("lang", "code").distinct(), model, order), "kn-values")
    return _with_scores(held, shared.Side(_scores(held, gathered, values, order, text, lang), "kn-scores"))


def bands(scored: DataFrame, lang: str = "lang") -> DataFrame:
    """(band_lang, centre, spread) per language, from all scored documents.

    Medians are taken over values rounded to 1e-4 and counted, so they are exact
    for the rounded values and do not depend on the order of the rows.
    """
    v = scored.filter(F.col("log_ppl").isNotNull()).select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("band_lang"), "log_ppl", "n_units")
    mid = v.groupBy("band_lang", F.round("log_ppl", 4).alias("x")).agg(F.count(F.lit(1)).alias("k")).groupBy("band_lang").agg(F.expr("percentile(x, 0.5, k)").alias("centre"))
    off = v.join(F.broadcast(mid), "band_lang").select("band_lang", "centre", F.round(F.abs(F.col("log_ppl") - F.col("centre")) * F.sqrt(F.greatest("n_units", F.lit(1))), 4).alias("x"))
    return off.groupBy("band_lang", "centre", "x").agg(F.count(F.lit(1)).alias("k")).groupBy("band_lang", "centre").agg((1.4826 * F.expr("percentile(x, 0.5, k)")).alias("spread"))


def decide(scored: DataFrame, limits: DataFrame, lang: str = "lang", z_low: float = Z_LOW, z_high: float = Z_HIGH, slack: float = SLACK) -> DataFrame:
    """``scored`` with ``ppl_low``, ``ppl_high`` (the document's band) and ``keep``."""
    scored = scored.drop("band_lang", "centre", "spread", "ppl_low", "ppl_high", "keep").withColumn("band_lang", F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)))
    unit = F.col("spread") / F.sqrt(F.greatest("n_units", F.lit(1)))
    joined = scored.join(F.broadcast(limits), "band_lang", "left")  # one row per language
    out = joined.withColumn("ppl_low", F.exp(F.col("centre") * (1 - slack) - z_low * unit)).withColumn("ppl_high", F.exp(F.col("centre") * (1 + slack) + z_high * unit))
    keep = F.coalesce(F.col("perplexity").between(F.col("ppl_low"), F.col("ppl_high")), F.lit(False))
    return out.withColumn("keep", keep).drop("band_lang", "centre", "spread")


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", order: int = ORDER, **params) -> DataFrame:
    """Every row of ``docs`` with its perplexity, its band and ``keep``."""
    scan.small_batches(docs.sparkSession)
    held = shared.parted(docs.drop(*ADDED), "kn-docs")
    gathered = shared.written(gather(held, order, text, lang), "kn-grams")
    # the documents are the model's own, so each of their n-grams is in its highest order
    top = smooth(totals(gathered), order)[order].select("lang", "code", F.log("p").alias("v"))
    side = shared.Side(_scores(held, gathered, top, order, text, lang), "kn-scores")
    known = docs.sparkSession.read.schema("lang string, log_ppl double, n_units long").parquet(side.path)
    return decide(_with_scores(held, side), bands(known), lang, **params)


def keep_in_band(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that the perplexity bands keep, with their own columns."""
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text, lang = (f"c{names.index(params.pop(k, k))}" for k in ("text", "lang"))
    return judge(inner, text=text, lang=lang, **params).filter("keep").select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
