"""Full-text search: documents, postings, shards, hot tokens, planning and BM25.

A document is a (pid, field) pair.  Postings carry tf, document length and df, are
partitioned by the hash of the token, and are sorted inside a shard, so a query
reads the row groups of its tokens in its shards only.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..lineage import forget_at_exit, fresh, hadoop_path, local, written

K1, B = 1.2, 0.75
WEIGHTS = {"sample.label": 3.0, "concept.label": 2.5, "sample.place_name": 2.0, "sample.description": 1.0}
CLAMP = 65535
SHARDS = 256
TOP = 50
HOT_TOP = 500
CAP_BYTES = 5 << 20
COMPRESSION = 0.7  # first guess of a file's bytes by those of its values
ATTEMPTS = 12
PART_POSTINGS = 1_000_000  # postings of a token from which it is cut in parts
STOPWORDS = frozenset("a an and at for from in is of on or the to was with".split())
MIN_QUERY = 2


def fragments(samples: DataFrame, concept_links: DataFrame, concepts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(pid, field, text): what is indexed of a sample.

    ``concept_links`` has (pid, concept id); a concept is named by the English (or
    language-less) label of the vocabulary, else by its own, else by its URI's tail.
    """
    v = vocabulary.filter(F.col("lang").isNull() | (F.col("lang") == "en")).groupBy("uri").agg(F.min("pref_label").alias("pref"))
    named = concepts.select(F.col("row_id").alias("concept"), F.col("pid").alias("uri"), F.col("label").alias("own")).join(v, "uri", "left")
    named = named.select("concept", tx.label_or_tail(F.coalesce(F.nullif(F.trim("pref"), F.lit("")), F.col("own")), F.col("uri")).alias("text"))
    out = samples.select("pid", F.lit("sample.label").alias("field"), F.col("label").alias("text"))
    out = out.unionByName(samples.select("pid", F.lit("sample.description").alias("field"), F.col("description").alias("text")))
    if "place_name" in samples.columns:
        out = out.unionByName(samples.select("pid", F.lit("sample.place_name").alias("field"), F.explode("place_name").alias("text")))
    out = out.unionByName(concept_links.join(named, "concept").select("pid", F.lit("concept.label").alias("field"), "text"))
    return out.filter(tx.not_blank(F.col("text")))


def _documents(frags: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Fragments that are a document of their own, and those of documents of several (None where there are none).

    Only ids are shuffled to tell them apart.
    """
    tx.small_batches(frags.sparkSession)
    many = frags.groupBy("pid", "field").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select(F.col("pid").alias("_pid"), F.col("field").alias("_field"))
    many = written(many, "documents-of-several")
    if many.isEmpty():
        return frags, None
    same = F.col("pid").eqNullSafe(F.col("_pid")) & F.col("field").eqNullSafe(F.col("_field"))
    return frags.join(many, same, "left_anti"), frags.join(many, same, "left_semi")


def _short(n: Column) -> Column:
    return F.least(n, F.lit(CLAMP)).cast("int")


def _merged(frags: DataFrame) -> DataFrame:
    """(token, hash, pid, field, n, doc_len) of documents of several fragments."""
    counted = frags.select("pid", "field", F.explode(tx.token_counts(F.col("text"))).alias("t")).select("pid", "field", "t.*")
    n = counted.repartition("pid", "field").groupBy("pid", "field", "token", "hash").agg(F.sum("n").alias("n"))
    return n.withColumn("doc_len", F.sum("n").over(Window.partitionBy("pid", "field")))


def hashed_postings(frags: DataFrame) -> DataFrame:
    """:func:`postings` with the hash of the token."""
    alone, several = _documents(frags)
    counts = alone.select("pid", "field", tx.token_counts(F.col("text")).alias("t"))
    sized = counts.withColumn("doc_len", F.aggregate("t", F.lit(0).cast("long"), lambda n, z: n + z["n"]))
    rows = sized.select("pid", "field", "doc_len", F.explode("t").alias("t")).select("pid", "field", "t.token", "t.hash", "t.n", "doc_len")
    if several is not None:
        rows = rows.unionByName(_merged(several))
    return rows.select("token", "pid", "field", _short(F.col("n")).alias("tf"), _short(F.col("doc_len")).alias("doc_len"), "hash")


def postings(frags: DataFrame) -> DataFrame:
    """(token, pid, field, tf, doc_len): tokens are counted where the fragments are.

    A fragment that is a whole document is not shuffled at all; of documents of several
    a row for each different token of a fragment is, never a text.  Both numbers are
    clamped to 16 bits (see :func:`clamped`).
    """
    return hashed_postings(frags).drop("hash")


def frequencies(frags: DataFrame) -> DataFrame:
    """(token, df) as :func:`document_frequency` of the postings, which are not made: tokens are counted in each task first."""
    alone, several = _documents(frags)
    n = tx.token_documents(alone, "text")
    if several is not None:
        n = n.unionByName(_merged(several).groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    return n.groupBy("token").agg(F.sum("n").alias("df"))


def documents(frags: DataFrame) -> DataFrame:
    """(pid, field, doc_len): one row for each document with tokens, as in the postings; only numbers are shuffled."""
    tx.small_batches(frags.sparkSession)
    n = frags.select("pid", "field", tx.token_number(F.col("text")).alias("n")).groupBy("pid", "field").agg(F.sum("n").alias("n"))
    return n.filter("n > 0").select("pid", "field", _short(F.col("n")).alias("doc_len"))


def clamped(rows: DataFrame) -> DataFrame:
    """(tf_clamped, len_clamped, max_tf, max_len) of postings."""
    return rows.agg(F.count_if(F.col("tf") >= CLAMP).alias("tf_clamped"), F.count_if(F.col("doc_len") >= CLAMP).alias("len_clamped"), F.max("tf").alias("max_tf"), F.max("doc_len").alias("max_len"))


def document_frequency(rows: DataFrame) -> DataFrame:
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def field_stats(rows: DataFrame) -> DataFrame:
    """(field, docs, avg_len): exact, from one row a document."""
    docs = rows.groupBy("pid", "field").agg(F.max("doc_len").alias("doc_len"))
    return docs.groupBy("field").agg(F.count(F.lit(1)).alias("docs"), F.avg("doc_len").alias("avg_len"))


def bm25(tf: Column, df: Column, doc_len: Column, avg_len: Column, total: Column, weight: Column) -> Column:
    idf = F.log((total - df + 0.5) / (df + 0.5) + 1)
    return weight * idf * (tf * (K1 + 1)) / (tf + K1 * (1 - B + B * doc_len / avg_len))


def weight_of(col: Column, weights: Mapping[str, float] = WEIGHTS) -> Column:
    out = None
    for k, w in weights.items():
        out = F.when(col == k, w) if out is None else out.when(col == k, w)
    return F.lit(1.0) if out is None else out.otherwise(1.0)


def with_df(rows: DataFrame) -> DataFrame:
    """Postings with df beside them, as they are stored."""
    return rows.join(document_frequency(rows), "token")


def scored(stored: DataFrame, stats: DataFrame, tokens: Sequence[str] | None = None, weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """(token, pid, field, c): the contribution of every posting (of the given tokens)."""
    rows = stored if tokens is None else stored.filter(F.col("token").isin(list(tokens)))
    small = F.broadcast(stats.withColumn("n_docs", F.sum("docs").over(Window.partitionBy())))  # one row a field
    c = bm25(F.col("tf"), F.col("df"), F.col("doc_len"), F.col("avg_len"), F.col("n_docs"), weight_of(F.col("field"), weights))
    return rows.join(small, "field").select("token", "pid", "field", c.alias("c"))


def rank(contributions: DataFrame, tokens: Sequence[str], top: int | None = TOP, key: str = "pid") -> DataFrame:
    """(pid, score): what holds all the tokens, best first, ties by key."""
    out = contributions.groupBy(key).agg(F.sum("c").alias("score"), F.count_distinct("token").alias("n")).filter(F.col("n") == len(set(tokens))).select(key, "score")
    return out if top is None else out.orderBy(F.desc("score"), F.asc(key)).limit(top)


def hot_tokens(stored: DataFrame, cap: int) -> DataFrame:
    """(token, postings, parts): tokens with more than ``cap`` postings, and in how many parts they are cut."""
    return hot_of(document_frequency(stored), cap)


def hot_of(df: DataFrame, cap: int) -> DataFrame:
    """:func:`hot_tokens` from (token, df)."""
    n = df.select("token", F.col("df").alias("postings")).filter(F.col("postings") > cap)
    return n.withColumn("parts", F.greatest(F.lit(2), F.ceil(F.col("postings") / cap)).cast("int"))


def _slice(hash_: Column, shards: int, slices: Column) -> Column:
    """The slice of its shard that a token belongs to."""
    return F.pmod(F.floor(hash_ / shards), slices).cast("int")


def laid_out(rows: DataFrame, df: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Hashed postings with (df, shard, part), sorted by token in as many pieces as their number asks for.

    Tokens of over ``PART_POSTINGS`` are salted by pid into parts and take their df from
    ``df`` (a stored table); the others have all their postings in one piece, where they
    are counted.  Postings are shuffled and sorted once.
    """
    total = df.agg(F.sum("df")).first()[0] or 0
    slices = max(1, -(-2 * total // (shards * PART_POSTINGS)))
    hot = hot_of(df, PART_POSTINGS).select("token", F.col("postings").alias("_df"), "parts")
    out = rows.join(F.broadcast(hot), "token", "left")  # total / PART_POSTINGS rows at most
    out = out.withColumn("shard", F.pmod("hash", F.lit(shards)).cast("int")).withColumn("part", F.coalesce(F.pmod(F.xxhash64("pid"), F.col("parts")).cast("int"), F.lit(-1)))
    out = out.withColumn("slice", _slice(F.col("hash"), shards, F.lit(slices))).drop("parts")
    piece = ["shard", "part", "slice"]
    out = out.repartition(*piece).sortWithinPartitions(*piece, "token", "pid", "field")
    here = F.count(F.lit(1)).over(Window.partitionBy(*piece, "token"))
    return out.select("token", "pid", "field", "tf", "doc_len", F.coalesce("_df", here).alias("df"), "hash", "shard", "part")


@dataclass
class _Hot:
    """A token with files of its own: their folder, how many they are, its postings, whether they are written."""

    key: str
    parts: int
    postings: int
    done: bool = False


def hot_key(token: str, used: set[str]) -> str:
    """The hash of a token in hex, with a suffix where another token has the same."""
    base = key = f"{tx.fnv1a32(token):08x}"
    n = 0
    while key in used:
        n += 1
        key = f"{base}-{n}"
    used.add(key)
    return key


def write_index(stored: DataFrame, path: str, cap_bytes: int = CAP_BYTES, shards: int = SHARDS) -> Manifest:
    """Write the index below ``path`` so that no file is larger than ``cap_bytes``; its manifest beside it.

    ``stored`` is read several times, so it should be a table; a column ``hash`` saves
    hashing its tokens.  The bytes of a posting are measured on a file of some of them.
    From these follow the slices of each shard, by further digits of the hash, and the
    tokens that get files of their own, split by pid.  Files are measured after writing: a
    token's files are split twice as finely, and the heaviest token of a slice is moved out
    of it, until all fit.  What still does not fit after ``ATTEMPTS`` is named in the
    manifest.  The driver handles one entry a file and a hot token.
    """
    spark = stored.sparkSession
    rows = stored if "hash" in stored.columns else stored.withColumn("hash", tx.fnv1a32_col(F.col("token")))
    rows = rows.select(*COLUMNS, "hash").withColumn("shard", F.pmod("hash", F.lit(shards)).cast("int"))
    counts = written(rows.groupBy("shard", "hash", "token").agg(F.count(F.lit(1)).alias("n")), "index-counts")
    in_shard = {r.shard: (r.n, r.tokens) for r in counts.groupBy("shard").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("tokens")).collect()}  # one row a shard
    guess = _bytes_each(rows, sum(n for n, _ in in_shard.values()), cap_bytes)
    hot: dict[str, _Hot] = {}
    used: set[str] = set()

    def promote(token: str, n: int) -> None:
        hot[token] = _Hot(hot_key(token, used), max(2, min(n, -(-int(n * guess / FILL) // cap_bytes))), n)

    for r in counts.filter(F.col("n") * guess > cap_bytes * HEAVY).orderBy("token").collect():  # hot tokens
        promote(r.token, r.n)
        n, tokens = in_shard[r.shard]
        in_shard[r.shard] = n - r.n, tokens - 1
    slices = {s: max(1, min(tokens, -(-int(n * guess / FILL) // cap_bytes))) for s, (n, tokens) in in_shard.items()}
    sliced = rows.withColumn("slice", _sliced(slices, shards))
    counts = counts.withColumn("slice", _sliced(slices, shards))
    sizes: dict[tuple[int, int], int] = {}
    dirty: set[tuple[int, int]] | None = None
    too_large: list[str] = []
    for attempt in range(ATTEMPTS + 1):
        _write_shards(sliced, path, dirty, hot)
        _write_hot(rows, path, {t: h for t, h in hot.items() if not h.done})
        sizes = {(int(a), int(b)): n for a, b, n in _sizes(spark, f"{path}/shards", "shard", "slice")}
        own = {(k, int(m)): n for k, m, n in _sizes(spark, f"{path}/hot", "key", "part")}
        over = sorted(x for x, n in sizes.items() if n > cap_bytes)
        wide = [t for t, h in hot.items() if not h.done and max(own.get((h.key, m), 0) for m in range(h.parts)) > cap_bytes]
        for h in hot.values():
            h.done = True
        if not over and not wide:
            break
        if attempt == ATTEMPTS:
            too_large = [f"shard {a} slice {b}" for a, b in over] + [f"hot {hot[t].key}" for t in wide]
            break
        for t in wide:
            hot[t].parts, hot[t].done = 2 * hot[t].parts, False
        dirty = set(over)
        left = _without(counts.join(F.broadcast(_places(spark, dirty)), ["shard", "slice"]), hot)
        heavy = left.groupBy("shard", "slice").agg(F.max_by(F.struct("token", "n"), F.struct("n", "token")).alias("t")).select("t.token", "t.n").collect()  # one a slice
        for r in heavy:
            promote(r.token, r.n)
    total: dict[str, int] = {}
    for (k, _), n in own.items():
        total[k] = total.get(k, 0) + n
    named = {_shard_name(s, j, slices.get(s, 1)): sizes.get((s, j), 0) for s in range(shards) for j in range(slices.get(s, 1))}
    manifest = Manifest(shards, {t: (h.key, h.parts, total.get(h.key, 0), total.get(h.key, 0) <= cap_bytes) for t, h in hot.items()}, named, {t: h.postings for t, h in hot.items()}, tuple(too_large), {s: n for s, n in slices.items() if n > 1})
    spark.createDataFrame([(manifest.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return manifest


COLUMNS = ("token", "pid", "field", "tf", "doc_len", "df")
PILOT_FILES = 4  # files that are written to measure a posting
FILL, HEAVY = 0.5, 0.25  # part of the cap that a file is planned for; part of the cap from which a token leaves its slice


def _shard_name(shard: int, slice_: int, slices: int) -> str:
    return f"shard_{shard:03d}.parquet" if slices == 1 else f"shard_{shard:03d}_{slice_:05d}.parquet"


def _sliced(slices: Mapping[int, int], shards: int) -> Column:
    """The slice of a row by its shard and hash."""
    n = F.element_at(F.array(*[F.lit(slices.get(s, 1)) for s in range(shards)]), F.col("shard") + 1)
    return _slice(F.col("hash"), shards, n)


def _bytes_each(rows: DataFrame, total: int, cap_bytes: int) -> float:
    """Bytes of a posting in files of about the cap, by writing a few of those that the index would have."""
    if not total:
        return 1.0
    width = rows.limit(1000).agg(F.avg(F.length("token") + F.length("pid") + F.length("field") + 4)).first()[0] or 30.0
    files = max(1, int(total * width * COMPRESSION) // max(1, cap_bytes))
    some = rows if files <= PILOT_FILES else rows.filter(F.pmod(F.xxhash64("hash"), F.lit(files)) < PILOT_FILES)
    spark, where = rows.sparkSession, fresh(rows.sparkSession, "index-pilot")
    _replace(some.withColumn("pilot", F.pmod(F.xxhash64("hash"), F.lit(files)).cast("int")).drop("hash", "shard"), where, (), "pilot")
    forget_at_exit(spark, where)
    n = spark.read.schema("pid string").parquet(where).count()
    return sum(b for _, b in _sizes(spark, where, "pilot")) / n if n else width * COMPRESSION


def _sizes(spark, path: str, *by: str) -> list[tuple]:
    """(values of the folders, bytes): one entry a folder; no file is read."""
    at, p = hadoop_path(spark, path)
    if not at.exists(p):
        return []
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    names = [F.regexp_extract("path", f"/{k}=([^/]+)/", 1).alias(k) for k in by]
    return [tuple(r) for r in files.groupBy(*names).agg(F.sum("length").alias("n")).collect()]


def _places(spark, which: set[tuple[int, int]]) -> DataFrame:
    return local(spark, sorted(which), shard=pa.int32(), slice=pa.int32())


def _without(rows: DataFrame, hot: Mapping[str, _Hot]) -> DataFrame:
    return rows.join(F.broadcast(local(rows.sparkSession, [(t,) for t in hot], token=pa.string())), "token", "left_anti") if hot else rows


def _write_shards(rows: DataFrame, path: str, which: set[tuple[int, int]] | None, hot: Mapping[str, _Hot]) -> None:
    """The given slices, or all (None)."""
    if which is not None:
        if not which:
            return
        rows = rows.join(F.broadcast(_places(rows.sparkSession, which)), ["shard", "slice"])
    _replace(_without(rows, hot).drop("hash"), path + "/shards", [f"shard={a}/slice={b}" for a, b in which or ()], "shard", "slice")


def _write_hot(rows: DataFrame, path: str, which: Mapping[str, _Hot]) -> None:
    if not which:
        return
    names = local(rows.sparkSession, [(t, h.key, h.parts) for t, h in which.items()], token=pa.string(), key=pa.string(), parts=pa.int32())
    mine = rows.drop("shard", "hash").join(F.broadcast(names), "token").withColumn("part", F.pmod(F.xxhash64("pid"), F.col("parts")).cast("int")).drop("parts")  # one row a hot token
    _replace(mine, path + "/hot", [f"key={h.key}" for h in which.values()], "key", "part")


def _replace(rows: DataFrame, path: str, folders: Sequence[str], *by: str) -> None:
    """Rows in place of what the folders held, a sorted file for each."""
    for f in folders:
        at, p = hadoop_path(rows.sparkSession, f"{path}/{f}")
        at.delete(p, True)
    rows.repartition(*by).sortWithinPartitions(*by, "token", "pid", "field").write.mode("append").partitionBy(*by).option("compression", "zstd").parquet(path)


def open_index(spark, path: str) -> tuple[DataFrame, Manifest]:
    """(postings, manifest) of a written index; filters on ``shard``, ``slice`` and ``key`` prune its files."""
    manifest = Manifest.from_json(spark.read.text(f"{path}/manifest").first()[0])
    columns = "token string, pid string, field string, tf int, doc_len int, df long"
    at, p = hadoop_path(spark, f"{path}/shards")
    rows = spark.read.schema(columns + ", shard int, slice int").parquet(f"{path}/shards") if at.exists(p) else spark.createDataFrame([], columns + ", shard int, slice int")
    rows = rows.withColumn("key", F.lit(None).cast("string"))
    if manifest.hot:
        own = spark.read.schema(columns + ", key string, part int").parquet(f"{path}/hot").drop("part").withColumn("shard", F.lit(-1)).withColumn("slice", F.lit(-1))
        rows = rows.unionByName(own)
    return rows, manifest


def hot_topk(stored: DataFrame, stats: DataFrame, hot: DataFrame | None, top: int = HOT_TOP) -> DataFrame:
    """(token, pid, static_score, rank): the best of each hot token, scores to 4 places.

    Without ``hot`` all tokens given are.  One shuffle, by token, serves sums and ranks.
    """
    rows = stored if hot is None else stored.join(hot.select("token"), "token", "left_semi")
    rows = scored(rows, stats).select("token", "pid", "c").repartition("token")
    per = rows.groupBy("token", "pid").agg(F.round(F.sum("c"), 4).alias("static_score"))
    w = Window.partitionBy("token").orderBy(F.desc("static_score"), F.asc("pid"))
    return per.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top).select("token", "pid", "static_score", "rank")


def rank_topk(lists: DataFrame, tokens: Sequence[str], top: int = TOP) -> DataFrame:
    """The same for common tokens only, from their lists (approximate: a list ends at its rank limit)."""
    return rank(lists.filter(F.col("token").isin(list(tokens))).select("token", "pid", F.col("static_score").alias("c")), tokens, top)


@dataclass(frozen=True)
class Plan:
    """How a query is answered: empty, allStopwords, topk or normal."""

    mode: str
    tokens: tuple[str, ...] = ()
    ignored: tuple[str, ...] = ()
    shards: tuple[int, ...] = ()
    files: tuple[str, ...] = ()
    expected_bytes: int | None = None


@dataclass(frozen=True)
class Manifest:
    """``hot``: token to (key, parts, total bytes, fetchable); ``sizes``: bytes of the shards' files; ``slices``: of shards with more files than one."""

    shards: int = SHARDS
    hot: Mapping[str, tuple[str, int, int, bool]] = field(default_factory=dict)
    sizes: Mapping[str, int] | None = None
    postings: Mapping[str, int] = field(default_factory=dict)
    too_large: tuple[str, ...] = ()
    slices: Mapping[int, int] = field(default_factory=dict)

    def place(self, token: str) -> tuple[int, int]:
        """(shard, slice) of a token."""
        h = tx.fnv1a32(token)
        return h % self.shards, h // self.shards % self.slices.get(h % self.shards, 1)

    def to_json(self) -> str:
        hot = {t: {"key": k, "sub_files": n, "postings": self.postings.get(t), "total_bytes": b, "fetchable": f} for t, (k, n, b, f) in sorted(self.hot.items())}
        return json.dumps({"shards": self.shards, "hot": hot, "sizes": self.sizes, "too_large": list(self.too_large), "slices": {str(s): n for s, n in self.slices.items()}}, ensure_ascii=True)

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        x = json.loads(text)
        hot = {t: (h["key"], h["sub_files"], h["total_bytes"], h["fetchable"]) for t, h in x["hot"].items()}
        return cls(x["shards"], hot, x["sizes"], {t: h["postings"] for t, h in x["hot"].items()}, tuple(x["too_large"]), {int(s): n for s, n in x.get("slices", {}).items()})


def plan(query: str, manifest: Manifest) -> Plan:
    """Tokens without stopwords and repeats; common tokens that are too large to read are left out and named."""
    raw = tx.tokenise(query)
    if not raw:
        return Plan("empty")
    kept = [t for t in dict.fromkeys(raw) if t not in STOPWORDS]
    if not kept:
        return Plan("allStopwords")
    common = [t for t in kept if t in manifest.hot and not manifest.hot[t][3]]
    rest = [t for t in kept if t not in common]
    if not rest:
        return Plan("topk", tuple(common), files=("hot_topk.parquet",))
    files: dict[str, int] = {}
    shards: list[int] = []
    for t in rest:
        if t in manifest.hot:
            key, parts, size, _ = manifest.hot[t]
            files |= {f"hot/{key}_p{m}.parquet": size if m == 0 else 0 for m in range(parts)}
        else:
            s, j = manifest.place(t)
            name = _shard_name(s, j, manifest.slices.get(s, 1))
            files[name] = (manifest.sizes or {}).get(name, 0)
        s = tx.fnv1a32(t) % manifest.shards
        if s not in shards:
            shards.append(s)
    return Plan("normal", tuple(rest), tuple(common), tuple(shards), tuple(files), sum(files.values()) if manifest.sizes is not None else None)


def use_index(terms: Sequence[str], enabled: bool = True) -> bool:
    """Identifiers, short queries and a switched-off index take the scan."""
    return enabled and sum(map(len, terms)) >= MIN_QUERY and not any(tx.looks_like_pid(t) for t in terms)


def answer(query: str, stored: DataFrame, stats: DataFrame, manifest: Manifest, lists: DataFrame | None = None, top: int | None = TOP) -> DataFrame:
    """(pid, score) of a query by its plan; shards prune partitions where the postings have them."""
    p = plan(query, manifest)
    if p.mode in ("empty", "allStopwords"):
        return stored.select("pid", F.lit(0.0).alias("score")).limit(0)
    if p.mode == "topk" and lists is not None:
        return rank_topk(lists, p.tokens, top or TOP)
    rows = stored
    if "shard" in stored.columns and p.shards:
        where = F.col("shard").isin(list(p.shards))
        if "slice" in stored.columns and manifest.slices:
            where = F.lit(False)
            for s, j in {manifest.place(t) for t in p.tokens if t not in manifest.hot}:
                where = where | ((F.col("shard") == s) & (F.col("slice") == j))
        keys = [manifest.hot[t][0] for t in p.tokens if t in manifest.hot]
        rows = stored.filter(where | F.col("key").isin(keys)) if keys and "key" in stored.columns else stored.filter(where)
    return rank(scored(rows, stats, p.tokens), p.tokens, top)


def scan_answer(df: DataFrame, terms: Sequence[str], label: str = "label", description: str = "description", place: str | None = "place_name", pid: str = "pid") -> DataFrame:
    """The scan path: rows that match every term, scored by weighted columns; identifiers match ids, too."""
    cols = [(F.col(label), 3.0), (F.col(description), 1.0)]
    if place:
        kind = dict(df.dtypes)[place]
        cols.append((tx.place_text(F.col(place)) if kind.startswith("array") else F.col(place), 2.0))
    where = tx.text_where(terms, [c for c, _ in cols])
    for t in terms:
        if tx.looks_like_pid(t):
            where = where | tx.pid_where(t, F.col(pid))
    return df.filter(where).withColumn("relevance_score", tx.text_score(terms, cols))


def build_stats(docs: DataFrame, df: DataFrame) -> DataFrame:
    """(documents, samples, tokens, postings) of an index, from its documents and (token, df)."""
    per = docs.groupBy("pid").agg(F.count(F.lit(1)).alias("n"))
    d = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("documents"), F.count("pid").alias("samples"))
    return d.crossJoin(df.agg(F.count("token").alias("tokens"), F.coalesce(F.sum("df"), F.lit(0)).alias("postings")))
