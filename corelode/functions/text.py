"""Text functions: tokens, hashes, patterns and identifiers, as Column expressions.

Everything is built in Catalyst expressions except the functions of tokens, which need
Unicode normalisation that Spark has no function for, and the hash of a token; they
work on Arrow arrays, long ones in pieces.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_TOKEN = 64
FNV_OFFSET, FNV_PRIME = 2166136261, 16777619


def tokenise(text: str | None) -> list[str]:
    """What a text is searched by: compatibility-folded, lower case, without marks.

    Anything that is neither letter nor digit separates tokens; a token has 1 to
    64 code points; nothing is stemmed and nothing is stopped.
    """
    if not text:
        return []
    folded = unicodedata.normalize("NFD", unicodedata.normalize("NFKC", text).lower())
    folded = unicodedata.normalize("NFC", "".join(c for c in folded if unicodedata.category(c) != "Mn"))
    spaced = "".join(c if c.isalnum() else " " for c in folded)
    return [t for t in spaced.split() if len(t) <= MAX_TOKEN]


_MARKED = "[\u03a3\u0130]"  # lower case of these depends on what is around them, or is two characters


# ASCII bytes: letters in lower case and digits stay, all else separates
_ASCII = np.array([b if chr(b).isalnum() else 32 for b in bytes(range(128)).lower()] + [32] * 128, dtype=np.uint8)


def _spaced(texts: pa.Array) -> pa.Array:
    """Folded texts in which anything but letters and digits is a blank."""
    plain = pc.string_is_ascii(texts)
    if pc.all(plain).as_py():
        return _spaced_ascii(texts)
    odd = pc.invert(plain)
    return pc.replace_with_mask(_spaced_ascii(texts), odd, _spaced_any(texts.filter(odd)))


def _spaced_ascii(texts: pa.Array) -> pa.Array:
    """The same for texts without other characters (others get blanks in their place)."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[: offsets[-1] if len(offsets) else 0]
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(_ASCII[data]))


def _spaced_any(texts: pa.Array) -> pa.Array:
    texts = pc.utf8_normalize(texts, form="NFKC")
    marked = pc.match_substring_regex(texts, _MARKED)
    if pc.any(marked).as_py():
        texts = pc.if_else(marked, pa.array([t.lower() if m else None for t, m in zip(texts.to_pylist(), marked.to_pylist())], pa.string()), texts)
    folded = pc.utf8_normalize(pc.utf8_lower(texts), form="NFD")
    folded = pc.utf8_normalize(pc.replace_substring_regex(folded, r"\p{Mn}+", ""), form="NFC")
    return pc.replace_substring_regex(folded, r"[^\p{L}\p{N}]+", " ")


def token_array(texts: pa.Array) -> pa.Array:
    """:func:`tokenise` of a whole Arrow array at once."""
    words = pc.split_pattern(_spaced(pc.fill_null(texts.cast(pa.string()), "")), " ")
    values, ends = words.flatten(), words.value_lengths().to_numpy().cumsum()
    size = pc.utf8_length(values).to_numpy()
    keep = (size > 0) & (size <= MAX_TOKEN)
    before = np.concatenate([[0], np.cumsum(keep)])
    offsets = before[np.concatenate([[0], ends])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values.filter(pa.array(keep)))


PIECE_BYTES = 4 << 20
BATCH = 2_000  # rows handed to Python at once


def small_batches(spark: SparkSession) -> None:
    """Long texts go to Python a few at once: memory of its workers counts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH:
        spark.conf.set(key, str(BATCH))


def _in_pieces(run, texts: pa.Array) -> pa.Array:
    """``run`` over pieces of an array of about the same bytes, so that memory does not follow the length of a batch."""
    texts = texts.cast(pa.string())
    n = max(1, min(len(texts), -(-texts.nbytes // PIECE_BYTES)))
    step = max(1, -(-len(texts) // n))
    parts = [run(texts.slice(k, step)) for k in range(0, len(texts), step)]
    return pa.concat_arrays(parts) if parts else run(texts)


def token_counts_array(texts: pa.Array) -> pa.Array:
    """For each text its different tokens with their numbers and hashes, in order of the tokens' first places."""
    words = token_array(texts)
    code = words.flatten().dictionary_encode()
    names, index = code.dictionary, code.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(words)), words.value_lengths().to_numpy())
    key, n = np.unique(row * max(1, len(names)) + index, return_counts=True)
    offsets = np.searchsorted(key, np.arange(len(words) + 1) * max(1, len(names))).astype(np.int32)
    place = pa.array(key % max(1, len(names)))
    pairs = pa.StructArray.from_arrays([names.take(place), pa.array(n.astype(np.int64)), fnv1a32_array(names).take(place)], ["token", "n", "hash"])
    return pa.ListArray.from_arrays(pa.array(offsets), pairs)


def token_documents_array(texts: pa.Array) -> pa.Array:
    """The different tokens of all texts, each with the number of texts that hold it."""
    return pc.value_counts(token_counts_array(texts).flatten().field("token"))


def tokens(col: Column) -> Column:
    """``array<string>`` of search tokens, any script (Arrow function)."""

    def run(texts: pa.Array) -> pa.Array:
        return _in_pieces(token_array, texts)

    return F.arrow_udf(run, "array<string>")(col)


def token_number(col: Column) -> Column:
    """How many search tokens a text has, repeats included (Arrow function)."""

    def run(texts: pa.Array) -> pa.Array:
        return _in_pieces(lambda t: token_array(t).value_lengths().cast(pa.int64()), texts)

    return F.arrow_udf(run, "bigint")(col)


def token_counts(col: Column) -> Column:
    """``array<struct<token, n, hash>>``: how often each search token occurs, and its hash (Arrow function)."""

    def run(texts: pa.Array) -> pa.Array:
        return _in_pieces(token_counts_array, texts)

    return F.arrow_udf(run, "array<struct<token:string,n:bigint,hash:bigint>>")(col)


def token_documents(df: DataFrame, text: str) -> DataFrame:
    """(token, n): in how many rows a token occurs, counted within each task's pieces; sum them by token."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).cast(pa.string())
            step = max(1, len(texts) * PIECE_BYTES // max(1, texts.nbytes))
            for k in range(0, len(texts), step):
                got = token_documents_array(texts.slice(k, step))
                yield pa.RecordBatch.from_arrays([got.field("values"), got.field("counts")], ["token", "n"])

    return df.select(text).mapInArrow(run, "token string, n bigint")


def fnv1a32(word: str) -> int:
    h = FNV_OFFSET
    for b in word.encode():
        h = ((h ^ b) * FNV_PRIME) & 0xFFFFFFFF
    return h


def fnv1a32_array(words: pa.Array) -> pa.Array:
    """The same of a whole Arrow array, byte place by byte place; null counts as empty."""
    words = pc.fill_null(words.cast(pa.string()), "")
    out = np.full(len(words), FNV_OFFSET, dtype=np.uint32)
    if len(words):
        offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)
        start, size = offsets[:-1], np.diff(offsets)
        left, at = np.flatnonzero(size), 0
        while len(left):
            out[left] = (out[left] ^ data[start[left] + at]) * np.uint32(FNV_PRIME)
            at += 1
            left = left[size[left] > at]
    return pa.array(out.astype(np.int64))


def fnv1a32_col(col: Column) -> Column:
    """32-bit FNV-1a of the UTF-8 bytes as a long (Arrow function)."""

    def run(words: pa.Array) -> pa.Array:
        return fnv1a32_array(words)

    return F.arrow_udf(run, "bigint")(col)


def shard_of(col: Column, shards: int) -> Column:
    return F.pmod(fnv1a32_col(col), F.lit(shards)).cast("int")


def escape_like(term: str) -> str:
    """A term whose wildcards are literal in a LIKE pattern with the default escape."""
    return re.sub(r"([\\%_])", r"\\\1", term)


def contains_ci(col: Column, term: str) -> Column:
    return col.ilike(f"%{escape_like(term)}%")


def search_terms(query: str | None) -> list[str]:
    return (query or "").split()


def text_where(terms: Sequence[str], cols: Sequence[Column]) -> Column:
    """Every term occurs in at least one of the columns; no terms accept all rows."""
    out = F.lit(True)
    for term in terms:
        one = F.lit(False)
        for c in cols:
            one = one | F.coalesce(contains_ci(c, term), F.lit(False))
        out = out & one
    return out


def text_score(terms: Sequence[str], weighted: Iterable[tuple[Column, float]]) -> Column:
    """Sum over terms and columns of the weight of each column that holds the term."""
    weighted = list(weighted)
    out = F.lit(0.0)
    for term in terms:
        for c, w in weighted:
            out = out + F.when(contains_ci(c, term), F.lit(float(w))).otherwise(F.lit(0.0))
    return out


# identifiers:

_RESOLVERS = ("doi.org", "hdl.handle.net", "n2t.net", "arks.org")
_RESOLVER = re.compile("^https?://(?:" + "|".join(map(re.escape, _RESOLVERS)) + ")/")


def canonical_pid(term: str) -> str:
    """One spelling for an identifier: lower case, no resolver, no slash after ``ark:``."""
    t = _RESOLVER.sub("", term.strip().lower(), count=1)
    return "ark:" + t[5:] if t.startswith("ark:/") else t


def looks_like_pid(term: str) -> bool:
    """Whether a search term carries a scheme, a resolver or a bare DOI."""
    t = term.strip().lower()
    return t.startswith(("pid:", "ark:", "igsn:", "doi:", "10.")) or bool(_RESOLVER.match(t))


def local_part(pid: str) -> str:
    """What follows the last slash."""
    return pid.rsplit("/", 1)[-1]


def pid_where(term: str, col: Column) -> Column:
    """``pid:x`` looks for x anywhere; else equality of canonical forms, or the local part anywhere.

    Slashes are collapsed before case is folded, so a stored ``ARK:/x`` stays apart.
    """
    if term.strip().lower().startswith("pid:"):
        return contains_ci(col, term.strip()[4:])
    c = canonical_pid(term)
    stored = F.lower(F.replace(col, F.lit("ark:/"), F.lit("ark:")))
    return (stored == F.lit(c)) | contains_ci(col, local_part(c))


# labels:


def uri_tail(col: Column) -> Column:
    """What follows the last slash of a URI, without query or fragment marks at its end."""
    return F.regexp_extract(F.regexp_replace(col, r"[?#/]+$", ""), r"([^/#]+)$", 1)


def label_or_tail(label: Column, uri: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(label), F.lit("")), uri_tail(uri))


def not_blank(col: Column) -> Column:
    """Not null and more than blanks."""
    return F.trim(col.cast("string")) != ""


def place_text(places: Column) -> Column:
    """Place names for display, outermost first as stored, blanks left out."""
    return F.concat_ws(" › ", F.filter(places, lambda p: p.isNotNull() & (F.trim(p) != "")))


def list_text(items: Column) -> Column:
    """A list as a string for storage: JSON, one spelling in every engine."""
    return F.to_json(items)


# CSV:


def csv_guard(col: Column) -> Column:
    """A field that a spreadsheet could take for a formula gets a leading apostrophe, unless it is a number."""
    s = col.cast("string")
    risky = s.rlike(r"^[=+\-@]") & ~s.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$")
    return F.when(risky, F.concat(F.lit("'"), s)).otherwise(s)


def csv_field(col: Column) -> Column:
    """A guarded field, quoted where it holds a quote, a comma or a line break (a bare CR too)."""
    s = F.coalesce(csv_guard(col), F.lit(""))
    return F.when(s.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(s)


def norm_uri(col: Column) -> Column:
    """A concept URI without its version segment, trailing slash or case differences."""
    return F.lower(F.regexp_replace(F.regexp_replace(col, r"/\d+(\.\d+)*(/|$)", "/"), r"/+$", ""))
