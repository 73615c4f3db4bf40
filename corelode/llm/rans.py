"""Token-ID / binary output by a static range asymmetric numeral system (rANS).

Documents are tokenised once with a public byte-level BPE vocabulary.  One
frequency table, counted by Spark over all tokens and scaled to ``1 << BITS``,
is shared by every block.  A block is a run of documents coded on its own:

    block_id | doc_ids | lengths | n_tokens | payload | checkpoints | crc32 | token_crc32

``payload`` is a stream of 32-bit words written by ``LANES`` interleaved 64-bit
coders (token i belongs to lane i % LANES).  ``checkpoints`` holds the lane
states and the stream position at every ``STRIDE``-th step, so that parts of a
block decode in parallel; ``crc32`` covers ids, lengths, payload and checkpoints,
and ``token_crc32`` the tokens themselves.

The frequency table is a row of the output, with the block id ``HEADER``: one
32-bit number for each id of the vocabulary in ``payload``, their count in
``n_tokens``.  The output decodes by itself (:func:`read`).

Tokens are written once between the two passes (16-bit ids where the vocabulary
allows), with the partial counts of each task beside them, so the text is
tokenised once.  The vocabulary file is read by the driver and sent to the tasks.

Defined results: null and empty texts are documents of no tokens and stay in
their block; a null ``doc_id`` is kept as null; repeated rows are coded as often
as they occur; an empty table gives no rows.  Special tokens in a text are
ordinary text.  Any token id below the size of the vocabulary can be coded, seen
or not.
"""

from __future__ import annotations

import base64
import importlib.util
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import scan, shared

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BITS = 20
LANES = 1024
STRIDE = 512
BLOCK_TOKENS = 1 << 20
BATCH_ROWS = 500
HEADER = -1
_LOW = np.uint64(1 << 31)
_encoders: dict[str, object] = {}


def encoder(path: str, data: bytes | None = None):
    """The tokenizer of a vocabulary file of ranks, kept per process; ``data`` are its bytes where the file is not at hand."""
    if path not in _encoders:
        import tiktoken

        if data is None:
            with open(path, "rb") as f:
                data = f.read()
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}
        _encoders[path] = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def _sent(docs: DataFrame, vocabulary: str):
    """The vocabulary file, for the tasks."""
    with open(vocabulary, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def counted(docs: DataFrame, name: str, vocabulary: str = VOCABULARY, text: str = "text") -> DataFrame:
    """``docs`` with the number of tokens of each text; nulls have none."""
    scan.small_batches(docs.sparkSession)
    data, columns = _sent(docs, vocabulary), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, data.value)
        for batch in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in batch.column(text).cast(pa.string()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], [*columns, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def tokenise(docs: DataFrame, vocabulary: str = VOCABULARY, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, ids, kind, token, n): token ids per document, and partial counts per task."""
    scan.small_batches(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = dict(narrow.dtypes)["doc_id"]
    data = _sent(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, data.value)
        counts = np.zeros(enc.n_vocab, dtype=np.int64)
        width = _width(enc.n_vocab)
        id_type = None
        names = ["doc_id", "ids", "kind", "token", "n"]
        for batch in batches:
            id_type = batch.column("doc_id").type
            for lo in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(lo, BATCH_ROWS)
                ids = [np.array(enc.encode_ordinary(t or ""), dtype=width) for t in part.column("text").to_pylist()]
                if ids:
                    counts += np.bincount(np.concatenate(ids), minlength=len(counts))
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([0] * n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())], names)
        seen = np.flatnonzero(counts)
        if len(seen):
            k = len(seen)
            yield pa.RecordBatch.from_arrays([pa.nulls(k, id_type), pa.nulls(k, pa.binary()), pa.array([1] * k, pa.int32()), pa.array(seen, pa.int32()), pa.array(counts[seen], pa.int64())], names)

    return narrow.mapInArrow(run, f"doc_id {kind}, ids binary, kind int, token int, n long")


def _width(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def scale(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Frequencies of sum ``1 << bits``, at least 1 each, proportional to ``counts``."""
    target = 1 << bits
    size = len(counts)
    total = max(1, int(counts.sum()))
    f = 1 + np.floor(counts.astype(np.float64) * (target - size) / total).astype(np.int64)
    order = np.argsort(-counts, kind="stable")
    rest = target - int(f.sum())
    f[order[: rest % size]] += 1
    f += rest // size
    return f


class Table:
    """Frequencies, cumulative frequencies and the inverse of a token alphabet."""

    def __init__(self, freq: np.ndarray, bits: int = BITS):
        self.bits = bits
        self.freq = freq.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.limit = self.freq << np.uint64(63 - bits)
        self._slot: np.ndarray | None = None

    @property
    def slot(self) -> np.ndarray:
        if self._slot is None:
            self._slot = np.repeat(np.arange(len(self.freq)), self.freq.astype(np.int64))
        return self._slot


def encode(tokens: np.ndarray, table: Table, lanes: int = LANES, stride: int = STRIDE) -> tuple[bytes, bytes]:
    """(payload, checkpoints) of one block.

    Steps are coded last to first; the stream is then reversed, so that decoding
    runs forward from the states of the first checkpoint.
    """
    n = len(tokens)
    steps = -(-n // lanes)
    state = np.full(lanes, _LOW, dtype=np.uint64)
    out: list[np.ndarray] = []
    marks: list[tuple[int, int, np.ndarray]] = []
    written = 0
    bits, word = np.uint64(table.bits), np.uint64(32)
    for step in range(steps - 1, -1, -1):
        t = tokens[step * lanes : (step + 1) * lanes]
        x = state[: len(t)]
        f = table.freq[t]
        full = np.flatnonzero(x >= table.limit[t])
        if len(full):
            over = x[full]
            # reversed so that the decoder meets the lanes in ascending order
            out.append(over[::-1].astype(np.uint32))
            x[full] = over >> word
            written += len(full)
        q, r = np.divmod(x, f)
        x[:] = (q << bits) + r + table.cum[t]
        if step % stride == 0:
            marks.append((step, written, state.copy()))
    stream = np.concatenate(out)[::-1] if out else np.zeros(0, np.uint32)
    head = b"".join(np.array([s, written - w], dtype="<u8").tobytes() + x.astype("<u8").tobytes() for s, w, x in reversed(marks))
    return stream.astype("<u4").tobytes(), head


def decode(payload: bytes, checkpoints: bytes, n: int, table: Table, lanes: int = LANES, stride: int = STRIDE, first: int = 0, last: int | None = None) -> np.ndarray:
    """Tokens of the checkpoints ``first`` up to, not including, ``last`` (all by default)."""
    stream = np.frombuffer(payload, dtype="<u4").astype(np.uint64)
    size = 16 + 8 * lanes
    count = len(checkpoints) // size
    last = count if last is None else min(last, count)
    mask = np.uint64((1 << table.bits) - 1)
    bits, word = np.uint64(table.bits), np.uint64(32)
    out = []
    if first < last:
        mark = checkpoints[first * size : (first + 1) * size]
        step, at = (int(v) for v in np.frombuffer(mark[:16], dtype="<u8"))
        state = np.frombuffer(mark[16:], dtype="<u8").astype(np.uint64)
        end = min(-(-n // lanes), last * stride)
        while step < end:
            x = state[: min(lanes, n - step * lanes)]
            low = x & mask
            t = table.slot[low]
            out.append(t.astype(np.uint32))
            x[:] = table.freq[t] * (x >> bits) + low - table.cum[t]
            need = np.flatnonzero(x < _LOW)
            if len(need):
                x[need] = (x[need] << word) | stream[at : at + len(need)]
                at += len(need)
            step += 1
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def checksum(*parts: bytes) -> int:
    c = 0
    for p in parts:
        c = zlib.crc32(p, c)
    return c


def _named(ids: list, lengths: list[int]) -> bytes:
    """The documents of a block, for its checksum."""
    return json.dumps([[None if d is None else str(d) for d in ids], [int(n) for n in lengths]]).encode()


def _tokens_sum(tokens: np.ndarray) -> int:
    return zlib.crc32(tokens.astype("<u4").tobytes())


def frequencies(tokenised: DataFrame, size: int) -> np.ndarray:
    """The scaled frequency table over all tokens: one entry per id of the vocabulary."""
    counts = np.zeros(size, dtype=np.int64)
    for token, n in tokenised.filter("kind = 1").groupBy("token").agg(F.sum("n")).collect():  # at most one row per id
        counts[token] = n
    return scale(counts)


def blocks(docs: DataFrame, vocabulary: str = VOCABULARY, text: str = "text", doc_id: str = "doc_id", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The coded blocks, and the row of the frequency table they share."""
    spark = docs.sparkSession
    tokenised = shared.written(tokenise(docs, vocabulary, text, doc_id), "rans-tokens")
    size = encoder(vocabulary).n_vocab
    width = _width(size)
    freq = frequencies(tokenised, size)
    sent = spark.sparkContext.broadcast(freq)  # bounded by the vocabulary
    kind = dict(tokenised.dtypes)["doc_id"]
    names = ["block_id", "doc_ids", "lengths", "n_tokens", "payload", "checkpoints", "crc32", "token_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table, part, serial = Table(sent.value), TaskContext.get().partitionId(), 0
        ids: list = []
        toks: list[np.ndarray] = []
        held = 0
        id_type = pa.int64()

        def flush() -> pa.RecordBatch:
            nonlocal serial, held
            tokens = np.concatenate(toks) if toks else np.zeros(0, np.uint32)
            payload, marks = encode(tokens, table)
            lengths = [len(t) for t in toks]
            row = [pa.array([(part << 32) + serial], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([lengths], pa.list_(pa.int32())), pa.array([len(tokens)], pa.int64()), pa.array([payload], pa.binary()), pa.array([marks], pa.binary()), pa.array([checksum(payload, marks, _named(ids, lengths))], pa.int64()), pa.array([_tokens_sum(tokens)], pa.int64())]
            serial += 1
            held = 0
            ids.clear(), toks.clear()
            return pa.RecordBatch.from_arrays(row, names)

        for batch in batches:
            id_type = batch.column("doc_id").type
            for d, b in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                ids.append(d)
                toks.append(np.frombuffer(b, dtype=width))
                held += len(toks[-1])
                if held >= block_tokens:
                    yield flush()
        if ids:
            yield flush()

    rows = tokenised.filter("kind = 0").select("doc_id", "ids")
    coded = rows.mapInArrow(run, f"block_id long, doc_ids array<{kind}>, lengths array<int>, n_tokens long, payload binary, checkpoints binary, crc32 long, token_crc32 long")
    if rows.isEmpty():
        return coded
    table = freq.astype("<u4").tobytes()
    header = (HEADER, [], [], size, bytearray(table), bytearray(), checksum(table), _tokens_sum(freq))
    return coded.unionByName(spark.createDataFrame([header], coded.schema).coalesce(1))


def read(coded: DataFrame) -> DataFrame:
    """(doc_id, position, ids): the documents of coded blocks; a broken checksum raises."""
    kind = coded.schema["doc_ids"].dataType.elementType.simpleString()
    head = coded.filter(F.col("block_id") == HEADER).first()
    freq = np.zeros(0, "<u4") if head is None else np.frombuffer(bytes(head["payload"]), "<u4")
    if head is not None and checksum(freq.tobytes()) != head["crc32"]:
        raise ValueError("the frequency table does not match its checksum")
    sent = coded.sparkSession.sparkContext.broadcast(freq)  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(sent.value)
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda c: batch.column(c)[r].as_py()  # noqa: B023, E731
                payload, marks, n = get("payload"), get("checkpoints"), get("n_tokens")
                if checksum(payload, marks, _named(get("doc_ids"), get("lengths"))) != get("crc32"):
                    raise ValueError(f"block {get('block_id')}: the checksum does not match")
                tokens = decode(payload, marks, n, table)
                if _tokens_sum(tokens) != get("token_crc32"):
                    raise ValueError(f"block {get('block_id')}: the tokens do not match")
                parts = np.split(tokens.astype(np.int32), np.cumsum(get("lengths"))[:-1])
                yield pa.RecordBatch.from_arrays([batch.column("doc_ids").slice(r, 1).flatten(), pa.array(np.arange(len(parts)), pa.int64()), pa.array(parts, pa.list_(pa.int32()))], ["doc_id", "position", "ids"])

    data = coded.filter(F.col("block_id") != HEADER).select("block_id", "doc_ids", "lengths", "n_tokens", "payload", "checkpoints", "crc32", "token_crc32")
    return data.mapInArrow(run, f"doc_id {kind}, position long, ids array<int>")


def installed() -> bool:
    return importlib.util.find_spec("tiktoken") is not None
