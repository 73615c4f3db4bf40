"""WARC: a writer and a sequential reader of one gzip member per record.

The reader takes files of any size.  It reads a file in chunks, feeds them to an
incremental inflater, starts a new inflater where a gzip member ends, and frames
each record by its ``Content-Length``; it holds one record at a time.  The SHA-1
of the block and of the HTTP payload are verified against the record's digests.
Files that are not compressed are read the same way.

Files are opened where the task runs, through the file system of their URI, and
the unit of parallel work is a file.  The writer puts about ``FILE_RECORDS``
records in a file; a file is written under a temporary name and renamed, so a
task that is run again leaves one whole file.

Defined results: a null body is written as an empty one and flagged, and reads
back as null; a null URI has no target header and reads back as null; a null id
likewise; a URI with line breaks or runs of white space has them as one space in
its header and is also kept as it was in a header of its own; page ids are integers
(or strings of digits), others raise; repeated rows become repeated records; an empty table gives files
without pages; a record that is cut short, or whose framing is broken, raises, or with
``tolerant`` ends its file with a record of type ``broken`` that names the fault; a
wrong digest is reported in ``block_ok`` and ``payload_ok`` (null where the record
names no digest that can be checked).
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

CHUNK = 1 << 20
FILE_RECORDS = 4000
BATCH_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"
SCHEMA = "file string, record int, warc_type string, record_id string, uri string, page_id long, content_type string, length long, block_ok boolean, payload_ok boolean, payload binary"


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record, framed and digested, not compressed."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers], f"WARC-Block-Digest: {digest(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, html: str | None) -> bytes:
    """The response record of a page."""
    body = (html or "").encode()
    head = [("WARC-Date", DATE), ("WARC-Record-ID", f"<urn:page:{'none' if page_id is None else page_id}>"), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest(body))]
    if url is not None:
        flat = " ".join(url.split())
        head.append(("WARC-Target-URI", flat))
        if flat != url:
            head.append(("X-URI-Base64", base64.b64encode(url.encode()).decode()))
    if html is None:
        head.append(("X-Null-Payload", "1"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    return record("response", head, http + body)


def member(data: bytes) -> bytes:
    """One gzip member; the header carries no time, so equal records give equal bytes."""
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def write(pages: DataFrame, path: str, file_records: int = FILE_RECORDS, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the pages as WARC files below ``path``; (file, records, bytes) of each."""
    where, root = fs.FileSystem.from_uri(path)
    where.create_dir(root, recursive=True)
    narrow = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ctx = TaskContext.get()
        where, root = fs.FileSystem.from_uri(path)
        where.create_dir(root, recursive=True)
        serial, out, n, size, name, temp = 0, None, 0, 0, "", ""

        def close() -> tuple[str, int, int]:
            out.close()
            if where.get_file_info(name).type != fs.FileType.NotFound:
                where.delete_file(name)  # an earlier attempt of this task got this far
            where.move(temp, name)
            return name, n, size

        done = []
        for batch in batches:
            for i, u, h in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                if out is None:
                    name = f"{root}/part-{ctx.partitionId():06d}-{serial:06d}.warc.gz"
                    temp = f"{name}.{ctx.taskAttemptId()}.tmp"
                    out, n = where.open_output_stream(temp, compression=None), 0
                    info = member(record("warcinfo", [("WARC-Date", DATE), ("WARC-Record-ID", f"<urn:file:{ctx.partitionId()}-{serial}>"), ("Content-Type", "application/warc-fields")], b"software: corelode\r\n"))
                    out.write(info)
                    size, serial = len(info), serial + 1
                m = member(page_record(i, u, h))
                out.write(m)
                n, size = n + 1, size + len(m)
                if n >= file_records:
                    done.append(close())
                    out = None
        if out is not None:
            done.append(close())
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["file", "records", "bytes"])

    return narrow.mapInArrow(run, "file string, records long, bytes long")


class _Stream:
    """Bytes of a file, inflated as they are asked for."""

    def __init__(self, raw):
        self.raw, self.buffer, self.at, self.ended = raw, bytearray(), 0, False
        self.pending = raw.read(CHUNK)
        self.zipped = self.pending[:2] == b"\x1f\x8b"
        self.inflater = zlib.decompressobj(31) if self.zipped else None
        self.started = False

    def _more(self) -> bool:
        """Add to the buffer; False at the end of the file."""
        if not self.pending:
            self.pending = self.raw.read(CHUNK)
            if not self.pending:
                if self.zipped and self.started:
                    raise ValueError("the file ends inside a gzip member")
                return False
        if not self.zipped:
            self.buffer += self.pending
            self.pending = b""
            return True
        self.started = True
        self.buffer += self.inflater.decompress(self.pending, CHUNK)
        if self.inflater.eof:
            self.pending = self.inflater.unused_data
            self.inflater, self.started = zlib.decompressobj(31), False
        else:
            self.pending = self.inflater.unconsumed_tail
        return True

    def _trim(self) -> None:
        if self.at > CHUNK:
            del self.buffer[: self.at]
            self.at = 0

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to ``mark``, which is passed; None at a clean end of the file."""
        look = self.at
        while (k := self.buffer.find(mark, look)) < 0:
            look = max(self.at, len(self.buffer) - len(mark) + 1)
            if not self._more():
                if self.buffer[self.at :].strip():
                    raise ValueError("the file ends inside a record header")
                return None
        out = bytes(self.buffer[self.at : k])
        self.at = k + len(mark)
        self._trim()
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) - self.at < n:
            if not self._more():
                raise ValueError("the file ends inside a record")
        out = bytes(self.buffer[self.at : self.at + n])
        self.at += n
        self._trim()
        return out


@dataclass
class Record:
    kind: str
    headers: dict[str, str]
    block: bytes


def records(raw) -> Iterator[Record]:
    """The records of an open file, in order."""
    stream = _Stream(raw)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        first, *lines = head.decode("utf-8", "replace").split("\r\n")
        if not first.strip().startswith("WARC/"):
            raise ValueError(f"not a record: {first[:40]!r}")
        headers: dict[str, str] = {}
        last = ""
        for line in lines:
            if line[:1] in " \t" and last:
                headers[last] += " " + line.strip()
                continue
            key, _, value = line.partition(":")
            last = key.strip().lower()
            headers[last] = value.strip()
        block = stream.take(int(headers["content-length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield Record(headers.get("warc-type", ""), headers, block)


def verify(expected: str | None, data: bytes) -> bool | None:
    """Whether the digest matches; None where there is none of a known kind."""
    if not expected:
        return None
    name, _, value = expected.partition(":")
    if name.lower() not in ("sha1", "sha256", "md5"):
        return None
    got = hashlib.new(name.lower(), data).digest()
    return value.strip().upper() == base64.b32encode(got).decode() or value.strip().lower() == got.hex()


def payload_of(r: Record) -> bytes:
    """The HTTP body of a request or response, else the whole block."""
    if r.headers.get("content-type", "").startswith("application/http"):
        return r.block.partition(b"\r\n\r\n")[2]
    return r.block


def uri_of(headers: dict[str, str]) -> str | None:
    if "x-uri-base64" in headers:
        return base64.b64decode(headers["x-uri-base64"]).decode()
    return headers.get("warc-target-uri")


def _tolerant(raw, tolerant: bool) -> Iterator[Record]:
    try:
        yield from records(raw)
    except (ValueError, KeyError, zlib.error) as e:
        if not tolerant:
            raise
        yield Record("broken", {"warc-record-id": f"{type(e).__name__}: {e}"}, b"")


def read_files(files: DataFrame, tolerant: bool = False) -> DataFrame:
    """All records of the files named by the column ``file``; one task a file at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in SCHEMA.split(", ")]
        types = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]
        rows: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal size
            out = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)
            rows.clear()
            size = 0
            return out

        for batch in batches:
            for file in batch.column("file").to_pylist():
                where, path = fs.FileSystem.from_uri(file)
                with where.open_input_stream(path, compression=None) as raw:
                    for k, r in enumerate(_tolerant(raw, tolerant)):
                        h = r.headers
                        body = payload_of(r)
                        ident = h.get("warc-record-id", "").strip("<>")
                        page = ident[9:] if ident.startswith("urn:page:") else ""
                        null = "x-null-payload" in h
                        rows.append((file, k, r.kind, ident, uri_of(h), int(page) if page.lstrip("-").isdigit() else None, h.get("content-type"), len(r.block), verify(h.get("warc-block-digest"), r.block), verify(h.get("warc-payload-digest"), body), None if null else body))
                        size += len(body) + 200
                        if size >= BATCH_BYTES:
                            yield flush()
        if rows:
            yield flush()

    return files.select("file").mapInArrow(run, SCHEMA)


def read(spark: SparkSession, path: str, tolerant: bool = False) -> DataFrame:
    """All records of the WARC files below ``path``.

    Spark lists the files (their contents are not loaded by the listing) and packs
    them into tasks by size.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{warc,warc.gz}").load(path)
    files = files.select(F.col("path").alias("file"))
    n = max(1, files.count())
    return read_files(files.repartition(n), tolerant)


def round_trip(spark: SparkSession, pages: DataFrame, **columns) -> DataFrame:
    """The pages written as WARC files in the shared folder, read and verified."""
    path = shared.fresh(spark, "warc")
    write(pages, path, **columns).count()
    got = read(spark, path).filter("warc_type = 'response'")
    return got.select("page_id", F.col("uri").alias("url"), F.decode("payload", "UTF-8").alias("html"), "block_ok", "payload_ok", F.octet_length("payload").cast("long").alias("n_bytes"))
