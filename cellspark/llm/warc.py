"""WARC archives: one gzip member for each record, and a sequential reader.

Writers run in tasks: every task writes archives of bounded size below a shared folder and returns one row
for each, which is stored before anything is read. An archive has a name of its own, so what a lost task
left behind is never read. Payloads that occur again are written once, as the response of the smallest page
id; the others become revisit records that refer to it. The reader inflates one member at a time in small
pieces, frames records by their content length and checks block and payload digests; a payload is held
only if it is asked for.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.functions.lineage import store, table_path

LEAST_SHARED = 100
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 16
DATE = "1970-01-01T00:00:00Z"
# Fixed value: the profile of revisits with the same payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def _plain(text: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _record_id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid4() if page is None else uuid.uuid5(uuid.NAMESPACE_OID, str(page))}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: str = DATE) -> bytes:
    """One record as a gzip member; a revisit of ``first`` if that is given. Its HTTP head keeps the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if page is not None:
        lines.append(f"X-Page-ID: {page}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {_plain(url)}")
    if first is not None:
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {_record_id(first)}", f"X-Refers-To-Page-ID: {first}"]
    lines.append(f"Content-Length: {len(block)}")
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + END + block + END) + pack.flush()


class Member:
    """One gzip member of a stream, inflated piece by piece."""

    def __init__(self, stream: BinaryIO, rest: bytes):
        self.stream, self.rest = stream, rest  # rest: compressed bytes not used yet
        self.inflate = zlib.decompressobj(31)
        self.ready = b""

    def _more(self) -> bool:
        """Inflate at least one byte more; False at the member's end."""
        while not self.inflate.eof:
            if not self.rest:
                self.rest = self.stream.read(CHUNK)
                if not self.rest:
                    raise ValueError("the archive ends inside a record")
            out = self.inflate.decompress(self.rest, CHUNK)
            self.rest = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if out:
                self.ready += out
                return True
        return False

    def head(self) -> list[str]:
        """Lines up to an empty one."""
        while (at := self.ready.find(END)) < 0:
            if not self._more():
                raise ValueError("a record ends inside its head")
        lines, self.ready = self.ready[:at].decode().split("\r\n"), self.ready[at + len(END) :]
        return lines

    def pieces(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, in pieces."""
        while size:
            if not self.ready and not self._more():
                raise ValueError("a record is shorter than its content length")
            piece, self.ready = self.ready[:size], self.ready[size:]
            size -= len(piece)
            yield piece

    def close(self) -> bytes:
        """Check that nothing but the record's end is left; what follows the member."""
        while self._more():
            pass
        if self.ready != END:
            raise ValueError("a record is longer than its content length")
        return self.rest


def fields(lines: list[str]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def read(stream: BinaryIO, payloads: bool = False) -> Iterator[tuple[dict[str, str], int, str, bytes | None]]:
    """(WARC fields, payload length, payload digest, payload) of every record, in order.

    The length and digest of a response are counted from what was read and compared with what its head
    says; those of a revisit are its head's. Damage of any kind raises ValueError or zlib.error.
    """
    rest = stream.read(CHUNK)
    while rest:
        member = Member(stream, rest)
        head = member.head()
        if not head[0].startswith("WARC/"):
            raise ValueError("no WARC record")
        warc = fields(head)
        left = int(warc["content-length"])
        block, payload, size, http, kept = hashlib.sha256(), hashlib.sha256(), 0, b"", []
        in_head = True
        for piece in member.pieces(left):
            block.update(piece)
            if in_head:
                http += piece
                at = http.find(END)
                if at < 0:
                    continue
                piece, http, in_head = http[at + len(END) :], http[:at], False
            payload.update(piece)
            size += len(piece)
            if payloads:
                kept.append(piece)
        if in_head:
            raise ValueError("a block without an HTTP head")
        said = int(fields(http.decode().split("\r\n"))["content-length"])
        digest = warc["warc-payload-digest"].removeprefix("sha256:")
        if warc["warc-block-digest"] != f"sha256:{block.hexdigest()}":
            raise ValueError("a block does not fit its digest")
        if warc["warc-type"] == "response" and (said != size or digest != payload.hexdigest()):
            raise ValueError("a payload does not fit its length or digest")
        yield warc, said, digest, b"".join(kept) if payloads and warc["warc-type"] == "response" else None
        rest = member.close() or stream.read(CHUNK)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that all machines share, and the path in it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":" in path else f"file://{path}")


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
                   archive_bytes: int = ARCHIVE_BYTES, least_shared: int = LEAST_SHARED) -> DataFrame:
    """Write a record for each row of ``pages``; a stored table (path, records) of the archives in ``folder``.

    Null html is empty. Of rows with equal payloads of at least ``least_shared`` bytes those with the
    smallest page id are responses, others revisit it; rows without an id come last, and are responses if
    none of the group has one. No rows give no archive.
    """
    rows = pages.select(F.col(key).cast("bigint").alias("page"), F.col(url).cast("string").alias("url"), F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    shared = rows.where(F.octet_length("payload") >= least_shared).groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    decided = rows.join(shared, "digest", "left").select("page", "url", "payload", "digest", F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first")).alias("first"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        out, name, size, n = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["path", "records"])

        for batch in batches:
            for page, address, payload, digest, first in zip(*[batch.column(c) for c in ("page", "url", "payload", "digest", "first")], strict=True):
                if out is None:
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                member = record(page.as_py(), address.as_py(), payload.as_py(), digest.as_py(), first.as_py())
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return store(decided.mapInArrow(run, "path string, records bigint"))


FOUND = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def read_archives(archives: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The records of the archives (path) in ``folder``: columns as in ``FOUND``; payload is null unless asked for."""
    spark = archives.sparkSession

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

        def number(text: str | None) -> int | None:
            return None if text is None else int(text)

        for batch in batches:
            for name in batch.column("path").to_pylist():
                with system.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    rows, held = [], 0
                    for warc, size, digest, payload in read(stream, payloads):
                        rows.append((number(warc.get("x-page-id")), warc.get("warc-target-uri"), size, digest, warc["warc-type"], number(warc.get("x-refers-to-page-id")), payload))
                        held += len(payload or b"")
                        if len(rows) == 1_000 or held > 16 << 20:
                            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)

    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return archives.select("path").repartition(tasks, "path").mapInArrow(run, FOUND)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) read back from archives of ``pages``."""
    folder = table_path(pages.sparkSession, "warc")
    archives = write_archives(pages, folder, key, url, html)
    return read_archives(archives, folder).select(F.col("page_id").alias(key), "payload_bytes", "payload_digest", "record_type", "refers_to")
