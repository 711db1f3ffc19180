"""Web archives: one gzip member per record, written and read by tasks.

Writing: payload digests are counted in Spark; of equal payloads of at least
``REVISIT_BYTES`` the one with the smallest ``page_id`` is stored as a
response and the others as revisits that refer to it. Every task streams its
rows into archive files of bounded size in the shared folder. A file gets its
name when it is whole, and the name belongs to the attempt, so a repeated
attempt leaves at most a file that the manifest does not list.

Reading: archives are read from front to back in small blocks. Members are
inflated as the bytes come, records are framed by their Content-Length, and
the payload's digest is checked against the record's header.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.settle import fresh_path, settle
from marketlens.llm.files import OutputFile, open_input

REVISIT_BYTES = 100
#: Bytes of payload after which an archive is closed.
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 18
DATE = "2024-01-01T00:00:00Z"

#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ODD = re.compile(r"[\x00-\x20\x7f-\x9f]")
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
_RECORD_TYPES = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]


def _name(page_id: int | None) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def _number(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One compressed record: a response, or a revisit if ``refers_to`` is set."""
    target = _ODD.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url) if url else "urn:none"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = VERSION + b"\r\n" + "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n"
    return deflate.compress(head) + deflate.compress(block) + deflate.compress(b"\r\n\r\n") + deflate.flush()


class ArchiveReader:
    """Records of one archive, in order, from a stream with ``read(n)``."""

    def __init__(self, stream, read_bytes: int = READ_BYTES):
        self.stream, self.read_bytes = stream, read_bytes
        self.inflate, self.packed, self.held = None, b"", bytearray()

    def _more(self) -> bool:
        """Inflate a little more; False at the end of the archive."""
        while True:
            if not self.packed:
                self.packed = self.stream.read(self.read_bytes)
                if not self.packed:
                    if self.inflate is not None:
                        raise EOFError("the archive ends inside a member")
                    return False
            if self.inflate is None:
                self.inflate = zlib.decompressobj(31)
            out = self.inflate.decompress(self.packed, self.read_bytes)
            if self.inflate.eof:
                self.packed, self.inflate = self.inflate.unused_data, None
            else:
                self.packed = self.inflate.unconsumed_tail
            if out:
                self.held += out
                return True

    def _line(self) -> bytes | None:
        at = 0
        while (end := self.held.find(b"\n", at)) < 0:
            at = len(self.held)
            if not self._more():
                if self.held:
                    raise EOFError("the archive ends inside a header")
                return None
        line = bytes(self.held[:end]).rstrip(b"\r")
        del self.held[: end + 1]
        return line

    def _take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self._more():
                raise EOFError("the archive ends inside a record")
            piece = bytes(self.held[:n])
            del self.held[: len(piece)]
            n -= len(piece)
            yield piece

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """Header fields, with lower-case names, and the block of every record."""
        while True:
            line = self._line()
            while line == b"":
                line = self._line()
            if line is None:
                return
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not a record: {line[:40]!r}")
            fields: dict[str, str] = {}
            while line := self._line():
                name, _, value = line.decode("utf-8", "replace").partition(":")
                fields[name.strip().lower()] = value.strip()
            yield fields, b"".join(self._take(int(fields["content-length"])))


def page_row(fields: dict[str, str], block: bytes) -> tuple | None:
    """A row of ``RECORDS`` from a response or revisit; None for other types.

    Raises ValueError when a stored payload does not fit its digest.
    """
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    head, _, payload = block.partition(b"\r\n\r\n")
    declared = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind == "response" and hashlib.sha256(payload).hexdigest() != declared:
        raise ValueError(f"payload of {fields.get('warc-record-id')} does not fit its digest")
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", head)[1]) if kind == "revisit" else len(payload)
    target = fields.get("warc-target-uri")
    return (_number(fields.get("warc-record-id")), None if target == "urn:none" else target, size, declared, kind,
            _number(fields.get("warc-refers-to")) if kind == "revisit" else None)


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page; returns the stored manifest ``file, records``.

    A null page is empty. A page without id is never referred to; rows that
    repeat the id of a response with its payload are responses too. Columns
    beyond ``page_id``, ``url`` and ``html`` are left out.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    equal = (
        rows.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest")
        .agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first_page")
    )
    ready = rows.join(settle(equal, "equal-payloads"), "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("first_page").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_page")), F.col("first_page")).alias("refers_to"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, out, held, records, name = TaskContext.get().partitionId(), 0, None, 0, 0, ""

        def close() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64())], names=["file", "records"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                for row in zip(*(c.to_pylist() for c in batch.slice(lo, 500).columns), strict=True):
                    if out is None:
                        name = f"{folder}/part-{part:06d}-{number:04d}-{uuid.uuid4().hex}.warc.gz"
                        out, held, records, number = OutputFile(name), 0, 0, number + 1
                    out.write(record(*row))
                    held, records = held + len(row[2]), records + 1
                    if held >= archive_bytes:
                        yield close()
                        out = None
        if out is not None:
            yield close()

    return settle(ready.mapInArrow(write, "file string, records long"), "archives")


def read_archives(manifest: DataFrame) -> DataFrame:
    """The responses and revisits of the manifest's archives."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(_RECORD_TYPES)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows: list[tuple] = []
                with open_input(file) as stream:
                    for fields, block in ArchiveReader(stream):
                        if row := page_row(fields, block):
                            rows.append(row)
                        if len(rows) == 5000:
                            yield _batch(rows, schema)
                            rows = []
                if rows:
                    yield _batch(rows, schema)

    return manifest.select("file").repartition(max(1, manifest.count()), "file").mapInArrow(read, RECORDS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages as archives and read their records back."""
    return read_archives(write_archives(pages, fresh_path(spark, "warc"))).drop("url")
