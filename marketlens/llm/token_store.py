"""Token ids of a corpus in binary files with Elias-Fano document boundaries.

A file holds the ids of some documents, one array after the other, in two
bytes each where the largest id allows it. The position behind every document
is a rising sequence, and so are the document numbers of a sorted corpus: both
are stored by Elias and Fano's code in about ``2 + log2(range / n)`` bits each.
Low bits lie packed; high bits are a bitmap in which every 64th one bit has
its place recorded, so that ``select`` finds any boundary by looking at a few
words.

Files are written by the tasks of a range partitioning by ``doc_id``. Each
attempt writes a file of its own name and reports it; a reader takes the files
of the manifest, so that a repeated attempt leaves at most an unlisted file.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.functions.settle import fresh_path, settle
from marketlens.llm.files import open_input, write_file
from marketlens.llm.tokens import default_vocabulary, encoder

END_ID = 0
MAGIC = b"TOKS0001"
SELECT_STEP = 64
#: Ids after which a file is closed.
FILE_IDS = 24_000_000

MANIFEST = "file string, part int, number int, n_docs long, n_ids long"


class EliasFano:
    """A non-decreasing sequence of non-negative integers.

    ``samples`` are the places of every SELECT_STEP-th bit set in the upper
    bitmap, as unsigned 32-bit numbers; they are stored, so a sequence is read without being decoded.
    """

    def __init__(self, n: int, low_bits: int, low: bytes, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = (values & ((1 << low_bits) - 1)).astype(np.uint64)
        bits = ((low[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        n_high = n + (top >> low_bits) + 1
        if n_high >= 1 << 32:
            raise ValueError("too many values for one sequence")
        high = np.zeros(-(-n_high // 64) * 64, np.uint8)
        ones = (values >> low_bits) + np.arange(n)
        high[ones] = 1
        return cls(n, low_bits, np.packbits(bits.ravel(), bitorder="little").tobytes(), np.packbits(high, bitorder="little").view(np.uint64), ones[::SELECT_STEP].astype("<u4"))

    def to_bytes(self) -> bytes:
        return struct.pack("<QBQQ", self.n, self.low_bits, len(self.low), len(self.high)) + self.low + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        n, low_bits, n_low, n_high = struct.unpack_from("<QBQQ", data, at)
        at += struct.calcsize("<QBQQ")
        high = np.frombuffer(data, np.uint64, n_high, at + n_low)
        last = at + n_low + 8 * n_high
        samples = np.frombuffer(data, "<u4", -(-n // SELECT_STEP), last)
        return cls(n, low_bits, data[at : at + n_low], high, samples), last + 4 * len(samples)

    def select(self, i: int) -> int:
        """The i-th value, from the nearest sample and a few bitmap words."""
        place = int(self.samples[i // SELECT_STEP])
        word, left = place // 64, i % SELECT_STEP
        bits = int(self.high[word]) >> (place % 64) << (place % 64)
        while (ones := bits.bit_count()) <= left:
            left, word = left - ones, word + 1
            bits = int(self.high[word])
        for _ in range(left):
            bits &= bits - 1
        place = 64 * word + (bits & -bits).bit_length() - 1
        first = i * self.low_bits
        chunk = int.from_bytes(self.low[first // 8 : (first + self.low_bits + 7) // 8], "little") >> (first % 8)
        return (place - i) << self.low_bits | chunk & ((1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        """Every value."""
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[: self.n]
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1, dtype=np.int64)
        return (ones - np.arange(self.n)) << self.low_bits | low


def encode_file(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """A file of documents in ascending order, null numbers first.

    ``ids`` are little-endian unsigned 32-bit arrays.
    """
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    base = int(known[0]) if len(known) else 0
    joined = np.frombuffer(b"".join(ids), "<u4")
    width = 2 if joined.max(initial=0) < 1 << 16 else 4
    ends = np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)
    head = struct.pack("<8sBqQQ", MAGIC, width, base, len(doc_ids) - len(known), len(joined))
    return b"".join([head, EliasFano.encode(known - base).to_bytes(), EliasFano.encode(ends).to_bytes(), joined.astype(f"<u{width}").tobytes()])


class TokenFile:
    """A file in memory: documents by position, without decoding the rest."""

    def __init__(self, data: bytes):
        magic, self.width, self.base, self.n_null, self.n_ids = struct.unpack_from("<8sBqQQ", data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.numbers, at = EliasFano.from_bytes(data, struct.calcsize("<8sBqQQ"))
        self.ends, at = EliasFano.from_bytes(data, at)
        self.ids = np.frombuffer(data, f"<u{self.width}", self.n_ids, at)

    def __len__(self) -> int:
        return self.ends.n

    def doc_id(self, i: int) -> int | None:
        return None if i < self.n_null else self.base + self.numbers.select(i - self.n_null)

    def start(self, i: int) -> int:
        return self.ends.select(i - 1) if i else 0

    def tokens(self, i: int) -> np.ndarray:
        return self.ids[self.start(i) : self.ends.select(i)].astype("<u4")


def write_tokens(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Write every text with its end id, in ascending ``doc_id`` order.

    Returns the manifest: files with their document and id counts. Null texts
    are empty, null numbers come first, rows that repeat a number stay beside
    each other in text order. Other columns are left out.
    """
    vocabulary = vocabulary or default_vocabulary()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        encode, end = encoder(vocabulary).encode, end_id.to_bytes(4, "little")
        doc_ids: list[int | None] = []
        ids: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal doc_ids, ids, held, number
            name = f"{folder}/part-{part:06d}-{number:04d}-{uuid.uuid4().hex}.tok"
            write_file(name, encode_file(doc_ids, ids))
            row = pa.RecordBatch.from_pylist(
                [{"file": name, "part": part, "number": number, "n_docs": len(doc_ids), "n_ids": held // 4}],
                pa.schema([("file", pa.string()), ("part", pa.int32()), ("number", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
            )
            doc_ids, ids, held, number = [], [], 0, number + 1
            return row

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                piece = batch.slice(lo, 256)
                found = [x + end for x in encode(piece.column(1).to_pylist())]
                doc_ids += piece.column(0).to_pylist()
                ids += found
                held += sum(map(len, found))
                if held >= 4 * file_ids:
                    yield close()
        if doc_ids:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return settle(rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(write, MANIFEST), "token-manifest")


def read_tokens(spark: SparkSession, manifest: DataFrame, digest=None) -> DataFrame:
    """Read the files back: ``doc_id, start, n_tokens, ids``.

    ``start`` counts the ids of all documents before. With ``digest``, a
    function of an id array, its result replaces the ids.
    """
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = settle(manifest.select("file", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("base")), "token-files")
    last = ("ids_digest", pa.int64()) if digest else ("ids", pa.binary())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open_input(file) as source:
                    held = TokenFile(source.read())
                for lo in range(0, len(held), 2048):
                    hi = min(lo + 2048, len(held))
                    bounds = np.array([held.start(i) for i in range(lo, hi + 1)], np.int64)
                    ids = [held.ids[a:b].astype("<u4") for a, b in zip(bounds, bounds[1:], strict=False)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([held.doc_id(i) for i in range(lo, hi)], pa.int64()),
                        pa.array(bounds[:-1] + base, pa.int64()),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array([digest(x) if digest else x.tobytes() for x in ids], last[1]),
                    ], names=["doc_id", "start", "n_tokens", last[0]])

    return placed.repartition(max(1, placed.count()), "file").mapInArrow(read, f"doc_id long, start long, n_tokens long, {'ids_digest long' if digest else 'ids binary'}")


def round_trip(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write the corpus, read it back, and return a checksum per document."""
    import zlib

    manifest = write_tokens(docs, fresh_path(spark, "tokens"), vocabulary)
    found = read_tokens(spark, manifest, digest=lambda ids: zlib.crc32(ids.tobytes()))
    return found.withColumnRenamed("ids_digest", "ids_crc32")
