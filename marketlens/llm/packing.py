"""Bounded-space best-fit packing of token sequences.

A packer holds a fixed number of open sequences in stacks, one stack per free
space, with a bitset of the stacks that are not empty. A piece goes into the
open sequence with the least free space that still holds it; a full one is
closed, and when too many are open the fullest is closed first.

Documents longer than a sequence are cut into full pieces, which need no
search; the remainder comes first. The pieces to be searched are dealt into
groups by a hash, and a group's pieces arrive longest first, so that a group
loses little against an unbounded packing. Groups are independent: only
lengths move between machines, never the ids, and a lost task is run again
with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.settle import settle
from marketlens.llm.tokens import default_vocabulary, encoder

SEQUENCE_TOKENS = 1024
OPEN_SEQUENCES = 65_536
#: Pieces that one packer sees, so that its memory is bounded.
GROUP_PIECES = 400_000
END_ID = 2

PIECES = "doc_id long, piece int, start long, length long, ids binary"


class BestFit:
    """Places piece lengths, one at a time, into sequences of ``size``."""

    def __init__(self, size: int = SEQUENCE_TOKENS, open_limit: int = OPEN_SEQUENCES):
        self.size, self.open_limit = size, open_limit
        self.stacks: list[list[int]] = [[] for _ in range(size + 1)]
        self.free_spaces = 0
        self.opened = self.n_open = 0

    def place(self, length: int) -> tuple[int, int]:
        """Sequence number and offset of a piece of 1 to ``size`` tokens."""
        fitting = self.free_spaces >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(space)
        else:
            if self.n_open >= self.open_limit:
                self._take((self.free_spaces & -self.free_spaces).bit_length() - 1)
            space, sequence = self.size, self.opened
            self.opened += 1
        left = space - length
        if left:
            self.stacks[left].append(sequence)
            self.free_spaces |= 1 << left
            self.n_open += 1
        return sequence, self.size - space

    def _take(self, space: int) -> int:
        stack = self.stacks[space]
        sequence = stack.pop()
        if not stack:
            self.free_spaces &= ~(1 << space)
        self.n_open -= 1
        return sequence


def token_pieces(docs: DataFrame, vocabulary: str | None = None, size: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``size`` ids of every text with its end id.

    ``ids`` holds little-endian unsigned 32-bit ids. A null text is empty and
    gives the end id alone. Rows with a null or repeated ``doc_id`` are pieces
    of their own. Other columns are left out.
    """
    vocabulary = vocabulary or default_vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary).encode, end_id.to_bytes(4, "little")
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                rows: list[list] = [[], [], [], [], []]
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()), strict=True):
                    ids += end
                    total = len(ids) // 4
                    edge, start, piece = total % size or size, 0, 0
                    while start < total:
                        for column, value in zip(rows, (doc_id, piece, start, edge - start, ids[4 * start : 4 * edge]), strict=True):
                            column.append(value)
                        start, edge, piece = edge, edge + size, piece + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, PIECES)


def pack(pieces: DataFrame, size: int = SEQUENCE_TOKENS, open_limit: int = OPEN_SEQUENCES, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces with a ``length``.

    All columns are kept and must not be called ``sequence_id``, ``offset`` or
    ``_group``. Every length must lie between 1 and ``size``. Sequence numbers
    are unique over all groups. ``pieces`` is read twice, so it should be a
    stored table. An empty input gives an empty result.
    """
    groups = -(-pieces.count() // group_pieces) or 1
    schema = pieces.schema.add("sequence_id", "long", False).add("offset", "long", False)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packers: dict[int, BestFit] = {}
        for batch in batches:
            group, sequences, offsets = batch.column(batch.num_columns - 1).to_pylist(), [], []
            for g, length in zip(group, batch.column(batch.schema.get_field_index("length")).to_pylist(), strict=True):
                if g not in packers:
                    packers = {g: BestFit(size, open_limit)}
                sequence, offset = packers[g].place(length)
                sequences.append(sequence * groups + g)
                offsets.append(offset)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    ties = [F.col(c) for c in ("doc_id", "piece", "start") if c in pieces.columns]
    return (
        pieces.withColumn("_group", F.pmod(F.xxhash64(*ties, "length"), F.lit(groups)))
        .repartition(groups, "_group")
        .sortWithinPartitions("_group", F.desc("length"), *ties)
        .mapInArrow(place, schema)
    )


def sequences(packed: DataFrame) -> DataFrame:
    """Assemble the ids of every sequence from packed pieces with ``ids``."""
    return (
        packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids"))).alias("pieces"))
        .select("sequence_id", F.expr("transform(pieces, p -> struct(p.doc_id, p.piece, p.offset))").alias("pieces"),
                F.expr("aggregate(transform(pieces, p -> p.ids), cast('' as binary), (a, x) -> a || x)").alias("ids"))
    )


def packed_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per piece with its place and the checksum of its ids."""
    pieces = token_pieces(docs, vocabulary).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(settle(pieces, "pieces"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: pack every document kept so far. A null text is an end id alone; repeated rows are packed apart; an empty table gives no pieces."""
    return packed_documents(docs)
