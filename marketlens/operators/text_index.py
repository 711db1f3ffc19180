"""Keyword search through a stored table of letter triples.

``build`` stores the rows under a row id, in parts, and beside them the postings of every triple of letters that stands in a
searched column: the sorted row ids of a part, as the first one and packed gaps. They are packed where the rows are read, so
that a byte or two a posting are shuffled and stored. A keyword then becomes the intersection of the postings of its
triples; only the rows that are left, and only the parts they lie in, are read and tested on their
text. Words of fewer than three letters and keywords with pattern signs have no
triples: those are answered by the scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .search import keyword_filter

GRAM = 3
#: Folders of the posting table; a lookup opens those of its triples only.
BUCKETS = 64
#: Rows of a part of the stored table.
PART_ROWS = 100_000
#: Parts at most; with more rows the parts get larger. Each is a folder to write and to list.
MAX_PARTS = 256
_SIGNS = re.compile(r"[\\.^$*+?{}\[\]()]")


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def _grams(text: Column) -> Column:
    low = F.coalesce(F.lower(text), F.lit(""))
    starts = F.when(F.length(low) >= GRAM, F.sequence(F.lit(1), F.length(low) - GRAM + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(low, i, F.lit(GRAM))))


def packed(ids: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The gaps between the ids of each group, which begins at one of ``starts`` and rises, in bytes of seven bits, low ones first."""
    gaps = np.diff(ids, prepend=ids[:1]).astype(np.uint64)
    sizes = np.ones(len(ids), np.int64)
    for k in range(1, 10):
        sizes += gaps >= np.uint64(1 << 7 * k)
    # The first id of a group is kept beside the gaps.
    sizes[starts] = 0
    ends = np.cumsum(sizes)
    data = np.zeros(ends[-1] if len(ends) else 0, np.uint8)
    for k in range(sizes.max(initial=0)):
        at = sizes > k
        low = (gaps[at] >> np.uint64(7 * k)).astype(np.uint8) & 0x7F
        data[ends[at] - sizes[at] + k] = low | ((sizes[at] > k + 1) * 0x80).astype(np.uint8)
    offsets = np.append(ends[starts], ends[-1:] if len(ends) else [0]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def unpacked(first: int, gaps: bytes) -> np.ndarray:
    """The ids of one group, rising."""
    data = np.frombuffer(gaps, np.uint8)
    ends = np.flatnonzero(data < 0x80)
    starts = np.append(0, ends[:-1] + 1)[: len(ends)]
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    bits = (data & 0x7F).astype(np.int64) << 7 * place
    return first + np.append(0, np.cumsum(np.add.reduceat(bits, starts) if len(starts) else bits))


_POSTINGS = pa.schema([("part", pa.int32()), ("gram", pa.string()), ("first", pa.int64()), ("gaps", pa.binary())])


def _packed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``part, gram, first, gaps`` of ``part, row_id, grams``: a row for each triple of a part in a batch."""
    for batch in batches:
        grams = batch.column("grams")
        rows = pc.list_parent_indices(grams).to_numpy()
        if not len(rows):
            continue
        flat = grams.flatten().dictionary_encode()
        gram, part, ids = flat.indices.to_numpy(), batch.column("part").to_numpy()[rows], batch.column("row_id").to_numpy()[rows]
        order = np.lexsort((ids, gram, part))
        gram, part, ids = gram[order], part[order], ids[order]
        starts = np.flatnonzero(np.append(True, (gram[1:] != gram[:-1]) | (part[1:] != part[:-1])))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[starts], pa.int32()), flat.dictionary.take(pa.array(gram[starts])), pa.array(ids[starts]), packed(ids, starts)], schema=_POSTINGS)


def build(rows: DataFrame, path: str, *columns: str, part_rows: int = PART_ROWS) -> None:
    """Store ``rows`` and the postings of ``columns`` below ``path``. The rows are neither counted nor moved."""
    spark = rows.sparkSession
    # The id holds the number of its partition above bit 33, and the place in it below. Stretches of a partition are dealt to parts.
    numbered = rows.withColumn("row_id", F.monotonically_increasing_id())
    place = F.shiftright("row_id", 33) + F.expr(f"(row_id & {(1 << 33) - 1}) div {int(part_rows)}")
    numbered = numbered.withColumn("part", (place % MAX_PARTS).cast("int"))
    numbered.write.mode("overwrite").option("compression", "zstd").partitionBy("part").parquet(f"{path}/rows")
    grams = reduce(F.array_union, [_grams(F.col(c)) for c in columns])
    stored = spark.read.parquet(f"{path}/rows").select(F.col("part").cast("int"), "row_id", grams.alias("grams"))
    postings = stored.mapInArrow(_packed_batches, "part int, gram string, first long, gaps binary").withColumn("bucket", _bucket(F.col("gram")))
    postings.hint("rebalance", "bucket").sortWithinPartitions("bucket", "gram").write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{path}/postings")


def words_of(keyword: str) -> list[str] | None:
    """The alternatives of a keyword, or None if it has to be answered by a scan."""
    words = keyword.split("|")
    return None if _SIGNS.search(keyword) or any(len(w) < GRAM for w in words) else words


def candidates(spark: SparkSession, path: str, words: list[str]) -> DataFrame:
    """``part, row_id`` of the rows that hold all triples of one of the words."""
    asked = {w: {w.lower()[i : i + GRAM] for i in range(len(w) - GRAM + 1)} for w in words}
    triples = sorted(set().union(*asked.values()))
    lists = spark.read.parquet(f"{path}/postings")
    buckets = [r[0] for r in spark.createDataFrame([(g,) for g in triples], "gram string").select(_bucket(F.col("gram")).alias("b")).distinct().collect()]

    def met(postings: pa.Table) -> pa.Table:
        """The rows of one part, by its packed lists: of every word the shortest list first."""
        held: dict[str, list[tuple[int, bytes]]] = {}
        for gram, first, gaps in zip(*[postings.column(c).to_pylist() for c in ("gram", "first", "gaps")], strict=True):
            held.setdefault(gram, []).append((first, gaps))
        found = [np.zeros(0, np.int64)]
        for grams in asked.values():
            if not all(g in held for g in grams):
                continue
            rows = None
            for gram in sorted(grams, key=lambda g: sum(len(gaps) for _, gaps in held[g])):
                ids = np.concatenate([unpacked(*group) for group in held[gram]])
                rows = ids if rows is None else rows[np.isin(rows, ids)]
            found.append(rows)
        ids = np.unique(np.concatenate(found))
        return pa.table({"part": pa.array(np.full(len(ids), postings.column("part")[0].as_py()), pa.int32()), "row_id": pa.array(ids, pa.int64())})

    wanted = lists.where(F.col("bucket").isin(*buckets) & F.col("gram").isin(*triples)).select("part", "gram", "first", "gaps")
    return wanted.groupBy("part").applyInArrow(met, "part int, row_id long")


def find(spark: SparkSession, path: str, keyword: str, *columns: str) -> DataFrame:
    """The rows of ``keyword_filter`` on the stored rows, read through the postings where the keyword allows it."""
    stored = spark.read.parquet(f"{path}/rows")
    words = words_of(keyword)
    if words is not None:
        chosen = candidates(spark, path, words)
        stored = stored.join(chosen, ["part", "row_id"], "left_semi")
    return keyword_filter(stored, keyword, *columns).drop("part", "row_id")
