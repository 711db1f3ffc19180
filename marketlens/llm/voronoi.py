"""Exact top-k search by a Voronoi join.

Integer vectors are dealt to the nearest of a bounded number of pivots. A
group's summary is its pivot, its radius and its size. For a query q and a
group with pivot c and radius r every member x has

    q.c - |q| r  <=  q.x  <=  q.c + |q| r,

so the summaries give each query a score that its k-th best is sure to reach,
and the groups that can hold anything as good.

1. Each query is solved in the group whose bound promises most, which raises
   the sure score to a real k-th best.
2. Each query is then replicated only to the groups whose upper bound is not
   below that score, and solved there; the partial lists are merged.

Groups are cut into blocks of bounded size, so that a vector shared by a third
of all rows fills many tasks, not one. Ties go to the smaller id, and groups
whose bound equals the score are visited, so results are exact. Scores are
sums of 64-bit integers.

A vector that is null or holds a null or a value that is not finite takes no
part, and neither does a null id. Components and scores beyond 64 bits are held
at the ends of that range. Shorter vectors are padded with zeros. Rows
that repeat an id are candidates each; a query excludes every row of its id
and queries of one id are answered once, by its first vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.functions.settle import settle

K = 10
SCALE = 1024
QUERY_EVERY = 100
PIVOTS = 64
#: Vectors in a block of a group.
BLOCK_VECTORS = 4096
#: Queries that meet a block at once.
QUERY_BATCH = 512
#: Slack of the floating bounds.
SLACK = 1e-9

PLACED = "vec_id long, cell int, distance double, vector array<long>"


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, vector`` with components ``floor(scale * x)``."""
    vector = F.col("embedding").cast("array<double>")
    fit = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return embeddings.where(fit).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(vector, lambda x: F.floor(x * F.lit(scale)).cast("long")).alias("vector"))


def _matrix(vectors, width: int) -> np.ndarray:
    """Rows padded to ``width``."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact inner products, by floating products where those are exact."""
    reach = np.abs(queries.astype(np.float64)).max(initial=0) * np.abs(data.astype(np.float64)).max(initial=0) * queries.shape[1]
    if reach < 2.0**53:
        return (queries.astype(np.float64) @ data.astype(np.float64).T).astype(np.int64)
    if reach < 2.0**63:
        return queries @ data.T
    return np.array([[max(-(2**63), min(2**63 - 1, sum(int(a) * int(b) for a, b in zip(q, d, strict=True)))) for d in data] for q in queries], np.int64).reshape(len(queries), len(data))


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, data: np.ndarray, k: int) -> pd.DataFrame:
    """The k best rows of ``data`` for every query, its own id left out."""
    rows: list[np.ndarray] = []
    for lo in range(0, len(queries), QUERY_BATCH):
        scores = _products(queries[lo : lo + QUERY_BATCH], data)
        for query_id, own in zip(query_ids[lo : lo + QUERY_BATCH], scores, strict=True):
            other = np.flatnonzero(ids != query_id)
            if len(other) > k:
                least = np.partition(own[other], len(other) - k)[len(other) - k]
                other = other[own[other] >= least]
            other = other[np.lexsort((ids[other], -own[other]))][:k]
            rows.append(np.stack([np.full(len(other), query_id), ids[other], own[other]], axis=1))
    found = np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])


def _merge(partial: DataFrame, k: int) -> DataFrame:
    """The k best of the partial lists of every query."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _solve(queries: DataFrame, blocks: DataFrame, width: int, k: int) -> DataFrame:
    """Partial lists of ``queries(query_id, vector, cell, block)`` in the blocks they name."""

    def local(key, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        return _best(asked["query_id"].to_numpy(), _matrix(asked["vector"], width), held["vec_id"].to_numpy(), _matrix(held["vector"], width), k)

    return queries.groupBy("cell", "block").cogroup(blocks.groupBy("cell", "block")).applyInPandas(local, "query_id long, vec_id long, score long")


def nearest(embeddings: DataFrame, query_every: int = QUERY_EVERY, k: int = K, pivots: int = PIVOTS, block_vectors: int = BLOCK_VECTORS, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best rows for each query.

    Queries are the rows whose id is divisible by ``query_every``.
    """
    spark = embeddings.sparkSession
    vectors = settle(integer_vectors(embeddings, scale), "integer-vectors")
    width = vectors.agg(F.max(F.size("vector"))).first()[0] or 0
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("vector").collect()
    centres = _matrix([r["vector"] for r in chosen], width).astype(np.float64)
    square = (centres**2).sum(axis=1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = _matrix(batch.column(1).to_pylist(), width).astype(np.float64)
            gaps = np.maximum((data**2).sum(axis=1)[:, None] - 2 * data @ centres.T + square, 0)
            cell = gaps.argmin(axis=1)
            distance = np.sqrt(((data - centres[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cell.astype(np.int32)), pa.array(distance), batch.column(1)], names=["vec_id", "cell", "distance", "vector"])

    placed = settle(vectors.mapInArrow(place, PLACED), "voronoi")
    # One row per pivot: at most ``pivots`` summaries come to the driver.
    summary = placed.groupBy("cell").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("members")).orderBy("cell").collect()
    cells = np.array([r["cell"] for r in summary], np.int64)
    radius, members = np.array([r["radius"] for r in summary], float), np.array([r["members"] for r in summary], np.int64)
    pivot = centres[cells] if len(cells) else np.zeros((0, width))
    parts = {int(c): int(-(-m // block_vectors)) for c, m in zip(cells, members, strict=True)}
    blocks_in = np.zeros(max(1, pivots), np.int64)
    for c, n in parts.items():
        blocks_in[c] = n
    block = F.pmod(F.xxhash64("vec_id", "distance"), F.element_at(F.array(*[F.lit(int(max(1, n))) for n in blocks_in]), F.col("cell") + 1)).cast("int")
    blocks = placed.select("cell", block.alias("block"), "vec_id", "vector")
    queries = placed.where(F.pmod("vec_id", F.lit(query_every)) == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"), F.count(F.lit(1)).alias("own"))

    def bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        along = data @ pivot.T
        reach = np.sqrt((data**2).sum(axis=1))[:, None] * radius
        slack = SLACK * (np.abs(along) + reach) + 1e-6
        return np.clip(along - reach - slack, -(2.0**63), 2.0**63), np.clip(along + reach + slack, -(2.0**63), 2.0**63)

    def send(first_round: bool):
        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, 2000):
                    part = batch.slice(start, 2000)
                    low, high = bounds(_matrix(part.column(1).to_pylist(), width).astype(np.float64))
                    if first_round:
                        wanted = np.zeros_like(high, bool)
                        wanted[np.arange(len(high)), high.argmax(axis=1)] = True
                    else:
                        floor = part.column(3).to_numpy(zero_copy_only=False).astype(np.float64)
                        order = np.argsort(-low, axis=1)
                        # The query's own rows are among the members but not in its answer.
                        needed = k + part.column(2).to_numpy()
                        enough = (np.cumsum(members[order], axis=1) >= needed[:, None]).argmax(axis=1)
                        sure = np.where(members.sum() >= needed, np.take_along_axis(low, order, axis=1)[np.arange(len(low)), enough], -np.inf)
                        wanted = high >= np.fmax(sure, np.where(np.isnan(floor), -np.inf, floor))[:, None]
                    rows, cols = np.nonzero(wanted)
                    copies = np.array([parts[int(c)] for c in cells[cols]], np.int64)
                    rows, of = np.repeat(rows, copies), np.repeat(cells[cols], copies)
                    number = np.arange(len(rows)) - np.repeat(np.cumsum(copies) - copies, copies)
                    taken = part.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [taken.column(0), taken.column(1), pa.array(of.astype(np.int32)), pa.array(number.astype(np.int32))], names=["query_id", "vector", "cell", "block"])

        return route

    routed = "query_id long, vector array<long>, cell int, block int"
    if not len(cells):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    first = _merge(_solve(queries.select("query_id", "vector", "own").mapInArrow(send(True), routed), blocks, width, k), k)
    floors = settle(first.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k).select("query_id", "floor"), "floors")
    second = queries.join(floors, "query_id", "left").select("query_id", "vector", "own", F.col("floor").cast("double").alias("floor")).mapInArrow(send(False), routed)
    return _merge(_solve(second, blocks, width, k), k)
