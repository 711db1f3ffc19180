"""Incremental ingest of landed files into a deduplicated table.

The stream checkpoint remembers which files are done. Every micro-batch is
cleaned, made distinct and reduced to rows the table does not hold yet, then
written to a folder named by the stream and the batch and listed in the
table's manifest. A batch that is retried after a failure overwrites only that
folder, so each row lands exactly once. A new checkpoint is a new stream: it
never touches the folders of an earlier one, and copies of their rows are
seen. Rows are compared by a digest of all their columns, which is stored
beside them, so a batch reads two columns of the months it touches. Nothing is
dropped for being late, and no state grows with the stream.

Beside the rows a table can keep *states*: mergeable statistics per key (see
``plans.batch``). Each batch adds the cells of its own new rows; reports fold
all cells and never read a row again. ``compact`` rewrites closed months, rows
and cells, as one part each.

``watermarked_ingest`` is the second mode, for streams whose rows come in
order but for a known delay: duplicates are held in Spark's own state, which
forgets what is older than the watermark, nothing stored is read, and rows
behind the watermark go to a table of their own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.batch import CELL, cells_by, fold_cells
from ..sources import snapshots
from ..sources.snapshots import Part, Snapshot

#: Keys of the states that the reports of ``plans.batch.cell_reports`` need.
REPORT_STATES: dict[str, list[str]] = {"cells": CELL, "days": ["price_date"]}
#: Rows of a month that one task makes distinct and writes.
MONTH_ROWS = 500_000
_STORED = ("stream", "batch_id", "ym", "row_digest")


def row_digest(columns: list[str]) -> Column:
    """128-bit digest of a row; nulls and empty texts differ."""
    text = lambda c: F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
    return F.md5(F.concat_ws(",", *[text(c) for c in columns]))


def month_of(date: str) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit("none"))


def stream_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint keeps for its stream as long as it lives."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def state_folder(name: str) -> str:
    return f"_state_{name}"


def _cells(rows: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """The cells of new rows, with the month that they are stored under."""
    return cells_by(rows.withColumn("month", F.trunc(date, "month")), *dict.fromkeys([*keys, "ym"]))


def deal_by_month(rows: DataFrame, months: Mapping[str, int], key: Column, *place: str) -> tuple[DataFrame, list[str]]:
    """Rows dealt by ``ym`` and ``place``, those of heavy months in slices by ``key``; and the columns of the deal.

    ``months`` are row counts. A stream with state runs without AQE, which then ignores a rebalance: every task
    would write a file of every month.
    """
    by = [*place, "ym"]
    slices = {m: -(-n // MONTH_ROWS) for m, n in months.items() if n > MONTH_ROWS}
    if slices:
        count = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in slices.items() for x in pair]), F.col("ym")), F.lit(1))
        rows, by = rows.withColumn("_slice", F.pmod(F.xxhash64(key), count)), [*by, "_slice"]
    return rows.repartition(*by), by


def month_counts(rows: DataFrame) -> dict[str, int]:
    return {r["ym"]: r["n"] for r in rows.groupBy("ym").agg(F.count(F.lit(1)).alias("n")).collect()}


def unseen_rows(rows: DataFrame, held: DataFrame | None, months: Mapping[str, int]) -> DataFrame:
    """One row of each digest that ``held`` hasn't, clustered by month; ``months`` are the row counts of ``rows``.

    One shuffle deals rows and held digests by month, heavy months in slices by
    digest. It serves the copies, the look-up and the write: a month is one
    file of a task unless it is heavy.
    """
    columns = [c for c in rows.columns if c not in ("ym", "row_digest")]
    both = rows.withColumn("_held", F.lit(False))
    if held is not None:
        both = both.unionByName(held.select(F.col("ym").cast("string"), "row_digest", F.lit(True).alias("_held")), allowMissingColumns=True)
    dealt, by = deal_by_month(both, months, F.col("row_digest"))
    # All rows of a digest are alike, and held ones have no values.
    found = dealt.groupBy(*by, "row_digest").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in columns], F.max("_held").alias("_held"))
    return found.where("NOT _held").select(*rows.columns)


def append_new_rows(target: str, clean: Callable[[DataFrame], DataFrame], date: str,
                    stream: Callable[[SparkSession], str] = lambda spark: "direct",
                    states: Mapping[str, Sequence[str]] | None = None) -> Callable[[DataFrame, int], None]:
    """A batch function writing the unseen rows of a batch below ``target``.

    ``stream`` gives the name under which the stream's batches are numbered;
    ``states`` names the statistics to keep and their keys. ``clean`` may leave copies in.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = stream(spark)
        folder = Part(name, batch_id, ()).folder
        rows = clean(batch)
        rows = rows.withColumn("row_digest", row_digest(rows.columns)).withColumn("ym", month_of(date))
        rows = rows.persist()
        try:
            months = month_counts(rows)
            listed = snapshots.current(spark, target)
            held = snapshots.read(spark, target, listed, "", min(months), max(months), (name, batch_id)) if months else None
            unseen_rows(rows, held, months).write.mode("overwrite").partitionBy("ym").parquet(f"{target}/{folder}")
            part = Part(name, batch_id, snapshots.written_months(spark, f"{target}/{folder}"))
            written = snapshots.read(spark, target, Snapshot(0, (part,)))
            for state, keys in (states or {}).items():
                path = f"{target}/{state_folder(state)}/{folder}"
                if written is not None:
                    _cells(written, keys, date).hint("rebalance", "ym").write.mode("overwrite").partitionBy("ym").parquet(path)
            snapshots.commit(spark, target, listed.with_part(part))
        finally:
            rows.unpersist()

    return write


def stored_rows(spark: SparkSession, target: str, first: str | None = None, last: str | None = None) -> DataFrame | None:
    """The rows of the table, of the months from ``first`` to ``last`` if given."""
    rows = snapshots.read(spark, target, snapshots.current(spark, target), "", first, last)
    return None if rows is None else rows.drop(*_STORED)


def stored_state(spark: SparkSession, target: str, state: str) -> DataFrame | None:
    """All cells of a state; several may stand for one key until they are folded."""
    cells = snapshots.read(spark, target, snapshots.current(spark, target), state_folder(state))
    return None if cells is None else cells.drop(*_STORED)


def _csv(reader, schema: StructType):
    return reader.schema(schema).option("header", True).option("quote", '"').option("escape", '"')


def _files(spark: SparkSession, landing: str, schema: StructType, max_files: int) -> DataFrame:
    return _csv(spark.readStream, schema).option("maxFilesPerTrigger", max_files).csv(landing)


def incremental_ingest(spark: SparkSession, landing: str, schema: StructType, target: str, checkpoint: str,
                       clean: Callable[[DataFrame], DataFrame], date: str = "price_date",
                       max_files: int = 1000, states: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Take in every file not taken in yet, then stop; returns the whole table.

    Copies are dropped here, by digest: a ``clean`` that leaves them in spares a shuffle.

    Safe to run again at any time: done files are skipped by the checkpoint and
    copies of stored rows by their digest, whichever stream stored them.
    """
    files = _files(spark, landing, schema, max_files)
    run = (
        files.writeStream.foreachBatch(append_new_rows(target, clean, date, lambda s: stream_of(s, checkpoint), states))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    rows = stored_rows(spark, target)
    return clean(spark.createDataFrame([], schema)) if rows is None else rows


def compact(spark: SparkSession, target: str, before: str, states: Mapping[str, Sequence[str]] | None = None) -> Snapshot:
    """Rewrite every month below ``before`` (yyyy-MM) that lies in several parts as one part.

    All these months are written to one new folder, cells folded to one per
    key, and switched by one manifest; a rewrite that fails changes nothing. Months are
    clustered by a rebalance, so each takes one file unless it is heavy.
    """
    listed = snapshots.current(spark, target)
    months = tuple(sorted(m for m, n in listed.parts_of().items() if n > 1 and m < before))
    if not months:
        return listed
    chosen = Snapshot(0, tuple(Part(p.stream, p.batch, tuple(m for m in p.months if m in set(months))) for p in listed.parts))
    part = Part(f"compact-{uuid.uuid4().hex}", 0, months)
    rows = snapshots.read(spark, target, chosen).drop("stream", "batch_id")
    rows.hint("rebalance", "ym").write.partitionBy("ym").parquet(f"{target}/{part.folder}")
    for state, keys in (states or {}).items():
        folded = fold_cells(snapshots.read(spark, target, chosen, state_folder(state)), *dict.fromkeys([*keys, "ym"]))
        folded.hint("rebalance", "ym").write.partitionBy("ym").parquet(f"{target}/{state_folder(state)}/{part.folder}")
    after = listed.replacing(months, part)
    snapshots.commit(spark, target, after)
    return after


def _logged(spark: SparkSession, path: str) -> list[dict]:
    """The JSON lines of a checkpoint file."""
    return [json.loads(r[0]) for r in spark.read.text(path).collect() if r[0].startswith("{")]


def watermark_of(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark, in milliseconds, that Spark wrote down for a batch before it began."""
    return int(next(o["batchWatermarkMs"] for o in _logged(spark, f"{checkpoint}/offsets/{batch_id}") if "batchWatermarkMs" in o))


def files_of(spark: SparkSession, checkpoint: str, batch_id: int) -> list[str]:
    """The files that a batch reads, by the log of its one file source."""
    at = lambda b: next(o["logOffset"] for o in _logged(spark, f"{checkpoint}/offsets/{b}") if "logOffset" in o) if b >= 0 else -1
    first, last = at(batch_id - 1) + 1, at(batch_id)
    names = snapshots.folder_names(spark, f"{checkpoint}/sources/0")
    paths: list[str] = []
    for n in range(first, last + 1):
        name = str(n) if str(n) in names else f"{n}.compact"
        paths += [o["path"] for o in _logged(spark, f"{checkpoint}/sources/0/{name}") if o["batchId"] == n]
    return paths


def watermarked_ingest(spark: SparkSession, landing: str, schema: StructType, target: str, checkpoint: str,
                       clean: Callable[[DataFrame], DataFrame], date: str = "price_date", delay: str = "30 days",
                       max_files: int = 1000, parse: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Take in every new file; returns the kept rows and the late ones.

    ``parse`` is ``clean`` with copies left in: the stream goes through it if it is given, since a ``clean`` that
    drops them keeps every row it has seen as state of its own. Late rows go through ``clean``.

    Spark moves the watermark between batches, to the newest date less ``delay``,
    and drops what is not after the watermark of the batch before; such rows, and
    rows without a date, are late. Of the others copies are dropped by
    ``dropDuplicatesWithinWatermark``, whose state forgets digests behind the
    watermark. Late rows come from a second read of the batch's own files and
    are stored as they came, copies included. A batch that is retried overwrites its folder.
    """
    rows = (parse or clean)(_files(spark, landing, schema, max_files))
    columns = rows.columns
    event_time = F.col(date).cast("timestamp")
    kept = (
        rows.withColumn("row_digest", row_digest(columns)).withColumn("event_time", event_time).where("event_time is not null")
        .withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["row_digest"]).select(*columns)
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        edge = F.timestamp_millis(F.lit(watermark_of(spark, checkpoint, batch_id - 1) if batch_id else 0))
        found, files = batch.withColumn("table", F.lit("kept")), files_of(spark, checkpoint, batch_id)
        if files:
            arrived = clean(_csv(spark.read, schema).csv(files))
            found = found.unionByName(arrived.where(event_time.isNull() | (event_time <= edge)).withColumn("table", F.lit("late")))
        # One folder a batch holds both tables, so that one write switches both.
        found = found.withColumn("ym", month_of(date)).persist()
        try:
            dealt, _ = deal_by_month(found, month_counts(found), F.struct(*columns), "table")
            dealt.drop("_slice").write.mode("overwrite").partitionBy("table", "ym").parquet(f"{target}/batch_id={batch_id}")
        finally:
            found.unpersist()

    run = kept.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    plain = StructType(clean(spark.createDataFrame([], schema)).schema.fields)
    stored = spark.read.schema(plain.add("batch_id", "long").add("table", "string").add("ym", "string")).parquet(target)
    table = lambda name: stored.where(F.col("table") == name).drop("batch_id", "table", "ym")
    return table("kept"), table("late")
