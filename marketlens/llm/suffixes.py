"""Removal of long repeated byte strings by sorted sampled suffixes.

A text's windows are its byte strings of ``WIDTH`` bytes. Every window picks
an *anchor* in itself: the leftmost of its ``SEED``-byte grams with the least
hash. Equal windows pick the same anchor, and neighbouring windows mostly share
theirs, so the suffixes that begin at anchors (about one in 85 bytes) meet at
every repeat although the others are never formed.

1. Each anchor gives a suffix row: leading token (hash of the gram), context
   token (hash of all bytes of the windows that picked it) and place.
2. Sampled splitters deal the suffixes by leading tokens into ranges. A bucket
   sorts its rows by multikey quicksort and compares neighbours; runs at the
   two ends of a bucket are compared across the boundaries, so that a hot
   token may fill several buckets.
3. An anchor whose context is repeated as a whole has all its windows
   repeated. One whose token is unique has none. What is left lies at the
   borders of repeats: those contexts are cut from the texts and their windows
   compared one by one; a token with very many contexts is compared by
   counting its windows in Spark instead of in one task.

Hashes have 64 bits and only meet within a leading token. A null text is
empty. Null ids and rows that repeat an id are documents like any others:
a row is known by its id and a stamp of its text, and rows equal in both have
equal texts, so equal results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.settle import delete_path, fresh_path, settle
from marketlens.llm import textbytes

WIDTH = 200
SEED = 32
#: Suffixes that a bucket holds about.
BUCKET_SUFFIXES = 400_000
#: Contexts of one leading token that one task compares; above, windows are counted in Spark.
TOKEN_CONTEXTS = 20_000
#: Windows that are compared at once.
BATCH_WINDOWS = 800_000

SUFFIXES = "doc_id long, stamp long, token long, context long, at int, back short, ahead short"
_SUFFIX_TYPES = [("doc_id", pa.int64()), ("stamp", pa.int64()), ("token", pa.int64()), ("context", pa.int64()), ("at", pa.int32()), ("back", pa.int16()), ("ahead", pa.int16())]


def _slide_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``values[i : i + width]`` for every i where it fits."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of concatenated texts: text, anchor, first and last window start (absolute), token, context."""
    none = np.zeros(0, np.int64)
    if len(data) < WIDTH:
        return none, none, none, none, none, none
    grams = textbytes.window_hashes(data, SEED)
    keyed = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    chosen = (_slide_minimum(keyed, WIDTH - SEED + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    owner = np.repeat(np.arange(len(offsets) - 1), np.maximum(np.diff(offsets) - WIDTH + 1, 0))
    if not len(owner):
        return none, none, none, none, none, none
    counts = np.maximum(np.diff(offsets) - WIDTH + 1, 0)
    starts = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[owner]
    chosen = chosen[starts]
    new = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])]))
    last = np.concatenate([starts[new[1:] - 1], starts[-1:]])
    first, at, owner = starts[new], chosen[new], owner[new]
    context = textbytes.span_hashes(textbytes.prefix_sums(data), first, last + WIDTH)
    context = textbytes.mix(context + (at - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return owner, at, first, last, grams[at].view(np.int64), context.view(np.int64)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = textbytes.flat(batch.column(2))
        ids, stamps = batch.column(0), batch.column(1)
        for begin, _, chunk, bounds in textbytes.chunks(data, offsets):
            owner, at, first, last, token, context = anchors(chunk, bounds)
            rows = pa.array(owner + begin)
            yield pa.RecordBatch.from_arrays(
                [ids.take(rows), stamps.take(rows), pa.array(token), pa.array(context), pa.array((at - bounds[owner]).astype(np.int32)),
                 pa.array((at - first).astype(np.int16)), pa.array((last - at).astype(np.int16))],
                schema=pa.schema(_SUFFIX_TYPES),
            )


def multikey_order(columns: list[np.ndarray], small: int = 4096) -> np.ndarray:
    """Order of rows by several columns: multikey quicksort.

    A segment is parted in three by a pivot of the current column; only the
    middle part, equal in it, goes on to the next column. Small segments are
    sorted at once.
    """
    order = np.arange(len(columns[0]))
    open_segments = [(0, len(order), 0)]
    while open_segments:
        lo, hi, depth = open_segments.pop()
        if depth == len(columns) or hi - lo < 2:
            continue
        rows = order[lo:hi]
        if hi - lo <= small:
            order[lo:hi] = rows[np.lexsort([c[rows] for c in reversed(columns[depth:])])]
            continue
        values = columns[depth][rows]
        pivot = np.sort(values[:: max(1, len(values) // 64)])[32 if len(values) >= 64 else 0]
        less, more = values < pivot, values > pivot
        parts = rows[less], rows[~less & ~more], rows[more]
        order[lo:hi] = np.concatenate(parts)
        for part, deeper in zip(parts, (0, 1, 0), strict=True):
            open_segments.append((lo, lo + len(part), depth + deeper))
            lo += len(part)
    return order


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort a bucket and keep the rows whose token is repeated or stands at an end."""
    from pyspark import TaskContext

    bucket = TaskContext.get().partitionId()
    table = pa.Table.from_batches(list(batches), pa.schema(_SUFFIX_TYPES))
    if not table.num_rows:
        return
    token, context = table["token"].to_numpy(), table["context"].to_numpy()
    order = multikey_order([token, context])
    token, context = token[order], context[order]
    new_token = np.concatenate([[True], token[1:] != token[:-1]])
    new_context = new_token | np.concatenate([[True], context[1:] != context[:-1]])
    run = np.cumsum(new_token) - 1
    ranked = np.cumsum(new_context) - 1
    same = np.bincount(ranked)[ranked] > 1
    repeated = np.bincount(run)[run] > 1
    mixed = np.bincount(run, new_context)[run] > 1
    edge = (run == 0) | (run == run[-1])
    keep = np.flatnonzero(repeated | edge)
    rows = table.take(pa.array(order[keep]))
    for name, flags in (("repeated", repeated), ("same", same), ("lead", new_context), ("mixed", mixed), ("edge", edge)):
        rows = rows.append_column(name, pa.array(flags[keep]))
    rows = rows.append_column("bucket", pa.array(np.full(len(keep), bucket, np.int32)))
    yield from rows.combine_chunks().to_batches(max_chunksize=20_000)


def repeated_suffixes(texts: DataFrame, bucket_suffixes: int = BUCKET_SUFFIXES) -> DataFrame:
    """Stored anchors of ``texts(doc_id, stamp, text)`` whose leading token is repeated.

    ``same``: the whole context is repeated; ``lead``: first of equal contexts
    in its bucket; ``mixed``: the token has several contexts.
    """
    spark = texts.sparkSession
    path = fresh_path(spark, "suffixes")
    texts.mapInArrow(_suffixes, SUFFIXES).write.parquet(path)
    rows = spark.read.schema(SUFFIXES).parquet(path)
    buckets = -(-rows.count() // bucket_suffixes) or 1
    sorted_rows = settle(
        rows.repartitionByRange(buckets, "token", "context", "doc_id", "at")
        .mapInArrow(_compare, SUFFIXES + ", repeated boolean, same boolean, lead boolean, mixed boolean, edge boolean, bucket int"), "sorted-suffixes",
    )
    delete_path(spark, path)
    ends = sorted_rows.where("edge").select("token", "context", "bucket").distinct()
    # Each boundary adds one row to either table at most; both are stored, so that their size decides how they are joined.
    spans = settle(ends.groupBy("token").agg(F.countDistinct("bucket").alias("n")).where("n > 1").select("token", F.lit(True).alias("token_spans")), "token-spans")
    equal = settle(ends.groupBy("token", "context").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("token", "context", F.lit(True).alias("context_spans")), "context-spans")
    return (
        sorted_rows.join(spans, "token", "left").join(equal, ["token", "context"], "left")
        .withColumn("same", F.col("same") | F.coalesce("context_spans", F.lit(False)))
        .withColumn("mixed", F.col("mixed") | F.coalesce("token_spans", F.lit(False)))
        .where(F.col("repeated") | F.coalesce("token_spans", F.lit(False)))
        .select("doc_id", "stamp", "token", "at", "back", "ahead", "same", "mixed", "lead")
    )


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes in the half-open ``spans``."""
    merged: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if merged and lo <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return merged


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(text)]
    return b"".join(text[lo:hi] for lo, hi in zip(edges[::2], edges[1::2], strict=True))


def digest_row(text: bytes, spans: list[tuple[int, int]]) -> tuple:
    """``n_bytes, n_removed, n_spans, kept_sha256``."""
    return len(text), sum(hi - lo for lo, hi in spans), len(spans), hashlib.sha256(_without(text, spans)).hexdigest()


def cleaned_row(text: bytes, spans: list[tuple[int, int]]) -> tuple:
    """The text without the characters that lie whole in a span."""
    whole = []
    for lo, hi in spans:
        while lo < hi and text[lo] & 0xC0 == 0x80:
            lo += 1
        while hi < len(text) and hi > lo and text[hi] & 0xC0 == 0x80:
            hi -= 1
        if lo < hi:
            whole.append((lo, hi))
    return (_without(text, whole).decode(),)


DIGEST = "n_bytes long, n_removed long, n_spans long, kept_sha256 string", digest_row


def _rows(values: list[tuple], schema: pa.Schema) -> list[pa.Array]:
    columns = zip(*values, strict=True) if values else [[] for _ in schema]
    return [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)]


def remove_repeats(docs: DataFrame, output: tuple[str, Callable] = DIGEST, token_contexts: int = TOKEN_CONTEXTS, bucket_suffixes: int = BUCKET_SUFFIXES) -> DataFrame:
    """Every row of ``docs`` without ``text``, with columns made from the text and its repeated spans.

    ``output`` is a schema and a function of the text's bytes and the merged
    spans, such as ``DIGEST``. Columns of ``docs`` with a name of that schema
    give way.
    """
    fields, make = output
    made = _arrow_schema(docs.sparkSession, fields)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text" and c not in made.names])
    base = docs.select(row.alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("stamp", F.xxhash64("text"))
    found = settle(repeated_suffixes(base.select("doc_id", "stamp", "text"), bucket_suffixes), "repeated-suffixes")
    border = (~F.col("same")) | (F.col("lead") & F.col("mixed"))
    # Stored, so that its size is known: it is broadcast while it is small, and a hot token's rows stay where they are.
    many = settle(found.where(border).groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > token_contexts).select("token", F.lit(True).alias("many")), "hot-tokens")
    place = F.struct("token", F.coalesce("many", F.lit(False)).alias("many"), F.col("same").alias("known"), F.col("at") - F.col("back"), F.col("at") + F.col("ahead"))
    per_row = found.join(many, "token", "left").groupBy("doc_id", "stamp").agg(
        F.collect_list(F.when(F.col("same"), F.struct((F.col("at") - F.col("back")).alias("lo"), (F.col("at") + F.col("ahead") + WIDTH).alias("hi")))).alias("spans"),
        F.collect_list(F.when(border, place)).alias("places"),
    )
    joined = base.join(per_row.hint("shuffle_hash"), ["doc_id", "stamp"], "left").select("row", "doc_id", "stamp", "text", "spans", "places")
    row_type = docs.select(row.alias("row")).schema["row"].dataType.simpleString()
    contexts_type = "array<struct<token:bigint,many:boolean,known:boolean,lo:int,hi:int>>"
    spans_type = "array<struct<lo:int,hi:int>>"

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                spans, places = part.column(4).to_pylist(), part.column(5)
                pending = [bool(x) and not all(p["known"] for p in x) for x in places.to_pylist()]
                texts = part.column(3).to_pylist()
                done = [(None,) * len(made) if wait else make(t.encode(), merge_spans([(s["lo"], s["hi"]) for s in x or []]))
                        for t, x, wait in zip(texts, spans, pending, strict=True)]
                keep = pa.array([bool(x) for x in places.to_pylist()])
                held = [pa.array([t if k else None for t, k in zip(texts, keep.to_pylist(), strict=True)], pa.string()), part.column(4), places]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], *_rows(done, made), *held, pa.array(pending)],
                    names=["row", "doc_id", "stamp", *made.names, "text", "spans", "places", "pending"],
                )

    parted = settle(joined.mapInArrow(
        first_pass, f"row {row_type}, doc_id long, stamp long, {fields}, text string, spans {spans_type}, places {contexts_type}, pending boolean"), "parted-texts")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("stamp", pa.int64()), ("token", pa.int64()), ("many", pa.bool_()), ("known", pa.bool_()), ("lo", pa.int32()), ("bytes", pa.binary())])
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                rows = []
                for doc_id, stamp, text, places in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                    data = text.encode()
                    rows += [(doc_id, stamp, p["token"], p["many"], p["known"], p["lo"], data[p["lo"] : p["hi"] + WIDTH]) for p in places]
                yield pa.RecordBatch.from_arrays(_rows(rows, schema), schema=schema)

    cut = settle(parted.where("text is not null").select("doc_id", "stamp", "text", "places").mapInArrow(
        contexts, "doc_id long, stamp long, token long, many boolean, known boolean, lo int, bytes binary"), "contexts")
    few = cut.where("not many").repartition(F.col("token")).sortWithinPartitions("token").mapInArrow(_repeated_windows, "doc_id long, stamp long, lo int, hi int")
    counted = cut.where("many").mapInArrow(_windows, "doc_id long, stamp long, known boolean, window long, lo int")
    often = counted.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window")
    hot = counted.where("not known").join(often, "window").select("doc_id", "stamp", "lo", (F.col("lo") + WIDTH).alias("hi"))
    windows = few.union(hot).groupBy("doc_id", "stamp").agg(F.collect_set(F.struct("lo", "hi")).alias("more"))

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                done = [make(t.encode(), merge_spans([(s["lo"], s["hi"]) for s in [*(x or []), *(y or [])]]))
                        for t, x, y in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *_rows(done, made)], names=["row", *made.names])

    finished = parted.where("not pending").select("row", *made.names)
    late = (
        parted.where("pending").join(windows.hint("shuffle_hash"), ["doc_id", "stamp"], "left")
        .select("row", "text", "spans", "more").mapInArrow(second_pass, f"row {row_type}, {fields}")
    )
    return finished.union(late).select("row.*", *made.names)


def _arrow_schema(spark, fields: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], fields).schema)


def _expand(blobs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, context number and start in its context of every window."""
    data, offsets = textbytes.flat(blobs)
    counts = np.diff(offsets) - WIDTH + 1
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return textbytes.window_hashes(data, WIDTH)[offsets[owner] + inside], owner, inside


def _repeated_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of contexts that come sorted by token, as spans."""
    schema = pa.schema([("doc_id", pa.int64()), ("stamp", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])

    def solve(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        hashes, owner, inside = _expand(table["bytes"])
        known = table["known"].to_numpy()
        _, which, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        hit = np.flatnonzero((counts[which] > 1) & ~known[owner])
        owner, inside = owner[hit], inside[hit]
        lead = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1] + 1)])) if len(hit) else hit
        tail = np.concatenate([lead[1:] - 1, [len(hit) - 1]]).astype(np.int64) if len(hit) else hit
        rows = pa.array(owner[lead])
        base = table["lo"].to_numpy()[owner[lead]]
        return pa.RecordBatch.from_arrays(
            [table["doc_id"].combine_chunks().take(rows), table["stamp"].combine_chunks().take(rows),
             pa.array((base + inside[lead]).astype(np.int32)), pa.array((base + inside[tail] + WIDTH).astype(np.int32))], schema=schema)

    held: pa.Table | None = None
    for batch in batches:
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if held["bytes"].nbytes < BATCH_WINDOWS * 3:
            continue
        tokens = held["token"].to_numpy()
        whole = int(np.searchsorted(tokens, tokens[-1]))
        if whole:
            yield solve(held.slice(0, whole))
            held = held.slice(whole)
    if held is not None and held.num_rows:
        yield solve(held)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of every context."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            hashes, owner, inside = _expand(part.column(6))
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(rows), part.column(1).take(rows), part.column(4).take(rows), pa.array(hashes.view(np.int64)),
                 pa.array((part.column(5).to_numpy()[owner] + inside).astype(np.int32))],
                names=["doc_id", "stamp", "known", "window", "lo"],
            )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without their repeated passages; ``n_chars`` follows.

    A null text becomes an empty one; repeated rows are copies of each other and lose what they share; an empty table gives an empty one.
    """
    name = "cleaned"
    while name in docs.columns:
        name += "_"
    cleaned = remove_repeats(docs, (f"{name} string", cleaned_row)).withColumnRenamed(name, "text")
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(docs.columns)
