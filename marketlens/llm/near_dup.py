"""Near-duplicate documents by an inverted join of MinHash coordinates.

1. Texts with the same word sequence form a class; one member stands for it.
   A sketch of a text is a few minimum hashes (coordinates) of its five-word
   shingles.
2. Representatives are posted under every (coordinate, value). Two texts of
   the wanted similarity agree in some number of coordinates at least, which is
   derived from the similarity (they miss with a chance of ``MISS_CHANCE`` at
   most at the threshold itself), so a text
   that meets others in fewer coordinates is skipped. So is one whose full set
   has too few shingles in common with all other candidates together.
3. Of any m agreeing coordinates of n the first lies in a prefix of
   n - m + 1, so only that prefix is joined. In a first
   round each posting list links its members to its hub, the member that meets
   most others, which folds groups of many near copies without their pairs.
4. In a second round lists that still hold several components are joined
   within themselves, only between components, only where sizes and shared
   shingles leave the similarity possible, and only in the first list in which
   two texts agree, so that each pair comes once. A long list is cut into
   blocks, and every two blocks meet in a cell of their own.
5. Every candidate pair is confirmed on its full shingle sets.

A text shorter than five words has its whole sequence as one shingle; one
without words is linked with nothing. A null ``doc_id`` joins no group and has
a null component. Rows that repeat a ``doc_id`` count as one document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.settle import settle
from marketlens.llm import textbytes
from marketlens.llm.components import components

#: Coordinates of a sketch; low similarities take more, so that ``LEAST_MATCHES`` must agree.
COORDINATES = 16
LEAST_MATCHES = 4
#: Chance, over the hash functions, that a pair of exactly the wanted similarity agrees in too few coordinates.
MISS_CHANCE = 2e-6
#: Members of a block of a posting list.
LIST_MEMBERS = 512
#: Members of a list from which on pairs are held against the list's hub before they are joined; this changes no result.
HUB_MEMBERS = 64
SIMILAR_PERCENT = 85
#: Similarity of the pipeline stage.
STAGE_PERCENT = 80


def sketch_sizes(percent: int, miss_chance: float = MISS_CHANCE) -> tuple[int, int]:
    """Coordinates of a sketch, and how many of them two texts of the similarity agree in."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be in 1..100")
    n = COORDINATES
    while True:
        fewer, matches = 0.0, 0
        while matches < n and (fewer := fewer + math.comb(n, matches) * (percent / 100) ** matches * (1 - percent / 100) ** (n - matches)) <= miss_chance:
            matches += 1
        if matches >= LEAST_MATCHES:
            return n, matches
        n += 4


def _hashes(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and flips of the hash function of every coordinate."""
    random = np.random.default_rng(7)
    factors = random.integers(1, 1 << 62, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, random.integers(1, 1 << 63, coordinates, dtype=np.uint64)


SKETCHES = "doc_id long, key_a long, key_b long, n_shingles long, sketch array<long>"


def _sets(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of texts: first, end, word hashes with owners, and distinct shingles with their bounds."""
    data, offsets = textbytes.flat(texts)
    for first, end, chunk, at in textbytes.chunks(data, offsets):
        n = end - first
        words, owner = textbytes.word_hashes(chunk, at)
        shingles, where = textbytes.shingle_hashes(words, owner, n)
        bounds = np.searchsorted(where, np.arange(n + 1))
        own = [np.unique(shingles[bounds[i] : bounds[i + 1]]) for i in range(n)]
        sizes = np.array([len(u) for u in own], np.int64)
        yield first, end, words, owner, np.concatenate(own), np.concatenate([[0], np.cumsum(sizes)])


def sketches(docs: DataFrame, coordinates: int = COORDINATES) -> DataFrame:
    """Word sequence key, set size and MinHash sketch of every text."""
    factors, flips = _hashes(coordinates)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, words, owner, sets, bounds in _sets(batch.column(1)):
                n = end - first
                key_a, key_b = textbytes.sequence_keys(words, owner, n)
                sizes = np.diff(bounds)
                full = np.flatnonzero(sizes)
                lows = np.zeros((len(full), coordinates), np.uint64)
                if len(full):
                    for c in range(coordinates):
                        lows[:, c] = np.minimum.reduceat((sets ^ flips[c]) * factors[c], bounds[:-1][full])
                ends = np.zeros(n + 1, np.int32)
                ends[1:] = np.cumsum(sizes > 0) * coordinates
                held = pa.ListArray.from_arrays(pa.array(ends), pa.array(lows.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(key_a.view(np.int64)), pa.array(key_b.view(np.int64)), pa.array(sizes), held],
                    names=["doc_id", "key_a", "key_b", "n_shingles", "sketch"],
                )

    return _texts(docs).mapInArrow(sketch, SKETCHES)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the sorted distinct shingle hashes of its text."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, _, _, sets, bounds in _sets(batch.column(1)):
                held = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), held], names=["doc_id", "shingles"])

    return _texts(docs).mapInArrow(collect, "doc_id long, shingles array<long>")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _with_keys(docs: DataFrame) -> DataFrame:
    """``doc_id, key_a, key_b, text``."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, words, owner, _, _ in _sets(batch.column(1)):
                key_a, key_b = textbytes.sequence_keys(words, owner, end - first)
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(key_a.view(np.int64)), pa.array(key_b.view(np.int64)), part.column(1)], names=["doc_id", "key_a", "key_b", "text"])

    return _texts(docs).mapInArrow(keyed, "doc_id long, key_a long, key_b long, text string")


def _agreeing(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether sizes, shingles shared with any candidate, and sketches of two texts allow the similarity."""
    n_a, n_b = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return (
        (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent)
        & (F.least(f"{a}.shared", f"{b}.shared") * (100 + percent) >= (n_a + n_b) * percent)
        & (_agreeing(F.col(f"{a}.sketch"), F.col(f"{b}.sketch")) >= sketch_sizes(percent)[1])
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar."""
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return (
        pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
        .where(shared * 100 >= (F.size("set_a") + F.size("set_b") - shared) * percent)
        .select("a", "b")
    )


def _hubs(posts: DataFrame) -> DataFrame:
    """``key, x``: of every list the member that meets the most others."""
    reach = posts.groupBy("doc_id").agg(F.sum("members").alias("reach"))
    return posts.join(reach, "doc_id").groupBy("key").agg(F.max_by(F.struct("doc_id", "n_shingles", "shared", "sketch"), F.struct("reach", -F.col("doc_id"))).alias("x"))


def _star_pairs(posts: DataFrame, percent: int) -> DataFrame:
    """Each member of a list with the list's hub."""
    return (
        posts.alias("y").join(_hubs(posts), "key").where((F.col("x.doc_id") != F.col("y.doc_id")) & _possible("x", "y", percent))
        .select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct()
    )


def _hub_overlaps(posts: DataFrame, sets: DataFrame) -> DataFrame:
    """``doc_id, key, overlap``: the shingles that each member of a long list shares with the list's hub."""
    long = posts.where(F.col("members") >= HUB_MEMBERS)
    hubs = settle(_hubs(long).select("key", F.col("x.doc_id").alias("hub")), "hubs")
    met = long.select("doc_id", "key").join(hubs, "key")
    hub_sets = settle(sets.join(hubs.select(F.col("hub").alias("doc_id")).distinct(), "doc_id", "left_semi").select(F.col("doc_id").alias("hub"), F.col("shingles").alias("hub_set")), "hub-sets")
    counted = (
        met.select("doc_id", "hub").distinct().join(sets, "doc_id").join(hub_sets, "hub")
        .select("doc_id", "hub", F.size(F.array_intersect("shingles", "hub_set")).alias("overlap"))
    )
    return met.join(counted, ["doc_id", "hub"]).select("doc_id", "key", "overlap")


def _beside_hub(a: str, b: str, percent: int) -> Column:
    """Whether what two members share with the hub of their list, and what both have beside it, allows the similarity.

    Their common shingles are in the hub, no more than the smaller overlap, or not, no more than the smaller rest
    of those shared with any text.
    """
    rest = lambda x: F.greatest(F.col(f"{x}.shared") - F.col(f"{x}.overlap"), F.lit(0))
    most = F.least(f"{a}.overlap", f"{b}.overlap") + F.least(rest(a), rest(b))
    return F.coalesce(most * (100 + percent) >= (F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles")) * percent, F.lit(True))


def _cross_pairs(posts: DataFrame, sets: DataFrame, percent: int, list_members: int) -> DataFrame:
    """Possible pairs between the components that meet in a posting list, each in the first list it agrees in."""
    lists = posts.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = lists.where("low < high").select("key", F.ceil(F.col("n") / list_members).cast("int").alias("blocks"))
    several = posts.join(mixed.select("key"), "key", "left_semi")
    cells = settle(
        posts.join(mixed, "key").join(_hub_overlaps(several, sets), ["doc_id", "key"], "left").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("doc_id", "n_shingles", "shared", "overlap", "sketch", "component", "at", "own", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")),
        "cells",
    )
    x, y = cells.alias("x"), cells.alias("y")
    met = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("key", "low", "high")]
    earlier = _agreeing(F.slice("x.sketch", F.lit(1), F.col("x.at")), F.slice("y.sketch", F.lit(1), F.col("x.at"))) == 0
    apart = (F.col("x.component") < F.col("y.component")) & ((F.col("x.low") == F.col("x.high")) | (F.col("x.own") != F.col("y.own")))
    return (
        x.join(y, met[0] & met[1] & met[2] & apart & _possible("x", "y", percent) & _beside_hub("x", "y", percent) & earlier)
        .select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b"))
    )


def near_duplicates(docs: DataFrame, percent: int = SIMILAR_PERCENT, list_members: int = LIST_MEMBERS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every document.

    Documents are linked when ``100 * shared >= percent * united`` shingles;
    ``component_id`` is the smallest ``doc_id`` that links reach. Rows that repeat a ``doc_id`` are one document, whose text is the one with
    the smallest key; a null id, an empty text and a null text are linked with nothing.
    """
    coordinates, matches = sketch_sizes(percent)
    sketched = settle(sketches(docs, coordinates), "sketches")
    several = settle(
        sketched.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("key_a", "key_b")).alias("low"), F.max(F.struct("key_a", "key_b")).alias("high"))
        .where("low <> high").select("doc_id", "low.*"), "repeated-ids",
    )
    if not several.isEmpty():
        # Only ids with different texts: their rows take the values of the chosen text.
        chosen = sketched.join(several, ["doc_id", "key_a", "key_b"], "left_semi").dropDuplicates(["doc_id"])
        rows = sketched.select("doc_id").join(several, "doc_id", "left_semi").join(chosen, "doc_id").select(sketched.columns)
        sketched = settle(sketched.alias("s").join(several.alias("r"), "doc_id", "left_anti").select(sketched.columns).union(rows), "sketches")
        docs = _with_keys(docs).join(several, ["doc_id", "key_a", "key_b"], "left_semi").union(_with_keys(docs).join(several, "doc_id", "left_anti")).select("doc_id", "text")
    classes = settle(
        sketched.where("n_shingles > 0 and doc_id is not null").groupBy("key_a", "key_b")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")),
        "classes",
    )
    posts = classes.select("doc_id", F.posexplode("sketch").alias("at", "value"))
    met = posts.groupBy("at", "value").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("at", "value")
    enough = posts.join(met, ["at", "value"]).groupBy("doc_id").agg(F.count(F.lit(1)).alias("met")).where(F.col("met") >= matches).select("doc_id")
    posted = settle(classes.join(enough, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select("doc_id", "n_shingles", "sketch"), "posted")
    sets = settle(
        shingle_sets(docs.join(posted.select("doc_id").hint("shuffle_hash"), "doc_id", "left_semi")).dropDuplicates(["doc_id"]), "shingle-sets"
    )
    alone = (
        sets.select("doc_id", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id"))
        .where("n = 1").groupBy("doc_id").agg(F.count(F.lit(1)).alias("alone"))
    )
    likely = (
        posted.join(alone, "doc_id", "left").withColumn("shared", F.col("n_shingles") - F.coalesce("alone", F.lit(0)))
        .where(F.col("shared") * 100 >= F.col("n_shingles") * percent)
    )
    prefix = settle(
        likely.select("doc_id", "n_shingles", "shared", "sketch", F.posexplode(F.slice("sketch", 1, coordinates - matches + 1)).alias("at", "value"))
        .withColumn("key", F.xxhash64("at", "value")).drop("value"), "posts",
    )
    sizes = prefix.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    lists = settle(prefix.join(sizes, "key"), "lists")
    stars = settle(_confirmed(_star_pairs(lists, percent), sets, percent), "star-links")
    folded = components(stars)
    coloured = lists.join(folded.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    more = _confirmed(_cross_pairs(coloured, sets, percent, list_members), sets, percent)
    linked = components(stars.union(more)).withColumnRenamed("node", "class_id")
    members = classes.select("key_a", "key_b", F.col("doc_id").alias("class_id")).join(linked, "class_id", "left")
    return (
        sketched.select("doc_id", "n_shingles", "key_a", "key_b").join(members, ["key_a", "key_b"], "left")
        .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.coalesce("component", "class_id", "doc_id")).otherwise(F.col("doc_id")))
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each near-duplicate group stays.

    Rows that repeat a kept ``doc_id`` stay, and so do rows with a null id and empty or null texts; an empty table gives an empty one.
    """
    dropped = settle(near_duplicates(docs, percent=STAGE_PERCENT).where(~F.col("kept")).select("doc_id").distinct(), "dropped")
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)
