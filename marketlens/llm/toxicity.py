"""Toxicity by a factorization machine over hashed terms.

Terms are the words of a text, lower-cased, and their beginnings of a few
lengths, which carry stems through unseen endings. Each is hashed to one of
``BUCKETS`` numbers; a text is the set of its numbers. The machine adds a bias,
a weight per term and, through a short vector per term, a weight for every pair
of terms in the text, so that a word that is harmless alone can count beside
another.

It is fitted on at most ``SAMPLE_ROWS`` labelled rows (those with the smallest
hash of their id, never from the held-out fold). Counts over that sample choose
the terms that get weights and vectors: those that differ most between the
classes by themselves, and those of which a pair does, though neither term alone
may (the odds ratio of the pair differs between the classes). All
bounds are parameters. Scoring is one pass over the whole texts: no shuffle,
and nothing but the model moves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.settle import settle
from marketlens.llm import textbytes

SAMPLE_ROWS = 24_000
BUCKETS = 1 << 20
ACTIVE_TERMS = 2048
BEGINNINGS = (4, 5, 6)
FACTORS = 8
THRESHOLD = 0.3
#: Chi-square of a term below which it gets no weight for itself.
LEAST_CHI_SQUARE = 20.0
#: Terms whose pairs are looked at: those that part the sample most evenly.
PAIR_TERMS = 2048
#: Squared normal deviate of a pair's odds ratios below which its terms get no weight for the pair; chance reaches it in one of some 10^9 pairs.
LEAST_PAIR_SQUARE = 40.0

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def fold(doc_id: Column) -> Column:
    """The fold of a document: crc32 of its id as text, modulo 4."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4))


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word and word beginning, and its text."""
    lowered = textbytes._LOWER_CODES
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = _LETTERS[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    owner = np.searchsorted(offsets, starts, "right") - 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(lowered[data] * textbytes.powers(textbytes._BASE, len(data)), out=sums[1:])
    scale = textbytes.powers(textbytes._BASE_INVERSE, len(data))[starts]
    found, owners = [], []
    for length in (None, *BEGINNINGS):
        rows = slice(None) if length is None else np.flatnonzero(ends - starts > length)
        begin = starts[rows]
        stop = ends[rows] if length is None else begin + length
        hashed = textbytes.mix((sums[stop] - sums[begin]) * scale[rows] + np.uint64(0 if length is None else length))
        found.append((hashed >> np.uint64(44)).astype(np.int64))
        owners.append(owner[rows])
    return np.concatenate(found), np.concatenate(owners)


def _term_sets(texts: pa.Array, numbered: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts: first, end, distinct terms and their texts, sorted by text.

    ``numbered`` maps buckets to the numbers to be used; negative ones are left out.
    """
    data, offsets = textbytes.flat(texts)
    for first, end, chunk, at in textbytes.chunks(data, offsets):
        found, owner = terms(chunk, at)
        if numbered is not None:
            found = numbered[found].astype(np.int64)
            hit = found >= 0
            found, owner = found[hit], owner[hit]
        pairs = np.unique(owner << 20 | found)
        yield first, end, pairs & (BUCKETS - 1), pairs >> 20


def interacting(texts: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """The terms below ``size`` of which some pair's odds ratio differs between the classes beyond ``LEAST_PAIR_SQUARE``."""
    together, totals = [], []
    for side in (False, True):
        rows = [texts[i] for i in np.flatnonzero((labels > 0) == side)]
        both = np.zeros((size, size), np.float32)
        for lo in range(0, len(rows), 1000):
            part = rows[lo : lo + 1000]
            held = np.zeros((len(part), size), np.float32)
            held[np.repeat(np.arange(len(part)), [len(t) for t in part]), np.concatenate(part)] = 1
            both += held.T @ held
        together.append(both)
        totals.append(len(rows))
    highest = np.zeros(size)
    # A strip of the pairs at a time keeps the arrays small.
    for lo in range(0, size, 128):
        strip, odds, spread = slice(lo, min(lo + 128, size)), 0, 0
        for both, total, sign in zip(together, totals, (1, -1), strict=True):
            alone, held = np.diag(both), both[strip]
            cells = [c + 0.5 for c in (held, alone[strip, None] - held, alone[None, :] - held, total - alone[strip, None] - alone[None, :] + held)]
            odds = odds + sign * (np.log(cells[0]) - np.log(cells[1]) - np.log(cells[2]) + np.log(cells[3]))
            spread = spread + sum(1 / c for c in cells)
        square = odds**2 / spread
        square[np.arange(square.shape[0]), np.arange(strip.start, strip.stop)] = 0
        highest[strip] = square.max(axis=1, initial=0)
    return np.flatnonzero(highest >= LEAST_PAIR_SQUARE)


@dataclass
class Machine:
    """A fitted factorization machine over numbered terms."""

    numbered: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def scores(self, n: int, found: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Chance of the label for n texts with the terms of each."""
        return 1 / (1 + np.exp(-np.clip(self._sums(n, found, owner)[0], -30, 30)))

    def _sums(self, n: int, found: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        linear = np.bincount(owner, self.weights[found], n)
        total = np.stack([np.bincount(owner, self.vectors[found, f], n) for f in range(self.vectors.shape[1])], axis=1)
        squares = np.bincount(owner, (self.vectors[found] ** 2).sum(axis=1), n)
        return self.bias + linear + 0.5 * ((total**2).sum(axis=1) - squares), total

    def fit(self, labels: np.ndarray, texts: list[np.ndarray], steps: int = 1000, batch: int = 1024, rate: float = 0.03, decay: float = 5e-5) -> None:
        """Minimise the log loss by Adam over small batches, in a fixed order."""
        random = np.random.default_rng(3)
        parts = [np.array([self.bias]), self.weights, self.vectors]
        first, second, step = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
        while step < steps:
            order = random.permutation(len(labels))
            for lo in range(0, len(order), batch):
                rows = order[lo : lo + batch]
                owner = np.repeat(np.arange(len(rows)), [len(texts[r]) for r in rows])
                found = np.concatenate([texts[r] for r in rows]).astype(np.int64)
                raw, total = self._sums(len(rows), found, owner)
                error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[rows]) / len(rows)
                size = len(self.weights)
                slopes = [
                    np.array([error.sum()]),
                    np.bincount(found, error[owner], size) + decay * self.weights,
                    np.stack([np.bincount(found, error[owner] * (total[owner, f] - self.vectors[found, f]), size) for f in range(total.shape[1])], axis=1)
                    + decay * self.vectors,
                ]
                step += 1
                for p, g, m, v in zip(parts, slopes, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                self.bias = float(parts[0][0])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, active_terms: int = ACTIVE_TERMS, pair_terms: int = PAIR_TERMS) -> Machine:
    """Fit on labelled rows outside the held-out fold.

    Rows with a null label or id are left out; a repeated id counts once, as
    toxic if any of its labels is. Without rows of both classes the machine
    gives every text the class's share (0.5 if there are no rows).
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    chosen = known.where(fold(F.col("doc_id")) != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = settle(_texts(docs).join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "labelled-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            toxic = batch.column(1).to_numpy() > 0
            for first, _, found, owner in _term_sets(batch.column(0)):
                side = toxic[first + owner]
                totals[0] += np.bincount(found[~side], minlength=BUCKETS)
                totals[1] += np.bincount(found[side], minlength=BUCKETS)
        seen = np.flatnonzero(totals.sum(axis=0))
        for lo in range(0, len(seen), 50_000):
            part = seen[lo : lo + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(totals[0][part]), pa.array(totals[1][part])], names=["term", "clean", "toxic"])

    sizes = {r["toxic"] > 0: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = sizes.get(False, 0), sizes.get(True, 0)
    share = (toxic + 0.5) / (clean + toxic + 1)
    machine = Machine(np.full(BUCKETS, -1, np.int16), float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, FACTORS)))
    if not clean or not toxic:
        return machine
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    n, x, y = clean + toxic, F.lit(float(toxic)), F.lit(float(clean))
    chi = n * F.pow(a * (y - b) - b * (x - a), 2) / (x * y * (a + b) * (n - a - b) + 1)
    counted = settle(
        sample.mapInArrow(count, "term long, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .select("term", chi.alias("chi"), ((a + b) * (n - a - b)).alias("evenness")), "term-counts")
    ranked = [r["term"] for r in counted.where(F.col("chi") >= LEAST_CHI_SQUARE).orderBy(F.desc("chi"), "term").limit(active_terms).collect()]
    even = [r["term"] for r in counted.orderBy(F.desc("evenness"), "term").limit(pair_terms).collect()]
    # Terms looked at for pairs come first, then those that count for themselves.
    looked_at = np.full(BUCKETS, -1, np.int16)
    seen = list(dict.fromkeys([*even, *ranked]))
    looked_at[seen] = np.arange(len(seen))
    numbered = sample.sparkSession.sparkContext.broadcast(looked_at)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, found, owner in _term_sets(batch.column(0), numbered.value):
                bounds = np.searchsorted(owner, np.arange(end - first + 1))
                blobs = [found[bounds[i] : bounds[i + 1]].astype(np.int16).tobytes() for i in range(end - first)]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(first, end - first), pa.array(blobs, pa.binary())], names=["toxic", "terms"])

    rows = sample.mapInArrow(number, "toxic int, terms binary").collect()
    rows.sort(key=lambda r: (bytes(r["terms"]), r["toxic"]))
    marks, texts = np.array([r["toxic"] > 0 for r in rows], float), [np.frombuffer(r["terms"], np.int16) for r in rows]
    paired = interacting([t[t < len(even)] for t in texts], marks, len(even))
    kept = list(dict.fromkeys([*ranked, *(seen[i] for i in paired)]))
    machine.numbered[kept] = np.arange(len(kept))
    machine.weights, machine.vectors = np.zeros(len(kept)), np.random.default_rng(5).normal(0, 0.02, (len(kept), FACTORS))
    own = machine.numbered[np.array(seen, np.int64)] if seen else np.zeros(0, np.int16)
    machine.fit(marks, [own[t][own[t] >= 0] for t in texts])
    return machine


def score(docs: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score as ``name``; a null text scores as an empty one."""
    model = docs.sparkSession.sparkContext.broadcast(machine)
    # The text travels once, inside the row.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.withColumn("text", F.col("text").cast("string")).select(row.alias("row"))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, found, owner in _term_sets(batch.column(0).field("text"), model.value.numbered):
                rated = model.value.scores(end - first, found, owner)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(rated)], names=["row", "rated"])

    return packed.mapInArrow(rate, f"row {packed.schema['row'].dataType.simpleString()}, rated double").select("row.*", F.col("rated").alias(name))


def toxic_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    machine = train(docs, labels)
    return score(docs.select("doc_id", "text"), machine).select(
        "doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the machine finds toxic go.

    Null and empty texts have the score of no terms; rows with null or repeated ids are judged one by one; an
    empty table gives an empty one. Columns keep their names, whatever they are.
    """
    name = "toxicity"
    while name in docs.columns:
        name += "_"
    scored = score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), name)
    return scored.where(F.col(name) < THRESHOLD).select(docs.columns)
