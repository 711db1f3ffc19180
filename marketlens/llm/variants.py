"""Grouping of spelling variants by a trie over letter counts.

Every word has a vector: how often it holds the letters of each group, group
after group. Words that differ by one inserted, deleted or replaced letter have
vectors that differ by a surplus of one, a deficit of one, or both. The trie
arranges words by successive counts; a search for the words beside a word walks
it depth first and may spend one surplus and one deficit. Each pair is looked
for from one side only: the first group in which the two differ has to be a
surplus. Words of the leaves that are reached are verified letter by letter.

The top of the trie is walked with joins, ``STRIDE`` counts a round: words
meet the nodes that their counts lead to. A node with up to ``BRANCH_WORDS``
words is a branch, which one task loads and searches depth first; larger nodes
are walked on. Visitors of a branch are dealt over as many copies of it as
their number asks for, so no group of rows grows with the data. Words of a full
vector that exceed a branch are dealt over blocks in the same way.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.settle import settle, settled

LEAST_LETTERS, LEAST_COUNT, FORM_FACTOR = 7, 2, 10
#: A word is damaged if this divides the crc32 of its document and itself.
DAMAGED_EVERY = 31
#: Letters of each count of the vector; letters beyond ASCII fall into two more groups by their code.
GROUPS = ("e", "a", "i", "n", "r", "t", "o", "s", "l", "cd", "mu", "gh", "bp", "fvw", "jkqxyz")
STRIDE = 3
#: Words of a branch, visitors of one copy of it, and pairs compared at a time.
BRANCH_WORDS, VISITORS, PAIRS = 8192, 32_768, 1 << 17
#: Words up to this length are compared as arrays.
ARRAY_LETTERS = 40
#: Distinct words counted by a task before it hands them on.
COUNTED = 200_000

_RUNS = re.compile(rb"[A-Za-z\xc0-\xff]{%d,}" % LEAST_LETTERS)
_OF = np.zeros(256, np.uint8)
for _i, _letters in enumerate(GROUPS):
    _OF[[*_letters.encode()]] = _i
    _OF[[*_letters.upper().encode()]] = _i
_OF[0xC0:] = len(GROUPS) + np.arange(64) % 2
WIDTH = len(GROUPS) + 2


def _words(doc_id, text: str, counts: Counter) -> None:
    data = text.encode("latin-1", "replace")
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(m.lower() for m in _RUNS.findall(data)).items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
        if h % DAMAGED_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LETTERS:
                continue
        counts[run] += n


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` of all words with at least LEAST_LETTERS letters and LEAST_COUNT occurrences in whole texts.

    Null texts hold no words; a null id counts as empty in the digest that
    decides on damage; rows that repeat an id count as often as they stand.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def counted():
            batch = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(counts.values(), pa.int64())], schema=schema)
            counts.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if text.is_valid:
                    _words(doc_id, text.as_py(), counts)
                if len(counts) >= COUNTED:
                    yield counted()
        if counts:
            yield counted()

    return (
        docs.selectExpr("doc_id", "cast(text as string) as text").mapInArrow(run, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)
    )


def letter_counts(word: str) -> bytes:
    """The vector of a word; counts above 255 stay 255, which keeps neighbours beside each other."""
    letters = np.frombuffer(word.encode("latin-1"), np.uint8)
    return np.minimum(np.bincount(_OF[letters], minlength=WIDTH), 255).astype(np.uint8).tobytes()


def with_vectors(words: DataFrame) -> DataFrame:
    """``word, n, vector``."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("vector", pa.binary())])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([letter_counts(w) for w in batch.column(0).to_pylist()], pa.binary())], schema=schema)

    return words.select("word", "n").mapInArrow(run, "word string, n long, vector binary")


def _walk(vector: bytes, key: bytes, spent: int, end: int) -> Iterator[tuple[bytes, int]]:
    """Nodes at depth ``end`` below ``key`` that a vector may visit; ``spent`` is 0, 1 (surplus) or 2 (both)."""
    at = len(key)
    if at == end:
        yield key, spent
        return
    count = vector[at]
    yield from _walk(vector, key + bytes([count]), spent, end)
    if spent == 0 and count < 255:
        yield from _walk(vector, key + bytes([count + 1]), 1, end)
    if spent == 1 and count > 0:
        yield from _walk(vector, key + bytes([count - 1]), 2, end)


_VISITS = "word string, n long, vector binary, node binary, spent int"


def _descend(visits: DataFrame, depth: int) -> DataFrame:
    """Visits to the nodes at ``depth`` from those of nodes above."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("vector", pa.binary()), ("node", pa.binary()), ("spent", pa.int32())])

    def run(batches):
        for batch in batches:
            source, nodes, spents = [], [], []
            for i, (vector, node, spent) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("vector", "node", "spent")], strict=True)):
                for below, cost in _walk(vector, node, spent, depth):
                    source.append(i)
                    nodes.append(below)
                    spents.append(cost)
            at = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(at) for c in ("word", "n", "vector")], pa.array(nodes, pa.binary()), pa.array(spents, pa.int32())], schema=schema)

    return visits.select("word", "n", "vector", "node", "spent").mapInArrow(run, _VISITS)


class _Words:
    """Words as padded arrays of letters, with their vectors."""

    def __init__(self, words: list[str], vectors: list[bytes]):
        self.raw = [w.encode("latin-1") for w in words]
        self.length = np.array([len(r) for r in self.raw], np.int64)
        self.vectors = np.frombuffer(b"".join(vectors), np.uint8).reshape(len(words), WIDTH).astype(np.int16)
        self.letters = np.frombuffer(b"".join(r[:ARRAY_LETTERS].ljust(ARRAY_LETTERS + 1, b"\0") for r in self.raw), np.uint8).reshape(len(words), ARRAY_LETTERS + 1)


def _beside(x: bytes, y: bytes) -> bool:
    """Whether y is x with one letter inserted or replaced."""
    first = next((i for i, (a, b) in enumerate(zip(x, y, strict=False)) if a != b), min(len(x), len(y)))
    return x[first:] == y[first + 1 :] if len(y) == len(x) + 1 else len(x) == len(y) and x != y and x[first + 1 :] == y[first + 1 :]


def _verified(here: _Words, visitors: _Words, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (visitor i, word j) that one insertion or replacement parts; equal vectors are taken in word order."""
    more = here.length[j] - visitors.length[i]
    likely = (more == 0) | (more == 1)
    i, j, more = i[likely], j[likely], more[likely]
    long = here.length[j] > ARRAY_LETTERS
    found = np.zeros(len(i), bool)
    for k in np.flatnonzero(long):
        found[k] = _beside(visitors.raw[i[k]], here.raw[j[k]])
    for extra in (0, 1):
        at = np.flatnonzero(~long & (more == extra))
        a, b = visitors.letters[i[at]], here.letters[j[at]]
        differ = a != b
        if extra == 0:
            found[at] = differ.sum(1) == 1
        else:
            first = differ.argmax(1)
            behind = (a[:, :-1] != b[:, 1:]) & (np.arange(ARRAY_LETTERS) >= first[:, None])
            found[at] = ~behind.any(1)
    equal = np.flatnonzero(found & (more == 0))
    same = (visitors.vectors[i[equal]] == here.vectors[j[equal]]).all(1)
    for k in equal[same]:
        found[k] = visitors.raw[i[k]] < here.raw[j[k]]
    return i[found], j[found]


def search_branch(here: _Words, visitors: _Words, depth: int, spent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (visitor, word) beside each other, by a depth-first walk over the words of a branch."""
    order = np.lexsort(here.vectors[:, depth:].T[::-1]) if depth < WIDTH else np.arange(len(here.raw))
    counts = here.vectors[order]
    stack = [(0, len(order), depth, np.arange(len(visitors.raw)), spent)]
    while stack:
        low, high, depth, who, spent = stack.pop()
        if depth == WIDTH or (high - low) * len(who) <= PAIRS:
            step = max(1, PAIRS // (high - low))
            for k in range(0, len(who), step):
                i, j = np.repeat(np.arange(k, min(k + step, len(who))), high - low), np.tile(np.arange(low, high), min(step, len(who) - k))
                paid = spent[i]
                for d in range(depth, WIDTH):
                    change = counts[j, d] - visitors.vectors[who[i], d]
                    fits = (change == 0) | ((change == 1) & (paid == 0)) | ((change == -1) & (paid == 1))
                    i, j, paid = i[fits], j[fits], paid[fits] + (change[fits] != 0)
                yield _verified(here, visitors, who[i], order[j])
            continue
        column = counts[low:high, depth]
        borders = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist(), high - low]
        for a, b in zip(borders, borders[1:], strict=False):
            change = column[a] - visitors.vectors[who, depth]
            fits = (change == 0) | ((change == 1) & (spent == 0)) | ((change == -1) & (spent == 1))
            if fits.any():
                stack.append((low + a, low + b, depth + 1, who[fits], spent[fits] + (change[fits] != 0)))


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    data, probes = rows[rows["spent"] < 0], rows[rows["spent"] >= 0]
    out = []
    if len(data) and len(probes):
        here, visitors = _Words(data["word"].tolist(), data["vector"].tolist()), _Words(probes["word"].tolist(), probes["vector"].tolist())
        words, word_n = data["word"].to_numpy(), data["n"].to_numpy()
        others, other_n = probes["word"].to_numpy(), probes["n"].to_numpy()
        for i, j in search_branch(here, visitors, len(rows["node"].iloc[0]), probes["spent"].to_numpy()):
            if len(i):
                out.append(pd.DataFrame({"a": others[i], "a_n": other_n[i], "b": words[j], "b_n": word_n[j]}))
    return pd.concat(out) if out else pd.DataFrame({"a": [], "a_n": [], "b": [], "b_n": []}).astype({"a": str, "a_n": "int64", "b": str, "b_n": "int64"})


def near_words(words: DataFrame, branch_words: int = BRANCH_WORDS, visitors: int = VISITORS) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of words that one inserted, deleted or replaced letter parts, once.

    ``words(word, n)`` holds distinct words of letters up to U+00FF. An empty
    table gives no pairs.
    """
    with settled(words.sparkSession) as run:
        words = run.keep(with_vectors(words), "vectors")
        prefix = lambda depth: F.expr(f"substring(vector, 1, {depth})")
        visits, standing, met = words.withColumns({"node": F.lit(b""), "spent": F.lit(0)}), words, []
        for depth in [*range(STRIDE, WIDTH, STRIDE), WIDTH]:
            placed = standing.withColumn("node", prefix(depth))
            sizes = run.keep(placed.groupBy("node").agg(F.count(F.lit(1)).alias("size")), "nodes")
            visits = run.keep(_descend(visits, depth).join(sizes, "node"), "visits")
            branch = (F.col("size") <= branch_words) | F.lit(depth == WIDTH)
            arrived = visits.where(branch)
            loads = run.keep(arrived.groupBy("node", "size").agg(F.count(F.lit(1)).alias("came")), "loads")
            copies = loads.select("node", F.ceil(F.col("came") / visitors).cast("int").alias("copies"), F.ceil(F.col("size") / branch_words).cast("int").alias("blocks"))
            mine = (
                placed.join(copies, "node").withColumn("block", F.expr("pmod(xxhash64(word), blocks)")).withColumn("copy", F.explode(F.expr("sequence(0, copies - 1)")))
                .select("node", "block", "copy", "word", "n", "vector", F.lit(-1).alias("spent"))
            )
            theirs = (
                arrived.join(copies, "node").withColumn("copy", F.expr("pmod(xxhash64(word), copies)")).withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1L)")))
                .select("node", "block", "copy", "word", "n", "vector", "spent")
            )
            both = mine.select(*[F.col(c) for c in theirs.columns]).withColumn("copy", F.col("copy").cast("long")).union(theirs.withColumn("copy", F.col("copy").cast("long")))
            met.append(run.keep(both.groupBy("node", "block", "copy").applyInPandas(_search, "a string, a_n long, b string, b_n long"), "met"))
            heavy = sizes.where(~branch).select("node")
            if heavy.isEmpty():
                break
            standing = placed.join(heavy, "node", "left_semi").select("word", "n", "vector")
            visits = visits.where(~branch).select("word", "n", "vector", "node", "spent")
        found = met[0]
        for more in met[1:]:
            found = found.union(more)
        return settle(found, "near-words")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words with a form. Each form has FORM_FACTOR times the word's count, so chains are short."""
    hops = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = settle(hops.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if further.where("moved").isEmpty():
            return hops
        hops = further.select("word", "root")


def spelling_groups(docs: DataFrame, branch_words: int = BRANCH_WORDS, visitors: int = VISITORS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word (see ``word_counts``).

    ``form`` is the near word with the largest count, the smallest of these by code
    points, if it has FORM_FACTOR times the word's count; ``root`` ends the chain of
    forms. Nulls, repeated rows and empty tables as in ``word_counts``; other columns are left out.
    """
    words = settle(word_counts(docs), "words")
    pairs = near_words(words, branch_words, visitors)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).union(pairs.select("b", "a", "a_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    beside = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    has_form = -F.col("best.less") >= FORM_FACTOR * F.col("n")
    judged = settle(
        words.join(beside, "word", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has_form, F.col("best.form")).alias("form"), F.when(has_form, -F.col("best.less")).alias("form_n")),
        "judged",
    )
    roots = _roots(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
