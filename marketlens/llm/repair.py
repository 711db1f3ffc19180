"""Repair of the turn structure of conversations at the least cost.

A conversation is sound if the initials of its roles read ``s?(ua)+`` or if it
is empty. Rows may be kept, given the role user or assistant, deleted, or
empty turns may be inserted, each at its price; a least-cost edit is a shortest
path over four states (nothing yet, after system, after user, after assistant).

The costs still to come are a vector over the states. Less its least entry it
takes few values only, so the step over every block of ``BLOCK`` row symbols
from every such vector is put into a table once (the Four Russians' method).
Blocks are passed by lookup from the last to the first; to write down the edits
each block is expanded backward from the vector at its end, row by row, and the
least letter that keeps the cost is taken from the front.

Rows are sorted over ranges of (conversation, turn), so that a conversation of
any length is shared by many tasks. A task cuts its rows into chunks and
sums each up as a matrix of costs from state to state. Only conversations of
several chunks pass their matrices, one small row a chunk, through one task to
learn the vector behind each chunk. A SHA-256 of a whole conversation is
sequential by nature: the chunks of such conversations stream in order through
one task that holds one chunk at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.settle import settle, settled

#: Prices of the edits; an undeleted truncated row costs TRUNCATED more.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Symbols passed by one lookup.
BLOCK = 4
#: A chunk ends with this many rows or bytes of text.
CHUNK_ROWS, CHUNK_BYTES = 4096, 1 << 20
#: Characters of a text that take part in cutting ranges; rows inside a range are sorted by whole texts.
RANGE_LETTERS = 32

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: Row symbols: initial s, u, a or another, for sound rows (0-3), truncated ones (4-7) and rows that have to go (8-11).
MUST_GO = 8
_NEVER = 1 << 40
_AFTER_INSERT = (USER, USER, ASSISTANT, USER)
_NAMES = {USER: "user", ASSISTANT: "assistant"}

def _kept(state: int, initial: int) -> int | None:
    """The state after a kept row."""
    if initial == 0:
        return SYSTEM if state == NOTHING else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def _before(symbol: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to come before a row, from those behind it."""
    rows = []
    for state in range(STATES):
        costs = [DELETE + behind[state]]
        if symbol < MUST_GO:
            extra = TRUNCATED if symbol >= 4 else 0
            kept = _kept(state, symbol % 4)
            if kept is not None:
                costs.append(extra + behind[kept])
            costs.append(extra + RENAME + behind[_AFTER_INSERT[state]])
        rows.append(min(costs))
    return _with_inserts(rows)


def _with_inserts(costs) -> tuple[int, ...]:
    once = [min(c, INSERT + costs[_AFTER_INSERT[s]]) for s, c in enumerate(costs)]
    return tuple(min(_NEVER, c, INSERT + once[_AFTER_INSERT[s]]) for s, c in enumerate(once))


def _less_least(vector) -> tuple[int, tuple[int, ...]]:
    least = min(vector)
    return least, tuple(_NEVER if v >= _NEVER else v - least for v in vector)


#: Costs behind the last row.
END = _with_inserts([0, _NEVER, _NEVER, 0])


class Tables:
    """Transitions of normalised cost vectors over single symbols and over blocks."""

    def __init__(self):
        units = [_with_inserts([0 if s == j else _NEVER for s in range(STATES)]) for j in range(STATES)]
        self.vectors: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}
        for v in (END, *units):
            self._add(_less_least(v)[1])
        step, gain, done = [], [], 0
        while done < len(self.vectors):
            moves = [_less_least(_before(s, self.vectors[done])) for s in range(MUST_GO + 1)]
            gain.append([m[0] for m in moves])
            step.append([self._add(m[1]) for m in moves])
            done += 1
        self.step, self.gain = step, gain
        width = MUST_GO + 1
        to = np.tile(np.arange(len(step))[:, None], (1, width**BLOCK))
        add = np.zeros_like(to)
        blocks = np.array(list(product(range(width), repeat=BLOCK)))
        one, price = np.array(step), np.array(gain)
        for at in range(BLOCK - 1, -1, -1):
            add += price[to, blocks[:, at]]
            to = one[to, blocks[:, at]]
        self.block_step, self.block_gain, self.powers = to, add, [width**i for i in range(BLOCK - 1, -1, -1)]

    def _add(self, vector: tuple[int, ...]) -> int:
        if vector not in self.number:
            self.number[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.number[vector]

    def borders(self, symbols: bytes, behind: int) -> tuple[list[int], list[int], int]:
        """Ends of the blocks, the vectors there, and the cost passed, from the last block to the first.

        The first entry of the lists is the end of the symbols; the last is their beginning.
        """
        ends, vectors, cost, end = [len(symbols)], [behind], 0, len(symbols)
        while end >= BLOCK:
            code = sum(min(s, MUST_GO) * p for s, p in zip(symbols[end - BLOCK : end], self.powers, strict=True))
            cost += int(self.block_gain[behind, code])
            behind = int(self.block_step[behind, code])
            end -= BLOCK
            ends.append(end)
            vectors.append(behind)
        while end:
            symbol = min(symbols[end - 1], MUST_GO)
            cost += self.gain[behind][symbol]
            behind = self.step[behind][symbol]
            end -= 1
            ends.append(end)
            vectors.append(behind)
        return ends, vectors, cost

    def matrix(self, symbols: bytes) -> list[int]:
        """Least costs from each state before the symbols to each state behind them, row by row."""
        columns = []
        for j in range(STATES):
            unit = _less_least(_with_inserts([0 if s == j else _NEVER for s in range(STATES)]))[1]
            _, vectors, cost = self.borders(symbols, self.number[unit])
            columns.append([min(_NEVER, cost + v) for v in self.vectors[vectors[-1]]])
        return [columns[j][s] for s in range(STATES) for j in range(STATES)]

    def trace(self, symbols: bytes, behind: int, state: int) -> tuple[str, int]:
        """The least letters of a cheapest edit from ``state``, and the state behind the symbols."""
        ends, vectors, _ = self.borders(symbols, behind)
        letters = []
        for k in range(len(ends) - 1, 0, -1):
            first, end = ends[k], ends[k - 1]
            inner = [vectors[k - 1]]
            for at in range(end - 1, first - 1, -1):
                inner.append(self.step[inner[-1]][min(symbols[at], MUST_GO)])
            for at in range(first, end):
                after = inner[end - at - 1]
                symbol = min(symbols[at], MUST_GO)
                here, there, gain = self.vectors[inner[end - at]], self.vectors[after], self.gain[after][symbol]
                while True:
                    cost = here[state] + gain
                    extra, kept = TRUNCATED if symbol >= 4 else 0, _kept(state, symbol % 4)
                    if DELETE + there[state] == cost:
                        letters.append("D")
                    elif INSERT + here[_AFTER_INSERT[state]] + gain == cost:
                        letters.append("I")
                        state = _AFTER_INSERT[state]
                        continue
                    elif symbol < MUST_GO and kept is not None and extra + there[kept] == cost:
                        letters.append("K")
                        state = kept
                    else:
                        letters.append("R")
                        state = _AFTER_INSERT[state]
                    break
        return "".join(letters), state


@cache
def tables() -> Tables:
    """The worker's tables."""
    return Tables()


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv, turn, role, text, copies``: the rows after damage, equal ones counted.

    The remainder by 20 of the crc32 of ``conv_id:turn`` drops a row (0),
    empties its text (1), removes its sentence ends (2), doubles it (3) or gives
    it the role user (4). A null counts as one space in the digest, in roles and in texts.
    """
    rows = conversations.select(
        _key().alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.pmod(F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])), F.lit(20)).alias("damage"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    ).where("damage > 0")
    damage = F.col("damage")
    return (
        rows.select("conv", "turn", F.when(damage == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(damage == 1, "").when(damage == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    F.when(damage == 3, 2).otherwise(1).alias("copy"))
        .groupBy("conv", "turn", "role", "text").agg(F.sum("copy").alias("copies"))
    )


def undamaged(conversations: DataFrame) -> DataFrame:
    """The same columns without damage: ``repair_pieces`` on a table as it is."""
    return conversations.select(
        _key().alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    ).groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))


def _key():
    """A conversation's id as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def with_faults(rows: DataFrame, run) -> DataFrame:
    """``rows`` with ``symbol`` of the first of the equal rows and ``fault`` (null, blank, duplicate, truncated).

    A row is a duplicate if its role and text stand at an earlier turn; of
    equal rows of one turn all but the first are duplicates too.
    """
    turn_key = F.struct(F.col("turn").isNotNull().alias("given"), "turn")
    same = ["conv", "role", "digest"]
    keyed = rows.withColumn("digest", F.sha2("text", 256))
    repeated = run.keep(
        keyed.groupBy(*same).agg(F.min(turn_key).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1").select(*same, "first"), "repeated")
    stripped = F.rtrim("text", F.lit(" \t\n\x0b\f\r"))
    fault = (
        F.when(stripped == "", "blank").when(F.col("first").isNotNull() & (turn_key > F.col("first")), "duplicate")
        .when(~F.substring(stripped, -1, 1).isin(".", "!", "?"), "truncated")
    )
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    kind = F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).when(F.col("fault") == "truncated", 4).otherwise(0)
    return keyed.join(repeated, same, "left").withColumn("fault", fault).select("conv", "turn", "role", "text", "copies", "fault", (number + kind).cast("int").alias("symbol"))


_CHUNK = pa.schema([
    ("conv", pa.string()), ("place", pa.int64()), ("symbols", pa.binary()), ("matrix", pa.list_(pa.int64())), ("illegal", pa.int64()),
    ("first", pa.int32()), ("last", pa.int32()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
])
_CHUNK_DDL = "conv string, place long, symbols binary, matrix array<long>, illegal long, first int, last int, roles array<string>, texts array<string>"
_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _chunk_row(conv: str, place: int, symbols: bytearray, roles: list, texts: list) -> tuple:
    illegal = sum((a % 4, b % 4) not in _LEGAL for a, b in zip(symbols, symbols[1:], strict=False))
    data = bytes(symbols)
    return conv, place, data, tables().matrix(data), illegal, symbols[0] % 4, symbols[-1] % 4, roles, texts


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _chunks(batches: Iterator[pa.RecordBatch], chunk_rows: int) -> Iterator[pa.RecordBatch]:
    """Chunks of the sorted rows of one range; texts of rows that have to go are left out."""
    place = TaskContext.get().partitionId() << 32
    conv, symbols, roles, texts, size, done, done_size = None, bytearray(), [], [], 0, [], 0
    for batch in batches:
        for c, symbol, copies, role, text in zip(*[batch.column(n).to_pylist() for n in ("conv", "symbol", "copies", "role", "text")], strict=True):
            while copies:
                if symbols and (c != conv or len(symbols) >= chunk_rows or size >= CHUNK_BYTES):
                    done.append(_chunk_row(conv, place, symbols, roles, texts))
                    place, symbols, roles, texts, done_size, size = place + 1, bytearray(), [], [], done_size + size, 0
                    if done_size >= CHUNK_BYTES or len(done) >= chunk_rows:
                        yield _record(done, _CHUNK)
                        done, done_size = [], 0
                conv = c
                if symbol < MUST_GO:
                    roles.append(role)
                    texts.append(text)
                    size += len(role) + len(text)
                    symbols.append(symbol)
                    copies -= 1
                    symbol = MUST_GO + symbol % 4
                else:
                    run = min(copies, chunk_rows - len(symbols))
                    symbols += bytes([symbol]) * run
                    copies -= run
    if symbols:
        done.append(_chunk_row(conv, place, symbols, roles, texts))
    if done:
        yield _record(done, _CHUNK)


_BEHIND = pa.schema([("conv", pa.string()), ("place", pa.int64()), ("behind", pa.list_(pa.int64())), ("cost", pa.int64()), ("border", pa.int64()), ("final", pa.bool_())])
_BEHIND_DDL = "conv string, place long, behind array<long>, cost long, border long, final boolean"


def _costs_behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From chunks in falling order: the costs behind each and from its beginning on, whether the pair of rows
    at its end is illegal, and whether it is the conversation's last."""
    conv, vector, following = None, list(END), None
    for batch in batches:
        out = []
        for c, place, matrix, first, last in zip(*[batch.column(n).to_pylist() for n in ("conv", "place", "matrix", "first", "last")], strict=True):
            if c != conv:
                conv, vector, following = c, list(END), None
            ahead = [min(_NEVER, *(matrix[s * STATES + j] + vector[j] for j in range(STATES))) for s in range(STATES)]
            out.append((c, place, vector, ahead[NOTHING], int(following is not None and (last, following) not in _LEGAL), following is None))
            vector, following = ahead, first
        if out:
            yield _record(out, _BEHIND)


_PIECE = pa.schema([("conv", pa.string()), ("place", pa.int64()), ("cost", pa.int64()), ("illegal", pa.int64()), ("audit", pa.string()),
                    ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])
_PIECE_DDL = "conv string, place long, cost long, illegal long, audit string, repaired array<struct<role:string,text:string>>"


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of chunks; those of one conversation come together and in order."""
    table = tables()
    conv, state = None, NOTHING
    for batch in batches:
        out, size = [], 0
        columns = ("conv", "place", "cost", "illegal", "symbols", "roles", "texts", "behind", "final")
        for c, place, cost, illegal, symbols, roles, texts, behind, final in zip(*[batch.column(n).to_pylist() for n in columns], strict=True):
            if c != conv:
                conv, state = c, NOTHING
            entered = state
            letters, state = table.trace(symbols, table.number[_less_least(behind)[1]], entered)
            if final:
                letters += "I" * {SYSTEM: 2, USER: 1}.get(state, 0)
            out.append((c, place, cost, illegal, letters, _repaired(letters, symbols, roles, texts, entered)))
            size += sum(map(len, texts))
            if size >= CHUNK_BYTES:
                yield _record(out, _PIECE)
                out, size = [], 0
        if out:
            yield _record(out, _PIECE)


def _repaired(letters: str, symbols: bytes, roles: list, texts: list, state: int) -> list[dict]:
    """The rows that the edits leave."""
    rows, at, held = [], 0, 0
    for letter in letters:
        if letter == "I":
            state = _AFTER_INSERT[state]
            rows.append({"role": _NAMES[state], "text": ""})
            continue
        symbol = symbols[at]
        if letter == "K":
            state = _kept(state, symbol % 4)
            rows.append({"role": roles[held], "text": texts[held]})
        elif letter == "R":
            state = _AFTER_INSERT[state]
            rows.append({"role": _NAMES[state], "text": texts[held]})
        held += symbol < MUST_GO
        at += 1
    return rows


_DIGEST = pa.schema([("conv", pa.string()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
_DIGEST_DDL = "conv string, illegal long, cost long, audit string, repaired_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation from its pieces, which come together and in order."""
    conv, started, sums, audit, sha = None, False, [0, 0], [], hashlib.sha256()
    for batch in batches:
        out = []
        for c, cost, illegal, letters, repaired in zip(*[batch.column(n).to_pylist() for n in ("conv", "cost", "illegal", "audit", "repaired")], strict=True):
            if c != conv:
                if conv is not None:
                    out.append((conv, *sums, "".join(audit), sha.hexdigest()))
                conv, started, sums, audit, sha = c, False, [0, cost], [], hashlib.sha256()
            sums[0] += illegal
            audit.append(letters)
            for row in repaired:
                sha.update(f"{chr(10) if started else ''}{row['role']}:{row['text']}".encode())
                started = True
        if out:
            yield _record(out, _DIGEST)
    if conv is not None:
        yield _record([(conv, *sums, "".join(audit), sha.hexdigest())], _DIGEST)


def _faults(rows: DataFrame, run) -> DataFrame:
    return with_faults(run.keep(rows, "turns"), run)


def _pieces(faults: DataFrame, run, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``conv, place, cost, illegal, audit, repaired`` of every chunk, those of a conversation together and in order."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role")]
    chunks = run.keep(
        faults.repartitionByRange(*order, F.substring("text", 1, RANGE_LETTERS)).sortWithinPartitions(*order, "text")
        .select("conv", "symbol", "copies", "role", "text").mapInArrow(lambda batches: _chunks(batches, chunk_rows), _CHUNK_DDL), "chunks")
    several = run.keep(chunks.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("conv"), "several")
    to_end = F.least(*[F.element_at("matrix", j + 1) + END[j] for j in range(STATES)])
    whole = chunks.join(several, "conv", "left_anti").select(
        "conv", "place", to_end.alias("cost"), "illegal", "symbols", "roles", "texts", F.array(*[F.lit(e).cast("long") for e in END]).alias("behind"), F.lit(True).alias("final"))
    falling = chunks.join(several, "conv", "left_semi").select("conv", "place", "matrix", "first", "last")
    behind = run.keep(falling.repartition("conv").sortWithinPartitions("conv", F.desc("place")).mapInArrow(_costs_behind, _BEHIND_DDL), "behind")
    parts = (
        chunks.join(behind, ["conv", "place"]).select("conv", "place", "cost", (F.col("illegal") + F.col("border")).alias("illegal"), "symbols", "roles", "texts", "behind", "final")
        .repartition("conv").sortWithinPartitions("conv", "place")
    )
    return whole.mapInArrow(_edits, _PIECE_DDL).union(parts.mapInArrow(_edits, _PIECE_DDL))


def repaired_rows(conversations: DataFrame, damage: bool = False) -> DataFrame:
    """``conv_id, place, role, text``: the rows of the repaired conversations.

    ``place`` rises within a conversation (not by ones). Conversations that
    lose all rows are absent. Nulls, ties, repeats and empty tables as in ``repair_report``.
    """
    with settled(conversations.sparkSession) as run:
        pieces = _pieces(_faults(damaged(conversations) if damage else undamaged(conversations), run), run)
        ids = conversations.select(_key().alias("conv"), "conv_id").distinct()
        rows = pieces.select("conv", "place", F.posexplode("repaired").alias("at", "row"))
        return settle(rows.join(ids, "conv").select("conv_id", (F.col("place") * (1 << 20) + F.col("at")).alias("place"), "row.role", "row.text"), "repaired")


def repair_report(conversations: DataFrame, damage: bool = True, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per ``conv_id``: ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Counts are of the rows after damage. Rows follow their turn, nulls first; rows of one
    turn follow role and then text. A null role or text counts as one space, a null
    ``conv_id`` is a conversation of its own. A conversation without rows has zeros, an empty audit and the
    digest of the empty string; an empty table gives no rows. Other columns are left out.
    """
    with settled(conversations.sparkSession) as run:
        faults = _faults(damaged(conversations) if damage else undamaged(conversations), run)
        again = F.when(F.col("fault") == "blank", 0).when(F.col("fault") == "duplicate", F.col("copies")).otherwise(F.col("copies") - 1)
        counts = faults.groupBy("conv").agg(
            (F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"),
            F.sum(F.when(F.col("fault") == "blank", F.col("copies"))).alias("blank"), F.sum(again).alias("duplicate"),
            F.count(F.when(F.col("fault") == "truncated", 1)).alias("truncated"),
        )
        digests = _pieces(faults, run, chunk_rows).mapInArrow(_digests, _DIGEST_DDL)
        numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        report = (
            conversations.select(_key().alias("conv"), "conv_id").distinct().join(counts, "conv", "left").join(digests, "conv", "left")
            .select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
        )
        return settle(report, "repair")
