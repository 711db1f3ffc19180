import random

import pytest

CLASHING = "row string, score double, spans string, token string, stamp int, shard int, component string, cleaned string, hash long, toxicity string"


def prose(rng, n, vocabulary=400):
    words = [chr(97 + i % 26) + "aeiou"[i % 5] + chr(97 + i // 26 % 26) + ("é" if i % 7 == 0 else "") for i in range(vocabulary)]
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def messy_rows():
    """Documents with nulls, empties, long texts, copies, near copies, shared passages and repeated ids."""
    rng = random.Random(11)
    passage, other = prose(rng, 70), prose(rng, 90)
    rows = [(i, prose(rng, rng.choice([1, 3, 5, 40, 120, 300]))) for i in range(60)]
    base = prose(rng, 200).split()
    rows += [(100 + i, " ".join(base)) for i in range(6)]
    for i in range(12):
        near = list(base)
        near[(i * 17) % 200] = f"changed{i}"
        rows.append((200 + i, " ".join(near).upper() if i == 3 else " ".join(near)))
    rows += [(300 + i, f"{prose(rng, 60)} {passage} {prose(rng, 50)}" + (f" {other}" if i % 3 == 0 else "")) for i in range(15)]
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, prose(rng, 30_000)), (404, "ab" * 300), (405, "x" * 250), (406, "x" * 250 + "é" * 120)]
    rows += [(0, rows[0][1]), (500, "one two three"), (501, "one TWO three"), (502, "one two three four")]
    return rows


@pytest.fixture(scope="session")
def with_clashes(spark):
    """A table of rows with further columns that operators use inside."""

    def make(rows, schema):
        width = len(CLASHING.split(","))
        return spark.createDataFrame([(*r, *[None] * width) for r in rows], f"{schema}, {CLASHING}")

    return make


@pytest.fixture(scope="session")
def messy(with_clashes, messy_rows):
    return with_clashes(messy_rows, "doc_id long, text string").repartition(4)


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)
