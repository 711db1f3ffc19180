"""Search, toxicity, decontamination, the pipeline and the SQL of queries."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import compare, connect
from marketlens.llm import decontaminate, near_dup, toxicity, voronoi
from marketlens.llm.queries import ORACLE, QUERIES
from tests.llm import brute
from tests.llm.conftest import prose


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_sql(key, spark, sf_dir):
    note, ok = compare(spark, key, QUERIES[key], ORACLE[key], sf_dir, connect(sf_dir))
    assert ok, note


def brute_nearest(rows, every, k):
    fit = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for i, v in fit:
        if i % every == 0:
            asked[i] = min(v, asked.get(i, v))
    out = []
    for q, qv in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(qv, v, strict=False)), i) for i, v in fit if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("pivots, block", [(5, 16), (64, 4096), (1, 7)])
def test_nearest(spark, pivots, block):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.3, 6).tolist()) for i in range(150)] + [(i, [0.5] * 6) for i in range(200, 290)]
    rows += [(400, None), (410, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (420, [float("nan")] * 6), (430, [float("inf")] * 6), (None, [0.2] * 6), (440, [0.4, 0.1]), (450, []), (30, [0.3] * 6), (460, [3e5] * 6)]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cell string, query_id int").repartition(3)
    got = sorted(tuple(r) for r in voronoi.nearest(table, query_every=10, k=7, pivots=pivots, block_vectors=block).collect())
    assert got == brute_nearest(rows, 10, 7)
    few = spark.createDataFrame(rows[:4], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in voronoi.nearest(few, query_every=2, k=7).collect()) == brute_nearest(rows[:4], 2, 7)
    assert voronoi.nearest(table.limit(0)).count() == 0


def test_nearest_with_repeated_query_rows(spark):
    """A query whose own rows fill a tight cell, and components from 2**52 on."""
    rng = np.random.default_rng(6)
    rows = [(10, [1.0, 0.0, 0.0])] * 30 + [(i, rng.normal(0, 0.3, 3).tolist()) for i in range(101, 190)] + [(7, [0.4, 0.0, 0.0])] * 2
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for pivots in (8, 64):
        assert sorted(tuple(r) for r in voronoi.nearest(table, query_every=10, k=7, pivots=pivots).collect()) == brute_nearest(rows, 10, 7)
    large = [(i, [2.0**52 + 2.0**20 * i, 0.0]) for i in (3, 4)] + [(10, [2.0**-10, 0.0]), (5, [1e300, 0.0]), (6, [-1e300, 0.0]), (8, [0.0, 1.0])]
    got = voronoi.nearest(spark.createDataFrame(large, "vec_id long, embedding array<double>"), query_every=10, k=5).collect()
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])] == [5, 4, 3, 8, 6]
    assert next(r["score"] for r in got if r["vec_id"] == 3) == 2**62 + 3 * 2**30


def test_exact_products_of_any_size():
    a, b = np.array([[2**40, -3]]), np.array([[2**20, 5], [1, 1]])
    assert voronoi._products(a, b).tolist() == [[2**60 - 15, 2**40 - 3]]
    assert voronoi._products(np.array([[2**62]]), np.array([[4], [-4]])).tolist() == [[2**63 - 1, -(2**63)]]


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(1500):
        text, toxic = prose(rng, 60).split(), i % 5 == 0
        if toxic:
            text[rng.randrange(60)] = rng.choice(["wretch", "wretches", "wretched", "dolt"])
        rows.append((i, " ".join(text)))
        if i % 3:
            labels.append((i, int(toxic)))
    docs = spark.createDataFrame([*rows, (9001, None), (9002, ""), (None, "wretch")], "doc_id long, text string")
    known = spark.createDataFrame([*labels, (None, 1), (3, None), (77, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxic_documents(docs, known).collect()}
    assert len(got) == 1503 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(1500))
    held = [i for i in range(1500) if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == (i % 5 == 0) for i in held]) > 0.97
    assert got[9001]["score"] == got[9002]["score"] and got[9001]["predicted"] == 0


def test_pairs_count():
    """Two harmless terms that only count together."""
    rng = np.random.default_rng(0)
    texts, labels = [], []
    for _ in range(1200):
        a, b = rng.random(2) < 0.5
        texts.append(np.array([t for t, on in ((0, a), (1, b), (2, True)) if on], np.int16))
        labels.append(float(a == b))
    machine = toxicity.Machine(np.full(1 << 20, -1, np.int16), 0.0, np.zeros(3), rng.normal(0, 0.1, (3, 4)))
    machine.fit(np.array(labels), texts, steps=600, batch=256)
    score = lambda *t: machine.scores(1, np.array(t), np.zeros(len(t), int))[0]
    assert score(0, 1, 2) > 0.8 and score(2) > 0.8 and score(0, 2) < 0.2 and score(1, 2) < 0.2


def test_pairs_are_learned(spark):
    """A label that two words decide together, each useless alone, through the whole training."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(5000):
        text, a, b = prose(rng, 40).split(), rng.random() < 0.5, rng.random() < 0.5
        for word, there in (("marble", a), ("zebra", b)):
            if there:
                text[rng.randrange(40)] = word
        a, b = "marble" in text, "zebra" in text
        rows.append((i, " ".join(text)))
        labels.append((i, int(a == b)))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxic_documents(docs, known).collect()}
    held = [i for i, _ in labels if got[i]["held_out"]]
    assert len(held) > 1000 and np.mean([(got[i]["score"] >= 0.5) == labels[i][1] for i in held]) > 0.9


def test_toxicity_without_labels(spark, messy, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.toxic_documents(messy, none).collect()} == {0.5}
    assert toxicity.toxic_documents(empty, none).count() == 0


def test_templates(spark, with_clashes):
    items = [(1, "A train that leaves the station of Paris at 60 km speed carries Alice home, then Alice walks 5 km more today."), (2, ""), (3, None), (4, "short question here"),
             (5, "What is the sum of two plain words that nobody ever wrote in this order before?")]
    docs = [
        (10, "intro. A train that leaves the station of Berlin at 75 mi speed carries Carol home, then Carol walks 9 mi more today. bye"),
        (11, "A train that leaves the station of Berlin at 75 mi speed carries Carol home, then Dave walks 9 mi more today."),
        (12, None), (13, ""), (14, "Short question, here!"), (15, "nothing at all to see in this one place today"),
        (16, "so what is the sum of two plain words that nobody ever wrote in this order before " + "pad " * 30_000),
        (17, "what is the sum of two plain words, alone"), (None, "what is the sum of two plain words that nobody ever wrote in this order before"), (14, "Short question, here!"),
    ]
    benchmark, table = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, doc_id int, hash int"), with_clashes(docs, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(table, benchmark).collect()), key=str)
    assert got == [(10, 1), (14, 4), (16, 5), (None, 5)]
    assert decontaminate.contaminated(table.limit(0), benchmark).count() == 0
    assert decontaminate.contaminated(table, benchmark.limit(0)).count() == 0


def test_copies_in_other_letter_case(spark):
    item = "Which of these ten plain words would ever stand in just this order, and who was Paris to Anna at home?"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = [(1, f"so, {item} yes"), (2, f"LOUD: {item.upper()}"), (3, f"News, {item.title()}"), (4, item.lower()), (5, "WHICH OF THESE TEN OTHER WORDS STAND, AND WHO WAS IT?")]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 2, 3, 4]


def test_short_and_number_items(spark):
    sums = "Compute 12 + 35 * 7 - 18 / 3"
    long_sums = " ".join(f"{i} + {i * 7}.5 km" for i in range(30))
    short = "Which small green animal of the old forest sings at night when rain falls there?"
    tiny = "Paris lies on the Seine"
    benchmark = spark.createDataFrame([(1, sums), (2, long_sums), (3, short), (4, tiny), (5, "7 / 9")], "item_id long, text string")
    docs = [
        (1, f"Please: {sums} ok"), (2, "Please compute 12 + 35 * 7 - 18 / 4"), (3, f"see {long_sums.upper()}."),
        (4, "x which small green animal of the old HILLS sings at night when rain falls there y"),
        (5, "x which small green animal of the old dark forest sings at night when rain falls there y"),
        (6, "which small green animal of the forest sings at night when rain falls there"),
        (7, "which small grey animal of the old hills sings at night when rain falls there"),
        (8, "and so, Paris lies on the Seine"), (None, "x which small green animal of the old hills sings at night when rain falls there"), (10, "take 7/9 of it"),
    ]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    want = [(1, 1), (3, 2), (4, 3), (5, 3), (6, 3), (8, 4), (None, 3)]
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=str) == sorted(want, key=str)


def test_shouted_benchmark_passages_are_found(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id % 2 = 0").selectExpr("doc_id", "upper(text) as text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(r["item_id"], " ".join(r["text"].lower().split())) for r in benchmark.collect()]
    want = {(d["doc_id"], i) for d in docs.collect() for i, t in items if t in " ".join((d["text"] or "").lower().split())}
    assert want and want <= {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, benchmark).collect()}


def test_benchmark_passages_are_found(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = [(r["item_id"], " ".join(r["text"].split())) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {(d["doc_id"], i) for d in docs for i, t in items if t in " ".join((d["text"] or "").split())}
    assert {(r["doc_id"], r["item_id"]) for r in QUERIES["op6_template_decontamination"](spark, sf_dir).collect()} == want


def test_one_row_for_a_template_of_many_items(spark):
    """Items of one template and documents that hold it do not make all pairs."""
    text = "On market day farmer {} carried {} baskets of fresh green pears over the old bridge to the town of {} before noon."
    names = ["Anna", "Bert", "Carl", "Dora", "Emil", "Frida"]
    items = [(i, text.format(names[i % 6], 3 + i, names[(i + 1) % 6])) for i in range(30)]
    docs = [(i, "Long ago, so they say, this is what was told: " + text.format(names[(i + 2) % 6], 90 + i, names[(i + 4) % 6])) for i in range(20)]
    docs += [(100 + i, f"Where {w} came first nothing of that kind was ever told to anybody in town.") for i, w in enumerate(names)]
    benchmark, table = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    got = decontaminate.contaminated(table, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"], r["n_items"]) for r in got) == [(i, 0, 30) for i in range(20)]
    assert sorted(tuple(r) for r in decontaminate.template_items(benchmark).collect()) == [(i, 0) for i in range(30)]


def test_copies_with_other_values_names_case_and_edits(spark, sf_dir):
    """Planted copies of every item, changed in one way each: the share found of each kind, and of clean texts."""
    rng = random.Random(8)
    words = [w for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).collect() for w in (r["text"] or "").split() if w.isalpha() and w.islower()]
    filler = lambda n: " ".join(rng.choice(words) for _ in range(n))
    units = ["km", "kg", "hours", "dollars"]
    items, docs, kinds = [], [], {}
    for i in range(60):
        name, number, unit = f"N{filler(1)}", rng.randrange(10, 99), rng.choice(units)
        form = f"{filler(6)}, {{0}} {filler(5)} {{1}} {{2}} {filler(5)} {{0}} {filler(6)}"
        items.append((i, form.format(name, number, unit)))
        other = form.format(f"M{filler(1)}", number + 7, units[(units.index(unit) + 1) % 4])
        inconsistent = form.replace("{0}", f"M{filler(1)}", 1).format(f"K{filler(1)}", number, unit)
        plain = items[-1][1]
        edited = plain.split()
        edited[rng.randrange(len(edited))] = "changed"
        for kind, text in (("other values", other), ("upper", plain.upper()), ("title", plain.title()), ("edited", " ".join(edited)), ("inconsistent", inconsistent), ("clean", filler(30))):
            docs.append((len(docs), f"{filler(20)} {text} {filler(20)}"))
            kinds.setdefault(kind, []).append((len(docs) - 1, i))
    benchmark, table = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(table, benchmark).collect()}
    share = {k: len(got & {*v}) / len(v) for k, v in kinds.items()}
    assert share["other values"] == share["upper"] == share["title"] == 1 and share["edited"] >= 0.95
    assert share["clean"] == 0 and share["inconsistent"] <= 0.1
    assert got <= {p for v in kinds.values() for p in v}


def test_native_plans(spark, sf_dir, monkeypatch):
    """No Python worker in the plan of the result nor in that of any table stored on the way."""
    from marketlens.functions.settle import Settled

    plans, keep, settle = [], Settled.keep, decontaminate.settle
    note = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(Settled, "keep", lambda self, df, label: (note(df), keep(self, df, label))[1])
    monkeypatch.setattr(decontaminate, "settle", lambda df, label: (note(df), settle(df, label))[1])
    for key in ("op6_template_decontamination", "op7_jump_hash_sharding"):
        note(QUERIES[key](spark, sf_dir))
    assert len(plans) > 8 and not any(word in plan for plan in plans for word in ("Python", "Arrow", "Pandas"))


def test_stages_are_named():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "decontamination", "packing"]


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    steps, at = [], docs
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, sf_dir).cache()
        steps.append(at)
        if name != "packing":
            assert at.columns == docs.columns
    clean, single, cut, safe, packed = steps
    texts = [{r["doc_id"]: r["text"] for r in s.collect()} for s in (docs, *steps[:4])]
    before, after = texts[:2]
    gone = set(before) - set(after)
    assert gone and sum(labels.get(d) == 0 for d in gone) <= 0.05 * len(before) and all(after[d] == before[d] for d in after)
    groups = defaultdict(list)
    for d, (_, c) in brute.near_duplicates(sorted(after.items()), percent=near_dup.STAGE_PERCENT).items():
        groups[c].append(d)
    assert set(texts[2]) == set(groups)
    kept = sorted(texts[2].items())
    for (d, t), (size, removed, runs, _) in zip(kept, brute.repeated_bytes([t for _, t in kept]), strict=True):
        assert 0 <= len(texts[3][d].encode()) - (size - removed) <= 6 * runs and (removed or texts[3][d] == t)
    found = {r["doc_id"] for r in decontaminate.contaminated(cut, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert found and set(texts[4]) == set(texts[3]) - found
    ids = dict(zip(texts[4], brute.tokens(list(texts[4].values()), 2), strict=True))
    assert sum(r["length"] for r in packed.collect()) == sum(map(len, ids.values()))
    assert corpus_pipeline.run(spark, sf_dir).count() == packed.count()


def test_stages_on_messy_and_empty_documents(spark, messy, empty, sf_dir):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, messy, sf_dir)
        assert out.count() > 0 and (name == "packing" or out.columns == messy.columns)
        assert stage(spark, empty, sf_dir).count() == 0
    assert near_dup.stage(spark, messy.where(F.col("doc_id") >= 500), sf_dir).count() == 2
