"""Operators on documents against plain restatements."""

import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketlens.llm import near_dup, packing, sharding, suffixes, token_store
from tests.llm import brute
from tests.llm.conftest import prose


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_near_duplicates_messy(messy, messy_rows):
    rows = messy_rows[:-4] + messy_rows[-3:]  # the repeated row counts as one document
    want = brute.near_duplicates(rows)
    got = near_dup.near_duplicates(messy).collect()
    assert len(got) == len(messy_rows)
    for r in got:
        size, component = want[r["doc_id"]]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (size, component, component == r["doc_id"]), r


def test_near_duplicates_with_short_lists(spark, sf_dir):
    docs = documents(spark, sf_dir)
    want = brute.near_duplicates([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(docs, list_members=1).collect()}
    assert got == want
    assert any(c != d for d, (_, c) in want.items())


def test_near_duplicates_chain(spark):
    """Links that only join through a middle document, away from the list's smallest member."""
    rng = random.Random(2)
    words = prose(rng, 300, 5000).split()
    rows = []
    for i in range(8):
        words = list(words)
        for j in range(4):
            words[(i * 31 + j * 70) % 300] = f"step{i}x{j}"
        rows.append((50 - i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.near_duplicates(rows)
    for members in (2, 64):
        assert {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs, list_members=members).collect()} == {d: c for d, (_, c) in want.items()}


def test_stage_drops_copies_from_80_percent(spark):
    """Pairs of a similarity between 0.80 and 0.85, and just below 0.80."""
    rng = random.Random(5)
    rows = []
    for i in range(40):
        words = prose(rng, 204, 5000).split()
        near = list(words)
        for j in range(4 if i < 30 else 5):
            near[20 + 40 * j] = f"changed{j}"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(near))]
    want = brute.near_duplicates(rows, percent=80)
    kept = {r["doc_id"] for r in near_dup.stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert kept == {d for d, (_, c) in want.items() if c == d} and len(kept) == 50
    assert brute.near_duplicates(rows, percent=85) != want


def test_sketch_sizes_follow_the_similarity():
    assert near_dup.sketch_sizes(85) == (16, 6) and near_dup.sketch_sizes(100) == (16, 16)
    for percent in (30, 50, 80, 95):
        n, matches = near_dup.sketch_sizes(percent)
        p = percent / 100
        assert matches >= near_dup.LEAST_MATCHES and sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(matches)) <= near_dup.MISS_CHANCE


def test_near_duplicates_null_id_and_empty(spark, empty):
    docs = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (7, "A b c d e f")], "doc_id long, text string")
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in near_dup.near_duplicates(docs).collect()}
    assert got == {None: (None, True), 3: (3, True), 7: (3, False)}
    assert near_dup.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("bucket, contexts", [(10**6, 10**6), (40, 3), (7, 1)])
def test_repeats_messy(messy, messy_rows, bucket, contexts):
    want = Counter(zip([d for d, _ in messy_rows], brute.repeated_bytes([t for _, t in messy_rows]), strict=True))
    got = suffixes.remove_repeats(messy.select("doc_id", "text"), token_contexts=contexts, bucket_suffixes=bucket).collect()
    assert Counter((r["doc_id"], tuple(r)[1:]) for r in got) == want


def test_repeats_sf(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rows = docs.collect()
    want = dict(zip([r["doc_id"] for r in rows], brute.repeated_bytes([r["text"] for r in rows]), strict=True))
    assert {r["doc_id"]: tuple(r)[1:] for r in suffixes.remove_repeats(docs, bucket_suffixes=900, token_contexts=5).collect()} == want


def test_repeats_stage_keeps_columns_and_characters(spark, messy, messy_rows, empty):
    out = suffixes.stage(spark, messy, "")
    assert out.columns == messy.columns
    texts = Counter((r["doc_id"], r["text"]) for r in out.collect())
    spans = dict(zip([d for d, _ in messy_rows], brute.repeated_bytes([t for _, t in messy_rows]), strict=True))
    assert sum(texts.values()) == len(messy_rows)
    for (doc_id, text), _ in texts.items():
        size, removed, runs, _ = spans[doc_id]
        assert 0 <= len(text.encode()) - (size - removed) <= 6 * runs
    assert suffixes.stage(spark, empty, "").count() == 0


def test_multikey_order():
    import numpy as np

    rng = np.random.default_rng(0)
    columns = [rng.integers(0, 9, 20_000), rng.integers(0, 5, 20_000), rng.integers(0, 50, 20_000)]
    order = suffixes.multikey_order(columns, small=64)
    assert sorted(order) == list(range(20_000))
    rows = list(zip(*(c[order] for c in columns), strict=True))
    assert rows == sorted(rows)


def check_packing(rows, pieces, size=1024):
    ids = {}
    for (doc_id, _), found in zip(rows, brute.tokens([t for _, t in rows], 2), strict=True):
        ids.setdefault(doc_id, []).append(found)
    placed, covered = {}, Counter()
    for p in pieces:
        assert any(brute.ids_crc32(found[p["start"] : p["start"] + p["length"]]) == p["ids_crc32"] for found in ids[p["doc_id"]])
        placed.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        covered[p["doc_id"]] += p["length"]
        assert p["piece"] == 0 or p["length"] == size
    assert covered == Counter({d: sum(map(len, found)) for d, found in ids.items()})
    for spots in placed.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= size
    return len(placed), -(-sum(covered.values()) // size)


def test_packing(spark, messy, messy_rows, empty, sf_dir):
    check_packing(messy_rows, packing.packed_documents(messy).collect())
    docs = documents(spark, sf_dir)
    used, least = check_packing([(r["doc_id"], r["text"]) for r in docs.collect()], packing.packed_documents(docs).collect())
    assert used <= least * 1.02 + 2
    assert packing.packed_documents(empty).count() == 0


def test_packer_is_bounded_and_best_fit():
    packer = packing.BestFit(10, open_limit=3)
    assert [packer.place(n) for n in (6, 5, 4, 5, 3, 7)] == [(0, 0), (1, 0), (0, 6), (1, 5), (2, 0), (2, 3)]
    for n in (2, 3, 4, 2):
        packer.place(9 if n == 2 else 8)
        assert packer.n_open <= 3


def test_groups_and_sequences(spark):
    docs = spark.createDataFrame([(i, "word " * (i * 7 % 400)) for i in range(80)], "doc_id long, text string")
    pieces = packing.token_pieces(docs).cache()
    packed = packing.pack(pieces, group_pieces=20)
    check_packing([(r["doc_id"], r["text"]) for r in docs.collect()], packed.withColumn("ids_crc32", F.crc32("ids")).collect())
    for row in packing.sequences(packed).collect():
        assert len(row["ids"]) <= 4096 and len(row["pieces"]) >= 1


def test_token_store(spark, messy, messy_rows, empty):
    rows = sorted(messy_rows, key=lambda r: (r[0], r[1] or ""))
    got = sorted(token_store.round_trip(spark, messy).collect(), key=lambda r: r["start"])
    at = 0
    for row, (doc_id, _), ids in zip(got, rows, brute.tokens([t for _, t in rows], 0), strict=True):
        assert tuple(row) == (doc_id, at, len(ids), brute.ids_crc32(ids))
        at += len(ids)
    assert token_store.round_trip(spark, empty).count() == 0


def test_token_store_null_id(spark):
    docs = spark.createDataFrame([(5, "five"), (None, "none"), (-3, "minus")], "doc_id long, text string")
    assert [r["doc_id"] for r in token_store.round_trip(spark, docs).orderBy("start").collect()] == [None, -3, 5]


def test_elias_fano():
    import numpy as np

    rng = np.random.default_rng(1)
    for values in ([], [0], [7], [0, 0, 0], [5] * 200, np.sort(rng.integers(0, 10**9, 3000)), np.arange(1000), np.sort(rng.integers(0, 500, 4000))):
        coded, _ = token_store.EliasFano.from_bytes(token_store.EliasFano.encode(np.array(values, np.int64)).to_bytes())
        assert coded.all().tolist() == list(values)
        assert [coded.select(i) for i in range(coded.n)] == list(values)
    size = len(token_store.EliasFano.encode(np.sort(rng.integers(0, 10**9, 100_000))).to_bytes())
    assert size * 8 / 100_000 < 17
    file = token_store.TokenFile(token_store.encode_file([None, 4, 9, 9], [np.array(x, "<u4").tobytes() for x in ([1], [], [70_000, 2], [3])]))
    assert [(file.doc_id(i), file.start(i), file.tokens(i).tolist()) for i in range(4)] == [(None, 0, [1]), (4, 1, []), (9, 1, [70_000, 2]), (9, 3, [3])]


def test_tokens_equal_the_library():
    texts = ["a  b", " a", "a ", "a \n b", "x\n \ny", "I'm ok's 12,5　y \x1c z", "café<|endoftext|> Ⅷ²", "", None, "word " * 50]
    from marketlens.llm.tokens import default_vocabulary, encoder, id_array

    assert [id_array(x).tolist() for x in encoder(default_vocabulary()).encode(texts)] == [x[:-1] for x in brute.tokens(texts, 0)]


def test_added_tokens_have_their_own_ids(spark):
    from tokenizers import Tokenizer

    from marketlens.llm.tokens import default_vocabulary

    texts = ["a<|endoftext|>b", "<|endoftext|>", " x <|endoftext|> \n y<|endoftext|><|endoftext|>", "<|endoftext", "plain  text "]
    want = [e.ids for e in Tokenizer.from_file(default_vocabulary()).encode_batch(texts, add_special_tokens=False)]
    assert want[0] == [64, 50256, 65]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stored = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in token_store.round_trip(spark, docs).collect()}
    assert stored == {i: (len(ids) + 1, brute.ids_crc32([*ids, 0])) for i, ids in enumerate(want)}
    packed = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in packing.packed_documents(docs).collect()}
    assert packed == {i: (len(ids) + 1, brute.ids_crc32([*ids, 2])) for i, ids in enumerate(want)}


def test_sharding(spark, messy, messy_rows, empty):
    got = sharding.assign_shards(messy, shards=7, slices=3).collect()
    assert len(got) == len(messy_rows)
    texts = {}
    for doc_id, text in messy_rows:
        texts.setdefault(doc_id, set()).add((16 + len((text or "").encode()), zlib.crc32((text or "").encode())))
    slots = {}
    for r in got:
        assert (r["size"], r["text_crc32"]) in texts[r["doc_id"]] and r["law"] == "key" and 0 <= r["shard"] < 7
        assert r["grown_shard"] in (r["shard"], 7)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign_shards(empty).count() == 0


def test_jump_walk(spark):
    keys = spark.range(20_000)
    for n in (1, 2, 39, 40):
        rows = keys.select(sharding.jump_shards(F.col("id"), n).alias("j"), sharding.jump_shards(F.col("id"), n + 1)["shard"].alias("more")).select("j.*", "more").collect()
        assert all(r["grown"] == r["more"] and r["grown"] in (r["shard"], n) for r in rows)
        sizes = Counter(r["shard"] for r in rows)
        assert len(sizes) == n and max(sizes.values()) < 1.35 * 20_000 / n
    row = spark.createDataFrame([(None,)], "k long").select(sharding.jump_shards(F.col("k"), 40)["shard"].alias("s")).first()
    assert 0 <= row["s"] < 40


@pytest.mark.parametrize("blank", [" ", "\t", "\n", "　"])
def test_long_runs_of_blanks(blank):
    """The merger gives up on these; the ids are the library's all the same."""
    from tokenizers import Tokenizer

    from marketlens.llm import tokens

    text = f"a{blank * 1_700_000}b <|endoftext|>"
    want = Tokenizer.from_file(tokens.default_vocabulary()).encode(text, add_special_tokens=False).ids
    assert tokens.id_array(tokens.encoder(tokens.default_vocabulary()).encode([text])[0]).tolist() == want


def test_long_blanks_through_packing_and_store(spark):
    docs = spark.createDataFrame([(1, " " * 5_000_000), (2, "x" + "\n" * 1_500_000), (3, "short")], "doc_id long, text string")
    want = {d: brute.tokens([t], 0)[0] for d, t in docs.collect()}
    got = {r["doc_id"]: r for r in token_store.round_trip(spark, docs).collect()}
    assert {d: (r["n_tokens"], r["ids_crc32"]) for d, r in got.items()} == {d: (len(i), brute.ids_crc32(i)) for d, i in want.items()}
    assert {r["doc_id"]: r["n"] for r in packing.packed_documents(docs).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == {d: len(i) for d, i in want.items()}


def test_repeated_ids_with_different_texts(spark):
    """They are one document, the same one whatever the order of the rows."""
    rng = random.Random(6)
    base = [prose(rng, 60, 5000) for _ in range(4)]
    rows = [(1, base[0]), (1, base[1]), (2, base[0]), (3, base[1]), (4, base[2]), (4, base[2]), (5, base[2]), (6, None), (6, base[3]), (7, base[3])]
    show = lambda r: sorted((x["doc_id"], x["n_shingles"], x["component_id"], x["kept"]) for x in near_dup.near_duplicates(spark.createDataFrame(r, "doc_id long, text string").repartition(3)).collect())
    first = show(rows)
    assert first == show(rows[::-1]) and len(first) == len(rows)
    component = {d: c for d, _, c, _ in first}
    assert sorted((component[2], component[3])) in ([1, 3], [1, 2]) and component[5] == 4 and len({c for d, _, c, _ in first if d == 1}) == 1


def test_walk_against_a_plain_one(spark):
    import hashlib

    def plain(key, shards):
        at = shard = 0
        while at < shards:
            shard = at
            draw = int(hashlib.md5(f"{key}:{at}".encode()).hexdigest()[:8], 16)
            at = math.floor((at + 1) * 4294967296.0 / (draw + 1))
        return shard

    for shards in (1, 2, 40, 1000):
        got = spark.range(3000).select("id", sharding.jump_shards(F.col("id"), shards).alias("j")).select("id", "j.*").collect()
        assert all((r["shard"], r["grown"]) == (plain(r["id"], shards), plain(r["id"], shards + 1)) for r in got)


def test_components(spark):
    from marketlens.llm.components import components

    links = [(i, i + 1) for i in range(100, 160)] + [(5, 5), (7, None), (None, 8), (3, 1), (1, 3), (9, 3), (42, 9)] + [(200, 200 + i) for i in range(1, 50)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(100, 161), 100), **dict.fromkeys((1, 3, 9, 42), 1), **dict.fromkeys(range(200, 250), 200)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shards_and_sequences_of_nulls_and_nothing(spark, tmp_path, empty):
    docs = spark.createDataFrame([(1, "a"), (None, None), (None, "x"), (2, "")], "doc_id long, text string")
    sharding.write_shards(docs, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(str, back.select("doc_id", "text").collect())) == sorted(map(str, docs.collect()))
    want = {r["doc_id"]: r["shard"] for r in sharding.assign_shards(docs).collect()}
    assert {r["doc_id"]: r["shard"] for r in back.collect()} == want
    packed = packing.pack(packing.token_pieces(docs))
    assert sum(len(r["pieces"]) for r in packing.sequences(packed).collect()) == 4
    assert packing.sequences(packing.pack(packing.token_pieces(empty))).count() == 0


def test_long_lists_of_near_copies(spark):
    """Copies that are edited too much for the list's hub: pairs among them are still found, though most are left out before they are joined."""
    rng = random.Random(12)
    base = prose(rng, 220, 5000).split()
    rows = [(1000, " ".join(base))]
    for i in range(120):
        words = list(base)
        for _ in range(rng.choice([2, 4, 6, 7, 8, 9])):
            words[rng.randrange(220)] = rng.choice([f"own{i}x{rng.random()}", "shared", "other"])
        rows.append((i, " ".join(words)))
    words = list(base)
    for j in range(0, 220, 22):
        words[j] = f"far{j}"
    rows += [(2000 + i, " ".join([*words[:-1], f"end{i}"])) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.near_duplicates(rows, percent=80)
    assert len({c for _, c in want.values()}) > 3 and want[2003][1] == 2000
    for members in (16, 512):
        assert {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs, percent=80, list_members=members).collect()} == {d: c for d, (_, c) in want.items()}
