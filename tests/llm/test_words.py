"""Spelling groups, pieces and conversation repair against plain restatements and the library."""

import hashlib
import random
import re

import numpy as np
import pytest

from marketlens.llm import pieces, repair, variants
from marketlens.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import CLASHING


def groups(df, **options):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in variants.spelling_groups(df, **options).collect()}


@pytest.fixture(scope="module")
def misspelt():
    rng = random.Random(3)
    base = ["".join(rng.choice("aeinrst") for _ in range(rng.randint(7, 10))) for _ in range(120)]
    rows = []
    for d in range(250):
        words = []
        for _ in range(60):
            w = base[min(int(rng.expovariate(0.05)), 119)]
            k, u = rng.randrange(len(w)), rng.random()
            w = w[:k] + rng.choice("aeinrst\u00e9\u00c0\u00df\u00d7") + w[k + (u < 0.1) :] if u < 0.3 else w
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((d or None, " ".join(words)))
    long = "a" * 300
    return rows + [
        (1000, None), (1001, ""), (1002, f"{long} {long}a {long} {long}a {long[:-1]}b {long[:-1]}b"), (1003, "\u65e5aaaaaaaa\u8a9eaaaaaaaa x\u00d7y\u00f7abcdefg abcdefg"),
        (5, "zzzzzzz zzzzzzz"), (5, "zzzzzzz zzzzzzz"), (1004, "abcdefghi " * 60_000 + "q" * 1_000_000),
        (1006, "chainaa " * 3 + "chainab " * 40 + "chainbb " * 500),
    ]


@pytest.mark.parametrize("options", [{}, {"branch_words": 5, "visitors": 6}])
def test_spelling_groups(with_clashes, misspelt, options):
    want = brute.spelling_groups(misspelt)
    assert sum(v[0] is not None for v in want.values()) > 100 and any(v[1] not in (w, v[0]) for w, v in want.items())
    assert groups(with_clashes(misspelt, "doc_id long, text string").repartition(3), **options) == want


def test_spelling_groups_of_tables(spark, sf_dir, empty):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in QUERIES["op11_trie_spelling_groups"](spark, sf_dir).collect()}
    assert got == brute.spelling_groups(rows) and got
    assert variants.spelling_groups(empty).count() == 0


def test_words_of_one_vector(spark):
    """Anagrams share a leaf, which is cut into blocks."""
    rng = random.Random(1)
    words = {"".join(rng.sample("aaeeiinn", 8)) for _ in range(300)}
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    beside = lambda a, b: len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) == 1
    words |= {w[:3] + "q" + w[4:] for w in words}
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    want = {frozenset((a, b)) for a in words for b in words if beside(a, b)}
    got = [frozenset((r["a"], r["b"])) for r in variants.near_words(table, branch_words=10, visitors=20).collect()]
    assert len(got) == len(set(got)) and set(got) == want


SPECIAL = [
    "", " ", "   a  b ", "\u2581", "a\u2581b", "\n\n", "a\x00b", "\u65e5\u672c\u8a9e \u30c6", "e\u0301 \u00e9", "\ufb01 \u00bd \u2167 \u3314", "\U0001f600\U0001f44d\U0001f3fd",
    " " * 50, "a" * 3000, "\t \t", "\u3000x\u3000", "\uff11\uff12", "a\u00adb", "x \u200b y", "\u1100\u1161\u11a8", "</s> <s> <unk> <0x41>",
]


def proto(blob=None):
    from sentencepiece import sentencepiece_model_pb2 as model_format

    with open(pieces.default_model(), "rb") as file:
        return model_format.ModelProto.FromString(blob or file.read())


def by_library(processor, text):
    return [(p.id, p.begin, p.end) for p in processor.encode(text, return_type="proto").pieces]


def by_pieces(model, text):
    return list(zip(*(a.tolist() for a in model.encode(text)), strict=True))


def variant(name):
    from sentencepiece import SentencePieceNormalizer

    m = proto()
    if name in ("nmt_nfkc", "nfkc_cf"):
        rules = proto(SentencePieceNormalizer(rule_name=name).serialized_model_proto()).normalizer_spec
        m.normalizer_spec.precompiled_charsmap, m.normalizer_spec.name = rules.precompiled_charsmap, name
        m.normalizer_spec.remove_extra_whitespaces = name == "nmt_nfkc"
    if name == "own symbols":
        m.pieces.add(piece="<sep>", type=pieces.USER_DEFINED)
        m.pieces.add(piece="\u2581<z z>\u2581", type=pieces.USER_DEFINED)
    if name == "no bytes":
        kept = [p for p in m.pieces if p.type != pieces.BYTE]
        del m.pieces[:]
        m.pieces.extend(kept)
        m.trainer_spec.byte_fallback = False
    if name == "no lead":
        m.normalizer_spec.add_dummy_prefix = False
    return m.SerializeToString()


@pytest.mark.parametrize("name", ["plain", "nmt_nfkc", "nfkc_cf", "own symbols", "no bytes", "no lead"])
def test_pieces_and_spans_are_the_librarys(spark, sf_dir, name):
    from sentencepiece import SentencePieceProcessor

    blob = variant(name)
    model, processor = pieces.PieceModel(blob), SentencePieceProcessor(model_proto=blob)
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    for text in [*SPECIAL, "a<sep>b <sep><sep> <sep", "x <z z> \u2581<z z>\u2581", *texts]:
        assert by_pieces(model, text) == by_library(processor, text), text[:80]


def test_other_models_are_refused():
    m = proto()
    m.trainer_spec.model_type = 1
    with pytest.raises(ValueError, match="byte-pair"):
        pieces.PieceModel(m.SerializeToString())


def test_piece_round_trip(with_clashes, spark, sf_dir, empty):
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_file=pieces.default_model())
    docs = [(i, t) for i, t in enumerate(SPECIAL)] + [(None, None), (50, "again"), (50, "again"), (99, "word " * 200_000 + "x" * 300_000)]
    table = with_clashes(docs, "doc_id long, text string").repartition(3)
    encoded = pieces.encode_documents(table)
    want = []
    for d, t in docs:
        ids = processor.encode(t or "", add_eos=True)
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(processor.decode(ids).encode()).hexdigest(), len((t or "").encode())))
    assert sorted((tuple(r)[:5] for r in pieces.round_trip_digests(table).collect()), key=str) == sorted(want, key=str)
    by_id = {r["doc_id"]: r for r in encoded.collect()}
    texts = {r["doc_id"]: r["text"] for r in pieces.decode_documents(encoded).collect()}
    for d, t in docs:
        source = (t or "").encode()
        spans = list(zip(*(np.frombuffer(by_id[d][c], "<u4").tolist() for c in ("starts", "ends")), strict=True))
        assert b"".join(source[a:b] for a, b in spans) == source
        assert texts[d] == processor.decode(processor.encode(t or ""))
    assert pieces.round_trip_digests(empty).count() == 0 and pieces.encode_documents(empty).count() == 0
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    ids = {r["doc_id"]: processor.encode(r["text"] or "", add_eos=True) for r in rows}
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in QUERIES["op12_sentencepiece_round_trip"](spark, sf_dir).collect()}
    assert got == {d: (len(i), hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest()) for d, i in ids.items()}


def report(df, **options):
    return {r[0]: tuple(r)[1:] for r in repair.repair_report(df, **options).collect()}


@pytest.fixture(scope="module")
def faulty():
    rng = random.Random(4)
    rows = []
    for c in range(300):
        for t in range(rng.choice([0, 1, 2, 3, 5, 9, 14])):
            for _ in range(rng.choice([1, 1, 1, 1, 2])):
                role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
                text = rng.choice(["Hi.", "What? ", "cut off", "", "  \n", None, f"x{t}.", f"y{rng.random()}!", "a." + " " * 50_000 + "b?"])
                rows.append((c or None, rng.choice([t, t, t, t + 3, None]), role, text))
    return rows


def test_conversation_repair(spark, faulty):
    want = brute.repair_report(faulty)
    assert len({v[6] for v in want.values()}) > 50 and {*"DKR"} <= {*"".join(v[6] for v in want.values())}
    width = len(CLASHING.split(","))
    table = spark.createDataFrame([(*r, *[None] * width) for r in faulty], f"conv_id long, turn long, role string, text string, {CLASHING}").repartition(5)
    assert report(table) == want
    assert report(table, damage=False) == brute.repair_report(faulty, damage=False)
    assert report(table.limit(0)) == {}


def test_conversations_of_several_chunks(spark, faulty):
    rng = random.Random(9)
    hot = [(5, i, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"t{i}.", f"t{i}", "again.", ""])) for i in range(400)]
    rows = faulty[:300] + hot + [(6, 3, "user", "same.")] * 50 + [(7, 0, "system", "Be brief.")] * 9
    want = brute.repair_report(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    for size in (1, 3, 16):
        assert report(table, chunk_rows=size) == want
    shown = {}
    for r in sorted(repair.repaired_rows(table, damage=True).collect(), key=lambda r: (r["conv_id"] or -1, r["place"])):
        shown.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        assert r["role"][:1] in "sua"
    empty = hashlib.sha256().hexdigest()
    assert {c: hashlib.sha256("\n".join(v).encode()).hexdigest() for c, v in shown.items()} == {c: v[7] for c, v in want.items() if v[7] != empty}


def test_block_tables_agree_with_single_steps():
    table, rng = repair.Tables(), random.Random(2)
    for _ in range(200):
        symbols = bytes(rng.randrange(12) for _ in range(rng.randrange(14)))
        vector = list(repair.END)
        for s in reversed(symbols):
            vector = repair._before(min(s, repair.MUST_GO), tuple(vector))
        matrix = table.matrix(symbols)
        assert [min(matrix[s * 4 + j] + repair.END[j] for j in range(4)) for s in range(4)] == list(vector)
        letters, _ = table.trace(symbols, table.number[repair._less_least(repair.END)[1]], repair.NOTHING)
        assert len(re.sub("I", "", letters)) == len(symbols)


def test_conversation_query(spark, sf_dir):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    got = QUERIES["op13_conversation_repair"](spark, sf_dir)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == brute.repair_report(rows)
