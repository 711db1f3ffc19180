"""Benchmark decontamination by templates, in DataFrame functions only.

A text is parted once into tokens: numbers and words, lower-cased, of which
numbers, names (capitalised words inside a sentence) and units after a number
are typed slots. A token has a hash in each of three forms: ``NAMED``, where
slots are placeholders, ``CASELESS``, where names are plain words (the name rule reads letter case, so
a copy in capitals has other names), and ``EXACT``, where all tokens stand as they are. Windows of ``WINDOW`` tokens get their hashes from
those by doubling: two neighbours, four, eight.

Items of the benchmark that differ in their slots alone are one template: the
same placeholders in the same places, equal values in the same places. Windows
are posted per template, so that a document meets a template once and not each
of its items; ``template_items`` tells the items of each. A window counts if
it meets in one of the forms in which it holds ``LEAST_WORDS`` plain words, or
exactly. Windows that meet at one shift between a document and a
template are an alignment, and its slots must be consistent: where the item repeats a value the document
repeats one too, and different values stay different.

A template is found when consistent alignments cover ``LEAST_SHARE`` of its
windows with enough plain words, or of all its windows. So one of any larger half of its windows has to
be met: only the rarest are used to find candidates, and a phrase that
many items begin with costs nothing.

An item shorter than a window is one window of its own length. A short item
loses most windows by one edit, so items of up to ``SHORT_WORDS`` tokens are also found where one token at most is
changed, added or left out: one of the two halves of the item is then whole, and the seeds are cut from
the halves at the place that gives both the most letters. Null and empty texts have no windows. A null ``doc_id`` or
``item_id`` is matched like any other; rows that repeat one are taken together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.settle import Settled, settle, settled

WINDOW = 8
LEAST_WORDS = 4
LEAST_SHARE = 0.5
#: Distinct window hashes of the benchmark up to which they are broadcast (16 MB); more are joined by a shuffle.
BROADCAST_WINDOWS = 1_000_000
#: Longer items keep half of their windows under one edit.
SHORT_WORDS = 3 * WINDOW - 2
#: Shorter items have to be met whole.
LEAST_EDITED = 5
#: Sizes of seeds and the least length of a half that holds one.
SEEDS = (7, 4, 2)

NUMBER_MARK, NAME_MARK, UNIT_MARK = "\ue001", "\ue002", "\ue003"
_MARKS = f"{NUMBER_MARK}-{UNIT_MARK}"
_NUMBER = r"[0-9](?:[0-9.,:/]*[0-9])?"
# The class of private signs holds the marks; written out as a range it makes the class ten times as slow.
_WORD = r"[^\s\p{Punct}\d\p{Co}]+"
_NAME = r"\p{Lu}(?<=[\p{Ll}0-9,;:] \p{Lu})\p{L}*"
#: Units that may follow a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml cl l gal s sec min h hr hrs hours hour minutes minute seconds second days day weeks week months month "
    "years year metres meters metre meter kilometres kilometers miles mile inches inch feet foot grams gram kilograms kilogram pounds pound litres liters "
    "litre liter percent degrees degree dollars dollar euros euro cents cent usd eur gbp").split()
_UNIT = rf"({NUMBER_MARK}{_NUMBER}[ -]?)((?i:{'|'.join(UNITS)})(?![\p{{L}}0-9]))"
#: Names of the hash arrays of the three forms.
NAMED, CASELESS, EXACT = "named", "caseless", "exact"


def marked_text(text: Column) -> Column:
    """The text with a mark before every slot."""
    marked = F.regexp_replace(F.regexp_replace(text, f"[{_MARKS}]", " "), f"({_NUMBER})", f"{NUMBER_MARK}$1")
    return F.regexp_replace(F.regexp_replace(marked, f"({_NAME})", f"{NAME_MARK}$1"), _UNIT, f"$1{UNIT_MARK}$2")


def tokens(text: Column) -> Column:
    """Array of tokens, lower-cased; a slot begins with the mark of its kind."""
    return _parted(marked_text(text))


def _parted(marked: Column) -> Column:
    return F.regexp_extract_all(F.lower(marked), F.lit(rf"[{_MARKS}]?(?:{_NUMBER}|{_WORD})"), F.lit(0))


def _is_slot(token: Column) -> Column:
    return (token >= NUMBER_MARK) & (token < chr(ord(UNIT_MARK) + 1))


def _plain(token: Column) -> Column:
    """The token without its mark."""
    return F.when(_is_slot(token), F.substring(token, 2, 1 << 30)).otherwise(token)


def _hashes(form: str) -> Column:
    """Hash of every token of ``tokens`` in a form."""
    if form == EXACT:
        return F.transform("tokens", lambda t: F.xxhash64(_plain(t)))
    if form == NAMED:
        return F.transform("tokens", lambda t: F.xxhash64(F.when(_is_slot(t), F.substring(t, 1, 1)).otherwise(t)))
    return F.transform("tokens", lambda t: F.xxhash64(
        F.when(F.startswith(t, F.lit(NAME_MARK)), F.substring(t, 2, 1 << 30)).when(_is_slot(t), F.substring(t, 1, 1)).otherwise(t)))


def _joined(array: Column, ahead: int, size: int) -> Column:
    """Hashes of pairs of an array's elements ``ahead`` apart; ``size`` tokens are joined by that."""
    pairs = F.zip_with(array, F.slice(array, F.lit(ahead + 1), F.size(array)), lambda a, b: F.xxhash64(a, b, F.lit(size)))
    return F.slice(pairs, F.lit(1), F.greatest(F.size(array) - ahead, F.lit(0)))


def _forms(df: DataFrame, wanted: dict[str, set[int]], *keep: str, flags: bool = False) -> DataFrame:
    """``keep`` and the columns ``<form>_<size>`` with the hashes of all windows of every form and size in ``wanted``, by doubling.

    With ``flags`` the columns ``has_names`` and ``has_slots`` tell where forms agree: a text
    without names has no ``CASELESS`` windows of its own, and one without slots shares the doubled arrays of ``NAMED``.
    """
    empty = F.array().cast("array<bigint>")
    for form, sizes in wanted.items():
        if not sizes:
            continue
        shared = lambda n: flags and form == EXACT and f"{NAMED}_{n}" in df.columns  # noqa: B023, E731
        base = _hashes(form)
        if flags and form == CASELESS:
            base = F.when(F.col("has_names"), base).otherwise(empty)
        if shared(1):
            base = F.when(F.col("has_slots"), base).otherwise(F.col(f"{NAMED}_1"))
        df, have = df.withColumn(f"{form}_1", base), [1]
        while have[-1] * 2 <= max(sizes):
            n = have[-1] * 2
            joined = _joined(F.col(f"{form}_{n // 2}"), n // 2, n)
            if shared(n):
                joined = F.when(F.col("has_slots"), joined).otherwise(empty if n == max(sizes) and n in wanted[NAMED] else F.col(f"{NAMED}_{n}"))
            df = df.withColumn(f"{form}_{n}", joined)
            have.append(n)
        for size in sorted(sizes - set(have)):
            half = max(n for n in have if n < size)
            df = df.withColumn(f"{form}_{size}", _joined(F.col(f"{form}_{half}"), size - half, size))
    return df.select(*keep, *[f"{form}_{n}" for form, sizes in wanted.items() for n in sorted(sizes)])


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``item_id, template, tokens, n, slots`` of every item that has tokens.

    ``template`` is a hash of the placeholders and plain words with every slot numbered by the first place of its value.
    """
    items = benchmark.select("item_id", tokens(F.col("text").cast("string")).alias("tokens")).where("size(tokens) > 0").distinct()
    numbered = F.transform("tokens", lambda t: F.when(_is_slot(t), F.concat(F.substring(t, 1, 1), F.array_position("tokens", t).cast("string"))).otherwise(t))
    return items.withColumn("shape", numbered).select("item_id", F.xxhash64("shape").alias("template"), "tokens", F.size("tokens").alias("n"), "shape")


def template_items(benchmark: DataFrame) -> DataFrame:
    """``item_id, template_item``: the template of every item, named by the smallest of its items; null is the smallest."""
    items = benchmark_items(benchmark).select("item_id", "template")
    first = items.groupBy("template").agg(F.min(F.struct(F.col("item_id").isNotNull(), "item_id")).alias("first"))
    return items.join(first, "template").select("item_id", F.col("first.item_id").alias("template_item")).distinct()


def template_windows(items: DataFrame, window: int, least_words: int) -> DataFrame:
    """``template, at, rich, hash`` of the windows of ``benchmark_items``, in every form that counts.

    ``rich`` windows hold ``least_words`` plain words, with names among them or without.
    """
    lengths = sorted(r["n"] for r in items.where(F.col("n") < window).select("n").distinct().collect())
    parts = []
    for size in [*lengths, window]:
        some = items.where(F.col("n") == size if size < window else F.col("n") >= window)
        hashed = _forms(some, {form: {size} for form in (NAMED, CASELESS, EXACT)}, "template", "tokens")
        each = hashed.select("template", "tokens", F.posexplode(F.arrays_zip(*[F.col(f"{f}_{size}").alias(f) for f in (NAMED, CASELESS, EXACT)])).alias("at", "hash"))
        part, enough = F.slice("tokens", F.col("at") + 1, F.lit(size)), min(size, least_words)
        plain = F.size(F.filter(part, lambda t: ~_is_slot(t))) >= enough
        with_names = F.size(F.filter(part, lambda t: ~_is_slot(t) | F.startswith(t, F.lit(NAME_MARK)))) >= enough
        parts.append(each.select("template", "at", F.explode(F.array(
            F.struct(plain.alias("use"), plain.alias("rich"), F.col(f"hash.{NAMED}").alias("hash")),
            F.struct(with_names.alias("use"), with_names.alias("rich"), F.col(f"hash.{CASELESS}").alias("hash")),
            F.struct(F.lit(True).alias("use"), with_names.alias("rich"), F.col(f"hash.{EXACT}").alias("hash")),
        )).alias("of")).where("of.use").select("template", "at", F.lit(size).alias("size"), "of.rich", "of.hash"))
    rows = reduce(DataFrame.union, parts)
    rich = rows.groupBy("template", "at", "size").agg(F.max("rich").alias("rich"), F.collect_set("hash").alias("hashes"))
    return rich.select("template", "at", "size", "rich", F.explode("hashes").alias("hash"))


def rarest_windows(windows: DataFrame, least_share: float) -> DataFrame:
    """The windows one of which has to be met for a template to be found: ``template, at, hash``.

    Of n windows ``least_share`` n have to be met, so some of any n - ceil(least_share n) + 1 is; those are
    taken that stand in the fewest templates. The same holds among the rich windows.
    """
    from pyspark.sql import Window

    common = windows.groupBy("hash").agg(F.count(F.lit(1)).alias("n_templates"))
    spread = windows.join(common, "hash").groupBy("template", "at").agg(F.max("n_templates").alias("spread"), F.first("rich").alias("rich"))
    ranked = spread.select(
        "*", F.row_number().over(Window.partitionBy("template").orderBy("spread", "at")).alias("place"), F.count(F.lit(1)).over(Window.partitionBy("template")).alias("n"),
        F.row_number().over(Window.partitionBy("template", "rich").orderBy("spread", "at")).alias("rich_place"), F.count(F.lit(1)).over(Window.partitionBy("template", "rich")).alias("n_rich"),
    )
    among = lambda place, n: F.col(place) <= F.col(n) - F.ceil(F.col(n) * least_share) + 1
    wanted = ranked.where(among("place", "n") | (F.col("rich") & among("rich_place", "n_rich"))).select("template", "at")
    return windows.join(wanted, ["template", "at"]).select("template", "at", "hash")


def edit_seeds(items: DataFrame, least_words: int) -> DataFrame:
    """``item_id, template, words, size, at, hash`` of two seeds of every short item with enough words that are no numbers.

    The item is cut in two where the shorter half has the most letters; each half gives one seed of
    the largest size it holds.
    """
    words = F.transform("tokens", _plain)
    short = (
        items.where(F.col("n").between(LEAST_EDITED, SHORT_WORDS)).withColumn("words", words)
        .where(F.size(F.filter("words", lambda w: ~w.rlike("^[0-9]"))) > least_words)
    )
    letters = lambda low, high: F.aggregate(F.slice("words", low, high), F.lit(0), lambda s, w: s + F.length(w))
    cut = F.array_max(F.transform(F.sequence(F.lit(2), F.col("n") - 2), lambda c: F.struct(
        F.least(letters(F.lit(1), c), letters(c + 1, F.col("n") - c)).alias("letters"), c.cast("int").alias("cut"))))["cut"]
    size_of = lambda length: reduce(lambda other, s: F.when(length >= s, s).otherwise(other), reversed(SEEDS), F.lit(None).cast("int"))
    halves = short.withColumn("cut", cut).select("item_id", "template", "tokens", "words", F.explode(F.array(
        F.struct(F.lit(0).alias("at"), size_of(F.col("cut")).alias("size")),
        F.struct(F.col("cut").alias("at"), size_of(F.col("n") - F.col("cut")).alias("size")))).alias("seed")).select("item_id", "template", "tokens", "words", "seed.*")
    hashed = _forms(halves, {EXACT: set(SEEDS)}, "item_id", "template", "words", "at", "size")
    hash_ = reduce(lambda other, s: F.when(F.col("size") == s, F.get(f"{EXACT}_{s}", F.col("at"))).otherwise(other), SEEDS, F.lit(None).cast("long"))
    return hashed.select("item_id", "template", "words", "size", "at", hash_.alias("hash"))


def window_hits(docs: DataFrame, known: DataFrame, wanted: dict[str, set[int]], run: Settled) -> DataFrame:
    """``doc_id, stamp, place, hash`` of the windows of documents that stand in ``known(hash)``; one pass over the texts."""
    text = F.col("text").cast("string")
    marked = docs.select("doc_id", F.xxhash64(text).alias("stamp"), marked_text(text).alias("marked"))
    has = lambda mark: F.contains("marked", F.lit(mark))
    parted = marked.select("doc_id", "stamp", _parted(F.col("marked")).alias("tokens"), has(NAME_MARK).alias("has_names"), (has(NAME_MARK) | has(NUMBER_MARK)).alias("has_slots"))
    hashed = _forms(parted, wanted, "doc_id", "stamp", flags=True)
    names = [c for c in hashed.columns if c not in ("doc_id", "stamp")]
    each = hashed.select("doc_id", "stamp", F.posexplode(F.arrays_zip(*names)).alias("place", "hashes"))
    rows = each.select("doc_id", "stamp", "place", F.explode(F.array(*[F.col(f"hashes.{n}") for n in names])).alias("hash")).where("hash is not null")
    small = known.count() <= BROADCAST_WINDOWS
    # Forms that agree give a hit twice; there are few hits, so they are made distinct here and not in every window.
    return run.keep(rows.join(F.broadcast(known) if small else known, "hash", "left_semi").select("doc_id", "stamp", "place", "hash").distinct(), "window-hits")


def _same(x: str, y: str) -> Column:
    return F.col(f"{x}.doc_id").eqNullSafe(F.col(f"{y}.doc_id")) & (F.col(f"{x}.stamp") == F.col(f"{y}.stamp"))


def _tokens_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``doc_id, stamp, words`` of the chosen documents, their tokens without marks."""
    text = F.col("text").cast("string")
    stamped = docs.select("doc_id", F.xxhash64(text).alias("stamp"), text.alias("text"))
    found = stamped.alias("d").join(chosen.select("doc_id", "stamp").distinct().alias("c"), _same("d", "c"), "left_semi").distinct()
    return found.select("doc_id", "stamp", tokens(F.col("text")).alias("tokens")).select("doc_id", "stamp", F.transform("tokens", _plain).alias("words"))


def _by_windows(docs: DataFrame, items: DataFrame, windows: DataFrame, probes: DataFrame, hits: DataFrame, least_share: float, run: Settled) -> DataFrame:
    """``doc_id, template, matched_windows, item_windows, n_slots``."""
    candidates = run.keep(hits.join(probes.select("template", "hash").distinct(), "hash").select("doc_id", "stamp", "template").distinct(), "candidates")
    wanted = candidates.join(windows, "template")
    shifted = ["doc_id", "stamp", "template", "shift"]
    matches = wanted.alias("w").join(hits.alias("h"), _same("w", "h") & (F.col("w.hash") == F.col("h.hash"))).select(
        "w.doc_id", "w.stamp", "w.template", "at", "size", "rich", (F.col("place") - F.col("at")).alias("shift"))
    runs = run.keep(
        matches.groupBy(*shifted).agg(F.min("at").alias("low"), F.max(F.col("at") + F.col("size")).alias("high"), F.collect_set(F.struct("at", "rich")).alias("met")),
        "alignments",
    )
    slots = items.select("template", F.posexplode("shape").alias("at", "slot")).where(_is_slot(F.col("slot"))).distinct()
    aligned = (
        runs.join(slots, "template").where("at >= low and at < high")
        .select(*shifted, F.substring("slot", 1, 1).alias("kind"), "slot", (F.col("at") + F.col("shift")).alias("place"))
    )
    values = _tokens_of(docs, runs).select("doc_id", "stamp", F.posexplode("words").alias("place", "value"))
    checked = (
        aligned.alias("a").join(values.alias("v"), _same("a", "v") & (F.col("a.place") == F.col("v.place")))
        .select(*[F.col(f"a.{c}") for c in shifted], "kind", "slot", "value").groupBy(*shifted)
        .agg(F.count(F.lit(1)).alias("slots"), F.countDistinct("kind", "slot", "value").alias("links"),
             F.countDistinct("kind", "slot").alias("left"), F.countDistinct("kind", "value").alias("right"))
    )
    same_run = reduce(Column.__and__, [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in shifted])
    met = (
        runs.alias("r").join(checked.alias("c"), same_run, "left").where("slots is null or (links = left and links = right)")
        .select("r.doc_id", "r.template", F.coalesce("slots", F.lit(0)).alias("slots"), F.explode("met").alias("met"))
        .groupBy("doc_id", "template", "met").agg(F.max("slots").alias("slots"))
        .groupBy("doc_id", "template").agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("met.rich")).alias("rich"), F.max("slots").cast("long").alias("n_slots"))
    )
    totals = windows.select("template", "at", "rich").distinct().groupBy("template").agg(F.count(F.lit(1)).alias("n_all"), F.count_if("rich").alias("n_rich"))
    enough = lambda part, whole: (F.col(part) > 0) & (F.col(part) >= F.col(whole) * least_share)
    by_rich = enough("rich", "n_rich")
    return met.join(totals, "template").where(by_rich | enough("all", "n_all")).select(
        "doc_id", "template", F.when(by_rich, F.col("rich")).otherwise(F.col("all")).alias("matched_windows"),
        F.when(by_rich, F.col("n_rich")).otherwise(F.col("n_all")).alias("item_windows"), "n_slots")


def _by_edits(docs: DataFrame, seeds: DataFrame, hits: DataFrame, run: Settled) -> DataFrame:
    """``doc_id, template, matched_windows, item_windows`` of short items found with one edit at most, counted in tokens."""
    n = F.size("item_words")
    near = F.array(*[F.col("place") - F.col("at") + d for d in (-1, 0, 1)])
    spots = run.keep(hits.join(seeds, "hash").select("doc_id", "stamp", "template", F.col("words").alias("item_words"), F.explode(near).alias("start")).distinct(), "seed-hits")
    met = (
        spots.alias("s").join(_tokens_of(docs, spots).alias("w"), _same("s", "w")).where("start >= 0")
        .select("s.doc_id", "template", "item_words", F.slice("words", F.col("start") + 1, n + 1).alias("part")).distinct()
        .select("*", F.explode(F.array(n - 1, n, n + 1)).alias("length")).where(F.size("part") >= F.col("length"))
        .withColumn("part", F.slice("part", F.lit(1), F.col("length")))
    )
    other = lambda x, y: F.array_position(F.zip_with(x, y, lambda a, b: a.eqNullSafe(b)), False)
    equal = lambda x, y: F.when(other(x, y) == 0, n).otherwise(other(x, y) - 1)
    agreeing = equal(F.col("item_words"), F.col("part")) + equal(F.reverse("item_words"), F.reverse("part"))
    return (
        met.withColumn("agreeing", agreeing).where(F.col("agreeing") >= F.greatest(n, F.col("length")) - 1)
        .groupBy("doc_id", "template").agg(F.max(F.least("agreeing", n)).cast("long").alias("matched_windows"), F.max(n).cast("long").alias("item_windows"))
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_share: float = LEAST_SHARE, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, item_id, matched_windows, item_windows, n_slots, n_items`` of each template found in a document.

    ``item_id`` names the template by the smallest of its ``n_items`` items (``template_items``). A template found
    by ``_by_edits`` only has counts of tokens.
    """
    with settled(docs.sparkSession) as run:
        items = run.keep(benchmark_items(benchmark), "items")
        windows = run.keep(template_windows(items, window, least_words), "benchmark-windows")
        probes = run.keep(rarest_windows(windows, least_share), "probes")
        seeds = run.keep(edit_seeds(items, least_words), "seeds")
        sizes = {r["size"] for r in windows.select("size").distinct().collect()}
        seed_sizes = {r["size"] for r in seeds.select("size").distinct().collect()}
        none = docs.select("doc_id").where("false").select("doc_id", *[F.lit(0).cast("long").alias(c) for c in ("template", "matched_windows", "item_windows", "n_slots", "first")])
        found = none
        if sizes:
            known = run.keep(windows.select("hash").union(seeds.select("hash")).distinct(), "known")
            hits = window_hits(docs, known, {NAMED: sizes, CASELESS: sizes, EXACT: sizes | seed_sizes}, run)
            found = found.union(_by_windows(docs, items, windows, probes, hits, least_share, run).withColumn("first", F.lit(1)))
            if seed_sizes:
                found = found.union(_by_edits(docs, seeds, hits, run).withColumns({"n_slots": F.lit(0).cast("long"), "first": F.lit(0)}))
        best = F.max(F.struct("first", "matched_windows", "item_windows", "n_slots")).alias("best")
        names = items.groupBy("template").agg(F.min(F.struct(F.col("item_id").isNotNull(), "item_id")).alias("name"), F.countDistinct(F.struct("item_id")).alias("n_items"))
        return settle(
            found.groupBy("doc_id", "template").agg(best).join(names, "template")
            .select("doc_id", "name.item_id", "best.matched_windows", "best.item_windows", "best.n_slots", "n_items"), "contaminated")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents in which a benchmark item is found go.

    Null, empty and clean texts stay; rows that repeat an id go together; an empty table gives an empty one.
    """
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct()
    return docs.alias("d").join(found.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")), "left_anti").select(*[f"d.{c}" for c in docs.columns])
