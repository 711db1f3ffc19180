"""Stored states, compaction, watermarks, stored models and the structures behind the newer queries."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketlens import schemas
from marketlens.functions.markup import named_references, tables_of
from marketlens.operators import forecast_ml, model_store, pages, periods, sketches, text_index
from marketlens.operators.cleaning import clean_prices, price_rejects
from marketlens.operators.search import keyword_filter
from marketlens.plans import batch
from marketlens.sources import held_urls, observed, readers, snapshots
from marketlens.streaming import ingest

HEAD = "variety,market,min_price,max_price,avg_price,date,province,crawl_ts,variety_code\n"


def line(variety, price, day):
    return f"{variety},m,1,3,{price},{day},shandong,t,c\n"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.fixture
def landed(spark, tmp_path):
    """Lands a file and takes it in; returns the whole table."""
    table = str(tmp_path / "table")

    def take(name, *lines, checkpoint="first"):
        put(tmp_path / "land" / name, HEAD + "".join(lines))
        return ingest.incremental_ingest(spark, str(tmp_path / "land"), schemas.RAW_PRICES, table, str(tmp_path / checkpoint), clean_prices, states=ingest.REPORT_STATES)

    take.table = table
    return take


def reports(spark, table):
    cells, days = (ingest.stored_state(spark, table, s) for s in ("cells", "days"))
    return {n: sorted(map(tuple, r.collect()), key=str) for n, r in batch.cell_reports(cells, days).items()}


def from_scratch(rows):
    found = batch.cell_reports(batch.quote_cells(rows), batch.cells_by(rows, "price_date"))
    return {n: sorted(map(tuple, r.collect()), key=str) for n, r in found.items()}


def test_reports_from_cells_equal_reports_from_rows(spark, landed):
    rng = random.Random(1)
    some = lambda: [line(rng.choice("abc"), rng.randrange(1, 90), f"2024-{rng.randrange(1, 5):02}-{rng.randrange(1, 29):02}") for _ in range(60)]
    first = some()
    rows = landed("1.csv", *first)
    assert reports(spark, landed.table) == from_scratch(rows)
    rows = landed("2.csv", *some(), *first[:20])
    assert reports(spark, landed.table) == from_scratch(rows) and rows.count() == rows.distinct().count()
    rows = landed("1.csv", *first, checkpoint="second")
    assert reports(spark, landed.table) == from_scratch(rows)
    after = ingest.compact(spark, landed.table, "2024-04", ingest.REPORT_STATES)
    assert {m: n for m, n in after.parts_of().items() if m < "2024-04"} == dict.fromkeys(("2024-01", "2024-02", "2024-03"), 1)
    assert reports(spark, landed.table) == from_scratch(rows)
    assert sorted(map(tuple, ingest.stored_rows(spark, landed.table).collect())) == sorted(map(tuple, rows.collect()))
    # Rows that were compacted are still known: their copies do not come back.
    n = rows.count()
    assert landed("3.csv", *first[:30]).count() == n


def test_reports_read_no_quotes(spark, landed):
    landed("1.csv", line("a", 2, "2024-03-01"), line("b", 4, "2024-02-05"))
    cells, days = (ingest.stored_state(spark, landed.table, s) for s in ("cells", "days"))
    for report in batch.cell_reports(cells, days).values():
        assert all("/_state_" in f for f in report.inputFiles()) and report.inputFiles()


def test_a_failed_rewrite_changes_nothing(spark, landed, monkeypatch):
    landed("1.csv", line("a", 2, "2024-03-01"))
    landed("2.csv", line("a", 3, "2024-03-02"))
    before = snapshots.current(spark, landed.table)

    def broken(*_):
        raise OSError("disk")

    with monkeypatch.context() as m:
        m.setattr(ingest, "fold_cells", broken)
        with pytest.raises(OSError):
            ingest.compact(spark, landed.table, "2024-04", ingest.REPORT_STATES)
    assert snapshots.current(spark, landed.table) == before and ingest.stored_rows(spark, landed.table).count() == 2
    after = ingest.compact(spark, landed.table, "2024-04", ingest.REPORT_STATES)
    assert after.version == before.version + 1 and ingest.stored_rows(spark, landed.table).count() == 2
    assert ingest.compact(spark, landed.table, "2024-04", ingest.REPORT_STATES) == after
    tables = ("", *[ingest.state_folder(s) for s in ingest.REPORT_STATES])
    # Both parts of the month and the rows of the broken rewrite go, from the rows and from both states.
    assert len(snapshots.remove_unlisted(spark, landed.table, tables)) == 7
    assert ingest.stored_rows(spark, landed.table).count() == 2 and reports(spark, landed.table)["price_trend"]
    with pytest.raises(RuntimeError, match="another writer"):
        snapshots.commit(spark, landed.table, after)


def test_empty_table(spark, tmp_path):
    put(tmp_path / "land" / "1.csv", HEAD)
    got = ingest.incremental_ingest(spark, str(tmp_path / "land"), schemas.RAW_PRICES, str(tmp_path / "t"), str(tmp_path / "c"), clean_prices, states=ingest.REPORT_STATES)
    assert got.count() == 0 and got.columns == schemas.CLEAN_PRICES.names
    assert ingest.stored_rows(spark, str(tmp_path / "nothing")) is None


def test_watermark_keeps_new_rows_and_sets_late_ones_apart(spark, tmp_path):
    def take(name, *lines):
        put(tmp_path / "land" / name, HEAD + "".join(lines))
        kept, late = ingest.watermarked_ingest(spark, str(tmp_path / "land"), schemas.RAW_PRICES, str(tmp_path / "t"), str(tmp_path / "c"), clean_prices, delay="30 days")
        show = lambda df: sorted((r.variety, str(r.price_date)) for r in df.collect())
        return show(kept), show(late)

    old, new = line("old", 1, "2019-01-01"), line("a", 2, "2024-03-05")
    kept, late = take("1.csv", new, new, old)
    assert kept == [("a", "2024-03-05"), ("old", "2019-01-01")] and late == []
    kept, late = take("2.csv", new, old, line("b", 3, "2024-02-10"), line("edge", 3, "2024-02-04"))
    assert kept == [("a", "2024-03-05"), ("b", "2024-02-10"), ("old", "2019-01-01")]
    assert late == [("edge", "2024-02-04"), ("old", "2019-01-01")]


def test_model_is_fitted_once_per_input(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer

    rows, calls = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", None)], "v string, x double"), []

    def fit(df):
        calls.append(1)
        return Pipeline(stages=[StringIndexer(inputCol="v", outputCol="i")]).fit(df)

    get = lambda df, **settings: model_store.stored_model(spark, {"rows": df}, lambda: fit(df), settings, str(tmp_path / "models"))
    first, again = get(rows), get(rows.repartition(3).select("x", "v"))
    assert len(calls) == 1 and first.transform(rows).collect() == again.transform(rows).collect()
    get(rows.union(rows.limit(1)))
    get(rows, trees=3)
    assert len(calls) == 3 and len(list((tmp_path / "models").iterdir())) == 3
    assert model_store.table_digest(rows) != model_store.table_digest(rows.withColumnRenamed("x", "y"))


def test_forest_is_read_back(spark, tmp_path):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int"))
    quotes = spark.range(600).select(F.concat(F.lit("v"), F.col("id") % 3).alias("variety"), F.lit("p").alias("province"), day.alias("price_date"), (F.col("id") % 17 + 5.0).alias("avg_price"))
    listing = spark.range(5).select(F.lit("v0").alias("variety"), F.lit("2024-01-02").cast("date").alias("publish_date"))
    inputs = forecast_ml.narrow_inputs(quotes, listing, listing)
    once = forecast_ml.fitted(*inputs, folder=str(tmp_path), num_trees=2)
    back = forecast_ml.fitted(*inputs, folder=str(tmp_path), num_trees=2)
    show = lambda model: forecast_ml.forecast(model, *inputs).orderBy("horizon", "rank").collect()
    assert show(once) == show(back) and len(list(tmp_path.iterdir())) == 1


def test_nested_tables():
    inner = "<TABLE class=x><tr><td>1<td>2</table>"
    got = tables_of(f"<table id=a><tr><td>left &eacute;&lt;<td>a {inner} b</td></tr><tr><td>last</table> after <table><td>only")
    assert [t["opening"].strip() for t in got] == ["id=a", "class=x", ""]
    cell = lambda own, whole=None: {"own": own, "whole": whole}
    assert got[0]["rows"] == [[cell("left é&lt;"), cell("a  b", f"a {inner} b")], [cell("last")]]
    assert got[1]["rows"] == [[cell("1"), cell("2")]] and got[2]["rows"] == [[cell("only")]]
    assert tables_of(None) == tables_of("") == tables_of("</table></td><!-- <table><tr><td>x</table> -->") == []
    assert named_references("&hearts;&amp;&nothing;") == "♥&amp;&nothing;"
    deep = "<table><tr><td>" * 300 + "x" + "</table>" * 300
    assert len(tables_of(deep)) == 300 and tables_of(deep)[-1]["rows"] == [[cell("x")]]


@pytest.mark.parametrize("base,href,want", [
    ("http://a.com/l/", "//cdn.com/x", "http://cdn.com/x"), ("https://a.com/l", "//cdn.com/x", "https://cdn.com/x"), ("http://a.com/l/", "httpdocs/y", "http://a.com/l/httpdocs/y"),
    ("http://a.com/l/", "HTTP://o.com/", "HTTP://o.com/"), ("http://a.com/l/", "/x", "http://a.com/x"), ("http://a.com/l", "x", "http://a.com/l/x"),
])
def test_url_resolve(spark, base, href, want):
    assert spark.createDataFrame([(base, href)], "b string, h string").select(pages.url_resolve("b", "h")).first()[0] == want


def test_rejects_and_more_dates(spark):
    days = ["2024-01-05T10:20:30Z", "2024-01-05T10:20", "20240105", "2024年1月5日", "2024.1.5", "2024-01-05 10:20:30.5+08:00", "2024-13-05", "soon", None]
    raw = spark.createDataFrame([("v", "m", "1", "3", "2", d, "shandong", "t", "c") for d in days] + [("v", "m", "1", "3", "x", "2024-01-05", "p", "t", "c")], schemas.RAW_PRICES)
    assert [str(r.price_date) for r in clean_prices(raw).select("price_date").distinct().collect()] == ["2024-01-05"]
    assert sorted((str(r.date), r.reason) for r in price_rejects(raw).collect()) == [("2024-01-05", "no price"), ("2024-13-05", "no date"), ("None", "no date"), ("soon", "no date")]


def test_periods_against_plain_sums(spark):
    rng = random.Random(7)
    start = dt.date(2024, 1, 1)
    quotes = [(rng.choice("ab"), start + dt.timedelta(rng.randrange(200)), rng.choice([None, rng.randrange(100) / 8])) for _ in range(700)] + [("a", None, 5.0)]
    ranges = [(i, start + dt.timedelta(rng.randrange(-20, 220)), start + dt.timedelta(rng.randrange(-20, 220))) for i in range(300)]
    ranges += [(900, None, None), (901, None, start), (902, start + dt.timedelta(199), None), (903, dt.date(2030, 1, 1), None)]
    table, asked = spark.createDataFrame(quotes, "variety string, price_date date, avg_price double"), spark.createDataFrame(ranges, "period_no int, date_from date, date_to date")

    def plain(first, last, only=None):
        chosen = [q for q in quotes if q[1] and (first is None or q[1] >= first) and (last is None or q[1] <= last) and only in (None, q[0])]
        prices = [q[2] for q in chosen if q[2] is not None]
        mean = round(sum(prices) / len(prices) + 1e-9, 2) if prices else None
        return mean, min(prices, default=None), max(prices, default=None), len(chosen)

    close = lambda a, b: a[3] == b[3] and all((x is None) == (y is None) and (x is None or abs(x - y) < 0.011) for x, y in zip(a[:3], b[:3], strict=True))
    got = {r[0]: tuple(r[c] for c in ("avg_price", "min_price", "max_price", "record_count")) for r in periods.period_statistics(table, asked).collect()}
    assert len(got) == len(ranges) and all(close(got[i], plain(a, b)) for i, a, b in ranges)
    split = {(r["period_no"], r["variety"]): tuple(r[c] for c in ("avg_price", "min_price", "max_price", "record_count")) for r in periods.period_statistics(table, asked, "variety").collect()}
    wrong = [(i, v, split.get((i, v)), plain(a, b, v)) for i, a, b in ranges for v in "ab" if not close(split.get((i, v), (None, None, None, 0)), plain(a, b, v))]
    assert len(split) > 300 and not wrong
    assert [r.record_count for r in periods.period_statistics(table.limit(0), asked).collect()] == [0] * len(ranges)


def test_sketches_of_many_values(spark):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 120).cast("int"))
    quotes = spark.range(60_000).select(day.alias("price_date"), F.concat(F.lit("m"), F.col("id") % 20_000).alias("market"), (F.col("id") % 2).cast("string").alias("province"))
    stored = sketches.monthly_sketches(quotes, "market", "province")
    exact = sketches.exact_distinct(quotes, "market", "province", first="2024-02", last="2024-03")
    got = sketches.within(sketches.estimated_distinct(stored, "province", first="2024-02", last="2024-03"), exact, "province").collect()
    assert len(got) == 2 and all(r.in_bound and r.n_distinct > 5000 for r in got)


def test_postings_find_what_the_scan_finds(spark, tmp_path):
    rng = random.Random(3)
    name = lambda: " ".join(rng.choice(["Red", "reddish", "blue", "gr", "é—ü", "bLueRed", "red b"]) for _ in range(3))
    rows = spark.createDataFrame([(i, name() if i % 11 else None, name()) for i in range(500)], "k int, a string, b string")
    text_index.build(rows, str(tmp_path / "i"), "a", "b", part_rows=50)
    for keyword in ("red", "Red|é—ü", "red b", "gr", "r.d", "zzz", "blueRed"):
        got = text_index.find(spark, str(tmp_path / "i"), keyword, "a", "b")
        assert sorted(r.k for r in got.collect()) == sorted(r.k for r in keyword_filter(rows, keyword, "a", "b").collect()), keyword
    plan = text_index.find(spark, str(tmp_path / "i"), "bLueRed", "a", "b")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and ("dynamicpruning" in plan or "LeftSemi" in plan)


def test_parts_of_the_stored_table_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text_index, "MAX_PARTS", 5)
    rows = spark.range(400).select("id", F.concat(F.lit("word"), F.col("id") % 7).alias("a"))
    text_index.build(rows, str(tmp_path / "i"), "a", part_rows=10)
    assert spark.read.parquet(str(tmp_path / "i/rows")).agg(F.countDistinct("part"), F.count("id")).first()[:] == (5, 400)
    assert text_index.find(spark, str(tmp_path / "i"), "word3", "a").count() == rows.where("a = 'word3'").count()


def test_held_side_is_not_moved(spark, tmp_path):
    held_pages = spark.createDataFrame([(f"http://h/{i}",) for i in range(50)] + [(None,)], "url string")
    held = held_urls.write_held(held_pages, "held_for_test", str(tmp_path / "held"), buckets=4)
    links = spark.createDataFrame([(f"http://h/{i}",) for i in range(40, 60)] * 2 + [(None,)], "target string")
    left = held_urls.not_held(links, held)
    assert sorted(r.target for r in left.collect()) == sorted(f"http://h/{i}" for i in range(50, 60))
    lines = left._jdf.queryExecution().executedPlan().toString().split("\n")
    scan = next(i for i, text in enumerate(lines) if "held_for_test" in text)
    join = next(i for i, text in enumerate(lines) if "LeftAnti" in text)
    depth = lambda text: len(text) - len(text.lstrip(" :+-"))
    above = [text for i, text in enumerate(lines[: scan + 1]) if i > join and depth(text) <= depth(lines[scan])]
    held_side = lines[max(i for i, text in enumerate(lines[:scan]) if depth(text) == depth(lines[join]) + 3 or i == join) : scan + 1]
    assert above and not any("Exchange" in text for text in held_side)
    spark.sql("DROP TABLE held_for_test")


def test_counts_while_writing(spark, tmp_path):
    rows = spark.createDataFrame([("a", None), (None, 1), ("c", 2)], "x string, y int")
    got = observed.write_observed(rows, str(tmp_path / "t"), observed.null_counts(rows))
    assert got == {"rows": 3, "null_x": 1, "null_y": 1} and spark.read.parquet(str(tmp_path / "t")).count() == 3
    assert observed.write_observed(rows.limit(0), str(tmp_path / "e"), observed.null_counts(rows)) == {"rows": 0, "null_x": 0, "null_y": 0}
    assert observed.counts_frame(spark, {"t": got}).count() == 3


def test_landed_files_with_other_headers(spark, tmp_path):
    schema = readers.as_text(schemas.RAW_SEEDS)
    put(tmp_path / "l" / "1.csv", "﻿product_name,click_count,category\n\"two\nlines, and \"\"quotes\"\"\",5,c\nshort\nlong,1,c,more\n")
    put(tmp_path / "l" / "2.csv", "分类,unknown,产品名称\nc2,u,p2\n")
    put(tmp_path / "l" / "3.csv", "other,names\n1,2\n")
    put(tmp_path / "l" / "4.csv", "product_name,click_count,category\n")
    kept, lost = readers.read_landed(spark, str(tmp_path / "l"), schema, {"分类": "category", "产品名称": "product_name"})
    assert kept.columns == schema.names
    assert sorted(((r.product_name, r.click_count, r.category) for r in kept.collect()), key=str) == sorted(
        [('two\nlines, and "quotes"', "5", "c"), ("short", None, None), ("p2", None, "c2")], key=str)
    assert sorted((r.reason, r.record[:8]) for r in lost.collect()) == [("surplus field", '["long",'), ("unknown header", '["1","2"')]


def test_a_month_is_one_file_of_a_batch_unless_it_is_heavy(spark, tmp_path, monkeypatch):
    days = [f"2024-0{1 + i % 4}-{1 + i % 28:02}" for i in range(200)]
    put(tmp_path / "land" / "1.csv", HEAD + "".join(line(f"v{i}", 1 + i, d) for i, d in enumerate(days)))
    take = lambda name: ingest.watermarked_ingest(
        spark, str(tmp_path / "land"), schemas.RAW_PRICES, str(tmp_path / name), str(tmp_path / f"{name}-c"), clean_prices,
        parse=lambda raw: clean_prices(raw, distinct=False))
    files = lambda name: len(list((tmp_path / name).glob("batch_id=0/table=kept/ym=*/*.parquet")))
    assert take("t")[0].count() == 200 and files("t") == 4
    monkeypatch.setattr(ingest, "MONTH_ROWS", 10)
    assert take("u")[0].count() == 200 and 4 < files("u") <= 20


def test_a_stream_that_leaves_copies_keeps_no_state_of_its_own(spark, tmp_path):
    put(tmp_path / "land" / "1.csv", HEAD + line("a", 2, "2024-03-05") * 3)
    kept, _ = ingest.watermarked_ingest(
        spark, str(tmp_path / "land"), schemas.RAW_PRICES, str(tmp_path / "t"), str(tmp_path / "c"), clean_prices, parse=lambda raw: clean_prices(raw, distinct=False))
    assert kept.count() == 1 and [p.name for p in (tmp_path / "c" / "state").iterdir()] == ["0"]


def test_unseen_rows_in_one_shuffle(spark, monkeypatch):
    rows = spark.range(100).selectExpr("id % 40 AS k", "IF(id % 40 = 3, NULL, 'x') AS v", "md5(cast(id % 40 AS string)) AS row_digest", "IF(id % 40 < 30, '2024-01', '2024-02') AS ym")
    held = rows.where("k >= 35 OR k < 2").select("ym", "row_digest").union(spark.sql("SELECT '2024-01', 'other'"))
    for heavy in (500_000, 10):
        monkeypatch.setattr(ingest, "MONTH_ROWS", heavy)
        new = ingest.unseen_rows(rows, held, ingest.month_counts(rows))
        # Nothing is shuffled but the rows and the held digests, once.
        assert str(new._jdf.queryExecution().executedPlan()).count("Exchange hashpartitioning") == 1
        assert new.columns == rows.columns and sorted(r.k for r in new.collect()) == list(range(2, 35))
        assert new.where("v IS NULL").count() == 1
    assert ingest.unseen_rows(rows, None, ingest.month_counts(rows)).count() == 40


def test_copies_left_in_give_the_same_table(spark, tmp_path):
    put(tmp_path / "land" / "1.csv", HEAD + "".join(line("a", p, "2024/3/5") for p in ("2", "2.0", "￥2", "-0", "0", "0.", "x")))
    plain, left = (
        ingest.incremental_ingest(spark, str(tmp_path / "land"), schemas.RAW_PRICES, str(tmp_path / n), str(tmp_path / f"{n}-c"), c)
        for n, c in (("plain", clean_prices), ("left", lambda raw: clean_prices(raw, distinct=False))))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, left.collect())) and left.count() == 2


def test_postings_are_packed_before_they_are_moved(spark, tmp_path):
    import numpy as np

    ids = np.array([5, 6, 133, 16517, 2**33 + 1, 3 * 2**33, 7, 9, 2**40], np.int64)
    starts = np.array([0, 6, 8])
    gaps = text_index.packed(ids, starts).to_pylist()
    assert [list(text_index.unpacked(int(ids[s]), g)) for s, g in zip(starts, gaps, strict=True)] == [[*ids[:6]], [7, 9], [2**40]]
    rows = spark.range(3000).select("id", F.concat(F.lit("common words "), F.md5(F.col("id").cast("string"))).alias("a"), F.when(F.col("id") % 3 == 0, "none").alias("b")).repartition(4)
    text_index.build(rows, str(tmp_path / "i"), "a", "b", part_rows=500)
    stored = spark.read.parquet(str(tmp_path / "i/postings"))
    # One row a part and triple, not one a posting: "mon" stands in 3,000 rows.
    assert stored.where("gram = 'mon'").count() <= 8 and stored.where("gram = 'mon'").agg(F.sum(F.length("gaps") + 1)).first()[0] < 2 * 3000
    for keyword in ("common words 1", "words c4", "none", "non|zzz", "mmon words "):
        got = text_index.find(spark, str(tmp_path / "i"), keyword, "a", "b")
        assert sorted(r.id for r in got.collect()) == sorted(r.id for r in keyword_filter(rows, keyword, "a", "b").collect()), keyword
