from pyspark.sql import functions as F

from marketlens import schemas
from marketlens.operators.cleaning import clean_prices
from marketlens.sources import audit, readers, writers
from marketlens.streaming.ingest import append_new_rows, incremental_ingest


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


PRICE_HEAD = writers.BOM + ",".join(schemas.PRICE_HEADER) + "\n"
RAW_HEAD = ",".join(schemas.RAW_PRICE_HEADER) + "\n"


def test_prices_with_bom_and_bad_tokens(spark, tmp_path):
    put(tmp_path / "p" / "a.csv", PRICE_HEAD + '白菜,"市场, 一",1,3,2.5,2024-01-05,shandong,baicai,山东\n葱,m,1,3,x,2024-01-05,s,c,山东\n葱,m,1,3,2,2024-01-05,t,c,台湾\n葱,m,1,3,2,2024-01-05,t,c,\n')
    rows = readers.read_prices(spark, str(tmp_path / "p")).collect()
    assert [(r.variety, r.market, r.avg_price) for r in rows] == [("白菜", "市场, 一", 2.5)]


def test_lenient_rows(spark, tmp_path):
    put(tmp_path / "r" / "a.csv", RAW_HEAD + "a,m,1,3,2,d,p,t,c\nshort,m\nlong,m,1,3,2,d,p,t,c,more,more\n")
    kept, malformed = readers.read_lenient(spark, str(tmp_path / "r"), schemas.RAW_PRICES)
    assert sorted(r.variety for r in kept.collect()) == ["a", "short"]
    assert [(r.variety, r._surplus) for r in malformed.collect()] == [("long", "more")]


def test_search_export_quotes_free_text(spark, tmp_path):
    rows = spark.createDataFrame(
        [('a "b", c', "r", "x", 3, "2024-01-05", "u", "v"), ("d", None, "x", 1, None, "u", "v")],
        "product_name string, supply_region string, company_name string, click_count int, publish_date string, product_url string, variety string",
    ).withColumn("publish_date", F.col("publish_date").cast("date"))
    path = writers.write_search_csv(rows, "seeds", str(tmp_path / "out"))
    # Read the bytes: the text source drops a byte-order mark.
    (part,) = (tmp_path / "out").glob("part-*.txt")
    lines = part.read_text(encoding="utf-8").splitlines()
    assert lines[0] == writers.BOM + ",".join(schemas.SEED_EXPORT_HEADER)
    assert lines[1:] == ['"a ""b"", c","r","x",v,3,2024-01-05,u', '"d","","x",v,1,,u']


def test_any_other_kind_exports_suppliers(spark):
    rows = spark.createDataFrame([("n", "o", "c", "t", 1, "u", "v")], "product_name string, origin string, contact_person string, company_type string, click_count int, product_url string, variety string").withColumn("publish_date", F.lit("2024-01-01").cast("date"))
    lines = [r.line for r in writers.search_csv_lines(rows, "whatever").orderBy("line_no").collect()]
    assert lines[1] == '"n","o","c",t,v,1,2024-01-01,u'


def test_result_is_computed_until_stored(spark, tmp_path):
    path = str(tmp_path / "res")
    compute = lambda: spark.range(3)
    assert readers.result_or_compute(spark, path, compute).count() == 3
    writers.write_result(spark.range(5), path)
    assert readers.result_or_compute(spark, path, compute).count() == 5


def test_audit_reports_missing(spark, tmp_path):
    path = writers.write_clean(spark.range(4).repartition(2), str(tmp_path / "t"))
    df = readers.read_csv(spark, path, readers.as_text(spark.range(1).schema))
    got = {r.table_name: r for r in audit.landing_audit({"t": df, "gone": None}).collect()}
    assert (got["t"].present, got["t"].row_count, got["t"].files) == (True, 4, 2)
    assert (got["gone"].present, got["gone"].row_count) == (False, 0)


def line(variety, price, day):
    return f"{variety},m,1,3,{price},{day},shandong,t,c\n"


def test_ingest_takes_each_file_and_row_once(spark, tmp_path):
    land, table, ckpt = tmp_path / "land", str(tmp_path / "table"), str(tmp_path / "ckpt")
    run = lambda: incremental_ingest(spark, str(land), schemas.RAW_PRICES, table, ckpt, clean_prices, max_files=1)
    put(land / "1.csv", RAW_HEAD + line("a", 2, "2024-03-01") + line("a", "￥2", "2024/3/1") + line("bad", "x", "2024-03-01"))
    assert run().count() == 1
    assert run().count() == 1
    # A copy, a much older row and a new one: nothing is lost for being late.
    put(land / "2.csv", RAW_HEAD + line("a", 2, "2024-03-01") + line("old", 5, "2019-01-01"))
    put(land / "3.csv", RAW_HEAD + line("old", 5, "2019-01-01") + line("new", 7, "2024-04-01"))
    assert sorted(r.variety for r in run().collect()) == ["a", "new", "old"]


def test_new_checkpoint_keeps_old_rows(spark, tmp_path):
    land, table = tmp_path / "land", str(tmp_path / "table")
    run = lambda ckpt, folder: incremental_ingest(spark, str(folder), schemas.RAW_PRICES, table, str(tmp_path / ckpt), clean_prices)
    put(land / "1.csv", RAW_HEAD + line("a", 2, "2024-03-01") + line("a", 3, "2024-03-02"))
    assert run("first", land).count() == 2
    other = tmp_path / "other"
    put(other / "2.csv", RAW_HEAD + line("b", 5, "2024-03-01") + line("a", 2, "2024-03-01"))
    assert sorted((r.variety, r.avg_price) for r in run("second", other).collect()) == [("a", 2.0), ("a", 3.0), ("b", 5.0)]
    assert run("first", land).count() == 3


def test_export_has_no_limit_unless_asked(spark, tmp_path):
    rows = spark.range(120_000).selectExpr(
        "concat('p', id) as product_name", "'r' as supply_region", "'x' as company_name", "cast(id as int) as click_count",
        "date_add(date '2024-01-01', cast(id % 300 as int)) as publish_date", "'u' as product_url", "'v' as variety")
    writers.write_search_csv(rows, "seeds", str(tmp_path / "all"))
    lines = [x for p in sorted((tmp_path / "all").glob("part-*.txt")) for x in p.read_text(encoding="utf-8").splitlines()]
    days = [x.split(",")[5] for x in lines[1:]]
    assert len(lines) == 120_001 and lines[0].startswith(writers.BOM) and days == sorted(days, reverse=True)
    assert writers.search_csv_lines(rows, "seeds", limit=50).count() == 51


def test_retried_batch_does_not_double(spark, tmp_path):
    write = append_new_rows(str(tmp_path / "t"), lambda df: df, "day")
    rows = spark.createDataFrame([(1, None), (2, "2024-01-01")], "k int, day string").withColumn("day", F.col("day").cast("date"))
    write(rows, 0)
    write(rows, 0)
    write(rows.union(rows.withColumn("k", F.col("k") + 10)), 1)
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 2, 11, 12]


def test_offers_are_dealt_by_the_number_of_lines(spark, monkeypatch):
    from marketlens.sources import star_views

    monkeypatch.setattr(star_views, "OFFER_LINES", 10)
    lines = spark.range(400).selectExpr("id % 150 AS l_partkey", "id % 3 AS l_suppkey", "date_add(DATE '2024-01-01', cast(id as int)) AS l_shipdate")
    offers = star_views._offers(lines, "day")
    assert offers.rdd.getNumPartitions() == 40
    assert offers.count() == 150 and str(offers.agg({"day": "max"}).first()[0]) == "2024-05-29"


def test_appended_files_are_bounded(spark, tmp_path):
    path = str(tmp_path / "landed")
    rows = spark.range(95).selectExpr("cast(id as string) AS a").coalesce(1)
    writers.append_rows(rows, path, file_rows=10)
    files = [f.read_text().split() for f in sorted((tmp_path / "landed").glob("*.csv"))]
    assert len(files) == 10 and all(f[0] == "a" and len(f) <= 11 for f in files) and sum(len(f) - 1 for f in files) == 95


def test_compressed_landing_is_read_alike(spark, tmp_path):
    rows = spark.range(95).selectExpr("cast(id as string) AS a", "concat('x, \"', id, '\"') AS b").coalesce(1)
    writers.write_clean(rows, str(tmp_path / "t"), compression="gzip", file_rows=10)
    assert len(list((tmp_path / "t").glob("*.csv.gz"))) == 10
    assert sorted(readers.read_csv(spark, str(tmp_path / "t"), rows.schema).collect()) == sorted(rows.collect())
    writers.append_rows(rows, str(tmp_path / "u"), file_rows=50, compression="gzip")
    assert len(list((tmp_path / "u").glob("*.csv.gz"))) == 2 and readers.read_csv(spark, str(tmp_path / "u"), rows.schema).count() == 95
