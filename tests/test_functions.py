import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlens.functions import dims
from marketlens.functions.dates import parse_date
from marketlens.functions.numbers import click_count, ratio, round_out, strip_currency, to_number
from marketlens.functions.text import contains_any, normalize_text, region_head
from marketlens.operators import cleaning


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first()["y"]


@pytest.mark.parametrize("text,want", [
    ("￥1,234.50元", 1234.5), ("¥ 3.2", 3.2), ("1，000", 1000.0), ("abc", None), ("", None), (None, None),
    ("12d", None), ("1e3", 1000.0), ("-2.5", -2.5), (".5", 0.5), ("　7　", 7.0),
])
def test_currency_text(spark, text, want):
    assert one(spark, text, to_number(strip_currency("x"))) == want


@pytest.mark.parametrize("text,want", [
    ("2024-1-5", dt.date(2024, 1, 5)), ("2024/01/05 3:04:05", dt.date(2024, 1, 5)), ("2024/1/5 13:04", dt.date(2024, 1, 5)),
    (" 2024-01-05 00:00:00 ", dt.date(2024, 1, 5)), ("2024-02-30", None), ("2024-1/5", None), ("未知", None), ("", None),
    ("2024-01-05 25:00:00", None), ("2024-01-05x", None), (None, None), ("nan", None),
])
def test_dates(spark, text, want):
    assert one(spark, text, parse_date("x")) == want


@pytest.mark.parametrize("value,digits,want", [
    (2.675, 2, 2.68), (-2.675, 2, -2.68), (1.005, 2, 1.0), (0.5, 0, 1.0), (-0.5, 0, -1.0), (None, 2, None),
])
def test_round_out(spark, value, digits, want):
    got = one(spark, value, round_out("x", digits), "double")
    assert got == want or (want is not None and abs(got - want) < 1e-9)


def test_ratio_of_zero_is_null(spark):
    assert one(spark, 0.0, ratio(F.lit(1.0), "x"), "double") is None


@pytest.mark.parametrize("text,want", [("12", 12), ("12.0", 12), ("n/a", 0), (None, 0), ("", 0), (" 7 ", 7)])
def test_click_count(spark, text, want):
    assert one(spark, text, click_count("x")) == want


@pytest.mark.parametrize("text,want", [
    ("山东 > 潍坊 > 寿光", "山东"), ("山东>潍坊", "山东"), ("　山东　", "山东"), ("", ""), (None, None),
])
def test_region_head(spark, text, want):
    assert one(spark, text, region_head("x")) == want


@pytest.mark.parametrize("text,want", [
    ('a"b\'c', "abc"), ("a\r\n\tb", "a b"), ("a\\nb", "a b"), ("  x ,y ", "x ，y"), ("a\x00\x85b", "ab"),
    ("a 　b", "a b"), ("12.5", "12.5"), ("a\n", "a"), (None, None),
])
def test_normalize_text(spark, text, want):
    assert one(spark, text, normalize_text("x")) == want


def test_keyword_is_a_pattern_and_null_is_no_match(spark):
    df = spark.createDataFrame([("red ring", None), (None, "blue"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(contains_any("re.|bl", "a", "b")).collect()] == [True, True, False]


def test_dictionaries():
    assert dims.NAME_TO_CODE["西瓜"] == "xigua" and dims.CODE_TO_NAME["gua"] == "西瓜"
    assert dims.province_forms("山东省") == ["山东省", "山东"] and dims.province_forms("山东") == ["山东"]
    assert set(dims.variety_forms("gua")) == {"gua", "西瓜", "xigua"}
    assert len(dims.SHORT_TO_FULL) == 34 and len(dims.CODE_TO_PROVINCE) == 32


def test_province_names(spark):
    df = spark.createDataFrame([("山东省",), ("xicang",), ("未知",), ("zhongguo",), ("",), (" 北京 ",), (None,)], "p string")
    short = cleaning.normalize_province_short(df, F.col("p"), "s")
    assert {r.p: r.s for r in short.collect()} == {
        "山东省": "山东", "xicang": "西藏", "未知": None, "zhongguo": None, "": None, " 北京 ": "北京", None: None,
    }
    full = cleaning.normalize_province_full(df, F.col("p"), "f")
    assert {r.p: r.f for r in full.collect()}["xicang"] == "西藏自治区"


def test_clean_prices_edges(spark):
    raw = spark.createDataFrame(
        [
            ("白菜", "m", "1", "3", "￥2.00元", "2024/1/5", "shandong", "t1", "baicai"),
            ("白菜", "m", "1", "3", " 2 ", "2024-01-05 00:00:00", "shandong", "t2", "baicai"),
            ("白菜", "m", "x", "", "2", "2024-01-06", "nowhere", "t", "baicai"),
            ("白菜", "m", "1", "3", "abc", "2024-01-05", "shandong", "t", "baicai"),
            ("白菜", "m", "1", "3", "2", "未知", "shandong", "t", "baicai"),
        ],
        "variety string, market string, min_price string, max_price string, avg_price string, date string, "
        "province string, crawl_ts string, variety_code string",
    )
    got = {(r.province, r.min_price, r.max_price, r.price_date.day) for r in cleaning.clean_prices(raw).collect()}
    # The two copies differ only in notation and crawl time.
    assert got == {("山东", 1.0, 3.0, 5), ("nowhere", None, None, 6)}


def test_exclude_regions_drops_null(spark):
    df = spark.createDataFrame([("山东",), ("台湾",), ("zhongguo",), (None,)], "province string")
    assert [r.province for r in cleaning.exclude_regions(df).collect()] == ["山东"]


def test_short_ways_of_dates_and_numbers_give_what_the_patterns_give(spark):
    from pyspark.sql import functions as F

    from marketlens.functions import dates, numbers

    days = ["2024-01-05", "2024/1/5", "2024/1-5", "2024-13-01", "2024-02-30", "2024-1-5\n", "2024-01-05\u2028", " 2024-01-05", "2024-01", "0001-01-01", "2024-01-05 25:00:00", None, ""]
    slow_date = F.regexp_extract(F.regexp_replace("t", dates._DATE_SHAPE, "$1-$3$5$7-$4$6$8"), "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", 0).try_cast("date")
    rows = spark.createDataFrame([(d,) for d in days], "t string").select("t", dates.parse_date("t").alias("a"), slow_date.alias("b")).collect()
    assert all(r.a == r.b for r in rows) and sum(r.a is not None for r in rows) >= 4
    texts = ["12", "12.", ".5", ".", "1.2.3", "1e3", "12d", "1,000", "￥7元", " 7", "7\n", "", None, "99999999999999999999", "-0", "٣"]
    rows = spark.createDataFrame([(x,) for x in texts], "t string").select(
        "t", numbers.price_number("t").alias("a"), numbers.to_number(numbers.strip_currency("t")).alias("b"),
        numbers.click_count("t").alias("c"), F.coalesce(numbers.to_number(F.trim("t")).try_cast("bigint"), F.lit(0)).alias("d")).collect()
    assert all(r.a == r.b and r.c == r.d for r in rows)
