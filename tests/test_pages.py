import pytest

from marketlens.operators import pages as pg


@pytest.fixture
def stored(spark):
    def make(*htmls, url="http://q.example.com/list/"):
        return spark.createDataFrame([(i, url, h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    return make


def row(*cells):
    return "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"


HEAD = row("品种", "批发市场", "最低价格", "最高价格", "平均价格", "发布时间")


def test_price_table_by_shape(stored):
    html = (
        "<table><tr><td>a</td><td>b</td></tr></table><table>" + HEAD
        + row("白菜", "<a href='/x' title=' 寿光 市场 '>寿光..</a>", "￥1", "￥3", "￥2", "2024-01-05")
        + row("菠菜, 大", "plain&nbsp;market", "1", "3", "2", "")
        + row("菠菜菠菜", "m", "1", "3", "2", "2024-01-05") + row("", "m", "1", "3", "2", "2024-01-05")
        + row("x" * 101, "m", "1", "3", "2", "2024-01-05") + row("a", "b") + "</table>"
    )
    got = pg.html_table_rows(stored(html), "2024-02-02").orderBy("row_no").collect()
    assert [(r.variety, r.market, r.avg_price, r.date) for r in got] == [
        ("白菜", "寿光 市场", "￥2", "2024-01-05"), ("菠菜， 大", "plain market", "2", "2024-02-02"),
    ]


def test_price_table_by_headings_and_unclosed_cells(stored):
    html = "<TABLE>" + HEAD + "<TR><TD>葱<TD>m<TD>1<TD>2<TD>1.5<TD>2024-01-01</TABLE>"
    got = pg.html_table_rows(stored(html), "d").collect()
    assert [(r.variety, r.max_price, r.date) for r in got] == [("葱", "2", "2024-01-01")]


def test_rejected_rows_have_a_reason(stored):
    html = "<table>" + HEAD + "".join(row(n, "m", "1", "3", "2", "2024-01-05") for n in ("葱", "菠菜菠菜", "x" * 101, "姜", "蒜")) + "</table>"
    got = {r.raw_name[:4]: r.reason for r in pg.html_table_rejects(stored(html)).collect()}
    assert got == {"菠菜菠菜": "repeated mark", "xxxx": "long name"}
    assert pg.html_table_rows(stored(html), "d", longest_name=200, repeated_marks=()).count() == 5


@pytest.mark.parametrize("text,want", [
    ("&#30333;&#x83DC; &amp;#65; &lt;b&gt; A&amp;B", "白菜 &#65; <b> A&B"), ("&#0;&#xD800;&#99999999;", "\ufffd\ufffd&#99999999;"), ("none", "none"), ("&copy;&unknown;", "©&unknown;"),
])
def test_character_references(spark, text, want):
    from pyspark.sql import functions as F

    assert spark.createDataFrame([(text,)], "t string").select(pg.decode_entities(F.col("t")).alias("t")).first().t == want


def test_links_are_decoded_and_fetchable(stored, spark):
    html = """<!-- <a href="/no.html">x</a> --><script>'<a href="/js.html">'</script><a data-href="/d" href=/q.html>q</a>
    <a href="/p?x=1&amp;y=2#top">p</a><a href="mailto:a@b.c">m</a><a href="#top">t</a><a href='HTTP://o.com/'>o</a>"""
    df = stored(html)
    assert [r.href for r in pg.link_extract(df).orderBy("position").collect()] == ["/q.html", "/p?x=1&y=2#top", "mailto:a@b.c", "#top", "HTTP://o.com/"]
    held = df.union(spark.createDataFrame([(9, "http://q.example.com/p?x=1&y=2", "")], df.schema))
    assert "http://q.example.com/p?x=1&y=2" not in {r.target for r in pg.link_frontier(held).collect()}
    assert {r.target for r in pg.link_frontier(df).collect()} >= {"http://q.example.com/q.html", "http://q.example.com/p?x=1&y=2"}
    assert len(pg.link_frontier(df).collect()) == 3


def test_page_addresses(spark):
    counts = spark.createDataFrame([(1, "http://a.com/list/", 3), (2, "http://b.com", 0)], "page_id long, url string, page_count int")
    assert [r.target for r in pg.page_addresses(counts, "/p{n}.html").orderBy("page_no").collect()] == [f"http://a.com/p{i}.html" for i in (1, 2, 3)]


@pytest.mark.parametrize("html", ["", "<p>no table</p>", "共找到0条<table>" + HEAD + row(*"abcdef") + "</table>", "<table>" + row(*"abcdef") + "</table>"])
def test_pages_without_price_table(stored, html):
    assert pg.html_table_rows(stored(html), "d").count() == 0


def test_seed_listing(stored):
    html = "<table>" + row(
        "img", "<p><a href='sell/1.html'> 种子 </a></p><p>供应地区：山东 > 潍坊</p><p>企业：<a href='/c/9'>甲公司</a></p>",
        "评论数<strong>3</strong>点击量<strong>12</strong>2024/1/5 10:20",
    ) + row("img", "<p><a href='http://z/1'>b</a></p><p>供应地区：</p><p>企业：乙</p>", "点击量：7 2024/1/5") + "</table>"
    a, b = pg.html_listing_rows(stored(html)).orderBy("row_no").collect()
    assert (a.product_name, a.supply_region, a.company_name, a.click_count, a.date, a.company_url) == (
        "种子", "山东 > 潍坊", "甲公司", "12", "2024/1/5 10:20", "/c/9")
    assert a.product_url == "http://q.example.com/sell/1.html"
    assert (b.product_url, b.supply_region, b.click_count, b.company_url) == ("http://z/1", "", "7", "")


def test_supplier_listing(stored):
    good = "<table class='m_t_5'>" + row("i", "<a href='/sell/3.html'>葱</a><p>产地：河南 > 郑州</p><p>企业：<a title='丙'>丙..</a></p>", "<strong>4</strong><br>2024/2/3") + "</table>"
    no_offer = "<table class='m_t_5'>" + row("i", "<a href='/buy/3.html'>葱</a>", "") + "</table>"
    other = "<table class='m_t_55'>" + row("i", "<a href='/sell/3.html'>葱</a>", "") + "</table>"
    got = pg.html_supplier_rows(stored(good + no_offer + other)).collect()
    assert [(r.product_name, r.origin, r.contact_person, r.company_type, r.click_count, r.date, r.product_url) for r in got] == [
        ("葱", "河南 > 郑州", "丙", "企业", "4", "2024/2/3", "http://q.example.com/sell/3.html")]


@pytest.mark.parametrize("html,want", [
    ("共 12 页", 12), ("<b>1</b>8</b>页", 8), ("&nbsp;/<b>33</b> 页", 33), ("pageCount=4", 4), ("none", 5),
    ('<div align="center" id="pager"><a href="/p3.html"></a>\n<a href="/p21.html"></a></div><a href="/p99.html">', 21),
])
def test_page_counts(stored, html, want):
    assert pg.page_count_detect(stored(html)).first().page_count == want


def test_links_slugs_and_frontier(stored, spark):
    html = '<a class="x" href="/shucai/ye/">1</a><a href=\'/shucai/p/\'>2</a><a href="p2.html">3</a><a href="http://o.com/">4</a><a name="n">5</a>'
    df = stored(html, html)
    assert [r.href for r in pg.link_extract(df).where("page_id = 0").orderBy("position").collect()] == ["/shucai/ye/", "/shucai/p/", "p2.html", "http://o.com/"]
    assert [r.slug for r in pg.link_slugs(df).collect()] == ["ye"]
    held = df.union(spark.createDataFrame([(9, "http://o.com/", "")], df.schema))
    assert {r.target for r in pg.link_frontier(held).collect()} == {
        "http://q.example.com/shucai/ye/", "http://q.example.com/shucai/p/", "http://q.example.com/list/p2.html"}
    cover = {r.host: r for r in pg.crawl_coverage(held, held.where("page_id = 9")).collect()}
    assert (cover["http://q.example.com"].pages_held, cover["http://q.example.com"].links_seen, cover["http://q.example.com"].links_missing) == (2, 4, 3)
    assert cover["http://o.com"].rows_extracted == 1 and cover["http://o.com"].links_seen == 0


@pytest.mark.parametrize("rows", [lambda p: pg.html_table_rows(p, "d"), pg.html_listing_rows, pg.html_supplier_rows])
def test_what_makes_the_html_runs_once_a_page(spark, rows):
    from pyspark.sql import functions as F

    made = spark.range(3).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.reverse(F.concat(F.lit("<td>"), F.col("id").cast("string"))).alias("html"))
    assert rows(made)._jdf.queryExecution().optimizedPlan().toString().count("reverse(") == 1


def test_a_value_named_often_is_evaluated_once(spark):
    from pyspark.sql import functions as F

    from marketlens.functions.text import normalize_text

    for use in (normalize_text, pg.decode_entities, pg.text_of):
        assert use(F.reverse(F.col("html")))._jc.toString().count("reverse(") == 1


def test_tables_as_columns(spark, stored):
    from marketlens.functions.markup import tables_of, with_tables

    nested = "<table a=1><tr><td>x<table><tr><td>y<td>z</table>w<td></table><TABLE><td>q"
    got = {r.page_id: [t.asDict(True) for t in r.tables] for r in with_tables(stored(nested, None, "", "<table>", "no <td> none", "<td>", row("k")), but_with="none").collect()}
    assert got == {0: tables_of(nested), 5: [], 6: []} and len(got[0]) == 3


@pytest.mark.parametrize("rows", [lambda p: pg.html_table_rows(p, "d"), pg.html_listing_rows, pg.html_supplier_rows])
def test_cells_are_read_in_the_pass_over_the_page(stored, rows):
    """No array of all tables, rows and cells leaves the pass, to be walked by interpreted lambdas."""
    plan = rows(stored("<td>"))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "array<" not in plan and plan.count("MapInArrow") == 1


def test_plain_text_functions_give_what_the_column_functions_give(spark):
    from pyspark.sql import functions as F

    from marketlens.functions import celltext as ct
    from marketlens.functions.text import normalize_text, strip

    texts = [
        "", "Brand#1", " Brand#1\n", "a  b", "　x ", "x y", "\u0085z", "\x1cw\x1f", "1,200", "'q\" r", "a\\nb\\rc", " \\ ", " k ", " m",
        "<b>x</b> y", "a < b", "<p", "&nbsp;&amp;lt;", "&#30333;&#x83DC;&#0;&#xD800;", "&#38;#65;&#65;", "&#1114112;&unknown;", "\U0001d4b3é", "﻿.",
    ]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", pg.text_of(F.col("t")), pg.decode_entities(F.col("t")), normalize_text("t"), strip("t"), normalize_text(pg.text_of(F.col("t")))).collect()
    for t, *want in got:
        assert [ct.text_of(t), ct.decode_entities(t), ct.normalize_text(t), ct.strip(t), ct.normal_text_of(t)] == want, repr(t)


@pytest.mark.parametrize("html", [
    "<table a><tr><td>1</td><td>2</tr>x<TR b><TD>3<b>c</b></table><td>out<table><td>4", "<table><td <tr>5</td <tr>6<td>7", "</table><table></tr <td>8<td>9</td>10<td/>11</table>",
    "<table><td>12<td>", "<table x <td>13<td>14</table <td>", "<table><tdx><td>15<tr/><td\n>16</tdx></table>", "a < b<table><td>17</table>", "<table><tr><td <table><td>18",
])
def test_flat_and_nested_pages_are_read_alike(html):
    from marketlens.functions import markup

    read = lambda tables: [(t.opening, t.rows, t.wholes) for t in tables]
    flat = markup._flat(html)
    assert read(markup._tables(html)) == read(markup._nested(html)) and (flat is None or read(flat) == read(markup._nested(html)))
