"""Market-shaped views over the star-schema tables.

``prices``, ``seeds`` and ``suppliers`` have the clean schema; the ``raw_*``
views carry the same facts as dirty text, as they would be landed. All are
plain joins, left to the planner: small dimensions are broadcast by their file
size, large ones are sort-merge joined with skew splitting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dims import CODE_TO_PROVINCE, NAME_TO_CODE

VIEW_EXCLUDED = ("NATION_22", "NATION_23", "NATION_24")

# Codes standing in for nation 0..24 and names for brand 1..25 in the raw views.
RAW_PROVINCE_CODES = list(CODE_TO_PROVINCE)[:22] + ["台湾", "香港", "zhongguo"]
RAW_VARIETIES = list(NAME_TO_CODE.items())[:25]
#: Order lines behind the offers of one task: what is made of them is wide and is made distinct in memory.
OFFER_LINES = 500_000
_QUOTE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a scan that has fewer partitions than cores one partition per core.

    The text views below cost far more per row than the scan. A table of
    cluster size has many splits already and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _kept(nation: DataFrame) -> DataFrame:
    return nation.where(~F.col("n_name").isin(*VIEW_EXCLUDED))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return (
        t("lineitem")
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(_kept(t("nation")), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("p_brand").alias("variety"),
            F.col("n_name").alias("province"),
            F.col("s_name").alias("market"),
            unit.alias("avg_price"),
            (unit * (1 - F.col("l_discount"))).alias("min_price"),
            (unit * (1 + F.col("l_tax"))).alias("max_price"),
            F.col("l_shipdate").cast("date").alias("price_date"),
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        )
    )


def _offers(lineitem: DataFrame, day: str) -> DataFrame:
    """The offered (part, supplier) pairs with their first day, in partitions counted from the lines.

    A coalesced shuffle packs them by their own few bytes, into tasks that then
    hold far wider rows. Dealt by part, as the join with the parts has them; no
    further shuffle where that join is a merge join.
    """
    parts = max(lineitem.sparkSession.sparkContext.defaultParallelism, -(-lineitem.count() // OFFER_LINES))
    offers = lineitem.groupBy("l_partkey", "l_suppkey").agg(F.min("l_shipdate").cast("date").alias(day))
    return offers.repartition(parts, "l_partkey")


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    return (
        _offers(t("lineitem"), "publish_date")
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(_kept(t("nation")), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("p_name").alias("product_name"),
            F.concat_ws(" > ", "n_name", "r_name", "s_name").alias("supply_region"),
            F.col("s_name").alias("company_name"),
            F.col("p_size").alias("click_count"),
            "publish_date",
            F.concat(
                F.lit("http://"), F.lower("p_type"), F.lit(".example.com/sell/"),
                F.col("l_partkey").cast("string"), F.lit(".html"),
            ).alias("product_url"),
            F.col("p_brand").alias("variety"),
            F.col("n_name").alias("province"),
            "l_partkey", "l_suppkey",
        )
    )


def _supplier_rows(spark: SparkSession, sf_dir: str, nation: DataFrame) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    return (
        spread(t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity"))
        .join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _supplier_rows(spark, sf_dir, _kept(table(spark, sf_dir, "nation"))).select(
        F.col("p_name").alias("product_name"),
        F.concat_ws(" > ", "n_name", "r_name", "c_name").alias("origin"),
        F.col("c_name").alias("contact_person"),
        F.col("c_mktsegment").alias("company_type"),
        F.col("l_quantity").cast("int").alias("click_count"),
        F.col("o_orderdate").cast("date").alias("publish_date"),
        F.col("p_type").alias("sub_type"),
        F.col("p_brand").alias("variety"),
        F.col("n_name").alias("province"),
        "l_orderkey", "l_partkey", "l_suppkey",
    )


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _brand_no() -> Column:
    return F.substring_index("p_brand", "#", -1).cast("int")


def _money(cents: Column) -> Column:
    """Whole cents as text with two decimals."""
    return F.concat(
        F.floor(cents / 100).cast("string"),
        F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )


def _grouped_money(cents: Column) -> Column:
    """The same with a comma before the thousands."""
    units = F.floor(cents / 100)
    return F.when(
        units >= 1000,
        F.concat(
            F.floor(units / 1000).cast("string"), F.lit(","),
            F.lpad((units % 1000).cast("string"), 3, "0"), F.lit("."),
            F.lpad((cents % 100).cast("string"), 2, "0"),
        ),
    ).otherwise(_money(cents))


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes as landed text, all regions, with dirty tokens and copies."""
    t = lambda name: table(spark, sf_dir, name)
    line, day = F.col("l_linenumber"), F.col("l_shipdate").cast("date")
    cents = F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100)
    quoted = (
        F.when(line == 7, F.lit("abc"))
        .when(line % 3 == 0, F.concat(F.lit("￥"), _money(F.col("cents")), F.lit("元")))
        .when(line % 3 == 1, _grouped_money(F.col("cents")))
        .otherwise(F.concat(F.lit(" "), _money(F.col("cents")), F.lit(" ")))
    )
    dated = (
        F.when(line == 6, F.lit("未知"))
        .when(line % 4 == 0, F.date_format(day, "yyyy/M/d"))
        .when(line % 4 == 1, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(line % 4 == 2, F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.date_format(day, "yyyy/MM/dd"))
    )
    rows = (
        spread(t("lineitem").select(*_QUOTE_COLUMNS))
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumn("cents", cents)
        .select(
            "l_linenumber",
            _pick([n for n, _ in RAW_VARIETIES], _brand_no()).alias("variety"),
            F.col("s_name").alias("market"),
            _money(F.floor(F.col("cents") * 9 / 10)).alias("min_price"),
            _money(F.floor(F.col("cents") * 11 / 10)).alias("max_price"),
            quoted.alias("avg_price"),
            dated.alias("date"),
            _pick(RAW_PROVINCE_CODES, F.col("s_nationkey") + 1).alias("province"),
            F.lit("2024-01-01 00:00:00").alias("crawl_ts"),
            _pick([c for _, c in RAW_VARIETIES], _brand_no()).alias("variety_code"),
        )
    )
    copies = F.when(line == 2, F.array_repeat(F.lit(1), 2)).otherwise(F.array_repeat(F.lit(1), 1))
    return rows.withColumn("_copy", F.explode(copies)).drop("_copy", "l_linenumber")


def raw_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    short = _pick([CODE_TO_PROVINCE.get(c, c) for c in RAW_PROVINCE_CODES], F.col("s_nationkey") + 1)
    gap = F.when(F.col("l_partkey") % 2 == 0, F.lit(" > ")).otherwise(F.lit(">"))
    return (
        _offers(t("lineitem"), "day")
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("p_name").alias("product_name"),
            F.concat(F.lit(" "), short, gap, F.col("s_name")).alias("supply_region"),
            F.col("s_name").alias("company_name"),
            F.when(F.col("p_size") % 5 == 0, F.lit("n/a"))
            .when(F.col("p_size") % 5 == 1, F.concat(F.col("p_size").cast("string"), F.lit(".0")))
            .otherwise(F.col("p_size").cast("string")).alias("click_count"),
            F.date_format("day", "yyyy/M/d").alias("date"),
            F.concat(F.lit("/sell/"), F.col("l_partkey").cast("string"), F.lit(".html")).alias("product_url"),
            F.concat(F.lit("http://example.com/c/"), F.col("l_suppkey").cast("string")).alias("company_url"),
            _pick([n for n, _ in RAW_VARIETIES], _brand_no()).alias("category"),
        )
    )


def raw_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    short = _pick([CODE_TO_PROVINCE.get(c, c) for c in RAW_PROVINCE_CODES], F.col("c_nationkey") + 1)
    return _supplier_rows(spark, sf_dir, nation).select(
        F.col("p_name").alias("product_name"),
        F.concat(short, F.lit(" > "), F.col("c_name")).alias("origin"),
        F.col("c_name").alias("contact_person"),
        F.col("c_mktsegment").alias("company_type"),
        F.when(F.col("l_quantity").cast("int") % 7 == 0, F.lit(""))
        .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("click_count"),
        F.when(F.col("l_partkey") % 10 == 0, F.lit("未知"))
        .otherwise(F.date_format(F.col("o_orderdate").cast("date"), "yyyy/M/d")).alias("date"),
        F.concat(F.lit("/sell/"), F.col("l_partkey").cast("string"), F.lit(".html")).alias("product_url"),
        _pick([n for n, _ in RAW_VARIETIES], _brand_no()).alias("category"),
        F.col("p_type").alias("sub_type"),
    )


def quote_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes as stored web pages: one page per quote with a price table of four days, or of one day.

    Every third line number has the short table (recognised by its headings
    only), line 7 is a page that says it found nothing.
    """
    t = lambda name: table(spark, sf_dir, name)
    line, day = F.col("l_linenumber"), F.col("l_shipdate").cast("date")
    # What the rows of a page share is put together once.
    lead = F.concat(
        F.lit("<TR><td><b>"), F.col("p_brand"), F.lit('</b>\n</td><td><span><a href="/m" title="'), F.col("s_name"), F.lit('">'),
        F.substring("s_name", 1, 5), F.lit("..</a></span></td><td>￥"), _money(F.floor(F.col("cents") * 9 / 10)),
        F.lit("</td><td>￥"), _money(F.floor(F.col("cents") * 11 / 10)), F.lit("</td><td>￥"),
    )

    def row(offset: int) -> list[Column]:
        stamp = F.date_format(F.date_add(day, offset), "yyyy-MM-dd") if offset < 3 else F.lit("&nbsp;")
        return [F.col("lead"), _money(F.col("cents") + offset), F.lit("</td><td>"), stamp, F.lit("</td></TR>\n")]

    head = F.lit("<tr>" + "".join(f"<td>{h}</td>" for h in ("品种", "批发市场", "最低价格", "最高价格", "平均价格", "发布时间")) + "</tr>")
    rows = F.when(line % 3 == 0, F.concat(*row(0))).otherwise(F.concat(*[c for i in range(4) for c in row(i)]))
    note = F.when(line == 7, F.lit("共找到0条")).otherwise(F.lit(""))
    return (
        spread(t("lineitem").select(*_QUOTE_COLUMNS))
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumn("cents", F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100))
        .withColumn("lead", lead)
        .select(
            F.col("l_orderkey").alias("page_id"),
            F.concat(F.lit("http://quotes.example.com/p"), line.cast("string"), F.lit(".html")).alias("url"),
            F.concat(
                F.lit('<html><body><table class="nav"><tr><td>menu</td></tr></table>'), note,
                F.lit('<table border="1">'), head, rows, F.lit("</table></body></html>"),
            ).alias("html"),
        )
    )


def nested_quote_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes as pages of a whole order: the price table stands in a cell of a layout table, and market cells hold a table of their own."""
    t = lambda name: table(spark, sf_dir, name)
    cell = lambda *parts: F.concat(F.lit("<td>"), *parts, F.lit("</td>"))
    money = lambda c: F.concat(F.lit("&yen;"), _money(c))
    row = F.concat(
        F.lit("<tr>"), cell(F.col("p_brand")), cell(F.lit("<table class=x><tr><td>"), F.col("s_name"), F.lit("</table>")),
        cell(money(F.floor(F.col("cents") * 9 / 10))), cell(money(F.floor(F.col("cents") * 11 / 10))), cell(money(F.col("cents"))),
        cell(F.date_format(F.col("l_shipdate").cast("date"), "yyyy-MM-dd")),
    )
    head = "<tr>" + "".join(f"<td>{h}" for h in ("品种", "批发市场", "最低价格", "最高价格", "平均价格", "发布时间")) + "</tr>"
    quotes = (
        spread(t("lineitem").select(*_QUOTE_COLUMNS))
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumn("cents", F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100))
    )
    return quotes.groupBy(F.col("l_orderkey").alias("page_id")).agg(F.array_join(F.collect_list(row), "\n").alias("body")).select(
        "page_id", F.lit("http://quotes.example.com/o").alias("url"),
        F.concat(F.lit("<body><table><tr><td><ul><li>menu</ul><td>"), F.lit("<TABLE border=0>" + head), F.col("body"), F.lit("</TABLE><td>side</td></tr></table>")).alias("html"))


def seed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed offers as stored listing pages, one offer each."""
    link = lambda href, text: F.concat(F.lit('<a href="'), href, F.lit('">'), text, F.lit("</a>"))
    raw = raw_seeds(spark, sf_dir)
    html = F.concat(
        F.lit("<table><tr><td><img src='x.jpg'></td><td><p>"), link(F.col("product_url"), F.col("product_name")),
        F.lit("</p><p>供应地区："), F.col("supply_region"),
        F.lit("</p><p>企业："), link(F.col("company_url"), F.col("company_name")),
        F.lit("</p></td><td>评论数：<strong>0</strong> 点击量：<strong>"), F.col("click_count"),
        F.lit("</strong><br>"), F.col("date"), F.lit("</td></tr></table>"),
    )
    return raw.select(
        F.xxhash64("product_url", "company_url").alias("page_id"),
        F.lit("http://seeds.example.com/zhongzi/").alias("url"), html.alias("html"),
    )


def supplier_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier offers as stored listing pages, one offer each; companies and persons by segment."""
    raw = raw_suppliers(spark, sf_dir)
    label = F.when(F.col("company_type").isin("BUILDING", "MACHINERY"), F.lit("企业")).otherwise(F.lit("个人"))
    clicks = F.when(F.col("company_type") == "BUILDING", F.concat(F.lit("<strong>"), F.col("click_count"), F.lit("</strong>"))).otherwise(
        F.concat(F.lit("点击量: "), F.col("click_count"))
    )
    html = F.concat(
        F.lit('<table class="m_t_5 list"><tr><td>img</td><td><a href="'), F.col("product_url"), F.lit('">'),
        F.col("product_name"), F.lit("</a><p>产地："), F.col("origin"), F.lit("</p><p>"), label, F.lit('：<a title="'),
        F.col("contact_person"), F.lit('">x</a></p></td><td>'), F.col("date"), F.lit(" <br>"), clicks,
        F.lit('</td></tr></table><table class="other"><tr><td>1</td><td><a href="/sell/0.html">no</a></td></tr></table>'),
    )
    return raw.select(
        F.xxhash64("product_url", "contact_person").alias("page_id"),
        F.lit("http://offers.example.com/shucai/").alias("url"),
        html.alias("html"),
    )


def pager_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that state their page count in each of the known ways, or not at all."""
    n, line = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber")
    text = (
        F.when(line == 1, F.concat(F.lit("共 "), n, F.lit(" 页")))
        .when(line == 2, F.concat(F.lit("<b>1</b>"), n, F.lit("</b> 页")))
        .when(line == 3, F.concat(F.lit("1&nbsp;/<b>"), n, F.lit("</b>页")))
        .when(line == 4, F.concat(F.lit("var pageCount = "), n, F.lit(";")))
        .when(line == 5, F.concat(
            F.lit('<div align="center" id="pager"><a href="/x/p1.html">1</a>\n<a href="/x/p'), n,
            F.lit('.html">last</a></div><a href="/y/p9999.html">other</a>'),
        ))
        .when(line == 6, F.concat(F.lit('<a class="n" href="/z/p'), n, F.lit('.html">next</a>')))
        .otherwise(F.lit("no pager"))
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("page_id"), F.lit("http://quotes.example.com/").alias("url"),
        F.concat(F.lit("<html>"), text, F.lit("</html>")).alias("html"),
    )
