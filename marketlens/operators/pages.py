"""Extraction from stored web pages ``pages(page_id, url, html)``.

Tables come from one pass over the tags of a page (``functions.markup``), so
nested tables, unclosed rows and unclosed cells come out right. The fields of their
rows are read from the cells in the same pass (``functions.celltext``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import celltext as ct
from ..functions.markup import with_fields
from ..functions.numbers import _col
from ..functions.once import with_value

# Words that identify headings and labels on the pages.
NO_RESULT = "共找到0条"
PRICE_HEADINGS = ("品种", "批发市场", "价格")
SKIPPED_FIRST_CELLS = ("品种", "发布时间", "日期", "时间", "")
REPEATED_MARKS = ("菠菜", "￥")
REGION_LABEL, COMPANY_LABEL, PERSON_LABEL, ORIGIN_LABEL = "供应地区：", "企业", "个人", "产地"
_CLICKS = re.compile(r"点击量[:：]\s*(\d+)", re.A)
_LISTING_DATE = re.compile(r"(\d{4}/\d{1,2}/\d{1,2}(?:\s+\d{1,2}:\d{1,2}(?::\d{1,2})?)?)", re.A)
_ORIGIN = re.compile(ORIGIN_LABEL + r"[:：]\s*([^<\n]+)", re.A)
PAGE_COUNTS = (r"共\s*(\d+)\s*页", r"</b>(\d+)</b>\s*页", r"&nbsp;/<b>(\d+)</b>\s*页", r"pageCount\s*=\s*(\d+)")
PAGER_BLOCK = r'(?s)<div align="center" id="pager".*?</div>'
PAGER_LINK = r"/p(\d+)\.html"
SUB_CATEGORY = "/shucai/([^/]+)/"
NOT_SUB_CATEGORIES = ("p", "buy")
LISTING_TABLE_CLASS = "m_t_5"
_LISTING_CLASS = re.compile(rf"(?:^|\s){LISTING_TABLE_CLASS}(?:\s|[\u0085\u2028\u2029]?\Z)", re.A)
LONGEST_RAW_NAME, LONGEST_NAME = 200, 100

_UNREAD = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)"
_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:"


def _numbered(text: Column, pattern: str, base: int) -> Column:
    """Text with its numeric character references of one base decoded."""
    digits = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))

    def put(done: Column, reference: Column) -> Column:
        number = F.conv(F.regexp_extract(reference, "([0-9a-fA-F]+);", 1), base, 10).cast("bigint")
        valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, number).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        return F.replace(done, reference, char)

    return F.aggregate(digits, text, put)


def decode_entities(text: Column) -> Column:
    """Character references of all numbers and the common names, each decoded once."""
    def decode(text: Column) -> Column:
        numbered = _numbered(_numbered(text, "&#[0-9]{1,7};", 10), "&#[xX][0-9a-fA-F]{1,6};", 16)
        decoded = F.when(text.contains("&#"), numbered).otherwise(text)
        for entity, char in ct.ENTITIES.items():
            decoded = F.replace(decoded, F.lit(entity), F.lit(char))
        # Most texts hold no entity: one scan decides.
        return F.when(text.contains("&"), decoded).otherwise(text)

    return with_value(text, decode)


def text_of(markup: Column) -> Column:
    """Text without tags, character references decoded."""
    plain = lambda m: F.when(m.contains("<"), F.regexp_replace(m, r"(?s)<[^>]*>", "")).otherwise(m)
    return decode_entities(with_value(markup, plain))


def _unquoted(value: Column) -> Column:
    """A captured attribute value without its quotes, decoded."""
    return decode_entities(F.regexp_replace(value, r"""^["']|["']$""", ""))


def _is_price_table(rows: list[list[str]]) -> bool:
    """By shape; the first five rows of a table are only looked at to recognise it."""
    return len(rows) >= 5 and len(rows[0]) == 6 and sum(len(r) == 6 for r in rows[:5]) >= 3


def _has_price_headings(rows: list[list[str]]) -> bool:
    if len(rows) < 2 or len(rows[0]) < 3:
        return False
    heading = " ".join(map(ct.text_of, rows[0]))
    return all(word in heading for word in PRICE_HEADINGS)


def _title(links: list[str]) -> str | None:
    """The first title of the links that is not empty."""
    return next((t for a in links if (t := ct.strip(ct.attribute(ct.open_tag(a), "title")))), None)


def _price_fields(tables: list) -> list[tuple]:
    """Row number, name as it stands, and the normalised name, market, prices and day of the rows of the price table."""
    table = next((t for t in tables if _is_price_table(t.rows)), None) or next((t for t in tables if _has_price_headings(t.rows)), None)
    found = []
    for row_no, cells in enumerate(table.rows if table else ()):
        if len(cells) < 6:
            continue
        name, market, *plain = [whole or own for own, whole in zip(cells[:6], table.wholes[row_no], strict=False)]
        raw_name = ct.text_of(name)
        first = ct.strip(raw_name)
        if first in SKIPPED_FIRST_CELLS or "价格" in first:
            continue
        title = _title(ct.blocks(market, "a"))
        found.append((
            row_no, raw_name, ct.normalize_text(raw_name), ct.normalize_text(ct.strip(ct.text_of(market)) if title is None else title),
            *map(ct.normal_text_of, plain)))
    return found


def _table_fields(pages: DataFrame, longest_raw_name: int, longest_name: int, repeated_marks) -> DataFrame:
    """Fields of the rows of the price table but its headings, with the ``reason`` for which a row is no quote."""
    named = with_fields(pages, ["raw_name", "variety", "market", "min_price", "max_price", "avg_price", "day"], _price_fields, but_with=NO_RESULT)
    name = F.col("raw_name")
    repeated = F.lit(False)
    for mark in repeated_marks:
        repeated = repeated | (F.size(F.split(name, mark)) > 2)
    return named.withColumn(
        "reason",
        F.when((F.length(name) > longest_raw_name) | (F.length("variety") > longest_name), "long name")
        .when(repeated, "repeated mark").when(F.col("variety") == "", "no name"),
    )


def html_table_rows(pages: DataFrame, load_date: str, longest_raw_name: int = LONGEST_RAW_NAME, longest_name: int = LONGEST_NAME,
                    repeated_marks=REPEATED_MARKS) -> DataFrame:
    """Quote rows of the price table of every page.

    The price table is the first whose opening rows have six cells, else the
    first with the expected headings. Headings are skipped; a missing date
    becomes ``load_date``. Rows whose name is overlong or run together are in
    ``html_table_rejects``.
    """
    day = F.col("day")
    return _table_fields(pages, longest_raw_name, longest_name, repeated_marks).where("reason is null").select(
        "page_id", "url", "row_no", "variety", "market", "min_price", "max_price", "avg_price",
        F.when(day != "", day).otherwise(F.lit(load_date)).alias("date"),
    )


def html_table_rejects(pages: DataFrame, longest_raw_name: int = LONGEST_RAW_NAME, longest_name: int = LONGEST_NAME,
                       repeated_marks=REPEATED_MARKS) -> DataFrame:
    """The rows that ``html_table_rows`` does not take, with the reason."""
    return _table_fields(pages, longest_raw_name, longest_name, repeated_marks).where("reason is not null").select(
        "page_id", "url", "row_no", "raw_name", "market", "min_price", "max_price", "avg_price", "day", "reason")


def _clicks(cell: str, last: bool) -> str:
    strong = ct.blocks(cell, "strong")
    return ct.strip(ct.text_of(ct.inner(strong[-1 if last else 0]))) if strong else ct.extract(_CLICKS, ct.text_of(cell))


def _listing_fields(tables: list) -> list[tuple]:
    found = []
    for row_no, cells in enumerate(row for t in tables for row in t.rows):
        if len(cells) < 3 or len(p := [ct.inner(x) for x in ct.blocks(cells[1], "p")]) < 3:
            continue
        link = lambda i: next(iter(ct.blocks(p[i], "a")), "")  # noqa: E731, B023
        part = lambda i, label: ct.strip(ct.strip(ct.text_of(p[i])).replace(label, ""))  # noqa: E731, B023
        href = lambda a: ct.attribute(ct.open_tag(a), "href")
        product = link(0)
        if name := ct.strip(ct.text_of(ct.inner(product))):
            found.append((
                row_no, name, href(product), part(1, REGION_LABEL), part(2, COMPANY_LABEL + "："), href(link(2)),
                _clicks(cells[2], last=True), ct.extract(_LISTING_DATE, ct.text_of(cells[2]))))
    return found


def html_listing_rows(pages: DataFrame) -> DataFrame:
    """Seed listings: every table row with three cells whose second holds three paragraphs."""
    fields = with_fields(
        pages, ["product_name", "href", "supply_region", "company_name", "company_url", "click_count", "date"], _listing_fields)
    target = F.when(F.col("href") == "", "").otherwise(url_resolve("url", "href", at_root=True))
    return fields.select(
        "page_id", "url", "row_no", "product_name", "supply_region", "company_name", "click_count", "date",
        target.alias("product_url"), "company_url",
    )


def _supplier_fields(tables: list) -> list[tuple]:
    found = []
    for row_no, table in enumerate(t for t in tables if _LISTING_CLASS.search(ct.attribute(t.opening, "class"))):
        cells = table.rows[0] if table.rows else ()
        if len(cells) < 2:
            continue
        links = ((a, ct.attribute(ct.open_tag(a), "href")) for a in ct.blocks(cells[1], "a"))
        a, href = next(((a, href) for a, href in links if href), ("", ""))
        name = ct.strip(ct.text_of(ct.inner(a)))
        if "/sell/" not in href or not name:
            continue
        third = cells[2] if len(cells) > 2 else ""
        p = [ct.inner(x) for x in ct.blocks(cells[1], "p")]
        texts = [ct.text_of(x) for x in p]
        origins = (ct.strip(ct.extract(_ORIGIN, ct.strip(text))) for text in texts)
        labelled = lambda label: next(
            (t for x, text in zip(p, texts, strict=True) if label in text and (t := _title(ct.blocks(x, "a")))), None)  # noqa: B023
        person, company = labelled(PERSON_LABEL), labelled(COMPANY_LABEL)
        found.append((
            row_no, name, href, next((o for o in origins if o), ""), person or company or "",
            PERSON_LABEL if person else COMPANY_LABEL if company else "",
            _clicks(third, last=False), ct.extract(_LISTING_DATE, ct.text_of(third))))
    return found


def html_supplier_rows(pages: DataFrame) -> DataFrame:
    """Supplier listings: first row of every listing table whose product link is an offer."""
    fields = with_fields(
        pages, ["product_name", "href", "origin", "contact_person", "company_type", "click_count", "date"], _supplier_fields)
    return fields.select(
        "page_id", "url", "row_no", "product_name", "origin", "contact_person", "company_type",
        "click_count", "date", url_resolve("url", "href", at_root=True).alias("product_url"),
    )


def link_extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, position, href) of every link with a target, outside comments and scripts; targets are decoded."""
    read = F.regexp_replace("html", _UNREAD, " ")
    hrefs = F.regexp_extract_all(read, F.lit(rf"(?i)<a(?=\s)[^>]*?\shref\s*=\s*{ct.VALUE}"), F.lit(1))
    return pages.select("page_id", "url", F.posexplode(F.transform(hrefs, _unquoted)).alias("position", "href"))


def link_slugs(pages: DataFrame, pattern: str = SUB_CATEGORY, dropped=NOT_SUB_CATEGORIES) -> DataFrame:
    """Distinct path parts captured from the links, in order; by default the sub-categories."""
    slug = F.regexp_extract("href", pattern, 1)
    return (
        link_extract(pages).select(slug.alias("slug"))
        .where((F.col("slug") != "") & ~F.col("slug").isin(*dropped))
        .distinct().orderBy("slug")
    )


def page_count_detect(pages: DataFrame, default: int = 5) -> DataFrame:
    """Pages of a paged listing: the first matching text, else the highest pager link, else the default."""
    stated = [
        F.nullif(F.regexp_extract("html", pattern, 1), F.lit("")).try_cast("int") for pattern in PAGE_COUNTS
    ]
    pager = F.regexp_extract("html", PAGER_BLOCK, 0)
    linked = F.array_max(
        F.transform(F.regexp_extract_all(pager, F.lit(PAGER_LINK), F.lit(1)), lambda n: n.try_cast("int"))
    )
    return pages.select("page_id", "url", F.coalesce(*stated, linked, F.lit(default)).alias("page_count"))


def listing_page_count(pages: DataFrame, default: int = 1) -> DataFrame:
    """The highest page number linked from a listing page, else the default."""
    numbers = F.transform(
        F.regexp_extract_all("html", F.lit(r"(?i)<a\s[^>]*?href\s*=\s*[\"'][^\"']*/p(\d+)\.html"), F.lit(1)),
        lambda n: n.try_cast("int"),
    )
    return pages.select("page_id", "url", F.greatest(F.array_max(numbers), F.lit(default)).alias("page_count"))


def url_host(url: Column | str) -> Column:
    """Scheme and host of an absolute URL."""
    return F.regexp_extract(_col(url), r"^https?://[^/?#]+", 0)


def url_resolve(base: Column | str, href: Column | str, at_root: bool = False) -> Column:
    """Links with a scheme stay; '//host/x' takes the scheme of the base, '/x' its host; others go below the base, or below the host root."""
    base, href = _col(base), _col(href)
    below = F.concat(url_host(base), F.lit("/"), href) if at_root else F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), href)
    return (
        F.when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^https?:", 0), href))
        .when(href.startswith("/"), F.concat(url_host(base), href))
        .otherwise(below)
    )


def link_targets(pages: DataFrame) -> DataFrame:
    """(host of the page, resolved link) of the links that can be fetched: fragments and other schemes are left out."""
    fetched = ~F.col("href").startswith("#") & (F.col("href").rlike("^(?i)https?:") | ~F.col("href").rlike(_SCHEME))
    return link_extract(pages).where(fetched).select(
        url_host("url").alias("host"), F.regexp_replace(url_resolve("url", "href"), "#.*$", "").alias("target")
    )


def link_frontier(pages: DataFrame) -> DataFrame:
    """Resolved links that no stored page has as its URL: what is left to fetch."""
    held = pages.select(F.col("url").alias("target"))
    return link_targets(pages).select("target").distinct().join(held, "target", "left_anti")


def page_addresses(counts: DataFrame, template: str = "p{n}.html", first_page: int = 1) -> DataFrame:
    """(page_id, url, page_no, target) for every page of a listing, from its ``page_count``.

    ``{n}`` in ``template`` stands for the page number; the address is resolved
    against the listing. Its targets are what a frontier may fetch.
    """
    numbers = F.expr(f"explode(sequence({first_page}, page_count))")
    return counts.where(F.col("page_count") >= first_page).select("page_id", "url", numbers.alias("page_no")).withColumn(
        "target", url_resolve("url", F.replace(F.lit(template), F.lit("{n}"), F.col("page_no").cast("string"))))


def crawl_coverage(pages: DataFrame, extracted: DataFrame) -> DataFrame:
    """Per host: pages held, links seen, links still missing, and whether any row was extracted.

    Links are made distinct before they are counted; ``extracted`` needs ``url``.
    """
    held = pages.groupBy(url_host("url").alias("host")).agg(F.count(F.lit(1)).alias("pages_held"))
    known = pages.select(F.col("url").alias("target")).distinct().withColumn("is_held", F.lit(1))
    links = (
        link_targets(pages).distinct().join(known, "target", "left").groupBy("host")
        .agg(F.count(F.lit(1)).alias("links_seen"), F.count_if(F.col("is_held").isNull()).alias("links_missing"))
    )
    rows = extracted.groupBy(url_host("url").alias("host")).agg(F.count(F.lit(1)).alias("rows_extracted"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return (
        held.join(links, "host", "left").join(rows, "host", "left")
        .select("host", "pages_held", zero("links_seen"), zero("links_missing"), zero("rows_extracted"))
    )
