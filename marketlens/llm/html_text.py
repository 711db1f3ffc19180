"""Main text of web pages by removal of what a site repeats.

1. Every page is read into a tree and each container element gets the hash of
   its subtree. Spark counts, per host, on how many pages with different main
   text a subtree stands; a page's main text is known by its longest block
   outside of announced boilerplate, so that copies of one page count once.
2. A subtree outside a marked article that recurs on ``TEMPLATE_SHARE`` of such
   pages of its host, and on ``TEMPLATE_PAGES`` at least, belongs to the site,
   not to the page, and is deleted. So are elements that say what
   they are: menus, headers, footers, sidebars, notices, adverts, forms,
   scripts, styles, reader comments.
3. What is left of the article (or of the body, if none is marked) is written
   as blocks, one per line, with character references decoded and white space
   folded.

Nothing inside a marked article is deleted as a template, wrapped or not:
copies of an article on one host are still articles. Hot hosts only
meet in counts, which are summed before they move.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.settle import settle
from marketlens.llm.html_tree import BLOCK, Element, hash_subtrees, parse

TEMPLATE_PAGES = 5
#: Share of a host's distinct pages on which a template stands at least.
TEMPLATE_SHARE = 0.05

DROPPED = frozenset(
    "script style noscript template iframe svg canvas object head title nav aside footer form button select textarea menu dialog datalist map audio video".split())
#: Elements whose recurrence is counted.
CONTAINERS = frozenset("nav ul ol dl div section aside header footer form table details center fieldset menu main".split())
_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split())
#: Words that name boilerplate when a class or id is one, ends with one ("site-nav") or begins with one and goes on with parts of pages ("share-buttons").
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead "
    "cookie cookies consent gdpr notice notices banner popup modal overlay newsletter subscribe subscription share sharing social related recommended comment comments "
    "commentlist replies respond disqus login signup signin pagination pager widget toolbar skip-link side-bar".split())
_OUTER_NAMES = frozenset("header footer topbar top-bar".split())
_PARTS = frozenset(
    "list lists box boxes bar block wrap wrapper container area section link links button buttons post posts article articles widget panel inner outer content item items "
    "text header footer form menu message group media icons left right top bottom main primary secondary mobile".split())
#: Words that say that something else has, or lacks, the named part.
_OF_OTHERS = frozenset("has with no not non without is hide show".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD_BORDER = re.compile("[-_]+")


def _is_name(name: str, words: frozenset[str]) -> bool:
    """Whether a whole class or id is a name out of ``words``."""
    if name in words:
        return True
    parts = [p for p in _WORD_BORDER.split(name) if p]
    if not parts or not _OF_OTHERS.isdisjoint(parts):
        return False
    return parts[-1] in words or parts[0] in words and all(p in _PARTS or p.isdigit() for p in parts[1:])


def _announced(element: Element, in_article: bool) -> bool:
    """Whether an element says by its tag, role or style that it is no part of the article."""
    if element.tag in DROPPED or element.tag == "header" and not in_article:
        return True
    if not element.attributes.strip():
        return False
    named = element.attribute_map()
    return "hidden" in named or named.get("aria-hidden") == "true" or bool(_HIDDEN.search(named.get("style", ""))) or named.get("role", "").lower() in _ROLES


def _named(element: Element, in_article: bool) -> bool:
    """Whether a class or the id of an element names boilerplate."""
    if not element.attributes.strip() or element.tag in ("html", "body", "main"):
        return False
    named = element.attribute_map()
    names = f"{named.get('class', '')} {named.get('id', '')}".lower().split()
    return any(_is_name(n, _NAMES) or not in_article and element.tag != "article" and _is_name(n, _OUTER_NAMES) for n in names)


def _left_out(element: Element, in_article: bool) -> bool:
    """Whether an element is announced or named boilerplate; a name never decides on what holds a marked article."""
    return _announced(element, in_article) or not element.holds_article and _named(element, in_article)


def _main_parts(root: Element, deleted: frozenset[int] | set[int]) -> list[Element]:
    """The marked articles (those named as something else only if there is no other), else the main element, else the whole page."""
    articles, named, mains, todo = [], [], [], [root]
    while todo:
        element = todo.pop()
        if (_announced if element.tag == "article" else _left_out)(element, False) or element.tag != "article" and element.digest in deleted and element.tag in CONTAINERS:
            continue
        if element.tag == "article":
            (named if _named(element, False) else articles).append(element)
            continue
        if element.tag == "main":
            mains.append(element)
        todo.extend(c for c in reversed(element.children) if type(c) is Element)
    return articles or named or mains[:1] or [root]


def _blocks(part: Element, deleted: frozenset[int] | set[int], in_article: bool) -> list[str]:
    """Text of the blocks in page order."""
    blocks: list[str] = []
    words: list[str] = []

    def close() -> None:
        if words and (text := " ".join(unescape("".join(words)).split())):
            blocks.append(text)
        words.clear()

    todo: list = [part]
    while todo:
        node = todo.pop()
        if node is None:
            close()
        elif type(node) is str:
            words.append(node)
        elif node is not part and (_left_out(node, in_article) or part.tag != "article" and node.digest in deleted and node.tag in CONTAINERS):
            if node.tag in BLOCK:
                close()
        elif node.tag in ("br", "wbr"):
            words.append(" " if node.tag == "br" else "")
        elif node.tag in BLOCK:
            close()
            todo.append(None)
            todo.extend(reversed(node.children))
        else:
            todo.extend(reversed(node.children))
    close()
    return blocks


def extract(html: str | None, deleted: frozenset[int] | set[int] = frozenset()) -> str:
    """Main text of a page without the subtrees whose hash is in ``deleted``."""
    if not html:
        return ""
    root = parse(html)
    if deleted:
        hash_subtrees(root)
    return "\n".join(block for part in _main_parts(root, deleted) for block in _blocks(part, deleted, part.tag in ("article", "main")))


def _longest(root: Element) -> str:
    """The longest text node of the article or body outside of announced boilerplate."""
    longest = ""
    for part in _main_parts(root, frozenset()):
        todo = [part]
        while todo:
            element = todo.pop()
            for child in element.children:
                if type(child) is not Element:
                    longest = child if len(child) > len(longest) and not child.isspace() else longest
                elif not _left_out(child, part.tag in ("article", "main")):
                    todo.append(child)
    return longest


def subtrees(html: str | None) -> tuple[list[int], int]:
    """Hashes of the containers with text, and the hash that stands for the main text."""
    if not html:
        return [], 0
    root = parse(html)
    hash_subtrees(root)
    found: set[int] = set()
    longest, own = "", _longest(root)
    todo: list[Element] = [root]
    while todo:
        element = todo.pop()
        if element.tag in ("script", "style", "head"):
            continue
        has_text = False
        for child in element.children:
            if type(child) is Element:
                has_text = True
                todo.append(child)
            elif len(child) > len(longest):
                longest, has_text = child, True
            else:
                has_text = has_text or not child.isspace()
        if has_text and element.tag in CONTAINERS:
            found.add(element.digest)
    mark = Element("p")
    mark.children.append(own or longest)
    hash_subtrees(mark)
    return list(found), mark.digest


def _keyed(pages: DataFrame) -> DataFrame:
    """Pages with a host and a key: equal keys mean equal pages."""
    return pages.select(
        "page_id", "url", F.col("html").cast("string").alias("html"),
        F.coalesce(F.lower(F.regexp_extract(F.col("url").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit("")).alias("host"),
        F.coalesce(F.col("page_id").cast("long"), F.lit(-1)).alias("id"), F.xxhash64("html", "url").alias("stamp"),
    )


def page_templates(pages: DataFrame, template_pages: int = TEMPLATE_PAGES, template_share: float = TEMPLATE_SHARE) -> DataFrame:
    """``id, stamp, deleted``: for each page its subtrees that its host repeats."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                found = [subtrees(html) for html in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([f[1] for f in found], pa.int64()), pa.array([f[0] for f in found], pa.list_(pa.int64()))],
                    names=["host", "id", "stamp", "content", "subtrees"])

    rows = settle(_keyed(pages).select("host", "id", "stamp", "html").mapInArrow(
        read, "host string, id long, stamp long, content long, subtrees array<long>"), "subtrees")
    each = rows.select("host", "id", "stamp", "content", F.explode("subtrees").alias("subtree"))
    hosts = rows.groupBy("host", "content").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("one").alias("pages"))
    recurring = (
        each.groupBy("host", "subtree", "content").agg(F.lit(1).alias("one")).groupBy("host", "subtree").agg(F.count("one").alias("n"))
        .where(F.col("n") >= template_pages)
        .join(hosts, "host").where(F.col("n") >= F.col("pages") * template_share).select("host", "subtree")
    )
    return each.join(recurring, ["host", "subtree"]).groupBy("id", "stamp").agg(F.collect_set("subtree").alias("deleted"))


def main_texts(pages: DataFrame, template_pages: int = TEMPLATE_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    A null page is empty; a null or odd url puts the page on a host of its own
    kind, the empty one. Equal rows give equal rows. Other columns are left
    out.
    """
    templates = page_templates(pages, template_pages)
    keyed = _keyed(pages)
    schema = keyed.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = [extract(html, frozenset(gone or ())) for html, gone in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return (
        keyed.join(templates.hint("shuffle_hash"), ["id", "stamp"], "left").select("page_id", "url", "html", "deleted")
        .mapInArrow(write, schema)
    )
