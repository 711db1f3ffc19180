"""Tables of a page by one pass over its tags with a running depth.

Pages without nested tables, most of them, are read cell by cell instead.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.entities import html5

import pyarrow as pa
from pyspark.sql import DataFrame

_UNREAD = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)")
_CELL_TAG = re.compile(r"<[tT][dD]")
_MAY_BE_UNREAD = re.compile(r"<(?:!--|[sSſ](?:[cC]|[tT][yY]))")
# Letters of both cases: a scan that ignores case takes twice the time.
_TAG = re.compile(r"<(/?)([tT](?:[aA][bB][lL][eE]|[rRdD]))(?=[\s>/])([^>]*)>?")
_TABLE_TAG = re.compile(r"<(/?)[tT][aA][bB][lL][eE](?=[\s>/])([^>]*)>?")
# Text up to the next row or cell tag; closing ones with the text behind them; and an opening row tag, which is a group,
# or cell tag with the text of the cell, which is another.
_TEXT = r"[^<]*+(?:<(?!/?[tT][rRdD][\s>/])[^<]*+)*+"
_CLOSED = rf"(?:</[tT][rRdD](?=[\s>/])[^>]*+>?{_TEXT})*+"
_BEFORE = re.compile(_TEXT + _CLOSED)
_INSIDE = re.compile(rf"<[tT](?:([rR])|[dD])(?=[\s>/])[^>]*+>?({_TEXT}){_CLOSED}")
_NAMED = re.compile(r"&([A-Za-z][A-Za-z0-9]*;)")
#: References that stay for ``decode_entities``: their characters would be read as markup.
_LATER = {"lt;", "gt;", "amp;", "quot;", "apos;", "LT;", "GT;", "AMP;", "QUOT;"}

CELL = "struct<own:string,whole:string>"
TABLES = f"array<struct<opening:string,rows:array<array<{CELL}>>>>"
_CELL = pa.struct([("own", pa.string()), ("whole", pa.string())])
_TABLES = pa.list_(pa.struct([("opening", pa.string()), ("rows", pa.list_(pa.list_(_CELL)))]))


class _Table:
    """An open table: its rows, and of the open cell where it starts and, once a table stands in it, the pieces of its own."""

    __slots__ = ("opening", "rows", "wholes", "start", "at", "own")

    def __init__(self, opening: str):
        self.opening = opening
        self.rows: list[list[str]] = []
        self.wholes: list[list[str | None]] = []
        self.start = self.at = -1
        self.own: list[str] | None = None

    def end_cell(self, page: str, end: int) -> None:
        """A cell is one slice of the page; only one that holds tables has its own markup put together from pieces."""
        if self.start >= 0:
            whole = page[self.start : end]
            if self.own is None:
                self.rows[-1].append(whole)
                self.wholes[-1].append(None)
            else:
                self.rows[-1].append("".join(self.own) + page[self.at : end])
                self.wholes[-1].append(whole)
            self.start, self.own = -1, None

    def start_row(self) -> None:
        self.rows.append([])
        self.wholes.append([])


def named_references(text: str) -> str:
    """Named character references decoded, but for those of markup signs."""
    return _NAMED.sub(lambda m: m[0] if m[1] in _LATER else html5.get(m[1], m[0]), text) if "&" in text else text


def _tables(html: str | None) -> list[_Table]:
    """The tables of a page in the order of their opening tags."""
    if not html or "<" not in html:
        return []
    page = named_references(_UNREAD.sub(" ", html) if _MAY_BE_UNREAD.search(html) else html)
    flat = _flat(page)
    return _nested(page) if flat is None else flat


def _flat(page: str) -> list[_Table] | None:
    """The tables of a page where none stands in another, else None. So too where a table tag may be part of an unclosed tag."""
    found: list[_Table] = []
    spans: list[list[int]] = []
    is_open = False
    for tag in _TABLE_TAG.finditer(page):
        if page.rfind("<", 0, tag.start()) > page.rfind(">", 0, tag.start()):
            return None
        if not tag[1]:
            if is_open:
                return None
            is_open = True
            found.append(_Table(tag[2]))
            spans.append([tag.end(), len(page)])
        elif is_open:
            is_open = False
            spans[-1][1] = tag.start()
    for table, (start, end) in zip(found, spans, strict=True):
        rows = table.rows
        for opens_row, text in _INSIDE.findall(page, _BEFORE.match(page, start, end).end(), end):
            if opens_row or not rows:
                rows.append([])
            if not opens_row:
                rows[-1].append(text)
        table.wholes = [[None] * len(row) for row in rows]
    return found


def _nested(page: str) -> list[_Table]:
    found: list[_Table] = []
    stack: list[_Table] = []
    top: _Table | None = None
    for tag in _TAG.finditer(page):
        closing, name = tag.group(1, 2)
        kind = name[1]
        if kind in "aA":
            if not closing:
                # The text up to here is the innermost open cell's own; what follows is the new table's.
                if top is not None and top.start >= 0:
                    top.own = top.own or []
                    top.own.append(page[top.at : tag.start()])
                top = _Table(tag[3])
                stack.append(top)
                found.append(top)
            elif top is not None:
                top.end_cell(page, tag.start())
                stack.pop()
                top = stack[-1] if stack else None
                if top is not None:
                    top.at = tag.end()
        elif top is not None:
            if top.start >= 0:
                top.end_cell(page, tag.start())
            if not closing:
                if kind in "rR":
                    top.start_row()
                else:
                    if not top.rows:
                        top.start_row()
                    top.start = top.at = tag.end()
    # Tables that are still open end with the page; the own of an outer cell stopped where the inner table began.
    for table in stack:
        if table is not top:
            table.at = len(page)
        table.end_cell(page, len(page))
    return found


def tables_of(html: str | None) -> list[dict]:
    """The tables of a page in the order of their opening tags, each with its own rows and cells.

    Tables may stand in cells of others: rows and cells belong to the innermost
    open table. Rows and cells that are not closed end at the next one. A cell
    has its ``own`` markup, without the tables inside it, and its ``whole`` markup where that differs.
    Comments, scripts and styles are left out. Null and empty pages have no tables.
    """
    pairs = lambda t: [[{"own": o, "whole": w} for o, w in zip(r, v, strict=True)] for r, v in zip(t.rows, t.wholes, strict=True)]
    return [{"opening": t.opening, "rows": pairs(t)} for t in _tables(html)]


def _as_arrow(htmls: list[str | None]) -> pa.Array:
    """``tables_of`` every page, put together from flat columns."""
    own: list[str] = []
    whole: list[str | None] = []
    opening: list[str] = []
    tables_to, rows_to, cells_to = [0], [0], [0]
    for html in htmls:
        for table in _tables(html):
            opening.append(table.opening)
            for row, wholes in zip(table.rows, table.wholes, strict=True):
                own += row
                whole += wholes
                cells_to.append(len(own))
            rows_to.append(len(cells_to) - 1)
        tables_to.append(len(opening))
    offsets = lambda to: pa.array(to, pa.int32())
    cells = pa.StructArray.from_arrays([pa.array(own, pa.string()), pa.array(whole, pa.string())], fields=list(_CELL))
    rows = pa.ListArray.from_arrays(offsets(rows_to), pa.ListArray.from_arrays(offsets(cells_to), cells))
    tables = pa.StructArray.from_arrays([pa.array(opening, pa.string()), rows], names=["opening", "rows"])
    return pa.ListArray.from_arrays(offsets(tables_to), tables).cast(_TABLES)


def _with_cells(htmls: list[str | None], but_with: str | None) -> list[int]:
    return [i for i, h in enumerate(htmls) if h and _CELL_TAG.search(h) and not (but_with and but_with in h)]


def with_tables(pages: DataFrame, but_with: str | None = None) -> DataFrame:
    """``page_id, url, tables`` of ``pages(page_id, url, html)``; other columns are left out.

    Pages without a cell, and those that hold the text ``but_with``, are left out. They are tested
    where the page is read: a filter in front of it would run whatever makes the html once more for each test.
    """
    kept = pages.select("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            htmls = batch.column("html").to_pylist()
            at = _with_cells(htmls, but_with)
            schema = pa.schema([batch.schema.field("page_id"), batch.schema.field("url"), pa.field("tables", _TABLES)])
            columns = [batch.column(c).take(pa.array(at, pa.int64())) for c in ("page_id", "url")]
            yield pa.RecordBatch.from_arrays([*columns, _as_arrow([htmls[i] for i in at])], schema=schema)

    of = dict(kept.dtypes)
    return kept.mapInArrow(run, f"page_id {of['page_id']}, url {of['url']}, tables {TABLES}")


def with_fields(pages: DataFrame, names: list[str], read: Callable[[list[_Table]], list[tuple]], but_with: str | None = None) -> DataFrame:
    """``page_id, url, row_no`` and the texts ``names`` that ``read`` makes of the tables of a page, in the same pass.

    ``read`` gives (row number, text, ...) for every row it takes. Nothing but those rows leaves the pass, no table
    with all its cells. Pages are left out as in ``with_tables``.
    """
    kept = pages.select("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            htmls = batch.column("html").to_pylist()
            at: list[int] = []
            rows: list[tuple] = []
            for i in _with_cells(htmls, but_with):
                found = read(_tables(htmls[i]))
                rows += found
                at += [i] * len(found)
            schema = pa.schema([
                batch.schema.field("page_id"), batch.schema.field("url"), pa.field("row_no", pa.int32()), *[pa.field(n, pa.string()) for n in names]])
            columns = [batch.column(c).take(pa.array(at, pa.int64())) for c in ("page_id", "url")]
            values = list(zip(*rows, strict=True)) if rows else [()] * (len(names) + 1)
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(v, f.type) for v, f in zip(values, list(schema)[2:], strict=True)]], schema=schema)

    of = dict(kept.dtypes)
    return kept.mapInArrow(run, f"page_id {of['page_id']}, url {of['url']}, row_no int, " + ", ".join(f"{n} string" for n in names))
