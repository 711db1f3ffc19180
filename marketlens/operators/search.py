"""Filtered, paged search over the three tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dims
from ..functions.text import contains_any

MAX_PAGE = 100


def keyword_filter(df: DataFrame, keyword: str | None, *columns: str) -> DataFrame:
    """Rows where either text column matches; missing text never matches."""
    return df.where(contains_any(keyword, *columns)) if keyword else df


def _narrow(df: DataFrame, province: str | None, variety: str | None) -> DataFrame:
    if province:
        df = df.where(dims.is_province(F.col("province"), province))
    if variety:
        df = df.where(dims.is_variety(F.col("variety"), variety))
    return df


def find_prices(prices: DataFrame, province: str | None = None, variety: str | None = None) -> DataFrame:
    return _narrow(prices, province, variety)


def find_seeds(seeds: DataFrame, keyword: str | None = None, province: str | None = None,
               variety: str | None = None) -> DataFrame:
    return keyword_filter(_narrow(seeds, province, variety), keyword, "product_name", "company_name")


def find_suppliers(suppliers: DataFrame, keyword: str | None = None, province: str | None = None,
                   variety: str | None = None, company_type: str | None = None) -> DataFrame:
    rows = keyword_filter(_narrow(suppliers, province, variety), keyword, "product_name", "contact_person")
    return rows.where(F.col("company_type") == company_type) if company_type else rows


def page_of(found: DataFrame, order: list, page: int, page_size: int) -> DataFrame:
    """One page in a total order, each row carrying the total number of hits.

    The total is a scalar subquery, so no window runs over the hits, and the
    page itself is a top-k of (offset + page size) rows per task.
    """
    if page < 1 or not 1 <= page_size <= MAX_PAGE:
        raise ValueError(f"page starts at 1 and page_size is 1..{MAX_PAGE}")
    total = found.agg(F.count(F.lit(1))).scalar()
    rows = found.orderBy(*order).offset((page - 1) * page_size).limit(page_size)
    return rows.withColumn("total", total).withColumn("page", F.lit(page))


def _follows(keys: list[tuple[str, bool]], last: dict) -> Column:
    """Rows behind ``last`` in an order of (column, descending) keys; nulls stand last."""
    same, behind = F.lit(True), F.lit(False)
    for column, descending in keys:
        c, value = F.col(column), last[column]
        if value is None:
            step = F.lit(False)
        else:
            step = F.coalesce(c < F.lit(value) if descending else c > F.lit(value), F.lit(True))
        behind = behind | (same & step)
        same = same & c.eqNullSafe(F.lit(value))
    return behind


def page_after(found: DataFrame, keys: list[tuple[str, bool]], page_size: int, last: dict | None = None) -> DataFrame:
    """The next ``page_size`` rows in a total order of (column, descending) keys.

    ``last`` holds the key values of the row that ended the page before, so a
    deep page is a filter and a top-k of one page: no skipped row is ranked.
    """
    if not 1 <= page_size <= MAX_PAGE:
        raise ValueError(f"page_size is 1..{MAX_PAGE}")
    rows = found if last is None else found.where(_follows(keys, last))
    return rows.orderBy(*[F.desc_nulls_last(c) if descending else F.asc_nulls_last(c) for c, descending in keys]).limit(page_size)


def newest_first(date: str, *keys: str) -> list:
    return [F.desc_nulls_last(date), *keys]
