"""Counts over seed and supplier listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dims


def _counted(df: DataFrame, key: str, out: str) -> DataFrame:
    return df.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(F.count(F.lit(1)).alias(out))


def by_province(listings: DataFrame, out: str) -> DataFrame:
    """Listings per known province, most first."""
    known = listings.where(~F.col("province").isin("未知", ""))
    return _counted(known, "province", out).orderBy(F.desc(out), "province")


def by_category(listings: DataFrame, out: str, top_n: int = 20) -> DataFrame:
    return _counted(listings, "variety", out).orderBy(F.desc(out), "variety").limit(top_n)


def categories_in_province(listings: DataFrame, province: str, out: str) -> DataFrame:
    """Listings per variety in one province, given by short or full name."""
    local = listings.where(dims.is_province(F.col("province"), province))
    return _counted(local, "variety", out).orderBy(F.desc(out), "variety")


def supplier_type_distribution(suppliers: DataFrame, top_n: int = 10) -> DataFrame:
    return (
        _counted(suppliers, "company_type", "supplier_count")
        .orderBy(F.desc("supplier_count"), "company_type")
        .limit(top_n)
    )
