"""Overviews, key lists and data-quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import dims
from ..functions.numbers import round_out


def key_union(column: str, *tables: DataFrame) -> DataFrame:
    """Distinct non-null values of a column over several tables."""
    parts = [t.select(column).where(F.col(column).isNotNull()).distinct() for t in tables]
    return reduce(DataFrame.union, parts).distinct()


def key_intersect(column: str, *tables: DataFrame) -> DataFrame:
    """Distinct non-null values of a column present in every table."""
    parts = [t.select(column).where(F.col(column).isNotNull()).distinct() for t in tables]
    return reduce(DataFrame.intersect, parts)


def variety_list(prices: DataFrame) -> DataFrame:
    return key_union("variety", prices).orderBy("variety")


def province_list(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame) -> DataFrame:
    dropped = dims.EXCLUDED_REGIONS + ("未知", "")
    return key_union("province", prices, seeds, suppliers).where(~F.col("province").isin(*dropped)).orderBy("province")


def overview(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Row counts, distinct keys and date bounds of the three tables, as one row.

    Each table is scanned once: quotes are reduced to (variety, market) groups
    before anything is counted as distinct, and the listing totals enter as one
    scalar subquery per table. Province names are a bounded domain, so their
    set travels with the totals.
    """
    dropped = F.array(*[F.lit(p) for p in (*dims.EXCLUDED_REGIONS, "未知", "")])
    groups = prices.groupBy("variety", "market").agg(
        F.count(F.lit(1)).alias("n"), F.min("price_date").alias("d0"), F.max("price_date").alias("d1"), F.collect_set("province").alias("p")
    )
    listing = lambda df: df.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.max("publish_date").alias("d"), F.collect_set("province").alias("p")).alias("v")
    ).scalar()
    provinces = F.array_except(F.array_union("p", F.array_union(listing(seeds)["p"], listing(suppliers)["p"])), dropped)
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("price_count"),
        F.countDistinct("variety").alias("varieties"),
        F.countDistinct("market").alias("markets"),
        F.min("d0").alias("price_date_min"),
        F.max("d1").alias("price_date_max"),
        F.array_distinct(F.flatten(F.collect_set("p"))).alias("p"),
    ).select(
        "price_count", "varieties", "markets", "price_date_min", "price_date_max",
        listing(seeds)["n"].alias("seed_count"),
        listing(suppliers)["n"].alias("supplier_count"),
        F.size(provinces).cast("bigint").alias("provinces"),
        listing(seeds)["d"].alias("seed_date_max"),
        listing(suppliers)["d"].alias("supplier_date_max"),
    )


def data_quality(prices: DataFrame) -> DataFrame:
    """Per variety: rows with a price, mean, date range, share of the best covered variety."""
    stats = prices.where(F.col("variety").isNotNull()).groupBy("variety").agg(
        F.count("avg_price").alias("record_count"),
        round_out(F.coalesce(F.avg("avg_price"), F.lit(0.0)), 2).alias("avg_price"),
        F.min("price_date").alias("date_min"),
        F.max("price_date").alias("date_max"),
    )
    best = F.max("record_count").over(W.partitionBy())
    return stats.withColumn(
        "completeness", round_out(F.try_divide(F.col("record_count"), best) * 100.0, 1)
    ).orderBy(F.desc("record_count"), "variety")


def data_quality_summary(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame) -> DataFrame:
    totals = overview(prices, seeds, suppliers)
    return totals.select(
        F.col("price_count").alias("total_price_records"),
        F.col("seed_count").alias("total_seed_records"),
        F.col("supplier_count").alias("total_supplier_records"),
        F.col("varieties").alias("variety_count"),
        F.col("provinces").alias("province_count"),
        F.col("markets").alias("market_count"),
    )
