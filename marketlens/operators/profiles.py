"""Variety-by-province profiles joining quotes with seed and supplier listings.

Every table is aggregated to its keys before any join, so the joins run on a
few rows per (variety, province) and hot keys are folded by the map-side
partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import dims
from ..functions.numbers import ratio, round_out

PAIR = ["variety", "province"]


def pair_counts(listings: DataFrame, out: str) -> DataFrame:
    return listings.where(F.col("province").isNotNull()).groupBy(*PAIR).agg(F.count(F.lit(1)).alias(out))


def with_listing_counts(groups: DataFrame, seeds: DataFrame, suppliers: DataFrame, keys: list[str],
                        seed_name: str = "seed_count", supplier_name: str = "supplier_count") -> DataFrame:
    """Left join the listing counts per key; missing counts are zero."""
    joined = groups
    for listings, name in ((seeds, seed_name), (suppliers, supplier_name)):
        counts = listings.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
        joined = joined.join(counts, keys, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return joined


def panorama(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Wide table: quote statistics and listing counts per (variety, province)."""
    groups = prices.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("price_record_count"),
        round_out(F.avg("avg_price"), 2).alias("avg_price_num"),
        round_out(F.min("min_price"), 2).alias("min_price_num"),
        round_out(F.max("max_price"), 2).alias("max_price_num"),
    )
    return with_listing_counts(groups, seeds, suppliers, PAIR)


def _national():
    """Mean quote of the variety over all its pairs."""
    everywhere = W.partitionBy("variety")
    return ratio(F.sum("total").over(everywhere), F.sum("priced").over(everywhere))


def variety_province_profile(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame,
                             min_records: int = 10) -> DataFrame:
    """Pairs with enough quotes: supply maturity and price against the national mean.

    The national mean uses unrounded inputs. It is a window over the pair groups,
    so the facts are scanned once.
    """
    groups = prices.groupBy(*PAIR).agg(
        F.sum("avg_price").alias("total"), F.count("avg_price").alias("priced"),
        F.avg("avg_price").alias("mean"), F.count(F.lit(1)).alias("price_records"),
    )
    kept = groups.withColumn("national", _national()).where(F.col("price_records") >= min_records)
    return (
        with_listing_counts(kept, seeds, suppliers, PAIR)
        .select(
            *PAIR,
            round_out("mean", 2).alias("avg_price"),
            "price_records", "seed_count", "supplier_count",
            (F.col("seed_count") + F.col("supplier_count")).alias("supply_maturity"),
            round_out(ratio("mean", "national"), 3).alias("price_competitiveness"),
        )
    )


def cross_table_profile(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame,
                        variety: str | None = None, province: str | None = None,
                        top_n: int | None = None, min_records: int = 10) -> DataFrame:
    """The profile with volatility, on rounded inputs; optionally filtered and cut to top n.

    The national mean is of all regions, so the filters apply after it.
    """
    groups = prices.groupBy(*PAIR).agg(
        F.sum("avg_price").alias("total"), F.count("avg_price").alias("priced"),
        round_out(F.avg("avg_price"), 2).alias("avg_price"),
        round_out(F.stddev_samp("avg_price"), 2).alias("price_std"),
        F.count(F.lit(1)).alias("price_records"),
    )
    kept = groups.withColumn("national_avg_price", round_out(_national(), 4)).where(F.col("price_records") >= min_records)
    if variety:
        kept = kept.where(dims.is_variety(F.col("variety"), variety))
    if province:
        kept = kept.where(dims.is_province(F.col("province"), province))
    result = (
        with_listing_counts(kept, seeds, suppliers, PAIR)
        .select(
            *PAIR, "avg_price", "price_std", "price_records", "seed_count", "supplier_count",
            (F.col("seed_count") + F.col("supplier_count")).alias("supply_maturity"),
            "national_avg_price",
            round_out(ratio("avg_price", "national_avg_price"), 3).alias("price_competitiveness"),
            round_out(ratio("price_std", "avg_price"), 3).alias("price_volatility"),
        )
        .orderBy(F.desc("supply_maturity"), *PAIR)
    )
    return result.limit(top_n) if top_n else result


def cross_table_summary(profile: DataFrame) -> DataFrame:
    """Profile rolled up per variety."""
    return (
        profile.groupBy("variety").agg(
            round_out(F.avg("avg_price"), 2).alias("avg_price"),
            F.sum("seed_count").alias("total_seeds"),
            F.sum("supplier_count").alias("total_suppliers"),
            F.countDistinct("province").alias("province_count"),
        )
        .withColumn("supply_maturity", F.col("total_seeds") + F.col("total_suppliers"))
        .orderBy(F.desc("supply_maturity"), "variety")
    )


def cross_table_summary_base(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame) -> DataFrame:
    """The same roll-up straight from the tables, over varieties found in any of them."""
    has_key = F.col("variety").isNotNull()
    pairs = prices.where(has_key).groupBy(*PAIR).agg(
        F.sum("avg_price").alias("total"), F.count("avg_price").alias("priced")
    )
    priced = pairs.groupBy("variety").agg(
        round_out(ratio(F.sum("total"), F.sum("priced")), 2).alias("mean"),
        F.countDistinct("province").alias("n_provinces"),
    )
    counts = lambda df, name: df.where(has_key).groupBy("variety").agg(F.count(F.lit(1)).alias(name))
    return (
        priced.join(counts(seeds, "n_seeds"), "variety", "full")
        .join(counts(suppliers, "n_suppliers"), "variety", "full")
        .select(
            "variety",
            F.coalesce("mean", F.lit(0.0)).alias("avg_price"),
            F.coalesce("n_seeds", F.lit(0)).alias("total_seeds"),
            F.coalesce("n_suppliers", F.lit(0)).alias("total_suppliers"),
            F.coalesce("n_provinces", F.lit(0)).alias("province_count"),
        )
        .withColumn("supply_maturity", F.col("total_seeds") + F.col("total_suppliers"))
        .orderBy(F.desc("supply_maturity"), "variety")
    )


def variety_ranking(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame) -> DataFrame:
    """National ranking by listings and price level."""
    groups = prices.groupBy("variety").agg(
        round_out(F.avg("avg_price"), 2).alias("national_avg_price"),
        F.count(F.lit(1)).alias("price_record_count"),
    )
    joined = with_listing_counts(
        groups, seeds, suppliers, ["variety"], "total_seed_count", "total_supplier_count"
    )
    score = (
        F.col("total_seed_count") * F.lit(0.3)
        + F.col("total_supplier_count") * F.lit(0.4)
        + (F.lit(100.0) - F.col("national_avg_price")) * F.lit(0.3)
    )
    return joined.withColumn("competitiveness_score", round_out(score, 2)).orderBy(
        F.desc("competitiveness_score"), "variety"
    )
