"""Variety scores and supply health.

Maxima that normalise a score are windows over the per-variety aggregate (one
row per variety), so the facts are scanned once and nothing goes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.numbers import ratio, round_out
from .profiles import with_listing_counts


def share_of_max(column: str) -> Column:
    """column / max(column) over all rows of a per-key aggregate; NULL when the maximum is zero."""
    return ratio(column, F.max(column).over(W.partitionBy()))


def normalized_count(listings: DataFrame, out: str = "n") -> DataFrame:
    """Rows per variety and their share of the largest variety."""
    counts = listings.where(F.col("variety").isNotNull()).groupBy("variety").agg(F.count(F.lit(1)).alias(out))
    return counts.withColumn(f"{out}_norm", share_of_max(out))


def price_cv(prices: DataFrame) -> DataFrame:
    """Coefficient of variation per variety with a positive mean."""
    return (
        prices.where(F.col("variety").isNotNull()).groupBy("variety")
        .agg(F.avg("avg_price").alias("mean"), F.stddev_samp("avg_price").alias("std"))
        .where("mean > 0")
        .withColumn("cv", ratio("std", "mean"))
    )


def price_cv_norm(prices: DataFrame) -> DataFrame:
    """Stability: one minus the variation as a share of the largest variation."""
    stats = price_cv(prices)
    return stats.withColumn("stability_norm", F.lit(1.0) - share_of_max("cv"))


def _three_way(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame) -> DataFrame:
    return (
        normalized_count(seeds, "seed_count")
        .join(normalized_count(suppliers, "supplier_count"), "variety")
        .join(price_cv_norm(prices), "variety")
        .withColumn("price_stability", round_out("stability_norm", 2))
    )


def variety_score(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame, top_n: int = 15) -> DataFrame:
    """Weighted score of varieties present in all three tables."""
    total = (
        F.col("seed_count_norm") * 0.3 + F.col("supplier_count_norm") * 0.4 + F.col("stability_norm") * 0.3
    )
    return (
        _three_way(prices, seeds, suppliers)
        .select("variety", "seed_count", "supplier_count", "price_stability", round_out(total, 2).alias("total_score"))
        .orderBy(F.desc_nulls_last("total_score"), "variety")
        .limit(top_n)
    )


def variety_score_renorm(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame, top_n: int = 15) -> DataFrame:
    """The variant whose stability is rounded first and then scaled by its own maximum.

    All three maxima are taken over the varieties present in every table.
    """
    common = _three_way(prices, seeds, suppliers).select(
        "variety", "seed_count", "supplier_count",
        F.coalesce("price_stability", F.lit(0.0)).alias("price_stability"),
    )
    total = (
        share_of_max("seed_count") * 0.3
        + share_of_max("supplier_count") * 0.4
        + share_of_max("price_stability") * 0.3
    )
    return (
        common.withColumn("total_score", round_out(total, 2))
        .orderBy(F.desc_nulls_last("total_score"), "variety")
        .limit(top_n)
    )


def supply_demand_items(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Per priced variety: listings, variation and mean."""
    stats = prices.where(F.col("variety").isNotNull()).groupBy("variety").agg(
        F.avg("avg_price").alias("mean"), F.stddev_samp("avg_price").alias("std")
    )
    return with_listing_counts(stats, seeds, suppliers, ["variety"], "seeds", "suppliers").select(
        "variety", "seeds", "suppliers",
        F.coalesce(round_out(ratio("std", "mean"), 3), F.lit(0.0)).alias("cv"),
        F.coalesce(round_out("mean", 2), F.lit(0.0)).alias("avg_price"),
    )


def supply_demand_correlation(items: DataFrame) -> DataFrame:
    """Pearson r of listings against variation; zero below three varieties or without variance."""
    def r(x: str) -> Column:
        # corr() itself raises on zero variance in ANSI mode.
        value = F.coalesce(ratio(F.covar_pop(x, "cv"), F.stddev_pop(x) * F.stddev_pop("cv")), F.lit(0.0))
        return round_out(F.when(F.count(F.lit(1)) < 3, F.lit(0.0)).otherwise(value), 3)

    return items.agg(
        F.count(F.lit(1)).alias("varieties"), r("seeds").alias("r_seed_cv"), r("suppliers").alias("r_supplier_cv")
    )


def supply_chain_health(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Health score and grade per variety, and the gain if seeds grew by a fifth."""
    stats = (
        prices.where(F.col("variety").isNotNull()).groupBy("variety")
        .agg(F.avg("avg_price").alias("mean"), F.stddev_samp("avg_price").alias("std"))
        .withColumn("cv", F.coalesce(ratio("std", "mean"), F.lit(0.0)))
    )
    joined = with_listing_counts(stats, seeds, suppliers, ["variety"], "seeds", "suppliers")
    share = lambda c: F.coalesce(share_of_max(c), F.lit(0.0))
    normed = joined.select(
        "variety", "seeds", "suppliers", "cv", "mean",
        share("seeds").alias("n_seed"), share("suppliers").alias("n_sup"), share("cv").alias("n_cv"),
    )
    total = lambda seed: seed * 0.4 + F.col("n_sup") * 0.3 + (F.lit(1.0) - F.col("n_cv")) * 0.3
    scored = normed.withColumn("health_score", round_out(total(F.col("n_seed")), 3)).withColumn(
        "sim_score", round_out(total(F.least(F.lit(1.0), F.col("n_seed") * 1.2)), 3)
    )
    score = F.col("health_score")
    return scored.select(
        "variety", "seeds", "suppliers",
        round_out("cv", 3).alias("cv"),
        round_out("mean", 2).alias("avg_price"),
        "health_score",
        F.when(score >= 0.8, "A").when(score >= 0.6, "B").when(score >= 0.4, "C").otherwise("D").alias("grade"),
        round_out((F.col("sim_score") - score) * 100.0, 1).alias("sim_improvement"),
    ).orderBy(F.desc("health_score"), "variety")
