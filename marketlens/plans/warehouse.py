"""The four warehouse layers: landed, detail, wide and application tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dims import EXCLUDED_REGIONS
from ..operators.cleaning import exclude_regions
from ..operators.profiles import panorama, variety_province_profile, variety_ranking
from ..sources.audit import layer_counts


def dwd_prices(ods: DataFrame, regions=EXCLUDED_REGIONS) -> DataFrame:
    """Detail quotes: renamed, priced, in a kept province."""
    return exclude_regions(ods.where(F.col("avg_price").isNotNull()), regions=regions).select(
        "variety", "province", F.col("market").alias("market_name"), "min_price", "max_price", "avg_price",
        "price_date", "variety_code",
    )


def dwd_seeds(ods: DataFrame, regions=EXCLUDED_REGIONS) -> DataFrame:
    return exclude_regions(ods, regions=regions).select(
        "variety", "province", "company_name", "click_count", "publish_date", "category",
    )


def dwd_suppliers(ods: DataFrame, regions=EXCLUDED_REGIONS) -> DataFrame:
    return exclude_regions(ods, regions=regions).select(
        "variety", "province", "contact_person", "company_type", "click_count", "publish_date", "category",
    )


def layers(ods_prices: DataFrame, ods_seeds: DataFrame, ods_suppliers: DataFrame) -> dict[str, DataFrame]:
    """All nine tables as lazy plans."""
    p, s, u = dwd_prices(ods_prices), dwd_seeds(ods_seeds), dwd_suppliers(ods_suppliers)
    return {
        "ods_prices": ods_prices, "ods_seeds": ods_seeds, "ods_suppliers": ods_suppliers,
        "dwd_prices": p, "dwd_seeds": s, "dwd_suppliers": u,
        "dws_panorama": panorama(p, s, u),
        "ads_variety_province_profile": variety_province_profile(p, s, u),
        "ads_variety_ranking": variety_ranking(p, s, u),
    }


def build(ods_prices: DataFrame, ods_seeds: DataFrame, ods_suppliers: DataFrame, base: str) -> dict[str, DataFrame]:
    """Write the layers below ``base``; each layer is computed from the stored one before.

    Detail quotes are stored by year-month for date pruning.
    """
    spark = ods_prices.sparkSession

    def store(name: str, df: DataFrame, *partition_by: str) -> DataFrame:
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    # Rebalancing clusters the months and lets AQE split a heavy one over tasks.
    detail = dwd_prices(ods_prices).withColumn("ym", F.date_format("price_date", "yyyy-MM")).hint("rebalance", "ym")
    p = store("dwd_prices", detail, "ym").drop("ym")
    s, u = store("dwd_seeds", dwd_seeds(ods_seeds)), store("dwd_suppliers", dwd_suppliers(ods_suppliers))
    return {
        "ods_prices": ods_prices, "ods_seeds": ods_seeds, "ods_suppliers": ods_suppliers,
        "dwd_prices": p, "dwd_seeds": s, "dwd_suppliers": u,
        "dws_panorama": store("dws_panorama", panorama(p, s, u)),
        "ads_variety_province_profile": store("ads_variety_province_profile", variety_province_profile(p, s, u)),
        "ads_variety_ranking": store("ads_variety_ranking", variety_ranking(p, s, u)),
    }


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    return layer_counts(tables)
