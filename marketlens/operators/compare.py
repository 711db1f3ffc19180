"""Comparisons of chosen provinces and varieties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dims
from ..functions.numbers import ratio, round_out
from .pricing import monthly_trend


def _row_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)))


def province_panorama(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame, province: str) -> DataFrame:
    """One province as one row: listings and mean quote, zero when there is none."""
    local = lambda df: df.where(F.col("province") == province)
    return local(prices).agg(
        F.coalesce(round_out(F.avg("avg_price"), 2), F.lit(0.0)).alias("avg_price")
    ).select(
        F.lit(province).alias("province"),
        _row_total(local(seeds)).scalar().alias("seed_count"),
        _row_total(local(suppliers)).scalar().alias("supplier_count"),
        "avg_price",
    )


def _requested(df: DataFrame, values: list[str], key: str) -> DataFrame:
    rows = [(str(i), v) for i, v in enumerate(values)]
    return dims.literal_frame(df.sparkSession, rows, "no", key).select(F.col("no").cast("int").alias("position"), key)


def province_compare(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame, provinces: list[str]) -> DataFrame:
    """All asked provinces in request order, zeros where a table has none."""
    local = lambda df: df.where(F.col("province").isin(*provinces))
    # (variety, market) groups first: the distinct counts then see few rows.
    groups = local(prices).groupBy("province", "variety", "market").agg(
        F.sum("avg_price").alias("total"), F.count("avg_price").alias("priced")
    )
    priced = groups.groupBy("province").agg(
        round_out(ratio(F.sum("total"), F.sum("priced")), 2).alias("mean"),
        F.countDistinct("variety").alias("n_varieties"),
        F.countDistinct("market").alias("n_markets"),
    )
    counts = lambda df, name: local(df).groupBy("province").agg(F.count(F.lit(1)).alias(name))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return (
        _requested(prices, provinces, "province")
        .join(priced, "province", "left")
        .join(counts(seeds, "n_seeds"), "province", "left")
        .join(counts(suppliers, "n_suppliers"), "province", "left")
        .select(
            "position", "province",
            zero("n_seeds").alias("seed_count"), zero("n_suppliers").alias("supplier_count"),
            F.coalesce("mean", F.lit(0.0)).alias("avg_price"),
            zero("n_varieties").alias("varieties"), zero("n_markets").alias("markets"),
        )
        .orderBy("position")
    )


def province_radar(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame, top_n: int = 8) -> DataFrame:
    """Provinces by combined score, with the largest value of every dimension among them."""
    known = lambda df: df.where(F.col("province").isNotNull()).groupBy("province")
    combined = (
        known(seeds).agg(F.count(F.lit(1)).alias("s"))
        .join(known(suppliers).agg(F.count(F.lit(1)).alias("u")), "province", "full")
        .join(known(prices).agg(round_out(F.avg("avg_price"), 2).alias("p")), "province", "full")
        .select(
            "province",
            F.coalesce("s", F.lit(0)).alias("seed_count"),
            F.coalesce("u", F.lit(0)).alias("supplier_count"),
            F.coalesce("p", F.lit(0.0)).alias("avg_price"),
        )
    )
    score = F.col("seed_count") + F.col("supplier_count") + F.col("avg_price") * 1000.0
    top = combined.withColumn("score", round_out(score, 2)).orderBy(F.desc("score"), "province").limit(top_n)

    def largest(c: str):
        best = top.agg(F.max(c)).scalar()
        return F.when(best == 0, F.lit(1).cast("double" if c == "avg_price" else "bigint")).otherwise(best).alias(f"max_{c}")

    return top.select("*", largest("seed_count"), largest("supplier_count"), largest("avg_price"))


def variety_compare(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame, varieties: list[str]) -> DataFrame:
    """All asked varieties in request order with a nested last-twelve-months series.

    Varieties without quotes are left out. The spread and coverage of each come
    from one pass; listing counts and the monthly series are joined per variety.
    """
    forms = [(str(i), f) for i, v in enumerate(varieties) for f in dims.variety_forms(v)]
    request = dims.literal_frame(prices.sparkSession, forms, "no", "variety").select(
        F.col("no").cast("int").alias("position"), "variety"
    )
    local = lambda df: df.where(F.col("variety").isin(*[f for _, f in forms]))
    stats = local(prices).groupBy("variety").agg(
        round_out(F.avg("avg_price"), 2).alias("avg_price"),
        F.coalesce(round_out(F.stddev_samp("avg_price"), 2), F.lit(0.0)).alias("price_std"),
        F.count(F.lit(1)).alias("record_count"),
    )
    coverage = (
        local(prices).select("variety", "province", "market").distinct().groupBy("variety")
        .agg(F.countDistinct("province").alias("province_count"), F.countDistinct("market").alias("market_count"))
    )
    counts = lambda df, name: local(df).groupBy("variety").agg(F.count(F.lit(1)).alias(name))
    series = monthly_trend(prices, varieties).groupBy("variety").agg(
        F.array_sort(F.collect_list(F.struct("month", "price"))).alias("monthly_trend")
    )
    return (
        request.join(stats, "variety")
        .join(coverage, "variety")
        .join(counts(seeds, "n_seeds"), "variety", "left")
        .join(counts(suppliers, "n_suppliers"), "variety", "left")
        .join(series, "variety", "left")
        .select(
            "position", "variety", "avg_price", "price_std",
            F.coalesce(round_out(ratio("price_std", "avg_price"), 3), F.lit(0.0)).alias("volatility"),
            "province_count", "market_count",
            F.coalesce("n_seeds", F.lit(0)).alias("seed_count"),
            F.coalesce("n_suppliers", F.lit(0)).alias("supplier_count"),
            "record_count", "monthly_trend",
        )
        .orderBy("position", "variety")
    )
