"""Single-table price aggregates and top-k reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import dims
from ..functions.dates import between_dates, year_month
from ..functions.numbers import ratio, round_out


def date_range(df: DataFrame, date_from: str | None = None, date_to: str | None = None,
               column: str = "price_date") -> DataFrame:
    """Rows whose date lies in the inclusive range; either end may be open."""
    return df.where(between_dates(column, date_from, date_to)) if date_from or date_to else df


def _mean_and_rows(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        round_out(F.avg("avg_price"), 2).alias("avg_price"),
        F.count(F.lit(1)).alias("record_count"),
    )


def price_by_province(prices: DataFrame) -> DataFrame:
    return _mean_and_rows(prices, "province").orderBy(F.desc("avg_price"), "province")


def price_by_variety(prices: DataFrame, top_n: int = 20) -> DataFrame:
    return _mean_and_rows(prices, "variety").orderBy(F.desc("avg_price"), "variety").limit(top_n)


def price_trend(prices: DataFrame, variety: str | None = None,
                date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Mean quote per day, optionally of one variety and a date range."""
    rows = prices.where(F.col("price_date").isNotNull())
    if variety:
        rows = rows.where(dims.is_variety(F.col("variety"), variety))
    return _mean_and_rows(date_range(rows, date_from, date_to), "price_date").orderBy("price_date")


def price_heatmap_long(prices: DataFrame) -> DataFrame:
    cells = (
        prices.where(F.col("price_date").isNotNull())
        .groupBy("province", "variety")
        .agg(round_out(F.avg("avg_price"), 2).alias("avg_price"))
    )
    return cells.where(F.col("avg_price").isNotNull()).orderBy(F.desc("avg_price"), "province", "variety")


def price_heatmap(prices: DataFrame, top_vegs: int = 12, top_provs: int | None = None) -> DataFrame:
    """Mean quote per (top variety, top province) with zero-based axis positions.

    Facts are scanned once, into (variety, province) groups; both axes are ranked
    by windows over those.
    """
    groups = prices.groupBy("variety", "province").agg(
        F.count(F.lit(1)).alias("n"), F.avg("avg_price").alias("mean")
    )
    valid = dims.UNKNOWN_PROVINCES + dims.EXCLUDED_REGIONS
    known = F.coalesce(~F.col("province").isin(*valid), F.lit(False))
    totals = groups.withColumn("known", known).withColumns({
        "of_variety": F.sum("n").over(W.partitionBy("variety")),
        "of_province": F.sum(F.when(F.col("known"), F.col("n"))).over(W.partitionBy("province")),
    })
    # Ranks over one row per (variety, province); rows that have no place on an axis come last on it.
    by_variety = W.partitionBy().orderBy(F.col("variety").isNull(), F.desc("of_variety"), "variety")
    by_province = W.partitionBy().orderBy(~F.col("known"), F.desc("of_province"), "province")
    placed = totals.withColumns({"i": F.dense_rank().over(by_variety) - 1, "j": F.dense_rank().over(by_province) - 1})
    inside = F.col("known") & F.col("variety").isNotNull()
    for index, top in (("i", top_vegs), ("j", top_provs)):
        inside = inside & (F.col(index) < top) if top else inside

    return (
        placed.where(inside)
        .select("variety", "province", "i", "j", round_out("mean", 2).alias("avg_price"))
        .where(F.col("avg_price").isNotNull())
        .orderBy("i", "j")
    )


def top_varieties_by_day(prices: DataFrame, top_n: int = 3) -> DataFrame:
    """Daily rows and mean quote of the varieties with most quotes, ranked and shown from one daily aggregate."""
    daily = prices.groupBy("variety", "price_date").agg(F.count(F.lit(1)).alias("quotes"), round_out(F.avg("avg_price"), 2).alias("avg_price"))
    top = daily.groupBy("variety").agg(F.sum("quotes").alias("n")).orderBy(F.desc("n"), "variety").limit(top_n)
    return daily.join(top.select("variety"), "variety", "left_semi")


def price_volatility(prices: DataFrame, top_n: int = 15,
                     date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Varieties by coefficient of variation (sample deviation over mean)."""
    stats = (
        date_range(prices, date_from, date_to)
        .groupBy("variety")
        .agg(F.avg("avg_price").alias("mean"), F.stddev_samp("avg_price").alias("std"))
        .where("mean > 0")
    )
    return (
        stats.select(
            "variety",
            round_out(ratio("std", "mean"), 3).alias("volatility"),
            round_out("mean", 2).alias("avg_price"),
        )
        .orderBy(F.desc_nulls_last("volatility"), "variety")
        .limit(top_n)
    )


def market_ranking(prices: DataFrame, top_n: int = 15,
                   date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    return (
        _mean_and_rows(date_range(prices, date_from, date_to), "market")
        .orderBy(F.desc("record_count"), "market")
        .limit(top_n)
    )


def price_scatter(prices: DataFrame, variety: str, size: int = 100) -> DataFrame:
    """The newest ``size`` low/high pairs of a variety, in a total order."""
    return (
        prices.where(dims.is_variety(F.col("variety"), variety))
        .where(F.col("min_price").isNotNull() & F.col("max_price").isNotNull())
        .orderBy(F.desc("price_date"), "market", "min_price", "max_price")
        .limit(size)
        .select("market", round_out("min_price", 2).alias("low"), round_out("max_price", 2).alias("high"))
    )


def monthly_trend(prices: DataFrame, varieties: list[str] | None = None, months: int = 12) -> DataFrame:
    """Mean quote of the last ``months`` year-months that have quotes, per variety."""
    rows = prices.where(F.col("price_date").isNotNull())
    if varieties:
        wanted = [form for v in varieties for form in dims.variety_forms(v)]
        rows = rows.where(F.col("variety").isin(*wanted))
    # Truncating to the month keeps the key a date inside the aggregate.
    by_month = (
        rows.groupBy("variety", F.trunc("price_date", "month").alias("first_day"))
        .agg(round_out(F.avg("avg_price"), 2).alias("price"))
    )
    newest = W.partitionBy("variety").orderBy(F.desc("first_day"))
    return (
        by_month.withColumn("rank", F.row_number().over(newest))
        .where(F.col("rank") <= months)
        .select("variety", year_month("first_day").alias("month"), "price")
    )


def period_matches(prices: DataFrame, periods: list[dict], variety: str | None = None) -> DataFrame:
    """Quotes tagged with every requested period they fall in.

    The periods are a handful of literals: matching is an array filter on the
    row, so no join is needed and rows outside all periods go before the shuffle.
    """
    rows = prices.where(F.col("price_date").isNotNull())
    if variety:
        rows = rows.where(dims.is_variety(F.col("variety"), variety))
    hits = F.array(*[
        F.when(between_dates("price_date", p.get("from"), p.get("to")), F.lit(i)) for i, p in enumerate(periods)
    ])
    return rows.select("variety", "avg_price", F.explode(F.array_compact(hits)).alias("period_no"))


def time_period_compare(prices: DataFrame, periods: list[dict], variety: str | None = None) -> DataFrame:
    """Mean, extremes and rows per labelled period; zeros for an empty one."""
    found = period_matches(prices, periods, variety).groupBy("period_no").agg(
        F.avg("avg_price").alias("mean"), F.min("avg_price").alias("low"),
        F.max("avg_price").alias("high"), F.count(F.lit(1)).alias("n"),
    )
    asked = dims.literal_frame(
        prices.sparkSession, [(str(i), p.get("label", "")) for i, p in enumerate(periods)], "no", "label"
    ).select(F.col("no").cast("int").alias("period_no"), "label")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return (
        asked.join(found, "period_no", "left")
        .select(
            "period_no", "label",
            zero(round_out("mean", 2)).alias("avg_price"),
            zero(round_out("low", 2)).alias("min_price"),
            zero(round_out("high", 2)).alias("max_price"),
            F.coalesce("n", F.lit(0)).alias("record_count"),
        )
        .orderBy("period_no")
    )


def time_period_varieties(prices: DataFrame, periods: list[dict], variety: str | None = None,
                          top_n: int = 10) -> DataFrame:
    """Per period, the varieties with the highest mean quote."""
    means = period_matches(prices, periods, variety).groupBy("period_no", "variety").agg(
        round_out(F.avg("avg_price"), 2).alias("price")
    )
    order = W.partitionBy("period_no").orderBy(F.desc("price"), "variety")
    label = F.element_at(F.array(*[F.lit(p.get("label", "")) for p in periods]), F.col("period_no") + 1)
    return (
        means.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top_n)
        .select("period_no", label.alias("label"), "rank", "variety", "price")
    )
