"""Seasonality, alerts, recent windows, slopes and exponential averages."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.numbers import ratio, round_out

EMA_ALPHA = 0.3
# Weights below this share of the whole cannot change a double.
EMA_LEAST_WEIGHT = 1e-20
# Up to so many newest rows are cut out of the table; a mean that reaches
# farther back is built from all rows with their ranks.
EMA_DEPTH = 1024
ROW_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def dated(prices: DataFrame) -> DataFrame:
    return prices.where(F.col("price_date").isNotNull() & F.col("variety").isNotNull())


def max_date(prices: DataFrame) -> Column:
    """Newest quote date, as a scalar subquery evaluated before the main plan."""
    return prices.agg(F.max("price_date")).scalar()


def seasonal_analysis(prices: DataFrame, top_n: int = 8) -> DataFrame:
    """Twelve months for each of the varieties with most quotes; missing months stay NULL.

    One fact pass yields (variety, month) sums; ranking, yearly mean and the
    month grid are built from one row per variety made of those.
    """
    by_month = dated(prices).groupBy("variety", F.month("price_date").alias("month")).agg(
        F.sum("avg_price").alias("total"), F.count("avg_price").alias("priced"),
        F.avg("avg_price").alias("mean"), F.count(F.lit(1)).alias("n"),
    )
    top = (
        by_month.groupBy("variety")
        .agg(F.sum("n").alias("n_all"), ratio(F.sum("total"), F.sum("priced")).alias("yearly"),
             F.map_from_entries(F.collect_list(F.struct("month", "mean"))).alias("means"))
        .orderBy(F.desc("n_all"), "variety").limit(top_n)
    )
    grid = top.select("variety", "yearly", "means", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    month_price = round_out("mean", 2)
    return (
        grid.withColumn("mean", F.try_element_at("means", F.col("month")))
        .select(
            "variety", "month",
            month_price.alias("monthly_price"),
            F.when(F.col("yearly") > 0, round_out(ratio(month_price, "yearly"), 3)).alias("seasonal_index"),
            round_out("yearly", 2).alias("yearly_avg"),
        )
        .orderBy("variety", "month")
    )


def price_alerts(prices: DataFrame, yellow: float = 20.0, red: float = 30.0) -> DataFrame:
    """Varieties whose mean of the last 30 days moved against the 30 days before.

    Only the last 60 days are read past the date filter; both means come from
    one conditional aggregate.
    """
    rows, newest = dated(prices), max_date(prices)
    recent_from, previous_from = F.date_sub(newest, 30), F.date_sub(newest, 60)
    recent = F.col("price_date") >= recent_from
    means = rows.where(F.col("price_date") >= previous_from).groupBy("variety").agg(
        F.avg(F.when(recent, F.col("avg_price"))).alias("cur"),
        F.avg(F.when(~recent, F.col("avg_price"))).alias("prev"),
    )
    change = round_out((F.col("cur") - F.col("prev")) / F.col("prev") * 100.0, 1)
    size = F.abs("change_rate")
    return (
        means.where("cur IS NOT NULL AND prev > 0")
        .withColumn("change_rate", change)
        .select(
            "variety", round_out("cur", 2).alias("current_avg"), round_out("prev", 2).alias("previous_avg"),
            "change_rate", F.when(size > red, "red").when(size > yellow, "yellow").alias("level"),
        )
        .where(F.col("level").isNotNull())
        .orderBy(F.desc(size), "variety")
    )


def recent_avg_30d(prices: DataFrame) -> DataFrame:
    """Mean since 30 days before the newest quote, else the overall mean; and the overall mean."""
    recent = F.when(F.col("price_date") >= F.date_sub(max_date(prices), 30), F.col("avg_price"))
    return prices.where(F.col("variety").isNotNull()).groupBy("variety").agg(
        F.avg("avg_price").alias("overall"), F.avg(recent).alias("recent")
    ).select(
        "variety",
        F.coalesce(round_out("recent", 4), F.col("overall")).alias("recent_30d_avg"),
        F.col("overall").alias("overall_avg"),
    )


def seasonal_factor(prices: DataFrame) -> DataFrame:
    """Month mean over overall mean per variety."""
    by_month = dated(prices).groupBy("variety", F.month("price_date").alias("month")).agg(
        F.sum("avg_price").alias("total"), F.count("avg_price").alias("priced"), F.avg("avg_price").alias("mean")
    )
    of_variety = W.partitionBy("variety")
    overall = ratio(F.sum("total").over(of_variety), F.sum("priced").over(of_variety))
    return by_month.withColumn("overall", overall).select(
        "variety", "month", round_out(ratio("mean", "overall"), 4).alias("seasonal_factor")
    )


def recent_slope(prices: DataFrame, days: int = 60, min_rows: int = 5, newest: Column | None = None) -> DataFrame:
    """Least-squares slope of price on day number over the last days; zero when undefined."""
    start = F.date_sub(max_date(prices) if newest is None else newest, days)
    day_no = F.datediff("price_date", start).cast("double")
    fitted = dated(prices).where(F.col("price_date") >= start).select("variety", "avg_price", day_no.alias("x")).groupBy(
        "variety"
    ).agg(
        F.regr_slope("avg_price", "x").alias("slope"), F.var_pop("x").alias("spread"), F.count(F.lit(1)).alias("n")
    )
    return fitted.select(
        "variety",
        round_out(
            F.when((F.col("n") >= min_rows) & (F.col("spread") > 0), F.col("slope")).otherwise(F.lit(0.0)), 6
        ).alias("slope"),
    )


def newest_rows(prices: DataFrame, depth: int, tie_break, spread: int = 64) -> DataFrame:
    """The ``depth`` newest rows of every variety with their rank (1 = newest).

    Two rounds keep a hot variety out of a single task: rows are first cut to
    ``depth`` within ``spread`` slices that follow the input partitions, where
    the group limit prunes before the shuffle, then the survivors (at most
    depth * spread per variety) are ranked.
    """
    order = [F.desc("price_date"), *[F.desc(k) for k in tie_break]]
    sliced = prices.withColumn("slice", F.spark_partition_id() % spread)
    first = W.partitionBy("variety", "slice").orderBy(*order)
    kept = sliced.withColumn("k", F.row_number().over(first)).where(F.col("k") <= depth).drop("k", "slice")
    return kept.withColumn("k", F.row_number().over(W.partitionBy("variety").orderBy(*order))).where(
        F.col("k") <= depth
    )


def ranked_rows(prices: DataFrame, tie_break) -> DataFrame:
    """All rows with their rank in the variety (1 = newest).

    A day's rows are ranked among themselves, after the rows of all later
    days, whose counts are one row per variety and day.
    """
    daily = prices.groupBy("variety", "price_date").agg(F.count(F.lit(1)).alias("on_day"))
    later = W.partitionBy("variety").orderBy(F.desc("price_date")).rowsBetween(W.unboundedPreceding, -1)
    offsets = daily.select("variety", "price_date", F.coalesce(F.sum("on_day").over(later), F.lit(0)).alias("later"))
    inside = W.partitionBy("variety", "price_date").orderBy(*[F.desc(k) for k in tie_break])
    ranked = prices.withColumn("in_day", F.row_number().over(inside)).join(offsets, ["variety", "price_date"])
    return ranked.withColumn("k", F.col("later") + F.col("in_day")).drop("later", "in_day")


def ema(prices: DataFrame, counts: DataFrame | None = None, alpha: float = EMA_ALPHA, tie_break=ROW_KEYS) -> DataFrame:
    """Last value of the recursive mean y1 = x1, yn = a*xn + (1-a)*y(n-1), oldest to newest.

    Closed form: row k from the newest weighs a*(1-a)^(k-1), and the very first
    row of the series (1-a)^(k-1). Rows are left out only where their weight is
    below double precision. ``counts`` (variety, n) may be passed in when the
    caller has it already.
    """
    if not 0 < alpha <= 1:
        raise ValueError("alpha lies above 0 and up to 1")
    rows = dated(prices).where(F.col("avg_price").isNotNull())
    if counts is None:
        counts = rows.groupBy("variety").agg(F.count(F.lit(1)).alias("n"))
    depth = 1 if alpha == 1 else math.ceil(math.log(EMA_LEAST_WEIGHT) / math.log1p(-alpha))
    needed = rows.select("variety", "price_date", "avg_price", *tie_break)
    top = newest_rows(needed, depth, tie_break) if depth <= EMA_DEPTH else ranked_rows(needed, tie_break)
    fade = F.pow(F.lit(1.0 - alpha), F.col("k") - 1)
    weight = F.when(F.col("k") == F.col("n"), fade).otherwise(fade * alpha)
    return (
        top.join(counts.select("variety", "n"), "variety")
        .groupBy("variety")
        .agg(round_out(F.sum(F.col("avg_price") * weight), 4).alias("ema"))
    )
