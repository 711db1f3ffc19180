"""Statistical price forecast: one row per variety and horizon, column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio, round_out
from .quantiles import iqr_filter
from .temporal import ROW_KEYS, dated, ema, max_date, recent_slope

WINDOWS = (7, 14, 30, 60)

# Constants of the forecast rule.
DAILY_DRIFT = 0.0025
DEVIATION_FLOOR = 0.05
SLOPE_FLOOR = 0.001
REVERSION_BASE, REVERSION_SPAN = 0.05, 0.15
SPREAD_BASE, SPREAD_SPAN = 0.5, 1.5
SPAN_DAYS = 60.0
CLIP_LOW, CLIP_HIGH, PRICE_FLOOR = 0.5, 1.5, 0.1
NORMAL_95 = 1.96
MARGIN_FLOOR = 0.08


def monthly_levels(rows: DataFrame) -> DataFrame:
    """Per variety: rows, mean, sample deviation and a month -> mean map, from one pass.

    Months are aggregated first and merged by the parallel variance formula,
    so that a hot variety is only ever a dozen rows after the shuffle.
    """
    by_month = dated(rows).groupBy("variety", F.month("price_date").alias("month")).agg(
        F.count("avg_price").alias("n"), F.avg("avg_price").alias("mean"),
        F.sum("avg_price").alias("total"), F.var_pop("avg_price").alias("var"),
    )
    merged = by_month.groupBy("variety").agg(
        F.sum("n").alias("n"),
        ratio(F.sum("total"), F.sum("n")).alias("long_avg"),
        F.collect_list(F.struct("month", "mean", "n", "var")).alias("months"),
    )
    about_mean = F.aggregate(
        "months", F.lit(0.0),
        lambda acc, m: acc + m["n"] * (m["var"] + F.pow(m["mean"] - F.col("long_avg"), 2)),
    )
    return merged.select(
        "variety", "n", "long_avg",
        F.when(F.col("n") > 1, F.sqrt(about_mean / (F.col("n") - 1))).otherwise(F.lit(0.0)).alias("std"),
        F.map_from_entries(
            F.transform("months", lambda m: F.struct(m["month"], round_out(ratio(m["mean"], F.col("long_avg")), 4)))
        ).alias("season"),
    )


def _drift(horizon: Column) -> Column:
    """Price move over the horizon: pull toward the long-run mean, or the slope when that is stronger."""
    level, long_avg, slope = F.col("ema"), F.col("long_avg"), F.col("slope")
    off = (level - long_avg) / long_avg
    heading = F.when(F.abs(off) > DEVIATION_FLOOR, -F.signum(off)).otherwise(
        F.when(F.abs(slope) > SLOPE_FLOOR, F.signum(slope)).otherwise(F.lit(1.0))
    )
    pull, trend = level * DAILY_DRIFT * horizon * heading, slope * horizon
    return F.when((long_avg > 0) & (F.abs(trend) <= F.abs(pull)), pull).otherwise(trend)


def forecast_statistical(prices: DataFrame, windows=WINDOWS, tie_break=ROW_KEYS) -> DataFrame:
    """Forecast with confidence band per variety for every horizon in days.

    Outliers are dropped first. The newest date is that of all quotes.
    """
    kept = iqr_filter(prices)
    newest = max_date(prices)
    levels = monthly_levels(kept)
    # The slope window hangs on the newest date of all quotes, outliers included.
    recent = recent_slope(kept, newest=newest)
    series = (
        levels.join(ema(kept, counts=levels, tie_break=tie_break), "variety")
        .join(recent, "variety", "left")
        .withColumn("slope", F.coalesce("slope", F.lit(0.0)))
        .where("ema > 0")
        .withColumn("horizon", F.explode(F.array(*[F.lit(int(w)) for w in windows])))
        .withColumn("prediction_date", F.date_add(newest, F.col("horizon")))
    )
    days = F.col("horizon").cast("double")
    share = days / SPAN_DAYS
    factor = lambda day: F.coalesce(F.try_element_at("season", F.month(day)), F.lit(1.0))
    now_factor = factor(newest)
    seasonal = F.when(now_factor > 0, ratio(factor(F.col("prediction_date")), now_factor)).otherwise(F.lit(1.0))
    raw = (F.col("ema") + _drift(days)) * seasonal
    away = F.when(F.col("long_avg") > 0, (F.col("raw") - F.col("long_avg")) / F.col("long_avg")).otherwise(F.lit(0.0))
    damped = round_out(F.col("raw") * (F.lit(1.0) - away * (share * REVERSION_SPAN + REVERSION_BASE)), 2)
    low = round_out(F.greatest(F.col("ema") * CLIP_LOW, F.lit(PRICE_FLOOR)), 2)
    high = round_out(F.col("ema") * CLIP_HIGH, 2)
    spread = share * SPREAD_SPAN + SPREAD_BASE
    price, margin = F.col("predicted_price"), F.col("margin")
    return (
        series.withColumn("raw", raw)
        .withColumn("low", low).withColumn("high", high)
        .withColumn("predicted_price", F.greatest("low", F.least("high", damped)))
        .withColumn("margin", round_out(F.greatest(F.col("std") * NORMAL_95 * spread, price * MARGIN_FLOOR * spread), 2))
        .select(
            "horizon", "variety", "predicted_price",
            round_out("ema", 2).alias("current_avg_price"),
            round_out(F.least(price + margin, "high"), 2).alias("confidence_upper"),
            round_out(F.greatest(price - margin, "low"), 2).alias("confidence_lower"),
            round_out((price - F.col("ema")) / F.col("ema") * 100.0, 1).alias("trend_rate"),
            "prediction_date",
        )
        .orderBy("horizon", F.desc("predicted_price"), "variety")
    )
