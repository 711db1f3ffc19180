"""Statistics of quotes over thousands of overlapping date ranges.

Quotes are scanned once, into one cell per key and day. Running sums give
the rows and the total of any range from two days; running minima and maxima
over 1, 2, 4, ... days give its extremes from two overlapping runs. A period is
therefore two lookups by day, however long it is, and no period is ever joined
with quotes or with the days inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import ratio, round_out
from ..functions.settle import settle

#: Prices are summed as decimals, so that a difference of two running sums is exact.
MONEY = "decimal(28,8)"


def _calendar(prices: DataFrame, keys: tuple[str, ...]) -> tuple[DataFrame, object, object]:
    """One row per key and day between the first and the last quoted day, and these days."""
    price = F.col("avg_price").cast(MONEY)
    daily = settle(
        prices.where(F.col("price_date").isNotNull()).groupBy(*keys, "price_date")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(price).alias("total"), F.count(price).alias("priced"), F.min("avg_price").alias("low"), F.max("avg_price").alias("high")),
        "day-cells",
    )
    first, last = daily.agg(F.min("price_date"), F.max("price_date")).first()
    if first is None:
        return daily, None, None
    every_day = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("price_date")
    grid = daily.select(*keys).distinct().select(*keys, every_day) if keys else daily.limit(1).select(every_day)
    return grid.join(daily, [*keys, "price_date"], "left").withColumn("day_no", F.datediff("price_date", F.lit(first))), first, last


def _day_table(calendar: DataFrame, keys: tuple[str, ...], days: int) -> DataFrame:
    """Per key and day the running sums up to it, and the extremes of the 2^k days from it on."""
    upto = W.partitionBy(*keys).orderBy("day_no").rowsBetween(W.unboundedPreceding, W.currentRow)
    order = W.partitionBy(*keys).orderBy("day_no")
    zero = lambda c: F.coalesce(c, F.lit(0))
    table = calendar.select(
        *keys, "day_no", *[F.sum(zero(c)).over(upto).alias(f"{c}_upto") for c in ("n", "total", "priced")],
        *[zero(c).alias(c) for c in ("n", "total", "priced")], F.col("low").alias("low_0"), F.col("high").alias("high_0"),
    )
    level = 0
    while 2 ** (level + 1) <= days:
        ahead = 2**level
        table = table.withColumns({
            f"low_{level + 1}": F.least(f"low_{level}", F.lead(f"low_{level}", ahead).over(order)),
            f"high_{level + 1}": F.greatest(f"high_{level}", F.lead(f"high_{level}", ahead).over(order)),
        })
        level += 1
    runs = lambda c: F.array(*[F.col(f"{c}_{k}") for k in range(level + 1)]).alias(f"{c}s")
    return settle(table.select(*keys, "day_no", *[c for c in table.columns if c.endswith("_upto")], "n", "total", "priced", runs("low"), runs("high")), "day-table")


def period_statistics(prices: DataFrame, periods: DataFrame, *keys: str) -> DataFrame:
    """``period_no, keys, avg_price, min_price, max_price, record_count`` for every row of ``periods(period_no, date_from, date_to)``.

    Both ends are included; a null end is open. A period without quotes has
    zero rows and null prices. With ``keys`` there is a row for every key of the table and every period that
    meets the days between its first and last quote.
    """
    calendar, first, last = _calendar(prices, keys)
    if first is None:
        return periods.select("period_no", *[F.lit(None).cast(prices.schema[k].dataType).alias(k) for k in keys], *[F.lit(None).cast("double").alias(c) for c in ("avg_price", "min_price", "max_price")],
                              F.lit(0).cast("long").alias("record_count")).where(F.lit(not keys))
    days = (last - first).days + 1
    table = _day_table(calendar, keys, days)
    number = lambda c, open_end: F.coalesce(F.datediff(c, F.lit(first)), F.lit(open_end))
    low, high = F.greatest(number("date_from", 0), F.lit(0)), F.least(number("date_to", days - 1), F.lit(days - 1))
    asked = periods.select("period_no", low.alias("low_day"), high.alias("high_day"))
    inside = asked.where("low_day <= high_day").withColumn("k", F.floor(F.log2(F.col("high_day") - F.col("low_day") + 1)).cast("int"))
    # A power of two can come out a hair too small.
    inside = inside.withColumn("k", F.when(F.pow(F.lit(2), F.col("k") + 1) <= F.col("high_day") - F.col("low_day") + 1, F.col("k") + 1).otherwise(F.col("k")))
    inside = inside.withColumn("late_day", F.col("high_day") - F.pow(F.lit(2), F.col("k")).cast("int") + 1)
    at = lambda day, **columns: table.select(*keys, F.col("day_no").alias(day), *[c.alias(n) for n, c in columns.items()])
    spans = (
        inside.join(at("low_day", n0=F.col("n_upto") - F.col("n"), total0=F.col("total_upto") - F.col("total"), priced0=F.col("priced_upto") - F.col("priced"), lows0=F.col("lows"), highs0=F.col("highs")), "low_day")
        .join(at("high_day", n1=F.col("n_upto"), total1=F.col("total_upto"), priced1=F.col("priced_upto")), ["high_day", *keys])
        .join(at("late_day", lows1=F.col("lows"), highs1=F.col("highs")), ["late_day", *keys])
    )
    of: Column = F.col("k")
    found = spans.select(
        "period_no", *keys, round_out(ratio(F.col("total1") - F.col("total0"), F.col("priced1") - F.col("priced0")), 2).alias("avg_price"),
        round_out(F.least(F.get("lows0", of), F.get("lows1", of)), 2).alias("min_price"),
        round_out(F.greatest(F.get("highs0", of), F.get("highs1", of)), 2).alias("max_price"), (F.col("n1") - F.col("n0")).alias("record_count"),
    )
    if keys:
        return found
    return periods.select("period_no").join(found, "period_no", "left").withColumn("record_count", F.coalesce("record_count", F.lit(0)).cast("long"))
