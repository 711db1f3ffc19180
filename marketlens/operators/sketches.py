"""Distinct counts of any date range from stored monthly sketches.

One small sketch per month and key is made when the quotes are stored. The
distinct values of a range of months are estimated from the union of their
sketches; the quotes are not read again. ``exact_distinct`` is the exact form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import year_month

#: Logarithm of the sketch's cells: the standard error is about 1.04 / sqrt(2^12) = 1.6 percent.
LOG_CELLS = 12


def monthly_sketches(prices: DataFrame, column: str, *keys: str, log_cells: int = LOG_CELLS) -> DataFrame:
    """``keys, ym, sketch``: a distinct-count sketch of ``column`` per key and month. Nulls count as no value."""
    return prices.where(F.col("price_date").isNotNull()).groupBy(*keys, year_month("price_date").alias("ym")).agg(
        F.hll_sketch_agg(F.col(column), F.lit(log_cells)).alias("sketch"))


def _months(df: DataFrame, first: str | None, last: str | None) -> DataFrame:
    df = df if first is None else df.where(F.col("ym") >= first)
    return df if last is None else df.where(F.col("ym") <= last)


def estimated_distinct(sketches: DataFrame, *keys: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """``keys, n_distinct`` over the months from ``first`` to ``last`` (yyyy-MM), from sketches alone."""
    return _months(sketches, first, last).groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


def exact_distinct(prices: DataFrame, column: str, *keys: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The same count from the quotes."""
    rows = prices.where(F.col("price_date").isNotNull()).withColumn("ym", year_month("price_date"))
    return _months(rows, first, last).groupBy(*keys).agg(F.countDistinct(column).alias("n_distinct"))


def within(estimated: DataFrame, exact: DataFrame, *keys: str, error: float = 0.08) -> DataFrame:
    """``keys, n_distinct, in_bound``: the exact count, and whether the estimate lies within ``error`` (five standard errors) of it."""
    guess = estimated.withColumnRenamed("n_distinct", "guess")
    return exact.join(guess, list(keys)).select(*keys, "n_distinct", (F.abs(F.col("guess") - F.col("n_distinct")) <= F.greatest(F.lit(1.0), F.col("n_distinct") * error)).alias("in_bound"))
