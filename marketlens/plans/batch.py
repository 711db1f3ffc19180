"""The whole analysis as one job over stored detail tables.

Most reports need only counts, sums and squared deviations per (variety,
province, month). Those are aggregated once, settled, and merged upward, so
the quotes are scanned once for all of them instead of once per report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio, round_out
from ..functions.settle import settle
from ..operators import forecast_ml, forecast_stat, listings, pricing, profiles, scoring
from ..sources.writers import write_result

CELL = ["variety", "province", "month"]
STATISTICS = ["n", "mean", "var", "low", "high"]


def cells_by(prices: DataFrame, *keys: str) -> DataFrame:
    """Mergeable statistics of the quotes per key: rows, mean, variance and bounds."""
    return prices.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg("avg_price").alias("mean"), F.var_pop("avg_price").alias("var"),
        F.min("min_price").alias("low"), F.max("max_price").alias("high"),
    )


def quote_cells(prices: DataFrame) -> DataFrame:
    """Mergeable statistics per variety, province and month."""
    return cells_by(prices.withColumn("month", F.trunc("price_date", "month")), *CELL)


def fold_cells(cells: DataFrame, *keys: str) -> DataFrame:
    """Cells of a coarser key, or one cell per key from several, in the same columns.

    Deviations are merged around the means of the cells (parallel variance
    formula), not from raw squares.
    """
    weighted = F.col("n") * F.col("mean")
    centre = ratio(F.sum(weighted), F.sum("n"))
    means = cells.groupBy(*keys).agg(centre.alias("centre"))
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
    about = F.col("n") * (F.col("var") + F.pow(F.col("mean") - F.col("centre"), 2))
    return (
        cells.alias("c").join(means.alias("m"), reduce(Column.__and__, same)).groupBy(*[F.col(f"c.{k}").alias(k) for k in keys])
        .agg(
            F.sum("n").alias("n"), F.first("centre").alias("mean"), ratio(F.sum(about), F.sum("n")).alias("var"),
            F.min("low").alias("low"), F.max("high").alias("high"),
        )
    )


def merge_cells(cells: DataFrame, *keys: str) -> DataFrame:
    """Statistics per coarser key: rows, mean, sample deviation and bounds."""
    sample = F.when(F.col("n") > 1, F.sqrt(F.col("var") * F.col("n") / (F.col("n") - 1)))
    return fold_cells(cells, *keys).withColumn("std", sample).drop("var")


def cell_reports(cells: DataFrame, days: DataFrame | None = None) -> dict[str, DataFrame]:
    """The reports that need no quotes, from cells per variety, province and month and, for the trend, cells per day."""
    level = lambda *keys: merge_cells(cells, *keys).select(
        *keys, round_out("mean", 2).alias("avg_price"), F.col("n").alias("record_count")
    )
    spread = merge_cells(cells, "variety").where("n >= 10")
    trend = {} if days is None else {
        "price_trend": merge_cells(days, "price_date").select("price_date", round_out("mean", 2).alias("avg_price")).orderBy("price_date")}
    return {
        "price_by_province": level("province").orderBy(F.desc("avg_price"), "province"),
        "price_by_variety": level("variety").orderBy(F.desc("avg_price"), "variety").limit(20),
        "heatmap": level("province", "variety").drop("record_count").orderBy(F.desc("avg_price"), "province", "variety"),
        **trend,
        "monthly_levels": merge_cells(cells, "variety", "month").select(
            "variety", "month", F.col("n").alias("record_count"), *[round_out(c, 2).alias(c) for c in ("mean", "std", "low", "high")]),
        "price_spread": spread.select("variety", *[round_out(c, 2).alias(c) for c in ("mean", "std", "low", "high")], round_out(ratio("std", "mean") * 100, 2).alias("cv")),
    }


def reports(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame) -> dict[str, DataFrame]:
    """Every batch report as a lazy plan; those on quotes alone come from the settled cells."""
    cells = settle(quote_cells(prices), "quote-cells")
    levels = cell_reports(cells)
    return {
        **{name: levels[name] for name in ("price_by_province", "price_by_variety", "heatmap")},
        "seed_by_province": listings.by_province(seeds, "seed_count"),
        "supplier_by_province": listings.by_province(suppliers, "supplier_count"),
        "price_trend": pricing.price_trend(prices),
        "variety_score": scoring.variety_score(prices, seeds, suppliers),
        "cross_table_profile": profiles.cross_table_profile(prices, seeds, suppliers),
        "forecast_statistical": forecast_stat.forecast_statistical(prices),
    }


def forest_reports(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame, **forest) -> dict[str, DataFrame]:
    """Train the forest, or read the stored one, and report its forecast with bounds, its scores and its importances.

    The scores of the seasonal-naive rule on the same rows stand beside the model's.
    """
    prices, seeds, suppliers = forecast_ml.narrow_inputs(prices, seeds, suppliers)
    frame = forecast_ml.training_frame(prices, seeds, suppliers)
    model = forecast_ml.fitted(prices, seeds, suppliers, **forest)
    scores = settle(forecast_ml.model_metrics(model.transform(frame.where("NOT is_train")), model), "model-metrics")
    naive = forecast_ml.regression_metrics(forecast_ml.seasonal_naive(frame))
    predicted = forecast_ml.forecast(model, prices, seeds, suppliers)
    return {
        "price_prediction": forecast_ml.forecast_postprocess(predicted, scores),
        "model_metrics": scores.unionByName(naive.withColumn("metric", F.concat(F.lit("naive_"), "metric"))),
        "feature_importance": forecast_ml.feature_importance(prices.sparkSession, model),
    }


def run(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame, out: str, fmt: str = "parquet",
        with_forest: bool = False, **forest) -> list[str]:
    """Compute and store every report below ``out``, the forest's too when asked for."""
    plans = reports(prices, seeds, suppliers)
    if with_forest:
        plans.update(forest_reports(prices, seeds, suppliers, **forest))
    return [write_result(df, f"{out}/{name}", fmt) for name, df in plans.items()]
