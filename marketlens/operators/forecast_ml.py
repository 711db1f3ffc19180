"""Price forecast with MLlib.

The training frame is built without looking ahead: per-variety statistics come
from the training range only, and the price level of a row is the mean of the
30 days strictly before it. The split is by date. A hash split and the
level feature that divides the label itself are kept under their own names
for comparison with earlier results; they are not forecast scores.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.numbers import ratio, round_out
from ..functions.settle import settle
from .forecast_stat import WINDOWS
from .model_store import stored_model
from .profiles import PAIR, with_listing_counts
from .quantiles import iqr_filter, percentile_bounds
from .temporal import dated, max_date, recent_avg_30d, seasonal_factor

# Model settings and forecast bounds.
NUM_TREES, MAX_DEPTH, MIN_BINS, MIN_ROWS_PER_NODE, SEED = 50, 10, 64, 20, 42
CLIP_LOW, CLIP_HIGH, PRICE_FLOOR, TOP_N = 0.7, 1.3, 0.1, 30
RMSE_FACTOR, MAE_FACTOR, MARGIN_SHARE, MARGIN_FLOOR = 1.96, 2.5, 0.10, 0.1

LEVEL_DAYS = 30
# Rows of a training partition, until there are as many partitions as this: at each level every partition sends
# the histograms of all nodes, so that their number must not grow with the rows.
PARTITION_ROWS, MAX_PARTITIONS = 25_000, 48
FEATURES = [
    "province_idx", "variety_idx", "month", "day_of_year", "year",
    "variety_national_avg", "variety_price_std", "variety_seed_count", "variety_supplier_count",
    "variety_price_records", "recent_level",
]


def narrow_inputs(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The columns that training and forecasting read, as settled tables.

    Both read the quotes many times (cutoff, statistics, fences, levels, rows);
    behind a settled table each of these is a scan of four columns, whatever
    joins the quotes come from.
    """
    listing = lambda df: df.select("variety", "publish_date")
    return (
        settle(dated(prices).select(*PAIR, "price_date", "avg_price"), "ml-quotes"),
        settle(listing(seeds), "ml-seeds"), settle(listing(suppliers), "ml-suppliers"),
    )


def forest_settings(**forest) -> dict[str, object]:
    """All settings that a fitted forest depends on, for the key of a stored one."""
    own = {"num_trees": NUM_TREES, "max_depth": MAX_DEPTH, "min_bins": MIN_BINS, "min_rows": MIN_ROWS_PER_NODE, "seed": SEED, "partition_rows": PARTITION_ROWS, "max_partitions": MAX_PARTITIONS}
    return {**own, **forest, "features": tuple(FEATURES), "level_days": LEVEL_DAYS}


def fitted(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame, folder: str | None = None, **forest) -> PipelineModel:
    """The forest of these tables: the stored one, else fitted on their training frame and stored.

    The key is a digest of ``narrow_inputs`` tables, from which the frame follows.
    """
    return stored_model(
        prices.sparkSession, {"quotes": prices, "seeds": seeds, "suppliers": suppliers},
        lambda: rf_train(training_frame(prices, seeds, suppliers).where("is_train"), **forest), forest_settings(**forest), folder,
    )


def variety_stats(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Per variety: mean, deviation, rows, listing counts and the recent 30-day mean."""
    groups = prices.groupBy("variety").agg(
        F.avg("avg_price").alias("variety_national_avg"),
        F.stddev_samp("avg_price").alias("variety_price_std"),
        F.count(F.lit(1)).alias("variety_price_records"),
    )
    counted = with_listing_counts(
        groups, seeds, suppliers, ["variety"], "variety_seed_count", "variety_supplier_count"
    )
    return counted.join(recent_avg_30d(prices).select("variety", "recent_30d_avg"), "variety", "left")


def with_calendar(df: DataFrame, day: str = "price_date") -> DataFrame:
    return df.withColumns({
        "month": F.month(day).cast("int"), "day_of_year": F.dayofyear(day).cast("int"), "year": F.year(day).cast("int"),
    })


def ml_features(prices: DataFrame, stats: DataFrame) -> DataFrame:
    """Calendar and per-variety columns with the two label ratios of the earlier model.

    ``price_vs_recent`` divides the label and so leaks it; it is not a feature
    of the forecast below.
    """
    settled = settle(stats, "variety-stats")
    return with_calendar(dated(prices)).join(settled, "variety").withColumns({
        "price_ratio": round_out(ratio("avg_price", "variety_national_avg"), 3),
        "price_vs_recent": round_out(ratio("avg_price", "recent_30d_avg"), 3),
    })


def trailing_level(prices: DataFrame, days: int = LEVEL_DAYS) -> DataFrame:
    """(variety, price_date, level): mean quote of the days strictly before each quoted day.

    The range window runs on daily sums, one row per variety and day.
    """
    daily = dated(prices).groupBy("variety", "price_date").agg(
        F.sum("avg_price").alias("total"), F.count("avg_price").alias("n")
    )
    before = W.partitionBy("variety").orderBy("day_no").rangeBetween(-days, -1)
    return daily.withColumn("day_no", F.unix_date("price_date").cast("long")).select(
        "variety", "price_date", ratio(F.sum("total").over(before), F.sum("n").over(before)).alias("level")
    )


def split_bucket(*keys: str, buckets: int = 10) -> Column:
    """A bucket that depends only on the row's key values, not on partitioning."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets


def train_test_split(df: DataFrame, *keys: str, train_tenths: int = 8) -> DataFrame:
    """Mark rows ``is_train`` by key hash, about ``train_tenths`` tenths of them."""
    return df.withColumn("is_train", split_bucket(*keys) < train_tenths)


def time_cutoff(prices: DataFrame, train_share: float = 0.8) -> Column:
    """The date below which ``train_share`` of the quotes lie, as a scalar subquery.

    Ranked on daily counts: one row per day, not per quote.
    """
    daily = prices.where(F.col("price_date").isNotNull()).groupBy("price_date").agg(F.count(F.lit(1)).alias("n"))
    total = daily.agg(F.sum("n")).scalar()
    upto = W.partitionBy().orderBy("price_date").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        daily.withColumn("upto", F.sum("n").over(upto))
        .where(F.col("upto") > total * train_share)
        .agg(F.min("price_date")).scalar()
    )


def training_frame(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame, train_share: float = 0.8) -> DataFrame:
    """Feature rows with ``is_train``; no column of a row depends on later quotes.

    A variety first quoted after the cutoff keeps its test rows: it gets the
    mean and deviation of all training quotes and zero counts.

    The rows are settled: training passes over them many times, and a lost
    executor then costs a read instead of the windows and joins behind them.
    """
    cutoff = time_cutoff(prices, train_share)
    past = prices.where(F.col("price_date") < cutoff)
    groups = past.groupBy("variety").agg(
        F.avg("avg_price").alias("variety_national_avg"),
        F.stddev_samp("avg_price").alias("variety_price_std"),
        F.count(F.lit(1)).alias("variety_price_records"),
    )
    counted = with_listing_counts(
        groups, seeds.where(F.col("publish_date") < cutoff), suppliers.where(F.col("publish_date") < cutoff),
        ["variety"], "variety_seed_count", "variety_supplier_count",
    )
    stats = settle(counted.join(percentile_bounds(past), "variety").drop("q1", "q3"), "training-stats")
    level = settle(trailing_level(prices), "levels")
    rows = with_calendar(dated(prices).select(*PAIR, "price_date", "avg_price"))
    # Outliers are dropped from training only: the test rows stay whole.
    usable = (F.col("price_date") >= cutoff) | F.col("avg_price").between(F.col("lower_fence"), F.col("upper_fence"))
    overall = lambda f: past.agg(f("avg_price")).scalar()
    frame = (
        rows.join(stats, "variety", "left")
        .where(usable)
        .withColumns({
            "variety_price_std": F.when(F.col("variety_national_avg").isNull(), overall(F.stddev_samp)).otherwise(F.coalesce("variety_price_std", F.lit(0.0))),
            "variety_national_avg": F.coalesce("variety_national_avg", overall(F.avg)),
            **{c: F.coalesce(c, F.lit(0)) for c in ("variety_price_records", "variety_seed_count", "variety_supplier_count")},
        })
        .join(level, ["variety", "price_date"])
        .withColumn("recent_level", F.coalesce("level", "variety_national_avg"))
        .withColumn("is_train", F.col("price_date") < cutoff)
        .drop("level", "lower_fence", "upper_fence")
    )
    return settle(frame, "training-frame")


def feature_stages() -> list:
    return [
        StringIndexer(inputCol="province", outputCol="province_idx", handleInvalid="keep"),
        StringIndexer(inputCol="variety", outputCol="variety_idx", handleInvalid="keep"),
        VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="skip"),
    ]


def in_fixed_order(rows: DataFrame, partition_rows: int = PARTITION_ROWS, max_partitions: int = MAX_PARTITIONS) -> DataFrame:
    """Rows dealt and sorted by their own values, into partitions counted from the rows, ``max_partitions`` at most.

    Trees draw their samples per partition, so the forest must not depend on
    how the rows happen to lie.
    """
    partitions = min(max_partitions, max(1, -(-rows.count() // partition_rows)))
    return rows.repartition(partitions, F.xxhash64(*rows.columns)).sortWithinPartitions(*rows.columns)


def feature_cells(train: DataFrame, label: str = "avg_price") -> DataFrame:
    """One row for all rows of the same features: their mean ``label`` and their number as ``weight``.

    All features follow from variety, province and day, so that the cells grow with the calendar and not with the
    markets that quote. A split is judged by sums of labels and numbers of rows on both sides; the spread within a cell
    is on one side as a whole and adds the same to every split. Means are of exact sums, hence independent of the order
    of the rows. A cell with a label that is missing has none.
    """
    total = F.sum(F.col(label).cast("decimal(38,12)")).cast("double")
    n = F.count(F.lit(1))
    keys = [c for c in ("province", "variety", *FEATURES) if c in train.columns]
    return train.groupBy(*keys).agg(
        F.when(F.count(label) == n, total / n).alias(label), n.cast("double").alias("weight"))


def rf_train(train: DataFrame, num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH, min_bins: int = MIN_BINS,
             min_rows: int = MIN_ROWS_PER_NODE, seed: int = SEED, partition_rows: int = PARTITION_ROWS,
             max_partitions: int = MAX_PARTITIONS) -> PipelineModel:
    """Fit indexers, assembler and random forest, as one pipeline. The indexers don't depend on the order of rows.

    Trees pass over the rows once a level, so they are fitted on ``feature_cells`` weighted by their rows: no row is left
    out, a node's ``min_rows`` are rows, and a tree draws whole cells. There are as many bins as the widest category
    needs. The histogram memory lets each pass grow many tree nodes.
    """
    cells = settle(feature_cells(train), "cells")
    widest, total = cells.agg(F.greatest(F.countDistinct("variety"), F.countDistinct("province")), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    max_bins = max(min_bins, (widest or 0) + 1)
    features = Pipeline(stages=feature_stages()).fit(train)
    # Weights are whole numbers of rows: at least ``min_rows`` is more than half a row less. Fewer than twice as many are not split.
    splits = total >= 2 * min_rows
    forest = RandomForestRegressor(
        featuresCol="features", labelCol="avg_price", weightCol="weight", numTrees=num_trees, maxDepth=max_depth, maxBins=max_bins,
        minInstancesPerNode=1 if splits else max(1, min_rows), minWeightFractionPerNode=max(0.0, min_rows - 0.5) / total if splits and total else 0.0,
        seed=seed, maxMemoryInMB=1024,
    )
    trees = forest.fit(features.transform(in_fixed_order(cells, partition_rows, max_partitions)))
    return PipelineModel([*features.stages, trees])


def regression_metrics(scored: DataFrame, label: str = "avg_price", prediction: str = "prediction") -> DataFrame:
    """RMSE, R2 and MAE as (metric, value) rows, from one aggregate."""
    err = F.col(label) - F.col(prediction)
    sums = scored.agg(
        F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"), F.var_pop(label).alias("var")
    ).select(
        round_out(F.sqrt("mse"), 4).alias("RMSE"),
        round_out(F.lit(1.0) - ratio("mse", "var"), 4).alias("R2"),
        round_out("mae", 4).alias("MAE"),
    )
    return sums.unpivot([], ["RMSE", "R2", "MAE"], "metric", "value")


def seasonal_naive(rows: DataFrame) -> DataFrame:
    """Score test rows by the training mean of their variety and month: the bar a model has to clear.

    Where training has no such month, the mean of all training rows stands in.
    """
    train = rows.where("is_train")
    means = train.groupBy("variety", "month").agg(F.avg("avg_price").alias("prediction"))
    scored = rows.where("NOT is_train").join(settle(means, "naive"), ["variety", "month"], "left")
    return scored.withColumn("prediction", F.coalesce("prediction", train.agg(F.avg("avg_price")).scalar()))


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, importance), at most one row per feature."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(FEATURES, weights)]
    return spark.createDataFrame(rows, "feature string, importance double")


def model_metrics(scored: DataFrame, model: PipelineModel) -> DataFrame:
    """Scores and settings of a fitted model as (metric, value) rows."""
    forest = model.stages[-1]
    settings = {
        "numTrees": float(forest.getNumTrees), "maxDepth": float(forest.getMaxDepth()), "featureCount": float(len(FEATURES)),
    }
    extra = scored.sparkSession.createDataFrame(list(settings.items()), "metric string, value double")
    return regression_metrics(scored).unionByName(extra)


def forecast_inputs(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame, windows=WINDOWS) -> DataFrame:
    """One row per (variety, province) and horizon, dated in the future, weighted by its quotes.

    All horizons are one exploded frame. The level of a future row is the mean
    of the last 30 days; statistics are of all quotes known today.
    """
    newest = max_date(prices)
    kept = iqr_filter(prices)
    weights = kept.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("weight"))
    stats = variety_stats(prices, seeds, suppliers).withColumn("recent_level", F.col("recent_30d_avg")).withColumn(
        "variety_price_std", F.coalesce("variety_price_std", F.lit(0.0)))
    dated_rows = (
        weights.join(stats, "variety")
        .withColumn("horizon", F.explode(F.array(*[F.lit(int(w)) for w in windows])))
        .withColumn("forecast_date", F.date_add(newest, F.col("horizon")))
    )
    return with_calendar(dated_rows, "forecast_date")


def seasonal_shift(scored: DataFrame, prices: DataFrame) -> DataFrame:
    """Add ``seasonal_ratio``: factor of the forecast month over that of the current month, 1 when unknown."""
    factors = seasonal_factor(prices)
    ahead = factors.withColumnRenamed("seasonal_factor", "ahead")
    today = factors.where(F.col("month") == F.month(max_date(prices))).select(
        "variety", F.col("seasonal_factor").alias("today")
    )
    return (
        scored.withColumn("month", F.month("forecast_date").cast("int"))
        .join(ahead, ["variety", "month"], "left").join(today, "variety", "left")
        .withColumn(
            "seasonal_ratio",
            F.coalesce(round_out(ratio(F.coalesce("ahead", F.lit(1.0)), F.coalesce("today", F.lit(1.0))), 4), F.lit(1.0)),
        )
        .drop("ahead", "today", "month")
    )


def roll_up_forecast(scored: DataFrame, prices: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """Province predictions to one clipped price per variety and horizon, best ``top_n`` per horizon."""
    weighted = (
        scored.where("prediction > 0")
        .groupBy("horizon", "forecast_date", "variety", "recent_30d_avg")
        .agg(round_out(ratio(F.sum(F.col("prediction") * F.col("weight")), F.sum("weight")), 2).alias("base"))
    )
    level = F.col("recent_30d_avg")
    high = round_out(level * CLIP_HIGH, 2)
    low = round_out(F.greatest(level * CLIP_LOW, F.lit(PRICE_FLOOR)), 2)
    moved = round_out(F.col("base") * F.col("seasonal_ratio"), 2)
    order = W.partitionBy("horizon").orderBy(F.desc("predicted_price"), "variety")
    return (
        seasonal_shift(weighted, prices)
        .withColumn("predicted_price", F.greatest(low, F.least(high, moved)))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top_n)
        .select(
            "horizon", "forecast_date", "rank", "variety", "predicted_price",
            round_out(level, 2).alias("current_avg_price"),
        )
    )


def forecast(model: PipelineModel, prices: DataFrame, seeds: DataFrame, suppliers: DataFrame,
             windows=WINDOWS, top_n: int = TOP_N) -> DataFrame:
    """Score every (variety, province) at each horizon and roll up per variety."""
    inputs = forecast_inputs(prices, seeds, suppliers, windows)
    return roll_up_forecast(model.transform(inputs), prices, top_n)


def forecast_postprocess(forecasts: DataFrame, metrics: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """Clip to 30 % around the current mean and add confidence bounds from the model error.

    The margin is 1.96 RMSE, else 2.5 MAE, else a tenth of the price. Results
    by province are averaged per variety first. Where a stored result has no
    current mean, or no such column, the variety's mean in ``prices`` stands in.
    """
    if "current_avg_price" not in forecasts.columns:
        forecasts = forecasts.withColumn("current_avg_price", F.lit(None).cast("double"))
    if prices is not None:
        means = prices.groupBy("variety").agg(round_out(F.avg("avg_price"), 2).alias("own_mean"))
        forecasts = forecasts.join(means, "variety", "left").withColumn("current_avg_price", F.coalesce("current_avg_price", "own_mean")).drop("own_mean")
    keys = ["horizon", "forecast_date", "variety", "current_avg_price"]
    rows = forecasts
    if "province" in forecasts.columns:
        rows = forecasts.groupBy(*keys).agg(F.avg("predicted_price").alias("predicted_price"))
    error = lambda name: F.coalesce(
        metrics.where(F.col("metric") == name).agg(F.max("value")).scalar(), F.lit(0.0)
    )
    cur, has_cur = F.col("current_avg_price"), F.col("current_avg_price") > 0
    clipped = F.when(
        has_cur, F.greatest(round_out(cur * CLIP_LOW, 2), F.least(round_out(cur * CLIP_HIGH, 2), F.col("predicted_price")))
    ).otherwise(F.col("predicted_price"))
    price, margin = F.col("predicted_price"), F.col("margin")
    top = F.when(has_cur, cur * CLIP_HIGH).otherwise(price + margin)
    bottom = F.when(has_cur, cur * CLIP_LOW).otherwise(F.greatest(F.lit(0.0), price - margin))
    return (
        rows.withColumn("predicted_price", clipped)
        .withColumn(
            "margin",
            F.when(error("RMSE") > 0, error("RMSE") * RMSE_FACTOR)
            .when(error("MAE") > 0, error("MAE") * MAE_FACTOR)
            .otherwise(F.greatest(price * MARGIN_SHARE, F.lit(MARGIN_FLOOR))),
        )
        .select(
            *keys, "predicted_price",
            round_out(F.least(price + margin, top), 2).alias("confidence_upper"),
            round_out(F.greatest(price - margin, bottom), 2).alias("confidence_lower"),
        )
    )
