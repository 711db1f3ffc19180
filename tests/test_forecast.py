import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlens.operators import forecast_ml as ml
from marketlens.operators import forecast_stat as fs
from marketlens.sources import star_views as sv


@pytest.fixture(scope="module")
def views(spark, sf_dir):
    return sv.prices(spark, sf_dir), sv.seeds(spark, sf_dir), sv.suppliers(spark, sf_dir)


@pytest.fixture(scope="module")
def fitted(views):
    frame = ml.training_frame(*views).persist()
    model = ml.rf_train(frame.where("is_train"), num_trees=5, max_depth=5)
    yield model, frame
    frame.unpersist()


def test_split_does_not_depend_on_partitioning(views):
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    a = ml.train_test_split(views[0], *keys).where("is_train").agg(F.sum("l_orderkey"), F.count("*")).first()
    b = ml.train_test_split(views[0].repartition(3), *keys).where("is_train").agg(F.sum("l_orderkey"), F.count("*")).first()
    assert a == b and 0.7 < a[1] / views[0].count() < 0.9


def test_level_uses_only_earlier_days(quotes, rows_by):
    d = lambda i: str(dt.date(2024, 1, 1) + dt.timedelta(days=i))
    df = quotes([("a", "p", "m", 1, d(0)), ("a", "p", "m", 3, d(0)), ("a", "p", "m", 10, d(1)), ("a", "p", "m", 7, d(31)), ("a", "p", "m", 7, d(90))])
    got = rows_by(ml.trailing_level(df).withColumn("d", F.col("price_date").cast("string")), "d")
    assert [got[d(i)].level for i in (0, 1, 31, 90)] == [None, 2.0, 10.0, None]


def test_features_of_a_row_ignore_later_quotes(views, spark):
    prices, seeds, suppliers = views
    cutoff = prices.select(ml.time_cutoff(prices).alias("c")).first().c
    frame = ml.training_frame(prices, seeds, suppliers)
    # Later quotes ten times dearer leave every training row as it was.
    dearer = prices.withColumn(
        "avg_price", F.when(F.col("price_date") >= F.lit(cutoff), F.col("avg_price") * 10).otherwise(F.col("avg_price"))
    )
    other = ml.training_frame(dearer, seeds, suppliers)
    key = [F.sum(F.round(c, 3)).alias(c) for c in ("recent_level", "variety_national_avg", "avg_price", "variety_price_std")]
    assert frame.where("is_train").agg(F.count("*"), *key).first() == other.where("is_train").agg(F.count("*"), *key).first()
    assert frame.where("NOT is_train").count() == prices.where(F.col("price_date") >= F.lit(cutoff)).count()


def test_forecast_stays_in_band(fitted, views):
    model, _ = fitted
    rows = ml.forecast(model, *views).collect()
    assert {r.horizon for r in rows} == {7, 14, 30, 60}
    per = {}
    for r in rows:
        per.setdefault(r.horizon, []).append(r.rank)
        assert 0.7 * r.current_avg_price - 0.02 <= r.predicted_price <= 1.3 * r.current_avg_price + 0.02
    assert all(sorted(v) == list(range(1, len(v) + 1)) and len(v) <= 30 for v in per.values())


def test_metrics_are_finite_and_compared_with_naive(fitted):
    model, frame = fitted
    test = frame.where("NOT is_train")
    got = {r.metric: r.value for r in ml.model_metrics(model.transform(test), model).collect()}
    assert got["numTrees"] == 5 and got["featureCount"] == len(ml.FEATURES)
    naive = {r.metric: r.value for r in ml.regression_metrics(ml.seasonal_naive(frame)).collect()}
    assert 0 < got["MAE"] <= got["RMSE"] and 0 < naive["MAE"] <= naive["RMSE"]


def test_forest_does_not_depend_on_how_rows_lie(fitted):
    train = fitted[1].where("is_train")
    test = fitted[1].where("NOT is_train")
    means = [
        ml.rf_train(train.repartition(n), num_trees=3, max_depth=4, partition_rows=1500).transform(test).agg(F.avg("prediction")).first()[0]
        for n in (4, 8)
    ]
    assert means[0] == means[1]


def test_many_and_new_varieties(quotes, offers):
    d = lambda i: str(dt.date(2024, 1, 1) + dt.timedelta(days=i))
    rows = [(f"v{i % 100}", "p", "m", 5 + i % 7, d(i // 20)) for i in range(2000)]
    rows += [(f"new{i}", "p", "m", 4, d(99)) for i in range(6)]
    frame = ml.training_frame(quotes(rows), offers([("v1", "p")]), offers([]))
    test = frame.where("NOT is_train")
    model = ml.rf_train(frame.where("is_train"), num_trees=2, max_depth=3)
    scored = model.transform(test).where("variety like 'new%'")
    assert scored.count() == 6 and scored.where("prediction > 0").count() == 6
    assert ml.seasonal_naive(frame).count() == test.count()


def test_importances_sum_to_one(spark, fitted):
    rows = ml.feature_importance(spark, fitted[0]).collect()
    assert [r.feature for r in rows] == ml.FEATURES and abs(sum(r.importance for r in rows) - 1) < 1e-6


@pytest.mark.parametrize("metrics,margin", [
    ([("RMSE", 2.0), ("MAE", 1.0)], 3.92), ([("RMSE", 0.0), ("MAE", 1.0)], 2.5), ([], 10.0),
])
def test_postprocess_margins(spark, metrics, margin):
    rows = spark.createDataFrame([(7, "a", 100.0, 100.0), (7, "b", 100.0, 200.0), (7, "c", 0.0, 5.0)],
                                 "horizon int, variety string, current_avg_price double, predicted_price double").withColumn("forecast_date", F.lit("d"))
    m = spark.createDataFrame(metrics, "metric string, value double")
    got = {r.variety: r for r in ml.forecast_postprocess(rows, m).collect()}
    assert got["a"].confidence_upper == round(100 + margin, 2) and got["a"].confidence_lower == round(100 - margin, 2)
    assert got["b"].predicted_price == 130.0 and got["b"].confidence_upper == 130.0
    assert got["c"].predicted_price == 5.0 and got["c"].confidence_lower >= 0


def test_postprocess_takes_the_mean_where_no_current_price_is_stored(spark, quotes):
    prices = quotes([("a", "p", "m", 10, "2024-01-01"), ("a", "p", "m", 20, "2024-01-01")])
    rows = spark.createDataFrame([(7, "d", "a", 90.0), (7, "d", "b", 90.0)], "horizon int, forecast_date string, variety string, predicted_price double")
    got = {r.variety: r for r in ml.forecast_postprocess(rows, spark.createDataFrame([], "metric string, value double"), prices).collect()}
    assert (got["a"].current_avg_price, got["a"].predicted_price) == (15.0, 19.5) and got["b"].predicted_price == 90.0


def test_postprocess_averages_provinces(spark):
    rows = spark.createDataFrame([(7, "d", "a", "p", 10.0, 9.0), (7, "d", "a", "q", 10.0, 11.0)],
                                 "horizon int, forecast_date string, variety string, province string, current_avg_price double, predicted_price double")
    got = ml.forecast_postprocess(rows, spark.createDataFrame([], "metric string, value double")).collect()
    assert len(got) == 1 and got[0].predicted_price == 10.0


@pytest.mark.parametrize("step,heading", [(0.0, 1), (0.5, 1)])
def test_statistical_forecast_bounds(quotes, step, heading):
    d = lambda i: str(dt.date(2024, 1, 1) + dt.timedelta(days=i))
    df = quotes([("a", "p", "m", 10 + step * i, d(i)) for i in range(40)])
    rows = fs.forecast_statistical(df).collect()
    assert [r.horizon for r in rows] == [7, 14, 30, 60]
    for r in rows:
        assert 0.5 * r.current_avg_price - 0.01 <= r.confidence_lower <= r.predicted_price <= r.confidence_upper <= 1.5 * r.current_avg_price + 0.01
        assert r.prediction_date == dt.date(2024, 2, 9) + dt.timedelta(days=r.horizon)


def test_batch_stores_the_forest_reports(spark, views, tmp_path):
    from marketlens.plans import batch

    paths = batch.run(*views, str(tmp_path), with_forest=True, num_trees=3, max_depth=4)
    stored = {p.rsplit("/", 1)[-1]: spark.read.parquet(p) for p in paths}
    assert {"cross_table_profile", "price_prediction", "model_metrics", "feature_importance"} <= set(stored)
    rows = stored["price_prediction"].collect()
    assert rows and all(r.confidence_lower <= r.predicted_price <= r.confidence_upper for r in rows)
    assert {"RMSE", "naive_RMSE", "numTrees"} <= {r.metric for r in stored["model_metrics"].collect()}


def test_training_partitions_do_not_grow_with_the_rows(spark):
    rows = spark.range(500).select("id", (F.col("id") % 7).alias("x"))
    assert ml.in_fixed_order(rows, partition_rows=100).rdd.getNumPartitions() == 5
    assert ml.in_fixed_order(rows, partition_rows=1).rdd.getNumPartitions() == ml.MAX_PARTITIONS
    assert ml.in_fixed_order(rows, partition_rows=1).count() == 500


def test_trees_pass_over_cells_that_hold_all_rows(fitted, monkeypatch):
    train = fitted[1].where("is_train")
    many = train.withColumn("copy", F.explode(F.array(*map(F.lit, range(4))))).withColumn("avg_price", F.col("avg_price") + F.col("copy") - 1.5).drop("copy")
    dealt = []
    deal = ml.in_fixed_order
    monkeypatch.setattr(ml, "in_fixed_order", lambda rows, *a: dealt.append(rows) or deal(rows, *a))
    one, four = (ml.rf_train(t, num_trees=3, max_depth=4, min_rows=n) for t, n in ((train, 5), (many, 20)))
    few, some = (d.agg(F.count("*"), F.sum("weight"), F.sum(F.col("avg_price") * F.col("weight"))).first() for d in dealt)
    # Four quotes of one mean weigh four times one of that price, whatever their spread: the same trees.
    rows, total = train.agg(F.count("*"), F.sum("avg_price")).first()
    assert (few[0], few[1], some[0], some[1]) == (few[0], rows, few[0], 4 * rows) and abs(some[2] - 4 * total) < 1e-6 * total
    test = fitted[1].where("NOT is_train")
    mean = [m.transform(test).agg(F.avg("prediction")).first()[0] for m in (one, four)]
    assert abs(mean[0] - mean[1]) < 1e-6 * mean[0]


def test_few_rows_make_no_split(quotes, offers):
    d = lambda i: str(dt.date(2024, 1, 1) + dt.timedelta(days=i))
    frame = ml.training_frame(quotes([("a", "pq"[i % 2], "m", 5 + i, d(i)) for i in range(30)]), offers([]), offers([]))
    model = ml.rf_train(frame.where("is_train"), num_trees=2, max_depth=3, min_rows=20)
    assert [t.numNodes for t in model.stages[-1].trees] == [1, 1]
