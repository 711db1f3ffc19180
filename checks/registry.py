"""Registered queries: operator key -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlens import schemas
from marketlens.functions import dates, numbers
from marketlens.functions.settle import fresh_path, settle
from marketlens.functions.text import normalize_text, region_head
from marketlens.operators import (
    cleaning, compare, forecast_ml, forecast_stat, listings, pages, periods, pricing, profiles, quality, quantiles, scoring,
    search, sketches, temporal, text_index,
)
from marketlens.plans import batch, warehouse
from marketlens.sources import audit, held_urls, observed, readers, writers
from marketlens.sources import star_views as sv
from marketlens.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def three(fn):
    """Register fn(prices, seeds, suppliers)."""
    def run(spark, sf_dir):
        return fn(sv.prices(spark, sf_dir), sv.seeds(spark, sf_dir), sv.suppliers(spark, sf_dir))
    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return fn


def over(view):
    """Register fn(view rows)."""
    def deco(fn):
        def run(spark, sf_dir):
            return fn(view(spark, sf_dir))
        run.__name__ = fn.__name__
        QUERIES[fn.__name__] = run
        return fn
    return deco


PERIODS = [
    {"label": "1996 first half", "from": "1996-01-01", "to": "1996-06-30"},
    {"label": "1996", "from": "1996-01-01", "to": "1996-12-31"},
    {"label": "since 2000", "from": "2000-01-01"},
    {"label": "empty", "from": "2030-01-01", "to": "2030-12-31"},
]
VARIETIES = ["Brand#3", "Brand#7", "no such variety", "Brand#11", "Brand#1", "Brand#2", "Brand#5", "Brand#8"]
PROVINCES = ["NATION_4", "NATION_1", "nowhere", "NATION_7", "NATION_9", "NATION_2", "NATION_3"]


# --- 2.2 cleaning ---------------------------------------------------------

@over(sv.raw_prices)
def clean_prices(raw):
    return cleaning.clean_prices(raw)


@over(sv.raw_seeds)
def clean_seeds(raw):
    return cleaning.clean_seeds(raw)


@over(sv.raw_suppliers)
def clean_suppliers(raw):
    return cleaning.clean_suppliers(raw)


@over(sv.raw_prices)
def strip_currency(raw):
    price = numbers.to_number(numbers.strip_currency("avg_price"))
    return raw.groupBy("variety").agg(
        F.count(F.lit(1)).alias("quotes"),
        F.count(price).alias("parsed"),
        F.sum(F.floor(price * 100 + 0.5)).alias("cents"),
        F.max(price).alias("highest"),
    )


@over(sv.raw_prices)
def parse_date_multi(raw):
    return raw.groupBy(
        F.coalesce(F.length(F.regexp_extract("date", "[-/]", 0)), F.lit(0)).alias("separators"),
        F.length("date").alias("text_length"),
        dates.parse_date("date").alias("day"),
    ).agg(F.count(F.lit(1)).alias("quotes"))


@over(sv.raw_prices)
def normalize_province_short(raw):
    coded = cleaning.normalize_province_full(
        cleaning.dims.with_lookup(raw, cleaning.dims.CODE_TO_PROVINCE, F.col("province"), "name", True),
        F.col("name"), "full_name",
    )
    return cleaning.normalize_province_short(coded, F.col("full_name"), "short_name").groupBy(
        "full_name", "short_name"
    ).agg(F.count(F.lit(1)).alias("quotes"))


@over(sv.raw_seeds)
def normalize_province_full(raw):
    named = cleaning.normalize_province_full(raw, region_head("supply_region"), "full_name")
    return named.groupBy("full_name").agg(F.count(F.lit(1)).alias("listings"))


@over(sv.raw_seeds)
def province_full_to_short(raw):
    named = cleaning.normalize_province_full(raw, region_head("supply_region"), "full_name")
    return cleaning.province_full_to_short(named, F.col("full_name"), "short_name").groupBy(
        "full_name", "short_name"
    ).agg(F.count(F.lit(1)).alias("listings"))


@over(sv.raw_suppliers)
def region_head_counts(raw):
    return raw.groupBy(region_head("origin").alias("province")).agg(F.count(F.lit(1)).alias("listings"))


QUERIES["region_head"] = QUERIES.pop("region_head_counts")


@over(sv.raw_seeds)
def variety_name_to_code(raw):
    return cleaning.variety_name_to_code(raw, F.col("category"), "code").groupBy("category", "code").agg(
        F.count(F.lit(1)).alias("listings")
    )


@over(sv.raw_prices)
def variety_code_to_name(raw):
    return cleaning.variety_code_to_name(raw, F.col("variety_code"), "name").groupBy("variety_code", "name").agg(
        F.count(F.lit(1)).alias("quotes")
    )


@over(sv.raw_prices)
def exclude_regions(raw):
    return cleaning.exclude_regions(raw).groupBy("province").agg(F.count(F.lit(1)).alias("quotes"))


@over(sv.raw_prices)
def dedup_exact(raw):
    return cleaning.dedup_exact(raw).groupBy("variety").agg(F.count(F.lit(1)).alias("quotes"))


@over(sv.raw_suppliers)
def fill_click_default(raw):
    clicks = numbers.click_count("click_count")
    return raw.groupBy("category").agg(
        F.sum(clicks).alias("clicks"), F.count_if(clicks == 0).alias("without_clicks")
    )


@query
def unify_tables(spark, sf_dir):
    return cleaning.unify_coverage({
        "prices": cleaning.unify_prices(sv.raw_prices(spark, sf_dir)),
        "seeds": cleaning.unify_listings(sv.raw_seeds(spark, sf_dir), "supply_region"),
        "suppliers": cleaning.unify_listings(sv.raw_suppliers(spark, sf_dir), "origin"),
    })


@query
def joinability_report(spark, sf_dir):
    return cleaning.joinability_report(
        cleaning.unify_prices(sv.raw_prices(spark, sf_dir)),
        cleaning.unify_listings(sv.raw_seeds(spark, sf_dir), "supply_region"),
        cleaning.unify_listings(sv.raw_suppliers(spark, sf_dir), "origin"),
    )


@query
def load_quality_counters(spark, sf_dir):
    return cleaning.load_quality_counters(
        cleaning.exclude_regions(cleaning.clean_prices(sv.raw_prices(spark, sf_dir))),
        cleaning.exclude_regions(cleaning.clean_seeds(sv.raw_seeds(spark, sf_dir))),
        cleaning.exclude_regions(cleaning.clean_suppliers(sv.raw_suppliers(spark, sf_dir))),
    )


@over(sv.prices)
def date_range_filter(prices):
    return pricing.date_range(prices, "1997-03-01", "1998-02-28").groupBy("variety").agg(
        F.count(F.lit(1)).alias("quotes"),
        F.min("price_date").alias("first_day"), F.max("price_date").alias("last_day"),
    )


@over(sv.seeds)
def keyword_filter(seeds):
    return search.keyword_filter(seeds, "red|0000[1-3]", "product_name", "company_name").groupBy("product_name").agg(
        F.count(F.lit(1)).alias("listings")
    )


# --- 2.3 aggregates -------------------------------------------------------

@over(sv.prices)
def price_by_province(prices):
    return pricing.price_by_province(prices)


@over(sv.prices)
def price_by_variety(prices):
    return pricing.price_by_variety(prices)


@over(sv.seeds)
def seed_by_province(seeds):
    return listings.by_province(seeds, "seed_count")


@over(sv.suppliers)
def supplier_by_province(suppliers):
    return listings.by_province(suppliers, "supplier_count")


@over(sv.seeds)
def seed_by_category(seeds):
    return listings.by_category(seeds, "seed_count")


@over(sv.suppliers)
def supplier_by_category(suppliers):
    return listings.by_category(suppliers, "supplier_count")


@over(sv.seeds)
def seed_categories_by_province(seeds):
    return listings.categories_in_province(seeds, "NATION_4", "seed_count")


@over(sv.suppliers)
def supplier_categories_by_province(suppliers):
    return listings.categories_in_province(suppliers, "NATION_4", "supplier_count")


@over(sv.prices)
def price_trend(prices):
    return pricing.price_trend(prices)


@over(sv.prices)
def price_trend_filtered(prices):
    return pricing.price_trend(prices, "Brand#3", "1996-01-01", "1999-12-31")


@over(sv.prices)
def price_heatmap_long(prices):
    return pricing.price_heatmap_long(prices)


@over(sv.prices)
def price_heatmap(prices):
    return pricing.price_heatmap(prices)


@over(sv.prices)
def price_heatmap_top_provinces(prices):
    return pricing.price_heatmap(prices, 6, 5)


@over(sv.prices)
def price_volatility(prices):
    return pricing.price_volatility(prices, 15, "1996-01-01", "2000-12-31")


@over(sv.prices)
def market_ranking(prices):
    return pricing.market_ranking(prices, 15, "1996-01-01", "2000-12-31")


@over(sv.suppliers)
def supplier_type_distribution(suppliers):
    return listings.supplier_type_distribution(suppliers)


@over(sv.prices)
def price_scatter(prices):
    return pricing.price_scatter(prices, "Brand#5")


@three
def overview(prices, seeds, suppliers):
    return quality.overview(prices, seeds, suppliers)


@over(sv.prices)
def variety_list(prices):
    return quality.variety_list(prices)


@three
def province_list(prices, seeds, suppliers):
    return quality.province_list(prices, seeds, suppliers)


@three
def key_union(prices, seeds, suppliers):
    return quality.key_union("variety", prices, seeds, suppliers)


@three
def key_intersect(prices, seeds, suppliers):
    return quality.key_intersect("province", prices, seeds, suppliers)


@over(sv.prices)
def data_quality(prices):
    return quality.data_quality(prices)


@three
def data_quality_summary(prices, seeds, suppliers):
    return quality.data_quality_summary(prices, seeds, suppliers)


@over(sv.prices)
def time_period_compare(prices):
    return pricing.time_period_compare(prices, PERIODS)


@query
def period_statistics(spark, sf_dir):
    """Statistics over a period for every order: from its date on, for up to two years."""
    orders = sv.table(spark, sf_dir, "orders").groupBy("o_orderkey").agg(F.min("o_orderdate").cast("date").alias("date_from"))
    asked = orders.select(F.col("o_orderkey").alias("period_no"), "date_from", F.expr("date_add(date_from, cast(o_orderkey % 700 as int) - 5)").alias("date_to"))
    found = periods.period_statistics(sv.prices(spark, sf_dir), asked)
    return found.select("period_no", "record_count", "avg_price", "min_price", "max_price")


@over(sv.prices)
def distinct_sketches(prices):
    """Distinct markets and days per province over two years: exact, and whether the merged monthly sketches agree."""
    out = []
    for column in ("market", "price_date"):
        stored = settle(sketches.monthly_sketches(prices.withColumn("price_date_text", F.col("price_date").cast("string")), column if column == "market" else "price_date_text", "province"), "sketches")
        guess = sketches.estimated_distinct(stored, "province", first="1996-01", last="1997-12")
        exact = sketches.exact_distinct(prices, column, "province", first="1996-01", last="1997-12")
        out.append(sketches.within(guess, exact, "province").withColumn("counted", F.lit(column)))
    return out[0].unionByName(out[1])


@over(sv.prices)
def time_period_varieties(prices):
    return pricing.time_period_varieties(prices, PERIODS)


@over(sv.prices)
def monthly_trend(prices):
    return pricing.monthly_trend(prices)


@over(sv.prices)
def seasonal_analysis(prices):
    return temporal.seasonal_analysis(prices)


@over(sv.prices)
def percentile_bounds(prices):
    b = quantiles.percentile_bounds(prices)
    return b.select("variety", *[numbers.round_out(c, 4).alias(c) for c in b.columns if c != "variety"])


@over(sv.prices)
def iqr_filter(prices):
    return quantiles.iqr_filter(prices).groupBy("variety").agg(
        F.count(F.lit(1)).alias("kept"),
        numbers.round_out(F.min("avg_price"), 4).alias("lowest"),
        numbers.round_out(F.max("avg_price"), 4).alias("highest"),
    )


# --- 2.4 joins and scores -------------------------------------------------

for _fn in (
    profiles.panorama, profiles.variety_province_profile, profiles.cross_table_profile,
    profiles.cross_table_summary_base, profiles.variety_ranking,
    scoring.variety_score, scoring.variety_score_renorm, scoring.supply_demand_items, scoring.supply_chain_health,
    compare.province_radar,
):
    three(_fn)


@three
def cross_table_profile_top(prices, seeds, suppliers):
    return profiles.cross_table_profile(prices, seeds, suppliers, variety="Brand#8", top_n=10)


@three
def cross_table_summary(prices, seeds, suppliers):
    return profiles.cross_table_summary(profiles.cross_table_profile(prices, seeds, suppliers))


@over(sv.seeds)
def normalized_count(seeds):
    n = scoring.normalized_count(seeds, "seed_count")
    return n.withColumn("seed_count_norm", numbers.round_out("seed_count_norm", 6))


@over(sv.prices)
def price_cv_norm(prices):
    n = scoring.price_cv_norm(prices)
    return n.select(
        "variety", numbers.round_out("cv", 6).alias("cv"), numbers.round_out("stability_norm", 6).alias("stability_norm")
    )


@three
def province_panorama(prices, seeds, suppliers):
    return compare.province_panorama(prices, seeds, suppliers, "NATION_4")


@three
def province_compare(prices, seeds, suppliers):
    return compare.province_compare(prices, seeds, suppliers, PROVINCES)


@three
def variety_compare(prices, seeds, suppliers):
    return compare.variety_compare(prices, seeds, suppliers, VARIETIES).drop("monthly_trend")


@three
def variety_compare_series(prices, seeds, suppliers):
    """The nested monthly series of the compared varieties, one row per month."""
    rows = compare.variety_compare(prices, seeds, suppliers, VARIETIES)
    return rows.select("variety", F.explode("monthly_trend").alias("m")).select("variety", "m.month", "m.price")


@three
def supply_demand_correlation(prices, seeds, suppliers):
    return scoring.supply_demand_correlation(scoring.supply_demand_items(prices, seeds, suppliers))


@over(sv.prices)
def price_alerts(prices):
    return temporal.price_alerts(prices)


# --- 2.5 windows ----------------------------------------------------------

@over(sv.suppliers)
def max_over_all(suppliers):
    n = scoring.normalized_count(suppliers, "supplier_count")
    return n.withColumn("supplier_count_norm", numbers.round_out("supplier_count_norm", 6))


@over(sv.prices)
def ema(prices):
    return temporal.ema(prices)


@over(sv.prices)
def ema_slow(prices):
    """Averages whose weights reach far back."""
    each = lambda a: temporal.ema(prices, alpha=a).withColumn("alpha", F.lit(a))
    return each(0.05).unionByName(each(0.01))


@over(sv.prices)
def recent_slope(prices):
    return temporal.recent_slope(prices)


@over(sv.prices)
def recent_avg_30d(prices):
    r = temporal.recent_avg_30d(prices)
    return r.select("variety", numbers.round_out("recent_30d_avg", 4).alias("recent_30d_avg"),
                    numbers.round_out("overall_avg", 4).alias("overall_avg"))


@over(sv.prices)
def seasonal_factor(prices):
    return temporal.seasonal_factor(prices)


@over(sv.prices)
def group_transform(prices):
    g = quantiles.group_transform(prices)
    above = F.col("avg_price") > F.col("q3")
    return g.groupBy("variety", "province").agg(
        F.count(F.lit(1)).alias("quotes"), F.count_if(above).alias("above_q3"),
        F.count_if(F.col("avg_price") < F.col("q1")).alias("below_q1"),
    )


@over(sv.prices)
def topk_then_detail(prices):
    return pricing.top_varieties_by_day(prices)


# --- 2.6 search -----------------------------------------------------------

@over(sv.prices)
def search_prices(prices):
    found = search.find_prices(prices, province="NATION_4", variety="Brand#8")
    order = search.newest_first("price_date", "market", *temporal.ROW_KEYS)
    page = search.page_of(found, order, 2, 20)
    return page.select(
        "variety", "market", "province", "price_date", "total", "page",
        *[numbers.round_out(c, 2).alias(c) for c in ("min_price", "max_price", "avg_price")],
    )


@over(sv.prices)
def search_prices_after(prices):
    """The second page, reached by the keys of the first page's last row."""
    found = search.find_prices(prices, province="NATION_4", variety="Brand#8")
    keys = [("price_date", True), ("market", False), *[(k, False) for k in temporal.ROW_KEYS]]
    first = search.page_after(found, keys, 20).select(*[c for c, _ in keys]).tail(1)
    page = search.page_after(found, keys, 20, first[0].asDict() if first else None)
    return page.select("variety", "market", "province", "price_date", *[numbers.round_out(c, 2).alias(c) for c in ("min_price", "max_price", "avg_price")])


@over(sv.seeds)
def search_seeds(seeds):
    found = search.find_seeds(seeds, keyword="red|blue", province="NATION_4")
    order = search.newest_first("publish_date", "product_name", "company_name", "l_partkey", "l_suppkey")
    return search.page_of(found, order, 3, 50).drop("l_partkey", "l_suppkey")


@query
def search_postings(spark, sf_dir):
    """A keyword search through stored postings, and one that needs the scan."""
    path = fresh_path(spark, "postings")
    text_index.build(sv.seeds(spark, sf_dir), path, "product_name", "company_name", part_rows=5000)
    rows = lambda keyword: text_index.find(spark, path, keyword, "product_name", "company_name").groupBy("product_name").agg(
        F.count(F.lit(1)).alias("listings"), F.max("publish_date").alias("last_day")).withColumn("keyword", F.lit(keyword))
    return rows("Supplier#00003|item 12").unionByName(rows("red|0000[1-3]"))


@over(sv.suppliers)
def search_suppliers(suppliers):
    found = search.find_suppliers(suppliers, keyword="ring|00012", company_type="MACHINERY")
    order = search.newest_first("publish_date", "product_name", "contact_person", "l_orderkey", "l_partkey", "l_suppkey", "click_count")
    return search.page_of(found, order, 1, 100).drop("l_orderkey", "l_partkey", "l_suppkey")


def _second_page(found, keys, page_size):
    first = search.page_after(found, keys, page_size).select(*[c for c, _ in keys]).tail(1)
    return search.page_after(found, keys, page_size, first[0].asDict() if first else None)


@over(sv.seeds)
def search_seeds_after(seeds):
    """The second page of a seed search, reached by keys."""
    found = search.find_seeds(seeds, keyword="red|blue", province="NATION_4")
    keys = [("publish_date", True), *[(k, False) for k in ("product_name", "company_name", "l_partkey", "l_suppkey")]]
    return _second_page(found, keys, 50).drop("l_partkey", "l_suppkey")


@over(sv.suppliers)
def search_suppliers_after(suppliers):
    """The second page of a supplier search, reached by keys."""
    found = search.find_suppliers(suppliers, keyword="ring|00012", company_type="MACHINERY")
    keys = [("publish_date", True), *[(k, False) for k in ("product_name", "contact_person", "l_orderkey", "l_partkey", "l_suppkey", "click_count")]]
    return _second_page(found, keys, 20).drop("l_orderkey", "l_partkey", "l_suppkey")


# --- 2.7 forecasting ------------------------------------------------------

def _stats(spark, sf_dir):
    return forecast_ml.variety_stats(sv.prices(spark, sf_dir), sv.seeds(spark, sf_dir), sv.suppliers(spark, sf_dir))


@query
def variety_stats(spark, sf_dir):
    s = _stats(spark, sf_dir)
    r = lambda c: numbers.round_out(c, 4).alias(c)
    return s.select(
        "variety", r("variety_national_avg"), r("variety_price_std"), r("recent_30d_avg"),
        "variety_price_records", "variety_seed_count", "variety_supplier_count",
    )


def _features(spark, sf_dir):
    kept = quantiles.iqr_filter(sv.prices(spark, sf_dir))
    return forecast_ml.ml_features(kept, _stats(spark, sf_dir))


@query
def ml_features(spark, sf_dir):
    return _features(spark, sf_dir).select(
        *temporal.ROW_KEYS, "variety", "province", "month", "day_of_year", "year", "price_ratio", "price_vs_recent",
        "variety_price_records", "variety_seed_count", "variety_supplier_count",
    )


@over(sv.prices)
def string_index(prices):
    model = forecast_ml.feature_stages()[1].fit(prices)
    return model.transform(prices).groupBy("variety", F.col("variety_idx").cast("int").alias("variety_idx")).agg(
        F.count(F.lit(1)).alias("quotes")
    )


@query
def assemble(spark, sf_dir):
    """Vectors of the forest's own indexers and assembler, read back element by element."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    columns = ["month", "day_of_year", "year", "variety_price_records", "variety_seed_count", "variety_supplier_count"]
    rows = settle(_features(spark, sf_dir).withColumn("recent_level", F.col("recent_30d_avg")), "features")
    vectors = Pipeline(stages=forecast_ml.feature_stages()).fit(rows).transform(rows).select("variety", vector_to_array("features").alias("v"))
    place = {c: forecast_ml.FEATURES.index(c) for c in columns}
    return vectors.groupBy("variety").agg(
        F.count(F.lit(1)).alias("vectors"), *[F.sum(F.col("v")[place[c]]).alias(f"sum_{c}") for c in columns]
    )


@over(sv.prices)
def train_test_split(prices):
    return forecast_ml.train_test_split(prices, *temporal.ROW_KEYS).groupBy("variety", "is_train").agg(
        F.count(F.lit(1)).alias("quotes"), F.min("price_date").alias("first_day")
    )


def _naive(prices, cutoff):
    rows = forecast_ml.with_calendar(temporal.dated(prices)).withColumn("is_train", F.col("price_date") < cutoff)
    return forecast_ml.seasonal_naive(rows)


@over(sv.prices)
def regression_metrics(prices):
    return forecast_ml.regression_metrics(_naive(prices, forecast_ml.time_cutoff(prices)))


@over(sv.prices)
def trailing_level(prices):
    t = forecast_ml.trailing_level(prices)
    return t.withColumn("level", numbers.round_out("level", 4))


@over(sv.prices)
def forecast_statistical(prices):
    return forecast_stat.forecast_statistical(prices)


def _ml_inputs(spark, sf_dir):
    return forecast_ml.narrow_inputs(sv.prices(spark, sf_dir), sv.seeds(spark, sf_dir), sv.suppliers(spark, sf_dir))


def _fitted(spark, sf_dir):
    """Model and training frame."""
    inputs = _ml_inputs(spark, sf_dir)
    return forecast_ml.fitted(*inputs), forecast_ml.training_frame(*inputs)


@query
def rf_train(spark, sf_dir):
    """Test rows per variety, and whether all their predictions lie inside the training range."""
    frame = forecast_ml.training_frame(*_ml_inputs(spark, sf_dir))
    model = forecast_ml.rf_train(frame.where("is_train"))
    edge = lambda f: frame.where("is_train").agg(f("avg_price")).scalar()
    return model.transform(frame.where("NOT is_train")).groupBy("variety").agg(
        F.count(F.lit(1)).alias("test_rows"),
        numbers.round_out(F.avg("avg_price"), 2).alias("mean_price"),
        F.min(F.col("prediction")).alias("low"), F.max(F.col("prediction")).alias("high"),
    ).select("variety", "test_rows", "mean_price", ((F.col("low") >= edge(F.min) - 1e-6) & (F.col("high") <= edge(F.max) + 1e-6)).alias("in_range"))


@query
def model_metrics(spark, sf_dir):
    """Settings and test rows of the fitted forest, and whether its scores and the naive rule's fit together."""
    model, frame = _fitted(spark, sf_dir)
    test = frame.where("NOT is_train")
    scores = forecast_ml.model_metrics(model.transform(test), model)
    naive = forecast_ml.regression_metrics(forecast_ml.seasonal_naive(frame))
    named = settle(scores.unionByName(naive.withColumn("metric", F.concat(F.lit("naive_"), F.col("metric")))), "scores")
    value = lambda name: named.where(F.col("metric") == name).agg(F.max("value")).scalar()
    fits = lambda prefix: (value(f"{prefix}RMSE") >= value(f"{prefix}MAE")) & (value(f"{prefix}MAE") >= 0) & (value(f"{prefix}R2") <= 1)
    checks = spark.range(1).select(
        fits("").cast("double").alias("scores_fit"), fits("naive_").cast("double").alias("naive_scores_fit"),
        test.agg(F.count(F.lit(1))).scalar().cast("double").alias("test_rows"),
    ).unpivot([], ["scores_fit", "naive_scores_fit", "test_rows"], "metric", "value")
    return named.where(F.col("metric").isin("numTrees", "maxDepth", "featureCount")).unionByName(checks)


@query
def feature_importance(spark, sf_dir):
    """All features, with no negative importance, which sum to one."""
    found = settle(forecast_ml.feature_importance(spark, forecast_ml.fitted(*_ml_inputs(spark, sf_dir))), "importances")
    whole = found.agg(F.abs(F.sum("importance") - 1) < 1e-6).scalar()
    return found.select("feature", (F.col("importance") >= 0).alias("not_negative"), whole.alias("sum_is_one"))


@query
def forecast(spark, sf_dir):
    """Forecasts with their current price, and whether price and rank are in order."""
    views = _ml_inputs(spark, sf_dir)
    rows = settle(forecast_ml.forecast(forecast_ml.fitted(*views), *views), "forecasts")
    by_price = Window.partitionBy("horizon").orderBy(F.desc("predicted_price"), "variety")
    level = F.col("current_avg_price")
    return rows.withColumn("place", F.row_number().over(by_price)).select(
        "horizon", "forecast_date", "variety", "current_avg_price",
        F.col("predicted_price").between(level * 0.7 - 0.011, level * 1.3 + 0.011).alias("in_band"), (F.col("place") == F.col("rank")).alias("in_order"))


@query
def forecast_fallbacks(spark, sf_dir):
    """Bounds by the MAE and by the price alone, around forecasts stored without a current price."""
    prices = sv.prices(spark, sf_dir)
    rows = settle(prices.groupBy("variety").agg(numbers.round_out(F.max("avg_price"), 2).alias("predicted_price")), "stored").withColumns(
        {"horizon": F.lit(7), "forecast_date": F.lit("2024-01-08").cast("date")})
    known = spark.createDataFrame([("RMSE", 0.0), ("MAE", 100.0)], "metric string, value double")
    bound = lambda metrics, name: forecast_ml.forecast_postprocess(rows, metrics, prices).withColumn("bound_by", F.lit(name))
    return bound(known, "MAE").unionByName(bound(known.limit(0), "price")).drop("forecast_date")


@query
def forecast_rollup(spark, sf_dir):
    """The roll-up step on the current level as prediction, which the oracle can rebuild."""
    views = sv.prices(spark, sf_dir), sv.seeds(spark, sf_dir), sv.suppliers(spark, sf_dir)
    inputs = forecast_ml.forecast_inputs(*views).withColumn("prediction", F.col("variety_national_avg") * 1.25)
    return forecast_ml.roll_up_forecast(inputs, views[0])


@query
def forecast_postprocess(spark, sf_dir):
    """Bounds around the statistical forecast, with the error of the seasonal-naive model."""
    prices = sv.prices(spark, sf_dir)
    metrics = settle(forecast_ml.regression_metrics(_naive(prices, forecast_ml.time_cutoff(prices))), "metrics")
    rows = forecast_stat.forecast_statistical(prices).withColumnRenamed("prediction_date", "forecast_date")
    return forecast_ml.forecast_postprocess(rows, metrics)


# --- 2.8 pages ------------------------------------------------------------

def _pages(spark, sf_dir):
    return sv.table(spark, sf_dir, "pages")


@over(sv.quote_pages)
def html_table_rows(stored):
    cents = F.floor(numbers.to_number(numbers.strip_currency("avg_price")) * 100 + 0.5)
    return pages.html_table_rows(stored, "2024-01-01").groupBy("variety", "market").agg(
        F.count(F.lit(1)).alias("quotes"), F.sum(cents).alias("cents"),
        F.min("min_price").alias("lowest"), F.max("max_price").alias("highest"),
        F.min("date").alias("first_day"), F.count_if(F.col("date") == "2024-01-01").alias("loaded_today"),
    )


@over(sv.nested_quote_pages)
def html_nested_rows(stored):
    """Quotes of pages whose price table stands in another and whose cells hold tables."""
    cents = F.floor(numbers.to_number(numbers.strip_currency("avg_price")) * 100 + 0.5)
    return pages.html_table_rows(stored, "2024-01-01").groupBy("variety", "market").agg(
        F.count(F.lit(1)).alias("quotes"), F.sum(cents).alias("cents"), F.min("min_price").alias("lowest"),
        F.max("max_price").alias("highest"), F.min("date").alias("first_day"))


@over(sv.seed_pages)
def html_listing_rows(stored):
    return pages.html_listing_rows(stored).drop("page_id", "url", "row_no")


@over(sv.supplier_pages)
def html_supplier_rows(stored):
    return pages.html_supplier_rows(stored).drop("page_id", "url", "row_no")


@over(_pages)
def text_normalize(stored):
    clean = normalize_text("html")
    return stored.select("page_id", F.length(clean).alias("characters"), F.md5(clean).alias("digest"))


@over(_pages)
def link_extract(stored):
    return pages.link_extract(stored).drop("url")


@over(_pages)
def link_slugs(stored):
    return pages.link_slugs(stored, pattern=r"^/([^/]+)$", dropped=("p", "buy", "the", "The"))


@over(sv.pager_pages)
def page_count_detect(stored):
    return pages.page_count_detect(stored).groupBy("page_count").agg(F.count(F.lit(1)).alias("pages"))


@over(sv.pager_pages)
def listing_page_count(stored):
    return pages.listing_page_count(stored).groupBy("page_count").agg(F.count(F.lit(1)).alias("pages"))


@over(sv.pager_pages)
def page_addresses(stored):
    found = pages.page_addresses(pages.page_count_detect(stored))
    return found.groupBy("page_no", "target").agg(F.count(F.lit(1)).alias("pages"))


@over(_pages)
def url_resolve(stored):
    return pages.link_extract(stored).select(
        "page_id", "position", pages.url_resolve("url", "href").alias("at_page"),
        pages.url_resolve("url", "href", at_root=True).alias("at_root"),
    )


@over(_pages)
def link_frontier(stored):
    return pages.link_frontier(stored)


@query
def link_frontier_held(spark, sf_dir):
    """The frontier against the bucketed table of held addresses."""
    path = fresh_path(spark, "held-urls")
    held = held_urls.write_held(_pages(spark, sf_dir), "held_urls_" + path.rsplit("-", 1)[-1], path)
    return held_urls.not_held(pages.link_targets(_pages(spark, sf_dir)), held)


@query
def crawl_coverage(spark, sf_dir):
    """Coverage of the stored pages and of listing pages, whose rows are extracted."""
    listed = sv.seed_pages(spark, sf_dir)
    stored = _pages(spark, sf_dir).select("page_id", "url", "html").unionByName(listed)
    return pages.crawl_coverage(stored, pages.html_listing_rows(stored))


# --- 2.1 sources, sinks, layers; 2.9 streaming ----------------------------

def _clean_layer(spark, sf_dir):
    """The cleaned raw tables: quotes, seeds, suppliers."""
    return (
        cleaning.clean_prices(sv.raw_prices(spark, sf_dir)),
        cleaning.clean_seeds(sv.raw_seeds(spark, sf_dir)),
        cleaning.clean_suppliers(sv.raw_suppliers(spark, sf_dir)),
    )


@query
def src_prices(spark, sf_dir):
    path = writers.write_clean(_clean_layer(spark, sf_dir)[0], fresh_path(spark, "clean-prices"))
    return readers.read_prices(spark, path)


@query
def src_seeds(spark, sf_dir):
    path = writers.write_clean(_clean_layer(spark, sf_dir)[1], fresh_path(spark, "clean-seeds"))
    return readers.read_seeds(spark, path)


@query
def src_suppliers(spark, sf_dir):
    path = writers.write_clean(_clean_layer(spark, sf_dir)[2], fresh_path(spark, "clean-suppliers"))
    return readers.read_suppliers(spark, path)


@query
def src_lenient_csv(spark, sf_dir):
    """Raw quotes landed with overlong lines among them: kept rows and quarantined lines per variety."""
    path = fresh_path(spark, "raw-prices")
    raw = sv.raw_prices(spark, sf_dir)
    writers.append_rows(raw, path)
    writers.append_rows(raw.where("date = '未知'").withColumn("surplus", F.lit("x")), path)
    kept, malformed = readers.read_lenient(spark, path, schemas.RAW_PRICES)
    bad = malformed.groupBy("variety").agg(F.count(F.lit(1)).alias("malformed"))
    return kept.groupBy("variety").agg(F.count(F.lit(1)).alias("kept")).join(bad, "variety", "left")


#: Rows of a landed file that one task reads whole.
LANDED_ROWS = 200_000

#: How raw quotes are landed for a stream, and its cleaning, which leaves the copies to the table.
LAND = {"compression": "gzip", "file_rows": 500_000}
_parse = partial(cleaning.clean_prices, distinct=False)


@query
def src_landed_csv(spark, sf_dir):
    """Raw quotes landed under three headers, with line breaks in fields and lines that are too long: kept rows and the rest."""
    path, raw = fresh_path(spark, "landed-prices"), sv.raw_prices(spark, sf_dir)
    wave = F.pmod(F.substring("market", -1, 1).cast("int"), F.lit(3))
    writers.append_rows(raw.where(wave == 0), path, file_rows=LANDED_ROWS)
    aliases = dict(zip(schemas.RAW_PRICE_HEADER, schemas.RAW_PRICES.names))
    turned = raw.where(wave == 1).select(F.lit("x").alias("note"), *[F.col(c).alias(a) for a, c in reversed(aliases.items())])
    writers.append_rows(turned.withColumn(schemas.RAW_PRICE_HEADER[1], F.concat(F.col(schemas.RAW_PRICE_HEADER[1]), F.lit("\n\"2\", east"))), path, file_rows=LANDED_ROWS)
    line = lambda *more: F.concat_ws(",", *[F.concat(F.lit('"'), c, F.lit('"')) for c in schemas.RAW_PRICES.names], *more)
    third = raw.where(wave == 2)
    lines = third.where("date <> '未知'").select(line().alias("l")).union(third.where("date = '未知'").select(line(F.lit("more")).alias("l")))
    # Every file gets its header: one line in front of its lines. A body is one record, and a file holds one.
    head, files = F.lit("\ufeff" + ",".join(schemas.RAW_PRICES.names)), max(4, -(-third.count() // LANDED_ROWS))
    bodies = lines.groupBy(F.pmod(F.xxhash64("l"), F.lit(files)).alias("file")).agg(F.array_join(F.collect_list("l"), "\n").alias("body"))
    bodies.select(F.concat_ws("\n", head, "body")).write.mode("append").option("maxRecordsPerFile", 1).text(path)
    kept, malformed = readers.read_landed(spark, path, schemas.RAW_PRICES, aliases)
    kind = F.when(F.col("market").contains("\n"), "two lines").otherwise("one line")
    good = kept.groupBy("variety", kind.alias("kind")).agg(F.count(F.lit(1)).alias("rows"), F.max("market").alias("market"), F.max("date").alias("date"))
    fields = F.from_json("record", "array<string>")
    bad = malformed.groupBy(F.get(fields, F.lit(0)).alias("variety"), F.col("reason").alias("kind")).agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.get(fields, F.lit(1))).alias("market"), F.max(F.get(fields, F.lit(5))).alias("date"))
    return good.unionByName(bad)


@query
def observed_load(spark, sf_dir):
    """Rows and nulls of the cleaned tables, counted by the tasks that write them."""
    counts = {}
    for name, df in zip(("prices", "seeds", "suppliers"), _clean_layer(spark, sf_dir)):
        counts[name] = observed.write_observed(df, fresh_path(spark, f"observed-{name}"), observed.null_counts(df, "province", "variety", "price_date" if name == "prices" else "publish_date"))
    return observed.counts_frame(spark, counts)


@query
def src_external_table(spark, sf_dir):
    path = writers.write_clean(_clean_layer(spark, sf_dir)[0], fresh_path(spark, "ods-prices"))
    readers.external_table(spark, path, schemas.CLEAN_PRICES, "ods_prices")
    return spark.sql("""
        SELECT province, count(*) AS quotes, min(price_date) AS first_day, max(avg_price) AS highest
        FROM ods_prices GROUP BY province""")


@query
def src_result_readback(spark, sf_dir):
    """The same report computed (nothing stored yet) and read back once stored."""
    path, prices = fresh_path(spark, "result"), sv.prices(spark, sf_dir)
    report = lambda: readers.result_or_compute(spark, path, lambda: pricing.price_by_province(prices))
    computed = report().withColumn("source", F.lit("computed"))
    writers.write_result(report(), path)
    return computed.unionByName(report().withColumn("source", F.lit("stored")))


@query
def sink_result(spark, sf_dir):
    path = fresh_path(spark, "result-csv")
    report = pricing.price_by_variety(sv.prices(spark, sf_dir))
    writers.write_result(report, path, "csv", single_file=True)
    return readers.read_csv(spark, path, report.schema)


@query
def sink_ctas(spark, sf_dir):
    path = fresh_path(spark, "ctas")
    table = "dwd_prices_" + path.rsplit("-", 1)[-1]
    dwd = warehouse.dwd_prices(_clean_layer(spark, sf_dir)[0])
    stored = writers.create_table_as(dwd, table, path)
    return stored.groupBy("variety", "province").agg(F.count(F.lit(1)).alias("quotes"))


@query
def sink_append(spark, sf_dir):
    """Quotes appended in two runs, read back as one table."""
    path, raw = fresh_path(spark, "append"), sv.raw_prices(spark, sf_dir)
    early = dates.parse_date("date") < F.lit("1998-01-01").cast("date")
    writers.append_rows(raw.where(F.coalesce(early, F.lit(False))), path)
    writers.append_rows(raw.where(~F.coalesce(early, F.lit(False))), path)
    back = readers.read_csv(spark, path, schemas.RAW_PRICES)
    return back.groupBy("variety", "province").agg(F.count(F.lit(1)).alias("quotes"), F.max("market").alias("last_market"))


@query
def sink_clean(spark, sf_dir):
    path = writers.write_clean(_clean_layer(spark, sf_dir)[2], fresh_path(spark, "clean"))
    return readers.read_csv(spark, path, schemas.CLEAN_SUPPLIERS)


@query
def sink_partitioned(spark, sf_dir):
    path = writers.write_partitioned(sv.prices(spark, sf_dir), fresh_path(spark, "by-month"))
    back = readers.read_partitioned(spark, path, "1996-01-01", "1997-12-31")
    return back.groupBy(dates.year_month("price_date").alias("ym")).agg(F.count(F.lit(1)).alias("quotes"), F.max("price_date").alias("last_day"))


@query
def sink_search_csv(spark, sf_dir):
    """An exported seed search, read back line by line."""
    found = search.find_seeds(_clean_layer(spark, sf_dir)[1], keyword="red|blue")
    path = writers.write_search_csv(found, "seeds", fresh_path(spark, "export"))
    return spark.read.text(path).select(F.replace("value", F.lit(writers.BOM), F.lit("")).alias("line"))


@query
def landing_audit(spark, sf_dir):
    landed = {}
    for name, df in zip(("prices", "seeds", "suppliers"), _clean_layer(spark, sf_dir)):
        path = writers.write_clean(df, fresh_path(spark, f"landed-{name}"), **LAND)
        landed[name] = readers.read_csv(spark, path, readers.as_text(df.schema))
    return audit.landing_audit({**landed, "missing": None}).drop("files")


@over(sv.raw_prices)
def clean_price_rejects(raw):
    """Rejected raw quotes per variety and reason."""
    return cleaning.price_rejects(raw).groupBy("variety", "reason").agg(
        F.count(F.lit(1)).alias("rows"), F.max("date").alias("last_date"), F.max("avg_price").alias("last_price"))


@query
def dwd_prices(spark, sf_dir):
    return warehouse.dwd_prices(_clean_layer(spark, sf_dir)[0])


@query
def dwd_seeds(spark, sf_dir):
    return warehouse.dwd_seeds(_clean_layer(spark, sf_dir)[1])


@query
def dwd_suppliers(spark, sf_dir):
    return warehouse.dwd_suppliers(_clean_layer(spark, sf_dir)[2])


#: A value column of each stored report and layer.
BATCH_VALUES = {
    "price_by_province": "avg_price", "price_by_variety": "avg_price", "heatmap": "avg_price", "seed_by_province": "seed_count", "supplier_by_province": "supplier_count",
    "price_trend": "avg_price", "variety_score": "total_score", "cross_table_profile": "price_competitiveness", "forecast_statistical": "predicted_price",
}
LAYER_VALUES = {
    "ods_prices": "avg_price", "ods_seeds": "click_count", "ods_suppliers": "click_count", "dwd_prices": "max_price", "dwd_seeds": "click_count", "dwd_suppliers": "click_count",
    "dws_panorama": "price_record_count", "ads_variety_province_profile": "price_records", "ads_variety_ranking": "price_record_count",
}


def _totals(tables, values):
    """Rows of every table and the sum of its value column."""
    one = lambda name, df: df.agg(F.count(F.lit(1)).alias("cnt"), numbers.round_out(F.sum(values[name]), 4).alias("total")).select(F.lit(name).alias("layer_table"), "cnt", "total")
    return reduce(DataFrame.unionByName, [one(name, df) for name, df in tables.items()])


@query
def layer_counts(spark, sf_dir):
    """Rows and the sum of a value per stored warehouse layer, built on the landed clean tables."""
    landed = [settle(df, "ods") for df in _clean_layer(spark, sf_dir)]
    return _totals(warehouse.build(*landed, fresh_path(spark, "warehouse")), LAYER_VALUES)


@three
def union_all(prices, seeds, suppliers):
    """All three tables as (kind, variety, day) rows, counted per variety."""
    part = lambda df, kind, day: df.select(F.lit(kind).alias("kind"), "variety", F.col(day).alias("day"))
    rows = part(prices, "price", "price_date").unionByName(part(seeds, "seed", "publish_date")).unionByName(
        part(suppliers, "supplier", "publish_date")
    )
    return rows.groupBy("kind", "variety").agg(F.count(F.lit(1)).alias("n"), F.max("day").alias("last_day"))


@over(sv.prices)
def merged_statistics(prices):
    """Per variety statistics merged from (variety, province, month) cells."""
    m = batch.merge_cells(settle(batch.quote_cells(prices), "cells"), "variety")
    return m.select("variety", "n", *[numbers.round_out(c, 4).alias(c) for c in ("mean", "std", "low", "high")])


@query
def batch_reports(spark, sf_dir):
    """All batch reports stored, then their rows and the sum of a value of each."""
    out = fresh_path(spark, "reports")
    paths = batch.run(sv.prices(spark, sf_dir), sv.seeds(spark, sf_dir), sv.suppliers(spark, sf_dir), out)
    return _totals({p.rsplit("/", 1)[-1]: spark.read.parquet(p) for p in paths}, BATCH_VALUES)


@query
def incremental_ingest(spark, sf_dir):
    """Raw quotes landed in two waves with copies, each taken in by its own run, then once more by a new stream."""
    base, raw = fresh_path(spark, "stream"), sv.raw_prices(spark, sf_dir)
    landing, target = f"{base}/landing", f"{base}/table"
    take = lambda checkpoint: ingest.incremental_ingest(
        spark, landing, schemas.RAW_PRICES, target, f"{base}/{checkpoint}", _parse
    )
    early = F.coalesce(dates.parse_date("date") < F.lit("1999-01-01").cast("date"), F.lit(False))
    writers.append_rows(raw.where(early), landing, **LAND)
    take("first")
    writers.append_rows(raw.where(~early | (F.col("variety") == "白菜")), landing, **LAND)
    take("first")
    return take("second")


def _waves(spark, sf_dir, base, take):
    """Land the raw quotes in two waves, the second with copies of some rows of the first; ``take`` runs after each."""
    raw = sv.raw_prices(spark, sf_dir)
    early = F.coalesce(dates.parse_date("date") < F.lit("1999-01-01").cast("date"), F.lit(False))
    writers.append_rows(raw.where(early), f"{base}/landing", **LAND)
    take()
    writers.append_rows(raw.where(~early | (F.col("variety") == "白菜")), f"{base}/landing", **LAND)
    return take()


@query
def report_refresh(spark, sf_dir):
    """Reports folded from the stored cells after two waves of quotes; the second wave adds its own cells only."""
    base = fresh_path(spark, "refresh")
    _waves(spark, sf_dir, base, lambda: ingest.incremental_ingest(
        spark, f"{base}/landing", schemas.RAW_PRICES, f"{base}/table", f"{base}/first", _parse, states=ingest.REPORT_STATES))
    # Means of cents lie on the rounding border at times; a shift takes them off it for both engines.
    cells, days = (ingest.stored_state(spark, f"{base}/table", s).withColumn("mean", F.col("mean") + 1e-6) for s in ("cells", "days"))
    shown = {"variety": "string", "province": "string", "day": "date", "avg_price": "double", "record_count": "bigint", "std": "double", "low": "double", "high": "double", "cv": "double"}
    names = {"price_date": "day", "month": "day", "mean": "avg_price"}

    def rows(name, report):
        have = {names.get(c, c): F.col(c) for c in report.columns}
        return report.select(F.lit(name).alias("report"), *[have.get(c, F.lit(None)).cast(t).alias(c) for c, t in shown.items()])

    return reduce(DataFrame.unionByName, [rows(n, r) for n, r in batch.cell_reports(cells, days).items()])


@query
def compacted_months(spark, sf_dir):
    """Rows and parts per month of quotes taken in as three waves by market, after the months before 1999 were compacted."""
    base, raw = fresh_path(spark, "compact"), sv.raw_prices(spark, sf_dir)
    wave = F.pmod(F.substring("market", -1, 1).cast("int"), F.lit(3))
    for i in range(3):
        writers.append_rows(raw.where(wave == i), f"{base}/landing", **LAND)
        ingest.incremental_ingest(spark, f"{base}/landing", schemas.RAW_PRICES, f"{base}/table", f"{base}/first", _parse, states=ingest.REPORT_STATES)
    after = ingest.compact(spark, f"{base}/table", "1999-01", ingest.REPORT_STATES)
    parts = spark.createDataFrame(sorted(after.parts_of().items()), "ym string, parts long")
    rows = ingest.stored_rows(spark, f"{base}/table").groupBy(dates.year_month("price_date").alias("ym")).agg(
        F.count(F.lit(1)).alias("quotes"), F.max("avg_price").alias("highest"))
    cells = ingest.stored_state(spark, f"{base}/table", "cells").groupBy(dates.year_month("month").alias("ym")).agg(F.sum("n").alias("in_cells"))
    return rows.join(cells, "ym").join(parts, "ym")


@query
def watermarked_ingest(spark, sf_dir):
    """Kept and late quotes per month where a second wave brings copies, new rows and rows behind the watermark."""
    base = fresh_path(spark, "watermark")
    kept, late = _waves(spark, sf_dir, base, lambda: ingest.watermarked_ingest(
        spark, f"{base}/landing", schemas.RAW_PRICES, f"{base}/table", f"{base}/first", cleaning.clean_prices, delay="90 days", parse=_parse))
    count = lambda df, name: df.groupBy(F.lit(name).alias("kind"), dates.year_month("price_date").alias("ym")).agg(
        F.count(F.lit(1)).alias("quotes"), F.countDistinct("variety").alias("varieties"), F.max("avg_price").alias("highest"))
    return count(kept, "kept").unionByName(count(late, "late"))


# --- 2.2 scalar functions, 2.6 value discard ------------------------------

@over(sv.prices)
def scalar_math(prices):
    """Rounding, clipping, sign and null handling on the mean gap between high and low quotes."""
    cells = prices.groupBy("variety", "province").agg(
        F.avg(F.col("max_price") + F.col("min_price") - 2 * F.col("avg_price")).alias("gap"), F.count(F.lit(1)).alias("n")
    )
    gap = F.col("gap")
    return cells.select(
        "variety", "province", numbers.round_out(gap, 3).alias("gap"), numbers.round_out(F.abs(gap), 3).alias("size"),
        F.signum(gap).cast("int").alias("direction"),
        numbers.round_out(F.least(F.lit(50.0), F.greatest(F.lit(-50.0), gap)), 3).alias("clipped"),
        F.coalesce(F.nullif("n", F.lit(100).cast("bigint")), F.lit(0).cast("bigint")).alias("n_or_zero"),
        numbers.round_out(numbers.ratio(gap, F.when(F.col("n") % 2 == 0, F.lit(0.0)).otherwise(F.col("n"))), 6).alias("per_quote"),
    )


@over(sv.prices)
def scalar_date(prices):
    d = F.col("price_date")
    return prices.groupBy("price_date").agg(F.count(F.lit(1)).alias("quotes")).select(
        "price_date", "quotes", F.month(d).alias("month"), F.dayofyear(d).alias("day_of_year"), F.year(d).alias("year"),
        F.date_add(d, 30).alias("ahead"), F.date_sub(d, 60).alias("before"),
        F.datediff(d, F.lit("1995-01-01").cast("date")).alias("day_no"),
        dates.year_month(d).alias("ym"), F.trunc(d, "month").alias("first_day"),
    )


@over(sv.seeds)
def scalar_string(seeds):
    return seeds.groupBy("supply_region", "product_url").agg(F.count(F.lit(1)).alias("listings")).select(
        F.get(F.split("supply_region", " > "), F.lit(1)).alias("second"),
        F.trim(F.substring_index("supply_region", ">", -1)).alias("last"),
        F.replace("supply_region", F.lit(" > "), F.lit("/")).alias("path"),
        F.regexp_replace("product_url", "^https?://", "").alias("bare_url"),
        F.regexp_extract("product_url", r"/sell/(\d+)\.html", 1).alias("offer"),
        "listings",
    )


@over(sv.prices)
def conditional(prices):
    """Quotes per price band, with the bands as a multi-branch condition."""
    p = F.col("avg_price")
    band = F.when(p >= 10000, "A").when(p >= 2000, "B").when(p >= 500, "C").otherwise("D")
    return prices.groupBy("variety", band.alias("band")).agg(F.count(F.lit(1)).alias("quotes"))


@three
def except_values(prices, seeds, suppliers):
    """Distinct provinces less a discarded set of values."""
    discarded = ("NATION_1", "NATION_2")
    return quality.key_union("province", prices, seeds, suppliers).where(~F.col("province").isin(*discarded))
