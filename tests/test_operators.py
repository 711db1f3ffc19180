import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.functions.settle import settle
from marketlens.operators import compare, listings, pricing, profiles, quality, quantiles, scoring, search, temporal
from marketlens.plans import batch, warehouse


def day(i, start=dt.date(2024, 1, 1)):
    return str(start + dt.timedelta(days=i))


def test_tie_in_top_n_breaks_on_key(quotes):
    df = quotes([("b", "p", "m", 2, day(0)), ("a", "p", "m", 2, day(0)), ("c", "p", "m", 1, day(0))])
    assert [r.variety for r in pricing.price_by_variety(df, 2).collect()] == ["a", "b"]


def test_volatility_of_one_row_and_zero_mean(quotes, rows_by):
    df = quotes([("one", "p", "m", 2, day(0)), ("zero", "p", "m", -1, day(0)), ("zero", "p", "m", 1, day(1)),
                 ("two", "p", "m", 1, day(0)), ("two", "p", "m", 3, day(0))])
    got = rows_by(pricing.price_volatility(df), "variety")
    assert set(got) == {"one", "two"} and got["one"].volatility is None
    assert got["two"].volatility == round(math.sqrt(2) / 2, 3)


def test_heatmap_axes_cover_all_provinces(quotes):
    df = quotes([("a", "p1", "m", 1, day(0)), ("a", "p1", "m", 3, day(0)), ("a", "p2", "m", 5, day(0)),
                 ("b", "p2", "m", 7, day(0)), ("a", "未知", "m", 9, day(0)), ("c", "p1", "m", 9, day(0))])
    got = {(r.i, r.j): r.avg_price for r in pricing.price_heatmap(df, top_vegs=2).collect()}
    # p1 has three quotes, p2 two; the unknown province is no axis.
    assert got == {(0, 0): 2.0, (0, 1): 5.0, (1, 1): 7.0}


def test_periods_overlap_and_empty(quotes, rows_by):
    df = quotes([("a", "p", "m", 1, "2024-01-01"), ("a", "p", "m", 3, "2024-06-30"), ("b", "p", "m", 8, "2024-07-01")])
    periods = [{"label": "h1", "from": "2024-01-01", "to": "2024-06-30"}, {"label": "all"}, {"label": "none", "from": "2030-01-01"}]
    got = rows_by(pricing.time_period_compare(df, periods), "label")
    assert (got["h1"].avg_price, got["h1"].record_count) == (2.0, 2)
    assert (got["all"].max_price, got["all"].record_count) == (8.0, 3)
    assert (got["none"].avg_price, got["none"].record_count) == (0.0, 0)
    only_b = rows_by(pricing.time_period_compare(df, periods, "b"), "label")
    assert only_b["h1"].record_count == 0 and only_b["all"].avg_price == 8.0


def test_seasonal_gap_and_mean_index(quotes):
    df = quotes([("a", "p", "m", 10 + m, f"2023-{m:02d}-10") for m in range(1, 12)])
    got = temporal.seasonal_analysis(df).collect()
    assert len(got) == 12 and got[11].monthly_price is None and got[11].seasonal_index is None
    assert abs(np.mean([r.seasonal_index for r in got[:11]]) - 1) < 0.01


@pytest.mark.parametrize("prev,cur,level", [(100, 131, "red"), (100, 121, "yellow"), (100, 120, None), (100, 69, "red"), (0, 5, None)])
def test_alert_levels(quotes, prev, cur, level):
    rows = [("a", "p", "m", cur, day(60)), ("a", "p", "m", cur, day(30)), ("a", "p", "m", prev, day(29)), ("a", "p", "m", prev, day(0))]
    got = temporal.price_alerts(quotes(rows)).collect()
    assert [r.level for r in got] == ([level] if level else [])


def test_slope_guards(quotes, rows_by):
    rows = [("up", "p", "m", 2 * i, day(i)) for i in range(10)]
    rows += [("few", "p", "m", i, day(i)) for i in range(4)] + [("flat", "p", "m", i, day(9)) for i in range(6)]
    got = rows_by(temporal.recent_slope(quotes(rows)), "variety")
    assert got["up"].slope == 2.0 and got["few"].slope == 0.0 and got["flat"].slope == 0.0


@pytest.mark.parametrize("n", [1, 2, 127, 128, 129, 700])
def test_ema_is_the_recursion(quotes, n):
    rng = random.Random(n)
    values = [rng.uniform(1, 9) for _ in range(n)]
    want = values[0]
    for x in values[1:]:
        want = 0.3 * x + 0.7 * want
    got = temporal.ema(quotes([("a", "p", "m", x, day(i)) for i, x in enumerate(values)]).repartition(5)).first().ema
    assert abs(got - want) < 1e-4


@pytest.mark.parametrize("alpha", [0.05, 0.01, 1.0])
def test_ema_reaches_as_far_as_its_weights(quotes, alpha):
    rng = random.Random(5)
    values = [rng.uniform(100, 200) for _ in range(1500)]
    want = values[0]
    for x in values[1:]:
        want = alpha * x + (1 - alpha) * want
    got = temporal.ema(quotes([("a", "p", "m", x, day(i // 3)) for i, x in enumerate(values)]).repartition(5), alpha=alpha).first().ema
    assert abs(got - want) < 1e-4


@pytest.mark.parametrize("seed", range(6))
def test_percentiles_are_exact(quotes, rows_by, seed):
    rng = np.random.default_rng(seed)
    groups = {
        "hot": rng.choice([1.25, 1.5, 1.75, 9.0], 900), "wide": np.exp(rng.normal(0, 6, 300)),
        "signed": rng.normal(0, 5, 201), "one": np.array([3.5]), "two": np.array([-1.0, 4.0]), "same": np.zeros(50),
        "near": 1000 + rng.random(400) * 1e-7,
    }
    df = quotes([(g, "p", "m", float(x), day(0)) for g, xs in groups.items() for x in xs] + [("hot", "p", "m", None, day(0)), (None, "p", "m", 1, day(0))])
    got = rows_by(quantiles.exact_percentiles(df, ["variety"], "avg_price", {"q1": 0.25, "mid": 0.5, "q3": 0.75, "top": 1.0}), "variety")
    assert set(got) == set(groups)
    for g, xs in groups.items():
        want = np.quantile(xs, [0.25, 0.5, 0.75, 1.0])
        assert np.allclose([got[g].q1, got[g].mid, got[g].q3, got[g].top], want, rtol=1e-12, atol=1e-12), g


def test_iqr_keeps_fence_values(quotes):
    df = quotes([("a", "p", "m", x, day(0)) for x in (1, 2, 3, 4, 5, 8, 8.01)])
    # q1 = 2.5, q3 = 6.5, fences -3.5 and 12.5: all kept; an outlier goes.
    assert quantiles.iqr_filter(df).count() == 7
    assert quantiles.iqr_filter(df.union(df.limit(1).withColumn("avg_price", F.lit(99.0)))).count() == 7


def test_profiles_keep_only_well_quoted_pairs(quotes, offers, rows_by):
    df = quotes([("a", "p", "m", 2, day(i)) for i in range(10)] + [("a", "q", "m", 8, day(i)) for i in range(9)])
    ads = rows_by(profiles.variety_province_profile(df, offers([("a", "p")] * 3), offers([("a", "q")])), "province")
    assert set(ads) == {"p"} and ads["p"].seed_count == 3 and ads["p"].supplier_count == 0
    assert ads["p"].price_competitiveness == round(2 / ((20 + 72) / 19), 3)


def test_summary_totals_match_tables(spark, sf_dir):
    from marketlens.sources import star_views as sv

    p, s, u = (v(spark, sf_dir) for v in (sv.prices, sv.seeds, sv.suppliers))
    wide = profiles.panorama(p, s, u)
    assert wide.agg(F.sum("price_record_count")).first()[0] == p.count()
    base = profiles.cross_table_summary_base(p, s, u).agg(F.sum("total_seeds"), F.sum("total_suppliers")).first()
    assert tuple(base) == (s.count(), u.count())


def test_score_and_health_bounds(quotes, offers, rows_by):
    steady = [("a", "p", "m", 5, day(i)) for i in range(4)]
    wild = [("b", "p", "m", x, day(i)) for i, x in enumerate((1, 9, 1, 9))]
    df, seeds, sup = quotes(steady + wild), offers([("a", "p")] * 5 + [("b", "p")]), offers([("a", "p")] * 2 + [("b", "p")])
    health = rows_by(scoring.supply_chain_health(df, seeds, sup), "variety")
    assert (health["a"].health_score, health["a"].grade, health["a"].sim_improvement) == (1.0, "A", 0.0)
    assert health["b"].grade == "D" and 0 <= health["b"].health_score <= 1
    score = rows_by(scoring.variety_score(df, seeds, sup), "variety")
    assert score["a"].total_score == 1.0 and score["b"].price_stability == 0.0


def test_health_without_any_listing(quotes, offers):
    got = scoring.supply_chain_health(quotes([("a", "p", "m", 5, day(0))]), offers([]), offers([])).first()
    assert (got.seeds, got.suppliers, got.cv, got.health_score) == (0, 0, 0.0, 0.3)


def test_correlation_guards(quotes, offers):
    few = scoring.supply_demand_items(quotes([("a", "p", "m", 1, day(0)), ("b", "p", "m", 1, day(0))]), offers([]), offers([]))
    assert scoring.supply_demand_correlation(few).first().r_seed_cv == 0.0
    rows = [(v, "p", "m", x, day(i)) for v in "abc" for i, x in enumerate((1, 2))]
    flat = scoring.supply_demand_items(quotes(rows), offers([("a", "p")]), offers([]))
    assert scoring.supply_demand_correlation(flat).first().r_seed_cv == 0.0


def test_compare_keeps_request_order_and_answers_all(quotes, offers):
    df = quotes([("a", "p", "m1", 2, day(0)), ("b", "p", "m2", 4, day(0))])
    got = compare.province_compare(df, offers([("a", "p")]), offers([]), ["x", "p", "y", "z", "w", "over"]).collect()
    assert [r.province for r in got] == ["x", "p", "y", "z", "w", "over"]
    assert (got[1].avg_price, got[1].varieties, got[1].markets, got[1].seed_count) == (3.0, 2, 2, 1)
    pick = compare.variety_compare(df, offers([]), offers([]), ["b", "none", "a"]).collect()
    assert [(r.variety, r.price_std) for r in pick] == [("b", 0.0), ("a", 0.0)]
    assert [m.month for m in pick[0].monthly_trend] == ["2024-01"]


def test_variety_only_in_listings(quotes, offers, rows_by):
    got = rows_by(profiles.cross_table_summary_base(quotes([("a", "p", "m", 2, day(0))]), offers([("s", "p")]), offers([])), "variety")
    assert (got["s"].avg_price, got["s"].total_seeds, got["s"].province_count) == (0.0, 1, 0)


def test_search_pages_partition_the_hits(quotes):
    df = quotes([("a", "山东" if i % 2 else "北京", "m", i, day(i)) for i in range(50)])
    found = search.find_prices(df, province="山东省", variety="a")
    order = search.newest_first("price_date", "market")
    pages = [search.page_of(found, order, n, 10).collect() for n in (1, 2, 3, 4)]
    assert [len(p) for p in pages] == [10, 10, 5, 0]
    assert {r.total for p in pages for r in p} == {25}
    assert len({r.l_orderkey for p in pages for r in p}) == 25
    with pytest.raises(ValueError):
        search.page_of(found, order, 1, 101)


def test_unknown_supplier_province_is_left_out(offers):
    got = listings.by_province(offers([("a", "未知"), ("a", ""), ("a", "p"), ("a", None)]), "n").collect()
    assert [(r.province, r.n) for r in got] == [("p", 1)]


def test_province_list_drops_excluded(quotes, offers):
    df = quality.province_list(quotes([("a", "台湾", "m", 1, day(0)), ("a", "b", "m", 1, day(0))]), offers([("a", "未知"), ("a", "c")]), offers([]))
    assert [r.province for r in df.collect()] == ["b", "c"]


def test_layers_conserve_rows(spark, tmp_path, quotes, offers):
    p = quotes([("a", "p", "m", 1, day(0)), ("a", "台湾", "m", 1, day(0)), ("a", "p", "m", None, day(0))]).withColumn("variety_code", F.lit("c"))
    s = offers([("a", "p"), ("a", None)]).selectExpr("*", "'c' company_name", "1 click_count", "'c' category")
    u = offers([("a", "p")]).selectExpr("*", "'c' contact_person", "'t' company_type", "1 click_count", "'c' category")
    stored = warehouse.build(p, s, u, str(tmp_path / "wh"))
    counts = {r.layer_table: r.cnt for r in warehouse.counts(stored).collect()}
    assert (counts["ods_prices"], counts["dwd_prices"], counts["dwd_seeds"], counts["dws_panorama"]) == (3, 1, 1, 1)
    lazy = {r.layer_table: r.cnt for r in warehouse.counts(warehouse.layers(p, s, u)).collect()}
    assert lazy == counts


def test_merged_cells_equal_direct_statistics(spark, sf_dir):
    from marketlens.sources import star_views as sv

    p = sv.prices(spark, sf_dir)
    merged = {r.province: r for r in batch.merge_cells(settle(batch.quote_cells(p), "t"), "province").collect()}
    for r in p.groupBy("province").agg(F.count("*").alias("n"), F.avg("avg_price").alias("m"), F.stddev_samp("avg_price").alias("s")).collect():
        got = merged[r.province]
        assert got.n == r.n and math.isclose(got.mean, r.m, rel_tol=1e-12) and math.isclose(got.std, r.s, rel_tol=1e-10)


def test_key_pages_are_the_whole_order(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), i) for i in range(57)]
    df, keys = spark.createDataFrame(rows, "d int, s string, i int"), [("d", True), ("s", False), ("i", False)]
    seen, last = [], None
    while page := search.page_after(df, keys, 10, last).collect():
        seen += [tuple(r) for r in page]
        last = page[-1].asDict()
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is None, r[1] or "", r[2]))
    assert seen == want
