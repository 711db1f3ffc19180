"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Each
query is executed whole into a discarding sink. Short queries run twice and the
better time counts, so that JVM warm-up is not measured; long ones and the one
that trains a model run once.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "clean_prices", "price_by_province", "price_by_variety", "price_trend", "price_heatmap", "price_volatility",
    "market_ranking", "overview", "data_quality", "time_period_compare", "seasonal_analysis", "percentile_bounds",
    "iqr_filter", "panorama", "variety_province_profile", "cross_table_profile", "variety_ranking", "variety_score",
    "supply_chain_health", "supply_demand_correlation", "price_alerts", "ema", "recent_slope", "search_prices",
    "forecast_statistical", "link_frontier", "html_listing_rows", "layer_counts", "incremental_ingest", "model_metrics",
    "forecast",
]

REPEAT_BELOW = 20.0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from checks.registry import QUERIES
    from marketlens.session import build_session

    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    QUERIES["price_by_province"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for key in wanted:
        runs = []
        while not runs or (len(runs) < 2 and runs[0] < REPEAT_BELOW and key != "model_metrics"):
            start = time.perf_counter()
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[key] = round(min(runs), 3)
        print(f"{key} {times[key]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
