"""Each fact table is read once per report."""

import pytest

from checks.registry import QUERIES


def fact_scans(df, name):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("+- == Initial Plan ==")[0].count(f"/{name}.parquet]")


@pytest.mark.parametrize("key,most", [
    ("price_heatmap", 1), ("data_quality", 1), ("seasonal_analysis", 1), ("seasonal_factor", 1),
    ("supply_chain_health", 3), ("cross_table_profile", 3), ("variety_province_profile", 3), ("variety_score", 3),
])
def test_scans(spark, sf_dir, key, most):
    assert 1 <= fact_scans(QUERIES[key](spark, sf_dir), "lineitem") <= most
