import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marketlens.session import build_session

    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture
def quotes(spark):
    """Quote rows from (variety, province, market, price, day) tuples."""
    from pyspark.sql import functions as F

    def make(rows):
        df = spark.createDataFrame(
            [(v, p, m, None if x is None else float(x), d, i) for i, (v, p, m, x, d) in enumerate(rows)],
            "variety string, province string, market string, avg_price double, day string, l_orderkey long",
        )
        return df.select(
            "variety", "province", "market", "avg_price",
            (F.col("avg_price") * 0.9).alias("min_price"), (F.col("avg_price") * 1.1).alias("max_price"),
            F.col("day").cast("date").alias("price_date"), "l_orderkey",
            F.lit(1).alias("l_linenumber"), F.lit(1).alias("l_partkey"), F.lit(1).alias("l_suppkey"),
        )

    return make


@pytest.fixture
def offers(spark):
    """Seed or supplier rows from (variety, province) pairs."""
    def make(pairs):
        return spark.createDataFrame(
            [(v, p, "2024-01-01") for v, p in pairs], "variety string, province string, publish_date string"
        ).selectExpr("variety", "province", "cast(publish_date as date) as publish_date")

    return make


@pytest.fixture
def rows_by(spark):
    def get(df, key):
        return {r[key]: r for r in df.collect()}

    return get
