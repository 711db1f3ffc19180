"""Every registered query against its SQL, on the smallest tables."""

import pytest

from checks.compare import compare, connect
from checks.oracle import ORACLE
from checks.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert not set(ORACLE) - set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_sql(key, spark, sf_dir, con):
    note, ok = compare(spark, key, QUERIES[key], ORACLE[key], sf_dir, con)
    assert ok, note


def test_entry_runs(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "price_competitiveness" in df.columns
