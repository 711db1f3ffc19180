"""Counts that are taken while a table is written, without another scan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_observed(df: DataFrame, path: str, counts: dict[str, Column], write: Callable[[DataFrame, str], object] | None = None) -> dict[str, int]:
    """Write ``df`` and return the aggregates of ``counts`` over the written rows.

    The aggregates are taken by the tasks that write. ``write(df, path)`` is the sink, parquet by default. An
    empty table gives what the aggregates give on no rows.
    """
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in counts.items()])
    (write or (lambda rows, to: rows.write.mode("overwrite").parquet(to)))(observed, path)
    return dict(seen.get)


def null_counts(df: DataFrame, *columns: str) -> dict[str, Column]:
    """The number of nulls of each column, as counts for ``write_observed``."""
    return {f"null_{c}": F.count_if(F.col(c).isNull()) for c in columns or df.columns}


def counts_frame(spark: SparkSession, counts: dict[str, dict[str, int]]) -> DataFrame:
    """``table_name, counter, value`` of the counts of several tables."""
    rows = [(table, name, value) for table, found in counts.items() for name, value in sorted(found.items())]
    return spark.createDataFrame(rows, "table_name string, counter string, value long")
