"""Presence and row counts of landed tables and warehouse layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """(layer, row count) of every given table."""
    return reduce(
        DataFrame.unionByName,
        [df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("layer_table"), "cnt") for name, df in layers.items()],
    )


def landing_audit(tables: dict[str, DataFrame | None]) -> DataFrame:
    """Presence, rows and source files per landed table; None stands for a missing one."""
    def measure(name: str, df: DataFrame) -> DataFrame:
        return df.groupBy().agg(
            F.count(F.lit(1)).alias("row_count"), F.countDistinct(F.col("_metadata.file_path")).alias("files")
        ).select(F.lit(name).alias("table_name"), F.lit(True).alias("present"), "row_count", "files")

    session = next(df for df in tables.values() if df is not None).sparkSession
    absent = lambda name: session.range(1).select(
        F.lit(name).alias("table_name"), F.lit(False).alias("present"),
        F.lit(0).cast("bigint").alias("row_count"), F.lit(0).cast("bigint").alias("files"),
    )
    return reduce(
        DataFrame.unionByName, [absent(n) if df is None else measure(n, df) for n, df in tables.items()]
    )
