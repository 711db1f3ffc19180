"""Materialised intermediate tables.

A per-key summary that has to be attached to every fact row is first written as
a table in the cluster's shared folder. Its true size is then known from the
files, so the planner broadcasts it when it is under
``spark.sql.autoBroadcastJoinThreshold`` and uses a (skew-split) sort-merge
join beyond that. Writing it also cuts lineage in a way that survives the loss
of executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A session that names none uses a folder beside its warehouse tables, which
    the cluster's file system holds as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_settled"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/marketlens/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a settled table through the cluster's file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Settled:
    """Settled tables with one owner, which deletes them when it is done."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        path = fresh_path(self.spark, label)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        for path in self.paths:
            delete_path(self.spark, path)
        self.paths.clear()


@contextmanager
def settled(spark: SparkSession) -> Iterator[Settled]:
    """Tables settled inside the block are deleted at its end."""
    owner = Settled(spark)
    try:
        yield owner
    finally:
        owner.drop()
