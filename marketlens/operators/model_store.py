"""Fitted pipelines stored under a digest of what they were fitted on.

A model is fitted once per state of its input and settings and read back by
whoever asks next, in this session or another. Nothing is kept in memory, and
an input that changes by one row has another digest, hence another model.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.settle import shared_dir


def table_digest(df: DataFrame) -> str:
    """A digest of the rows of a table in any order: their number and two sums of their hashes.

    One scan, folded map-side. Columns count with their names and types.
    """
    row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    low, high = row.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(row, 32)
    mixed = F.xxhash64(row, F.lit(1)).bitwiseAND(0xFFFFFFFF)
    sums = df.agg(F.count(F.lit(1)), *[F.sum(c.cast("decimal(38,0)")).cast("string") for c in (low, high, mixed)]).first()
    return hashlib.sha256(repr((sorted(df.dtypes), tuple(sums))).encode()).hexdigest()


def models_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/marketlens/models"


def stored_model(spark: SparkSession, inputs: Mapping[str, DataFrame], fit: Callable[[], PipelineModel],
                 settings: Mapping[str, object] | None = None, folder: str | None = None) -> PipelineModel:
    """The model fitted on ``inputs`` with ``settings``: read if it is stored, else fitted and stored.

    A model appears under its name when all of its files are written; of two that
    are fitted at once the first to finish stays.
    """
    key = hashlib.sha256(repr((sorted((settings or {}).items()), [(n, table_digest(inputs[n])) for n in sorted(inputs)])).encode()).hexdigest()
    path = f"{folder or models_dir(spark)}/{key}"
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = named.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(named):
        return PipelineModel.load(path)
    model = fit()
    draft = f"{path}.{uuid.uuid4().hex}"
    model.write().save(draft)
    if files.exists(named) or not files.rename(spark._jvm.org.apache.hadoop.fs.Path(draft), named):
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(draft), True)
    return model
