"""A training corpus from raw documents, in five stages.

Each stage takes the documents its predecessor kept and returns documents with
the same columns; the last returns the packed pieces. A stage's result is
written to the shared folder before the next one starts, so that a lost
executor costs the tasks it held and nothing before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens.functions.settle import settle
from marketlens.llm import decontaminate, near_dup, packing, suffixes, toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity.stage),
    ("near_duplicates", near_dup.stage),
    ("repeated_passages", suffixes.stage),
    ("decontamination", decontaminate.stage),
    ("packing", packing.stage),
]

#: Fitted models, sketches and token ids are beyond SQL; the tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder.

    Null and empty texts pass all stages as empty documents; rows that repeat an id are kept or dropped together
    by the stages that decide by id; an empty table gives no pieces.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
