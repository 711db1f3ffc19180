"""Connected components of a link table, as repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.settle import settle


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``.

    ``component`` is the smallest node that can be reached. Each round gives
    every label the smallest label beside it and draws the links between the
    new labels; the links shrink until none is left. Rounds write their tables
    to the shared folder. Nulls and loops are ignored.
    """
    links = settle(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    labels = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
    while not links.isEmpty():
        both = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
        lowest = settle(both.groupBy(F.col("a").alias("component")).agg(F.min("b").alias("next"))
                        .select("component", F.least("component", "next").alias("next")), "lowest")
        labels = settle(labels.join(lowest, "component", "left").select("node", F.coalesce("next", "component").alias("component")), "labels")
        left, right = (lowest.select(F.col("component").alias(c), F.col("next").alias(f"next_{c}")) for c in "ab")
        links = settle(
            links.join(left, "a").join(right, "b")
            .select(F.least("next_a", "next_b").alias("a"), F.greatest("next_a", "next_b").alias("b")).where("a < b").distinct(),
            "links",
        )
    return labels
