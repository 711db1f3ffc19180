"""The addresses that are held, as a bucketed and sorted table of digests.

The table is written once per refresh, clustered by digest. An anti join with
it moves the new links only: the held side is read bucket by bucket, in order,
without an exchange or a sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of the table; a bucket of a billion addresses over 1024 buckets is some 16 MB.
HELD_BUCKETS = 32


def address_digest(url: str | Column) -> Column:
    """128-bit digest of an address."""
    return F.unhex(F.md5(F.col(url) if isinstance(url, str) else url))


def write_held(pages: DataFrame, table: str, path: str, buckets: int = HELD_BUCKETS) -> DataFrame:
    """Store the digests of the pages' addresses as the catalog table ``table``; null addresses are left out."""
    digests = pages.where(F.col("url").isNotNull()).select(address_digest("url").alias("digest")).distinct()
    digests.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, "digest").sortBy("digest").saveAsTable(table)
    return pages.sparkSession.table(table)


def not_held(targets: DataFrame, held: DataFrame) -> DataFrame:
    """Distinct ``target`` addresses whose digest the held table has not."""
    links = targets.select("target").where(F.col("target").isNotNull()).distinct().withColumn("digest", address_digest("target"))
    return links.join(held.hint("merge"), "digest", "left_anti").select("target")
