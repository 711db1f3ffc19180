"""Shards by jump consistent hashing, in DataFrame functions only.

A key walks from bucket to bucket: standing at bucket b it draws a number r in
(0, 1] from a hash of (key, b) and jumps to ``floor((b + 1) / r)``; the last
bucket below the shard count is its shard. There is no ring table, the walk
has about ``ln(shards)`` steps, and one more shard only cuts the walk one
bucket later, so rows move into the new shard alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARDS = 40
ROW_OVERHEAD_BYTES = 16
#: Steps allowed to a walk, whose mean length is ln(shards); a longer one raises instead of ending wrong.
LONGEST_WALK = 64
#: Numbering groups inside a shard.
SLICES = 211


def jump_shards(key: Column, shards: int) -> Column:
    """Struct of ``shard`` among ``shards`` and ``grown`` among one more."""
    name = F.coalesce(key.cast("string"), F.lit("null"))

    def step(at: Column, _: Column) -> Column:
        draw = F.conv(F.substring(F.md5(F.concat(name, F.lit(":"), at["reached"].cast("string"))), 1, 8), 16, 10).cast("long")
        target = F.floor((at["reached"] + 1) * F.lit(4294967296.0) / (draw + 1)).cast("long")
        return F.when(at["reached"] > shards, at).otherwise(F.struct(
            F.when(at["reached"] < shards, at["reached"]).otherwise(at["shard"]).alias("shard"),
            at["reached"].alias("grown"), target.alias("reached"),
        ))

    zero = F.lit(0).cast("long")
    begin = F.struct(zero.alias("shard"), zero.alias("grown"), zero.alias("reached"))
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(LONGEST_WALK)), begin, step)
    ended = lambda w, c: F.when(w["reached"] > shards, w[c]).otherwise(F.raise_error(F.lit("a walk over the shards did not end")).cast("long")).cast("int").alias(c)
    return F.transform(F.array(walked), lambda w: F.struct(ended(w, "shard"), ended(w, "grown")))[0]


def assign_shards(docs: DataFrame, shards: int = SHARDS, slices: int = SLICES) -> DataFrame:
    """Shard, slot and grown shard of every row, by ``doc_id``.

    Slots count a shard's rows without gaps: each shard is numbered in hash
    slices, and the slices' counts (at most ``shards * slices`` rows) give the
    offsets. A null key is a key like any other; rows that repeat a key share
    its shard and are numbered apart. Null texts have no bytes. Columns beyond
    ``doc_id`` and ``text`` are left out.
    """
    jumped = jump_shards(F.col("doc_id"), shards)
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(ROW_OVERHEAD_BYTES)).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("text_crc32"),
        jumped.alias("jump"),
    ).select(
        "doc_id", "size", "text_crc32", F.col("jump.shard").alias("shard"), F.col("jump.grown").alias("grown_shard"),
        F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slices)).cast("int").alias("slice"),
    )
    counts = rows.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("place", F.row_number().over(inside))
        .join(F.broadcast(first), ["shard", "slice"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
            (F.col("first") + F.col("place") - 1).cast("long").alias("slot"), "grown_shard",
        )
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write whole rows into one folder per shard."""
    (docs.withColumn("shard", jump_shards(F.col("doc_id"), shards)["shard"])
     .repartition("shard", F.pmod(F.xxhash64("doc_id"), F.lit(8)))
     .write.partitionBy("shard").parquet(path))
