"""Table readers: explicit schemas, no inference, malformed input kept apart."""

from __future__ import annotations

import csv
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.dates import between_dates
from ..functions.dims import EXCLUDED_REGIONS
from ..functions.numbers import click_count
from ..functions.once import compute_once
from ..functions.settle import settle
from ..operators.cleaning import exclude_regions
from ..schemas import CLEAN_PRICES, CLEAN_SEEDS, CLEAN_SUPPLIERS

SURPLUS = "_surplus"
BOM = "\ufeff"


def as_text(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType()) for f in schema])


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Header CSV by position; a leading byte-order mark belongs to the header and goes with it."""
    return (
        spark.read.schema(schema)
        .option("header", True).option("quote", '"').option("escape", '"').option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def read_prices(spark: SparkSession, path: str, regions=EXCLUDED_REGIONS) -> DataFrame:
    """Clean quotes with a price and a kept province."""
    return exclude_regions(read_csv(spark, path, CLEAN_PRICES).where(F.col("avg_price").isNotNull()), regions=regions)


def _read_listings(spark: SparkSession, path: str, schema: StructType, regions) -> DataFrame:
    rows = read_csv(spark, path, as_text(schema)).withColumn("click_count_num", click_count("click_count"))
    return exclude_regions(rows, regions=regions)


def read_seeds(spark: SparkSession, path: str, regions=EXCLUDED_REGIONS) -> DataFrame:
    return _read_listings(spark, path, CLEAN_SEEDS, regions)


def read_suppliers(spark: SparkSession, path: str, regions=EXCLUDED_REGIONS) -> DataFrame:
    return _read_listings(spark, path, CLEAN_SUPPLIERS, regions)


def read_lenient(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """All-text rows, and the malformed ones apart instead of lost.

    A line with too few fields is kept with NULLs; one with a field too many is
    malformed and shows the first surplus field beside its columns.
    """
    text = StructType([*as_text(schema).fields, StructField(SURPLUS, StringType())])
    rows = read_csv(spark, path, text)
    return rows.where(F.col(SURPLUS).isNull()).drop(SURPLUS), rows.where(F.col(SURPLUS).isNotNull())


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """``file, header``: the first line of every landed file, without a byte-order mark."""
    first = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), first.alias("at"), "value").where("at.block = 0")
    return lines.groupBy("file").agg(F.min_by("value", "at").alias("header")).withColumn("header", F.regexp_replace("header", f"^{BOM}", ""))


def header_fields(header: str) -> list[str]:
    """Names of a header line, quoted or plain."""
    return [f.strip() for f in next(csv.reader([header]), [])]


def read_landed(spark: SparkSession, path: str, schema: StructType, aliases: dict[str, str] | None = None,
                multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """All-text rows by the names in each file's header, and what could not be placed.

    Columns may stand in any order; a column that a file lacks is null, one that the schema
    lacks is left out. ``aliases`` gives further names of the schema's columns. With
    ``multi_line`` a quoted field may hold line breaks; a file is then read by one task.
    Records with a field too many, and all records of files without any known name, go to the
    second table, ``file, record, reason``. Files are grouped by header: the
    driver sees the distinct headers only.
    """
    names = {**{f.name: f.name for f in schema}, **(aliases or {})}
    headers = settle(file_headers(spark, path), "headers")
    layouts = [r["header"] for r in headers.select("header").distinct().orderBy("header").collect()]
    kept, malformed = [], []
    for header in layouts:
        fields = header_fields(header)
        files = [r["file"] for r in headers.where(F.col("header") == header).select("file").orderBy("file").collect()]
        known = {names[f]: i for i, f in reversed(list(enumerate(fields))) if f in names}
        text = StructType([StructField(f"_{i}", StringType()) for i in range(len(fields) + 1)])
        rows = (
            spark.read.schema(text).option("header", True).option("enforceSchema", True).option("multiLine", multi_line)
            .option("quote", '"').option("escape", '"').csv(files).select("*", F.col("_metadata.file_path").alias("file"))
        )
        surplus = F.col(f"_{len(fields)}").isNotNull()
        reason = F.lit("unknown header") if not known else F.when(surplus, "surplus field")
        rows = compute_once(rows, *rows.columns, reason=reason)
        record = F.to_json(F.array(*[F.col(f"_{i}") for i in range(len(fields) + 1)]))
        malformed.append(rows.where(F.col("reason").isNotNull()).select("file", record.alias("record"), "reason"))
        if known:
            kept.append(rows.where(F.col("reason").isNull()).select(
                *[(F.col(f"_{known[f.name]}") if f.name in known else F.lit(None).cast("string")).alias(f.name) for f in schema]))
    none = spark.createDataFrame([], as_text(schema))
    lost = spark.createDataFrame([], "file string, record string, reason string")
    return reduce(DataFrame.unionByName, kept, none), reduce(DataFrame.unionByName, malformed, lost)


def read_partitioned(spark: SparkSession, path: str, date_from: str | None = None, date_to: str | None = None,
                     date: str = "price_date") -> DataFrame:
    """Quotes stored by year-month; the date range also prunes month folders."""
    rows = spark.read.parquet(path)
    if date_from:
        rows = rows.where(F.col("ym") >= date_from[:7])
    if date_to:
        rows = rows.where(F.col("ym") <= date_to[:7])
    return rows.where(between_dates(date, date_from, date_to)).drop("ym")


def external_table(spark: SparkSession, path: str, schema: StructType, name: str) -> DataFrame:
    """A folder of header CSV files as a named view with a fixed schema."""
    df = read_csv(spark, path, schema)
    df.createOrReplaceTempView(name)
    return df


def result_or_compute(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """A stored result when its folder exists, else the same result computed."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return compute()
