"""Result and table sinks. Files are written by the tasks; nothing is gathered to one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.search import newest_first
from ..schemas import SEED_EXPORT_HEADER, SUPPLIER_EXPORT_HEADER

BOM = "\ufeff"


def _csv(df: DataFrame, mode: str):
    """Header CSV writer that keeps the text as it is: quotes doubled, blanks kept."""
    return (
        df.write.mode(mode).option("header", True).option("escape", '"').option("dateFormat", "yyyy-MM-dd")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    )


def write_result(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False) -> str:
    """Overwrite a result folder. ``single_file`` is for small report tables only."""
    out = df.coalesce(1) if single_file else df
    if fmt == "csv":
        _csv(out, "overwrite").csv(path)
    else:
        out.write.mode("overwrite").format(fmt).save(path)
    return path


def create_table_as(df: DataFrame, table: str, path: str | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """Replace a catalog table by the rows of ``df`` and read it back."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def append_rows(df: DataFrame, path: str, fmt: str = "csv", file_rows: int = 0, compression: str = "none") -> str:
    """Append scraped rows; every file carries its own header, so a re-read needs no state.

    ``file_rows`` bounds the rows of a file, for readers that take a file as a whole, as they do with a
    compressed one; 0 for no bound. ``compression`` is that of CSV files.
    """
    if fmt == "csv":
        _csv(df, "append").option("maxRecordsPerFile", file_rows).option("compression", compression).csv(path)
    else:
        df.write.mode("append").option("maxRecordsPerFile", file_rows).format(fmt).save(path)
    return path


def write_clean(df: DataFrame, path: str, compression: str = "none", file_rows: int = 0) -> str:
    """Overwrite a table of the clean layer as UTF-8 CSV with a header.

    A compressed file is read by one task: ``file_rows`` bounds its rows, 0 for no bound.
    """
    _csv(df, "overwrite").option("maxRecordsPerFile", file_rows).option("compression", compression).csv(path)
    return path


def write_partitioned(df: DataFrame, path: str, date: str = "price_date") -> str:
    """Clean quotes as parquet by year-month, so that date filters prune folders.

    Rows are rebalanced by month before writing: AQE splits the heavy months
    over tasks and joins the small ones.
    """
    keyed = df.withColumn("ym", F.date_format(date, "yyyy-MM"))
    keyed.hint("rebalance", "ym").write.mode("overwrite").partitionBy("ym").parquet(path)
    return path


def _quoted(c: str) -> Column:
    return F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))


def _plain(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def search_csv_lines(found: DataFrame, kind: str, limit: int | None = None) -> DataFrame:
    """Lines of an exported search: header with byte-order mark, then the hits, newest first.

    Free text is quoted with quotes doubled, the other columns are plain. Any
    kind but 'seeds' exports suppliers. All hits are exported unless a
    ``limit`` is given. Rows come range-sorted; ``line_no`` rises in their
    order, with gaps between partitions.
    """
    if kind == "seeds":
        header, quoted = SEED_EXPORT_HEADER, ["product_name", "supply_region", "company_name"]
        plain = ["variety", "click_count", "publish_date", "product_url"]
    else:
        header, quoted = SUPPLIER_EXPORT_HEADER, ["product_name", "origin", "contact_person"]
        plain = ["company_type", "variety", "click_count", "publish_date", "product_url"]
    columns = quoted + plain
    order = newest_first("publish_date", *[c for c in columns if c != "publish_date"])
    if limit is not None:
        found = found.orderBy(*order).limit(limit)
    line = F.concat_ws(",", *[_quoted(c) for c in quoted], *[_plain(c) for c in plain])
    body = found.select(F.lit(1).alias("part"), line.alias("line"), *columns)
    empty = [F.lit(None).cast(body.schema[c].dataType).alias(c) for c in columns]
    head = found.sparkSession.range(1).select(F.lit(0).alias("part"), F.lit(BOM + ",".join(header)).alias("line"), *empty)
    return head.union(body).orderBy("part", *order).select(F.monotonically_increasing_id().alias("line_no"), "line")


def write_search_csv(found: DataFrame, kind: str, path: str, limit: int | None = None) -> str:
    """Write an exported search as text files whose names give the order of their lines."""
    search_csv_lines(found, kind, limit).select("line").write.mode("overwrite").text(path)
    return path
