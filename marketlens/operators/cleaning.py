"""Cleaning and unification of the three fact tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dims
from ..functions.dates import parse_date
from ..functions.numbers import click_count, price_number, strip_currency, to_number
from ..functions.once import compute_once
from ..functions.text import region_head, strip

PRICE_COLUMNS = ("min_price", "max_price", "avg_price")


def dedup_exact(df: DataFrame) -> DataFrame:
    """Whole-row distinct. Copies collapse map-side before the shuffle."""
    return df.dropDuplicates()


def exclude_regions(df: DataFrame, column: str = "province", regions=dims.EXCLUDED_REGIONS) -> DataFrame:
    """Drop the given regions and rows without a region."""
    c = F.col(column)
    return df.where(c.isNotNull() & ~c.isin(*regions))


def price_rejects(raw: DataFrame) -> DataFrame:
    """The raw rows that ``clean_prices`` does not take, whole, with the reason: what could not be read."""
    no_price, no_date = to_number(strip_currency("avg_price")).isNull(), parse_date("date").isNull()
    reason = F.when(no_price & no_date, "no price, no date").when(no_price, "no price").when(no_date, "no date")
    return compute_once(raw, *raw.columns, reason=reason).where(F.col("reason").isNotNull())


def clean_prices(raw: DataFrame, distinct: bool = True) -> DataFrame:
    """Raw quote text to the clean schema; rows without date or average price go (see ``price_rejects``).

    Without ``distinct`` copies stay, for a table that drops them itself.
    """
    parsed = compute_once(
        raw, "variety", "market", "province", "variety_code",
        **{f"{c}_value": price_number(c) for c in PRICE_COLUMNS}, price_date=parse_date("date"),
    )
    typed = parsed.where(F.col("avg_price_value").isNotNull() & F.col("price_date").isNotNull()).select(
        # Adding 0 makes one of both zeros, as a distinct does.
        "variety", "market", *[(F.col(f"{c}_value") + F.lit(0.0)).alias(c) for c in PRICE_COLUMNS], "price_date",
        F.col("province").alias("province_raw"), "variety_code",
    )
    # Copies go first: the lookup then runs once per kept row.
    return dims.with_lookup(
        dedup_exact(typed) if distinct else typed, dims.CODE_TO_PROVINCE, F.col("province_raw"), "province", keep_unmapped=True
    )


def clean_seeds(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        "product_name", "supply_region", "company_name",
        click_count("click_count").alias("click_count"),
        parse_date("date").alias("publish_date"),
        "product_url", "category",
    )
    # Copies go first: what follows from these columns needs no part in the shuffle.
    return dedup_exact(typed).select("*", F.col("category").alias("variety"), region_head("supply_region").alias("province"))


def clean_suppliers(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        "product_name", "origin", "contact_person", "company_type",
        click_count("click_count").alias("click_count"),
        parse_date("date").alias("publish_date"),
        "product_url", "category", "sub_type",
    )
    return dedup_exact(typed).select("*", F.col("category").alias("variety"), region_head("origin").alias("province"))


def normalize_province_short(df: DataFrame, key: Column, out: str) -> DataFrame:
    """Alias, full or short province name to the short one; 'unknown' names to NULL."""
    aliases = {**dims.FULL_TO_SHORT, **dims.ALIAS_TO_PROVINCE}
    named = dims.with_lookup(df, aliases, strip(key), out, keep_unmapped=True)
    return named.withColumn(out, F.when(~F.col(out).isin(*dims.UNKNOWN_PROVINCES), F.col(out)))


def normalize_province_full(df: DataFrame, key: Column, out: str) -> DataFrame:
    """Short name or alias to the full map name; identity when unmapped."""
    names = {**dims.SHORT_TO_FULL, **{a: dims.SHORT_TO_FULL[p] for a, p in dims.ALIAS_TO_PROVINCE.items()}}
    return dims.with_lookup(df, names, key, out, keep_unmapped=True)


def province_full_to_short(df: DataFrame, key: Column, out: str) -> DataFrame:
    return dims.with_lookup(df, dims.FULL_TO_SHORT, key, out, keep_unmapped=True)


def variety_name_to_code(df: DataFrame, key: Column, out: str) -> DataFrame:
    return dims.with_lookup(df, dims.NAME_TO_CODE, strip(key), out, keep_unmapped=True)


def variety_code_to_name(df: DataFrame, key: Column, out: str, keep_unmapped: bool = True) -> DataFrame:
    return dims.with_lookup(df, dims.CODE_TO_NAME, key, out, keep_unmapped)


def unify_prices(prices: DataFrame) -> DataFrame:
    """Give quotes the joinable keys: variety by code, short province, one date form."""
    named = variety_code_to_name(prices, F.col("variety_code"), "variety", keep_unmapped=False)
    placed = normalize_province_short(named, F.col("province"), "province_short")
    return placed.select(
        "variety", F.col("province_short").alias("province"), parse_date("date").alias("day"),
    )


def unify_listings(listings: DataFrame, region: str) -> DataFrame:
    """The same keys for seed or supplier listings."""
    placed = normalize_province_short(listings, region_head(region), "province_short")
    return placed.select(
        F.col("category").alias("variety"), F.col("province_short").alias("province"), parse_date("date").alias("day"),
    )


def unify_coverage(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and non-null keys per unified table."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("rows_total"),
            F.count("variety").alias("variety_rows"),
            F.count("province").alias("province_rows"),
            F.count("day").alias("day_rows"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def joinability_report(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Sizes of key intersections and of the two sample joins.

    Every table is first reduced to its (variety, province) pairs; all further
    work is on those. Membership is a flag per table, so one aggregate per key
    answers every two- and three-way intersection.
    """
    pairs = reduce(
        DataFrame.unionByName,
        [
            df.select("variety", "province").distinct().withColumn("src", F.lit(src))
            for src, df in (("p", prices), ("s", seeds), ("u", suppliers))
        ],
    )

    def flags(*keys: str) -> DataFrame:
        rows = pairs
        for k in keys:
            rows = rows.where(F.col(k).isNotNull())
        return rows.groupBy(*keys).agg(
            *[F.max(F.col("src") == src).alias(src) for src in ("p", "s", "u")]
        )

    def sizes(label: str, df: DataFrame, wanted: dict[str, str]) -> DataFrame:
        measured = df.agg(*[F.count_if(F.expr(test)).alias(f"{label}_{name}") for name, test in wanted.items()])
        return measured.unpivot([], list(measured.columns), "measure", "size")

    sets = {
        "prices_seeds": "p AND s", "prices_suppliers": "p AND u",
        "seeds_suppliers": "s AND u", "all_three": "p AND s AND u",
    }
    joins = {"seeds_suppliers": "s AND u", "prices_seeds": "p AND s"}
    return (
        sizes("variety", flags("variety"), sets)
        .unionByName(sizes("province", flags("province"), sets))
        .unionByName(sizes("join", flags("variety", "province"), joins))
    )


def load_quality_counters(prices: DataFrame, seeds: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Null and distinct counters, as one row.

    Distinct counts come from the (variety, province) groups, not from the rows.
    """
    groups = prices.groupBy("variety", "province").agg(F.count_if(F.col("avg_price").isNull()).alias("null_avg"))
    missing = lambda df: df.agg(F.count_if(F.col("publish_date").isNull())).scalar()
    return groups.agg(
        F.sum("null_avg").alias("price_null_avg"),
        F.countDistinct("variety").alias("varieties"),
        F.countDistinct("province").alias("provinces"),
    ).select(
        "price_null_avg",
        missing(seeds).alias("seed_null_date"),
        missing(suppliers).alias("supplier_null_date"),
        "varieties", "provinces",
    )
