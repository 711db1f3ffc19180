"""Explicit schemas; nothing is inferred from data.

Column order is the order of the landed files. Raw tables are all text: numbers
and dates are parsed by the cleaning operators so that a bad token becomes NULL.
"""

from __future__ import annotations

from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

_TYPES = {"string": StringType(), "double": DoubleType(), "bigint": LongType(), "date": DateType()}


def _struct(columns: str) -> StructType:
    """A schema from 'name type, ...'; usable before any session exists."""
    pairs = [c.split() for c in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_PRICES = _struct(
    "variety string, market string, min_price string, max_price string, avg_price string, "
    "date string, province string, crawl_ts string, variety_code string"
)
RAW_SEEDS = _struct(
    "product_name string, supply_region string, company_name string, click_count string, date string, "
    "product_url string, company_url string, category string"
)
RAW_SUPPLIERS = _struct(
    "product_name string, origin string, contact_person string, company_type string, click_count string, "
    "date string, product_url string, category string, sub_type string"
)
CLEAN_PRICES = _struct(
    "variety string, market string, min_price double, max_price double, avg_price double, price_date date, "
    "province_raw string, variety_code string, province string"
)
CLEAN_SEEDS = _struct(
    "product_name string, supply_region string, company_name string, click_count bigint, publish_date date, "
    "product_url string, category string, variety string, province string"
)
CLEAN_SUPPLIERS = _struct(
    "product_name string, origin string, contact_person string, company_type string, click_count bigint, "
    "publish_date date, product_url string, category string, sub_type string, variety string, province string"
)

# Header names used by the landed files, in schema order.
PRICE_HEADER = ["品种", "批发市场", "最低价", "最高价", "平均价", "日期", "省份", "蔬菜类型", "省份简称"]
RAW_PRICE_HEADER = ["品种", "批发市场", "最低价", "最高价", "平均价", "日期", "省份", "爬取时间", "蔬菜类型"]
RAW_SEED_HEADER = ["产品名称", "供应地区", "企业名称", "点击量", "日期", "产品链接", "企业链接", "分类"]
RAW_SUPPLIER_HEADER = ["产品名称", "产地", "联系人", "企业类型", "点击量", "日期", "产品链接", "分类", "子分类"]
SEED_EXPORT_HEADER = ["产品名称", "供应地区", "企业名称", "品种", "点击量", "日期", "产品链接"]
SUPPLIER_EXPORT_HEADER = ["产品名称", "产地", "联系人", "企业类型", "品种", "点击量", "日期", "产品链接"]
