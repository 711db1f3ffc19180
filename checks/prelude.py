"""SQL text shared by the oracle queries: the clean views and the raw text views."""

from __future__ import annotations

from marketlens.functions.dims import CODE_TO_PROVINCE, NAME_TO_CODE
from marketlens.sources.star_views import RAW_PROVINCE_CODES, RAW_VARIETIES

CLEAN = """
prices AS (
  SELECT p_brand AS variety, n_name AS province, s_name AS market,
         l_extendedprice / l_quantity AS avg_price,
         l_extendedprice / l_quantity * (1 - l_discount) AS min_price,
         l_extendedprice / l_quantity * (1 + l_tax) AS max_price,
         CAST(l_shipdate AS DATE) AS price_date,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  WHERE n_name NOT IN ('NATION_22', 'NATION_23', 'NATION_24')
),
seeds AS (
  SELECT p_name AS product_name,
         concat(n_name, ' > ', r_name, ' > ', s_name) AS supply_region,
         s_name AS company_name, p_size AS click_count, publish_date,
         concat('http://', lower(p_type), '.example.com/sell/', CAST(l_partkey AS VARCHAR), '.html') AS product_url,
         p_brand AS variety, n_name AS province, l_partkey, l_suppkey
  FROM (SELECT l_partkey, l_suppkey, CAST(min(l_shipdate) AS DATE) AS publish_date
        FROM lineitem GROUP BY l_partkey, l_suppkey) o
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  WHERE n_name NOT IN ('NATION_22', 'NATION_23', 'NATION_24')
),
suppliers AS (
  SELECT p_name AS product_name,
         concat(n_name, ' > ', r_name, ' > ', c_name) AS origin,
         c_name AS contact_person, c_mktsegment AS company_type,
         CAST(l_quantity AS INT) AS click_count, CAST(o_orderdate AS DATE) AS publish_date,
         p_type AS sub_type, p_brand AS variety, n_name AS province,
         l_orderkey, l_partkey, l_suppkey
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
  WHERE n_name NOT IN ('NATION_22', 'NATION_23', 'NATION_24')
)
"""


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _money(cents: str) -> str:
    return f"concat({cents} // 100, '.', lpad(CAST({cents} % 100 AS VARCHAR), 2, '0'))"


_NAME = f"{_list(n for n, _ in RAW_VARIETIES)}[CAST(split_part(p_brand, '#', 2) AS INT)]"
_CODE = f"{_list(c for _, c in RAW_VARIETIES)}[CAST(split_part(p_brand, '#', 2) AS INT)]"
_SHORTS = _list(CODE_TO_PROVINCE.get(c, c) for c in RAW_PROVINCE_CODES)

RAW_PRICES = f"""
cents AS (
  SELECT *, CAST(floor(l_extendedprice / l_quantity * 100) AS BIGINT) AS c, CAST(l_shipdate AS DATE) AS day
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
),
one_copy AS (
  SELECT l_linenumber, {_NAME} AS variety, s_name AS market,
         {_money('(c * 9 // 10)')} AS min_price,
         {_money('(c * 11 // 10)')} AS max_price,
         CASE WHEN l_linenumber = 7 THEN 'abc'
              WHEN l_linenumber % 3 = 0 THEN concat('￥', {_money('c')}, '元')
              WHEN l_linenumber % 3 = 1 THEN
                CASE WHEN c // 100 >= 1000 THEN
                  concat(c // 100000, ',', lpad(CAST(c // 100 % 1000 AS VARCHAR), 3, '0'), '.',
                         lpad(CAST(c % 100 AS VARCHAR), 2, '0'))
                ELSE {_money('c')} END
              ELSE concat(' ', {_money('c')}, ' ') END AS avg_price,
         CASE WHEN l_linenumber = 6 THEN '未知'
              WHEN l_linenumber % 4 = 0 THEN strftime(day, '%Y/%-m/%-d')
              WHEN l_linenumber % 4 = 1 THEN strftime(day, '%Y-%m-%d 00:00:00')
              WHEN l_linenumber % 4 = 2 THEN strftime(day, '%Y-%m-%d')
              ELSE strftime(day, '%Y/%m/%d') END AS date,
         {_list(RAW_PROVINCE_CODES)}[s_nationkey + 1] AS province,
         '2024-01-01 00:00:00' AS crawl_ts, {_CODE} AS variety_code
  FROM cents
),
raw_prices AS (
  SELECT * EXCLUDE (l_linenumber) FROM one_copy
  UNION ALL SELECT * EXCLUDE (l_linenumber) FROM one_copy WHERE l_linenumber = 2
)
"""

RAW_SEEDS = f"""
raw_seeds AS (
  SELECT p_name AS product_name,
         concat(' ', {_SHORTS}[s_nationkey + 1], CASE WHEN l_partkey % 2 = 0 THEN ' > ' ELSE '>' END, s_name) AS supply_region,
         s_name AS company_name,
         CASE WHEN p_size % 5 = 0 THEN 'n/a' WHEN p_size % 5 = 1 THEN concat(p_size, '.0')
              ELSE CAST(p_size AS VARCHAR) END AS click_count,
         strftime(day, '%Y/%-m/%-d') AS date,
         concat('/sell/', l_partkey, '.html') AS product_url,
         concat('http://example.com/c/', l_suppkey) AS company_url,
         {_NAME} AS category
  FROM (SELECT l_partkey, l_suppkey, CAST(min(l_shipdate) AS DATE) AS day FROM lineitem GROUP BY ALL) o
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
)
"""

RAW_SUPPLIERS = f"""
raw_suppliers AS (
  SELECT p_name AS product_name,
         concat({_SHORTS}[c_nationkey + 1], ' > ', c_name) AS origin,
         c_name AS contact_person, c_mktsegment AS company_type,
         CASE WHEN CAST(l_quantity AS INT) % 7 = 0 THEN '' ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS click_count,
         CASE WHEN l_partkey % 10 = 0 THEN '未知' ELSE strftime(CAST(o_orderdate AS DATE), '%Y/%-m/%-d') END AS date,
         concat('/sell/', l_partkey, '.html') AS product_url,
         {_NAME} AS category, p_type AS sub_type
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)
"""


def values(mapping: dict[str, str]) -> str:
    return "(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in mapping.items()) + ")"


# Date parsing by explicit patterns, unlike the shape test on the Spark side.
DAY = (
    "CAST(try_strptime(trim({c}), ['%Y-%m-%d', '%Y/%m/%d %H:%M:%S', '%Y/%m/%d', '%Y-%m-%d %H:%M:%S']) AS DATE)"
)
NUMBER = "TRY_CAST(regexp_replace({c}, '[￥¥元,，\\s]', '', 'g') AS DOUBLE)"

CLEAN_RAW_PRICES = f"""
province_codes AS (SELECT * FROM {values(CODE_TO_PROVINCE)} t(code, short)),
clean_prices AS (
  SELECT DISTINCT variety, market, {NUMBER.format(c='min_price')} AS min_price, {NUMBER.format(c='max_price')} AS max_price,
         {NUMBER.format(c='avg_price')} AS avg_price, {DAY.format(c='date')} AS price_date,
         province AS province_raw, variety_code, coalesce(short, province) AS province
  FROM raw_prices LEFT JOIN province_codes ON province = code
  WHERE {NUMBER.format(c='avg_price')} IS NOT NULL AND {DAY.format(c='date')} IS NOT NULL
)
"""
CLICKS = "coalesce(CAST(TRY_CAST(trim(click_count) AS DOUBLE) AS BIGINT), 0)"
CLEAN_RAW_SEEDS = f"""
clean_seeds AS (
  SELECT DISTINCT product_name, supply_region, company_name, {CLICKS} AS click_count,
         {DAY.format(c='date')} AS publish_date, product_url, category, category AS variety,
         trim(split_part(supply_region, '>', 1)) AS province
  FROM raw_seeds
)
"""
CLEAN_RAW_SUPPLIERS = f"""
clean_suppliers AS (
  SELECT DISTINCT product_name, origin, contact_person, company_type, {CLICKS} AS click_count,
         {DAY.format(c='date')} AS publish_date, product_url, category, sub_type, category AS variety,
         trim(split_part(origin, '>', 1)) AS province
  FROM raw_suppliers
)
"""
assert len(RAW_VARIETIES) == 25 and len(NAME_TO_CODE) >= 25
