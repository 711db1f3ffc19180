"""Oracle SQL per registered query, for a second engine over the same base tables."""

from __future__ import annotations

from marketlens.functions import dims

from . import prelude as p

ORACLE: dict[str, str] = {}


def add(key: str, sql: str, *ctes: str) -> None:
    ORACLE[key] = "WITH " + ",\n".join(c.strip() for c in (ctes or (p.CLEAN,))) + "\n" + sql.strip()


RAW_P = (p.RAW_PRICES,)
RAW_S = (p.RAW_SEEDS,)
RAW_U = (p.RAW_SUPPLIERS,)
CLEAN_P = (p.RAW_PRICES, p.CLEAN_RAW_PRICES)
CLEAN_S = (p.RAW_SEEDS, p.CLEAN_RAW_SEEDS)
CLEAN_U = (p.RAW_SUPPLIERS, p.CLEAN_RAW_SUPPLIERS)
OUT = "('台湾', '香港', '澳门', 'zhongguo')"

# --- 2.2 cleaning ---------------------------------------------------------
add("clean_prices", "SELECT * FROM clean_prices", *CLEAN_P)
add("clean_seeds", "SELECT * FROM clean_seeds", *CLEAN_S)
add("clean_suppliers", "SELECT * FROM clean_suppliers", *CLEAN_U)
add("strip_currency", f"""
SELECT variety, count(*) AS quotes, count({p.NUMBER.format(c='avg_price')}) AS parsed,
       CAST(sum(CAST(round({p.NUMBER.format(c='avg_price')} * 100) AS BIGINT)) AS BIGINT) AS cents,
       max({p.NUMBER.format(c='avg_price')}) AS highest
FROM raw_prices GROUP BY variety""", *RAW_P)
add("parse_date_multi", f"""
SELECT CAST(CASE WHEN date LIKE '%-%' OR date LIKE '%/%' THEN 1 ELSE 0 END AS INT) AS separators,
       CAST(length(date) AS INT) AS text_length, {p.DAY.format(c='date')} AS day, count(*) AS quotes
FROM raw_prices GROUP BY ALL""", *RAW_P)

FULLS = f"fulls AS (SELECT * FROM {p.values(dims.SHORT_TO_FULL)} t(short, full_))"
CODES = f"codes AS (SELECT * FROM {p.values(dims.CODE_TO_PROVINCE)} t(code, short))"
add("normalize_province_short", """
SELECT coalesce(f.full_, c.short, province) AS full_name,
       CASE WHEN province = 'zhongguo' THEN NULL ELSE coalesce(c.short, province) END AS short_name,
       count(*) AS quotes
FROM raw_prices LEFT JOIN codes c ON province = c.code LEFT JOIN fulls f ON coalesce(c.short, province) = f.short
GROUP BY ALL""", *RAW_P, FULLS, CODES)
HEAD = "trim(split_part(supply_region, '>', 1))"
add("normalize_province_full", f"""
SELECT coalesce(full_, {HEAD}) AS full_name, count(*) AS listings
FROM raw_seeds LEFT JOIN fulls ON short = {HEAD} GROUP BY ALL""", *RAW_S, FULLS)
add("province_full_to_short", f"""
SELECT coalesce(full_, {HEAD}) AS full_name, {HEAD} AS short_name, count(*) AS listings
FROM raw_seeds LEFT JOIN fulls ON short = {HEAD} GROUP BY ALL""", *RAW_S, FULLS)
add("region_head", """
SELECT trim(split_part(origin, '>', 1)) AS province, count(*) AS listings FROM raw_suppliers GROUP BY ALL""", *RAW_U)
add("variety_name_to_code", f"""
SELECT category, coalesce(code, category) AS code, count(*) AS listings
FROM raw_seeds LEFT JOIN {p.values(dims.NAME_TO_CODE)} t(name, code) ON category = name GROUP BY ALL""", *RAW_S)
add("variety_code_to_name", f"""
SELECT variety_code, coalesce(name, variety_code) AS name, count(*) AS quotes
FROM raw_prices LEFT JOIN {p.values(dims.CODE_TO_NAME)} t(code, name) ON variety_code = code GROUP BY ALL""", *RAW_P)
add("exclude_regions", f"SELECT province, count(*) AS quotes FROM raw_prices WHERE province NOT IN {OUT} GROUP BY ALL", *RAW_P)
add("dedup_exact", "SELECT variety, count(*) AS quotes FROM (SELECT DISTINCT * FROM raw_prices) GROUP BY ALL", *RAW_P)
add("fill_click_default", f"""
SELECT category, CAST(sum({p.CLICKS}) AS BIGINT) AS clicks, count(*) FILTER ({p.CLICKS} = 0) AS without_clicks
FROM raw_suppliers GROUP BY ALL""", *RAW_U)

UNIFIED = f"""
u_prices AS (
  SELECT name AS variety, CASE WHEN province IN ('未知', '', 'zhongguo', '中国') THEN NULL
                               WHEN province = 'xicang' THEN '西藏' ELSE province END AS province,
         {p.DAY.format(c='date')} AS day
  FROM raw_prices LEFT JOIN {p.values(dims.CODE_TO_NAME)} t(code, name) ON variety_code = code),
u_seeds AS (
  SELECT category AS variety, CASE WHEN {HEAD} IN ('未知', '', 'zhongguo', '中国') THEN NULL ELSE {HEAD} END AS province,
         {p.DAY.format(c='date')} AS day FROM raw_seeds),
u_suppliers AS (
  SELECT category AS variety, CASE WHEN trim(split_part(origin, '>', 1)) IN ('未知', '', 'zhongguo', '中国') THEN NULL
         ELSE trim(split_part(origin, '>', 1)) END AS province, {p.DAY.format(c='date')} AS day FROM raw_suppliers)
"""
_cov = "SELECT '{n}' AS table_name, count(*) AS rows_total, count(variety) AS variety_rows, count(province) AS province_rows, count(day) AS day_rows FROM u_{n}"
add("unify_tables", " UNION ALL ".join(_cov.format(n=n) for n in ("prices", "seeds", "suppliers")),
    p.RAW_PRICES, p.RAW_SEEDS, p.RAW_SUPPLIERS, UNIFIED)


def _meet(key: str, *names: str) -> str:
    sets = " INTERSECT ".join(f"SELECT {key} FROM u_{n} WHERE {' AND '.join(k.strip() + ' IS NOT NULL' for k in key.split(','))}" for n in names)
    return f"(SELECT count(*) FROM ({sets}))"


_J = []
for _k in ("variety", "province"):
    for _label, _names in (("prices_seeds", ("prices", "seeds")), ("prices_suppliers", ("prices", "suppliers")),
                           ("seeds_suppliers", ("seeds", "suppliers")), ("all_three", ("prices", "seeds", "suppliers"))):
        _J.append((f"{_k}_{_label}", _meet(_k, *_names)))
_J.append(("join_seeds_suppliers", _meet("variety, province", "seeds", "suppliers")))
_J.append(("join_prices_seeds", _meet("variety, province", "prices", "seeds")))
add("joinability_report", " UNION ALL ".join(f"SELECT '{m}' AS measure, {q} AS size" for m, q in _J),
    p.RAW_PRICES, p.RAW_SEEDS, p.RAW_SUPPLIERS, UNIFIED)
add("load_quality_counters", f"""
SELECT CAST(count(*) FILTER (avg_price IS NULL) AS BIGINT) AS price_null_avg,
       (SELECT count(*) FROM clean_seeds WHERE publish_date IS NULL AND province NOT IN {OUT}) AS seed_null_date,
       (SELECT count(*) FROM clean_suppliers WHERE publish_date IS NULL AND province NOT IN {OUT}) AS supplier_null_date,
       count(DISTINCT variety) AS varieties, count(DISTINCT province) AS provinces
FROM clean_prices WHERE province NOT IN {OUT}""", *CLEAN_P, *CLEAN_S, *CLEAN_U)
add("date_range_filter", """
SELECT variety, count(*) AS quotes, min(price_date) AS first_day, max(price_date) AS last_day
FROM prices WHERE price_date BETWEEN DATE '1997-03-01' AND DATE '1998-02-28' GROUP BY variety""")
add("keyword_filter", """
SELECT product_name, count(*) AS listings FROM seeds
WHERE regexp_matches(product_name, 'red|0000[1-3]') OR regexp_matches(company_name, 'red|0000[1-3]') GROUP BY ALL""")

# --- 2.3 aggregates -------------------------------------------------------
MEAN = "round(avg(avg_price), 2) AS avg_price, count(*) AS record_count"
add("price_by_province", f"SELECT province, {MEAN} FROM prices GROUP BY province")
add("price_by_variety", f"SELECT variety, {MEAN} FROM prices GROUP BY variety ORDER BY avg_price DESC, variety LIMIT 20")
add("seed_by_province", "SELECT province, count(*) AS seed_count FROM seeds GROUP BY ALL")
add("supplier_by_province", "SELECT province, count(*) AS supplier_count FROM suppliers GROUP BY ALL")
add("seed_by_category", "SELECT variety, count(*) AS seed_count FROM seeds GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 20")
add("supplier_by_category", "SELECT variety, count(*) AS supplier_count FROM suppliers GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 20")
add("seed_categories_by_province", "SELECT variety, count(*) AS seed_count FROM seeds WHERE province = 'NATION_4' GROUP BY ALL")
add("supplier_categories_by_province", "SELECT variety, count(*) AS supplier_count FROM suppliers WHERE province = 'NATION_4' GROUP BY ALL")
add("price_trend", f"SELECT price_date, {MEAN} FROM prices GROUP BY ALL")
add("price_trend_filtered", f"""
SELECT price_date, {MEAN} FROM prices
WHERE variety = 'Brand#3' AND price_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' GROUP BY price_date""")
add("price_heatmap_long", "SELECT province, variety, round(avg(avg_price), 2) AS avg_price FROM prices GROUP BY ALL")
_HEAT = """
SELECT variety, province, CAST(i AS INT) AS i, CAST(j AS INT) AS j, round(avg(avg_price), 2) AS avg_price FROM prices
JOIN (SELECT variety, row_number() OVER (ORDER BY count(*) DESC, variety) - 1 AS i FROM prices GROUP BY variety) USING (variety)
JOIN (SELECT province, row_number() OVER (ORDER BY count(*) DESC, province) - 1 AS j FROM prices GROUP BY province) USING (province)
WHERE i < {v} AND j < {p} GROUP BY ALL"""
add("price_heatmap", _HEAT.format(v=12, p=1000))
add("price_heatmap_top_provinces", _HEAT.format(v=6, p=5))
add("price_volatility", """
SELECT variety, round(stddev_samp(avg_price) / avg(avg_price), 3) AS volatility, round(avg(avg_price), 2) AS avg_price
FROM prices WHERE price_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' GROUP BY variety
HAVING avg(avg_price) > 0 ORDER BY volatility DESC, variety LIMIT 15""")
add("market_ranking", f"""
SELECT market, {MEAN} FROM prices WHERE price_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
GROUP BY market ORDER BY record_count DESC, market LIMIT 15""")
add("supplier_type_distribution", """
SELECT company_type, count(*) AS supplier_count FROM suppliers GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 10""")
add("price_scatter", """
SELECT market, round(min_price, 2) AS low, round(max_price, 2) AS high FROM
(SELECT * FROM prices WHERE variety = 'Brand#5' ORDER BY price_date DESC, market, min_price, max_price LIMIT 100)""")
_OVER = """
(SELECT count(*) FROM prices) AS price_count, (SELECT count(*) FROM seeds) AS seed_count,
(SELECT count(*) FROM suppliers) AS supplier_count, (SELECT count(DISTINCT variety) FROM prices) AS varieties,
(SELECT count(DISTINCT market) FROM prices) AS markets,
(SELECT count(*) FROM (SELECT province FROM prices UNION SELECT province FROM seeds UNION SELECT province FROM suppliers)) AS provinces
"""
add("overview", f"""
SELECT {_OVER}, (SELECT min(price_date) FROM prices) AS price_date_min, (SELECT max(price_date) FROM prices) AS price_date_max,
       (SELECT max(publish_date) FROM seeds) AS seed_date_max, (SELECT max(publish_date) FROM suppliers) AS supplier_date_max""")
add("variety_list", "SELECT DISTINCT variety FROM prices")
add("province_list", "SELECT province FROM prices UNION SELECT province FROM seeds UNION SELECT province FROM suppliers")
add("key_union", "SELECT variety FROM prices UNION SELECT variety FROM seeds UNION SELECT variety FROM suppliers")
add("key_intersect", "SELECT province FROM prices INTERSECT SELECT province FROM seeds INTERSECT SELECT province FROM suppliers")
add("data_quality", """
SELECT variety, count(avg_price) AS record_count, round(avg(avg_price), 2) AS avg_price,
       min(price_date) AS date_min, max(price_date) AS date_max,
       round(count(avg_price) / max(count(avg_price)) OVER () * 100, 1) AS completeness
FROM prices GROUP BY variety""")
add("data_quality_summary", f"""
SELECT price_count AS total_price_records, seed_count AS total_seed_records, supplier_count AS total_supplier_records,
       varieties AS variety_count, provinces AS province_count, markets AS market_count FROM (SELECT {_OVER})""")
PERIODS = """periods(period_no, label, f, t) AS (VALUES
  (0, '1996 first half', DATE '1996-01-01', DATE '1996-06-30'), (1, '1996', DATE '1996-01-01', DATE '1996-12-31'),
  (2, 'since 2000', DATE '2000-01-01', DATE '9999-12-31'), (3, 'empty', DATE '2030-01-01', DATE '2030-12-31'))"""
add("time_period_compare", """
SELECT period_no, label, coalesce(round(avg(avg_price), 2), 0) AS avg_price, coalesce(round(min(avg_price), 2), 0) AS min_price,
       coalesce(round(max(avg_price), 2), 0) AS max_price, count(avg_price) AS record_count
FROM periods LEFT JOIN prices ON price_date BETWEEN f AND t GROUP BY ALL""", p.CLEAN, PERIODS)
add("time_period_varieties", """
SELECT * FROM (
  SELECT period_no, label, CAST(row_number() OVER (PARTITION BY period_no ORDER BY price DESC, variety) AS INT) AS rank, variety, price
  FROM (SELECT period_no, label, variety, round(avg(avg_price), 2) AS price
        FROM periods JOIN prices ON price_date BETWEEN f AND t GROUP BY ALL)) WHERE rank <= 10""", p.CLEAN, PERIODS)
add("monthly_trend", """
SELECT variety, month, price FROM (
  SELECT variety, strftime(price_date, '%Y-%m') AS month, round(avg(avg_price), 2) AS price,
         row_number() OVER (PARTITION BY variety ORDER BY strftime(price_date, '%Y-%m') DESC) AS r
  FROM prices GROUP BY variety, strftime(price_date, '%Y-%m')) WHERE r <= 12""")
ORACLE["variety_compare_series"] = ORACLE["monthly_trend"].replace(
    "WHERE r <= 12", "WHERE r <= 12 AND variety IN ('Brand#3', 'Brand#7', 'Brand#11', 'Brand#1', 'Brand#2', 'Brand#5', 'Brand#8')")
add("seasonal_analysis", """
SELECT variety, CAST(month AS INT) AS month, monthly_price, round(monthly_price / yearly, 3) AS seasonal_index, round(yearly, 2) AS yearly_avg
FROM (SELECT variety, avg(avg_price) AS yearly FROM prices GROUP BY variety ORDER BY count(*) DESC, variety LIMIT 8)
CROSS JOIN generate_series(1, 12) g(month)
LEFT JOIN (SELECT variety, month(price_date) AS month, round(avg(avg_price), 2) AS monthly_price FROM prices GROUP BY ALL)
USING (variety, month)""")

FENCES = """fences AS (
  SELECT variety, q1, q3, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence
  FROM (SELECT variety, quantile_cont(avg_price, 0.25) AS q1, quantile_cont(avg_price, 0.75) AS q3 FROM prices GROUP BY variety)),
kept AS (SELECT prices.* FROM prices JOIN fences USING (variety) WHERE avg_price BETWEEN lower_fence AND upper_fence)"""
add("percentile_bounds", """
SELECT variety, round(q1, 4) AS q1, round(q3, 4) AS q3, round(lower_fence, 4) AS lower_fence, round(upper_fence, 4) AS upper_fence
FROM fences""", p.CLEAN, FENCES)
add("iqr_filter", """
SELECT variety, count(*) AS kept, round(min(avg_price), 4) AS lowest, round(max(avg_price), 4) AS highest FROM kept GROUP BY variety
""", p.CLEAN, FENCES)

# --- 2.4 joins and scores -------------------------------------------------
PAIRS = """
sc AS (SELECT variety, province, count(*) AS seed_count FROM seeds GROUP BY ALL),
uc AS (SELECT variety, province, count(*) AS supplier_count FROM suppliers GROUP BY ALL),
sv AS (SELECT variety, count(*) AS seed_count FROM seeds GROUP BY ALL),
uv AS (SELECT variety, count(*) AS supplier_count FROM suppliers GROUP BY ALL)"""
add("panorama", """
SELECT variety, province, price_record_count, avg_price_num, min_price_num, max_price_num,
       coalesce(seed_count, 0) AS seed_count, coalesce(supplier_count, 0) AS supplier_count
FROM (SELECT variety, province, count(*) AS price_record_count, round(avg(avg_price), 2) AS avg_price_num,
             round(min(min_price), 2) AS min_price_num, round(max(max_price), 2) AS max_price_num FROM prices GROUP BY ALL)
LEFT JOIN sc USING (variety, province) LEFT JOIN uc USING (variety, province)""", p.CLEAN, PAIRS)
add("variety_province_profile", """
SELECT variety, province, round(m, 2) AS avg_price, n AS price_records,
       coalesce(seed_count, 0) AS seed_count, coalesce(supplier_count, 0) AS supplier_count,
       coalesce(seed_count, 0) + coalesce(supplier_count, 0) AS supply_maturity,
       round(m / nullif(nat, 0), 3) AS price_competitiveness
FROM (SELECT variety, province, avg(avg_price) AS m, count(*) AS n FROM prices GROUP BY ALL)
LEFT JOIN sc USING (variety, province) LEFT JOIN uc USING (variety, province)
LEFT JOIN (SELECT variety, avg(avg_price) AS nat FROM prices GROUP BY variety) USING (variety)
WHERE n >= 10""", p.CLEAN, PAIRS)
PROFILE = """profile AS (
SELECT variety, province, avg_price, price_std, price_records,
       coalesce(seed_count, 0) AS seed_count, coalesce(supplier_count, 0) AS supplier_count,
       coalesce(seed_count, 0) + coalesce(supplier_count, 0) AS supply_maturity, national_avg_price,
       round(avg_price / national_avg_price, 3) AS price_competitiveness, round(price_std / avg_price, 3) AS price_volatility
FROM (SELECT variety, province, round(avg(avg_price), 2) AS avg_price, round(stddev_samp(avg_price), 2) AS price_std,
             count(*) AS price_records FROM prices GROUP BY ALL)
LEFT JOIN sc USING (variety, province) LEFT JOIN uc USING (variety, province)
LEFT JOIN (SELECT variety, round(avg(avg_price), 4) AS national_avg_price FROM prices GROUP BY variety) USING (variety)
WHERE price_records >= 10)"""
add("cross_table_profile", "SELECT * FROM profile", p.CLEAN, PAIRS, PROFILE)
add("cross_table_profile_top", """
SELECT * FROM profile WHERE variety = 'Brand#8' ORDER BY supply_maturity DESC, province LIMIT 10""", p.CLEAN, PAIRS, PROFILE)
add("cross_table_summary", """
SELECT variety, round(avg(avg_price), 2) AS avg_price, CAST(sum(seed_count) AS BIGINT) AS total_seeds,
       CAST(sum(supplier_count) AS BIGINT) AS total_suppliers, count(DISTINCT province) AS province_count,
       CAST(sum(seed_count) + sum(supplier_count) AS BIGINT) AS supply_maturity FROM profile GROUP BY variety""", p.CLEAN, PAIRS, PROFILE)
add("cross_table_summary_base", """
SELECT variety, coalesce(m, 0) AS avg_price, coalesce(seed_count, 0) AS total_seeds, coalesce(supplier_count, 0) AS total_suppliers,
       coalesce(n, 0) AS province_count, coalesce(seed_count, 0) + coalesce(supplier_count, 0) AS supply_maturity
FROM (SELECT variety, round(avg(avg_price), 2) AS m, count(DISTINCT province) AS n FROM prices GROUP BY variety)
FULL JOIN sv USING (variety) FULL JOIN uv USING (variety)""", p.CLEAN, PAIRS)
add("variety_ranking", """
SELECT variety, national_avg_price, price_record_count, coalesce(seed_count, 0) AS total_seed_count,
       coalesce(supplier_count, 0) AS total_supplier_count,
       round(coalesce(seed_count, 0) * 0.3::DOUBLE + coalesce(supplier_count, 0) * 0.4::DOUBLE + (100::DOUBLE - national_avg_price) * 0.3::DOUBLE, 2)
         AS competitiveness_score
FROM (SELECT variety, round(avg(avg_price), 2) AS national_avg_price, count(*) AS price_record_count FROM prices GROUP BY variety)
LEFT JOIN sv USING (variety) LEFT JOIN uv USING (variety)""", p.CLEAN, PAIRS)
SCORES = """
cv AS (SELECT variety, stddev_samp(avg_price) / avg(avg_price) AS cv FROM prices GROUP BY variety HAVING avg(avg_price) > 0),
norms AS (
  SELECT variety, seed_count, supplier_count, seed_norm, supplier_norm, stability, round(stability, 2) AS price_stability
  FROM (SELECT variety, seed_count, seed_count / max(seed_count) OVER () AS seed_norm FROM sv)
  JOIN (SELECT variety, supplier_count, supplier_count / max(supplier_count) OVER () AS supplier_norm FROM uv) USING (variety)
  JOIN (SELECT variety, 1 - cv / max(cv) OVER () AS stability FROM cv) USING (variety))"""
add("variety_score", """
SELECT variety, seed_count, supplier_count, price_stability,
       round(seed_norm * 0.3::DOUBLE + supplier_norm * 0.4::DOUBLE + stability * 0.3::DOUBLE, 2) AS total_score
FROM norms ORDER BY total_score DESC, variety LIMIT 15""", p.CLEAN, PAIRS, SCORES)
add("variety_score_renorm", """
SELECT variety, seed_count, supplier_count, price_stability,
       round(seed_count / max(seed_count) OVER () * 0.3::DOUBLE + supplier_count / max(supplier_count) OVER () * 0.4::DOUBLE
             + price_stability / max(price_stability) OVER () * 0.3::DOUBLE, 2) AS total_score
FROM norms ORDER BY total_score DESC, variety LIMIT 15""", p.CLEAN, PAIRS, SCORES)
add("normalized_count", "SELECT variety, seed_count, round(seed_count / max(seed_count) OVER (), 6) AS seed_count_norm FROM sv", p.CLEAN, PAIRS)
add("max_over_all", "SELECT variety, supplier_count, round(supplier_count / max(supplier_count) OVER (), 6) AS supplier_count_norm FROM uv", p.CLEAN, PAIRS)
add("price_cv_norm", "SELECT variety, round(cv, 6) AS cv, round(1 - cv / max(cv) OVER (), 6) AS stability_norm FROM cv", p.CLEAN, PAIRS, SCORES)
add("province_panorama", """
SELECT 'NATION_4' AS province, (SELECT count(*) FROM seeds WHERE province = 'NATION_4') AS seed_count,
       (SELECT count(*) FROM suppliers WHERE province = 'NATION_4') AS supplier_count,
       coalesce((SELECT round(avg(avg_price), 2) FROM prices WHERE province = 'NATION_4'), 0) AS avg_price""")
add("province_compare", """
SELECT position, province, coalesce(s, 0) AS seed_count, coalesce(u, 0) AS supplier_count, coalesce(m, 0) AS avg_price,
       coalesce(nv, 0) AS varieties, coalesce(nm, 0) AS markets
FROM (VALUES (0, 'NATION_4'), (1, 'NATION_1'), (2, 'nowhere'), (3, 'NATION_7'), (4, 'NATION_9'), (5, 'NATION_2'), (6, 'NATION_3')) r(position, province)
LEFT JOIN (SELECT province, round(avg(avg_price), 2) AS m, count(DISTINCT variety) AS nv, count(DISTINCT market) AS nm FROM prices GROUP BY 1) USING (province)
LEFT JOIN (SELECT province, count(*) AS s FROM seeds GROUP BY 1) USING (province)
LEFT JOIN (SELECT province, count(*) AS u FROM suppliers GROUP BY 1) USING (province)""")
add("province_radar", """
SELECT *, max(seed_count) OVER () AS max_seed_count, max(supplier_count) OVER () AS max_supplier_count, max(avg_price) OVER () AS max_avg_price
FROM (SELECT province, coalesce(s, 0) AS seed_count, coalesce(u, 0) AS supplier_count, coalesce(m, 0) AS avg_price,
        round(coalesce(s, 0) + coalesce(u, 0) + coalesce(m, 0) * 1000::DOUBLE, 2) AS score
      FROM (SELECT province, round(avg(avg_price), 2) AS m FROM prices GROUP BY 1)
      FULL JOIN (SELECT province, count(*) AS s FROM seeds GROUP BY 1) USING (province)
      FULL JOIN (SELECT province, count(*) AS u FROM suppliers GROUP BY 1) USING (province)
      ORDER BY score DESC, province LIMIT 8)""")
add("variety_compare", """
SELECT position, variety, avg_price, price_std, round(price_std / avg_price, 3) AS volatility, province_count, market_count,
       coalesce(seed_count, 0) AS seed_count, coalesce(supplier_count, 0) AS supplier_count, record_count
FROM (VALUES (0, 'Brand#3'), (1, 'Brand#7'), (2, 'no such variety'), (3, 'Brand#11'), (4, 'Brand#1'), (5, 'Brand#2'), (6, 'Brand#5'), (7, 'Brand#8')) r(position, variety)
JOIN (SELECT variety, round(avg(avg_price), 2) AS avg_price, round(stddev_samp(avg_price), 2) AS price_std,
             count(DISTINCT province) AS province_count, count(DISTINCT market) AS market_count, count(*) AS record_count
      FROM prices GROUP BY variety) USING (variety)
LEFT JOIN sv USING (variety) LEFT JOIN uv USING (variety)""", p.CLEAN, PAIRS)
ITEMS = """items AS (
SELECT variety, coalesce(seed_count, 0) AS seeds, coalesce(supplier_count, 0) AS suppliers,
       coalesce(round(s / m, 3), 0) AS cv, round(m, 2) AS avg_price
FROM (SELECT variety, stddev_samp(avg_price) AS s, avg(avg_price) AS m FROM prices GROUP BY variety)
LEFT JOIN sv USING (variety) LEFT JOIN uv USING (variety))"""
add("supply_demand_items", "SELECT * FROM items", p.CLEAN, PAIRS, ITEMS)
add("supply_demand_correlation", """
SELECT count(*) AS varieties, round(corr(seeds, cv), 3) AS r_seed_cv, round(corr(suppliers, cv), 3) AS r_supplier_cv FROM items""",
    p.CLEAN, PAIRS, ITEMS)
add("supply_chain_health", """
SELECT variety, seeds, suppliers, round(cv, 3) AS cv, round(m, 2) AS avg_price, health_score,
       CASE WHEN health_score >= 0.8 THEN 'A' WHEN health_score >= 0.6 THEN 'B' WHEN health_score >= 0.4 THEN 'C' ELSE 'D' END AS grade,
       round((sim - health_score) * 100::DOUBLE, 1) AS sim_improvement
FROM (SELECT *, round(ns * 0.4::DOUBLE + nu * 0.3::DOUBLE + (1::DOUBLE - nc) * 0.3::DOUBLE, 3) AS health_score,
             round(least(1::DOUBLE, ns * 1.2::DOUBLE) * 0.4::DOUBLE + nu * 0.3::DOUBLE + (1::DOUBLE - nc) * 0.3::DOUBLE, 3) AS sim
      FROM (SELECT *, seeds / max(seeds) OVER () AS ns, suppliers / max(suppliers) OVER () AS nu, cv / max(cv) OVER () AS nc
            FROM (SELECT variety, coalesce(seed_count, 0) AS seeds, coalesce(supplier_count, 0) AS suppliers, coalesce(s / m, 0) AS cv, m
                  FROM (SELECT variety, stddev_samp(avg_price) AS s, avg(avg_price) AS m FROM prices GROUP BY variety)
                  LEFT JOIN sv USING (variety) LEFT JOIN uv USING (variety))))""", p.CLEAN, PAIRS)
NEWEST = "newest AS (SELECT max(price_date) AS d FROM prices)"
add("price_alerts", """
SELECT variety, round(c, 2) AS current_avg, round(v, 2) AS previous_avg, change_rate,
       CASE WHEN abs(change_rate) > 30 THEN 'red' ELSE 'yellow' END AS level
FROM (SELECT variety, c, v, round((c - v) / v * 100::DOUBLE, 1) AS change_rate
      FROM (SELECT variety, avg(avg_price) AS c FROM prices, newest WHERE price_date >= d - 30 GROUP BY variety)
      JOIN (SELECT variety, avg(avg_price) AS v FROM prices, newest WHERE price_date >= d - 60 AND price_date < d - 30 GROUP BY variety)
      USING (variety) WHERE v > 0)
WHERE abs(change_rate) > 20""", p.CLEAN, NEWEST)

# --- 2.5 windows ----------------------------------------------------------
# The mean by its recursion, oldest to newest, as a fold over the ordered list.
EMA = """ema AS (
  SELECT variety, round(list_reduce(list(avg_price ORDER BY price_date, l_orderkey, l_linenumber, l_partkey, l_suppkey),
                                    lambda y, x: 0.3::DOUBLE * x + 0.7::DOUBLE * y), 4) AS ema
  FROM {t} GROUP BY variety)"""
add("ema", "SELECT * FROM ema", p.CLEAN, EMA.format(t="prices"))
_SLOW = EMA.format(t="prices").replace("ema AS", "ema_{n} AS").replace("0.3::DOUBLE", "{a}::DOUBLE").replace("0.7::DOUBLE", "{b}::DOUBLE")
add("ema_slow", "SELECT *, 0.05::DOUBLE AS alpha FROM ema_a UNION ALL SELECT *, 0.01::DOUBLE AS alpha FROM ema_b", p.CLEAN,
    _SLOW.format(n="a", a="0.05", b="0.95"), _SLOW.format(n="b", a="0.01", b="0.99"))
SLOPE = """slopes AS (
  SELECT variety, round(CASE WHEN count(*) >= 5 THEN coalesce(regr_slope(avg_price, date_diff('day', d - 60, price_date)), 0) ELSE 0 END, 6) AS slope
  FROM {t}, newest WHERE price_date >= d - 60 GROUP BY variety)"""
add("recent_slope", "SELECT * FROM slopes", p.CLEAN, NEWEST, SLOPE.format(t="prices"))
add("recent_avg_30d", """
SELECT variety, coalesce(round(r, 4), round(m, 4)) AS recent_30d_avg, round(m, 4) AS overall_avg
FROM (SELECT variety, avg(avg_price) AS m, avg(avg_price) FILTER (price_date >= d - 30) AS r FROM prices, newest GROUP BY variety)""",
    p.CLEAN, NEWEST)
add("seasonal_factor", """
SELECT variety, CAST(month AS INT) AS month, round(m / a, 4) AS seasonal_factor
FROM (SELECT variety, month(price_date) AS month, avg(avg_price) AS m FROM prices GROUP BY ALL)
JOIN (SELECT variety, avg(avg_price) AS a FROM prices GROUP BY ALL) USING (variety)""")
add("group_transform", """
SELECT variety, province, count(*) AS quotes, count(*) FILTER (avg_price > q3) AS above_q3, count(*) FILTER (avg_price < q1) AS below_q1
FROM prices JOIN fences USING (variety) GROUP BY ALL""", p.CLEAN, FENCES)
add("topk_then_detail", """
SELECT variety, price_date, count(*) AS quotes, round(avg(avg_price), 2) AS avg_price FROM prices
WHERE variety IN (SELECT variety FROM prices GROUP BY variety ORDER BY count(*) DESC, variety LIMIT 3) GROUP BY ALL""")

# --- 2.6 search -----------------------------------------------------------
add("search_prices", """
SELECT variety, market, province, price_date, total, CAST(2 AS INT) AS page, round(min_price, 2) AS min_price,
       round(max_price, 2) AS max_price, round(avg_price, 2) AS avg_price
FROM (SELECT *, count(*) OVER () AS total FROM prices WHERE province = 'NATION_4' AND variety = 'Brand#8'
      ORDER BY price_date DESC, market, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20 OFFSET 20)""")
add("search_seeds", """
SELECT * EXCLUDE (l_partkey, l_suppkey) FROM (
  SELECT *, count(*) OVER () AS total, CAST(3 AS INT) AS page FROM seeds
  WHERE province = 'NATION_4' AND (regexp_matches(product_name, 'red|blue') OR regexp_matches(company_name, 'red|blue'))
  ORDER BY publish_date DESC, product_name, company_name, l_partkey, l_suppkey LIMIT 50 OFFSET 100)""")
add("search_seeds_after", """
SELECT * EXCLUDE (l_partkey, l_suppkey) FROM (
  SELECT * FROM seeds WHERE province = 'NATION_4' AND (regexp_matches(product_name, 'red|blue') OR regexp_matches(company_name, 'red|blue'))
  ORDER BY publish_date DESC, product_name, company_name, l_partkey, l_suppkey LIMIT 50 OFFSET 50)""")
add("search_suppliers_after", """
SELECT * EXCLUDE (l_orderkey, l_partkey, l_suppkey) FROM (
  SELECT * FROM suppliers
  WHERE company_type = 'MACHINERY' AND (regexp_matches(product_name, 'ring|00012') OR regexp_matches(contact_person, 'ring|00012'))
  ORDER BY publish_date DESC, product_name, contact_person, l_orderkey, l_partkey, l_suppkey, click_count LIMIT 20 OFFSET 20)""")
add("search_postings", " UNION ALL ".join(f"""
SELECT product_name, count(*) AS listings, max(publish_date) AS last_day, '{k}' AS keyword FROM seeds
WHERE regexp_matches(product_name, '{k}') OR regexp_matches(company_name, '{k}') GROUP BY product_name""" for k in ("Supplier#00003|item 12", "red|0000[1-3]")))
ORACLE["search_prices_after"] = f"SELECT * EXCLUDE (total, page) FROM ({ORACLE['search_prices']})"
add("search_suppliers", """
SELECT * EXCLUDE (l_orderkey, l_partkey, l_suppkey) FROM (
  SELECT *, count(*) OVER () AS total, CAST(1 AS INT) AS page FROM suppliers
  WHERE company_type = 'MACHINERY' AND (regexp_matches(product_name, 'ring|00012') OR regexp_matches(contact_person, 'ring|00012'))
  ORDER BY publish_date DESC, product_name, contact_person, l_orderkey, l_partkey, l_suppkey, click_count LIMIT 100)""")

# --- 2.7 forecasting ------------------------------------------------------
STATS = """stats AS (
  SELECT variety, m AS variety_national_avg, s AS variety_price_std, coalesce(round(r, 4), m) AS recent_30d_avg, n AS variety_price_records,
         coalesce(seed_count, 0) AS variety_seed_count, coalesce(supplier_count, 0) AS variety_supplier_count
  FROM (SELECT variety, avg(avg_price) AS m, stddev_samp(avg_price) AS s, count(*) AS n,
               avg(avg_price) FILTER (price_date >= d - 30) AS r FROM prices, newest GROUP BY variety)
  LEFT JOIN sv USING (variety) LEFT JOIN uv USING (variety))"""
add("variety_stats", """
SELECT variety, round(variety_national_avg, 4) AS variety_national_avg, round(variety_price_std, 4) AS variety_price_std,
       round(recent_30d_avg, 4) AS recent_30d_avg, variety_price_records, variety_seed_count, variety_supplier_count
FROM stats""", p.CLEAN, PAIRS, NEWEST, STATS)
FEATURES = """features AS (
  SELECT kept.*, CAST(month(price_date) AS INT) AS month, CAST(dayofyear(price_date) AS INT) AS day_of_year, CAST(year(price_date) AS INT) AS year,
         round(avg_price / variety_national_avg, 3) AS price_ratio, round(avg_price / recent_30d_avg, 3) AS price_vs_recent,
         variety_price_records, variety_seed_count, variety_supplier_count
  FROM kept JOIN stats USING (variety))"""
add("ml_features", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, variety, province, month, day_of_year, year, price_ratio, price_vs_recent,
       variety_price_records, variety_seed_count, variety_supplier_count FROM features""",
    p.CLEAN, PAIRS, NEWEST, FENCES, STATS, FEATURES)
add("string_index", """
SELECT variety, CAST(row_number() OVER (ORDER BY count(*) DESC, variety) - 1 AS INT) AS variety_idx, count(*) AS quotes
FROM prices GROUP BY variety""")
add("assemble", """
SELECT variety, count(*) AS vectors, sum(month)::DOUBLE AS sum_month, sum(day_of_year)::DOUBLE AS sum_day_of_year, sum(year)::DOUBLE AS sum_year,
       sum(variety_price_records)::DOUBLE AS sum_variety_price_records, sum(variety_seed_count)::DOUBLE AS sum_variety_seed_count,
       sum(variety_supplier_count)::DOUBLE AS sum_variety_supplier_count FROM features GROUP BY variety""",
    p.CLEAN, PAIRS, NEWEST, FENCES, STATS, FEATURES)
add("train_test_split", """
SELECT variety, ('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 8))::BIGINT % 10 < 8 AS is_train,
       count(*) AS quotes, min(price_date) AS first_day FROM prices GROUP BY ALL""")
CUTOFF = """cutoff AS (
  SELECT min(price_date) AS c FROM (
    SELECT price_date, sum(count(*)) OVER (ORDER BY price_date) AS upto, sum(count(*)) OVER () AS total FROM prices GROUP BY price_date)
  WHERE upto > total * 0.8::DOUBLE),
naive AS (
  SELECT avg_price, prediction FROM prices, cutoff
  JOIN (SELECT variety, month(price_date) AS mm, avg(avg_price) AS prediction FROM prices, cutoff WHERE price_date < c GROUP BY ALL) t
  ON t.variety = prices.variety AND mm = month(price_date)
  WHERE price_date >= c),
naive_metrics AS (
  SELECT 'RMSE' AS metric, round(sqrt(avg((avg_price - prediction) ** 2)), 4) AS value FROM naive
  UNION ALL SELECT 'R2', round(1 - avg((avg_price - prediction) ** 2) / var_pop(avg_price), 4) FROM naive
  UNION ALL SELECT 'MAE', round(avg(abs(avg_price - prediction)), 4) FROM naive)"""
CUTOFF = CUTOFF.replace("FROM prices, cutoff\n  JOIN", "FROM prices CROSS JOIN cutoff\n  JOIN")
add("regression_metrics", "SELECT * FROM naive_metrics", p.CLEAN, CUTOFF)
add("rf_train", """
SELECT variety, count(*) AS test_rows, round(avg(avg_price), 2) AS mean_price, true AS in_range
FROM prices CROSS JOIN cutoff WHERE price_date >= c GROUP BY variety""", p.CLEAN, CUTOFF)
add("model_metrics", """
SELECT * FROM (VALUES ('numTrees', 50::DOUBLE), ('maxDepth', 10::DOUBLE), ('featureCount', 11::DOUBLE), ('scores_fit', 1::DOUBLE), ('naive_scores_fit', 1::DOUBLE)) v(metric, value)
UNION ALL SELECT 'test_rows', CAST(count(*) AS DOUBLE) FROM prices CROSS JOIN cutoff WHERE price_date >= c""", p.CLEAN, CUTOFF)
ORACLE["feature_importance"] = """
SELECT feature, true AS not_negative, true AS sum_is_one FROM (VALUES ('province_idx'), ('variety_idx'), ('month'), ('day_of_year'), ('year'),
  ('variety_national_avg'), ('variety_price_std'), ('variety_seed_count'), ('variety_supplier_count'), ('variety_price_records'), ('recent_level')) v(feature)"""
add("forecast", """
SELECT CAST(h AS INT) AS horizon, d + h AS forecast_date, variety, round(coalesce(round(r, 4), m), 2) AS current_avg_price, true AS in_band, true AS in_order
FROM (SELECT variety, avg(avg_price) AS m, avg(avg_price) FILTER (price_date >= d - 30) AS r FROM prices, newest GROUP BY variety)
CROSS JOIN newest CROSS JOIN (VALUES (7), (14), (30), (60)) w(h)""", p.CLEAN, NEWEST)
add("forecast_fallbacks", """
SELECT 7 AS horizon, variety, cur AS current_avg_price, price AS predicted_price,
       round(least(price + margin, cur * 1.3::DOUBLE), 2) AS confidence_upper, round(greatest(price - margin, cur * 0.7::DOUBLE), 2) AS confidence_lower, bound_by
FROM (SELECT *, CASE bound_by WHEN 'MAE' THEN 250::DOUBLE ELSE greatest(price * 0.1::DOUBLE, 0.1::DOUBLE) END AS margin
      FROM (SELECT variety, cur, greatest(round(cur * 0.7::DOUBLE, 2), least(round(cur * 1.3::DOUBLE, 2), top)) AS price
            FROM (SELECT variety, round(avg(avg_price), 2) AS cur, round(max(avg_price), 2) AS top FROM prices GROUP BY variety))
      CROSS JOIN (VALUES ('MAE'), ('price')) b(bound_by))""")
add("trailing_level", """
SELECT variety, price_date, round(sum(t) OVER w / sum(n) OVER w, 4) AS level
FROM (SELECT variety, price_date, sum(avg_price) AS t, count(*) AS n FROM prices GROUP BY ALL)
WINDOW w AS (PARTITION BY variety ORDER BY price_date RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING)""")

STAT_FORECAST = """
season AS (
  SELECT variety, month(price_date) AS mm, round(avg(avg_price) / any_value(a), 4) AS f
  FROM kept JOIN (SELECT variety, avg(avg_price) AS a FROM kept GROUP BY variety) USING (variety) GROUP BY ALL),
base AS (
  SELECT variety, ema, coalesce(sd, 0) AS sd, coalesce(slope, 0) AS slope, la, h, d + h AS prediction_date, h / 60::DOUBLE AS share,
         coalesce((SELECT f FROM season s WHERE s.variety = v.variety AND mm = month(d + h)), 1) AS f1,
         coalesce((SELECT f FROM season s WHERE s.variety = v.variety AND mm = month(d)), 1) AS f0
  FROM (SELECT variety, avg(avg_price) AS la, stddev_samp(avg_price) AS sd FROM kept GROUP BY variety) v
  JOIN ema USING (variety) LEFT JOIN slopes USING (variety) CROSS JOIN newest
  CROSS JOIN (VALUES (7), (14), (30), (60)) w(h) WHERE ema > 0),
pulled AS (
  SELECT *, ema * 0.0025::DOUBLE * h * CASE WHEN abs((ema - la) / la) > 0.05 THEN -sign((ema - la) / la)
                                            WHEN abs(slope) > 0.001 THEN sign(slope) ELSE 1 END AS pull FROM base),
raw AS (
  SELECT *, (ema + CASE WHEN abs(slope * h) > abs(pull) THEN slope * h ELSE pull END) * (f1 / f0) AS raw FROM pulled),
priced AS (
  SELECT *, greatest(round(greatest(ema * 0.5::DOUBLE, 0.1::DOUBLE), 2), least(round(ema * 1.5::DOUBLE, 2),
            round(raw * (1::DOUBLE - (raw - la) / la * (share * 0.15::DOUBLE + 0.05::DOUBLE)), 2))) AS p,
         round(greatest(ema * 0.5::DOUBLE, 0.1::DOUBLE), 2) AS lo, round(ema * 1.5::DOUBLE, 2) AS hi, share * 1.5::DOUBLE + 0.5::DOUBLE AS u FROM raw),
stat_forecast AS (
  SELECT CAST(h AS INT) AS horizon, variety, p AS predicted_price, round(ema, 2) AS current_avg_price,
         round(least(p + margin, hi), 2) AS confidence_upper, round(greatest(p - margin, lo), 2) AS confidence_lower,
         round((p - ema) / ema * 100::DOUBLE, 1) AS trend_rate, prediction_date
  FROM (SELECT *, round(greatest(sd * 1.96::DOUBLE * u, p * 0.08::DOUBLE * u), 2) AS margin FROM priced))"""
STAT = (p.CLEAN, NEWEST, FENCES, EMA.format(t="kept"), SLOPE.format(t="kept"), STAT_FORECAST)
add("forecast_statistical", "SELECT * FROM stat_forecast", *STAT)
add("forecast_postprocess", """
SELECT horizon, forecast_date, variety, current_avg_price, p AS predicted_price,
       round(least(p + margin, cur * 1.3::DOUBLE), 2) AS confidence_upper, round(greatest(p - margin, cur * 0.7::DOUBLE), 2) AS confidence_lower
FROM (SELECT horizon, prediction_date AS forecast_date, variety, current_avg_price, current_avg_price AS cur,
             greatest(round(current_avg_price * 0.7::DOUBLE, 2), least(round(current_avg_price * 1.3::DOUBLE, 2), predicted_price)) AS p,
             (SELECT value FROM naive_metrics WHERE metric = 'RMSE') * 1.96::DOUBLE AS margin FROM stat_forecast)""", *STAT, CUTOFF)
add("forecast_rollup", """
SELECT horizon, forecast_date, rank, variety, predicted_price, current_avg_price FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY horizon ORDER BY predicted_price DESC, variety) AS INT) AS rank FROM (
    SELECT CAST(h AS INT) AS horizon, d + h AS forecast_date, variety, round(recent_30d_avg, 2) AS current_avg_price,
           greatest(round(greatest(recent_30d_avg * 0.7::DOUBLE, 0.1::DOUBLE), 2), least(round(recent_30d_avg * 1.3::DOUBLE, 2),
             round(round(variety_national_avg * 1.25::DOUBLE, 2) * round(coalesce(f1.f, 1) / coalesce(f0.f, 1), 4), 2))) AS predicted_price
    FROM stats CROSS JOIN newest CROSS JOIN (VALUES (7), (14), (30), (60)) w(h)
    LEFT JOIN factors f1 USING (variety) LEFT JOIN factors f0 USING (variety)
    WHERE f1.mm = month(d + h) AND f0.mm = month(d))) WHERE rank <= 30""", p.CLEAN, PAIRS, NEWEST, STATS, """
factors AS (SELECT variety, month(price_date) AS mm, round(avg(avg_price) / any_value(a), 4) AS f
  FROM prices JOIN (SELECT variety, avg(avg_price) AS a FROM prices GROUP BY variety) USING (variety) GROUP BY ALL)""")

add("period_statistics", """
SELECT p.period_no, CAST(coalesce(sum(n), 0) AS BIGINT) AS record_count, round(sum(total) / sum(n), 2) AS avg_price, round(min(low), 2) AS min_price, round(max(high), 2) AS max_price
FROM (SELECT o_orderkey AS period_no, CAST(min(o_orderdate) AS DATE) AS f, CAST(min(o_orderdate) AS DATE) + CAST(o_orderkey % 700 - 5 AS INT) AS t FROM orders GROUP BY o_orderkey) p
LEFT JOIN (SELECT price_date, count(*) AS n, sum(avg_price) AS total, min(avg_price) AS low, max(avg_price) AS high FROM prices GROUP BY price_date) d
  ON d.price_date BETWEEN p.f AND p.t GROUP BY p.period_no""")
add("distinct_sketches", " UNION ALL ".join(f"""
SELECT province, count(DISTINCT {c}) AS n_distinct, true AS in_bound, '{c}' AS counted FROM prices
WHERE price_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' GROUP BY province""" for c in ("market", "price_date")))

# --- 2.8 pages ------------------------------------------------------------
add("html_nested_rows", f"""
SELECT p_brand AS variety, s_name AS market, count(*) AS quotes, CAST(sum(c) AS BIGINT) AS cents,
       min(concat('¥', {p._money('(c * 9 // 10)')})) AS lowest, max(concat('¥', {p._money('(c * 11 // 10)')})) AS highest, min(strftime(day, '%Y-%m-%d')) AS first_day
FROM cents GROUP BY ALL""", p.RAW_PRICES)
add("html_table_rows", f"""
, quoted AS (
  SELECT *, CAST(floor(l_extendedprice / l_quantity * 100) AS BIGINT) AS c, CAST(l_shipdate AS DATE) AS day
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey WHERE l_linenumber <> 7)
SELECT p_brand AS variety, s_name AS market, count(*) AS quotes, CAST(sum(c + k) AS BIGINT) AS cents,
       min(concat('￥', {p._money('(c * 9 // 10)')})) AS lowest, max(concat('￥', {p._money('(c * 11 // 10)')})) AS highest,
       min(CASE WHEN k < 3 THEN strftime(day + CAST(k AS INT), '%Y-%m-%d') ELSE '2024-01-01' END) AS first_day,
       count(*) FILTER (k = 3) AS loaded_today
FROM quoted CROSS JOIN generate_series(0, 3) g(k) WHERE k = 0 OR l_linenumber % 3 <> 0 GROUP BY ALL""".lstrip(), "one AS (SELECT 1)")
add("html_listing_rows", """
SELECT product_name, trim(supply_region) AS supply_region, company_name, click_count, date,
       concat('http://seeds.example.com', product_url) AS product_url, company_url FROM raw_seeds""", *RAW_S)
add("html_supplier_rows", """
SELECT product_name, origin, contact_person,
       CASE WHEN company_type IN ('BUILDING', 'MACHINERY') THEN '企业' ELSE '个人' END AS company_type,
       click_count, CASE WHEN date = '未知' THEN '' ELSE date END AS date,
       concat('http://offers.example.com', product_url) AS product_url FROM raw_suppliers""", *RAW_U)
_STEP = "html"
for _a, _b in (("[\"'']", ""), ("[\\n\\r\\t]|\\\\n|\\\\r", " "), ("[\\x00-\\x1F\\x7F-\\x{9F}]", ""), ("[\\s\\p{Z}]+", " ")):
    _STEP = f"regexp_replace({_STEP}, '{_a}', '{_b}', 'g')"
NORMAL = f"replace(trim({_STEP}), ',', '，')"
add("text_normalize", f"SELECT page_id, CAST(length({NORMAL}) AS INT) AS characters, md5({NORMAL}) AS digest FROM pages", "one AS (SELECT 1)")
LINKS = """links AS (
  SELECT page_id, url, CAST(position AS INT) AS position, hrefs[position + 1] AS href
  FROM (SELECT page_id, url, [replace(trim(h, '"'), '&amp;', '&') FOR h IN regexp_extract_all(html, '<a href=("[^"]*")', 1)] AS hrefs FROM pages),
       LATERAL (SELECT unnest(generate_series(0, len(hrefs) - 1)) AS position)),
hosts AS (SELECT *, regexp_extract(url, '^https?://[^/?#]+') AS host FROM links),
resolved AS (
  SELECT *, CASE WHEN starts_with(href, 'http') THEN href WHEN starts_with(href, '/') THEN host || href
                 ELSE rtrim(url, '/') || '/' || href END AS target,
         CASE WHEN starts_with(href, 'http') THEN href WHEN starts_with(href, '/') THEN host || href ELSE host || '/' || href END AS at_root
  FROM hosts)"""
add("link_extract", "SELECT page_id, position, href FROM links", LINKS)
add("link_slugs", """
SELECT DISTINCT regexp_extract(href, '^/([^/]+)$', 1) AS slug FROM links
WHERE regexp_extract(href, '^/([^/]+)$', 1) NOT IN ('', 'p', 'buy', 'the', 'The')""", LINKS)
add("page_count_detect", """
SELECT CAST(CASE WHEN l_linenumber BETWEEN 1 AND 5 THEN l_quantity ELSE 5 END AS INT) AS page_count, count(*) AS pages
FROM lineitem GROUP BY 1""", "one AS (SELECT 1)")
add("listing_page_count", """
SELECT CAST(CASE l_linenumber WHEN 5 THEN 9999 WHEN 6 THEN l_quantity ELSE 1 END AS INT) AS page_count, count(*) AS pages
FROM lineitem GROUP BY 1""", "one AS (SELECT 1)")
add("page_addresses", """
SELECT CAST(n AS INT) AS page_no, count(*) AS pages, concat('http://quotes.example.com/p', n, '.html') AS target
FROM (SELECT CAST(CASE WHEN l_linenumber BETWEEN 1 AND 5 THEN l_quantity ELSE 5 END AS INT) AS page_count FROM lineitem)
JOIN generate_series(1, 60) g(n) ON n <= page_count GROUP BY n""", "one AS (SELECT 1)")
add("url_resolve", "SELECT page_id, position, target AS at_page, at_root FROM resolved", LINKS)
add("link_frontier", "SELECT DISTINCT split_part(target, '#', 1) AS target FROM resolved WHERE split_part(target, '#', 1) NOT IN (SELECT url FROM pages)", LINKS)
ORACLE["link_frontier_held"] = ORACLE["link_frontier"]
add("crawl_coverage", """
SELECT host, pages_held, coalesce(links_seen, 0) AS links_seen, coalesce(links_missing, 0) AS links_missing, CAST(0 AS BIGINT) AS rows_extracted
FROM (SELECT regexp_extract(url, '^https?://[^/?#]+') AS host, count(*) AS pages_held FROM pages GROUP BY 1)
LEFT JOIN (SELECT host, count(DISTINCT split_part(target, '#', 1)) AS links_seen,
                  count(DISTINCT split_part(target, '#', 1)) FILTER (split_part(target, '#', 1) NOT IN (SELECT url FROM pages)) AS links_missing FROM resolved GROUP BY host) USING (host)
UNION ALL
SELECT 'http://seeds.example.com', count(*), count(DISTINCT product_url) + count(DISTINCT company_url), count(DISTINCT product_url) + count(DISTINCT company_url), count(*) FROM raw_seeds""",
    p.RAW_SEEDS, LINKS)

# --- 2.1 sources, sinks, layers; 2.9 streaming ----------------------------
ALL_CLEAN = (*CLEAN_P, *CLEAN_S, *CLEAN_U)
add("src_prices", f"SELECT * FROM clean_prices WHERE province NOT IN {OUT}", *CLEAN_P)
_LISTED = """SELECT * REPLACE (CAST(click_count AS VARCHAR) AS click_count, CAST(publish_date AS VARCHAR) AS publish_date),
  click_count AS click_count_num FROM {t} WHERE province NOT IN """ + OUT
add("src_seeds", _LISTED.format(t="clean_seeds"), *CLEAN_S)
add("src_suppliers", _LISTED.format(t="clean_suppliers"), *CLEAN_U)
add("src_lenient_csv", """
SELECT variety, count(*) AS kept, nullif(count(*) FILTER (date = '未知'), 0) AS malformed FROM raw_prices GROUP BY variety""", *RAW_P)
add("clean_price_rejects", f"""
SELECT variety, reason, count(*) AS rows, max(date) AS last_date, max(avg_price) AS last_price FROM (
  SELECT *, CASE WHEN {p.NUMBER.format(c='avg_price')} IS NULL AND {p.DAY.format(c='date')} IS NULL THEN 'no price, no date'
                 WHEN {p.NUMBER.format(c='avg_price')} IS NULL THEN 'no price' WHEN {p.DAY.format(c='date')} IS NULL THEN 'no date' END AS reason FROM raw_prices)
WHERE reason IS NOT NULL GROUP BY variety, reason""", *RAW_P)
add("observed_load", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS counter, {e} AS value FROM clean_{t}"
    for t, d in (("prices", "price_date"), ("seeds", "publish_date"), ("suppliers", "publish_date"))
    for c, e in (("rows", "count(*)"), *((f"null_{c}", f"count(*) FILTER ({c} IS NULL)") for c in ("province", "variety", d)))), *ALL_CLEAN)
add("src_landed_csv", """
SELECT variety, kind, count(*) AS rows, max(shown) AS market, max(date) AS date FROM (
  SELECT *, CASE WHEN wave = 1 THEN market || chr(10) || '"2", east' ELSE market END AS shown,
         CASE WHEN wave = 2 AND date = '未知' THEN 'surplus field' WHEN wave = 1 THEN 'two lines' ELSE 'one line' END AS kind
  FROM (SELECT *, CAST(right(market, 1) AS INT) % 3 AS wave FROM raw_prices)) GROUP BY variety, kind""", *RAW_P)
add("src_external_table", """
SELECT province, count(*) AS quotes, min(price_date) AS first_day, max(avg_price) AS highest FROM clean_prices GROUP BY province""", *CLEAN_P)
add("src_result_readback", f"""
SELECT province, {MEAN}, source FROM prices CROSS JOIN (VALUES ('computed'), ('stored')) s(source) GROUP BY province, source""")
ORACLE["sink_result"] = ORACLE["price_by_variety"]
add("sink_ctas", f"SELECT variety, province, count(*) AS quotes FROM clean_prices WHERE province NOT IN {OUT} GROUP BY ALL", *CLEAN_P)
add("sink_append", "SELECT variety, province, count(*) AS quotes, max(market) AS last_market FROM raw_prices GROUP BY ALL", *RAW_P)
add("sink_clean", "SELECT * FROM clean_suppliers", *CLEAN_U)
add("sink_partitioned", """
SELECT strftime(price_date, '%Y-%m') AS ym, count(*) AS quotes, max(price_date) AS last_day FROM prices
WHERE price_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' GROUP BY 1""")
add("sink_search_csv", """
SELECT concat('"', product_name, '","', supply_region, '","', company_name, '",', variety, ',', click_count, ',', publish_date, ',', product_url) AS line
FROM clean_seeds WHERE regexp_matches(product_name, 'red|blue') OR regexp_matches(company_name, 'red|blue')
UNION ALL SELECT '产品名称,供应地区,企业名称,品种,点击量,日期,产品链接'""", *CLEAN_S)
_N = "(SELECT count(*) FROM clean_{t})"
add("landing_audit", " UNION ALL ".join(
    [f"SELECT '{t}' AS table_name, true AS present, {_N.format(t=t)} AS row_count" for t in ("prices", "seeds", "suppliers")]
    + ["SELECT 'missing', false, CAST(0 AS BIGINT)"]), *ALL_CLEAN)
add("dwd_prices", f"""
SELECT variety, province, market AS market_name, min_price, max_price, avg_price, price_date, variety_code
FROM clean_prices WHERE province NOT IN {OUT}""", *CLEAN_P)
add("dwd_seeds", f"""
SELECT variety, province, company_name, click_count, publish_date, category FROM clean_seeds WHERE province NOT IN {OUT}""", *CLEAN_S)
add("dwd_suppliers", f"""
SELECT variety, province, contact_person, company_type, click_count, publish_date, category
FROM clean_suppliers WHERE province NOT IN {OUT}""", *CLEAN_U)
_KEPT = f"WHERE province NOT IN {OUT}"
_LAYERS = {
    "ods_prices": "SELECT avg_price AS v FROM clean_prices", "ods_seeds": "SELECT click_count AS v FROM clean_seeds", "ods_suppliers": "SELECT click_count AS v FROM clean_suppliers",
    "dwd_prices": f"SELECT max_price AS v FROM clean_prices {_KEPT}", "dwd_seeds": f"SELECT click_count AS v FROM clean_seeds {_KEPT}",
    "dwd_suppliers": f"SELECT click_count AS v FROM clean_suppliers {_KEPT}",
    "dws_panorama": f"SELECT count(*) AS v FROM clean_prices {_KEPT} GROUP BY variety, province",
    "ads_variety_province_profile": f"SELECT count(*) AS v FROM clean_prices {_KEPT} GROUP BY variety, province HAVING count(*) >= 10",
    "ads_variety_ranking": f"SELECT count(*) AS v FROM clean_prices {_KEPT} GROUP BY variety",
}
add("layer_counts", " UNION ALL ".join(f"SELECT '{n}' AS layer_table, count(*) AS cnt, round(CAST(sum(v) AS DOUBLE), 4) AS total FROM ({q})" for n, q in _LAYERS.items()), *ALL_CLEAN)
add("union_all", """
SELECT kind, variety, count(*) AS n, max(day) AS last_day FROM (
  SELECT 'price' AS kind, variety, price_date AS day FROM prices
  UNION ALL SELECT 'seed', variety, publish_date FROM seeds
  UNION ALL SELECT 'supplier', variety, publish_date FROM suppliers) GROUP BY ALL""")
add("merged_statistics", """
SELECT variety, count(*) AS n, round(avg(avg_price), 4) AS mean, round(stddev_samp(avg_price), 4) AS std,
       round(min(min_price), 4) AS low, round(max(max_price), 4) AS high FROM prices GROUP BY variety""")
_REPORTS = {
    "price_by_province": ("price_by_province", "avg_price"), "price_by_variety": ("price_by_variety", "avg_price"), "heatmap": ("price_heatmap_long", "avg_price"),
    "seed_by_province": ("seed_by_province", "seed_count"), "supplier_by_province": ("supplier_by_province", "supplier_count"), "price_trend": ("price_trend", "avg_price"),
    "variety_score": ("variety_score", "total_score"), "cross_table_profile": ("cross_table_profile", "price_competitiveness"), "forecast_statistical": ("forecast_statistical", "predicted_price"),
}
ORACLE["batch_reports"] = " UNION ALL ".join(
    f"SELECT '{n}' AS layer_table, count(*) AS cnt, round(CAST(sum({c}) AS DOUBLE), 4) AS total FROM ({ORACLE[k]})" for n, (k, c) in _REPORTS.items())
add("incremental_ingest", "SELECT * FROM clean_prices", *CLEAN_P)
_NONE = {c: f"CAST(NULL AS {t})" for c, t in (("variety", "VARCHAR"), ("province", "VARCHAR"), ("day", "DATE"), ("avg_price", "DOUBLE"), ("record_count", "BIGINT"),
                                              ("std", "DOUBLE"), ("low", "DOUBLE"), ("high", "DOUBLE"), ("cv", "DOUBLE"))}


def _report(name: str, keys: dict[str, str], rest: str = "", having: str = "", **values: str) -> str:
    have = {**_NONE, **keys, "avg_price": "round(avg(avg_price) + 0.000001, 2)", **values}
    group = ", ".join(keys.values())
    return f"(SELECT '{name}' AS report, {', '.join(f'{v} AS {c}' for c, v in have.items())} FROM clean_prices GROUP BY {group} {having} {rest})"


_V, _P = {"variety": "variety"}, {"province": "province"}
_LEVEL = {"std": "round(stddev_samp(avg_price), 2)", "low": "round(min(min_price), 2)", "high": "round(max(max_price), 2)"}
add("report_refresh", " UNION ALL ".join([
    _report("price_by_province", _P, record_count="count(*)"),
    _report("price_by_variety", _V, "ORDER BY round(avg(avg_price) + 0.000001, 2) DESC, variety LIMIT 20", record_count="count(*)"),
    _report("heatmap", {**_V, **_P}), _report("price_trend", {"day": "price_date"}),
    _report("monthly_levels", {**_V, "day": "CAST(date_trunc('month', price_date) AS DATE)"}, record_count="count(*)", **_LEVEL),
    _report("price_spread", _V, having="HAVING count(*) >= 10", cv="round(stddev_samp(avg_price) / avg(avg_price) * 100, 2)", **_LEVEL),
]), *CLEAN_P)
add("compacted_months", """
SELECT strftime(price_date, '%Y-%m') AS ym, count(*) AS quotes, max(avg_price) AS highest, CAST(count(*) AS BIGINT) AS in_cells,
       CASE WHEN price_date < DATE '1999-01-01' THEN 1 ELSE count(DISTINCT CAST(right(market, 1) AS INT) % 3) END AS parts
FROM clean_prices GROUP BY strftime(price_date, '%Y-%m'), price_date < DATE '1999-01-01'""", *CLEAN_P)
add("watermarked_ingest", f"""
SELECT kind, strftime(price_date, '%Y-%m') AS ym, count(*) AS quotes, count(DISTINCT variety) AS varieties, max(avg_price) AS highest FROM (
  SELECT 'kept' AS kind, variety, price_date, avg_price FROM clean_prices
  UNION ALL
  SELECT 'late', variety, {p.DAY.format(c='date')}, {p.NUMBER.format(c='avg_price')} FROM (SELECT DISTINCT * FROM raw_prices WHERE variety = '白菜')
  WHERE {p.NUMBER.format(c='avg_price')} IS NOT NULL
    AND {p.DAY.format(c='date')} <= (SELECT max(price_date) FROM clean_prices WHERE price_date < DATE '1999-01-01') - 90
) GROUP BY ALL""", *CLEAN_P)

# --- 2.2 scalar functions, 2.6 value discard ------------------------------
add("scalar_math", """
SELECT variety, province, round(gap, 3) AS gap, round(abs(gap), 3) AS size, CAST(sign(gap) AS INT) AS direction,
       round(least(50::DOUBLE, greatest(-50::DOUBLE, gap)), 3) AS clipped, coalesce(nullif(n, 100), 0) AS n_or_zero,
       round(gap / CASE WHEN n % 2 = 0 THEN NULL ELSE n END, 6) AS per_quote
FROM (SELECT variety, province, avg(max_price + min_price - 2 * avg_price) AS gap, count(*) AS n FROM prices GROUP BY ALL)""")
add("scalar_date", """
SELECT price_date, count(*) AS quotes, CAST(month(price_date) AS INT) AS month, CAST(dayofyear(price_date) AS INT) AS day_of_year,
       CAST(year(price_date) AS INT) AS year, price_date + 30 AS ahead, price_date - 60 AS before,
       CAST(date_diff('day', DATE '1995-01-01', price_date) AS INT) AS day_no, strftime(price_date, '%Y-%m') AS ym,
       CAST(date_trunc('month', price_date) AS DATE) AS first_day FROM prices GROUP BY price_date""")
add("scalar_string", """
SELECT split_part(supply_region, ' > ', 2) AS second, trim(split_part(supply_region, '>', 3)) AS last,
       replace(supply_region, ' > ', '/') AS path, regexp_replace(product_url, '^https?://', '') AS bare_url,
       regexp_extract(product_url, '/sell/(\\d+)\\.html', 1) AS offer, count(*) AS listings
FROM seeds GROUP BY supply_region, product_url""")
add("conditional", """
SELECT variety, CASE WHEN avg_price >= 10000 THEN 'A' WHEN avg_price >= 2000 THEN 'B' WHEN avg_price >= 500 THEN 'C' ELSE 'D' END AS band,
       count(*) AS quotes FROM prices GROUP BY ALL""")
add("except_values", """
(SELECT province FROM prices UNION SELECT province FROM seeds UNION SELECT province FROM suppliers)
EXCEPT SELECT * FROM (VALUES ('NATION_1'), ('NATION_2'))""")
