"""Variety and province dictionaries, as constants and as small DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Variety names and the codes used by the listing pages.
LISTING_VARIETY_CODES = {
    "白菜": "baicai",
    "芹菜": "qincai",
    "菠菜": "bocai",
    "莴苣": "woju",
    "番茄": "fanqie",
    "辣椒": "lajiao",
    "茄子": "qiezi",
    "甘蓝": "ganlan",
    "花椰菜": "huacai",
    "西瓜": "gua",
    "黄瓜": "hg",
    "南瓜": "nangua",
    "西葫芦": "xihulu",
    "冬瓜": "donggua",
    "豆角": "doujiao",
    "萝卜": "luobo",
    "姜": "jiang",
    "大葱": "cong",
    "大蒜": "suan",
    "土豆": "tudou",
    "香菜": "xiangcai",
    "芥菜": "jiecai",
    "油菜": "youcai",
    "茼蒿": "tonghao",
    "甜椒": "tianjiao",
    "西兰花": "xilanhua",
    "甜瓜": "tiangua",
    "苦瓜": "kugua",
    "丝瓜": "sigua",
    "菜豆": "caidou",
    "豌豆": "wandou",
    "胡萝卜": "huluobo",
    "莲藕": "lianou",
    "洋葱": "yangcong",
    "韭菜": "jiucai",
    "食用菌": "shiyongjun",
    "蒜薹": "suantai",
    "蒜苗": "suanmiao",
    "红薯": "hongshu",
    "芋头": "yutou",
    "芦笋": "lusun",
}

# Names whose quotes use another code; these win for name -> code.
QUOTE_VARIETY_CODES = {
    "花椰菜": "huayecai",
    "菜花": "caihua",
    "西兰花": "xilanhua",
    "黄瓜": "huanggua",
    "西瓜": "xigua",
    "山药": "shanyao",
    "大蒜": "dasuan",
    "大葱": "dacong",
}

# Short province name and the full name used on maps.
SHORT_TO_FULL = {
    "北京": "北京市",
    "天津": "天津市",
    "上海": "上海市",
    "重庆": "重庆市",
    "河北": "河北省",
    "山西": "山西省",
    "辽宁": "辽宁省",
    "吉林": "吉林省",
    "黑龙江": "黑龙江省",
    "江苏": "江苏省",
    "浙江": "浙江省",
    "安徽": "安徽省",
    "福建": "福建省",
    "江西": "江西省",
    "山东": "山东省",
    "河南": "河南省",
    "湖北": "湖北省",
    "湖南": "湖南省",
    "广东": "广东省",
    "海南": "海南省",
    "四川": "四川省",
    "贵州": "贵州省",
    "云南": "云南省",
    "陕西": "陕西省",
    "甘肃": "甘肃省",
    "青海": "青海省",
    "台湾": "台湾省",
    "内蒙古": "内蒙古自治区",
    "广西": "广西壮族自治区",
    "西藏": "西藏自治区",
    "宁夏": "宁夏回族自治区",
    "新疆": "新疆维吾尔自治区",
    "香港": "香港特别行政区",
    "澳门": "澳门特别行政区",
}

# Province codes found in raw quotes and the short names.
CODE_TO_PROVINCE = {
    "gansu": "甘肃",
    "shandong": "山东",
    "shanxi": "山西",
    "xinjiang": "新疆",
    "hubei": "湖北",
    "anhui": "安徽",
    "jiangsu": "江苏",
    "hebei": "河北",
    "zhejiang": "浙江",
    "beijing": "北京",
    "sichuan": "四川",
    "liaoning": "辽宁",
    "henan": "河南",
    "tianjin": "天津",
    "neimenggu": "内蒙古",
    "jiangxi": "江西",
    "hunan": "湖南",
    "yunnan": "云南",
    "guangdong": "广东",
    "heilongjian": "黑龙江",
    "ningxia": "宁夏",
    "shan_xi": "陕西",
    "fujian": "福建",
    "chongqing": "重庆",
    "guizhou": "贵州",
    "jilin": "吉林",
    "guangxi": "广西",
    "xizang": "西藏",
    "hainan": "海南",
    "qinghai": "青海",
    "shanghai": "上海",
    "xicang": "西藏",
}

# Code alias accepted wherever a province name is expected.
ALIAS_TO_PROVINCE = {
    "xicang": "西藏",
}

# Regions left out of every analysis, and names that mean "no province".
EXCLUDED_REGIONS = ("台湾", "香港", "澳门", "zhongguo")
UNKNOWN_PROVINCES = ("未知", "", "zhongguo", "中国")


NAME_TO_CODE = LISTING_VARIETY_CODES | QUOTE_VARIETY_CODES
CODE_TO_NAME = {code: name for codes in (LISTING_VARIETY_CODES, QUOTE_VARIETY_CODES) for name, code in codes.items()}
FULL_TO_SHORT = {full: short for short, full in SHORT_TO_FULL.items()}


def dim_frame(spark: SparkSession, mapping: dict[str, str]) -> DataFrame:
    """A dictionary as a (key, value) DataFrame of fixed, known size."""
    return literal_frame(spark, list(mapping.items()), "dim_key", "dim_value")


def literal_frame(spark: SparkSession, rows: list[tuple[str, ...]], *names: str) -> DataFrame:
    """Constant string rows as an inline table, whose size the planner knows exactly."""
    quoted = ", ".join("(" + ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {quoted} AS t({', '.join(names)})")


def with_lookup(df: DataFrame, mapping: dict[str, str], key: Column, out: str, keep_unmapped: bool) -> DataFrame:
    """Add ``out`` = mapping[key] by a broadcast join on a fixed dictionary.

    The broadcast side is one of the constants above (at most 49 rows), so its
    size does not depend on the data.
    """
    dim = F.broadcast(dim_frame(df.sparkSession, mapping))
    keyed = df.withColumn("_dim_probe", key)
    hit = keyed.join(dim, keyed["_dim_probe"] == dim["dim_key"], "left")
    value = F.coalesce("dim_value", "_dim_probe") if keep_unmapped else F.col("dim_value")
    return hit.withColumn(out, value).drop("_dim_probe", "dim_key", "dim_value")


def province_forms(province: str) -> list[str]:
    """Spellings under which a requested province may be stored."""
    short = FULL_TO_SHORT.get(province, province)
    return [province] if short == province else [province, short]


def variety_forms(variety: str) -> list[str]:
    """Spellings under which a requested variety may be stored: name and codes."""
    name = CODE_TO_NAME.get(variety, variety)
    codes = [code for code, n in CODE_TO_NAME.items() if n == name]
    return list(dict.fromkeys([variety, name, *codes]))


def is_province(c: Column, province: str) -> Column:
    return c.isin(*province_forms(province))


def is_variety(c: Column, variety: str) -> Column:
    return c.isin(*variety_forms(variety))
