"""Chinese regnal, era and relative dates as struct columns. Years BCE are positive: a larger one is earlier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE = "struct<year_bce:int,year_bce_end:int,uncertainty:string,original:string,era:string,inference_kind:string,relative_anchor_event_id:string>"

# First and last years of reigns, BCE.
ZHOU = {
    "平": (770, 720), "桓": (719, 697), "庄": (696, 682), "釐": (681, 677), "惠": (676, 652), "襄": (651, 619), "顷": (618, 613),
    "匡": (612, 607), "定": (606, 586), "简": (585, 572), "灵": (571, 545), "景": (544, 520), "敬": (519, 476),
}
LU = {
    "隐": (722, 712), "桓": (711, 694), "庄": (693, 662), "闵": (661, 660), "僖": (659, 627), "文": (626, 609),
    "宣": (608, 591), "成": (590, 573), "襄": (572, 542), "昭": (541, 510), "定": (509, 495), "哀": (494, 468),
}
# Eras by name, their first and last years.
ERAS = {
    "春秋初": ("春秋", 770, 720), "春秋早期": ("春秋", 770, 700), "春秋中期": ("春秋", 700, 600), "春秋末": ("春秋", 510, 476), "春秋晚期": ("春秋", 550, 476),
    "战国初": ("战国", 475, 430), "战国早期": ("战国", 475, 400), "战国中期": ("战国", 400, 300), "战国末": ("战国", 260, 221), "战国晚期": ("战国", 300, 221),
}
# What relative words add to a year BCE.
OFFSETS = {"其年": 0, "明年": -1, "次年": -1, "去年": 1, "前年": 1, "是岁": 0, "是年": 0}
# States whose names begin a reign, and one-character names of states for counting.
STATES = {
    "周": "sta:zhou", "鲁": "sta:lu", "晋": "sta:jin", "齐": "sta:qi", "楚": "sta:chu", "秦": "sta:qin", "宋": "sta:song", "郑": "sta:zheng",
    "卫": "sta:wei", "陈": "sta:chen", "蔡": "sta:cai", "曹": "sta:cao", "燕": "sta:yan", "吴": "sta:wu", "越": "sta:yue", "申": "sta:shen",
}
NUMERALS = "元一二三四五六七八九十"


def literal_map(values: dict, kind: str) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair)).cast(f"map<string,{kind}>")


def chinese_number(text: Column) -> Column:
    """元 (1), 一 to 十, 十x, x十 and x十y as int; null for anything else."""
    units = literal_map({c: i for i, c in enumerate("一二三四五六七八九", 1)} | {"元": 1}, "int")
    tens, ones = F.substring_index(text, "十", 1), F.substring_index(text, "十", -1)
    digit = lambda x: F.try_element_at(units, x)
    with_ten = F.when(tens == "", 10).otherwise(digit(tens) * 10) + F.when(ones == "", 0).otherwise(digit(ones))
    plain = "^[一二三四五六七八九]$"
    return F.when((text == "元") | text.rlike(plain), digit(text)).when(text.rlike("^[一二三四五六七八九]?十[一二三四五六七八九]?$"), with_ten)


def date_struct(year: Column, kind: str, original: Column, era: Column, uncertainty: str = "point", end: Column | None = None) -> Column:
    return F.struct(
        year.cast("int").alias("year_bce"), (F.lit(None) if end is None else end).cast("int").alias("year_bce_end"), F.lit(uncertainty).alias("uncertainty"), original.alias("original"),
        era.cast("string").alias("era"), F.lit(kind).alias("inference_kind"), F.lit(None).cast("string").alias("relative_anchor_event_id"),
    )


def _royal(text: Column, pattern: str, reigns: dict[str, tuple[int, int]], kind: str) -> Column:
    ruler, number = F.regexp_extract(text, pattern, 1), chinese_number(F.regexp_extract(text, pattern, 2))
    year = F.try_element_at(literal_map({k: a for k, (a, _) in reigns.items()}, "int"), ruler) - (number - 1)
    return F.when(year.isNotNull(), date_struct(year, kind, text, F.lit("春秋")))


def lu_date(text: Column) -> Column:
    return _royal(text, f"^鲁?({'|'.join(LU)})公?([{NUMERALS}]+)年$", LU, "explicit_reign_lu")


def zhou_date(text: Column) -> Column:
    return _royal(text, f"^周({'|'.join(ZHOU)})王?([{NUMERALS}]+)年$", ZHOU, "explicit_reign_zhou")


def era_date(text: Column) -> Column:
    era, first, last = (F.try_element_at(literal_map({k: v[i] for k, v in ERAS.items()}, kind), text) for i, kind in enumerate(("string", "int", "int")))
    return F.when(era.isNotNull(), date_struct(F.floor((first + last) / 2), "era_only", text, era, "range", last))


def relative_date(text: Column, anchor_year: Column, anchor_era: Column) -> Column:
    offset = F.try_element_at(literal_map(OFFSETS, "int"), F.regexp_replace(text, "^是[春夏秋冬]", "是年"))
    return F.when(offset.isNotNull() & anchor_year.isNotNull(), date_struct(anchor_year + offset, "relative_to_prior_event", text, anchor_era))


def other_reigns(dates: DataFrame, rulers: DataFrame, column: str = "original") -> DataFrame:
    """Adds reign_year and reign_out_of_range for dates such as a state's name, a ruler's name and a year. rulers:
    state_id, ruler_id, posthumous_name, given_name, reign_start_bce, reign_end_bce. The longer form of the name is
    tried first; a name of no ruler or of several gives null."""
    pattern = f"^({'|'.join(STATES)})(\\S+?)([{NUMERALS}]+)年$"
    state, name, number = (F.regexp_extract(column, pattern, i) for i in (1, 2, 3))
    keyed = dates.withColumn("_state", F.try_element_at(literal_map(STATES, "string"), state)).withColumn("_n", chinese_number(number))
    keyed = keyed.withColumn("_state", F.when(~F.col("_state").isin("sta:lu", "sta:zhou"), F.col("_state"))).withColumn("_long", F.concat(state, name)).withColumn("_short", name)
    aliases = rulers.select("state_id", "ruler_id", "reign_start_bce", "reign_end_bce", F.explode(F.array_distinct(F.array("ruler_id", "posthumous_name", "given_name"))).alias("alias")).filter("alias IS NOT NULL")
    single = aliases.groupBy("state_id", "alias").agg(F.countDistinct("ruler_id").alias("n"), F.min("reign_start_bce").alias("start"), F.min("reign_end_bce").alias("end")).filter("n = 1").drop("n")
    for which in ("long", "short"):
        keyed = keyed.join(single.select(F.col("state_id").alias("_state"), F.col("alias").alias(f"_{which}"), F.col("start").alias(f"_start_{which}"), F.col("end").alias(f"_end_{which}")), ["_state", f"_{which}"], "left")
    year = F.coalesce("_start_long", "_start_short") - (F.col("_n") - 1)
    return keyed.withColumn("reign_year", year).withColumn("reign_out_of_range", year < F.coalesce("_end_long", "_end_short")).select(*dates.columns, "reign_year", "reign_out_of_range")


def parse_date(text: Column, anchor_year: Column | None = None, anchor_era: Column | None = None, other_year: Column | None = None) -> Column:
    """A date's struct: of Lu, of Zhou, of another state (by its year from other_reigns), relative, of an era, or unknown."""
    none = F.lit(None)
    other = none if other_year is None else F.when(other_year.isNotNull(), date_struct(other_year, "explicit_reign_other", text, F.lit("春秋")))
    relative = none if anchor_year is None else relative_date(text, anchor_year, none if anchor_era is None else anchor_era)
    tried = [x for x in (lu_date(text), zhou_date(text), other, relative, era_date(text)) if x is not none]
    return F.coalesce(*tried, date_struct(none, "unknown", text, none))


def walk_offset(text: Column, later: Column | None = None) -> Column:
    """What a relative date adds to the rolling year: an explicit number of years later, a word, or 0 for a note in
    brackets; null for other texts."""
    got = F.coalesce(F.try_element_at(literal_map(OFFSETS, "int"), text), F.when(F.trim(text).rlike(r"(?s)^\(.+\)$"), F.lit(0)))
    return got if later is None else F.coalesce(-later, got)
