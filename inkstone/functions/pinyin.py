"""Toneless pinyin of names, for search. The characters of all names are a bounded list, which the driver transliterates
with the ICU library that Spark ships; names are then joined with it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = "Han-Latin; Latin-ASCII; Lower"


def with_pinyin(names: DataFrame, column: str, out: str = "pinyin") -> DataFrame:
    """names with the joined lower-case syllables of a column; other characters stay, lower-cased; null and empty stay."""
    spark = names.sparkSession
    distinct = names.select(F.col(column).alias("_name")).filter("_name <> ''").distinct()
    chars = distinct.select("_name", F.posexplode(F.split("_name", "")).alias("_at", "_char"))
    han = [r[0] for r in chars.filter(F.col("_char").rlike(r"\p{IsHan}")).select("_char").distinct().collect()]
    latin = spark._jvm.com.ibm.icu.text.Transliterator.getInstance(RULES)
    known = spark.createDataFrame([(c, latin.transliterate(c).replace(" ", "")) for c in han], "_char string, _latin string")
    spelled = chars.join(F.broadcast(known), "_char", "left").withColumn("_latin", F.coalesce("_latin", F.lower("_char")))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("_at", "_latin"))), lambda x: x["_latin"])
    words = spelled.groupBy("_name").agg(F.array_join(ordered, "").alias(out))
    return names.join(words, names[column] == words["_name"], "left").drop("_name").withColumn(out, F.coalesce(out, column))
