"""Scans over partitions of any size against loops."""

import random

import pytest
from pyspark.sql import functions as F

from inkstone.operators import timeline


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small ranges stay apart here, as large ones do elsewhere."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("chapters", [1, 3, 200])
def test_years_roll_across_ranges(spark, chapters):
    """One partition with all rows, few and many; null partitions; no anchor at first; unknown offsets."""
    rng = random.Random(chapters)
    rows = []
    for k in range(3000):
        chapter = rng.choice([None, *range(chapters)]) if chapters > 1 else 0
        relative = rng.random() < 0.9 or k < 500
        rows.append((chapter, k, relative, None if rng.random() < 0.2 else rng.randrange(-800, -200), None if rng.random() < 0.1 else rng.randrange(-3, 4)))
    expected, rolling = {}, {}
    for c, k, relative, year, offset in rows:
        if not relative:
            expected[k] = year
            rolling[c] = rolling.get(c) if year is None else year
        elif offset is None or rolling.get(c) is None:
            expected[k] = None
        else:
            rolling[c] += offset
            expected[k] = rolling[c]
    df = spark.createDataFrame(rows, "chapter int, pos int, is_relative boolean, year_bce int, offset int").repartition(5)
    got = timeline.walk_relative(df, ["chapter"], ["pos"])
    assert got.columns == [*df.columns, "resolved_year"]
    assert {r["pos"]: r["resolved_year"] for r in got.collect()} == expected


def test_a_partition_with_all_rows_is_in_several_tasks(spark):
    rows = spark.range(4000).select(F.lit("all").alias("k"), (F.col("id") * 7919 % 4000).alias("v"), F.lit(1).alias("place_"))
    assert timeline.ranged(rows, ["k"], ["v"]).select("_range").distinct().count() > 1
    got = timeline.ranked(rows, ["k"], [F.desc("v")])
    assert {r["v"]: r["place"] for r in got.collect()} == {v: 4000 - v for v in range(4000)}
    assert timeline.ranked(rows, ["k"], ["v"], first=3).count() == 3 and timeline.ranked(rows.limit(0), ["k"], ["v"]).count() == 0


def test_numbers_within_partitions(spark):
    rng = random.Random(9)
    rows = [(rng.choice([None, "a", "b", "c"]), rng.randrange(10**6), k) for k in range(2000)]
    got = timeline.ranked(spark.createDataFrame(rows, "k string, v int, i int").repartition(6), ["k"], ["v", "i"])
    expected = {}
    for key in {r[0] for r in rows}:
        expected |= {r[2]: n + 1 for n, r in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: r[1:]))}
    assert {r["i"]: r["place"] for r in got.collect()} == expected
