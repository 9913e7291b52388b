"""Relative dates within a sequence, anchor chains, rosters and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkstone.sources.storage import settled


def ranged(rows: DataFrame, partition: list[str], order: list) -> DataFrame:
    """rows with `_range`, the task that holds them: tasks hold ranges of the order by partition, then order, whatever a partition's size."""
    return settled(rows.repartitionByRange(*partition, *order).withColumn("_range", F.spark_partition_id()))


def with_carried(rows: DataFrame, carried: DataFrame, partition: list[str], name: str) -> DataFrame:
    """rows with the column `name` of carried (_range, partition, name): what earlier ranges hand on to a partition. Only a range's first
    partition has any, so carried has a row a range at most."""
    few = carried.filter(F.col(name).isNotNull()).select(F.col("_range").alias("_at"), *(F.col(p).alias(f"_at_{p}") for p in partition), name)
    same = F.col("_range") == F.col("_at")
    for p in partition:
        same = same & F.col(p).eqNullSafe(F.col(f"_at_{p}"))
    return rows.join(F.broadcast(few), same, "left").drop("_at", *(f"_at_{p}" for p in partition))


def walk_relative(records: DataFrame, partition: list[str], order: list[str], relative: str = "is_relative", year: str = "year_bce", offset: str = "offset") -> DataFrame:
    """Adds resolved_year: a dated record that isn't relative sets the rolling year; each relative one adds its offset to
    it, cascading; one of unknown offset stays null and moves nothing; before any dated record all are null.

    A scan by ranges: each task walks its own range, as if nothing came before; a range's summary (the year at its end, or how
    far it moves one) is composed with those of its partition's earlier ranges, and what comes out is added. So a partition that
    holds all rows is walked by many tasks."""
    step = F.when(F.col(relative), F.coalesce(offset, F.lit(0))).otherwise(0)
    got = ranged(records.withColumns({"_anchor": F.when(~F.col(relative), F.col(year)), "_step": step}), partition, order)
    own = ["_range", *partition]
    got = got.withColumn("_group", F.count("_anchor").over(Window.partitionBy(*own).orderBy(*order)))
    within = Window.partitionBy(*own, "_group").orderBy(*order)
    got = got.withColumns({"_start": F.first("_anchor", ignorenulls=True).over(within), "_moved": F.sum("_step").over(within)})
    last = F.max_by(F.col("_start") + F.col("_moved"), F.struct(*order))
    ends = got.groupBy(*own).agg(F.when(F.max("_group") > 0, last).alias("_end"), F.sum("_step").alias("_total"))
    ranges = Window.partitionBy(*partition).orderBy("_range")
    since = ends.withColumn("_since", F.count("_end").over(ranges))
    after = Window.partitionBy(*partition, "_since").orderBy("_range")
    rolled = F.first("_end", ignorenulls=True).over(after) + F.sum(F.when(F.col("_end").isNull(), F.col("_total")).otherwise(0)).over(after)
    carried = since.withColumn("_rolled", rolled).withColumn("_carried", F.lag("_rolled").over(ranges))
    got = with_carried(got, carried, partition, "_carried")
    base = F.when(F.col("_group") > 0, F.col("_start")).otherwise(F.col("_carried"))
    resolved = F.when(~F.col(relative), F.col(year)).when(F.col(offset).isNotNull(), base + F.col("_moved"))
    return got.withColumn("resolved_year", resolved).select(*records.columns, "resolved_year")


def anchor_terminals(records: DataFrame, key: str, anchor: str) -> DataFrame:
    """key, terminal and depth of each record: the end of its chain of anchors. Each turn doubles the chains' reach, so turns
    are as many as the logarithm of the longest chain. A dangling anchor, or one that leads back, gives terminal null."""
    links = records.select(F.col(key).alias("id"), F.col(anchor).alias("to"))
    ended = links.filter("to IS NULL").select("id", F.col("id").alias("to"), F.lit(0).alias("d"), F.lit(True).alias("done"))
    state = settled(ended.unionByName(links.filter("to IS NOT NULL").select("id", "to", F.lit(1).alias("d"), F.lit(False).alias("done"))))
    for _ in range(1 + state.count().bit_length()):
        if not state.filter("NOT done").limit(1).count():
            break
        further = state.select(F.col("id").alias("to"), F.col("to").alias("_to"), F.col("d").alias("_d"), F.col("done").alias("_done"))
        moved = state.filter("NOT done").join(further, "to").select("id", F.col("_to").alias("to"), (F.col("d") + F.col("_d")).alias("d"), F.col("_done").alias("done"))
        state = settled(state.filter("done").unionByName(moved))
    found = state.filter("done").select("id", F.col("to").alias("terminal"), F.col("d").alias("depth"))
    return links.select("id").join(found, "id", "left").withColumnRenamed("id", key)


def numbered(rows: DataFrame, order: list[str], name: str = "place") -> DataFrame:
    """rows with their number, from 1, in one order over all of them. Tasks sort ranges of the order and number their own; how
    many rows the ranges before have is added."""
    ranges = settled(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counts = ranges.groupBy("_range").count()  # a row for each task
    before = counts.select("_range", (F.sum("count").over(Window.orderBy("_range")) - F.col("count")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranges.withColumn(name, own).join(F.broadcast(before), "_range").withColumn(name, (F.col(name) + F.col("_before")).cast("int")).drop("_range", "_before")


def ranked(rows: DataFrame, partition: list[str], order: list, name: str = "place", first: int | None = None) -> DataFrame:
    """rows with their number, from 1, within each partition, of any size: each task numbers its range, and what the partition's earlier
    ranges have is added; numbered() is for one order over all rows."""
    got = ranged(rows, partition, order)
    own = ["_range", *partition]
    got = got.withColumn(name, F.row_number().over(Window.partitionBy(*own).orderBy(*order)))
    counts = got.groupBy(*own).agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy(*partition).orderBy("_range")) - F.col("_n")).filter("_before > 0")
    got = with_carried(got, before, partition, "_before").withColumn(name, (F.col(name) + F.coalesce("_before", F.lit(0))).cast("int")).select(*rows.columns, name)
    return got if first is None else got.filter(F.col(name) <= first)
