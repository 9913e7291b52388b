"""Who held what, and when no one did: sweeps over tenures, and each tenure's predecessor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkstone.operators.timeline import ranged, with_carried


def running(rows: DataFrame, partition: list[str], order: list, value: Column, of, name: str, both) -> DataFrame:
    """rows, with `_range`, and in `name` the sum or maximum (`of`; `both` composes two of them) of value over the partition's rows up to each in the
    order. Tasks scan ranges of the order; what a partition's earlier ranges come to is carried on, so one may hold all rows."""
    got = ranged(rows.withColumn("_value", value), partition, order)
    own = ["_range", *partition]
    ends = got.groupBy(*own).agg(of("_value").alias("_whole"))
    earlier = Window.partitionBy(*partition).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", of("_whole").over(earlier))
    within = Window.partitionBy(*own).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    got = with_carried(got.withColumn(name, of("_value").over(within)), carried, partition, "_carried")
    return got.withColumn(name, F.coalesce(both(F.col(name), F.col("_carried")), F.col(name), F.col("_carried"))).drop("_value", "_carried")


def _valid(tenures: DataFrame, start: str, end: str) -> DataFrame:
    return tenures.filter(F.col(start) < F.col(end))


def holder_spans(tenures: DataFrame, partition: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """partition, start, end, holders and kind (vacant, held or shared) of the longest spans of one number of holders, from a partition's
    first tenure to the end of its last. A tenure holds from its start until just before its end.

    One row goes in at each end of a tenure, however long it is or however many overlap. Defined results: tenures with a null end, or whose
    end isn't behind their start, take no part; repeated rows are several holders; partitions may be null; no tenures give no rows."""
    ends = F.explode(F.array(F.struct(F.col(start).alias("_year"), F.lit(1).alias("_step")), F.struct(F.col(end).alias("_year"), F.lit(-1).alias("_step"))))
    points = _valid(tenures, start, end).select(*partition, ends.alias("_end")).groupBy(*partition, F.col("_end._year").alias("_year")).agg(F.sum("_end._step").alias("_step"))
    swept = running(points.filter("_step <> 0"), partition, ["_year"], F.col("_step"), F.sum, "holders", lambda a, b: a + b)
    own = ["_range", *partition]
    first = swept.groupBy(*own).agg(F.min("_year").alias("_first"))
    following = first.withColumn("_next", F.lead("_first").over(Window.partitionBy(*partition).orderBy("_range")))
    until = F.coalesce(F.lead("_year").over(Window.partitionBy(*own).orderBy("_year")), F.col("_next"))
    # Of a range's partitions the last alone goes on in a later range.
    spans = with_carried(swept, following, partition, "_next").withColumn("_until", until).filter("_until IS NOT NULL")
    kind = F.when(F.col("holders") == 0, "vacant").when(F.col("holders") == 1, "held").otherwise("shared")
    return spans.select(*partition, F.col("_year").alias(start), F.col("_until").alias(end), "holders", kind.alias("kind"))


def predecessors(tenures: DataFrame, partition: list[str], key: str = "id", start: str = "start", end: str = "end") -> DataFrame:
    """tenures with predecessor (the key of the partition's tenure that ended last before or when each starts; of several the one that started
    last, then the greatest key) and vacancy (how long after its end), both null for a first one.

    Ends and starts are scanned in one order, ends first. Defined results: tenures with a null end, or whose end isn't behind their start,
    are nobody's predecessor, and stay with nulls; null partitions are one partition; repeated rows each stay."""
    named = lambda at, is_start, last: F.struct(at.alias("_year"), F.lit(is_start).alias("_is_start"), last.alias("_last"))
    last = F.struct(F.col(end).alias("at"), F.col(start).alias("since"), F.col(key).alias("key"))
    none = F.lit(None).cast(last_type(tenures, key, start, end))
    row = F.struct(*(F.col(f"`{c}`") for c in tenures.columns)).alias("_row")
    ok = F.coalesce(F.col(start) < F.col(end), F.lit(False))
    points = tenures.select(*(F.col(p).alias(f"_by_{p}") for p in partition), row, ok.alias("_ok"), F.explode(F.when(ok, F.array(named(F.col(end), False, last), named(F.col(start), True, none))).otherwise(F.array(named(F.col(start), True, none)))).alias("_p"))
    points = points.select("*", "_p.*").drop("_p")
    by = [f"_by_{p}" for p in partition]
    found = running(points, by, ["_year", "_is_start"], F.col("_last"), F.max, "_found", F.greatest).filter("_is_start")
    known = F.when(F.col("_ok"), F.col("_found"))
    return found.withColumn("_known", known).select("_row.*", F.col("_known.key").alias("predecessor"), (F.col(f"_row.{start}") - F.col("_known.at")).alias("vacancy"))


def last_type(tenures: DataFrame, key: str, start: str, end: str) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in tenures.schema.fields}
    return f"struct<at:{kinds[end]},since:{kinds[start]},key:{kinds[key]}>"
