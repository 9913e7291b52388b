"""Tables as they were, from what they are and their audit log: at a time, or without a run.

Entries are taken back, the newest first, without walking through them: what a field was before is told by the first entry after the last
one that stays. A set, edit or fill has the value before and after; a create made its row; a merge has the merged person's row before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstone.sources.storage import settled

FIELD_CHANGES = ("set", "edit", "fill")


def taken_back(table: DataFrame, kind: str, log: DataFrame, undone: Column, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """table (id, fields and more) without the undone entries of a log (entity_kind, entity_id, field, change_kind, before_json, after_json,
    at, seq and what `undone` asks for), and conflicts (entity_id, field, reason).

    A field whose last entry is undone becomes what it was before the undone ones at its end; one that was changed later by an entry that
    stays keeps its value, which is a conflict: "changed later". An undone create removes its row, unless an entry that stays changed it
    after: "row changed later". An undone merge brings the merged person's row back, unless its id is there: "id is there".

    Defined results: entries of equal at and seq go by change_kind; an entry whose value before is null or lacking makes the field null; a null
    `undone` counts as false; what a log doesn't say (rows' confidences, edges that moved, columns that aren't in fields) stays as it
    is, and a row that comes back has what its entry has; entries of rows that aren't there do nothing."""
    entries = settled(log.filter(F.col("entity_kind") == kind).select("entity_id", "field", "change_kind", "before_json", F.struct("at", "seq", "change_kind").alias("pos"), F.coalesce(undone, F.lit(False)).alias("undone")))
    back = entries.filter(F.col("undone") & (F.col("change_kind") == "merge")).select("pos", F.from_json("before_json", table.schema).alias("row")).filter("row.id IS NOT NULL")
    back = back.groupBy("row.id").agg(F.min_by("row", "pos").alias("row"))
    clash = back.join(table.select("id"), "id", "left_semi").select(F.col("id").alias("entity_id"), F.lit(None).cast("string").alias("field"), F.lit("id is there").alias("reason"))
    rows = table.unionByName(back.join(table.select("id"), "id", "left_anti").select("row.*"))

    changes = entries.filter(F.col("field").isin(fields) & F.col("change_kind").isin(*FIELD_CHANGES))
    last = changes.groupBy("entity_id", "field").agg(F.max(F.when(~F.col("undone"), F.col("pos"))).alias("kept"), F.max(F.when(F.col("undone"), F.col("pos"))).alias("gone")).filter("gone IS NOT NULL")
    last = settled(last)
    ends = changes.filter("undone").join(last, ["entity_id", "field"]).filter(F.col("kept").isNull() | (F.col("pos") > F.col("kept")))
    was = ends.groupBy("entity_id", "field").agg(F.min_by(F.struct(F.get_json_object("before_json", "$.value").alias("value")), "pos").alias("was"))
    wide = was.groupBy(F.col("entity_id").alias("id")).pivot("field", fields).agg(F.first("was")).select("id", *(F.col(f).alias(f"_was_{f}") for f in fields))
    rows = rows.join(wide, "id", "left").select(*(F.when(F.col(f"_was_{c}").isNotNull(), F.col(f"_was_{c}.value").cast(table.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in table.columns))
    later = last.filter("kept > gone").select("entity_id", "field", F.lit("changed later").alias("reason"))

    made = entries.filter(F.col("undone") & (F.col("change_kind") == "create")).groupBy("entity_id").agg(F.max("pos").alias("made"))
    touched = made.join(entries.filter(~F.col("undone")).select("entity_id", "pos"), "entity_id").filter("pos > made").select("entity_id").distinct()
    touched = settled(touched)
    rows = rows.join(made.join(touched, "entity_id", "left_anti").select(F.col("entity_id").alias("id")), "id", "left_anti").select(*table.columns)
    stays = touched.select("entity_id", F.lit(None).cast("string").alias("field"), F.lit("row changed later").alias("reason"))
    return rows, clash.unionByName(later).unionByName(stays)


def as_of(table: DataFrame, kind: str, log: DataFrame, at: Column, fields: list[str]) -> DataFrame:
    """table as it was at a time, entries of that time included."""
    return taken_back(table, kind, log, F.col("at") > at, fields)[0]


def without_run(table: DataFrame, kind: str, log: DataFrame, run: str, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """table without what a run changed, and where that can't be taken back. log has the column run."""
    return taken_back(table, kind, log, F.col("run") == run, fields)
