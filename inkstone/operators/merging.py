"""Field-level merges into canonical rows, retargeting with collisions, history, conflicts, curated merges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkstone.operators.rows import first_rows
from inkstone.operators.timeline import ranked
from inkstone.sources.storage import settled

# Ranks of a date's precision and the confidence margins of the merge rules.
PRECISION = {"point": 3, "circa": 2, "range": 1}
MARGIN = 0.1


def merge_date(current: Column, new: Column) -> Column:
    """The winner of two struct<value: date, confidence>: the more precise one wins with a confidence up to 0.1 lower,
    else the higher confidence; ties go to the current one. Null, or without value: the other."""
    rank = lambda d: F.when(d["value"]["uncertainty"] == "circa", 2).when(d["value"]["uncertainty"] == "range", 1).when(d["value"]["uncertainty"].isNull() | (d["value"]["uncertainty"] == "point"), 3).otherwise(0)
    confidence = lambda d: F.coalesce(d["confidence"], F.lit(0.0))
    return (
        F.when(current["value"].isNull(), new)
        .when(new["value"].isNull(), current)
        .when((rank(new) > rank(current)) & (confidence(new) >= confidence(current) - MARGIN), new)
        .when((rank(current) > rank(new)) & (confidence(current) >= confidence(new) - MARGIN), current)
        .when(confidence(new) > confidence(current), new)
        .otherwise(current)
    )


def merge_scalar(old: Column, old_confidence: Column, new: Column, new_confidence: Column, curated: Column, conflicts: bool = True, equal: Column | None = None) -> Column:
    """keep, set or conflict. A curated value is never overwritten; a new value needs more than 0.1 above the old
    confidence. Without conflicts (places and states) there is no guard of curated values, and what would conflict is kept."""
    same = (old == new) if equal is None else equal
    otherwise = "conflict" if conflicts else "keep"
    tried = F.when(new.isNull(), "keep").when(old.isNull(), "set").when(same, "keep")
    if conflicts:
        tried = tried.when(curated, "conflict")
    return tried.when(new_confidence > old_confidence + MARGIN, "set").otherwise(otherwise)


def _step(a: Column, r: Column, curated: Column, equal: Callable[[Column, Column], Column] | None) -> Column:
    same = None if equal is None else equal(a["value"], r["value"])
    return merge_scalar(a["value"], a["confidence"], r["value"], r["confidence"], curated, equal=same)


def applied(proposals: DataFrame, keys: list[str], order: list[str], start: DataFrame | None = None, equal: Callable[[Column, Column], Column] | None = None, most: int = 4_000) -> DataFrame:
    """Each proposal (keys, order, value, confidence) with what it does after the ones before it in order: action (keep, set or
    conflict) and the old_value and old_confidence that it met. start: keys, value, confidence and curated of what was there.

    A key's proposals are folded as one sorted array. A key of more than `most` isn't gathered: as a confidence has to rise by
    MARGIN to be set, few are, and each turn finds the next one of every such key as a minimum; then each proposal is joined
    with the value that held at its time."""
    kind = proposals.schema["value"].dataType.simpleString()
    if start is None:
        start = proposals.select(*keys).limit(0).select(*keys, F.lit(None).cast(kind).alias("value"), F.lit(0.0).alias("confidence"), F.lit(False).alias("curated"))
    begun = start.select(*keys, F.struct("value", F.coalesce("confidence", F.lit(0.0)).alias("confidence")).alias("_start"), F.coalesce("curated", F.lit(False)).alias("_curated"))
    nothing = F.struct(F.lit(None).cast(kind).alias("value"), F.lit(0.0).alias("confidence"))
    with_start = lambda df: df.join(begun, keys, "left").withColumn("_start", F.coalesce("_start", nothing)).withColumn("_curated", F.coalesce("_curated", F.lit(False)))
    rows = proposals.select(*keys, F.struct(*order).alias("pos"), "value", F.col("confidence").cast("double").alias("confidence"))
    hot = settled(rows.groupBy(*keys).count().filter(F.col("count") > most).select(*keys))
    few = rows if not hot.limit(1).count() else rows.join(hot, keys, "left_anti")

    def folded(held: Column, r: Column) -> Column:
        return F.when(_step(F.element_at(held, -1), r, F.col("_curated"), equal) == "set", F.concat(held, F.array(r))).otherwise(held)

    # The values that ever held, few; each proposal then meets the last one before it.
    listed = few.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("pos", "value", "confidence"))).alias("rows"))
    first = F.struct(F.lit(None).cast(rows.schema["pos"].dataType).alias("pos"), F.col("_start.value").alias("value"), F.col("_start.confidence").alias("confidence"))
    held = with_start(listed).withColumn("_held", F.aggregate("rows", F.array(first), folded)).select(*keys, "_curated", "_held", F.explode("rows").alias("r"))
    got = held.withColumn("_met", F.element_at(F.filter("_held", lambda h: h["pos"].isNull() | (h["pos"] < F.col("r.pos"))), -1))
    got = got.select(*keys, "r.*", _step(F.col("_met"), F.col("r"), F.col("_curated"), equal).alias("action"), F.col("_met.value").alias("old_value"), F.col("_met.confidence").alias("old_confidence"))
    if few is not rows:
        got = got.unionByName(_applied_hot(with_start(rows.join(hot, keys, "left_semi")), keys, equal))
    return got.select(*keys, "pos.*", "value", "confidence", "action", "old_value", "old_confidence")


def _applied_hot(rows: DataFrame, keys: list[str], equal: Callable[[Column, Column], Column] | None) -> DataFrame:
    rows = settled(rows)
    none = F.lit(None).cast(rows.schema["pos"].dataType)
    state = settled(rows.groupBy(*keys).agg(F.first("_start").alias("held"), F.first("_curated").alias("curated")).withColumn("since", none))
    history, active = state, rows.drop("_start", "_curated")
    while True:
        # What isn't above the confidence by MARGIN now won't be later.
        met = active.join(state, keys).filter((F.col("since").isNull() | (F.col("pos") > F.col("since"))) & (F.col("held.value").isNull() | (F.col("confidence") > F.col("held.confidence") + MARGIN)))
        met = settled(met)
        action = _step(F.col("held"), F.struct("value", "confidence"), F.col("curated"), equal)
        state = settled(met.filter(action == "set").groupBy(*keys).agg(F.min_by(F.struct("value", "confidence"), "pos").alias("held"), F.first("curated").alias("curated"), F.min("pos").alias("since")))
        if not state.limit(1).count():
            break
        history, active = history.unionByName(state), met.select(*active.columns)
    until = F.lead("since").over(Window.partitionBy(*keys).orderBy(F.col("since").asc_nulls_first()))  # a row for each value that ever held
    spans = history.withColumn("until", until)
    got = rows.drop("_start", "_curated").join(spans, keys).filter((F.col("since").isNull() | (F.col("pos") > F.col("since"))) & (F.col("until").isNull() | (F.col("pos") <= F.col("until"))))
    return got.select(*keys, "pos", "value", "confidence", _step(F.col("held"), F.struct("value", "confidence"), F.col("curated"), equal).alias("action"), F.col("held.value").alias("old_value"), F.col("held.confidence").alias("old_confidence"))


def outcome(labelled: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """keys, value, confidence (of the last proposal that was set, or null), n_set and n_conflict, of applied()'s rows."""
    n = lambda action: F.sum((F.col("action") == action).cast("int")).cast("int")
    last = F.max(F.when(F.col("action") == "set", F.struct(*order, "value", "confidence")))
    return labelled.groupBy(*keys).agg(last.alias("_last"), n("set").alias("n_set"), n("conflict").alias("n_conflict")).select(*keys, "_last.value", F.coalesce("_last.confidence", F.lit(0.0)).alias("confidence"), "n_set", "n_conflict")


def fold_scalars(proposals: DataFrame, keys: list[str], order: list[str], value: str = "value", confidence: str = "confidence", most: int = 4_000) -> DataFrame:
    """Applies each key's proposals in order, each to the outcome of the ones before: keys, value, confidence (of the
    winner), n_set and n_conflict. A key's proposals are the runs that mention one field of one entity."""
    return outcome(applied(proposals.select(*keys, *order, F.col(value).alias("value"), F.col(confidence).alias("confidence")), keys, order, most=most), keys, order)


def retarget(edges: DataFrame, remap: DataFrame, column: str, key: list[str], confidence: str = "confidence", order: list[str] | None = None) -> DataFrame:
    """Rewrites ids of a column by remap (old_id, new_id) and keeps one row of each key: of higher confidence, ties
    to the row that wasn't rewritten, then by `order`."""
    moved = edges.join(remap, edges[column] == remap["old_id"], "left").withColumn("_moved", F.col("old_id").isNotNull()).withColumn(column, F.coalesce("new_id", column)).drop("old_id", "new_id")
    best = Window.partitionBy(*key).orderBy(F.desc(confidence), "_moved", *(order or []))
    return moved.withColumn("_n", F.row_number().over(best)).filter("_n = 1").drop("_n", "_moved")


def without_self_loops(edges: DataFrame, a: str, b: str) -> DataFrame:
    return edges.filter(~F.col(a).eqNullSafe(F.col(b)))


def latest(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in an append-only log."""
    last = Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in order))
    return events.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n")


def field_history(log: DataFrame) -> DataFrame:
    """Field-level entries of an audit log in order: value and confidence before and after, and the change's number."""
    get = lambda c, p: F.get_json_object(c, f"$.{p}")
    got = log.filter("field IS NOT NULL").withColumns({f"{w}_{p}": get(f"{w}_json", p) for w in ("before", "after") for p in ("value", "confidence")})
    return ranked(got, ["entity_kind", "entity_id", "field"], ["at", "seq"], "change")


def inverse_conflicts(incoming: DataFrame, known: DataFrame, a: str, b: str, kind: str, directional: list[str]) -> DataFrame:
    """Incoming directed edges whose reverse is known (or came earlier, by seq) while they themselves are not."""
    turned = known.select(F.col(a).alias(b), F.col(b).alias(a), kind, F.lit(-1).cast("long").alias("_seq")).unionByName(incoming.select(F.col(a).alias(b), F.col(b).alias(a), kind, F.col("seq").cast("long").alias("_seq")))
    first = turned.groupBy(a, b, kind).agg(F.min("_seq").alias("_seq"))
    fresh = incoming.filter(F.col(kind).isin(directional)).join(known.select(a, b, kind), [a, b, kind], "left_anti")
    return fresh.join(first, [a, b, kind]).filter("_seq < seq").drop("_seq")


def conflict_rows(merged: DataFrame) -> DataFrame:
    """A conflict's variants as JSON with the index of the better one."""
    variant = lambda v, c, s: F.struct(F.col(v).alias("value"), F.col(c).alias("confidence"), F.col(s).alias("source"))
    return merged.withColumn("variants_json", F.to_json(F.array(variant("old_value", "old_confidence", "old_source"), variant("new_value", "new_confidence", "new_source")))).withColumn("best_idx", F.when(F.col("old_confidence") >= F.col("new_confidence"), 0).otherwise(1))


def load_edges(existing: DataFrame, incoming: DataFrame, key: list[str], kind: str | None = None, allowed: list[str] | None = None) -> DataFrame:
    """Edges to append: of allowed kinds, the first (by seq, then the rest) of each key, absent before (null keys equal)."""
    good = incoming if kind is None else incoming.filter(F.col(kind).isin(allowed))
    good = first_rows(good, key)
    there = existing.select(*(F.col(k).alias(f"_{k}") for k in key)).distinct()
    same = [good[k].eqNullSafe(there[f"_{k}"]) for k in key]
    return good.join(there, same, "left_anti")


def split_person(persons: DataFrame, variants: DataFrame, person: str, new_id: str, new_name: str, peeled: list[str]) -> tuple[DataFrame, DataFrame]:
    """A new person with some of another's variants; relations stay. A variant that isn't there raises."""
    held = {r["variant"] for r in variants.filter(F.col("person_id") == person).filter(F.col("variant").isin(peeled)).select("variant").collect()}
    if missing := [v for v in peeled if v not in held]:
        raise ValueError(f"no such variants: {', '.join(missing)}")
    made = persons.sparkSession.createDataFrame([(new_id, new_name, 1.0)], "id string, canonical_name string, confidence double")
    moved = variants.withColumn("person_id", F.when((F.col("person_id") == person) & F.col("variant").isin(peeled), new_id).otherwise(F.col("person_id")))
    return persons.unionByName(made, allowMissingColumns=True), moved
