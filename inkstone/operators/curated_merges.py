"""Merges of persons that a curator accepted, as accepting them one after the other would make them.

What an acceptance does depends on those before it: a survivor's fields were filled or edited, a person is gone, a candidate's
status changed. Acceptances that share persons, by however many steps, form a component; components are folded each by itself,
in order, over the few fields that decide. A component of more than `most` acceptances is folded in runs of so many, all
components' next runs at once, so no group grows without bound.

The accepted merges form a forest. Each merged person has its way up, the persons it went into and when; rows that name
persons follow it, and where rows of one key meet, they are held against one another at the merges that bring them together.
Only rows whose key meets another are gathered, one group a key: at most one row for each person of the forest's tree.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkstone.operators.graphs import components
from inkstone.operators.timeline import numbered
from inkstone.sources.storage import settled

# What a curator may edit when merging, and what is filled from the merged person.
EDITABLE = ("gender", "birth_date_json", "death_date_json", "notes", "state_id", "clan_name", "canonical_name")
FILLED = ("gender", "birth_date_json", "death_date_json", "notes", "state_id", "clan_name")
#: Tables of edges: their person columns and their key.
PERSON_EDGES = {
    "event_participants": (("person_id",), ("event_id", "person_id", "role")),
    "person_relations": (("from_person_id", "to_person_id"), ("from_person_id", "to_person_id", "kind")),
    "person_states": (("person_id",), ("person_id", "state_id", "role", "from_date_json")),
}
FIELDS = "array<string>"
JUDGED = f"component string, seq long, mc_id string, into string, out string, from_candidates boolean, reason string, before {FIELDS}, merged {FIELDS}, after {FIELDS}"


def judge(events: list[dict], people: dict[str, list], candidates: dict[str, list], statuses: dict[str, str], fields: list[str]) -> list[tuple]:
    """One component's acceptances in order. people and candidates: the fields of those there, which this changes; statuses: of
    merge candidates. Of each: reason (null if merged), whether the merged one is a candidate, and the fields of the
    survivor before, of the merged one, and of the survivor after."""
    out = []
    for e in events:
        into, gone, mc = e["into"], e["out"], e["mc_id"]
        status = statuses.get(mc, e["status"])
        a = people.get(into)
        of_candidates = gone not in people
        b = candidates.get(gone) if of_candidates else people[gone]
        edits = {x["field"]: x["value"] for x in e["edits"] or ()}
        after, reason = None, None
        if status is None:
            reason = "no such merge candidate"
        elif status != "open":
            reason = f"status is {status}"
        elif a is None or b is None:
            reason = "no such person"
        elif into == gone:
            reason = "a person can't be merged into itself"
        elif barred := sorted(f for f in edits if f not in EDITABLE):
            reason = f"may not be edited: {barred[0]}"
        else:
            after = [edits.get(f, v) for f, v in zip(fields, a, strict=True)]
            differ = [f for f, x, y in zip(fields, after, b, strict=True) if f in FILLED and x is not None and y is not None and x != y]
            if differ:
                reason = f"fields differ: {', '.join(differ)}"
        if reason is None:
            after = [y if x is None and f in FILLED else x for f, x, y in zip(fields, after, b, strict=True)]
            people[into] = after
            statuses[mc] = "merged"
            if not of_candidates:
                del people[gone]
        out.append((e["component"], e["seq"], mc, into, gone, of_candidates if reason is None else None, reason, a, b, after if reason is None else None))
    return out


def _judged(events: DataFrame, states: DataFrame, fields: list[str]) -> DataFrame:
    """events (component, seq, mc_id, into, out, status, edits) and states (component, id, candidate, values) of each component."""

    def fold(own: pa.Table, known: pa.Table) -> pa.Table:
        people: dict[str, list] = {}
        candidates: dict[str, list] = {}
        for r in known.to_pylist():
            (candidates if r["candidate"] else people)[r["id"]] = r["values"]
        rows = judge(sorted(own.to_pylist(), key=lambda e: e["seq"]), people, candidates, {}, fields)
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.string(), *[pa.list_(pa.string())] * 3]
        return pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["component", "seq", "mc_id", "into", "out", "from_candidates", "reason", "before", "merged", "after"])

    return events.groupBy("component").cogroup(states.groupBy("component")).applyInArrow(fold, JUDGED)


def judged_in_order(accepted: DataFrame, queue: DataFrame, people: DataFrame, candidates: DataFrame | None, edits: DataFrame | None, fields: list[str], most: int) -> DataFrame:
    """JUDGED, a row for each row of accepted (mc_id, seq)."""
    pair = accepted.join(queue.select(F.col("id").alias("mc_id"), F.col("target_id").alias("into"), F.col("candidate_id").alias("out"), "status"), "mc_id", "left")
    pair = settled(pair.withColumn("into", F.coalesce("into", F.concat(F.lit("\0"), "mc_id"))).withColumn("out", F.coalesce("out", "into")))
    if edits is not None:
        by_mc = edits.groupBy("mc_id").agg(F.collect_list(F.struct("field", "value")).alias("edits"))  # a row a field
        pair = pair.join(by_mc, "mc_id", "left")
    else:
        pair = pair.withColumn("edits", F.lit(None).cast("array<struct<field:string,value:string>>"))
    named = components(pair, "into", "out")
    events = pair.join(named.withColumnRenamed("id", "into"), "into")
    run = F.floor((F.row_number().over(Window.partitionBy("component").orderBy("seq", "mc_id")) - 1) / most).cast("int")
    events = settled(events.withColumn("run", run))
    values = F.array(*(F.col(f).cast("string") for f in fields))
    state = people.select("id", F.lit(False).alias("candidate"), values.alias("values"))
    if candidates is not None:
        held = [f if f in candidates.columns else None for f in fields]
        state = state.unionByName(candidates.select("id", F.lit(True).alias("candidate"), F.array(*(F.lit(None).cast("string") if f is None else F.col(f).cast("string") for f in held)).alias("values")))
    state = settled(state.join(named, "id"))
    done = None
    for k in range((events.agg(F.max("run")).first()[0] or 0) + 1):
        own = events.filter(F.col("run") == k).drop("run")
        if done is not None:
            # What earlier runs left: survivors' fields, persons that went, candidates that were merged already.
            good = done.filter("reason IS NULL")
            last = good.groupBy(F.col("into").alias("id")).agg(F.max_by("after", "seq").alias("_after"))
            went = good.filter("NOT from_candidates").select(F.col("out").alias("id"))
            mine = state.filter("NOT candidate").join(went, "id", "left_anti").join(last, "id", "left").withColumn("values", F.coalesce("_after", "values")).drop("_after")
            current = mine.unionByName(state.filter("candidate"))
            merged = good.select("mc_id", F.lit("merged").alias("_status")).distinct()
            own = own.join(merged, "mc_id", "left").withColumn("status", F.coalesce("_status", "status")).drop("_status")
        else:
            current = state
        ends = own.select("component", F.explode(F.array("into", "out")).alias("id")).distinct()
        turn = settled(_judged(own, current.join(ends, ["component", "id"], "left_semi"), fields))
        done = turn if done is None else settled(done.unionByName(turn))
    return done


def ways(merges: DataFrame) -> DataFrame:
    """id, root and way (the persons it went into and when, an array of struct<into, seq> in order) of each merged person. merges: out,
    into, seq; each turn doubles the ways' reach."""
    state = settled(merges.select(F.col("out").alias("id"), F.col("into").alias("root"), F.array(F.struct("into", "seq")).alias("way")))
    while True:
        further = state.select(F.col("id").alias("root"), F.col("root").alias("_root"), F.col("way").alias("_way"))
        turn = settled(state.join(further, "root", "left"))
        if not turn.filter("_root IS NOT NULL").limit(1).count():
            return state
        state = turn.select("id", F.coalesce("_root", "root").alias("root"), F.when(F.col("_way").isNotNull(), F.concat("way", "_way")).otherwise(F.col("way")).alias("way"))


def meet(rows: list[dict], columns: list[str]) -> tuple[list[tuple[int, list[str]]], list[tuple[int, list[str]]]]:
    """Rows of one key (each: place, persons, ways, confidence) through the merges that concern them: those that stay and those that
    go, each with the persons it had then. Of two that meet the one of higher confidence stays, the survivor's of equal ones; a row
    between the two persons of a merge goes."""
    events: dict[int, tuple[str, str]] = {}
    for r in rows:
        for person, way in zip(r["persons"], r["ways"], strict=True):
            at = person
            for step in way or []:
                events[step["seq"]] = (at, step["into"])
                at = step["into"]
    held: dict[tuple, dict] = {}
    gone: list[tuple[int, list[str]]] = []
    for r in sorted(rows, key=lambda r: r["place"]):
        key = tuple(r["persons"])
        other = held.get(key)
        if other is not None:  # two rows of one key before any merge
            worse = r if (r["confidence"] or 0.0) <= (other["confidence"] or 0.0) else other
            gone.append((worse["place"], list(key)))
            r = other if worse is r else r
        held[key] = r
    for seq in sorted(events):
        out, into = events[seq]
        for key in [k for k in held if out in k]:
            r = held.pop(key)
            if len(columns) == 2 and set(key) == {out, into}:
                gone.append((r["place"], list(key)))
                continue
            new = tuple(into if p == out else p for p in key)
            other = held.get(new)
            if other is not None:
                stays = (r["confidence"] or 0.0) > (other["confidence"] or 0.0)
                gone.append((other["place"], list(new)) if stays else (r["place"], list(key)))
                r = r if stays else other
            held[new] = r
    return [(r["place"], list(k)) for k, r in held.items()], gone


def moved_rows(table: DataFrame, columns: list[str], key: list[str], way: DataFrame, concerned: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The table after the merges, and the rows that went, as struct `row`, with the names that their persons had then in `persons`."""
    place = F.monotonically_increasing_id()
    rows = table.select(F.struct(*table.columns).alias("row"), *(F.col(c).cast("string").alias(f"key_{c}") for c in key), (F.col("confidence") if "confidence" in table.columns else F.lit(0.0)).cast("double").alias("confidence"), (F.lit(True) if concerned is None else F.coalesce(concerned, F.lit(False))).alias("concerned"))
    for c in columns:
        own = way.select(F.col("id").alias(f"key_{c}"), F.col("root").alias(f"root_{c}"), F.col("way").alias(f"way_{c}"))
        rows = rows.join(own, f"key_{c}", "left")
        rows = rows.withColumns({f"root_{c}": F.when(F.col("concerned"), F.col(f"root_{c}")), f"way_{c}": F.when(F.col("concerned"), F.col(f"way_{c}"))})
    moved = F.lit(False)
    for c in columns:
        moved = moved | F.col(f"root_{c}").isNotNull()
    root = {c: F.coalesce(f"root_{c}", f"key_{c}") for c in columns}
    finals = [f"final_{c}" for c in key]
    rows = rows.withColumn("moved", moved).withColumns({f"final_{c}": root.get(c, F.col(f"key_{c}")) for c in key}).withColumn("place", place)
    rows = settled(rows)
    # Keys where a moved row meets another one, or becomes a loop.
    loop = F.lit(False) if len(columns) == 1 else F.max(F.col("moved") & F.col(f"final_{columns[0]}").eqNullSafe(F.col(f"final_{columns[1]}")))
    met = rows.groupBy(*finals).agg(F.count("*").alias("n"), F.max("moved").alias("any"), loop.alias("loop")).filter("any AND (n > 1 OR loop)").select(*(F.col(c).alias(f"_{c}") for c in finals), F.lit(True).alias("meets"))
    rows = rows.join(met, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in finals], "left")
    alone = rows.filter("meets IS NULL")
    back = lambda c: F.coalesce(F.col(f"root_{c}"), F.col(f"row.{c}")).alias(c) if c in columns else F.col(f"row.{c}").alias(c)
    stay = alone.select(*map(back, table.columns))
    groups = rows.filter("meets").select(*finals, "place", F.array(*(F.col(f"key_{c}") for c in columns)).alias("persons"), F.array(*(F.col(f"way_{c}") for c in columns)).alias("ways"), "confidence")

    def run(own: pa.Table) -> pa.Table:
        held, gone = meet(own.to_pylist(), columns)
        both = [(p, k, True) for p, k in held] + [(p, k, False) for p, k in gone]
        return pa.table({"place": pa.array([p for p, _, _ in both], pa.int64()), "persons": pa.array([k for _, k, _ in both], pa.list_(pa.string())), "stays": pa.array([s for _, _, s in both], pa.bool_())})

    outcome = settled(groups.groupBy(*finals).applyInArrow(run, "place long, persons array<string>, stays boolean"))
    told = rows.filter("meets").join(outcome, "place")
    kept = told.filter("stays").select(*(F.col("persons")[columns.index(c)].alias(c) if c in columns else F.col(f"row.{c}").alias(c) for c in table.columns))
    return stay.unionByName(kept), told.filter("NOT stays").select("row", "persons")


def _entry(rows: DataFrame, kind: str, entity: Column, change: str, before: Column, after: Column, field: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("string")
    return rows.select(F.lit(kind).alias("entity_kind"), entity.alias("entity_id"), (none if field is None else field).alias("field"), F.lit(change).alias("change_kind"), before.alias("before_json"), after.alias("after_json"), (F.col("seq") if "seq" in rows.columns else F.lit(None).cast("long")).alias("seq"))


def _variants(tables: dict[str, DataFrame], good: DataFrame, root: DataFrame) -> DataFrame:
    """person_variants with the merged persons' own and the merged candidates' lists, each once a person."""
    own = tables["person_variants"]
    moved = own.join(root.withColumnRenamed("id", "person_id"), "person_id", "left").withColumn("person_id", F.coalesce("root", "person_id")).select(*own.columns)
    if "candidate_persons" in tables:
        listed = good.filter("from_candidates").join(tables["candidate_persons"].select(F.col("id").alias("out"), "variants_json"), "out")
        listed = listed.select(F.col("into").alias("person_id"), F.explode(F.from_json("variants_json", "array<struct<variant:string,kind:string>>")).alias("v"))
        listed = listed.join(root.withColumnRenamed("id", "person_id"), "person_id", "left").select(F.coalesce("root", "person_id").alias("person_id"), F.col("v.variant").alias("variant"), F.coalesce("v.kind", F.lit("")).alias("kind")).filter("variant <> ''").distinct()
        listed = listed.withColumn("id", F.concat(F.lit("pv:"), F.substring(F.sha2(F.concat_ws(":", "person_id", "variant", "kind"), 256), 1, 8))).select(*(c for c in ("id", "person_id", "variant", "kind") if c in own.columns))
        listed = listed.join(moved.select("person_id", "variant", "kind"), ["person_id", "variant", "kind"], "left_anti")
        moved = moved.unionByName(listed, allowMissingColumns=True)
    row = F.struct(*(F.col(c) for c in own.columns))
    return moved.groupBy("person_id", "variant", "kind").agg(F.min(row).alias("row")).select("row.*")


def accept_merges(accepted: DataFrame, tables: dict[str, DataFrame], edits: DataFrame | None = None, most: int = 10_000) -> dict[str, DataFrame]:
    """New versions of tables after the accepted merge candidates (mc_id, and seq, their order; without it by mc_id).

    tables: merge_candidates (id, target_id, candidate_id, status), persons, candidate_persons, person_variants, entity_citations,
    and the tables of PERSON_EDGES, whichever there are; edits: mc_id, field, value of the surviving person, made before anything
    else. Gives these tables, `audit_log` (rows to append: edit, merge, merge_collision_resolved; seq is the acceptance's number),
    `fills` (rows of that form for fields that were filled, which replay.taken_back() needs and the audit log by itself lacks) and `refused`
    (mc_id, seq, reason).

    Refused are candidates that aren't open by then, name persons that aren't there by then, edit a field that isn't in EDITABLE, or would
    overwrite a field of FILLED that is set otherwise; a refusal changes nothing. Else the surviving person's null fields are
    filled, the other's variants and edges become its own, of two edges of one key the one of higher confidence stays (ties:
    the survivor's), edges between the two go, and the other person goes. Where the other is one of candidate_persons, it stays
    there with its match_target_id set, and its listed variants become the survivor's.

    Defined results: rows of accepted with equal seq go by mc_id; one accepted again is refused by its status; no tables, no rows:
    empty results; of several edits of one field the greatest value counts; null confidences count as 0."""
    people, queue = tables["persons"], tables["merge_candidates"]
    fields = [f for f in EDITABLE if f in people.columns]
    order = accepted.select("mc_id", F.col("seq").cast("long").alias("seq")) if "seq" in accepted.columns else accepted.select("mc_id").distinct().withColumn("seq", F.lit(0).cast("long"))
    order = numbered(order, ["seq", "mc_id"]).select("mc_id", F.col("place").cast("long").alias("seq"))
    said = None if edits is None else edits.groupBy("mc_id", "field").agg(F.max("value").alias("value"))
    judged = judged_in_order(order, queue, people, tables.get("candidate_persons"), said, fields, most)
    good = settled(judged.filter("reason IS NULL"))
    way = ways(good.filter("NOT from_candidates").select("out", "into", "seq"))
    root = way.select("id", "root")

    last = good.groupBy(F.col("into").alias("id")).agg(F.max_by("after", "seq").alias("_after"))
    persons = people.join(way.select("id"), "id", "left_anti").join(last, "id", "left")
    value = lambda f, of: F.col(of)[fields.index(f)].cast(people.schema[f].dataType)
    persons = persons.select(*(F.when(F.col("_after").isNotNull(), value(c, "_after")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in people.columns))
    merged = good.select(F.col("mc_id").alias("id"), F.lit(True).alias("_done")).distinct()
    out = {"persons": persons, "merge_candidates": queue.join(merged, "id", "left").withColumn("status", F.when(F.col("_done"), "merged").otherwise(F.col("status"))).select(*queue.columns)}
    if "candidate_persons" in tables:
        own = tables["candidate_persons"]
        target = good.filter("from_candidates").groupBy(F.col("out").alias("id")).agg(F.max_by("into", "seq").alias("_into"))
        kept = own if "match_target_id" in own.columns else own.withColumn("match_target_id", F.lit(None).cast("string"))
        out["candidate_persons"] = kept.join(target, "id", "left").withColumn("match_target_id", F.coalesce("_into", "match_target_id")).select(*kept.columns)

    nothing = F.lit(None).cast("string")
    as_json = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    valued = lambda c: as_json(F.struct(c.alias("value"), F.lit(1.0).alias("confidence")))
    rest = [c for c in people.columns if c not in fields]
    row = lambda k: people.select(F.col("id").alias(k), F.struct(*rest).alias(f"{k}_row"))
    snapshot = lambda of, k: F.struct(*(value(c, of).alias(c) if c in fields else F.coalesce(F.col(f"{k}_row.{c}"), F.col(k)).alias(c) if c == "id" else F.col(f"{k}_row.{c}").alias(c) for c in people.columns))
    both = good.join(row("into"), "into").join(row("out"), "out", "left")
    audit = _entry(both, "person", F.col("into"), "merge", as_json(snapshot("merged", "out")), as_json(snapshot("after", "into")))
    if said is not None:
        changed = said.join(good, "mc_id")
        was = F.coalesce(*(F.when(F.col("field") == f, F.col("before")[k]) for k, f in enumerate(fields)))
        audit = audit.unionByName(_entry(changed, "person", F.col("into"), "edit", valued(was), valued(F.col("value")), F.col("field")))
    held = [f for f in FILLED if f in fields]
    at = lambda of, f: F.col(of)[fields.index(f)]
    none = F.lit(None).cast("array<struct<field:string,value:string>>")
    told = good.withColumn("edits", none) if said is None else good.join(said.groupBy("mc_id").agg(F.collect_list(F.struct("field", "value")).alias("edits")), "mc_id", "left")
    own = lambda f: F.filter("edits", lambda e: e["field"] == f)
    met = lambda f: F.when(F.coalesce(F.size(own(f)), F.lit(0)) > 0, F.get(own(f), F.lit(0))["value"]).otherwise(at("before", f))  # noqa: E731  what the fill met
    each = F.array(*(F.struct(F.lit(f).alias("field"), F.when(met(f).isNull(), at("after", f)).alias("value")) for f in held))
    if held:
        filled = told.select("seq", "into", F.inline(F.filter(each, lambda x: x["value"].isNotNull())))
        out["fills"] = _entry(filled, "person", F.col("into"), "fill", nothing, valued(F.col("value")), F.col("field"))
    if "person_variants" in tables:
        out["person_variants"] = _variants(tables, good, root)
    if "entity_citations" in tables:
        own = tables["entity_citations"]
        out["entity_citations"], gone = moved_rows(own, ["entity_id"], ["entity_kind", "entity_id", "citation_id"], way, F.col("entity_kind") == "person")
        repeat = as_json(F.struct(F.lit(True).alias("duplicate"), F.col("persons")[0].alias("entity_id"), F.col("row.citation_id").alias("citation_id")))
        audit = audit.unionByName(_entry(gone, "entity_citation", F.concat_ws(":", F.lit("person"), F.col("persons")[0], F.col("row.citation_id")), "merge_collision_resolved", repeat, nothing))
    for name, (columns, key) in PERSON_EDGES.items():
        if name in tables:
            out[name], gone = moved_rows(tables[name], list(columns), list(key), way)
            now = lambda k: F.col("persons")[columns.index(k)] if k in columns else F.col(f"row.{k}")  # noqa: B023, E731
            names = F.concat_ws(":", *(F.coalesce(now(k).cast("string"), F.lit("null")) for k in key))
            audit = audit.unionByName(_entry(gone, name[:-1], names, "merge_collision_resolved", as_json(F.struct(*(now(c).alias(c) for c in tables[name].columns))), nothing))
    return out | {"audit_log": audit, "refused": judged.filter("reason IS NOT NULL").select("mc_id", "seq", "reason")}
