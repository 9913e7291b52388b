"""Loading of candidates into canonical tables: identity, then fields, variants, citations, audit entries and conflicts.

Each loader is a function from tables to tables: what a run's candidates make of the tables that are there. Candidates act in
order (those without a target before those with one, then by id), each on the outcome of the ones before; the fields' fold is
merging.applied(). Ids of new rows depend on content alone, so a repeated load finds its own rows and adds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstone.functions.text import json_equal, slug
from inkstone.operators.merging import MARGIN, applied, inverse_conflicts, load_edges, outcome
from inkstone.operators.validation import match_events, match_persons
from inkstone.sources.storage import settled

# The fields that are merged; kinds of edges; the confidence and provenance of loaded rows; a variant's usual kind.
PERSON_FIELDS = ("gender", "birth_date_json", "death_date_json", "notes", "state_id", "clan_name", "social_category")
EVENT_FIELDS = ("type", "outcome", "summary", "primary_place_id")
EDGE_CONFIDENCE, PROVENANCE, OTHER_NAME = 0.9, "auto", "别名"
EVENT_RELATIONS = ("causes", "precedes", "related")
PERSON_RELATIONS = ("parent", "child", "spouse", "sibling", "mentor", "ruler", "minister", "ally", "rival", "killed_by", "clan_member")
PERSON_STATE_ROLES = ("ruler", "minister", "exile", "defector", "citizen", "other")
DIRECTED = ("parent", "child", "killed_by", "ruler", "minister", "mentor")
#: Tables of edges: the key, the columns beside it, and the column of kinds with those allowed.
EDGES = {
    "event_participants": (("event_id", "person_id", "role"), ("role_detail",), None, ()),
    "event_places": (("event_id", "place_id", "role"), (), None, ()),
    "event_relations": (("from_event_id", "to_event_id", "kind"), (), "kind", EVENT_RELATIONS),
    "person_relations": (("from_person_id", "to_person_id", "kind"), ("date_json",), "kind", PERSON_RELATIONS),
    "person_states": (("person_id", "state_id", "role", "from_date_json"), ("to_date_json",), "role", PERSON_STATE_ROLES),
}
AUDIT = ["entity_kind", "entity_id", "field", "change_kind", "before_json", "after_json"]


def _json(**values: Column) -> Column:
    return F.to_json(F.struct(*(v.alias(k) for k, v in values.items())), {"ignoreNullFields": "false"})


def _entries(rows: DataFrame, kind: str, entity: Column, change: str, after: Column, field: Column | None = None, before: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("string")
    return rows.select(F.lit(kind).alias("entity_kind"), entity.alias("entity_id"), (none if field is None else field).alias("field"), F.lit(change).alias("change_kind"), (none if before is None else before).alias("before_json"), after.alias("after_json"))


def field_equal(field: Column):
    """Values of fields that end in _json are equal as JSON."""
    return lambda a, b: F.when(field.endswith("_json"), json_equal(a, b)).otherwise(a.eqNullSafe(b))


def long_fields(rows: DataFrame, keep: list[str], fields: tuple[str, ...]) -> DataFrame:
    """keep, field and value (as text) of each field, nulls too."""
    return rows.select(*keep, F.inline(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields))))


def merged_fields(kind: str, entities: DataFrame, matched: DataFrame, fields: tuple[str, ...], audit_log: DataFrame, run: str) -> dict[str, DataFrame]:
    """entities with the fields that the matched candidates set, audit entries and conflicts.

    entities: id, confidence, provenance, fields, those that this load makes among them; matched: entity_id, pass, id, confidence
    and fields of the candidates that act on an entity (its maker isn't among them). A field's confidence is that of its last
    audit entry, or else its row's."""
    said = audit_log.filter((F.col("entity_kind") == kind) & F.col("field").isNotNull()).groupBy(F.col("entity_id"), "field").agg(F.max_by(F.get_json_object("after_json", "$.confidence").try_cast("double"), F.struct("at", "seq")).alias("_said"))
    start = long_fields(entities, [F.col("id").alias("entity_id"), "confidence", (F.col("provenance") == "curated").alias("curated")], fields)
    start = start.join(said, ["entity_id", "field"], "left").withColumn("confidence", F.coalesce(F.when(F.col("_said") != 0, F.col("_said")), "confidence")).drop("_said")
    proposals = long_fields(matched, ["entity_id", "pass", "id", "confidence"], fields).filter("value IS NOT NULL")
    keys, order = ["entity_id", "field"], ["pass", "id"]
    labelled = settled(applied(proposals, keys, order, start.join(proposals.select(*keys).distinct(), keys, "left_semi"), field_equal(F.col("field")) if any(f.endswith("_json") for f in fields) else None))
    final = outcome(labelled, keys, order).filter("n_set > 0").groupBy("entity_id").pivot("field", list(fields)).agg(F.first("value"))
    final = final.select(F.col("entity_id").alias("id"), *(F.col(f).alias(f"_{f}") for f in fields))
    got = entities.join(final, "id", "left").select(*(F.coalesce(F.col(f"_{c}").cast(entities.schema[c].dataType), F.col(c)).alias(c) if c in fields else F.col(c) for c in entities.columns))
    done = labelled.filter("action = 'set'")
    audit = _entries(done, kind, F.col("entity_id"), "set", _json(value=F.col("value"), confidence=F.col("confidence")), F.col("field"), F.when(F.col("old_value").isNotNull(), _json(value=F.col("old_value"), confidence=F.col("old_confidence"))))
    variant = lambda v, c, source: F.struct(F.col(v).alias("value"), F.col(c).alias("confidence"), F.lit(source).alias("source"))
    variants = F.to_json(F.array(variant("old_value", "old_confidence", "existing"), variant("value", "confidence", f"run:{run}")))
    content = F.concat_ws("|", F.lit(run), F.lit(kind), "entity_id", "field", "id")
    conflicts = labelled.filter("action = 'conflict'").select(
        F.concat(F.lit("cfl:"), F.substring(F.sha2(content, 256), 1, 12)).alias("id"), F.lit(kind).alias("entity_kind"), "entity_id", "field", variants.alias("variants_json"),
        F.when(F.col("old_confidence") >= F.col("confidence"), 0).otherwise(1).alias("best_idx"), F.lit("highest_confidence").alias("resolution_rule"), F.lit("open").alias("status"),
    )
    return {"entities": got, "audit_log": audit, "conflicts": conflicts}


def _citations(known: DataFrame, kind: str, rows: DataFrame, entity: str, citation: str) -> DataFrame:
    """Those to append."""
    own = rows.filter(F.col(citation).isNotNull()).select(F.lit(kind).alias("entity_kind"), F.col(entity).alias("entity_id"), F.col(citation).alias("citation_id")).distinct()
    return own.join(known, ["entity_kind", "entity_id", "citation_id"], "left_anti")


def _made(candidates: DataFrame, entity: str) -> DataFrame:
    """The first candidate, in order, of each entity that the load makes."""
    first = candidates.filter("created").groupBy(entity).agg(F.min(F.struct("pass", "id")).alias("_first")).select(entity, F.col("_first.id").alias("id"))
    return candidates.join(first, [entity, "id"], "left_semi")


def listed_variants(rows: DataFrame, key: str, variants: str = "variants_json") -> DataFrame:
    """key and each variant of JSON lists of {variant, kind} as v; malformed lists give nothing."""
    return rows.select(key, F.explode(F.from_json(variants, "array<struct<variant:string,kind:string>>")).alias("v"))


def new_variants(known: DataFrame, rows: DataFrame) -> DataFrame:
    """Variants to append: a missing kind is the usual one, an empty variant gives nothing; ids depend on person, variant and kind."""
    listed = listed_variants(rows, "person_id")
    own = listed.select("person_id", F.col("v.variant").alias("variant"), F.coalesce("v.kind", F.lit(OTHER_NAME)).alias("kind")).filter("variant <> ''").distinct()
    fresh = own.join(known.select("person_id", "variant", "kind"), ["person_id", "variant", "kind"], "left_anti")
    return fresh.select(F.concat(F.lit("pv:"), F.substring(F.sha2(F.concat_ws(":", "person_id", "variant", "kind"), 256), 1, 8)).alias("id"), "person_id", "variant", "kind")


def load_persons(candidates: DataFrame, tables: dict[str, DataFrame], run: str) -> dict[str, DataFrame]:
    """What the candidates of a run make of persons.

    candidates: id, canonical_name, PERSON_FIELDS (states resolved), variants_json, confidence, chunk_id, match_target_id.
    tables: persons (id, canonical_name, PERSON_FIELDS, confidence, provenance), person_variants, entity_citations, audit_log.
    Gives the new persons, and the rows to append to person_variants, entity_citations, audit_log and conflicts, and `ids` (id,
    person_id)."""
    persons, variants = tables["persons"], tables["person_variants"]
    ids = match_persons(candidates, persons, variants, listed_variants(candidates, "id").select("id", F.col("v.variant").alias("variant")))
    own = candidates.join(ids, "id").withColumn("pass", F.col("match_target_id").isNotNull().cast("int"))
    made = _made(own, "person_id")
    new = made.select(F.col("person_id").alias("id"), "canonical_name", *PERSON_FIELDS, "confidence", F.lit(PROVENANCE).alias("provenance"))
    everyone = persons.select("id", "canonical_name", *PERSON_FIELDS, "confidence", "provenance").unionByName(new)
    acting = own.join(made.select("id"), "id", "left_anti").withColumn("entity_id", F.col("person_id"))
    got = merged_fields("person", everyone, acting, PERSON_FIELDS, tables["audit_log"], run)
    created = _entries(new, "person", F.col("id"), "create", _json(canonical_name=F.col("canonical_name"), confidence=F.col("confidence")))
    return {
        "persons": got["entities"], "person_variants": new_variants(variants.select("person_id", "variant", "kind"), own), "entity_citations": _citations(tables["entity_citations"], "person", own, "person_id", "chunk_id"),
        "audit_log": created.unionByName(got["audit_log"]), "conflicts": got["conflicts"], "ids": ids.select("id", "person_id"),
    }


#: Of entities that are known by their name: the fields that are merged and the beginning of new ids.
NAMED = {
    "place": (("type", "lat", "lon", "coord_confidence", "modern_equiv"), "pla:"),
    "state": (("type", "ruling_clan", "founded_date_json", "ended_date_json"), "sta:"),
}


def new_ids(names: DataFrame, existing: DataFrame, prefix: str) -> DataFrame:
    """name and id of new names (name, pos): the name's slug; where an id of `existing` or an earlier name has it, with a hash behind."""
    slugs = names.select("name", "pos", F.concat(F.lit(prefix), slug(F.col("name"))).alias("_slug"))
    taken = existing.select(F.col("id").alias("_slug"), F.lit(True).alias("_taken")).distinct()
    first = slugs.groupBy("_slug").agg(F.min(F.struct("pos", "name")).alias("_first"))
    both = slugs.join(taken, "_slug", "left").join(first, "_slug")
    plain = F.col("_taken").isNull() & (F.col("name") == F.col("_first.name"))
    return both.select("name", F.when(plain, F.col("_slug")).otherwise(F.concat("_slug", F.lit("-"), F.substring(F.sha2("name", 256), 1, 6))).alias("id"))


def load_named(kind: str, candidates: DataFrame, tables: dict[str, DataFrame], fields: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """What candidates make of the places or states, one after the other: by seq, then id.

    candidates: id, name, the fields, confidence, chunk_id, seq (left out: by id). tables: the entities (id, name, the fields, confidence and
    more) by `kind` and an s, entity_citations, audit_log. The first candidate of a new name makes it. Each other one sets the fields that
    are null, without touching the entity's confidence, and those that differ and whose confidence its own exceeds by more than MARGIN,
    which becomes the entity's, too. A field's confidence is that of its last audit entry, or else, or if that is 0, the entity's. Gives the new
    entities, the rows to append to entity_citations and audit_log, and `ids` (id, entity_id).

    A field changes a few times at most, since its confidence has to rise; so each turn finds the next candidate of every name that
    changes anything, as a minimum, and no name's candidates are gathered.

    Defined results: null names are left out; of several entities of one name the least id is meant; a null confidence fills what is null
    and overwrites nothing; candidates of equal seq go by id; empty tables give empty results."""
    usual, prefix = NAMED[kind]
    fields = usual if fields is None else fields
    there = tables[f"{kind}s"]
    order = "seq" if "seq" in candidates.columns else "id"
    own = settled(candidates.filter("name IS NOT NULL").select(F.col("id").alias("cand"), "name", F.struct(F.col(order).alias("seq"), F.col("id").alias("id")).alias("pos"), *(F.col(f).cast(there.schema[f].dataType).alias(f) for f in fields), F.col("confidence").cast("double").alias("c"), "chunk_id"))
    none = F.lit(None).cast(own.schema["pos"].dataType)
    known = there.filter("name IS NOT NULL").groupBy("name").agg(F.min_by(F.struct("id", F.col("confidence").cast("double").alias("confidence"), *fields), "id").alias("e"))
    said = tables["audit_log"].filter((F.col("entity_kind") == kind) & F.col("field").isin(*fields)).groupBy(F.col("entity_id").alias("id"), "field").agg(F.max_by(F.get_json_object("after_json", "$.confidence").try_cast("double"), F.struct("at", "seq")).alias("p"))
    said = said.groupBy("id").pivot("field", list(fields)).agg(F.first("p")).select("id", *(F.col(f).alias(f"p_{f}") for f in fields))
    names = own.groupBy("name").agg(F.min(F.struct("pos", *fields, "c")).alias("m"))
    started = names.join(known, "name").select("name", F.col("e.id").alias("id"), none.alias("since"), F.coalesce("e.confidence", F.lit(0.0)).alias("r"), *(F.col(f"e.{f}").alias(f"v_{f}") for f in fields)).join(said, "id", "left")
    fresh = settled(names.join(known.select("name"), "name", "left_anti"))
    made = fresh.join(new_ids(fresh.select("name", F.col("m.pos").alias("pos")), there, prefix), "name")
    made = made.select("id", "name", F.col("m.pos").alias("since"), F.coalesce("m.c", F.lit(0.0)).alias("r"), *(F.col(f"m.{f}").alias(f"v_{f}") for f in fields), *(F.lit(None).cast("double").alias(f"p_{f}") for f in fields))
    state = settled(started.select(*made.columns).unionByName(made))
    created = settled(state.filter("since IS NOT NULL").select("id", "name", F.col("r").alias("c")))

    prior = {f: F.coalesce(F.when(F.col(f"p_{f}") != 0, F.col(f"p_{f}")), F.col("r")) for f in fields}
    fills = lambda new, f: new.isNotNull() & F.col(f"v_{f}").isNull()
    over = lambda new, c, f: new.isNotNull() & F.coalesce((F.col(f"v_{f}") != new) & (c > prior[f] + MARGIN), F.lit(False))
    any_of = lambda conditions: F.greatest(*conditions) if len(conditions) > 1 else conditions[0]
    final, audit = state, _entries(created, kind, F.col("id"), "create", _json(value=F.col("name"), confidence=F.col("c")))
    while True:
        met = own.join(state, "name").filter(F.col("since").isNull() | (F.col("pos") > F.col("since"))).filter(any_of([fills(F.col(f), f) | over(F.col(f), F.col("c"), f) for f in fields]))
        first = met.groupBy("name").agg(F.min(F.struct("pos", *fields, "c")).alias("m"))
        step = settled(state.join(first, "name"))
        if not step.limit(1).count():
            break
        new = {f: F.col(f"m.{f}") for f in fields}
        sets = {f: fills(new[f], f) | over(new[f], F.col("m.c"), f) for f in fields}
        for f in fields:
            before = F.when(F.col(f"v_{f}").isNotNull(), _json(value=F.col(f"v_{f}"), confidence=prior[f]))
            audit = audit.unionByName(_entries(step.filter(sets[f]), kind, F.col("id"), "set", _json(value=new[f], confidence=F.col("m.c")), F.lit(f), before))
        r = F.when(any_of([over(new[f], F.col("m.c"), f) for f in fields]), F.col("m.c")).otherwise(F.col("r")).alias("r")
        state = settled(step.select("id", "name", F.col("m.pos").alias("since"), r, *(F.when(sets[f], new[f]).otherwise(F.col(f"v_{f}")).alias(f"v_{f}") for f in fields), *(F.when(sets[f], F.coalesce("m.c", F.lit(0.0))).otherwise(F.col(f"p_{f}")).alias(f"p_{f}") for f in fields)))
        final = settled(final.join(state.select("name"), "name", "left_anti").unionByName(state))
    held = final.select("id", F.col("name").alias("_name"), F.lit(True).alias("_held"), "r", *(f"v_{f}" for f in fields))
    both = there.join(held, "id", "full")
    now = lambda c: F.when(F.col("_held"), F.col(f"v_{c}")).otherwise(F.col(c)) if c in fields else F.coalesce(c, "_name") if c == "name" else F.coalesce("r", c) if c == "confidence" else F.col(c)
    entities = both.select(*((F.coalesce(c, F.when(F.col("_held"), F.lit(PROVENANCE))) if c == "provenance" else now(c)).alias(c) for c in there.columns))
    ids = own.select("cand", "name", "chunk_id").join(final.select("name", F.col("id").alias("entity_id")), "name")
    return {
        f"{kind}s": entities, "audit_log": audit, "ids": ids.select(F.col("cand").alias("id"), "entity_id"),
        "entity_citations": _citations(tables["entity_citations"], kind, ids, "entity_id", "chunk_id"),
    }


def merged_dates(entities: DataFrame, matched: DataFrame) -> DataFrame:
    """id and date_json of the entities whose date the matched candidates change, each of them acting in order: a more precise
    date wins with a confidence up to MARGIN below the row's, a less precise one needs more than MARGIN above it, and else the
    higher confidence wins.

    A row's confidence stays, so of the candidates whose confidence less MARGIN is above it the last one always wins; after it, only such
    count as are at least as precise as all before (with a higher confidence) or more precise (without); which is the last of
    the most precise that have a higher confidence, or else the first of the most precise."""
    rank = lambda c: F.coalesce(F.element_at(F.create_map(*(F.lit(x) for p in (("point", 3), ("circa", 2), ("range", 1)) for x in p)), F.coalesce(F.get_json_object(c, "$.uncertainty"), F.lit("point"))), F.lit(0))
    base = entities.select(F.col("id").alias("entity_id"), F.col("date_json").alias("_date"), F.coalesce("confidence", F.lit(0.0)).alias("_conf"))
    moves = matched.filter(F.try_parse_json("date_json").isNotNull()).select("entity_id", F.struct("pass", "id").alias("pos"), "date_json", F.col("confidence").alias("c"), rank(F.col("date_json")).alias("r")).join(base, "entity_id")
    moves = settled(moves)
    # Without a date there the first one is taken, and then is what others meet.
    begin = moves.filter("_date IS NULL").groupBy("entity_id").agg(F.min(F.struct("pos", "date_json")).alias("_begin"))
    moves = moves.join(settled(begin), "entity_id", "left").filter("_begin IS NULL OR pos > _begin.pos").withColumn("_date", F.coalesce("_date", "_begin.date_json"))
    always = moves.filter(F.col("c") - MARGIN > F.col("_conf")).groupBy("entity_id").agg(F.max(F.struct("pos", "date_json")).alias("_always"))
    always = settled(always)
    left = moves.join(always, "entity_id", "left").filter("_always IS NULL OR pos > _always.pos").withColumn("_from", F.coalesce("_always.date_json", "_date"))
    left = left.filter((F.col("c") >= F.col("_conf") - MARGIN) & (F.col("c") - MARGIN <= F.col("_conf"))).withColumn("_higher", F.col("c") > F.col("_conf"))
    left = left.filter((F.col("r") > rank(F.col("_from"))) | (F.col("_higher") & (F.col("r") == rank(F.col("_from")))))
    most = left.groupBy("entity_id").agg(F.max("r").alias("_most"))
    best = left.join(most, "entity_id").filter("r = _most").groupBy("entity_id").agg(F.max(F.when(F.col("_higher"), F.struct("pos", "date_json"))).alias("_last"), F.min(F.struct("pos", "date_json")).alias("_first"))
    # The first of the most precise sets that precision; a later one with a higher confidence replaces it.
    best = best.select("entity_id", F.coalesce("_last.date_json", "_first.date_json").alias("_best"))
    got = begin.join(always, "entity_id", "full").join(best, "entity_id", "full").join(base, "entity_id")
    return got.select(F.col("entity_id").alias("id"), F.coalesce("_best", "_always.date_json", "_begin.date_json").alias("date_json"), "_date").filter(~json_equal(F.col("date_json"), F.col("_date"))).drop("_date")


def load_events(candidates: DataFrame, tables: dict[str, DataFrame], run: str) -> dict[str, DataFrame]:
    """What the candidates of a run make of events: matched by type, year and place.

    candidates: id, EVENT_FIELDS (places resolved), date_json, confidence, chunk_id. tables: events (id, EVENT_FIELDS, date_json,
    confidence, provenance), entity_citations, audit_log. Gives the new events, the rows to append to entity_citations,
    audit_log and conflicts, and `ids` (id, event_id). A date that changes has one audit entry, of its last value."""
    year = F.get_json_object("date_json", "$.year_bce").try_cast("int")
    keyed = lambda df: df.select("id", "type", year.alias("year_bce"), F.col("primary_place_id").alias("place_id"))
    events = tables["events"].select("id", *EVENT_FIELDS, "date_json", "confidence", "provenance")
    ids = settled(match_events(keyed(candidates), keyed(events)))
    own = settled(candidates.join(ids, "id").withColumn("pass", F.lit(0)))  # read again by every step
    made = settled(_made(own, "event_id"))
    new = made.select(F.col("event_id").alias("id"), *EVENT_FIELDS, "date_json", "confidence", F.lit(PROVENANCE).alias("provenance"))
    every = events.unionByName(new)
    acting = own.join(made.select("id"), "id", "left_anti").withColumn("entity_id", F.col("event_id"))
    # Type and place are what candidates match by, and so never differ.
    got = merged_fields("event", every, acting, ("outcome", "summary"), tables["audit_log"], run)
    dates = settled(merged_dates(every, acting))
    dated = got["entities"].join(dates.withColumnRenamed("date_json", "_date"), "id", "left")
    audit = _entries(new, "event", F.col("id"), "create", _json(type=F.col("type"), confidence=F.col("confidence"))).unionByName(got["audit_log"])
    was = dated.filter("_date IS NOT NULL")
    audit = audit.unionByName(_entries(was, "event", F.col("id"), "set", _json(value=F.col("_date")), F.lit("date_json"), _json(value=F.col("date_json"), confidence=F.col("confidence"))))
    return {
        "events": dated.withColumn("date_json", F.coalesce("_date", "date_json")).select(*events.columns), "entity_citations": _citations(tables["entity_citations"], "event", own, "event_id", "chunk_id"),
        "audit_log": audit, "conflicts": got["conflicts"], "ids": ids.select("id", "event_id"),
    }


def load_relations(name: str, candidates: DataFrame, tables: dict[str, DataFrame], run: str) -> dict[str, DataFrame]:
    """Rows to append to a table of EDGES, with those to entity_citations (the run is the citation), audit_log and conflicts.

    candidates: the key's columns with resolved ids, those beside it, and seq (their order). Rows with a missing id or a kind
    that isn't allowed are left out. A directed relation of two persons whose reverse is there, or came earlier, is loaded and
    makes a conflict."""
    key, more, kind, allowed = EDGES[name]
    ends = [k for k in key if k.endswith("_id")]
    good = candidates.filter(" AND ".join(f"{k} IS NOT NULL" for k in ends))
    good = good if kind is None else good.filter(F.col(kind).isin(*allowed))
    relation = F.concat_ws(":", *(F.coalesce(F.col(k), F.lit("null")) for k in key))
    fresh = load_edges(tables[name], good.select(*key, *more, "seq"), list(key)).withColumn("relation_id", relation)
    fresh = settled(fresh)
    out = {
        name: fresh.select(*key, *more, F.lit(EDGE_CONFIDENCE).alias("confidence"), F.lit(PROVENANCE).alias("provenance")),
        "entity_citations": _citations(tables["entity_citations"], name[:-1], good.select(relation.alias("relation_id"), F.lit(run).alias("run")), "relation_id", "run"),
        "audit_log": _entries(fresh, name[:-1], F.col("relation_id"), "create", _json(**{k: F.col(k) for k in key if k != "from_date_json"})),
    }
    if name == "person_relations":
        met = inverse_conflicts(fresh.select(*key, "seq"), tables[name], "from_person_id", "to_person_id", "kind", list(DIRECTED))
        arrow = lambda a, b: F.concat(a, F.lit("→"), b)
        old, new = arrow("to_person_id", "from_person_id"), arrow("from_person_id", "to_person_id")
        turned = F.concat_ws(":", "to_person_id", "from_person_id", "kind")
        variants = F.to_json(F.array(F.struct(old.alias("value"), F.lit("existing").alias("source")), F.struct(new.alias("value"), F.lit(f"run:{run}").alias("source"))))
        out["conflicts"] = met.select(
            F.concat(F.lit("cfl:"), F.substring(F.sha2(F.concat_ws("|", F.lit(run), turned), 256), 1, 12)).alias("id"), F.lit("person_relation").alias("entity_kind"), turned.alias("entity_id"), F.lit("directionality").alias("field"), variants.alias("variants_json"),
            F.lit(0).alias("best_idx"), F.lit("manual_review").alias("resolution_rule"), F.lit("open").alias("status"),
        )
    return out
