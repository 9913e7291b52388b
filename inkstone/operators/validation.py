"""Extracted records against their chunks: rules with one message each, kept rows and quarantine, loading of candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkstone.functions.text import any_of, first_failure, last_segment, slug
from inkstone.operators.corpus import normalised, normalised_values
from inkstone.operators.rows import last_rows
from inkstone.sources.storage import settled

# How a date may have been inferred, and the enumerations of extracted rows.
INFERENCE_KINDS = ("explicit_reign_zhou", "explicit_reign_lu", "relative_to_prior_event", "era_only", "unknown")
LOCAL_ID = r"^(p|e|pl|s)\d+$"
DATE_FIELDS = ("date", "birth_date", "death_date", "founded_date", "ended_date")


def check_records(records: DataFrame, chunks: DataFrame, declared: DataFrame, kinds: tuple[str, ...] = INFERENCE_KINDS, references: tuple[str, ...] = ("primary_place_id", "state_id")) -> DataFrame:
    """records (id, chunk_id, quote, justifications map, date structs, references, run) with `violation`, the first rule
    that fails, or null. chunks: id, text; declared: run, local_id of every record of the extraction. Quotes, texts and
    justifications compare in normal form C."""
    texts = normalised(chunks.select(F.col("id").alias("chunk_id"), F.col("text").alias("_text")), "_text")
    own = records.withColumn("_quote", F.col("quote")).withColumn("_why", normalised_values(F.map_values("justifications")))
    got = normalised(own, "_quote").join(texts, "chunk_id", "left")
    rules: list[tuple[Column, str]] = [
        (F.col("_text").isNotNull(), "unknown chunk_id"),
        (F.length("quote") > 0, "citation.quote is empty"),
        (F.contains(F.col("_text"), F.col("_quote")), "quote is not in its chunk"),
        (F.col("_why").isNull() | F.forall("_why", lambda v: (F.length(v) > 0) & F.contains(F.col("_quote"), v)), "a justification is empty or not in the quote"),
    ]
    for d in (d for d in DATE_FIELDS if d in records.columns):
        kind = F.col(f"{d}.inference_kind")
        rules.append((kind.isNull() | kind.isin(*kinds), f"{d}.inference_kind is not allowed"))
    for ref in (r for r in references if r in records.columns):
        known = declared.select("run", F.col("local_id").alias(ref), F.lit(True).alias(f"_{ref}")).distinct()
        got = got.join(known, ["run", ref], "left")
        rules.append((F.col(ref).isNull() | F.contains(F.col(ref), F.lit(":")) | F.col(f"_{ref}"), f"{ref} is not declared"))
    return got.withColumn("violation", first_failure(*rules)).select(*records.columns, "violation")


def check_relations(relations: DataFrame, chunks: DataFrame) -> DataFrame:
    known = chunks.select(F.col("id").alias("chunk_id"), F.lit(True).alias("_known")).distinct()
    return relations.join(known, "chunk_id", "left").withColumn("violation", F.when(F.col("_known").isNull(), F.concat(F.lit("relation/"), "kind", F.lit(": unknown chunk_id")))).select(*relations.columns, "violation")


def check_relation_quotes(relations: DataFrame, chunks: DataFrame) -> DataFrame:
    """relations (kind, chunk_id, quote) with `violation`: unknown chunk, empty quote, quote not in its chunk, or null."""
    texts = normalised(chunks.select(F.col("id").alias("chunk_id"), F.col("text").alias("_text")), "_text")
    got = normalised(relations.withColumn("_quote", F.col("quote")), "_quote").join(texts, "chunk_id", "left")
    rules = (F.col("_text").isNotNull(), "unknown chunk_id"), (F.length("quote") > 0, "citation.quote is empty"), (F.contains(F.col("_text"), F.col("_quote")), "quote is not in its chunk")
    return got.withColumn("violation", F.concat(F.lit("relation/"), "kind", F.lit(": "), first_failure(*rules))).select(*relations.columns, "violation")


def unknown_properties(rows: DataFrame, key: str, body: str, allowed: tuple[str, ...]) -> DataFrame:
    """key, field and rule of the properties of JSON objects that aren't allowed; malformed JSON is one broken rule."""
    names = F.json_object_keys(body)
    other = F.when(names.isNull(), F.array(F.lit(""))).otherwise(F.array_except(names, F.array(*map(F.lit, allowed))))
    return rows.select(key, names.isNull().alias("_bad"), F.explode(other).alias("field")).select(key, "field", F.when(F.col("_bad"), "object").otherwise("closed").alias("rule"))


def preflight(parts: dict[str, tuple[DataFrame, dict]], relations: DataFrame, chunks: DataFrame, declared: DataFrame) -> DataFrame:
    """kind, id and error of everything that is wrong with extracted rows: schema rules, then record rules, then the quotes of
    relations. parts: rows and schema_violations()'s rules by kind."""
    out = check_relation_quotes(relations, chunks).filter("violation IS NOT NULL").select(F.lit("relation").alias("kind"), F.col("kind").alias("id"), F.col("violation").alias("error"))
    for kind, (rows, rules) in parts.items():
        broken = schema_violations(rows, "id", **rules).select(F.lit(kind).alias("kind"), "id", F.concat(F.lit("schema: "), "field", F.lit(": "), "rule").alias("error"))
        wrong = check_records(rows, chunks, declared).filter("violation IS NOT NULL").select(F.lit(kind).alias("kind"), "id", F.col("violation").alias("error"))
        out = out.unionByName(broken).unionByName(wrong)
    return out


def schema_violations(rows: DataFrame, key: str, required: tuple[str, ...] = (), enums: dict[str, tuple[str, ...]] | None = None, patterns: dict[str, str] | None = None, least: dict[str, float] | None = None) -> DataFrame:
    """key, field and rule of every broken rule, a row each."""
    checks = [(c, "required", F.col(c).isNull()) for c in required]
    checks += [(c, "enum", F.col(c).isNotNull() & ~F.col(c).isin(*v)) for c, v in (enums or {}).items()]
    checks += [(c, "pattern", F.col(c).isNotNull() & ~F.col(c).rlike(v)) for c, v in (patterns or {}).items()]
    checks += [(c, "minimum", F.col(c) < v) for c, v in (least or {}).items()]
    broken = F.filter(F.array(*(F.struct(F.lit(c).alias("field"), F.lit(rule).alias("rule"), F.coalesce(bad, F.lit(False)).alias("bad")) for c, rule, bad in checks)), lambda x: x["bad"])
    return rows.filter(any_of([F.coalesce(bad, F.lit(False)) for _, _, bad in checks])).select(key, F.inline(broken)).select(key, "field", "rule")


def resolve_ids(edges: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rewrites local or candidate ids (run, local_id -> id; of several the last by seq, then the greatest); ids of other forms stay, and
    unknown local ids become null."""
    mapped = last_rows(ids, ["run", "local_id"]).select("run", F.col("local_id").alias("_local"), F.col("id").alias("_id"))
    local = F.when(F.col(column).startswith("cand:") | F.col(column).rlike(LOCAL_ID), last_segment(F.col(column)))
    return edges.withColumn("_local", local).join(mapped, ["run", "_local"], "left").withColumn(column, F.when(F.col("_local").isNull(), F.col(column)).otherwise(F.col("_id"))).drop("_local", "_id")


def match_persons(candidates: DataFrame, persons: DataFrame, variants: DataFrame, written: DataFrame | None = None) -> DataFrame:
    """id, person_id and created of each candidate (id, canonical_name, match_target_id), those without a target before those with
    one, then by id. A candidate is its target, or what its target, another candidate that came earlier, became; or the person
    of that name; or of that variant; or a new person. Several known persons of a name: the least id. written (id, variant):
    names that candidates add to what they became, for the ones after them.

    What a candidate becomes depends on earlier ones alone, so turns in which all look at the last turn's outcome settle; a
    turn's look-ups are of the first who made or wrote a name."""
    by_name = persons.groupBy("canonical_name").agg(F.min("id").alias("_by_name"))
    by_variant = variants.groupBy(F.col("variant").alias("canonical_name")).agg(F.min("person_id").alias("_by_variant"))
    known = persons.select(F.col("id").alias("match_target_id"), F.col("id").alias("_target"))
    fresh = F.concat(F.lit("per:"), slug(F.col("canonical_name")), F.lit("-"), F.substring(F.sha2("canonical_name", 256), 1, 6))
    own = candidates.select("id", "canonical_name", "match_target_id").join(by_name, "canonical_name", "left").join(by_variant, "canonical_name", "left").join(known, "match_target_id", "left")
    base = own.select("id", "canonical_name", F.when(F.col("_target").isNull(), F.col("match_target_id")).alias("sibling"), F.struct(F.col("match_target_id").isNotNull().alias("late"), "id").alias("pos"), F.coalesce("_target", "_by_name", "_by_variant").alias("known"), F.col("_target").isNotNull().alias("sure"), fresh.alias("fresh"))
    state = settled(base.withColumn("person_id", F.coalesce("known", "fresh")))
    while True:
        made = state.filter("person_id = fresh").groupBy("canonical_name").agg(F.min("pos").alias("_made"))
        turn = state.join(made, "canonical_name", "left").join(state.select(F.col("id").alias("sibling"), F.col("pos").alias("_pos"), F.col("person_id").alias("_sibling")), "sibling", "left")
        if written is not None:
            wrote = written.filter("variant IS NOT NULL").join(state.select("id", "pos", "person_id"), "id").groupBy(F.col("variant").alias("canonical_name")).agg(F.min(F.struct("pos", "person_id")).alias("_wrote"))
            turn = turn.join(wrote, "canonical_name", "left")
            said = F.when((F.col("_made").isNull() | (F.col("_made") >= F.col("pos"))) & (F.col("_wrote.pos") < F.col("pos")), F.col("_wrote.person_id"))
        else:
            said = F.lit(None).cast("string")
        found = F.when(F.col("sure"), F.col("known")).otherwise(F.coalesce(F.when(F.col("_pos") < F.col("pos"), F.col("_sibling")), "known", said, "fresh"))
        turn = settled(turn.select(*base.columns, found.alias("person_id"), (found != F.col("person_id")).alias("_moved")))
        state = turn.drop("_moved")
        if not turn.filter("_moved").limit(1).count():
            return state.join(persons.select(F.col("id").alias("person_id"), F.lit(False).alias("_there")), "person_id", "left").select("id", "person_id", F.col("_there").isNull().alias("created"))


def match_events(candidates: DataFrame, events: DataFrame) -> DataFrame:
    """id and event_id of each candidate: the least known event of one type, year and place (nulls equal), or a new id of
    type and year; the n-th new event of a type and year gets suffix n from the second on. Only distinct keys are ranked."""
    key = ["type", "year_bce", "place_id"]
    known = events.groupBy(*(F.col(k).alias(f"_{k}") for k in key)).agg(F.min("id").alias("_known"))
    got = candidates.join(known, [candidates[k].eqNullSafe(known[f"_{k}"]) for k in key], "left")
    base = F.concat(F.lit("evt:"), slug(F.col("type")), F.lit("-"), F.coalesce(F.col("year_bce").cast("string"), F.lit("x")))
    new = got.filter("_known IS NULL").select(*key).distinct().withColumn("_base", base)
    place = F.dense_rank().over(Window.partitionBy("_base").orderBy(F.col("place_id").asc_nulls_first()))
    taken = events.select(F.regexp_extract("id", r"^(evt:.*?-(?:\d+|x))(?:-(\d+))?$", 1).alias("_base"), F.coalesce(F.regexp_extract("id", r"-(?:\d+|x)-(\d+)$", 1).try_cast("int"), F.lit(1)).alias("_n")).groupBy("_base").agg(F.max("_n").alias("_max"))
    new = new.join(taken, "_base", "left").withColumn("_n", place + F.coalesce("_max", F.lit(0)))
    named = new.select(*(F.col(k).alias(f"_{k}") for k in key), F.concat("_base", F.when(F.col("_n") > 1, F.concat(F.lit("-"), F.col("_n"))).otherwise("")).alias("event_id"))
    fresh = got.filter("_known IS NULL").select("id", *key)
    made = fresh.join(settled(named), [fresh[k].eqNullSafe(F.col(f"_{k}")) for k in key]).select("id", "event_id", F.lit(True).alias("created"))
    return got.filter("_known IS NOT NULL").select("id", F.col("_known").alias("event_id"), F.lit(False).alias("created")).unionByName(made)
