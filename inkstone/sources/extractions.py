"""Extraction files: YAML mappings with lists of persons, events, places, states and relations, and the candidates they make.

Files are parsed by tasks, one object a row, and lists become rows by Spark's JSON functions. A file whose top isn't a
mapping, or is no YAML, gives a row of `problems`.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstone.functions.reign_dates import DATE, walk_offset
from inkstone.operators.evaluation import confidence
from inkstone.operators.timeline import walk_relative
from inkstone.operators.rows import last_rows
from inkstone.operators.validation import check_records, check_relations, schema_violations, unknown_properties
from inkstone.sources.storage import settled

CITATION = "struct<chunk_id:string,paragraph:int,span:array<int>,quote:string>"
WHY = f"citation {CITATION}, justifications map<string,string>"
RECORDS = {
    "persons": f"id string, canonical_name string, gender string, social_category string, birth_date {DATE}, death_date {DATE}, state_id string, clan_name string, notes string, {WHY}",
    "events": f"id string, type string, date {DATE}, outcome string, summary string, primary_place_id string, {WHY}",
    "places": f"id string, name string, type string, lat double, lon double, coord_confidence double, modern_equiv string, {WHY}",
    "states": f"id string, name string, type string, ruling_clan string, founded_date {DATE}, ended_date {DATE}, {WHY}",
    "relations": f"kind string, event_id string, person_id string, place_id string, state_id string, from_event_id string, to_event_id string, from_person_id string, to_person_id string, role string, role_detail string, relation_kind string, kind_detail string, citation {CITATION}",
}
# Parts of ids, the fields whose justifications count, properties, required ones, enumerations and patterns.
PREFIX = {"persons": "per", "events": "evt", "places": "pla", "states": "sta"}
SCORED = {"persons": ["canonical_name", "gender", "state_id", "clan_name"], "events": ["type", "outcome", "summary", "primary_place_id"], "places": ["name", "type", "modern_equiv"], "states": ["name", "type", "ruling_clan"]}
PROPERTIES = {
    "persons": ("id", "canonical_name", "variants", "gender", "social_category", "birth_date", "death_date", "state_id", "clan_name", "citation", "justifications"),
    "events": ("id", "type", "date", "outcome", "summary", "primary_place_id", "citation", "justifications"),
    "places": ("id", "name", "type", "lat", "lon", "coord_confidence", "modern_equiv", "citation", "justifications"),
    "states": ("id", "name", "type", "ruling_clan", "founded_date", "ended_date", "citation", "justifications"),
}
CATEGORIES = ("royalty", "noble", "official", "military", "religious", "clergy", "commoner", "servant", "foreign", "mythic", "unknown")
RULES = {
    "persons": {"required": ("id", "canonical_name", "citation", "justifications"), "enums": {"gender": ("male", "female", "unknown"), "social_category": CATEGORIES}, "patterns": {"id": r"^p\d+$", "canonical_name": ".", "state_id": r"^(s\d+|sta:[\p{L}\p{N}_\-]+)$"}},
    "events": {"required": ("id", "type", "citation", "justifications"), "patterns": {"id": r"^e\d+$", "type": ".", "primary_place_id": r"^(pl\d+|pla:[\p{L}\p{N}_\-]+)$"}},
    "places": {"required": ("id", "name", "citation", "justifications"), "patterns": {"id": r"^pl\d+$", "name": "."}, "least": {"coord_confidence": 0.0}},
    "states": {"required": ("id", "name", "citation", "justifications"), "patterns": {"id": r"^s\d+$", "name": "."}},
}


def yaml_objects(spark: SparkSession, path: str) -> DataFrame:
    """path, body (JSON text) and error of each YAML file."""

    def parsed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        for frame in frames:
            rows = []
            for name, text in zip(frame["path"], frame["value"], strict=True):
                try:
                    rows.append((name, json.dumps(yaml.safe_load(text), ensure_ascii=False, default=str), None))
                except yaml.YAMLError as e:
                    rows.append((name, None, f"no YAML: {e}"))
            yield pd.DataFrame(rows, columns=["path", "body", "error"])

    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value").mapInPandas(parsed, "path string, body string, error string")


def read_extractions(spark: SparkSession, path: str, run: str) -> dict[str, DataFrame]:
    """The rows of each list (with run, pos, the record's JSON as body, and its fields), and problems (path, error)."""
    files = settled(yaml_objects(spark, path))
    lists = {k: F.get_json_object("body", f"$.{k}") for k in RECORDS}
    missing = F.concat_ws(", ", *(F.when(~F.coalesce(v.startswith("["), F.lit(False)), k) for k, v in lists.items()))
    error = F.coalesce("error", F.when(~F.coalesce(F.col("body").startswith("{"), F.lit(False)), "top level must be a mapping"), F.when(missing != "", F.concat(F.lit("no list: "), missing)))
    out = {"problems": files.select("path", error.alias("error")).filter("error IS NOT NULL")}
    for kind, schema in RECORDS.items():
        own = files.select("path", F.posexplode(F.from_json(lists[kind], "array<string>")).alias("pos", "body"))
        out[kind] = own.select(F.lit(run).alias("run"), "pos", "body", F.from_json("body", schema).alias("r")).select("run", "pos", "body", "r.*", F.col("r.citation.chunk_id").alias("chunk_id"), F.col("r.citation.quote").alias("quote"))
    return out


def declared_ids(parts: dict[str, DataFrame]) -> DataFrame:
    """run and local_id of every record."""
    out = None
    for kind in PREFIX:
        own = parts[kind].select("run", F.col("id").alias("local_id"))
        out = own if out is None else out.unionByName(own)
    return out.distinct()


def broken_rules(parts: dict[str, DataFrame]) -> DataFrame:
    """kind, id, field and rule of what breaks the records' schema, properties that it doesn't have among it."""
    out = None
    for kind, rules in RULES.items():
        own = schema_violations(parts[kind], "id", **rules).unionByName(unknown_properties(parts[kind], "id", "body", PROPERTIES[kind])).select(F.lit(kind).alias("kind"), "id", "field", "rule")
        out = own if out is None else out.unionByName(own)
    return out


def with_resolved_dates(events: DataFrame) -> DataFrame:
    """Events in order of their file, whose relative dates have a year where an earlier event gives one."""
    d = events.withColumns({"is_relative": F.coalesce(F.col("date.inference_kind") == "relative_to_prior_event", F.lit(False)), "year_bce": F.col("date.year_bce"), "offset": walk_offset(F.col("date.original"))})
    got = walk_relative(d, ["run"], ["pos"])
    year = F.coalesce("date.year_bce", F.col("resolved_year").cast("int"))
    return got.withColumn("date", F.when(F.col("date").isNotNull(), F.col("date").withField("year_bce", year))).select(*events.columns)


def extraction_candidates(parts: dict[str, DataFrame], chunks: DataFrame, run: str) -> dict[str, DataFrame]:
    """Candidate tables of the records that hold, `violations` (kind, id, violation) of the others, and `stats` (kind, n).
    Local ids in relations become candidates' ids; records that fail are left out, and so are relations of unknown chunks."""
    parts = {**parts, "events": with_resolved_dates(parts["events"])}
    declared = settled(declared_ids(parts))
    out, violations = {}, None
    text = lambda path: F.get_json_object("body", f"$.{path}")
    as_json = lambda d: F.when(F.col(d).isNotNull(), F.to_json(d))
    columns: dict[str, list[Column | str]] = {
        "persons": ["canonical_name", "gender", as_json("birth_date").alias("birth_date_json"), as_json("death_date").alias("death_date_json"), "notes", "state_id", "clan_name", "social_category", text("variants").alias("variants_json"), F.lit(None).cast("string").alias("match_target_id")],
        "events": ["type", as_json("date").alias("date_json"), "outcome", "summary", "primary_place_id"],
        "places": ["name", "type", "lat", "lon", "coord_confidence", "modern_equiv"],
        "states": ["name", "type", "ruling_clan", as_json("founded_date").alias("founded_date_json"), as_json("ended_date").alias("ended_date_json")],
    }
    known = None
    for kind, prefix in PREFIX.items():
        checked = settled(check_records(parts[kind], chunks, declared))
        bad = checked.filter("violation IS NOT NULL").select(F.lit(kind).alias("kind"), "id", "violation")
        violations = bad if violations is None else violations.unionByName(bad)
        held = checked.filter("violation IS NULL").withColumn("cand_id", F.concat(F.lit(f"cand:{prefix}:{run}:"), "id"))
        trust = F.round(confidence(F.col("quote"), F.col("justifications"), SCORED[kind]), 6)
        out[f"candidate_{kind}"] = held.select(F.col("cand_id").alias("id"), "run", *columns[kind], trust.alias("confidence"), "chunk_id", "quote")
        ids = held.select(F.col("id").alias("local_id"), "cand_id")
        known = ids if known is None else known.unionByName(ids)
    known = settled(last_rows(known, ["local_id"]))
    relations = check_relations(parts["relations"], chunks)
    violations = violations.unionByName(relations.filter("violation IS NOT NULL").select(F.lit("relations").alias("kind"), F.col("pos").cast("string").alias("id"), "violation"))
    held = relations.filter("violation IS NULL")

    def edges(relation: str, ends: dict[str, str], **more: Column) -> DataFrame:
        got = held.filter(F.col("kind") == relation).select("run", F.col("pos").alias("seq"), *(F.col(a).alias(b) for a, b in ends.items()), *(c.alias(name) for name, c in more.items()))
        for end in ends.values():
            got = got.join(known.select(F.col("local_id").alias(end), "cand_id"), end, "left").withColumn(end, F.coalesce("cand_id", end)).drop("cand_id")
        return got

    blank = lambda c: F.coalesce(c, F.lit(""))
    out["candidate_event_participants"] = edges("event_participant", {"event_id": "event_id", "person_id": "person_id"}, role=blank("role"), role_detail=F.col("role_detail"))
    out["candidate_event_places"] = edges("event_place", {"event_id": "event_id", "place_id": "place_id"}, role=blank("role"))
    out["candidate_event_relations"] = edges("event_relation", {"from_event_id": "from_event_id", "to_event_id": "to_event_id"}, kind=F.coalesce("relation_kind", F.lit("related")))
    out["candidate_person_relations"] = edges("person_relation", {"from_person_id": "from_person_id", "to_person_id": "to_person_id"}, kind=blank("kind_detail"), date_json=text("date"))
    out["candidate_person_states"] = edges("person_state", {"person_id": "person_id", "state_id": "state_id"}, role=blank("role"), from_date_json=text("from_date"), to_date_json=text("to_date"))
    counted = None
    for kind in PREFIX:
        own = out[f"candidate_{kind}"].agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
        counted = own if counted is None else counted.unionByName(own)
    out["stats"] = counted.unionByName(held.agg(F.count("*").alias("n")).select(F.lit("relations").alias("kind"), "n"))
    out["violations"] = violations
    return out
