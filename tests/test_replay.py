"""Tables taken back by their logs, after real loads and merges."""

import datetime

from pyspark.sql import functions as F

from inkstone.operators import loading, replay
from inkstone.operators.curated_merges import accept_merges

FIELDS = ["gender", "birth_date_json", "death_date_json", "notes", "state_id", "clan_name"]
PERSONS = "id string, canonical_name string, gender string, birth_date_json string, death_date_json string, notes string, state_id string, clan_name string, social_category string, confidence double, provenance string"
LOG = "entity_kind string, entity_id string, field string, change_kind string, before_json string, after_json string, at timestamp, seq long, run string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def person(i, name, confidence=0.5, **fields):
    return (i, name, *(fields.get(f) for f in (*FIELDS, "social_category")), confidence, "auto")


def entry(i, field, change, before, after, seq, run):
    return ("person", i, field, change, before, after, datetime.datetime(2026, 1, 1 + seq), seq, run)


def test_a_load_and_merges_are_taken_back(spark):
    """As of the load the merges are gone, and as of before it the load is gone too."""
    start = spark.createDataFrame([person("per:a", "重耳", state_id="sta:jin"), person("per:b", "文公", 0.3, gender="f", clan_name="ji"), person("per:c", "狐偃"), person("per:d", "赵衰", notes="x")], PERSONS)
    tables = {
        "persons": start, "person_variants": spark.createDataFrame([], "id string, person_id string, variant string, kind string"),
        "entity_citations": spark.createDataFrame([], "entity_kind string, entity_id string, citation_id string"), "audit_log": spark.createDataFrame([], LOG),
    }
    candidates = [("k1", "狐偃", "m", None, None, "n1", None, "ji", None, None, 0.9, None, None), ("k2", "文公", "m", None, None, None, None, None, None, None, 0.9, None, None), ("k3", "新人", "m", None, None, None, None, None, None, None, 0.9, None, None)]
    schema = "id string, canonical_name string, gender string, birth_date_json string, death_date_json string, notes string, state_id string, clan_name string, social_category string, variants_json string, confidence double, chunk_id string, match_target_id string"
    loaded = loading.load_persons(spark.createDataFrame(candidates, schema), tables, "r1")
    after_load = spark.createDataFrame(loaded["persons"].collect(), PERSONS)
    day = lambda n: F.lit(datetime.datetime(2026, 1, n))
    stamped = lambda df, n, run: df.withColumns({"at": day(n), "run": F.lit(run)})
    log = stamped(loaded["audit_log"].withColumn("seq", F.lit(1).cast("long")), 2, "r1")
    queue = spark.createDataFrame([("m1", "per:b", "per:c", "open"), ("m2", "per:a", "per:b", "open"), ("m3", "per:a", "per:d", "open")], "id string, target_id string, candidate_id string, status string")
    edits = spark.createDataFrame([("m2", "canonical_name", "晋文公"), ("m2", "notes", None)], "mc_id string, field string, value string")
    merged = accept_merges(queue.selectExpr("id AS mc_id"), {"persons": after_load, "merge_candidates": queue}, edits)
    log = log.unionByName(stamped(merged["audit_log"], 3, "curator")).unionByName(stamped(merged["fills"], 3, "curator"))
    now = merged["persons"]
    assert [r["mc_id"] for r in merged["refused"].collect()] == ["m3"] and now.count() == after_load.count() - 2
    fields = [*FIELDS, "canonical_name"]
    assert rows(replay.as_of(now, "person", log, day(2), fields)) == rows(after_load)
    assert rows(replay.as_of(now, "person", log, day(1), fields)) == rows(start)
    assert rows(replay.as_of(now, "person", log, day(3), fields)) == rows(now)


def test_what_changed_later_is_named(spark):
    table = spark.createDataFrame([person("a", "x", state_id="s3", clan_name="c1"), person("b", "y", gender="m"), person("c", "z", notes="n2"), person("d", "w")], PERSONS)
    value = lambda v: f'{{"value": "{v}"}}'
    log = spark.createDataFrame([
        entry("a", "state_id", "set", None, value("s1"), 1, "r"), entry("a", "state_id", "set", value("s1"), value("s2"), 2, "q"), entry("a", "state_id", "set", value("s2"), value("s3"), 3, "r"),
        entry("a", "clan_name", "set", None, value("c1"), 4, "r"), entry("b", None, "create", None, "{}", 1, "r"), entry("b", "gender", "set", None, value("m"), 5, "q"),
        entry("c", "notes", "set", None, value("n1"), 1, "r"), entry("c", "notes", "edit", value("n1"), value("n2"), 2, "q"), entry("d", None, "create", None, "{}", 1, "r"), entry("gone", "notes", "set", None, value("n"), 1, "r"),
        entry("a", None, "merge", '{"id": "c", "canonical_name": "old"}', "{}", 9, "r"),
    ], LOG)
    got, conflicts = replay.without_run(table, "person", log, "r", FIELDS)
    assert {r["id"]: (r["state_id"], r["clan_name"], r["gender"], r["notes"]) for r in got.collect()} == {"a": ("s2", None, None, None), "b": (None, None, "m", None), "c": (None, None, None, "n2")}
    assert sorted((r["entity_id"], str(r["field"]), r["reason"]) for r in conflicts.collect()) == [("b", "None", "row changed later"), ("c", "None", "id is there"), ("c", "notes", "changed later")]
    assert rows(replay.without_run(table, "person", log.limit(0), "r", FIELDS)[0]) == rows(table) and replay.without_run(table.limit(0), "person", log, "r", FIELDS)[0].count() == 1  # who was merged comes back
