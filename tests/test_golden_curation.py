import pytest
from pyspark.sql import functions as F

from inkstone.operators import curation, golden


def test_golden_pairs_and_gates(spark):
    schema = "id string, canonical_name string, variants array<string>, state_id string, social_category string"
    g = spark.createDataFrame([("g1", "重耳", ["晋文公"], "sta:jin", None), ("g2", "管仲", [], "sta:qi", "noble")], schema)
    c = spark.createDataFrame([("c1", "晋文公", [], None, None), ("c2", "管仲", ["夷吾"], "sta:lu", "noble"), ("c3", "重耳", None, "sta:jin", "noble")], schema)
    people = golden.person_pairs(g, c)
    assert {tuple(r) for r in people.collect()} == {("g1", "c1"), ("g1", "c3")}
    events = "id string, type string, place string, year_bce int"
    e = golden.event_pairs(spark.createDataFrame([("g1", "战", "x", 632), ("g2", "战", None, None)], events), spark.createDataFrame([("c1", "战", "y", 633), ("c2", "战", "x", 500), ("c3", "战", None, 400), ("c4", "盟", "x", 632)], events))
    assert {tuple(r) for r in e.collect()} == {("g1", "c1"), ("g1", "c2"), ("g2", "c3")}
    got = {r["kind"]: r for r in golden.precision_recall({"person": people, "event": e}, {"person": (2, 3), "event": (2, 4)}).collect()}
    assert (got["person"]["tp"], got["person"]["fp"], got["person"]["fn"], got["person"]["passed"]) == (1, 2, 1, False)
    assert (got["event"]["tp"], got["event"]["recall"], got["event"]["precision"]) == (2, 1.0, 0.5)


def test_relations_match_on_their_own_columns(spark):
    schema = "id string, kind string, event string, person string, place string, state string, from_event string, to_event string, from_person string, to_person string, relation_kind string, role string"
    row = lambda i, kind, **x: (i, kind, *(x.get(c.split()[0]) for c in schema.split(", ")[2:]))
    g = spark.createDataFrame([row("g1", "event_place", event="e", place="p", role="x"), row("g2", "person_state", person="a", state="s", role="lord"), row("g3", "event_place", event="e", place="q", role="x")], schema)
    c = spark.createDataFrame([row("c1", "event_place", event="e", place="p", role="y"), row("c2", "person_state", person="a", state="s", role="minister"), row("c3", "event_place", event="e", place="q", role="x")], schema)
    assert [tuple(r) for r in golden.relation_pairs(g, c).collect()] == [("g3", "c3")]  # the role of a place counts, too


def test_golden_errors(spark):
    rows = spark.createDataFrame([("a", None, "x", ["c1", "c9"]), ("b", "n", "战", [])], "id string, name string, kind string, citations array<string>")
    cites = spark.createDataFrame([("c1",)], "id string")
    assert {tuple(r) for r in golden.golden_errors(rows, cites, ["name"], {"kind": ["战"]}).collect()} == {("a", "name is missing"), ("a", "kind is not allowed"), ("a", "no such citation: c9")}


def test_queue_and_decisions(spark):
    mc = spark.createDataFrame([("m1", "t1", "c1", "open", 2), ("m2", "t2", "c2", "open", 1), ("m3", "t3", "c3", "merged", 0)], "id string, target_id string, candidate_id string, status string, created_at int")
    assert [(r["id"], r["next_id"]) for r in curation.open_queue(mc).orderBy("place").collect()] == [("m2", "m1"), ("m1", None)]
    after = curation.decide(mc, spark.createDataFrame([("m1", "rejected"), ("m3", "rejected"), ("m2", "deferred")], "id string, status string"))
    assert {r["id"]: r["status"] for r in after.collect()} == {"m1": "rejected", "m2": "open", "m3": "merged"}
    known = spark.createDataFrame([], "canonical_id string, fingerprint string")
    prints = spark.createDataFrame([("c1", "f1"), ("c2", "f2")], "candidate_id string, fingerprint string")
    kept = curation.remembered_rejections(known, after, prints)
    assert [tuple(r) for r in kept.collect()] == [("t1", "f1")] and curation.remembered_rejections(kept, after, prints).count() == 1


def test_edits_dates_cache_and_spans(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "id string, name string, n int")
    edits = spark.createDataFrame([("a", "name", "z", 1), ("a", "name", "w", 2), ("b", "n", "5", 1)], "id string, field string, value string, seq int")
    assert sorted(tuple(r) for r in curation.edited(rows, edits, ["name", "n"]).collect()) == [("a", "w", 1), ("b", "y", 5)]
    with pytest.raises(ValueError, match="may not be edited: n"):
        curation.edited(rows, edits, ["name"])
    events = spark.createDataFrame([("e1", 771, None), ("e2", None, None)], "id string, year_bce int, relative_anchor_event_id string")
    cache = spark.range(1).select(F.sha2(F.lit("q"), 256).alias("key"), F.lit("a").alias("response_json"))
    asked = spark.createDataFrame([("q",), ("r",)], "request_json string")
    assert {r["request_json"]: r["response_json"] for r in curation.cached(asked, cache).collect()} == {"q": "a", "r": None}
    spans = spark.createDataFrame([(None,), ([1],), ([0, 0],), ([None, 3],), ([0, 3],)], "span array<int>")
    assert [r[0] for r in spans.select(curation.needs_span(F.col("span"))).collect()] == [True, True, True, True, False]


def test_neighbouring_chunks_and_audit_ids(spark):
    chunks = spark.createDataFrame([("k1", "d", 0, 1, "a"), ("k2", "d", 1, 3, "b"), ("k3", "d", 6, 7, "c")], "id string, document_id string, paragraph_start int, paragraph_end int, text string")
    cites = spark.createDataFrame([("c", "k1", 1)], "id string, chunk_id string, paragraph int")
    assert [r["near_chunk_id"] for r in curation.around(cites, chunks).orderBy("place").collect()] == ["k1", "k2"]
    change = spark.createDataFrame([("person", "a", "name", "set", None, "{}", 1)] * 2, "entity_kind string, entity_id string, field string, change_kind string, before_json string, after_json string, seq int")
    assert curation.audit_rows(change).select("id").distinct().count() == 1
