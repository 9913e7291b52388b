"""Curated merges against a plain loop over copies of the tables."""

import json
import random

import duckdb
import pytest

from inkstone.operators.curated_merges import EDITABLE, FILLED, accept_merges
from inkstone.operators.graphs import components
from inkstone.plans.queries import ORACLES, QUERIES


def test_accepted_merges(spark):
    persons = spark.createDataFrame([("a", "重耳", None, "ji"), ("b", "晋文公", "sta:jin", "ji"), ("c", "x", None, None), ("d", "y", "sta:qi", None), ("e", "z", "sta:lu", None), ("f", "w", None, None)], "id string, canonical_name string, state_id string, clan_name string")
    queue = spark.createDataFrame([("m1", "a", "b", "open"), ("m2", "d", "e", "open"), ("m3", "c", "f", "merged"), ("m4", "c", "zz", "open")], "id string, target_id string, candidate_id string, status string")
    relations = spark.createDataFrame([("a", "b", "ally", 0.9), ("b", "c", "parent", 0.5), ("a", "c", "parent", 0.5), ("c", "b", "ally", 0.7), ("d", "d", "ally", 0.1)], "from_person_id string, to_person_id string, kind string, confidence double")
    states = spark.createDataFrame([("a", "sta:jin", "ruler", None, 0.3), ("b", "sta:jin", "ruler", None, 0.8)], "person_id string, state_id string, role string, from_date_json string, confidence double")
    cites = spark.createDataFrame([("person", "a", "k"), ("person", "b", "k"), ("person", "b", "j"), ("event", "b", "k")], "entity_kind string, entity_id string, citation_id string")
    variants = spark.createDataFrame([("a", "文公", "谥号"), ("b", "文公", "谥号"), ("b", "公子", "别名")], "person_id string, variant string, kind string")
    tables = {"persons": persons, "merge_candidates": queue, "person_relations": relations, "person_states": states, "entity_citations": cites, "person_variants": variants}
    accepted = spark.createDataFrame([("m1",), ("m2",), ("m3",), ("m4",), ("m9",)], "mc_id string")
    edits = spark.createDataFrame([("m1", "canonical_name", "晋侯重耳")], "mc_id string, field string, value string")
    got = accept_merges(accepted, tables, edits)
    rows = lambda name: sorted(tuple(r) for r in got[name].collect())
    assert ("a", "晋侯重耳", "sta:jin", "ji") in rows("persons") and "b" not in {r[0] for r in rows("persons")} and len(rows("persons")) == 5
    assert rows("refused") == [("m2", 2, "fields differ: state_id"), ("m3", 3, "status is merged"), ("m4", 4, "no such person"), ("m9", 5, "no such merge candidate")]
    assert {r[0]: r[3] for r in rows("merge_candidates")} == {"m1": "merged", "m2": "open", "m3": "merged", "m4": "open"}
    assert rows("person_relations") == [("a", "c", "parent", 0.5), ("c", "a", "ally", 0.7), ("d", "d", "ally", 0.1)] and rows("person_states") == [("a", "sta:jin", "ruler", None, 0.8)]
    assert rows("entity_citations") == [("event", "b", "k"), ("person", "a", "j"), ("person", "a", "k")] and len(rows("person_variants")) == 2
    changes = sorted((r["change_kind"], r["entity_kind"]) for r in got["audit_log"].collect())
    assert changes == [("edit", "person"), ("merge", "person"), ("merge_collision_resolved", "entity_citation"), ("merge_collision_resolved", "person_relation"), ("merge_collision_resolved", "person_relation"), ("merge_collision_resolved", "person_state")]
    barred = accept_merges(accepted.filter("mc_id = 'm1'"), tables, spark.createDataFrame([("m1", "id", "q")], "mc_id string, field string, value string"))
    assert [tuple(r) for r in barred["refused"].collect()] == [("m1", 1, "may not be edited: id")] and barred["persons"].count() == 6


SCHEMAS = {
    "persons": "id string, canonical_name string, gender string, state_id string, clan_name string, confidence double",
    "candidate_persons": "id string, canonical_name string, state_id string, variants_json string, match_target_id string",
    "merge_candidates": "id string, target_id string, candidate_id string, status string",
    "person_variants": "id string, person_id string, variant string, kind string",
    "entity_citations": "entity_kind string, entity_id string, citation_id string",
    "event_participants": "event_id string, person_id string, role string, confidence double",
    "person_relations": "from_person_id string, to_person_id string, kind string, confidence double",
    "person_states": "person_id string, state_id string, role string, from_date_json string, confidence double",
}


def one_by_one(accepted, edits, tables):
    """Each acceptance on what the ones before it left; rows are dicts."""
    t = {k: [dict(r) for r in v] for k, v in tables.items()}
    audit, refused = [], []

    def collide(name, kind, key, out, into, old, row):
        other = next((r for r in t[name] if r is not row and r[old] == into and all(r[k] == row[k] for k in key if k != old)), None)
        if other is not None:
            loser = row if row["confidence"] <= other["confidence"] else other
            t[name] = [r for r in t[name] if r is not loser]
            audit.append((kind, ":".join(str(loser[k] or "null") for k in key), "merge_collision_resolved"))

    for mc_id, seq in accepted:
        mc = next((r for r in t["merge_candidates"] if r["id"] == mc_id), None)
        own = {f: v for m, f, v in edits if m == mc_id}
        people = {r["id"]: r for r in t["persons"]}
        if mc is None or mc["status"] != "open":
            refused.append((mc_id, "no such merge candidate" if mc is None else f"status is {mc['status']}"))
            continue
        into, out = mc["target_id"], mc["candidate_id"]
        candidate = next((r for r in t["candidate_persons"] if r["id"] == out), None)
        b = people.get(out) or candidate
        if into not in people or b is None:
            refused.append((mc_id, "no such person"))
            continue
        if barred := sorted(f for f in own if f not in EDITABLE):
            refused.append((mc_id, f"may not be edited: {barred[0]}"))
            continue
        fields = [f for f in EDITABLE if f in people[into]]
        after = people[into] | own
        if differ := [f for f in fields if f in FILLED and after[f] is not None and b.get(f) is not None and after[f] != b[f]]:
            refused.append((mc_id, f"fields differ: {', '.join(differ)}"))
            continue
        for f in own:
            audit.append(("person", into, "edit"))
        audit.append(("person", into, "merge"))
        people[into].update({f: b.get(f) if after[f] is None and f in FILLED else after[f] for f in fields})
        mc["status"] = "merged"
        if out not in people:
            candidate["match_target_id"] = into
            have = {(r["person_id"], r["variant"], r["kind"]) for r in t["person_variants"]}
            for v in json.loads(candidate["variants_json"] or "[]"):
                if v["variant"] and (into, v["variant"], v["kind"]) not in have:
                    have.add((into, v["variant"], v["kind"]))
                    t["person_variants"].append({"person_id": into, "variant": v["variant"], "kind": v["kind"]})
            continue
        for r in list(t["person_variants"]):
            if r["person_id"] == out:
                if any(q["person_id"] == into and (q["variant"], q["kind"]) == (r["variant"], r["kind"]) for q in t["person_variants"]):
                    t["person_variants"].remove(r)
                r["person_id"] = into
        for r in list(t["person_relations"]):
            if {r["from_person_id"], r["to_person_id"]} == {into, out}:
                t["person_relations"].remove(r)
                audit.append(("person_relation", f"{r['from_person_id']}:{r['to_person_id']}:{r['kind']}", "merge_collision_resolved"))
        for name, kind, key in (("event_participants", "event_participant", ("event_id", "person_id", "role")), ("person_states", "person_state", ("person_id", "state_id", "role", "from_date_json"))):
            for r in [r for r in t[name] if r["person_id"] == out]:
                collide(name, kind, key, out, into, "person_id", r)
            for r in t[name]:
                if r["person_id"] == out:
                    r["person_id"] = into
        for side, kept in (("from_person_id", "to_person_id"), ("to_person_id", "from_person_id")):
            for r in [r for r in t["person_relations"] if r[side] == out]:
                if any(q is not r and q[side] == into and q[kept] == r[kept] and q["kind"] == r["kind"] for q in t["person_relations"]):
                    collide("person_relations", "person_relation", ("from_person_id", "to_person_id", "kind"), out, into, side, r)
            for r in t["person_relations"]:
                if r[side] == out:
                    r[side] = into
        for r in [r for r in t["entity_citations"] if r["entity_kind"] == "person" and r["entity_id"] == out]:
            if any(q["entity_kind"] == "person" and q["entity_id"] == into and q["citation_id"] == r["citation_id"] for q in t["entity_citations"]):
                t["entity_citations"].remove(r)
                audit.append(("entity_citation", f"person:{out}:{r['citation_id']}", "merge_collision_resolved"))
            r["entity_id"] = into
        t["persons"] = [r for r in t["persons"] if r["id"] != out]
    return t, audit, refused


def random_case(seed):
    rng = random.Random(seed)
    n = 14
    some = lambda values, empty=0.5: None if rng.random() < empty else rng.choice(values)
    people = [f"p{k:02}" for k in range(n)]
    t = {
        "persons": [{"id": p, "canonical_name": f"n {p}", "gender": some("mf", 0.6), "state_id": some(["jin", "qi"], 0.8), "clan_name": some(["ji"], 0.5), "confidence": 0.5} for p in people],
        "candidate_persons": [{"id": f"c{k}", "canonical_name": f"c {k}", "state_id": some(["jin", "qi"], 0.8), "variants_json": rng.choice([None, "[]", json.dumps([{"variant": rng.choice("uvw"), "kind": "k"}, {"variant": "", "kind": "k"}])]), "match_target_id": None} for k in range(3)],
        "merge_candidates": [{"id": f"m{k:02}", "target_id": a, "candidate_id": b, "status": rng.choice(["open"] * 9 + ["rejected"])} for k in range(20) for a, b in [rng.sample([*people, "none"], 2)]] + [{"id": f"m{k}", "target_id": rng.choice(people), "candidate_id": f"c{k % 3}", "status": "open"} for k in range(20, 25)],
        "person_variants": [{"person_id": p, "variant": v, "kind": "k"} for p in people for v in rng.sample("uvwx", 2)],
        "entity_citations": [{"entity_kind": k, "entity_id": p, "citation_id": c} for k in ("person", "event") for p in people for c in rng.sample("abcd", 2)],
        "event_participants": [{"event_id": e, "person_id": p, "role": "r", "confidence": rng.choice([0.1, 0.5, 0.9])} for p in people for e in rng.sample("efgh", 2)],
        "person_states": [{"person_id": p, "state_id": s, "role": "r", "from_date_json": d, "confidence": rng.choice([0.1, 0.5])} for p in people for s in ("jin", "qi") for d in rng.sample([None, "{}"], 1)],
        "person_relations": [{"from_person_id": a, "to_person_id": b, "kind": "ally", "confidence": rng.random()} for a, b in {tuple(rng.sample(people, 2)) for _ in range(25)}],
    }
    order = [m["id"] for m in t["merge_candidates"]] + ["m99", "m03"]
    rng.shuffle(order)
    edits = [(m, f, v) for m, f, v in (("m01", "state_id", "jin"), ("m02", "clan_name", "mi"), ("m05", "gender", None), ("m06", "id", "x"), ("m07", "canonical_name", "new")) if rng.random() < 0.8]
    return [(m, k) for k, m in enumerate(order)], edits, t


@pytest.mark.parametrize(("seed", "most"), [(1, 10_000), (2, 3), (3, 1), (4, 10_000)])
def test_merges_equal_one_after_the_other(spark, seed, most):
    """Chains, several into one, refusals between, candidates twice; in runs of any size."""
    accepted, edits, tables = random_case(seed)
    expected, audit, refused = one_by_one(accepted, edits, tables)
    frames = {k: spark.createDataFrame([tuple(r.get(c.split()[0]) for c in SCHEMAS[k].split(", ")) for r in v], SCHEMAS[k]) for k, v in tables.items()}
    got = accept_merges(spark.createDataFrame(accepted, "mc_id string, seq int"), frames, spark.createDataFrame(edits, "mc_id string, field string, value string"), most)
    for name, rows in expected.items():
        columns = [c.split()[0] for c in SCHEMAS[name].split(", ") if c != "id string" or name != "person_variants"]
        assert sorted((tuple(r[c] for c in columns) for r in got[name].collect()), key=repr) == sorted((tuple(r.get(c) for c in columns) for r in rows), key=repr), name
    assert sorted((r["mc_id"], r["reason"]) for r in got["refused"].collect()) == sorted(refused)
    assert sorted((r["entity_kind"], r["entity_id"], r["change_kind"]) for r in got["audit_log"].collect()) == sorted(audit)


def test_a_chain_and_a_star_of_merges(spark):
    """a <- b <- c in an order that allows it and in one that doesn't, and many into one, in runs of 7."""
    n = 60
    persons = spark.createDataFrame([(f"p{k:03}", "m" if k == n else None) for k in range(n + 1)], "id string, gender string")
    queue = [(f"m{k:03}", f"p{k - 1:03}", f"p{k:03}", "open") for k in range(1, n + 1)]
    schema = "id string, target_id string, candidate_id string, status string"
    edges = spark.createDataFrame([("e", f"p{k:03}", "r", k / 100) for k in range(n + 1)], "event_id string, person_id string, role string, confidence double")
    tables = {"persons": persons, "merge_candidates": spark.createDataFrame(queue, schema), "event_participants": edges}
    up = accept_merges(spark.createDataFrame([(m, n - k) for k, (m, *_) in enumerate(queue)], "mc_id string, seq int"), tables, most=7)
    assert [tuple(r) for r in up["persons"].collect()] == [("p000", "m")] and [tuple(r) for r in up["event_participants"].collect()] == [("e", "p000", "r", 0.6)]
    assert up["audit_log"].filter("change_kind = 'merge_collision_resolved'").count() == n
    down = accept_merges(spark.createDataFrame([(m, k) for k, (m, *_) in enumerate(queue)], "mc_id string, seq int"), tables, most=7)
    assert down["persons"].count() == n // 2 + 1 and down["refused"].count() == n // 2
    star = tables | {"merge_candidates": spark.createDataFrame([(m, "p000", out, s) for m, _, out, s in queue], schema)}
    assert [tuple(r) for r in accept_merges(star["merge_candidates"].selectExpr("id AS mc_id"), star, most=7)["persons"].collect()] == [("p000", "m")]


def test_components(spark):
    edges = [(f"n{k:02}", f"n{k + 1:02}") for k in range(30)] + [("x", "y"), ("z", "z"), (None, "x")]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {**{f"n{k:02}": "n00" for k in range(31)}, "x": "x", "y": "x", "z": "z"}


@pytest.mark.parametrize("least", [0, 100_000])
def test_query_with_orders_of_customers_that_are_not_there_matches_sql(spark, tmp_path, least):
    """Orders whose customer's group has no customer; the last one has no customers, so counts of nothing are rows, too."""
    duck = duckdb.connect()
    duck.execute(f"COPY (SELECT * FROM '/root/testdata/sf0.001/customer.parquet' WHERE c_custkey BETWEEN {least} AND {least + 20}) TO '{tmp_path}/customer.parquet'")
    duck.execute(f"COPY (SELECT * FROM '/root/testdata/sf0.001/orders.parquet') TO '{tmp_path}/orders.parquet'")
    for name in ("customer", "orders"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    expected = duck.sql(ORACLES["accept_merges"]).fetchall()
    got = QUERIES["accept_merges"](spark, str(tmp_path)).select("table_name", "id", "value").collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_query_writes_numbers_and_ids_as_its_sql(spark, tmp_path):
    """Zeros below nothing, large numbers, halves, none, and ids of which a part is missing."""
    duck = duckdb.connect()
    values = "[-0.0, 0.0, -0.004, 1e7, 12345678.91, 1.005, 2.675, 0.001, 'nan'::DOUBLE, -5.5]"
    duck.execute(f"COPY (SELECT c_custkey * 8 AS c_custkey, c_name, CASE WHEN c_custkey % 7 > 0 THEN c_nationkey END AS c_nationkey, {values}[c_custkey % 10 + 1] AS c_acctbal, c_mktsegment FROM '/root/testdata/sf0.001/customer.parquet' WHERE c_custkey < 40) TO '{tmp_path}/customer.parquet'")
    duck.execute(f"COPY (SELECT o_orderkey, o_custkey * 8 AS o_custkey, CASE WHEN o_orderkey % 7 > 0 THEN o_orderstatus END AS o_orderstatus, {values}[o_orderkey % 10 + 1] AS o_totalprice FROM '/root/testdata/sf0.001/orders.parquet' WHERE o_custkey < 40 AND o_orderkey < 300) TO '{tmp_path}/orders.parquet'")
    for name in ("customer", "orders"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    expected = duck.sql(ORACLES["accept_merges"]).fetchall()
    got = QUERIES["accept_merges"](spark, str(tmp_path)).select("table_name", "id", "value").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert {"-0.0", "12345678.91", "10000000.0", "1.0", "nan"} < {v for _, _, v in expected} and ("person_states", None, "12345678.91") in expected
