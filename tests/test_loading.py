"""Loading: folds, persons, events, relations, merges, extractions and the command line, against plain loops and known cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from inkstone import cli
from inkstone.operators import curation, evaluation, linking, loading, merging, timeline, validation
from inkstone.sources import extractions, storage


def loop(proposals, start):
    """(action, old value, old confidence) of each proposal, one after the other."""
    value, trust, curated = start
    out = []
    for v, c in proposals:
        action = "keep" if v is None or v == value else "set" if value is None or (not curated and c > trust + 0.1) else "conflict"
        out.append((action, value, trust))
        if action == "set":
            value, trust = v, c
    return out


@pytest.mark.parametrize("most", [1_000, 3])
def test_proposals_act_as_in_a_loop(spark, most):
    """Long keys, which are found by turns, act as folded ones do."""
    rng = random.Random(5)
    rows, start, expected = [], [], {}
    for key in range(25):
        own = [(rng.choice(["a", "b", "c", None]), rng.randrange(11) / 10) for _ in range(rng.choice([1, 2, 5, 40]))]
        begin = (rng.choice([None, "a", "z"]), rng.randrange(8) / 10, rng.random() < 0.2) if key % 3 else (None, 0.0, False)
        start += [(key, *begin)] if key % 3 else []
        rows += [(key, pos, *p) for pos, p in enumerate(own)]
        expected |= {(key, pos): got for pos, got in enumerate(loop(own, begin))}
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, pos int, value string, confidence double").repartition(3)
    begun = spark.createDataFrame(start, "k int, value string, confidence double, curated boolean")
    got = merging.applied(df, ["k"], ["pos"], begun, most=most)
    assert {(r["k"], r["pos"]): (r["action"], r["old_value"], r["old_confidence"]) for r in got.collect()} == expected
    final = {r["k"]: r["value"] for r in merging.outcome(got, ["k"], ["pos"]).collect()}
    assert final == {k: next((v for kk, _, v, _, a in sorted(((*r[:4], expected[r[0], r[1]][0]) for r in rows), key=lambda r: -r[1]) if kk == k and a == "set"), None) for k in range(25)}


def test_dates_act_as_in_a_loop(spark):
    rng = random.Random(6)
    rank = {"point": 3, "circa": 2, "range": 1}
    entities, rows, expected = [], [], {}
    for e in range(60):
        trust, date = rng.randrange(11) / 10, rng.choice([None, "point", "circa", "range"])
        now = (date, "old") if date else None
        entities.append((str(e), json.dumps({"uncertainty": date, "original": "old"}) if date else None, trust))
        for k in range(rng.choice([0, 1, 3, 12])):
            u, c = rng.choice(list(rank)), rng.randrange(11) / 10
            rows.append((str(e), 0, f"c{k:02}", json.dumps({"uncertainty": u, "original": f"c{k}"}), c))
            if now is None:
                now = (u, f"c{k}")
            elif rank[u] > rank[now[0]] and c >= trust - 0.1:
                now = (u, f"c{k}")
            elif rank[now[0]] > rank[u] and trust >= c - 0.1:
                pass
            elif c > trust:
                now = (u, f"c{k}")
        if now and now[1] != "old":
            expected[str(e)] = now[1]
    df = spark.createDataFrame(rows, "entity_id string, pass int, id string, date_json string, confidence double")
    got = loading.merged_dates(spark.createDataFrame(entities, "id string, date_json string, confidence double"), df)
    assert {r["id"]: json.loads(r["date_json"])["original"] for r in got.collect()} == expected


PERSON = "id string, canonical_name string, gender string, birth_date_json string, death_date_json string, notes string, state_id string, clan_name string, social_category string, confidence double, provenance string"


def test_persons_are_made_and_merged(spark):
    persons = spark.createDataFrame([("per:a", "重耳", None, '{"year_bce": 697, "era": null}', None, None, "sta:jin", "ji", None, 0.8, "auto"), ("per:b", "管仲", None, None, None, None, "sta:qi", None, None, 1.0, "curated")], PERSON)
    cand = "id string, canonical_name string, gender string, birth_date_json string, death_date_json string, notes string, state_id string, clan_name string, social_category string, confidence double, variants_json string, chunk_id string, match_target_id string"
    rows = [
        ("c1", "重耳", "male", '{"era":null,"year_bce":697}', None, None, "sta:jin", "other", None, 0.85, '[{"variant": "文公", "kind": "谥号"}, {"variant": ""}]', "k1", None),
        ("c2", "管仲", None, None, None, None, "sta:lu", None, "noble", 0.9, '[{"variant": "夷吾"}]', "k1", None),
        ("c3", "新人", "male", None, None, None, None, None, None, 0.7, None, "k2", None), ("c4", "别名", "female", None, None, None, None, None, "noble", 0.9, "broken", "k2", "c3"),
    ]
    log = spark.createDataFrame([("person", "per:a", "clan_name", '{"value": "ji", "confidence": 0.7}', 1, 1)], "entity_kind string, entity_id string, field string, after_json string, at int, seq int")
    empty = spark.createDataFrame([], "entity_kind string, entity_id string, citation_id string")
    tables = {"persons": persons, "person_variants": spark.createDataFrame([], "id string, person_id string, variant string, kind string"), "entity_citations": empty, "audit_log": log}
    got = loading.load_persons(spark.createDataFrame(rows, cand), tables, "run-1")
    people = {r["canonical_name"]: r for r in got["persons"].collect()}
    assert (people["重耳"]["gender"], people["重耳"]["clan_name"]) == ("male", "other")  # 0.85 > 0.7 + 0.1, though not > 0.8 + 0.1
    assert (people["管仲"]["state_id"], people["管仲"]["social_category"]) == ("sta:qi", "noble")
    assert (people["新人"]["gender"], people["新人"]["social_category"], people["新人"]["provenance"]) == ("female", "noble", "auto") and "别名" not in people
    assert {(r["person_id"], r["variant"], r["kind"]) for r in got["person_variants"].collect()} == {("per:a", "文公", "谥号"), ("per:b", "夷吾", "别名")}
    assert [(r["entity_id"], r["field"], r["best_idx"]) for r in got["conflicts"].collect()] == [("per:b", "state_id", 0)]
    assert {(r["entity_id"], r["citation_id"]) for r in got["entity_citations"].collect()} == {("per:a", "k1"), ("per:b", "k1"), (people["新人"]["id"], "k2")}
    changes = sorted((r["change_kind"], r["field"]) for r in got["audit_log"].collect())
    assert changes == [("create", None), ("set", "clan_name"), ("set", "gender"), ("set", "gender"), ("set", "social_category"), ("set", "social_category")]


def test_candidates_become_persons_as_in_a_loop(spark):
    """Names and variants that earlier candidates made or wrote, targets among candidates, and what was there before."""
    rng = random.Random(8)
    for _ in range(4):
        names = [f"n{k}" for k in range(12)]
        persons = {n: f"per:{n}" for n in names[:2]}
        variants = {names[2]: "per:n0"}
        rows, written = [], []
        for k in range(40):
            target = rng.choice([None, None, None, "per:n1", "per:none", f"c{rng.randrange(40):02}"])
            rows.append((f"c{k:02}", rng.choice(names), target))
            written += [(f"c{k:02}", rng.choice(names)) for _ in range(rng.choice([0, 0, 1, 2]))]
        expected, by_name, by_variant, ids = {}, dict(persons), dict(variants), set(persons.values())
        for i, name, target in sorted(rows, key=lambda r: (r[2] is not None, r[0])):
            own = (target if target in ids and not target.startswith("c") else expected.get(target)) or by_name.get(name) or by_variant.get(name)
            if own is None:
                own = by_name[name] = f"new {name}"
            expected[i] = own
            for j, v in written:
                if j == i:
                    by_variant.setdefault(v, own)
        got = validation.match_persons(
            spark.createDataFrame(rows, "id string, canonical_name string, match_target_id string"), spark.createDataFrame([(p, n) for n, p in persons.items()], "id string, canonical_name string"),
            spark.createDataFrame([(p, v) for v, p in variants.items()], "person_id string, variant string"), spark.createDataFrame(written, "id string, variant string"),
        ).collect()
        assert {r["id"]: f"new {r['person_id'][4:-7]}" if r["created"] else r["person_id"] for r in got} == expected


def test_relations_are_appended_once(spark):
    known = spark.createDataFrame([("per:b", "per:a", "parent")], "from_person_id string, to_person_id string, kind string")
    rows = [("per:a", "per:b", "parent", None, 1), ("per:a", "per:b", "parent", None, 2), ("per:b", "per:a", "parent", None, 3), (None, "per:a", "ally", None, 4), ("per:a", "per:c", "stranger", None, 5), ("per:a", "per:c", "ally", None, 6)]
    empty = spark.createDataFrame([], "entity_kind string, entity_id string, citation_id string")
    got = loading.load_relations("person_relations", spark.createDataFrame(rows, "from_person_id string, to_person_id string, kind string, date_json string, seq long"), {"person_relations": known, "entity_citations": empty}, "r")
    assert sorted(tuple(r)[:3] for r in got["person_relations"].collect()) == [("per:a", "per:b", "parent"), ("per:a", "per:c", "ally")]
    assert {r["confidence"] for r in got["person_relations"].collect()} == {0.9}
    assert [r["entity_id"] for r in got["conflicts"].collect()] == ["per:b:per:a:parent"] and got["entity_citations"].count() == 3 and got["audit_log"].count() == 2
    states = [("per:a", "sta:jin", "ruler", None, None, 1), ("per:a", "sta:jin", "ruler", None, None, 2), ("per:a", "sta:jin", "cook", None, None, 3)]
    kept = loading.load_relations("person_states", spark.createDataFrame(states, "person_id string, state_id string, role string, from_date_json string, to_date_json string, seq long"), {"person_states": spark.createDataFrame([], "person_id string, state_id string, role string, from_date_json string"), "entity_citations": empty}, "r")
    assert [r["entity_id"] for r in kept["audit_log"].collect()] == ["per:a:sta:jin:ruler:null"]


def test_link_writes_and_stats(spark):
    actions = spark.createDataFrame([("p1", "t1", 90, "auto"), ("p2", "t2", 50, "queue"), ("p3", None, None, "skip"), ("p4", "t1", 50, "rejected")], "cand string, target string, score100 int, action string")
    best = spark.createDataFrame([(c, t, "strong", "same", "same", "same", "unknown") for c, t in (("p1", "t1"), ("p2", "t2"), ("p4", "t1"))], "cand string, target string, overlap string, state string, clan string, social string, time string")
    got = linking.link_writes(actions, best, "r", F.lit("2026-01-01").cast("timestamp"))
    assert [tuple(r) for r in got["candidate_targets"].collect()] == [("p1", "t1")]
    assert [(r["target_id"], r["candidate_id"], r["score"], r["status"]) for r in got["merge_candidates"].collect()] == [("t2", "p2", 0.5, "open")]
    assert json.loads(got["audit_log"].first()["after_json"]) == {"value": "t1", "score": 0.9, "features": {"overlap": "strong", "state": "same", "clan": "same", "social": "same", "time": "unknown"}}
    assert linking.link_stats(actions).first().asDict() == {"candidates_processed": 4, "auto_merges": 1, "queued": 1, "skipped": 1, "rejected_filter_skipped": 1, "already_open_skipped": 0}


def test_numbers_over_all_rows(spark):
    rows = [(i * 7 % 500, f"x{i}") for i in range(500)]
    got = timeline.numbered(spark.createDataFrame(rows, "a int, b string").repartition(6), ["a"]).collect()
    assert {r["a"]: r["place"] for r in got} == {i: i + 1 for i in range(500)}
    assert timeline.numbered(spark.createDataFrame([], "a int, b string"), ["a"]).count() == 0


def named_tables(spark, existing, log=()):
    return {
        "places": spark.createDataFrame(existing, "id string, name string, confidence double, lat double, type string, provenance string"), "entity_citations": spark.createDataFrame([("place", "pla:x", "k1")], "entity_kind string, entity_id string, citation_id string"),
        "audit_log": spark.createDataFrame(list(log), "entity_kind string, entity_id string, field string, after_json string, at int, seq int"),
    }


PLACE_ROWS = "id string, name string, confidence double, seq int, lat double, type string, chunk_id string"


def test_names_of_one_slug_get_ids_of_their_own(spark):
    new = [("a b", 0.5, 1, 1.0), ("c!d", 0.5, 3, 2.0), ("c d", 0.5, 2, 3.0), ("!!", 0.5, 4, 4.0), ("??", 0.5, 5, 5.0)]
    got = loading.load_named("place", spark.createDataFrame([(f"k{s}", n, c, s, x, None, None) for n, c, s, x in new], PLACE_ROWS), named_tables(spark, [("pla:a-b", "known", 0.5, None, None, None)]), ("lat", "type"))
    ids = {r["name"]: r["id"] for r in got["places"].collect()}
    assert len(set(ids.values())) == 6 and ids["c d"] == "pla:c-d" and ids["a b"].startswith("pla:a-b-") and len(ids["!!"]) == len("pla:") + 8


def test_places_fold_every_candidate(spark):
    """A row that only fills, one whose value differs, a field's own confidence, a row's that falls; random rows against a loop."""
    rng = random.Random(3)
    existing = [("pla:x", "X", 0.9, None, "city", "auto"), ("pla:y", "Y", None, 1.0, None, "auto"), ("pla:z", None, 0.4, 1.0, None, "auto")]
    log = [("place", "pla:x", "type", '{"confidence": 0.1}', 1, 1), ("place", "pla:x", "type", '{"confidence": 0.2}', 1, 2), ("place", "pla:y", "lat", '{"confidence": 0.0}', 1, 3)]
    rows = [(f"k{k:02}", rng.choice(["X", "Y", "New", None]), rng.choice([None, 0.1, 0.3, 0.35, 0.5, 0.8]), rng.randrange(30), rng.choice([None, 1.0, 2.0]), rng.choice([None, "city", "pass"]), rng.choice([None, "k1", "k2"])) for k in range(60)]
    fields, state, said, audit, cited = ("lat", "type"), {n: {"id": i, "c": c or 0.0, "lat": lat, "type": t} for i, n, c, lat, t, _ in existing if n}, {("pla:x", "type"): 0.2, ("pla:y", "lat"): 0.0}, [], {("place", "pla:x", "k1")}
    for i, name, c, _, lat, kind, chunk in sorted(rows, key=lambda r: (r[3], r[0])):
        if name is None:
            continue
        if name not in state:
            state[name] = {"id": "pla:new", "c": c or 0.0, "lat": lat, "type": kind}
            audit.append(("pla:new", None, "create"))
        else:
            e = state[name]
            row_confidence = e["c"]
            for f, v in (("lat", lat), ("type", kind)):
                if v is None or v == e[f]:
                    continue
                prior = said.get((e["id"], f)) or row_confidence
                if e[f] is None or (c is not None and c > prior + 0.1):
                    audit.append((e["id"], f, "set"))
                    if e[f] is not None:
                        e["c"] = c
                    e[f], said[e["id"], f] = v, c or 0.0
        if chunk:
            cited.add(("place", state[name]["id"], chunk))
    got = loading.load_named("place", spark.createDataFrame(rows, PLACE_ROWS), named_tables(spark, existing, log), fields)
    found = {r["name"]: (r["id"], r["confidence"] or 0.0, r["lat"], r["type"]) for r in got["places"].collect()}
    assert found == {None: ("pla:z", 0.4, 1.0, None)} | {n: (e["id"], e["c"], e["lat"], e["type"]) for n, e in state.items()}
    assert sorted((r["entity_id"], str(r["field"]), r["change_kind"]) for r in got["audit_log"].collect()) == sorted((a, str(b), c) for a, b, c in audit)
    assert {tuple(r) for r in got["entity_citations"].collect()} == cited - {("place", "pla:x", "k1")} and got["ids"].count() == sum(r[1] is not None for r in rows)
    again = loading.load_named("place", spark.createDataFrame([], PLACE_ROWS), named_tables(spark, existing), fields)
    assert again["places"].count() == 3 and again["audit_log"].count() == 0


def test_smoke_check(spark):
    runs = spark.createDataFrame([("r", '{"dates_out_of_range": 2}'), ("q", None)], "id string, stats_json string")
    persons = spark.createDataFrame([("p", "q")], "id string, run string")
    tables = {"pipeline_runs": runs, "persons": persons, "events": spark.createDataFrame([("e",)], "id string"), "event_participants": spark.createDataFrame([("e", "p"), ("e", "lost")], "event_id string, person_id string"), "person_relations": spark.createDataFrame([("p", "p")], "from_person_id string, to_person_id string")}
    got = evaluation.smoke_check("r", tables).first()
    assert (got["status"], got["failures"], got["warnings"], got["fk_orphans"]) == ("fail", ["fk_orphan: event_participants.person_id (1)"], ["dates_out_of_range", "zero_persons"], 1)
    good = evaluation.smoke_check("q", tables | {"event_participants": tables["event_participants"].limit(0)}).first()
    assert (good["status"], good["failures"], good["warnings"], good["n_persons"]) == ("pass", [], [], 1)
    assert evaluation.smoke_check("no", tables).first()["failures"] == ["no_pipeline_run"]


def test_dates_are_resolved_with_audit(spark):
    events = spark.createDataFrame([("e1", 771, None), ("e2", None, None), ("e3", None, None)], "id string, year_bce int, relative_anchor_event_id string")
    decided = spark.createDataFrame([("e2", "e1", 3), ("e3", "e2", 1), ("e1", "e1", 1)], "event_id string, anchor_id string, later int")
    moved, audit, refused = curation.resolve_dates(events, decided)
    assert {r["id"]: r["year_bce"] for r in moved.collect()} == {"e1": 771, "e2": 768, "e3": None}
    assert [(r["entity_id"], r["change_kind"], json.loads(r["after_json"])["year_bce"]) for r in audit.collect()] == [("e2", "curator_override", 768)]
    assert sorted(r[0] for r in refused.collect()) == ["e1", "e3"]


def test_tokens_are_replaced_whole(spark):
    ids = spark.createDataFrame([("evt:1:per:a:lord",), ("evt:1:per:ab:lord",), ("per:a",), ("per:a:per:a",), (None,)], "x string")
    got = [r[0] for r in ids.select(curation.replaced_token(F.col("x"), "per:a", "per:$b")).collect()]
    assert got == ["evt:1:per:$b:lord", "evt:1:per:ab:lord", "per:$b", "per:$b:per:$b", None]


YAML = """
persons:
- {id: p1, canonical_name: 重耳, gender: male, state_id: s1, variants: [{variant: 文公, kind: 谥号}], citation: {chunk_id: 'chk:novel:1:0', paragraph: 1, span: [0, 2], quote: 重耳奔狄}, justifications: {canonical_name: 重耳}}
- {id: p2, canonical_name: 狐偃, citation: {chunk_id: 'chk:novel:1:0', paragraph: 1, span: [0, 2], quote: 不在}, justifications: {}}
events:
- {id: e1, type: 奔, date: {year_bce: 655, inference_kind: explicit_reign_lu, original: 僖公五年, uncertainty: point}, primary_place_id: pl1, citation: {chunk_id: 'chk:novel:1:0', paragraph: 1, span: [0, 2], quote: 重耳奔狄}, justifications: {}}
- {id: e2, type: 战, date: {year_bce: null, inference_kind: relative_to_prior_event, original: 明年}, citation: {chunk_id: 'chk:novel:1:0', paragraph: 1, span: [0, 2], quote: 奔狄}, justifications: {}}
places:
- {id: pl1, name: 狄, citation: {chunk_id: 'chk:novel:1:0', paragraph: 1, span: [0, 2], quote: 狄}, justifications: {}}
states:
- {id: s1, name: 晋, citation: {chunk_id: 'chk:novel:1:0', paragraph: 1, span: [0, 2], quote: 重耳奔狄}, justifications: {}}
relations:
- {kind: event_participant, event_id: e1, person_id: p1, role: 主, citation: {chunk_id: 'chk:novel:1:0', paragraph: 1, span: [0, 2], quote: 重耳奔狄}}
- {kind: person_state, person_id: p1, state_id: s1, role: ruler, citation: {chunk_id: 'chk:novel:1:0', paragraph: 1, span: [0, 2], quote: 重耳奔狄}}
- {kind: event_place, event_id: e1, place_id: pl1, role: 地, citation: {chunk_id: 'chk:none', paragraph: 1, span: [0, 2], quote: 狄}}
"""


def test_extraction_rules(spark, tmp_path):
    (tmp_path / "a.yaml").write_text(YAML.replace("gender: male", "gender: male, height: 9").replace("id: pl1, name", "id: x1, name"), encoding="utf-8")
    parts = extractions.read_extractions(spark, str(tmp_path / "a.yaml"), "r")
    assert parts["problems"].count() == 0
    assert {(r["kind"], r["id"], r["field"], r["rule"]) for r in extractions.broken_rules(parts).collect()} == {("persons", "p1", "height", "closed"), ("places", "x1", "id", "pattern")}
    for name, text in (("list.yaml", "- 1"), ("bad.yaml", "a: [1"), ("part.yaml", "persons: []\nevents: []")):
        (tmp_path / name).write_text(text)
        assert extractions.read_extractions(spark, str(tmp_path / name), "r")["problems"].count() == 1


def test_extracting_and_loading_by_the_command_line(spark, tmp_path, capsys):
    folder = str(tmp_path / "state")
    (tmp_path / "book.json").write_text(json.dumps({"title": "T", "chapters": [{"title": "a", "content": "重耳奔狄"}]}))
    (tmp_path / "x.yaml").write_text(YAML, encoding="utf-8")
    cli.main(["ingest", folder, str(tmp_path / "book.json"), "--corpus", "novel"])
    cli.main(["chunk", folder])
    for chapter, code in (("1", 0), ("2", 1)):
        with pytest.raises(SystemExit) as end:
            cli.main(["extract", folder, "--chapter", chapter])
        assert end.value.code == code
    cli.main(["extract-load", folder, str(tmp_path / "x.yaml"), "--chapter", "1", "--run", "r1"])
    said = capsys.readouterr().out
    assert "persons=1" in said and "relations=2" in said and "invariant violations: 2" in said
    read = lambda name: [r.asDict() for r in storage.read(spark, folder, name).collect()]
    assert {r["date_json"] and json.loads(r["date_json"]).get("year_bce") for r in read("candidate_events")} == {655, 654}
    for _ in range(2):  # loading again adds nothing
        cli.main(["load", folder, "r1"])
        written = json.loads(capsys.readouterr().out)
        assert (written["persons"], written["events"], written["event_participants"], written["person_states"], written["person_variants"], written["conflicts"]) == (1, 2, 1, 1, 1, 0)
    assert read("persons")[0]["state_id"] == "sta:晋" and {r["primary_place_id"] for r in read("events")} == {"pla:狄", None}
    with pytest.raises(SystemExit) as end:
        cli.main(["smoke-check", folder, "r1"])
    assert end.value.code == 0 and json.loads(capsys.readouterr().out)["n_persons"] == 1
    cli.main(["list-unresolved-dates", folder])
    assert capsys.readouterr().out == ""
    later, first = (next(r["id"] for r in read("events") if r["type"] == t) for t in ("战", "奔"))
    cli.main(["resolve-relative-date", folder, later, first, "--years-later", "5"])
    assert next(json.loads(r["date_json"])["year_bce"] for r in read("events") if r["id"] == later) == 650
    assert any(r["change_kind"] == "curator_override" for r in read("audit_log"))
    cli.main(["qa-sample", folder, "r1", str(tmp_path / "sample.yaml")])
    assert "重耳" in (tmp_path / "sample.yaml").read_text(encoding="utf-8")
    capsys.readouterr()
    golden = tmp_path / "golden"
    golden.mkdir()
    (golden / "persons.yaml").write_text("- {id: g1, canonical_name: 文公, variants: [], citations: []}\n", encoding="utf-8")
    (golden / "events.yaml").write_text("- {id: g2, type: 奔, date: {year_bce: 655, inference_kind: explicit_reign_lu}, citations: []}\n- {id: g3, type: 战, date: {year_bce: 650, inference_kind: unknown}, citations: []}\n", encoding="utf-8")
    with pytest.raises(SystemExit):
        cli.main(["golden-eval", folder, "r1", str(golden)])
    rows = {r["kind"]: r for r in map(json.loads, capsys.readouterr().out.splitlines())}
    assert (rows["person"]["tp"], rows["event"]["tp"], rows["event"]["fn"]) == (1, 2, 0)  # both at no place: 654 matches 650
    assert (rows["place"]["fp"], rows["place"]["recall"], rows["state"]["fp"], rows["relation"]["fp"]) == (1, 1.0, 1, 2)
    (golden / "places.yaml").write_text("- {id: gp, name: 狄, citations: []}\n", encoding="utf-8")
    (golden / "events.yaml").write_text("- {id: g2, type: 奔, date: {year_bce: 200, inference_kind: unknown}, primary_place_id: gp, citations: []}\n- {id: g3, type: 战, date: {year_bce: 649, inference_kind: unknown}, primary_place_id: gp, citations: []}\n", encoding="utf-8")
    (golden / "relations.yaml").write_text("- {kind: event_participant, event_id: g2, person_id: g1, role: 主}\n", encoding="utf-8")
    with pytest.raises(SystemExit):
        cli.main(["golden-eval", folder, "r1", str(golden)])
    rows = {r["kind"]: r for r in map(json.loads, capsys.readouterr().out.splitlines())}
    assert (rows["event"]["tp"], rows["place"]["tp"], rows["relation"]["tp"] + rows["relation"]["fn"]) == (1, 1, 1)  # one place by name


def test_golden_pair_and_verdict_files(spark, tmp_path):
    (tmp_path / "pairs.yaml").write_text("same_person_pairs:\n- {rationale: x, person_a: {canonical_name: a, variants: [b]}, person_b: {canonical_name: b}}\ndifferent_person_pairs: []\n")
    assert [(r["same"], r["person_a"]["variants"], r["person_b"]["canonical_name"]) for r in storage.read_merge_pairs(spark, str(tmp_path / "pairs.yaml")).collect()] == [(True, ["b"], "b")]
    for text in ("same_person_pairs: []", "- 1", "same_person_pairs: [1]\ndifferent_person_pairs: []"):
        (tmp_path / "bad.yaml").write_text(text)
        with pytest.raises(ValueError):
            storage.read_merge_pairs(spark, str(tmp_path / "bad.yaml"))
    (tmp_path / "v.yaml").write_text("- {record_kind: person, record_id: p, field: f, verdict: 'yes'}\n")
    assert [r["verdict"] for r in storage.read_verdicts(spark, str(tmp_path / "v.yaml")).collect()] == ["yes"]
    with pytest.raises(ValueError, match="no such folder"):
        storage.read_golden(spark, str(tmp_path / "none"))
    (tmp_path / "in").mkdir()
    for n in ("ch02.md", "ch01.md", "notes.md"):
        (tmp_path / "in" / n).write_text(n)
    assert [r[0] for r in storage.copy_texts(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()] == ["ch01.md", "ch02.md"]
    assert (tmp_path / "out" / "ch02.md").read_text() == "ch02.md" and not (tmp_path / "out" / "notes.md").exists()


def test_new_events_are_numbered_by_distinct_places_alone(spark):
    """No candidate passes through a window, however many a type and year has; nulls are a place, a type and a year of their own."""
    from inkstone.operators.validation import match_events

    rows = [(f"c{k}", "battle", -600, (None, "pla:a", "pla:b")[k % 3]) for k in range(30)] + [("n1", "battle", None, None), ("n2", None, -600, None), ("k1", "siege", -600, "pla:a")]
    schema = "id string, type string, year_bce int, place_id string"
    got = match_events(spark.createDataFrame(rows, schema), spark.createDataFrame([("evt:siege--600", "siege", -600, "pla:a"), ("evt:battle--600", "battle", -600, "pla:z")], schema))
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    expected = {f"c{k}": (f"evt:battle--600-{k % 3 + 2}", True) for k in range(30)} | {"n1": ("evt:battle-x", True), "n2": (None, True), "k1": ("evt:siege--600", False)}
    assert {r["id"]: (r["event_id"], r["created"]) for r in got.collect()} == expected
