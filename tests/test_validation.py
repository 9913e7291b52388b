import random

from pyspark.sql import functions as F

from inkstone.operators import articles, validation

DATE = "struct<year_bce:int,inference_kind:string>"


def test_records_fail_by_their_first_rule(spark):
    chunks = spark.createDataFrame([("c1", "重耳奔狄 née")], "id string, text string")
    declared = spark.createDataFrame([("r", "s1")], "run string, local_id string")
    rows = [
        ("ok", "r", "c1", "重耳", {"name": "重"}, None, "s1"), ("ok2", "r", "c1", "née", None, (632, "era_only"), "sta:jin"), ("chunk", "r", "c9", "重耳", {}, None, None), ("empty", "r", "c1", "", {}, None, None), ("quote", "r", "c1", "无", {}, None, None),
        ("why", "r", "c1", "重耳", {"name": ""}, None, None), ("why2", "r", "c1", "重耳", {"name": "狄"}, None, None), ("date", "r", "c1", "重耳", {}, (1, "explicit_reign_other"), None), ("ref", "r", "c1", "重耳", {}, None, "s2"),
    ]
    records = spark.createDataFrame(rows, f"id string, run string, chunk_id string, quote string, justifications map<string,string>, date {DATE}, state_id string")
    got = {r["id"]: r["violation"] for r in validation.check_records(records, chunks, declared).collect()}
    assert got["ok"] is got["ok2"] is None
    assert [got[k] for k in ("chunk", "empty", "quote", "why", "why2", "date", "ref")] == [
        "unknown chunk_id", "citation.quote is empty", "quote is not in its chunk", "a justification is empty or not in the quote", "a justification is empty or not in the quote", "date.inference_kind is not allowed", "state_id is not declared",
    ]


def test_schema_violations(spark):
    rows = spark.createDataFrame([(1, None, "x", "s1", -1.0), (2, "n", "战", "sta:jin", 1.0)], "id int, name string, kind string, state string, paragraph double")
    got = {(r["id"], r["field"], r["rule"]) for r in validation.schema_violations(rows, "id", ("name",), {"kind": ("战",)}, {"state": r"^sta:"}, {"paragraph": 0}).collect()}
    assert got == {(1, "name", "required"), (1, "kind", "enum"), (1, "state", "pattern"), (1, "paragraph", "minimum")}


def test_persons_and_events_match(spark):
    persons = spark.createDataFrame([("per:a", "重耳"), ("per:b", "管仲")], "id string, canonical_name string")
    variants = spark.createDataFrame([("per:b", "夷吾")], "person_id string, variant string")
    candidates = spark.createDataFrame([("c1", "重耳", None), ("c2", "夷吾", None), ("c3", "新人", None), ("c4", "别名", "c3"), ("c5", "另", "per:a"), ("c6", "新人", None)], "id string, canonical_name string, match_target_id string")
    got = {r["id"]: (r["person_id"], r["created"]) for r in validation.match_persons(candidates, persons, variants).collect()}
    assert got["c1"] == ("per:a", False) and got["c2"] == ("per:b", False) and got["c5"] == ("per:a", False)
    assert got["c3"] == got["c4"] == got["c6"] and got["c3"][1] and got["c3"][0].startswith("per:新人-")
    events = spark.createDataFrame([("evt:战-632", "战", 632, "pla:x")], "id string, type string, year_bce int, place_id string")
    new = spark.createDataFrame([("e1", "战", 632, "pla:x"), ("e2", "战", 632, None), ("e3", "盟", None, None), ("e4", "战", 632, None)], "id string, type string, year_bce int, place_id string")
    assert {r["id"]: r["event_id"] for r in validation.match_events(new, events).collect()} == {"e1": "evt:战-632", "e2": "evt:战-632-2", "e3": "evt:盟-x", "e4": "evt:战-632-2"}


def test_local_ids_resolve(spark):
    edges = spark.createDataFrame([("r", "p1"), ("r", "cand:per:r:x:p1"), ("r", "per:a"), ("r", "p9"), ("q", "p1")], "run string, person_id string")
    ids = spark.createDataFrame([("r", "p1", "per:z")], "run string, local_id string, id string")
    assert sorted((r["run"], str(r["person_id"])) for r in validation.resolve_ids(edges, "person_id", ids).collect()) == [("q", "None"), ("r", "None"), ("r", "per:a"), ("r", "per:z"), ("r", "per:z")]


def test_drift(spark):
    text = "| When you change | Update this article |\n|---|---|\n| `src/**/*.py` | `a.md` |\n| linking stage | `knowledge/b.md` |\n| x | none |\n\nend"
    mapping = articles.mapping_rows(spark.createDataFrame([(text,)], "value string"))
    changed = spark.createDataFrame([("src/x/y.py",), ("src/z.py",), ("lib/linking_run.go",), ("knowledge/b.md",)], "path string")
    got = articles.drift(mapping, changed).collect()
    assert sorted(tuple(r) for r in got) == [("`src/**/*.py`", "knowledge/a.md", "src/x/y.py"), ("`src/**/*.py`", "knowledge/a.md", "src/z.py")]


def test_matched_paths_of_random_globs(spark):
    """Against comparing every path with every pattern: globs without folders or endings, words, other scripts, nulls, repeated rows."""
    rng = random.Random(3)
    piece = lambda: rng.choice(["a", "ab", "src", "b.py", "*", "?", "**", "a*", "*.py", "?b", "a**b", "x+y", "文"])
    patterns = ["/".join(piece() for _ in range(rng.randrange(1, 5))) for _ in range(120)] + [f"`{piece()}/**`" for _ in range(5)]
    patterns += ["the linker stage", "with code", "Loader 重耳出奔", "**", "*", "", None, "ab/b.py", "ab/b.py", "/src/**", "a.b.md"]
    name = lambda: rng.choice(["a", "ab", "src", "b.py", "aab", "x+y", "文", "cb", "Linker.go", "重耳出奔.md", "xy"])
    paths = ["/".join(name() for _ in range(rng.randrange(1, 5))) for _ in range(200)] + ["", "/", "/src/a", "src/", "a.b.md", "axb.md", None, "a", "a"]
    asked, files = spark.createDataFrame([(p,) for p in patterns], "code_pattern string"), spark.createDataFrame([(p,) for p in paths], "path string")
    expected = {tuple(r) for r in asked.crossJoin(files).filter(articles.path_matches(F.col("code_pattern"), F.col("path"))).collect()}
    got = [tuple(r) for r in articles.matched_paths(asked, files).collect()]
    assert set(got) == expected and len(got) == len(expected) > 500


def test_frontmatter_errors(spark):
    rows = [("a.md", "title", ["A"]), ("a.md", "type", ["concept"]), ("a.md", "area", ["x"]), ("a.md", "updated", ["2026-1-1"]), ("a.md", "status", ["ripe"]), ("a.md", "references", ["b.md", "c.txt", "a.md"]), ("a.md", "load_bearing", ["maybe"]), ("b.md", "title", [])]
    got = {(r["path"], r["error"]) for r in articles.frontmatter_errors(spark.createDataFrame(rows, "path string, key string, values array<string>"), spark.createDataFrame([("a.md",)], "path string")).collect()}
    assert {e for p, e in got if p == "a.md"} == {"updated is no date", "status is ripe", "no such article: b.md", "reference is no article: c.txt", "load_bearing is no boolean"}
    assert len([e for p, e in got if p == "b.md"]) == 5
