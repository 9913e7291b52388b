"""Known inputs and results of single operators."""

import random

import pytest
from pyspark.sql import functions as F

from inkstone.functions import reign_dates as d
from inkstone.functions import text
from inkstone.operators import quotes as quotes_of
from inkstone.operators import corpus, evaluation, linking, merging, timeline
from inkstone.sources import storage


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(k) for k, c in columns.items())).first()


@pytest.mark.parametrize(("written", "year", "kind"), [
    ("鲁僖公二十八年", 632, "explicit_reign_lu"), ("鲁僖二十八年", 632, "explicit_reign_lu"), ("僖公二十八年", 632, "explicit_reign_lu"), ("僖公三十三年", 627, "explicit_reign_lu"),
    ("文公元年", 626, "explicit_reign_lu"), ("庄公三十二年", 662, "explicit_reign_lu"), ("周襄王二十年", 632, "explicit_reign_zhou"), ("春秋末", 493, "era_only"), ("隐公一二年", None, "unknown"), ("不明", None, "unknown"), ("", None, "unknown"),
])
def test_dates(spark, written, year, kind):
    got = one(spark, x=d.parse_date(F.lit(written)))["x"]
    assert (got["year_bce"], got["inference_kind"]) == (year, kind)


def test_relative_dates_need_an_anchor(spark):
    got = one(spark, a=d.parse_date(F.lit("明年"), F.lit(771), F.lit("春秋")), b=d.parse_date(F.lit("明年"), F.lit(None).cast("int")), c=d.parse_date(F.lit("是冬"), F.lit(600)))
    assert (got["a"]["year_bce"], got["a"]["era"], got["b"]["inference_kind"], got["c"]["year_bce"]) == (770, "春秋", "unknown", 600)


def test_other_reigns(spark):
    rulers = spark.createDataFrame([("sta:jin", "晋文公", "文公", "重耳", 636, 628), ("sta:qi", "齐桓公", "桓公", "小白", 685, 643), ("sta:qi", "齐又公", "又公", "小白", 642, 630)], "state_id string, ruler_id string, posthumous_name string, given_name string, reign_start_bce int, reign_end_bce int")
    rows = spark.createDataFrame([("晋文公七年",), ("晋重耳七年",), ("晋文公二十年",), ("齐小白三年",), ("鲁文公三年",), (None,)], "original string")
    got = {r["original"]: (r["reign_year"], r["reign_out_of_range"]) for r in d.other_reigns(rows, rulers).collect()}
    assert got == {"晋文公七年": (630, False), "晋重耳七年": (630, False), "晋文公二十年": (617, True), "齐小白三年": (None, None), "鲁文公三年": (None, None), None: (None, None)}


def test_walk_relative(spark):
    rows = [(1, "a", False, 771), (2, "明年", True, None), (3, "明年", True, None), (4, "(note)", True, None), (5, "()", True, None), (6, "x", False, None), (7, "去年", True, None)]
    df = spark.createDataFrame(rows, "pos int, original string, is_relative boolean, year_bce int").withColumn("k", F.lit(1)).withColumn("offset", d.walk_offset(F.col("original")))
    assert [r["resolved_year"] for r in timeline.walk_relative(df, ["k"], ["pos"]).orderBy("pos").collect()] == [771, 770, 769, 769, None, None, 770]


def test_anchor_chains_with_cycles_and_dangling_links(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 99), (5, 6), (6, 5), (7, 7), *((i, i - 1) for i in range(11, 40)), (10, 3)], "id int, anchor int")
    assert {r["id"]: (r["terminal"], r["depth"]) for r in timeline.anchor_terminals(df, "id", "anchor").collect()} == {1: (1, 0), 2: (1, 1), 3: (1, 2), 4: (None, None), 5: (None, None), 6: (None, None), 7: (None, None)} | {i: (1, i - 7) for i in range(10, 40)}


def test_chunks(spark):
    assert corpus.spans([5000], 100, 20) == [(0, 0)]
    assert corpus.spans([100, 100, 100], 500, 20) == [(0, 2)]
    assert corpus.spans([], 500, 20) == []
    docs = spark.createDataFrame([(1, "a" * 5000, "x"), (2, None, "y"), (3, "  \n　\n", "z"), (4, "p\n\nq\r\nr", "w")], "doc_id long, text string, hash string")
    got = {r["doc_id"]: (r["paragraph_start"], r["paragraph_end"], r["text"]) for r in corpus.chunks(docs, 100, 20).collect()}
    assert got == {1: (0, 0, "a" * 5000), 4: (0, 2, "p\n\nq\n\nr")}


def test_terms(spark):
    docs = spark.createDataFrame([(1, "晋晋晋齐"), (2, ""), (3, None)], "doc_id long, text string")
    got = {r["term_id"]: r["n"] for r in corpus.discover_terms(docs, d.STATES, "doc_id").collect()}
    assert got == {"sta:jin": 3, "sta:qi": 1}


def test_quotes(spark):
    docs = spark.createDataFrame([(1, "aaaa"), (2, "ét"), (3, None)], "doc_id long, text string")
    quotes = spark.createDataFrame([("q", "aa"), ("r", ""), ("s", None)], "id string, quote string")
    assert [(r["start"], r["end"]) for r in quotes_of.quote_spans(docs, quotes).orderBy("start").collect()] == [(0, 2), (1, 3), (2, 4)]
    assert quotes_of.quote_spans(docs, quotes, every=False).count() == 1
    assert corpus.normalised(docs, "text").filter(F.col("text") == "ét").count() == 1
    got = one(spark, a=corpus.aligned(F.lit("abc"), F.lit(1), F.lit(3), F.lit("bc")), b=corpus.aligned(F.lit("abc"), F.lit(1), F.lit(9), F.lit("bc")), s=text.snippet(F.lit("x\nabc"), F.lit(2), F.lit(2)))
    assert (got["a"], got["b"], got["s"]) == (True, False, "x ⏎ 【ab】c")


def test_fingerprints_and_slugs(spark):
    v = lambda *x: F.array(*(F.lit(y) for y in x))
    got = one(spark, a=text.fingerprint(F.lit("重耳"), v("文公", "晋文公")), b=text.fingerprint(F.lit("重耳"), v("晋文公", "文公", "文公")), c=text.fingerprint(F.lit("重耳"), v("文公")), s=text.slug(F.lit(" Duke-Wen 晋! ")))
    assert got["a"] == got["b"] != got["c"] and len(got["a"]) == 16 and got["s"] == "duke-wen-晋"


def test_scores(spark):
    v = lambda *x: F.array(*(F.lit(y) for y in x)).cast("array<string>")
    kinds = one(spark, none=linking.variant_overlap(F.lit("重耳"), v("晋文公"), F.lit("管仲"), v("夷吾")), strong=linking.variant_overlap(F.lit("重耳"), v("晋文公"), F.lit("晋文公"), v("文公")), partial=linking.variant_overlap(F.lit("重耳"), v("公子"), F.lit("夷吾"), v("公子")))
    assert kinds.asDict() == {"none": "none", "strong": "strong", "partial": "partial"}
    s = lambda *x: linking.score(*(F.lit(y) for y in x))
    got = one(spark, veto=s("none", "same", "same", "same", "compatible"), strong=s("strong", "one_null", "one_null", "one_null", "unknown"), partial=s("partial", "one_null", "one_null", "one_null", "unknown"), full=s("strong", "same", "same", "same", "compatible"), waived=s("strong", "same", "one_null", "different", "unknown"), low=s("partial", "different", "different", "different", "conflict"))
    assert list(got) == [0, 50, 20, 100, 70, 0]


def test_sibling_chain_is_skipped(spark):
    best = spark.createDataFrame([("p1", "p2", 1, 90), ("p2", "p3", 1, 90), ("p3", "p4", 1, 90)], "cand string, target string, kind_rank int, score100 int")
    assert sorted(r["id"] for r in linking.skipped_siblings(best).collect()) == ["p2", "p4"]


def test_long_and_branching_merges_are_skipped_in_order(spark):
    rng = random.Random(2)
    target = {i: i + 1 for i in range(70)} | {i: rng.randrange(i - 30, 400) for i in range(100, 399)}
    skipped = set()
    for i in sorted(target):
        if i not in skipped:
            skipped.add(target[i]) if target[i] > i else None
    best = spark.createDataFrame([(f"p{i:03}", f"p{t:03}", 1, 90) for i, t in target.items() if i != t], "cand string, target string, kind_rank int, score100 int")
    got = [r["id"] for r in linking.skipped_siblings(best).collect()]
    assert len(got) == len(set(got)) and set(got) == {f"p{i:03}" for i in skipped}


def test_date_merge(spark):
    def entry(u, c):
        return F.struct(F.struct(F.lit(u).alias("uncertainty"), F.lit(f"{u}{c}").alias("original")).alias("value"), F.lit(c).alias("confidence"))

    got = one(spark, a=merging.merge_date(entry("range", 0.9), entry("point", 0.85)), b=merging.merge_date(entry("point", 0.7), entry("point", 0.85)), c=merging.merge_date(entry("circa", 0.8), entry("circa", 0.8)))
    assert [x["value"]["original"] for x in got] == ["point0.85", "point0.85", "circa0.8"]


def test_sample_size(spark):
    got = [one(spark, n=evaluation.sample_size(F.lit(n)))["n"] for n in (10, 100, 1000, 10000)]
    assert got == [10, 30, 51, 250]


def test_importance_rewards_rare_deeds(spark):
    p = spark.createDataFrame([(f"e{i}", "a", "战" if i == 0 else "伐") for i in range(8)] + [(f"f{i}", "b", "战" if i < 4 else "伐") for i in range(8)], "event_id string, person_id string, event_type string")
    got = {(r["event_id"]): r["importance"] for r in evaluation.deed_importance(p, p.select("event_id")).collect()}
    assert got["e0"] > got["f0"]


def test_split(spark):
    persons = spark.createDataFrame([("a", "重耳", None, 0.9), ("b", "晋文公", "sta:jin", 0.8)], "id string, canonical_name string, state_id string, confidence double")
    variants = spark.createDataFrame([("a", "公子重耳", "alias"), ("b", "文公", "posthumous")], "person_id string, variant string, kind string")
    people, moved = merging.split_person(persons, variants, "b", "c", "新", ["文公"])
    assert people.count() == 3 and moved.filter("person_id = 'c'").count() == 1
    with pytest.raises(ValueError, match="no such variants"):
        merging.split_person(persons, variants, "b", "c", "新", ["无"])


def test_greedy_matches(spark):
    pairs = spark.createDataFrame([("k", 1, 10), ("k", 1, 11), ("k", 2, 10), ("k", 3, 11)], "kind string, g int, c int")
    assert sorted((r["g"], r["c"]) for r in evaluation.greedy_matches(pairs, "kind", "g", "c").collect()) == [(1, 10), (3, 11)]


def test_missing_citations_raise(spark):
    with pytest.raises(ValueError, match="2 chunks are missing"):
        evaluation.require_all(spark.createDataFrame([("x",), ("y",)], "id string"), spark.createDataFrame([], "id string"), "id", "chunks")


def test_books_frontmatter_and_export(spark, tmp_path):
    (tmp_path / "b.json").write_text('{"title": "T", "chapters": [{"title": "one", "content": "c1"}, {"content": "c2"}]}')
    docs = storage.read_books(spark, str(tmp_path / "b.json"), "novel")
    assert [tuple(r) for r in docs.select("id", "chapter_num", "chapter_title").orderBy("chapter_num").collect()] == [("novel:1", 1, "one"), ("novel:2", 2, "Chapter 2")]
    (tmp_path / "a.md").write_text('---\ntitle: "A"\ntags: [x, y]\naffects:\n  - src/a.py\n  - src/b.py\n---\nbody')
    got = {r["key"]: r["values"] for r in storage.read_frontmatter(spark, str(tmp_path / "a.md")).collect()}
    assert got == {"title": ["A"], "tags": ["x", "y"], "affects": ["src/a.py", "src/b.py"]}
    manifest = storage.export({"documents": docs, "candidate_persons": docs}, str(tmp_path / "out"), "v1", {"id": "novel"}, "2026-01-01T00:00:00Z")
    assert manifest["counts"] == {"documents": 2}
