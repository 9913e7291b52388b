"""Rows that are alike are handled once, and pairs are made once without being moved."""

import random

from inkstone.operators import evaluation, golden, search
from tests.test_pairs_once import above_joins, rows

EVENTS = "id int, chapter int, type string, place string, year_bce int"


def test_event_pairs_once_each_and_by_classes(spark):
    rng = random.Random(5)
    some = lambda values: None if rng.random() < 0.4 else rng.choice(values)
    known, found = ([(k, k % 2, "a", some("xy"), some([600, 601, 603])) for k in range(60)] for _ in range(2))
    near = lambda a, b: (a == b) if None in (a, b) else abs(a - b) <= 1
    want = sorted((g[1], g[0], c[0]) for g in known for c in found if g[1] == c[1] and (g[3] == c[3] or near(g[4], c[4])))
    want.sort(key=repr)
    g, c = spark.createDataFrame(known, EVENTS), spark.createDataFrame(found, EVENTS)
    got = golden.event_pairs(g, c, ("chapter",))
    assert rows(got) == want and "Aggregate" not in above_joins(got)
    kinds = {x.id: x for x in golden.event_classes(g, ("chapter",)).collect()}
    assert len(kinds) < len(known)


def test_person_pairs_of_several_shared_names(spark):
    schema = "id string, canonical_name string, variants array<string>, state_id string, social_category string"
    g = spark.createDataFrame([("g1", "a", ["b", "b", ""], None, None), ("g2", "b", ["a"], "x", None), ("g3", None, None, None, None)], schema)
    c = spark.createDataFrame([("c1", "b", ["a"], "x", None), ("c2", "a", None, "y", None)], schema)
    want = [("g1", "c1"), ("g1", "c2"), ("g2", "c1")]
    for hot in (1, 100):
        got = golden.person_pairs(g, c, hot=hot)
        assert rows(got) == want and "Aggregate" not in above_joins(got)


def test_equal_questions_of_a_prefix_search_are_answered_once(spark):
    keys = spark.createDataFrame([(k, f"Name{k % 5}{k}") for k in range(40)], "id long, key string")
    asked = spark.createDataFrame([(k, "nAme" if k % 2 else "name1") for k in range(50)] + [(3, "name4"), (3, "NAME0")], "query_id long, prefix string")
    written = []
    before, search.settled = search.settled, lambda df: written.append(before(df)) or written[-1]
    try:
        got = search.prefix_search(keys, asked, 3)
    finally:
        search.settled = before
    names = sorted((f"name{k % 5}{k}", k) for k in range(40))
    first = lambda p: [(n, (key, i)) for n, (key, i) in enumerate([x for x in names if x[0].startswith(p)][:3], 1)]
    want = sorted((q, n, i, key) for q in range(50) for n, (key, i) in first("name" if q % 2 else "name1"))
    assert rows(got) == sorted(want, key=repr)
    assert max(df.count() for df in written) <= 52  # no rows of 50 queries times their keys


def test_greedy_matches_are_those_of_a_plain_loop(spark):
    rng = random.Random(3)
    pairs = list({(f"k{rng.randrange(3)}", rng.randrange(25), rng.randrange(25)) for _ in range(150)}) + [(None, k, k) for k in range(30)] + [("k9", g, c) for g in range(20) for c in range(20)]
    taken, used, want = set(), set(), []
    for k, g, c in sorted(pairs, key=lambda r: (repr(r[0]), r[1], r[2])):
        if (k, g) not in taken and (k, c) not in used:
            taken.add((k, g))
            used.add((k, c))
            want.append((k, g, c))
    seen = []
    before, evaluation._matched_in_order = evaluation._matched_in_order, lambda rest, *a: seen.append(rest.count()) or before(rest, *a)
    try:
        assert rows(evaluation.greedy_matches(spark.createDataFrame(pairs, "kind string, g int, c int"), "kind", "g", "c")) == sorted(want, key=repr)
        sure = spark.createDataFrame([("k", g, g) for g in range(200)], "kind string, g int, c int")
        assert evaluation.greedy_matches(sure, "kind", "g", "c").count() == 200
    finally:
        evaluation._matched_in_order = before
    assert seen[0] > 0 == seen[1]  # pairs that leave no choice don't meet in one task
