"""Closure against a search from every person."""

import random

from inkstone.operators.graphs import closure


def searched(edges):
    """(a, b): (generation, kinds of all least paths)."""
    steps = {}
    for a, b, kind in edges:
        if a is not None and b is not None:
            steps.setdefault(a, {}).setdefault(b, set()).update({kind} - {None})
    out = {}
    for start in steps:
        level, seen, n = {start: set()}, set(), 0
        while level:
            n += 1
            further = {}
            for v, kinds in level.items():
                for w, own in steps.get(v, {}).items():
                    if w not in seen:
                        further.setdefault(w, set()).update(kinds | own)
            for w, kinds in further.items():
                out[start, w] = (n, sorted(kinds))
            seen |= set(further)
            level = further
    return out


def closed(spark, edges):
    return {(r["a"], r["b"]): (r["generation"], r["kinds"]) for r in closure(spark.createDataFrame(edges, "a int, b int, kind string").repartition(3)).collect()}


def test_closure_of_random_graphs(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(25), rng.randrange(25), rng.choice(["blood", "adoption", None])) for _ in range(45)] + [(None, 1, "blood"), (1, None, "blood"), (30, 30, "oath"), (31, 32, "blood"), (31, 32, "blood")]
    assert closed(spark, edges) == searched(edges)
    assert closed(spark, []) == {}


def test_closure_of_a_long_chain_with_a_cycle(spark):
    edges = [(k, k + 1, "blood" if k % 7 else "adoption") for k in range(20)] + [(20, 15, "oath")]
    assert closed(spark, edges) == searched(edges)


def test_closure_broadcasts_nothing(spark, monkeypatch):
    from inkstone.operators import graphs

    plans, settled = [], graphs.settled
    monkeypatch.setattr(graphs, "settled", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or settled(df))
    edges = spark.createDataFrame([(k, k // 2, "x") for k in range(1, 40)], "a int, b int, kind string")
    assert closure(edges).count() > 39
    assert any("Join" in p for p in plans) and not any("Broadcast" in p for p in plans)
