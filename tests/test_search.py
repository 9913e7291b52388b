"""Searches by grams and by prefixes against comparing every query with every name."""

import random

from inkstone.operators import search


def gram_set(s):
    p = f"  {s.lower()} "
    return {p[i : i + 3] for i in range(len(p) - 2)}


def nearest(names, queries, k, least):
    out = set()
    for q, query in set(queries):
        scored = []
        for i, name in set(names):
            if name and query and i is not None:
                a, b = gram_set(name), gram_set(query)
                score = len(a & b) / len(a | b)
                if score >= least:
                    scored.append((-score, i))
        out |= {(q, place, i, -s) for place, (s, i) in enumerate(sorted(scored)[:k], 1)}
    return out


def searched(spark, names, queries, k, least, **how):
    names = spark.createDataFrame(names, "id int, name string").selectExpr("*", "1 AS grams", "2 AS query", "3 AS score").repartition(3)
    got = search.trigram_search(names, spark.createDataFrame(queries, "query_id int, query string"), k, least, **how).collect()
    assert len(got) == len({tuple(r) for r in got})
    return {tuple(r) for r in got}


def test_trigram_search_with_ties_and_a_hot_gram(spark):
    """Every name begins with the same characters; short names, names of one text, other cases, nulls, empty and repeated rows."""
    rng = random.Random(5)
    names = [(i, "duke " + "".join(rng.choices("abcxyz重耳文", k=rng.randrange(0, 7)))) for i in range(300)]
    names += [(300 + i, "Duke Wen") for i in range(6)] + [(400, None), (401, ""), (None, "duke wen"), (402, "文"), (402, "文"), (403, "文公")]
    queries = [(i, names[rng.randrange(300)][1][rng.randrange(3) :] + rng.choice(["", "a", "文"])) for i in range(40)] + [(90, "duke wen"), (91, None), (92, ""), (93, "文"), (94, "qqq"), (90, "duke wen"), (95, "DUKE WEN")]
    for k, least in ((4, 0.3), (1000, 0.5), (3, 0.05), (2, 1.0)):
        assert searched(spark, names, queries, k, least, hot=20) == nearest(names, queries, k, least)
    assert searched(spark, [], queries, 3, 0.3) == searched(spark, names, [], 3, 0.3) == set()


def first_by_prefix(keys, queries, k):
    out = set()
    for q in {r[0] for r in queries}:
        best = {}
        for _, prefix, state, clan in [r for r in queries if r[0] == q and r[1]]:
            for i, key, s, c in keys:
                if i is not None and key and key.lower().startswith(prefix.lower()) and state in (None, s) and clan in (None, c):
                    best[i] = min(best.get(i, key.lower()), key.lower(), key=lambda x: x.encode())
        out |= {(q, place, i, key) for place, (i, key) in enumerate(sorted(best.items(), key=lambda x: (x[1].encode(), x[0]))[:k], 1)}
    return out


def test_prefix_search_where_most_names_share_one(spark):
    """Blocks stay apart here, as large ones do elsewhere; a prefix of nearly all keys, filters, cases, nulls, keys of one text."""
    rng = random.Random(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keys = [(rng.randrange(200), rng.choice(["Zhong", "zhong", "z", "重"]) + "".join(rng.choices("ab文\U0010ffff", k=rng.randrange(4))), rng.choice(["晉", "楚", None]), rng.choice(["姬", "羋"])) for _ in range(600)]
        keys += [(7, None, "晉", "姬"), (8, "", "晉", "姬"), (None, "zhong", "晉", "姬"), *keys[:20]]
        queries = [(i, rng.choice(["z", "zh", "ZHONG", "zhonga", "zhong\U0010ffff", "重", "重文", "q", "", None]), rng.choice([None, "晉", "楚"]), rng.choice([None, "姬"])) for i in range(40)] + [(3, "重", None, None)]
        frame = spark.createDataFrame(keys, "id int, key string, state string, clan string").selectExpr("*", "1 AS prefix", "2 AS query_id").repartition(3)
        asked = spark.createDataFrame(queries, "query_id int, prefix string, state string, clan string")
        for k in (3, 10_000):
            got = search.prefix_search(frame, asked, k, ("state", "clan")).collect()
            assert {tuple(r) for r in got} == first_by_prefix(keys, queries, k) and len(got) == len({tuple(r) for r in got})
        assert search.prefix_search(frame.limit(0), asked, 3, ("state",)).count() == search.prefix_search(frame, asked.limit(0), 3).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_search_keys(spark):
    names = spark.createDataFrame([(1, "重耳", "chong er", "晉"), (2, "文", None, None)], "id int, name string, pinyin string, state string")
    variants = spark.createDataFrame([(1, "晉文公"), (9, "x")], "id int, variant string")
    got = {tuple(r) for r in search.search_keys(names, variants, ("name", "pinyin"), ("state",)).collect()}
    assert got == {(1, "重耳", "晉"), (1, "chong er", "晉"), (2, "文", None), (2, None, None), (1, "晉文公", "晉")}
