"""Sweeps over tenures against loops over years and pairs."""

import random

import pytest

from inkstone.operators.successions import holder_spans, predecessors


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small ranges stay apart here, as large ones do elsewhere."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def swept(rows):
    out = set()
    for state in {r[1] for r in rows}:
        own = [(a, b) for _, s, a, b in rows if s == state and a is not None and b is not None and a < b]
        years = range(min((a for a, _ in own), default=0), max((b for _, b in own), default=0))
        level = [(y, sum(a <= y < b for a, b in own)) for y in years]
        start = 0
        for i in range(1, len(level) + 1):
            if i == len(level) or level[i][1] != level[start][1]:
                n = level[start][1]
                out.add((state, level[start][0], level[i - 1][0] + 1, n, "vacant" if not n else "held" if n == 1 else "shared"))
                start = i
    return out


def before(rows):
    out = []
    valid = [r for r in rows if r[2] is not None and r[3] is not None and r[2] < r[3]]
    for r in rows:
        ended = [(b, a, i) for i, s, a, b in valid if r in valid and s == r[1] and b <= r[2]]
        last = max(ended, default=None)
        out.append((*r, last[2] if last else None, r[2] - last[0] if last else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("states", [1, 4, 60])
def test_spans_and_predecessors(spark, states):
    """One state with all rows, few and many; null states and years; reigns of no years; one reign over most years; repeated rows."""
    rng = random.Random(states)
    rows = []
    for i in range(250):
        start = rng.randrange(-700, -200)
        rows.append((i, rng.choice([None, *map(str, range(states))]) if states > 1 else "0", rng.choice([start] * 9 + [None]), start + rng.choice([-3, 0, 1, 2, 5, 8]) if rng.random() < 0.95 else None))
    rows += [(900, "0", -690, -250), rows[0], rows[0]]
    frame = spark.createDataFrame(rows, "id int, state string, start int, end int").repartition(3)
    got = [tuple(r) for r in holder_spans(frame, ["state"]).collect()]
    assert set(got) == swept(rows) and len(got) == len(set(got))
    assert sorted((tuple(r) for r in predecessors(frame, ["state"]).collect()), key=str) == before(rows)


def test_no_tenures(spark):
    frame = spark.createDataFrame([], "id int, state string, start int, end int")
    assert holder_spans(frame, ["state"]).count() == predecessors(frame, ["state"]).count() == 0
