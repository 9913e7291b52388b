import re
from collections import defaultdict

import pytest

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
SF = "/root/testdata/sf0.001"

#: Texts of every awkward kind, by doc_id.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog"),
    (2, "the quick brown fox jumps over the lazy dog"),
    (3, ""),
    (4, None),
    (5, "  \n\t "),
    (6, "one"),
    (7, "A\x0bB\x0cC\x1cD E"),
    (8, "naïve café — Ünïcode ﬁ İSTANBUL Σίσυφος 中文 字符 😀"),
    (9, "word " * 3000),
    (10, "x" * 20_000),
    (None, "a row without an id"),
    (1, "The quick brown fox jumps over the lazy dog"),
    (11, "<|endoftext|> special <|startoftext|>"),
    (12, "a b c d"),
    (13, "a b c d"),
    (14, "don't stop it's we're I'm 123 4½ ²x"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """ODD as a table with further columns, some of whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "s", 7, "k") for i, t in ODD], "doc_id long, text string, source string, score int, class string").repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words_of(text):
    return WORDS.findall((text or "").translate(LOWER))


def linked(rows, percent=75, width=5):
    """doc_id: (set size, component) by brute force; rows without an id are left out."""
    sets = {}
    for i, t in rows:
        w = words_of(t)
        if i is not None:
            sets[i] = frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()
    having, up = defaultdict(list), {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in sorted(sets):
        counts = defaultdict(int)
        for s in sets[i]:
            for j in having[s]:
                counts[j] += 1
            having[s].append(i)
        for j, n in counts.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}
