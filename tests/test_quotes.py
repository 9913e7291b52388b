"""Quote search against str.find."""

import random
import unicodedata

import pytest

from inkstone.operators import corpus
from inkstone.operators.quotes import PIECE, kept_runs, pieces, quote_spans


def occurrences(texts, quotes, every):
    out = []
    for i, t in texts:
        for j, q in quotes:
            at = t.find(q) if t and q else -1
            while at >= 0:
                out.append((i, j, at, at + len(q)))
                at = t.find(q, at + 1) if every else -1
    return sorted(out, key=repr)


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.mark.parametrize("every", [True, False])
def test_quotes_are_found_wherever_they_are(spark, every):
    """Quotes of every length, overlapping, repeated, beyond the basic plane; a run in most places; nulls and empty texts."""
    rng = random.Random(5)
    made = lambda n: "".join(rng.choice("abab 中😀\n") for _ in range(n))
    texts = [(k, made(rng.randrange(0, 400))) for k in range(40)] + [(50, None), (51, ""), (52, "a" * 300), (53, "a" * 300), (53, "a" * 300), (None, "common " * 40), *((60 + k, "common " * 30 + str(k)) for k in range(20))]
    bodies = [t for _, t in texts if t]
    quotes = [(k, None if k == 0 else "") for k in (0, 1)]
    for k in range(2, 90):
        t = rng.choice(bodies)
        a = rng.randrange(len(t))
        quotes.append((k, t[a : a + rng.choice([1, 2, 3, 5, 8, 15, 31, 64, 65, 130, 300])]))
    quotes += [(100, "a" * 64), (100, "a" * 64), (101, "aaa"), (102, "common common "), (103, "nowhere to be found in any of these texts, although it is long enough"), (104, bodies[0] + "x")]
    got = quote_spans(table(spark, texts, "i int, text string"), table(spark, quotes, "j int, quote string"), every=every, hot=7)
    assert got.columns == ["i", "text", "j", "quote", "start", "end"]
    assert sorted(((r["i"], r["j"], r["start"], r["end"]) for r in got.collect()), key=repr) == occurrences(texts, quotes, every)


def test_quotes_of_empty_tables(spark):
    texts, quotes = table(spark, [(1, "abc")], "i int, text string"), table(spark, [(1, "b")], "j int, quote string")
    assert quote_spans(texts.limit(0), quotes).count() == 0 and quote_spans(texts, quotes.limit(0)).count() == 0
    assert [r["start"] for r in quote_spans(texts, quotes).collect()] == [1]


def test_more_quotes_than_a_driver_would_hold(spark):
    """More than two million characters of quotes, in one pass."""
    texts = spark.range(200).selectExpr("id AS i", "concat_ws(' ', transform(sequence(0, 199), k -> sha2(concat(id, ':', k), 256))) AS text")
    quotes = spark.range(40_000).selectExpr("id AS j", "CASE WHEN id % 2 = 0 THEN sha2(concat(id DIV 200, ':', id % 200), 256) ELSE sha2(concat('no', id), 256) END AS quote")
    got = quote_spans(texts, quotes).collect()
    assert len(got) == 20_000 and all(r["i"] == r["j"] // 200 and r["start"] == 65 * (r["j"] % 200) for r in got)


def test_a_quotes_runs_are_kept_in_every_text():
    rng = random.Random(6)
    for c in range(7):
        for _ in range(60):
            quote = "".join(rng.choice("ab") for _ in range(rng.randrange(1 << c, 2 << c)))
            before, after = ("".join(rng.choice("ab") for _ in range(rng.randrange(90))) for _ in range(2))
            ((_, places, hashes),) = kept_runs(quote, [c])
            ((_, there, values),) = kept_runs(before + quote + after, [c])
            assert len(places) and set(zip((places + len(before)).tolist(), hashes.tolist(), strict=True)) <= set(zip(there.tolist(), values.tolist(), strict=True))


def test_texts_go_to_python_in_pieces(spark):
    """Quotes across every cut of a long text, and none of its pieces is long."""
    rng = random.Random(7)
    body = "".join(rng.choice("abcdefgh 中😀\n") for _ in range(6 * PIECE + 70))
    texts = [(1, body), (2, body[:PIECE]), (3, body[: PIECE + 1]), (4, None), (5, "")]
    quotes = [(k, body[at : at + size]) for k, (at, size) in enumerate((cut * PIECE - before, size) for cut in range(1, 7) for before, size in ((1, 2), (5, 9), (40, 64), (63, 64), (64, 65), (1, 64), (0, 64), (100, 300)))]
    got = quote_spans(table(spark, texts, "doc long, text string"), table(spark, quotes, "q long, quote string"))
    assert sorted(((r["doc"], r["q"], r["start"], r["end"]) for r in got.collect()), key=repr) == occurrences(texts, quotes, True)
    cut = pieces(spark.createDataFrame(texts, "doc long, text string"), "doc", "text").collect()
    assert max(len(r["piece"]) for r in cut) == PIECE + 63
    assert "".join(r["piece"][:PIECE] for r in sorted(cut, key=lambda r: r["start"]) if r["doc"] == 1) == body


def test_texts_that_cannot_change_are_not_normalised(spark):
    """Texts without the characters of unsure() are in normal form C, and only few characters are among them."""
    rng = random.Random(3)
    sure = [c for c in map(chr, (*range(0xD800), *range(0xE000, 0x110000))) if ord(c) not in corpus.unsure()]
    assert corpus.unsure().isdisjoint(map(ord, "az éüñ中文字кд，。“”—…한😀"))
    assert all(unicodedata.is_normalized("NFC", "".join(rng.choices(sure[:60_000], k=50))) for _ in range(20_000))
    rows = [(k, t) for k, t in enumerate(["e\u0301", "한", "\u1112\u1161\u11ab", "\u212b", "中文", "", None, "a\u0323\u0307", "a\u0307\u0323"])]
    got = corpus.normalised(spark.createDataFrame(rows, "k int, text string"), "text").collect()
    assert {r["k"]: r["text"] for r in got} == {k: None if t is None else unicodedata.normalize("NFC", t) for k, t in rows}
