"""Whitening, vector codes and byte-pair coding against plain forms."""

import hashlib
import json
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
from inkstone.llm import bpe_codec, vector_codes, whitening
from inkstone.llm.common import tokenizer_path

from .conftest import ODD, SF

VECTORS = "vec_id long, embedding array<double>, label int, x string, whitened int, part int, of int, v int"


def table_of(spark, rows):
    """Rows (vec_id, embedding, label) with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, v, k, "x", 1, 2, 3, 4) for i, v, k in rows], VECTORS).repartition(3)


def kept(rows):
    return [(i, v, k) for i, v, k in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def odd_rows(n=60, d=6, seed=1, far=1.0):
    rng = np.random.default_rng(seed)
    rows = [(i, (far * rng.normal(size=d)).tolist(), None if i % 5 == 0 else i % 3) for i in range(n)]
    return [*rows, rows[3], rows[3], (rows[4][0], rows[5][1], 1), (None, rows[6][1], None), (1000, None, 1), (1001, [None] * d, 1), (1002, [math.nan] * d, 2), (1003, [math.inf] * d, 2), (1004, [-0.0] * d, 2)]


# ---------------------------------------------------------------- whitening


def whitened_by_loop(rows, components=8):
    """(vec_id, component, deviation, |whitened|, explained) with exact sums in Python's integers."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v, _ in kept(rows)]
    n, d = len(x), len(x[0])
    s = [sum(r[k] for r in x) for k in range(d)]
    diff = [[n * r[k] - s[k] for k in range(d)] for r in x]
    c = np.array(diff, float) / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    z = c @ vectors / np.sqrt(values)
    out = []
    for (i, _, _), dev, row in zip(kept(rows), diff, z, strict=True):
        out += [(i, k + 1, sum(v * v for v in dev), abs(row[k]), values[k] / values.sum()) for k in range(min(components, d))]
    return out


def order(r):
    return (r[0] is None, r[0] or 0, r[1], r[2], r[3])


@pytest.mark.parametrize("d", [3, 12])
def test_whitening_matches_a_loop(spark, d):
    rows = odd_rows(d=d)
    got = whitening.whitened(table_of(spark, rows)).collect()
    expected = sorted(whitened_by_loop(rows), key=order)
    found = sorted(((r["vec_id"], r["component"], int(r["deviation"]), abs(r["whitened"]), r["explained"]) for r in got), key=order)
    assert [r[:3] for r in found] == [r[:3] for r in expected]
    assert np.allclose([r[3:] for r in found], [r[3:] for r in expected], atol=1e-7)
    assert {r["n"] for r in got} == {len(kept(rows))} and len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whitening_has_one_sign_and_survives_an_offset(spark):
    """Small deviations on a large common offset; the same projection for all rows."""
    rng = np.random.default_rng(2)
    rows = [(i, (1e6 + rng.normal(size=4) * [1, 0.1, 0.05, 0.02]).tolist(), 0) for i in range(300)]
    got = whitening.whitened(table_of(spark, rows)).collect()
    assert got[0]["identity_error"] < 1e-6
    z = np.zeros((300, 4))
    for r in got:
        z[r["vec_id"], r["component"] - 1] = r["whitened"]
    x = np.floor(1024 * np.array([v for _, v, _ in rows]))
    fitted, *_ = np.linalg.lstsq(x - x.mean(axis=0), z, rcond=None)
    assert np.abs((x - x.mean(axis=0)) @ fitted - z).max() < 1e-6  # one linear map gives them all


def test_whitening_of_odd_tables(spark):
    assert whitening.whitened(table_of(spark, [])).count() == 0
    assert whitening.whitened(table_of(spark, [(1, None, 1), (2, [], 0)])).count() == 0
    one = whitening.whitened(table_of(spark, [(1, [1.0, 2.0], 1)])).collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None), (2, 0, None, None, None)]
    flat = whitening.whitened(table_of(spark, [(i, [float(i), 5.0], 0) for i in range(4)])).collect()
    assert sorted((r["vec_id"], r["component"], r["whitened"] is None) for r in flat) == [(i, k, k == 2) for i in range(4) for k in (1, 2)]
    mixed = whitening.whitened(table_of(spark, [*odd_rows(d=2), *odd_rows(d=3)])).collect()
    assert sorted({(r["component"], r["n"]) for r in mixed}) == [(1, len(kept(odd_rows()))), (2, len(kept(odd_rows()))), (3, len(kept(odd_rows())))]
    far = whitening.whitened(table_of(spark, [(1, [1e300, 0.0], 0), (2, [-1e300, 1.0], 0), (3, [1e18, 7.0], 0)])).collect()
    assert len(far) == 6 and all(r["explained"] is not None for r in far)


def test_whitening_query(spark):
    got = __spark_entry__.queries()["op11_whitening"](spark, SF)
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    expected = {(i, c): (dev, z, e) for i, c, dev, z, e in whitened_by_loop(rows)}
    found = got.collect()
    assert dict(got.dtypes)["deviation"] == "bigint" and len(found) == len(expected)
    for r in found:
        dev, z, e = expected[r["vec_id"], r["component"]]
        assert r["deviation"] == dev and abs(abs(r["whitened"]) - z) < 1e-6 and abs(r["explained"] / e - 1) < 1e-9 and r["identity_error"] < 1e-9


# ---------------------------------------------------------------- vector codes


def coded_by_loop(rows, parts=4, entries=256, rounds=4):
    """Lloyd's rounds with every distance computed, in Python's integers: (vec_id, label, codes, error, label_error) and
    the digest."""
    good = [(i, [math.floor(1024 * c) for c in v], k) for i, v, k in kept(rows)]
    d = len(good[0][1])
    at = [k * (d // parts) + min(k, d % parts) for k in range(parts + 1)]
    first = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][at[p] : at[p + 1]] for r in first] for p in range(parts)]

    def nearest(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(x[at[p] : at[p + 1]], e, strict=True)), k) for k, e in enumerate(books[p]))

    for turn in range(rounds + 1):
        codes = [[nearest(x, p) for p in range(parts)] for _, x, _ in good]
        if turn == rounds:
            break
        for p in range(parts):
            members = defaultdict(list)
            for (_, x, _), c in zip(good, codes, strict=True):
                members[c[p][1]].append(x[at[p] : at[p + 1]])
            for e, own in members.items():
                books[p][e] = [sum(v) // len(own) for v in zip(*own, strict=True)]
    by_label = defaultdict(int)
    for (_, _, k), c in zip(good, codes, strict=True):
        by_label[k] += sum(e for e, _ in c)
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted(((i, k, [e for _, e in c], sum(e for e, _ in c), by_label[k]) for (i, _, k), c in zip(good, codes, strict=True)), key=repr), digest


def coded(df, **how):
    got = vector_codes.product_codes(df, **how).collect()
    return sorted(((r["vec_id"], r["label"], r["codes"], int(r["error"]), int(r["label_error"])) for r in got), key=repr), {r["codebooks_sha256"] for r in got}


@pytest.mark.parametrize(("d", "entries", "far"), [(8, 16, 1.0), (6, 7, 1.0), (4, 16, 0.004), (3, 5, 1.0), (4, 8, 2.0**34)])
def test_vector_codes_match_a_loop(spark, d, entries, far):
    """Even and uneven parts, many ties, and components whose squares no 64-bit number holds."""
    rows = odd_rows(n=150, d=d, far=far)
    expected, digest = coded_by_loop(rows, entries=entries)
    found, digests = coded(table_of(spark, rows), entries=entries, block=16)
    assert found == expected and digests == {digest}


def test_heaps_leave_parts_unseen_and_change_nothing():
    """Over many rounds of moving codebooks, what the heaps leave alone is nearest to its entry still."""
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(400, 4)) * 30 + rng.integers(0, 6, size=(400, 1)) * 300).astype(np.int64)
    books = vector_codes.Codebooks(x[:12].copy(), 1, 4000)
    codes, slack = books.nearest(x, 0)
    heap = vector_codes.Heaps.of(codes.copy(), slack, 12)
    seen_in_all = 0
    for _ in range(8):
        words = books.words.copy()
        for e in np.unique(heap.codes):
            words[e] = x[heap.codes == e].sum(axis=0) // (heap.codes == e).sum()
        books = books.moved(words)
        heap = vector_codes.Heaps.read(heap.codes, heap.keys, heap.order(), 12)
        seen = heap.violated(books.drift[0])
        seen_in_all += len(seen)
        codes, slack = books.nearest(x[seen], 0)
        for row, code, key in zip(seen, codes.tolist(), (slack + books.drift[0][codes]).tolist(), strict=True):
            heap.push(row, code, key)
        assert (heap.codes == books.squares(x, 0).argmin(axis=1)).all() and len(heap.order()) == 400
    assert 0 < seen_in_all < 8 * 400 / 2


def test_vector_codes_of_odd_tables(spark):
    assert vector_codes.product_codes(table_of(spark, [])).count() == 0
    assert coded(table_of(spark, [(5, [1.0, 2.0, 3.0, 4.0], None)]))[0] == [(5, None, [0, 0, 0, 0], 0, 0)]
    assert [r[2:] for r in coded(table_of(spark, [(7, [], 1), (8, [], 1)]))[0]] == [([0] * 4, 0, 0)] * 2
    two = [*odd_rows(n=40, d=4), *odd_rows(n=40, d=8, seed=2)]
    found, digests = coded(table_of(spark, two), entries=4)
    assert digests == {coded_by_loop(odd_rows(n=40, d=4), entries=4)[1], coded_by_loop(odd_rows(n=40, d=8, seed=2), entries=4)[1]}
    total = defaultdict(int)
    for _, k, _, e, _ in found:
        total[k] += e
    assert all(s == total[k] for _, k, _, _, s in found)  # over all rows of a label, whatever their dimension


def test_vector_codes_query(spark):
    got = __spark_entry__.queries()["op13_vector_codes"](spark, SF).collect()
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    expected, digest = coded_by_loop(rows)
    assert {(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got} == {(i, "".join(f"{e:02x}" for e in c), e, s) for i, _, c, e, s in expected}
    assert {r["codebooks_sha256"] for r in got} == {digest} and len(got) == len(expected)


# ---------------------------------------------------------------- byte-pair coding


def awkward_texts(n, seed=1):
    rng = random.Random(seed)
    alphabet = "abcdefghijklmnopqrstuvwxyzABCé üßœŀ中文字😀ΣσςİıŉǅК'-.,!?0123½²\t\n \u0085́‍<|>endoftext"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(n)]
    return [*made, *(t or "" for _, t in ODD), "ab" * 2000, "z" * 5000, "<|endoftext|>x<|startoftext|><|endoftext|", "é<|endoftext|>́", "\x00\x01\x7f\xad"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_bpe_matches_the_library(name):
    own, library = bpe_codec.ForcedBPE(tokenizer_path(name)), Tokenizer.from_file(tokenizer_path(name))
    for text in awkward_texts(800):
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids, text
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False), text
    rng = random.Random(2)
    for _ in range(200):
        ids = [rng.randrange(50_300) for _ in range(20)]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_forced_cuts_are_certain_and_long_merges_equal_short_ones():
    own = bpe_codec.ForcedBPE(tokenizer_path("word_bpe_49k.json"))
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgxyzqvé中") for _ in range(rng.randrange(1, 40))).encode() for _ in range(600)]
    split = 0
    for w in words:
        parts = own.fragments(w)
        split += len(parts) > 1
        assert b"".join(f for f, _ in parts) == w and [e for _, e in parts] == [False] * (len(parts) - 1) + [True]
        whole = own.merged(w, True)
        assert np.frombuffer(own.word(w), "<u4").tolist() == whole
        assert own._merged_long([own.one[b] for b in w[:-1]] + [own.last[w[-1]]]) == whole
    assert split > 100


def test_bpe_refuses_what_it_does_not_know(tmp_path):
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    for change in ({"model": spec["model"] | {"unk_token": "!"}}, {"decoder": {"type": "WordPiece"}}, {"added_tokens": [spec["added_tokens"][0] | {"lstrip": True}]}, {"pre_tokenizer": {"type": "Whitespace"}}):
        (tmp_path / "t.json").write_text(json.dumps(spec | change), encoding="utf-8")
        with pytest.raises(ValueError):
            bpe_codec.ForcedBPE(str(tmp_path / "t.json"))


def test_bpe_query(spark, odd, none):
    path = tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = __spark_entry__.queries()["op12_bpe"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    rows = bpe_codec.coded(odd, path)
    found = sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in rows.collect()), key=repr)
    assert found == sorted(((i, ids := library.encode(t or "", add_special_tokens=False).ids, library.decode(ids, skip_special_tokens=False)) for i, t in ODD), key=repr)
    back = {(r["doc_id"], r["text"]) for r in bpe_codec.decoded(rows.withColumn("ids", F.when(F.col("doc_id") == 9, None).otherwise(F.col("ids"))), path).collect()}
    assert back == {(i, None if i == 9 else t) for i, _, t in found}
    assert bpe_codec.coded(none, path).count() == 0
