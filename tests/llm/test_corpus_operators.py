"""Quality, toxicity, packing, language model, neighbours, near duplicates and the pipeline."""

import json
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from inkstone.llm import additive_quantisation, jaccard_join, kneser_ney, packing, quality, toxicity
from inkstone.llm.common import fold, tokenizer_path

from .conftest import ODD, SF, linked, words_of

BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")


def test_quality_on_held_out_labels(spark, labelled, odd, none):
    docs, labels = labelled
    model = quality.train(docs, labels, fold("doc_id", 5) != 0)
    got = quality.scored(docs, model).join(labels, "doc_id").filter(fold("doc_id", 5) == 0).select("score", "quality").toPandas()
    assert ((got["score"] >= 0.3).astype(int) == got["quality"]).mean() >= 0.93
    scores = [r["score"] for r in quality.scored(odd, model).collect()]
    assert len(scores) == len(ODD) and all(0 <= s <= 1 for s in scores)
    assert quality.scored(none, model).count() == 0 and quality.kept(none, model).count() == 0
    assert quality.kept(odd, model).columns == odd.columns


def test_quality_without_labels(spark, odd):
    model = quality.train(odd, spark.createDataFrame([], "doc_id long, quality int"), F.lit(True))
    assert {round(r["score"], 9) for r in quality.scored(odd, model).collect()} == {0.3}


def test_ranking_recovers_an_order():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, quality.FEATURES))
    w = rng.normal(size=quality.FEATURES)
    y = (x @ w + rng.logistic(size=2000) > -1).astype(int)
    model = quality.fit(x, y, (y == 0).mean(), 20_000)
    assert np.corrcoef(model.weights / model.scale, w)[0, 1] > 0.95
    assert abs((model.score(x) < 0.3).mean() - (y == 0).mean()) < 0.02


def test_toxicity_on_held_out_labels(spark, labelled, odd, none):
    docs, labels = labelled
    model = toxicity.train(docs, labels, fold("doc_id", 5) != 0)
    got = toxicity.graded(docs, model).withColumnRenamed("toxic", "found").join(labels, "doc_id").filter(fold("doc_id", 5) == 0).toPandas()
    assert (got["found"] == got["toxic"]).mean() >= 0.93
    rows = toxicity.graded(odd, model).collect()
    assert len(rows) == len(ODD) and all(r["p_mild"] >= r["p_middle"] >= r["p_severe"] and abs(r["severity"] - r["p_mild"] - r["p_middle"] - r["p_severe"]) < 1e-9 for r in rows)
    assert toxicity.graded(none, model).count() == 0 and toxicity.clean(odd, model).columns == odd.columns
    empty = toxicity.train(odd, spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True))
    assert all(r["severity"] < 1e-9 for r in toxicity.graded(odd, empty).collect())


def test_ordinal_fit_recovers_thresholds():
    rng = np.random.default_rng(5)
    x, w = rng.normal(size=(4000, 3)), np.array([1.0, -2.0, 0.5])
    y = (x @ w + rng.logistic(size=4000))[:, None] > np.array([-1.0, 0.5, 2.0])
    doc, word = np.repeat(np.arange(4000), 3), np.tile(np.arange(3), 4000)
    weights, thresholds = toxicity.fit(doc, word, x.ravel(), y.sum(axis=1), 3, 3, steps=600)
    assert np.abs(weights - w).max() < 0.25 and np.all(np.diff(thresholds) > 0)


def graded_texts(n, seed, least=0):
    """(doc_id, text, grade): texts of 40 words, a word's kind being the likelier the higher the grade."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(least, least + n):
        grade = int(rng.integers(0, 4))
        kinds = rng.random(40) < [0.0, 0.1, 0.25, 0.5][grade]
        out.append((i, " ".join(f"bad{rng.integers(12)}" if k else f"word{rng.integers(300)}" for k in kinds), grade))
    return out


def test_grades_of_held_out_texts(spark):
    """Learned from grades, the expected grade is near the true one; learned from toxic or not alone, it still orders texts."""
    rows, new = graded_texts(1_500, 1), graded_texts(500, 2, 10_000)
    docs = spark.createDataFrame([r[:2] for r in rows + new], "doc_id long, text string")
    truth = {i: g for i, _, g in new}
    for labels, error in (([(i, g) for i, _, g in rows], 0.45), ([(i, int(g > 0)) for i, _, g in rows], None)):
        model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
        got = {r["doc_id"]: r for r in toxicity.graded(docs, model).collect() if r["doc_id"] in truth}
        assert np.mean([(got[i]["toxic"] > 0) == (g > 0) for i, g in truth.items()]) > 0.93
        means = [np.mean([got[i]["severity"] for i, g in truth.items() if g == k]) for k in range(4)]
        assert all(b > a + 0.3 for a, b in zip(means, means[1:], strict=False))
        if error:
            assert np.mean([abs(got[i]["severity"] - g) for i, g in truth.items()]) < error


def test_scores_against_brute_force(spark, labelled):
    """Each text's severity and grades by plain counting over Python words."""
    docs, labels = labelled
    model = toxicity.train(docs, labels, F.lit(True))
    place = {int(h): k for k, h in enumerate(model.words)}
    rows = docs.limit(60).collect()
    got = {r["doc_id"]: r for r in toxicity.graded(docs, model).collect()}
    for r in rows:
        words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", (r["text"] or "").encode())
        keys = [int(toxicity.hashed(pa.array([w.decode()]))[0][k]) for w in words if not w[:5].decode(errors="ignore").encode() != w[:5] for k in (0, 1)]
        if len(keys) != 2 * len(words):
            continue  # a stem would end inside a character
        total = sum(math.log1p(n) * model.weights[place[k]] for k, n in Counter(keys).items() if k in place)
        above = [1 / (1 + math.exp(-max(-40, min(40, total - t)))) for t in model.thresholds]
        assert math.isclose(got[r["doc_id"]]["severity"], sum(above), rel_tol=1e-9, abs_tol=1e-12)


def test_quality_features_and_scores_against_brute_force(spark, labelled):
    """Some features by plain Python, and the score as the logistic function of their weighted sum."""
    docs, labels = labelled
    model = quality.train(docs, labels, F.lit(True))
    texts = [t or "" for _, t in ODD] + [r["text"] for r in docs.limit(40).collect()]
    x = quality.features(pa.array(texts))
    assert x.shape == (len(texts), quality.FEATURES)
    for t, own in zip(texts, x, strict=True):
        raw, words = t.encode(), [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", t)]
        many = max(1, len(words))
        folded = [w.lower() if w.isascii() else re.sub(rb"[A-Z]", lambda m: m.group().lower(), w) for w in words]
        runs = [tuple(folded[k : k + 5]) for k in range(max(1, len(folded) - 4))] if folded else []
        expected = {1: sum(97 <= b < 123 for b in raw) / max(1, len(raw)), 4: sum(b >= 128 for b in raw) / max(1, len(raw)), 11: math.log1p(len(words)), 12: math.log1p(len(raw)), 13: sum(map(len, words)) / many}
        expected |= {15: sum(len(w) > 20 for w in words) / many, 16: sum(len(w) <= 2 for w in words) / many, 17: sum(65 <= w[0] < 91 for w in words) / many, 22: sum(a == b for a, b in zip(folded, folded[1:], strict=False)) / many}
        expected |= {23: len(set(folded)) / many, 24: len(set(folded)) / math.sqrt(many), 25: len(set(runs)) / max(1, len(runs))}
        for k, v in expected.items():
            assert math.isclose(own[k], v, rel_tol=1e-9, abs_tol=1e-12), (k, t[:50])
        raw_score = sum((v - m) / s * w for v, m, s, w in zip(own, model.mean, model.scale, model.weights, strict=True)) - model.threshold
        assert math.isclose(model.score(own[None])[0], 1 / (1 + math.exp(-max(-40, min(40, model.slope * raw_score + math.log(3 / 7))))), rel_tol=1e-9)


def test_labelled_ids_of_many_rows_count_once(spark):
    rng = np.random.default_rng(3)
    text = lambda k: " ".join(f"{'zz' if k else 'w'}{rng.integers(50)}" for _ in range(30))
    rows = [(i, text(i % 2)) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    once, often = (spark.createDataFrame(r, "doc_id long, text string").repartition(3) for r in (rows, rows + [rows[1]] * 500))
    a, b = (quality.train(d, labels, F.lit(True)) for d in (once, often))
    assert np.allclose(a.weights, b.weights)
    a, b = (toxicity.train(d, labels, F.lit(True)) for d in (once, often))
    assert np.array_equal(a.words, b.words) and np.allclose(a.weights, b.weights)


@pytest.mark.parametrize("seed", range(10))
def test_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    lengths = sorted((int(x) for x in rng.integers(1, 65, 300)), reverse=True)
    got = packing.best_fit_decreasing(lengths, 64)
    room, expected = [], []
    for n in lengths:
        fit = [r for r in room if r >= n]
        expected.append(min(fit) if fit else 64)
        if fit:
            room.remove(min(fit))
        room.append(expected[-1] - n)
    assert [64 - o for _, o in got] == expected
    used = defaultdict(list)
    for (w, o), n in zip(got, lengths, strict=True):
        used[w].append((o, n))
    for parts in used.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 64


def packed_right(rows, texts, length=2048):
    """Every id in one piece, every sequence gapless and within the length; gives the padding's share."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    ids = Counter()
    for i, t in texts:
        own = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for r in range(0, len(own), length):
            ids[i, r, len(own[r : r + length]), zlib.crc32(own[r : r + length].tobytes()), len(own)] += 1
    assert ids == Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= length
    return 1 - sum(r["length"] for r in rows) / (length * len(sequences))


def test_packing(spark, odd, none, documents):
    path = tokenizer_path("word_bpe_49k.json")
    packed_right(packing.pack(odd, path).collect(), ODD)
    texts = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert packed_right(packing.pack(documents, path, with_ids=True).collect(), texts) < 0.02
    packed_right(packing.pack(documents, path, length=100, group_rows=50).collect(), texts, 100)
    assert packing.pack(none, path).count() == 0


def test_runs_give_the_ids_of_the_tokenizer():
    """Random texts of code points that the shorter way takes, and some that it leaves to the tokenizer."""
    own = packing.WordBPE(tokenizer_path("word_bpe_49k.json"))
    assert not own.whole
    rng = np.random.default_rng(12)
    alphabets = [range(0x20, 0x7F), range(0, 0x180), [*range(0x41, 0x5B), *range(0x61, 0x7B), 0x20, 0x27, 0x0A, 0x85, 0xA0], [*range(0x20, 0x250), 0x130, 0x301, 0x3C2, 0x4E2D, 0x1F600]]
    for letters in alphabets:
        for n in rng.integers(0, 40, 700):
            text = "".join(map(chr, rng.choice(list(letters), n)))
            assert np.frombuffer(own.encode(text), "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("change", [("normalizer", None), ("pre_tokenizer", {"type": "Whitespace"}), ("added_tokens", [{"id": 0, "content": "word", "single_word": False, "lstrip": False, "rstrip": False, "normalized": True, "special": False}])])
def test_other_tokenizers_take_whole_texts(tmp_path, change):
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        sections = json.load(f)
    sections[change[0]] = change[1]
    (tmp_path / "other.json").write_text(json.dumps(sections))
    own = packing.WordBPE(str(tmp_path / "other.json"))
    assert own.whole and np.frombuffer(own.encode("A word's 12 words"), "<u4").tolist() == own.tokenizer.encode("A word's 12 words", add_special_tokens=False).ids


def test_repeated_rows_spread_over_groups(spark):
    docs = spark.createDataFrame([(1, "the same text")] * 3_000 + [(None, None)] * 500, "doc_id long, text string").repartition(4)
    rows = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), group_rows=100).collect()
    packed_right(rows, [(1, "the same text")] * 3_000 + [(None, None)] * 500)
    groups = Counter(r["sequence_id"] >> 40 for r in rows)
    assert len(groups) == 35 and max(groups.values()) < 200


def kneser_ney_by_hand(rows, training):
    tokens = {k: [*words_of(t), "</s>"] for k, t in enumerate(t for _, t in rows)}
    counts, pairs = Counter(), Counter()
    for k in training:
        counts.update(tokens[k])
        pairs.update(zip(["<s>", *tokens[k]], tokens[k], strict=False))
    left, total, follow = Counter(w for _, w in pairs), Counter(), defaultdict(lambda: [0] * 4)
    for (v, w), c in pairs.items():
        total[v] += c
        follow[v][min(c, 3)] += 1
    level = lambda cs: kneser_ney.Level.of([sum(c == k for c in cs) for k in (1, 2, 3, 4)]).discounts
    d, e, n, v_all = level(pairs.values()), level(left.values()), sum(counts.values()), len(counts)
    spare = sum(e[min(c, 3)] for c in left.values()) / max(1, len(pairs))

    def p(v, w):
        low = max(left[w] - e[min(left[w], 3)], 0) / len(pairs) + spare / (v_all + 1)
        if not total[v]:
            return low
        return max(pairs[v, w] - d[min(pairs[v, w], 3)], 0) / total[v] + sum(d[k] * follow[v][k] for k in (1, 2, 3)) / total[v] * low

    score = [sum(math.log10(p(v, w)) for v, w in zip(["<s>", *t], t, strict=False)) for t in tokens.values()]
    base = [sum(math.log10((counts[w] + 1) / (n + v_all + 1)) for w in t) for t in tokens.values()]
    return tokens, counts, n, base, score, p


def test_kneser_ney(spark, documents, odd, none):
    texts = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    training = [k for k, (i, _) in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    tokens, counts, n, base, score, p = kneser_ney_by_hand(texts, training)
    got = {r["doc_id"]: r for r in kneser_ney.perplexity(documents, fold("doc_id", 7) != 2).collect()}
    for k, (i, _) in enumerate(texts):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens[k]), sum(w in counts for w in tokens[k]), n)
        assert math.isclose(r["base_score"], base[k], rel_tol=1e-9) and math.isclose(r["score"], score[k], rel_tol=1e-9)
    for context in ("the", "<s>", "never seen"):
        assert abs(sum(p(context, w) for w in counts) + p(context, "never seen") - 1) < 1e-9
    held = [k for k in range(len(texts)) if k not in set(training)]
    assert sum(score[k] for k in held) > sum(base[k] for k in held)
    rows = kneser_ney.perplexity(odd, F.col("doc_id").isNotNull()).collect()
    assert len(rows) == len(ODD) and all(math.isfinite(r["score"]) and r["n_tokens"] >= 1 for r in rows)
    assert kneser_ney.perplexity(none, F.lit(True)).count() == 0
    assert all(r["score"] == 0 and r["train_tokens"] == 0 for r in kneser_ney.perplexity(odd, F.lit(False)).collect())


def test_kneser_ney_dealt_twice_and_with_large_counts(spark, documents, monkeypatch):
    expected = {r["doc_id"]: (r["n_known"], r["score"]) for r in kneser_ney.perplexity(documents, F.lit(True)).collect()}
    monkeypatch.setattr(kneser_ney, "DEALT", 2)
    again = kneser_ney.train(documents)
    assert again.ranges == {"bigrams": 4, "words": 2}
    got = {r["doc_id"]: (r["n_known"], r["score"]) for r in kneser_ney.scored(documents, again).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in expected.items()} and all(math.isclose(got[k][1], expected[k][1], rel_tol=1e-9) for k in got)
    for numbers in ([1, 2, 3], [1, 2**32 - 1], [1, 2**32, 2**50]):
        assert kneser_ney.columns_of(kneser_ney.planes(np.array(numbers), np.array(numbers)), 2).tolist() == [numbers] * 2


def test_counts_beyond_32_bits_are_kept_in_files(tmp_path):
    keys, counts = np.array([3, 5, 2**63], np.uint64), np.array([[1, 2**32 + 7, 2**40], [1, 2, 3]])
    for name, columns in (("large", counts), ("small", counts % 1000)):
        kneser_ney.write_columns(f"{tmp_path}/{name}", keys, columns)
        own, got = kneser_ney.Maps().of(f"{tmp_path}/{name}", 2)
        assert own.tolist() == keys.tolist() and np.array_equal(np.stack(got), columns)
    assert (tmp_path / "large").stat().st_size - (tmp_path / "small").stat().st_size == 24


def test_beam_search_beats_a_narrow_one():
    x = np.random.default_rng(2).normal(size=(600, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    words = additive_quantisation.train(x, 4, 16, 1, rounds=0).words
    error = [((x - (c := additive_quantisation.Codebooks(words, beam)).decode(c.encode(x))) ** 2).sum() for beam in (1, 16)]
    assert error[1] <= error[0]
    solved = additive_quantisation.train(x, 4, 16, 16, rounds=2)
    assert ((x - solved.decode(solved.encode(x))) ** 2).sum() < error[1]


def nearest(ids, x, chosen, k=5):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in chosen:
        s = x @ x[ids.index(i)]
        out[i] = [j for _, j in sorted((-s[n], j) for n, j in enumerate(ids) if j != i)][:k]
    return out


def test_neighbours(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = defaultdict(dict)
    for r in additive_quantisation.search(vectors, F.col("vec_id") % 50 == 0, codewords=64).collect():
        got[r["query_id"]][r["rank"]] = r["vec_id"]
    rows = sorted((r["vec_id"], r["embedding"]) for r in vectors.collect())
    expected = nearest([i for i, _ in rows], np.array([v for _, v in rows], float), [i for i, _ in rows if i % 50 == 0])
    hits = [len(set(expected[q]) & set(got[q].values())) for q in expected]
    assert sum(hits) >= 0.9 * 5 * len(expected) and all(list(sorted(v)) == [1, 2, 3, 4, 5] for v in got.values())


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0]), (50, [1.0, 1.0]), (1, [2.0, 0.0]), (9, [3.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in additive_quantisation.search(vectors, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 9), (0, 3, 50), (0, 4, 2), (50, 1, 0), (50, 2, 1), (50, 3, 2), (50, 4, 9)]
    assert additive_quantisation.search(vectors.limit(0), F.col("vec_id") == 0).count() == 0
    assert additive_quantisation.search(vectors.filter("vec_id = 0"), F.col("vec_id") == 0).count() == 0


def test_recall_of_a_narrow_rerank(spark):
    """20,000 vectors around 400 centres; one in a hundred is scored exactly for each query."""
    rng = np.random.default_rng(9)
    x = (rng.normal(size=(400, 32))[rng.integers(0, 400, 20_000)] + 0.7 * rng.normal(size=(20_000, 32))).astype(np.float32)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = defaultdict(set)
    for r in additive_quantisation.search(vectors, F.col("vec_id") % 200 == 0, rerank=200, codewords=64, sample=4_096, run=2).collect():
        got[r["query_id"]].add(r["vec_id"])
    expected = nearest(list(range(20_000)), x.astype(float), range(0, 20_000, 200))
    assert sum(len(set(expected[q]) & got[q]) for q in expected) >= 0.9 * 5 * len(expected)


def test_repeated_ids_dimensions_and_extreme_lengths(spark):
    """Rows of one id with other vectors are candidates, of each other too; each dimension is searched by itself; components
    beyond the square root of the range of doubles give true cosines."""
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (1, [0.0, 1.0]), (2, [0.5, 0.5]), (0, [0.0, 1.0]), (3, [1.0, 0.0, 0.0]), (50, [1.0, 1.0, 0.0]), (4, [1e-170, 1e-170]), (5, [1e160, -1e160])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(Counter)
    for r in additive_quantisation.search(vectors, F.col("vec_id") % 50 == 0, k=8).collect():
        got[r["query_id"]][r["rank"], r["vec_id"], round(r["score"], 9)] += 1
    cos = lambda a, b: round(float(np.dot(np.array(a) / np.hypot(*a), np.array(b) / np.hypot(*b))), 9)
    expected = Counter()
    flat = [(i, v if max(map(abs, v)) > 1e-9 else [1.0, 1.0]) for i, v in rows if len(v) == 2]
    flat = [(i, v if max(map(abs, v)) < 1e9 else [1.0, -1.0]) for i, v in flat]
    for a, (i, v) in enumerate(flat):
        if i == 0:
            best = sorted(((-cos(v, w), j) for b, (j, w) in enumerate(flat) if b != a))
            expected.update((rank, j, -s) for rank, (s, j) in enumerate(best, 1))
    assert got[0] == expected and got[50] == Counter({(1, 3, round(0.5**0.5, 9)): 1}) and set(got) == {0, 50}


def test_prefixes_meet_often_enough():
    rng = np.random.default_rng(4)
    hot = (np.sort(rng.integers(0, 2**32, 50).astype(np.uint32)), rng.integers(12, 5000, 50))
    pool = np.unique(np.concatenate([rng.integers(0, 2**63, 300).astype(np.uint64), hot[0].astype(np.uint64) << np.uint64(32)]))
    for _ in range(500):
        a = np.sort(rng.choice(pool, rng.integers(1, 80), replace=False))
        b = np.unique(np.concatenate([rng.choice(a, max(1, int(len(a) * rng.uniform(0.6, 1))), replace=False), rng.choice(pool, rng.integers(0, 8))]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            (x, _, l), (y, _, m) = jaccard_join.prefix(a, hot, 75), jaccard_join.prefix(b, hot, 75)
            assert len(np.intersect1d(x, y)) >= min(l, m)


def check_join(docs, rows, **how):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_join(docs, **how).collect() if r["doc_id"] is not None}
    assert got == linked(rows)


def test_jaccard_join(spark, documents, none):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    check_join(documents, rows)
    check_join(documents, rows, hot=2, run=3)
    assert jaccard_join.jaccard_join(none).count() == 0


def test_jaccard_join_of_large_groups(spark):
    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(300):  # near copies of one text, copies, and texts that share a long passage
        words = base.copy()
        for k in rng.choice(60, rng.integers(0, 4), replace=False):
            words[k] = f"x{rng.integers(40)}"
        rows.append((i, " ".join(words)))
    rows += [(300 + i, " ".join(base[:30] + [f"y{i}_{k}" for k in range(25)])) for i in range(100)]
    rows += [(400 + i, " ".join(base[:30] + [f"z{i % 50}_{k}" for k in range(rng.integers(2, 12))])) for i in range(100)]
    check_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), rows, hot=5, run=20)


def test_jaccard_join_of_shared_passages(spark):
    """Short texts that are mostly one passage, with more or less of their own, in lists that are cut and not."""
    rng = np.random.default_rng(11)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(240):
        own = [f"o{i // 2 if i % 3 == 0 else i}_{k}" for k in range(rng.integers(1, 18))]
        cut = int(rng.integers(0, len(own) + 1))
        rows.append((i, " ".join(own[:cut] + passage + own[cut:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check_join(docs, rows, hot=1000)
    check_join(docs, rows, hot=5, run=20)


def test_jaccard_join_of_odd_texts(spark, odd):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_join(odd).collect()}
    assert {r for r in got if r[0] is not None} == {(i, *x) for i, x in linked(ODD).items()}
    assert jaccard_join.jaccard_join(odd).count() == len(ODD)
    assert jaccard_join.one_of_each(odd).columns == odd.columns


def check_links(docs, rows, **how):
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := words_of(t)) else frozenset() for _, t in rows]
    having, both = defaultdict(list), Counter()
    for i, own in enumerate(sets):
        for s in own:
            both.update((j, i) for j in having[s])
            having[s].append(i)
    pairs = [p for p, n in both.items() if 100 * n >= 75 * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    linked_with = Counter(x for p in pairs for x in p)
    got = jaccard_join.link_counts(docs, **how).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["n_links"]) for r in got) == Counter((i, len(s), linked_with[k]) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True)))
    class_of = {}
    for r in got:
        class_of.setdefault(r["doc_id"], r["class"])
    expected = {tuple(sorted((class_of[rows[a][0]], class_of[rows[b][0]]))) for a, b in pairs if sets[a] != sets[b]}
    found = [(r["a"], r["b"]) for r in jaccard_join.links(docs, **how).collect()]
    assert len(found) == len(set(found)) and set(found) == expected
    return found, got


def test_links_of_the_table(spark, documents, none):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    check_links(documents, rows, hot=2, run=3)
    assert jaccard_join.links(none).count() == 0 and jaccard_join.link_counts(none).count() == 0


def test_links_within_one_component(spark):
    """Near copies of one text are one component at once, but many of its pairs link and some don't."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(150):
        words = [f"w{k}" for k in range(60)]
        for k in rng.choice(60, rng.integers(0, 4), replace=False):
            words[k] = f"x{rng.integers(40)}"
        rows.append((i, " ".join(words)))
    rows += [(150 + i, rows[i % 3][1]) for i in range(9)] + [(200, ""), (201, None), (202, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found, got = check_links(docs, rows, hot=5, run=20)
    classes = {r["class"] for r in got if r["n_links"]}
    assert len(classes) < len(found) < len(classes) * (len(classes) - 1) // 2
    check_links(docs, rows)


def test_texts_without_ids_link(spark):
    """1 and 2 don't link, but both link with a text whose only rows have no doc_id."""
    words = [f"w{k}" for k in range(100)]
    far = [*words[:-10], *(f"x{k}" for k in range(10))], [*(f"y{k}" for k in range(10)), *words[10:]]
    rows = [(1, " ".join(far[0])), (2, " ".join(far[1])), (None, " ".join(words)), (None, " ".join(words)), (None, "of no other"), (3, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["component_id"]) for r in jaccard_join.jaccard_join(docs).collect())
    assert got == Counter({(1, 1): 1, (2, 1): 1, (None, 1): 2, (None, None): 1, (3, 3): 1})
    assert Counter((r["doc_id"], r["n_links"]) for r in jaccard_join.link_counts(docs).collect()) == Counter({(1, 2): 1, (2, 2): 1, (None, 3): 2, (None, 0): 1, (3, 0): 1})


def expected_to_stay(rows):
    """How many rows of each (doc_id, text) stay when one of each component does, by brute force."""
    shingles = [frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := words_of(t)) else frozenset() for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(shingles):
        for j in range(i):
            both = len(a & shingles[j])
            if a and shingles[j] and 100 * both >= 75 * (len(a) + len(shingles[j]) - both):
                up[root(i)] = root(j)
    groups = defaultdict(list)
    for i, own in enumerate(shingles):
        groups[root(i) if own else ("none", i)].append(i)
    return [{rows[i] for i in own if (rows[i][0] is None, rows[i][0]) == min((rows[k][0] is None, rows[k][0] or 0) for k in own) or (rows[i][0] is None and all(rows[k][0] is None for k in own))} for own in groups.values()]


def test_one_of_each_with_repeated_and_null_ids(spark):
    """One row of every group stays, whatever its ids: repeated ids with other texts, equal rows, rows without ids."""
    words = [f"w{k}" for k in range(60)]
    near, other = " ".join([*words[:-2], "x", "y"]), " ".join(f"z{k}" for k in range(20))
    rows = [(1, " ".join(words)), (2, near), (2, other), (3, other), (3, other), (4, "alone"), (4, "alone"), (None, " ".join(words)), (None, "no id"), (None, "no id"), (5, ""), (5, ""), (6, None), (2, "a third text of two")]
    docs = spark.createDataFrame([(i, t, "k", 1, 5, [2], "c") for i, t in rows], "doc_id long, text string, class string, n_rows int, _id int, _class array<int>, first string").repartition(3)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    groups = expected_to_stay(rows)
    assert sum(got.values()) == len(groups)
    for allowed in groups:
        got -= Counter([next(r for r in allowed if got[r])])
    assert not got
    assert jaccard_join.one_of_each(docs.limit(0)).count() == 0


def test_pipeline_of_odd_and_empty_tables(spark, odd, none, tmp_path):
    """All four stages, over repeated and null ids and over nothing."""
    for name, docs in (("odd", odd), ("empty", none)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (6, 0, 1), (None, 1, 1), (1, 0, 0)] if name == "odd" else [], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        rows = docs
        for stage, f in corpus_pipeline.STAGES[:-1]:
            rows = spark.createDataFrame(f(spark, rows, f"{tmp_path}/{name}").collect(), docs.schema)
        texts = [(r["doc_id"], r["text"]) for r in rows.collect()]
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert Counter((r["doc_id"], r["start"], r["length"]) for r in got) == Counter((r["doc_id"], r["start"], r["length"]) for r in corpus_pipeline.STAGES[-1][1](spark, rows, "").collect())
        assert (len(got) > 0) == (name == "odd") and len(texts) <= len(got)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (5, 5), (200, 201), (201, 202), (202, 200)]
    got = {r["class"]: r["component"] for r in jaccard_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 200: 200, 201: 200, 202: 200}


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, rows, SF)
        assert kept.columns == docs.columns and kept.join(rows, "doc_id", "left_anti").count() == 0
        if name == "near duplicates":
            expected = {i for i, (_, c) in linked([(r["doc_id"], r["text"]) for r in rows.collect()]).items() if i == c}
            assert {r["doc_id"] for r in kept.collect()} == expected
        rows = spark.createDataFrame(kept.collect(), docs.schema)
    texts = [(r["doc_id"], r["text"]) for r in rows.collect()]
    packed_right(corpus_pipeline.STAGES[-1][1](spark, rows, SF).collect(), texts)
    assert corpus_pipeline.run(spark, SF).select("doc_id").distinct().count() == len(texts)


def test_all_queries_are_registered():
    names = list(__spark_entry__.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))


def test_long_rows_are_cut_into_bounded_parts():
    from inkstone.llm.common import slices

    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (10, 0, 50, 200, 1, 1)] + [None])], ["text"])
    parts = [p.column(0).to_pylist() for p in slices(batch, "text", 100)]
    assert sum(parts, []) == batch.column(0).to_pylist() and max(len(p) for p in parts) < 7


def test_most_frequent_shingles_within_their_bound(spark):
    """All of the higher steps, a share by hash of the one that the bound falls into, nothing beyond the bound; empty tables."""
    rng = np.random.default_rng(4)
    hashes = np.unique(rng.integers(0, 1 << 32, 30_000))
    counts = np.where(rng.random(len(hashes)) < 0.1, rng.integers(1_000, 100_000, len(hashes)), rng.integers(12, 16, len(hashes)))
    often = spark.createDataFrame(list(zip(hashes.tolist(), counts.tolist(), strict=True)), "shingle long, n_docs long")
    for most in (2_000, 10_000, 20_000, 50_000):
        keys, n = jaccard_join.most_frequent(often, most)
        got = dict(zip(keys.tolist(), n.tolist(), strict=True))
        assert (np.diff(keys.astype(np.int64)) > 0).all() and got.items() <= dict(zip(hashes.tolist(), counts.tolist(), strict=True)).items()
        assert min(most, len(hashes)) * 0.9 <= len(got) <= most
        assert min(got.values()) * 1.02 >= max((c for h, c in zip(hashes.tolist(), counts.tolist(), strict=True) if h not in got), default=0)
    assert [len(x) for x in jaccard_join.most_frequent(often.limit(0), 5)] == [0, 0]
