"""Operator 4: toxicity grades by cumulative-link ordinal regression.

P(grade >= k) is the logistic function of x . w - t_k: the weights are shared by all thresholds, and the thresholds
are kept in order. x holds log(1 + count) of the words and stems (a word's first five bytes) of a vocabulary in the
whole text, lower-cased; words are runs of ASCII letters, digits and bytes beyond ASCII. The output is the expected grade, the sum of P(grade >= k).

Labels are grades from 0 (not toxic). Where they only say toxic or not, grades among the toxic are made by cross-fitting: a
model of toxic or not that is learned from one half of the sample's doc_ids gives the other half's probabilities, and the
toxic documents' terciles of these are the grades (1 mild, 2 middle, 3 severe). So a severity then orders documents by how
sure a model that never saw them is that they are toxic; it knows no other scale.

Vocabulary and weights are fitted on at most `sample` labelled documents of each class, toxic or not, those of least hash; a
labelled doc_id of several rows counts once, by the least of its texts. The vocabulary is the `words` words at most, of
`least_docs` documents or more, whose document counts differ most between the classes (z of the log odds ratio, at least
`least_z`); the README has the held-out errors at other values.

Defined results: null and empty texts have no features; a null doc_id is scored and stays null; repeated rows each get
a row; an empty table gives an empty result; without labels of both classes every severity is 0; further columns of the
input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstone.llm.common import SMALL_SLICE, column_of, distinct_sorted, mix, saved, slices, text_bytes, word_hashes
from inkstone.llm.quality import labelled


STEM = 5


@dataclass(frozen=True)
class Severity:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, column: pa.Array) -> np.ndarray:
        """P(grade >= k), a row for each text."""
        n = len(column)
        total = np.zeros(n)
        doc, word, count = counted(column, self.words)
        if len(doc):
            total = np.bincount(doc, np.log1p(count) * self.weights[word], minlength=n)
        return sigmoid(total[:, None] - self.thresholds)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def hashed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each word of the texts its hash and that of its first STEM bytes, and the texts' offsets in them."""
    raw, at = text_bytes(column)
    words, places = word_hashes(raw, at, alnum=True)
    both = np.empty(2 * len(words), np.uint64)
    both[::2], both[1::2] = words, word_hashes(raw, at, alnum=True, most=STEM)[0]
    return both, 2 * places


def counted(column: pa.Array, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place in `words` and count, for each word of the vocabulary in each text."""
    hashes, at = hashed(column)
    if not len(words) or not len(hashes):
        return (np.zeros(0, np.int64),) * 3
    place = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    hit = words[place] == hashes
    doc = np.repeat(np.arange(len(column)), np.diff(at))[hit]
    key, count = np.unique(doc * len(words) + place[hit], return_counts=True)
    return key // len(words), key % len(words), count


def fit(doc: np.ndarray, word: np.ndarray, value: np.ndarray, grade: np.ndarray, words: int, grades: int, l2: float = 1e-3, steps: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of least loss by gradient steps (Adam). The gaps between thresholds are exponentials, so
    their order holds. Each class of toxic and not toxic has half of the weight."""
    share = np.where(grade > 0, 0.5 / max(1, (grade > 0).sum()), 0.5 / max(1, (grade == 0).sum()))
    w, first, gaps = np.zeros(words), 0.0, np.zeros(grades - 1)
    moment, square = np.zeros(words + grades), np.zeros(words + grades)
    for step in range(1, steps + 1):
        t = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        x = np.bincount(doc, value * w[word], minlength=len(grade))
        above = np.concatenate([np.ones((len(grade), 1)), sigmoid(x[:, None] - t), np.zeros((len(grade), 1))], axis=1)
        row = np.arange(len(grade))
        up, down = above[row, grade], above[row, grade + 1]
        p = np.maximum(up - down, 1e-12)
        slope = lambda a: a * (1 - a)
        by_x = -share * (slope(up) - slope(down)) / p
        by_t = np.zeros(grades)  # of the loss by each threshold
        np.add.at(by_t, grade[grade > 0] - 1, (share * slope(up) / p)[grade > 0])
        np.add.at(by_t, grade[grade < grades], (-share * slope(down) / p)[grade < grades])
        after = np.cumsum(by_t[::-1])[::-1]
        gradient = np.concatenate([np.bincount(word, by_x[doc] * value, minlength=words) + l2 * w, [after[0]], after[1:] * np.exp(gaps)])
        moment, square = 0.9 * moment + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        move = 0.05 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
        w, first, gaps = w - move[:words], first - move[words], gaps - move[words + 1 :]
    return w, first + np.concatenate([[0], np.cumsum(np.exp(gaps))])


def cross_fitted(doc: np.ndarray, word: np.ndarray, value: np.ndarray, toxic: np.ndarray, half: np.ndarray, words: int, grades: int) -> np.ndarray:
    """Grades of documents labelled 0 or 1: the toxic ones of each half are cut at the quantiles of what a model of the other
    half gives for them."""
    out = toxic.copy()
    for k in (0, 1):
        other, own = half != k, (half == k) & (toxic > 0)
        if not own.any() or len(set(toxic[other])) < 2:
            continue
        inside = other[doc]
        place = np.cumsum(other) - 1
        weights, _ = fit(place[doc[inside]], word[inside], value[inside], toxic[other], words, 1)
        score = np.bincount(doc, value * weights[word], minlength=len(toxic))
        out[own] = 1 + np.searchsorted(np.quantile(score[own], [g / grades for g in range(1, grades)]), score[own], side="left")
    return out


def train(docs: DataFrame, labels: DataFrame, training: Column, label: str = "toxic", grades: int = 3, sample: int = 8_000, words: int = 65_536, least_docs: int = 5, least_z: float = 3.0) -> Severity:
    chosen = labelled(docs, labels.filter(F.col(label) <= grades), label, sample, training)
    # However many rows have a doc_id, one is learned from. The sample is bounded, and read three times.
    chosen = saved(chosen.groupBy("doc_id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")), "sample")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SMALL_SLICE):
                hashes, at = hashed(column_of(part, "text"))
                sets = [distinct_sorted(hashes[a:b]) for a, b in zip(at, at[1:], strict=False)]
                label = np.repeat(column_of(part, "label").to_numpy(zero_copy_only=False) > 0, [len(s) for s in sets])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64)), pa.array(label.astype(np.int32))], ["word", "label"])

    sizes = {r[0]: r[1] for r in chosen.groupBy("label").count().collect()}
    clean, toxic = sizes.get(0, 0), sum(n for k, n in sizes.items() if k)
    if not clean or not toxic:
        return Severity(np.zeros(0, np.uint64), np.zeros(0), np.full(grades, 40.0))
    a, b = F.col("n_toxic") + 0.5, F.col("n_clean") + 0.5
    odds = F.log(a / (toxic + 0.5 - F.col("n_toxic") + 0.5)) - F.log(b / (clean + 0.5 - F.col("n_clean") + 0.5))
    best = (
        chosen.mapInArrow(distinct, "word long, label int")
        .groupBy("word")
        .agg(F.sum("label").alias("n_toxic"), F.sum(1 - F.col("label")).alias("n_clean"))
        .filter(F.col("n_toxic") + F.col("n_clean") >= least_docs)
        .withColumn("z", odds / F.sqrt(1 / a + 1 / b))
        .filter(F.abs("z") >= least_z)
        .orderBy(F.abs("z").desc(), "word")
        .limit(words)
        .select("word")
        .toPandas()
    )
    order = np.argsort(best["word"].to_numpy().view(np.uint64))
    vocabulary = best["word"].to_numpy().view(np.uint64)[order]

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SMALL_SLICE):
                doc, word, count = counted(column_of(part, "text"), vocabulary)
                edges = np.searchsorted(doc, np.arange(part.num_rows + 1))
                cut = lambda x: pa.array([x[i:j].astype("<i4").tobytes() for i, j in zip(edges, edges[1:], strict=False)], pa.binary())  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([column_of(part, "doc_id"), column_of(part, "label"), cut(word), cut(count)], ["doc_id", "label", "word", "count"])

    rows = chosen.mapInArrow(described, "doc_id long, label int, word binary, count binary").toPandas().sort_values(["doc_id", "label"])
    word = [np.frombuffer(x, "<i4") for x in rows["word"]]
    doc = np.repeat(np.arange(len(rows)), [len(x) for x in word])
    word, count = np.concatenate(word), np.frombuffer(b"".join(rows["count"]), "<i4")
    grade = rows["label"].to_numpy().astype(np.int64)
    if grade.max() == 1 and grades > 1:
        half = mix(rows["doc_id"].to_numpy().astype(np.int64).view(np.uint64)) & np.uint64(1)
        grade = cross_fitted(doc, word, np.log1p(count), grade, half.astype(np.int64), len(vocabulary), grades)
    weights, thresholds = fit(doc, word, np.log1p(count), grade, len(vocabulary), grades)
    return Severity(vocabulary, weights, thresholds)


def graded(docs: DataFrame, model: Severity, limit: float = 0.5) -> DataFrame:
    """doc_id, severity (the expected grade), p_mild, p_middle, p_severe (of at least that grade, for three grades) and
    toxic (1 if P(grade >= 1) >= limit)."""
    names = ["p_mild", "p_middle", "p_severe"] if len(model.thresholds) == 3 else [f"p_{k + 1}" for k in range(len(model.thresholds))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SMALL_SLICE):
                above = model.above(column_of(part, "text"))
                yield pa.RecordBatch.from_arrays([column_of(part, "doc_id"), pa.array(above.sum(axis=1)), *(pa.array(x) for x in above.T), pa.array((above[:, 0] >= limit).astype(np.int32))], ["doc_id", "severity", *names, "toxic"])

    return docs.select("doc_id", "text").mapInArrow(run, ", ".join(["doc_id long", "severity double", *(f"{x} double" for x in names), "toxic int"]))


def clean(docs: DataFrame, model: Severity, limit: float = 0.5) -> DataFrame:
    """The rows of docs, all columns as they are, that are not toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SMALL_SLICE):
                yield part.filter(pa.array(model.above(column_of(part, "text"))[:, 0] < limit))

    return docs.mapInArrow(run, docs.schema)
