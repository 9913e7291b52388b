"""Operator 2: a quality classifier by Bradley-Terry pairwise ranking.

Of a pair of labelled documents the one with label 1 is preferred; the probability is the logistic function of the
difference of their scores, which are linear in 26 features of the whole text. The weights minimise the logistic loss of
sampled pairs' feature differences (Newton steps, L2). The threshold is the quantile of the labelled documents' scores at the share of
label 0; a logistic function with that point at 0.3 brings scores to 0..1.

Fitted on at most `sample` labelled documents of each class, those of least hash, and `pairs` pairs; the share of label 0 and the
scoring cover all rows. A labelled doc_id of several rows counts once, by the least of their features.

Defined results: null and empty texts are scored from features of zero; a null doc_id is scored and stays null; repeated
rows each get a row; an empty table gives an empty result; without labels of both classes every score is 0.3;
further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstone.llm.common import SMALL_SLICE, column_of, distinct_sorted, shingle_hashes, slices, text_bytes, word_hashes, word_spans

# Kinds of bytes: 0 other, 1 a-z, 2 A-Z, 3 digits, 4 beyond ASCII, 5 space, 6 line end, 7 .,;: and so on, 8 !?, 9 brackets, 10 other marks.
KIND = np.zeros(256, np.int64)
KIND[97:123], KIND[65:91], KIND[48:58], KIND[128:] = 1, 2, 3, 4
for kind, chars in ((5, b" \t"), (6, b"\n\r"), (7, b".,;:'\"-"), (8, b"!?"), (9, b"()[]{}<>/"), (10, b"#$%&*+=@\\^_`|~")):
    KIND[list(chars)] = kind
KINDS, FEATURES = 11, 26


def features(column: pa.Array) -> np.ndarray:
    """One row of FEATURES numbers for each text."""
    raw, at = text_bytes(column)
    n = len(at) - 1
    sizes = np.diff(at)
    of = np.repeat(np.arange(n), sizes)
    kinds = np.bincount(of * KINDS + KIND[raw], minlength=n * KINDS).reshape(n, KINDS) if n else np.zeros((0, KINDS))
    starts, ends, words = word_spans(raw, at)
    counts = np.diff(words)
    many = np.maximum(counts, 1)
    doc = np.repeat(np.arange(n), counts)
    per = lambda x: np.bincount(doc, x, minlength=n) / many  # noqa: E731  the mean over a text's words
    first, last = KIND[raw[starts]], KIND[raw[ends - 1]]
    lengths = ends - starts
    hashes, _ = word_hashes(raw, at)
    same = np.zeros(len(hashes))
    if len(hashes):
        same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    upper = np.concatenate([[0], np.cumsum(KIND[raw] == 2)])
    shouted = (upper[ends] - upper[starts]) * 2 > lengths
    shingles, sat = shingle_hashes(hashes, words, 5)
    distinct = np.array([len(distinct_sorted(hashes[a:b])) for a, b in zip(words, words[1:], strict=False)]) if n else np.zeros(0)
    runs = np.array([len(distinct_sorted(shingles[a:b])) for a, b in zip(sat, sat[1:], strict=False)]) if n else np.zeros(0)
    mean = per(lengths)
    out = [kinds[:, k] / np.maximum(sizes, 1) for k in range(KINDS)]
    out += [np.log1p(counts), np.log1p(sizes), mean, np.sqrt(np.maximum(per(lengths**2.0) - mean**2, 0)), per(lengths > 20), per(lengths <= 2)]
    out += [per(first == 2), per(shouted), per(last == 8), per(last == 10), per(last == 7), per(same), distinct / many, distinct / np.sqrt(many), runs / np.maximum(np.diff(sat), 1)]
    return np.stack(out, axis=1)


@dataclass(frozen=True)
class Ranking:
    """score = the logistic function of slope * (features . weights - threshold) + logit(0.3)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = ((x - self.mean) / self.scale) @ self.weights
        return 1 / (1 + np.exp(-np.clip(self.slope * (raw - self.threshold) + np.log(0.3 / 0.7), -40, 40)))


def newton(x: np.ndarray, y: np.ndarray, l2: float, steps: int = 25) -> np.ndarray:
    """Weights of least logistic loss."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(x) + l2 * np.eye(len(w)), x.T @ (p - y) / len(x) + l2 * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(x: np.ndarray, y: np.ndarray, share: float, pairs: int, seed: int = 1) -> Ranking:
    """share: of label 0 among all labels, at which quantile the threshold lies."""
    better, worse = x[y == 1], x[y == 0]
    if not len(better) or not len(worse):
        return Ranking(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0, 0.0)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    x = (x - mean) / scale
    rng = np.random.default_rng(seed)
    a, b = x[y == 1][rng.integers(0, len(better), pairs)], x[y == 0][rng.integers(0, len(worse), pairs)]
    weights = newton(a - b, np.ones(pairs), 1e-3)
    raw = x @ weights
    heavy = np.where(y == 1, (1 - share) / len(better), share / len(worse))  # the sample has the classes in other shares
    order = np.argsort(raw, kind="stable")
    threshold = float(raw[order][min(np.searchsorted(np.cumsum(heavy[order]), share), len(raw) - 1)])
    slope = newton(np.stack([raw - threshold, np.ones(len(raw))], axis=1), y.astype(float), 1e-4)[0]
    return Ranking(mean, scale, weights, threshold, max(float(slope), 1e-3))


def labelled(docs: DataFrame, labels: DataFrame, label: str, sample: int, training: Column) -> DataFrame:
    """doc_id, label and text of at most `sample` labelled documents of each of the classes 0 and 1 or more, those of least
    hash. The sample of labels has a fixed bound, and so can be broadcast. Documents that share a doc_id are all here."""
    known = labels.filter(training & (F.col(label) >= 0)).select("doc_id", F.col(label).cast("int").alias("label")).distinct()
    least = [known.filter(own).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample) for own in ("label = 0", "label > 0")]
    return docs.select("doc_id", "text").join(F.broadcast(least[0].unionByName(least[1])), "doc_id")


def train(docs: DataFrame, labels: DataFrame, training: Column, label: str = "quality", sample: int = 8_000, pairs: int = 100_000) -> Ranking:
    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SMALL_SLICE):
                x = features(column_of(part, "text")).astype("<f8")
                yield pa.RecordBatch.from_arrays([column_of(part, "doc_id"), column_of(part, "label"), pa.array([v.tobytes() for v in x], pa.binary())], ["doc_id", "label", "x"])

    chosen = labelled(docs, labels.filter(F.col(label).isin(0, 1)), label, sample, training).select("doc_id", "label", "text")
    # However many rows have a doc_id, the driver gets one.
    rows = chosen.mapInArrow(described, "doc_id long, label int, x binary").groupBy("doc_id", "label").agg(F.min("x").alias("x")).toPandas().sort_values(["doc_id", "label"])
    counts = {r[0]: r[1] for r in labels.filter(training & F.col(label).isin(0, 1)).groupBy(label).count().collect()}
    x = np.frombuffer(b"".join(rows["x"]), "<f8").reshape(-1, FEATURES)
    return fit(x, rows["label"].to_numpy(), counts.get(0, 0) / max(1, sum(counts.values())), pairs)


def scored(docs: DataFrame, model: Ranking) -> DataFrame:
    """doc_id and score (0 to 1) of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SMALL_SLICE):
                yield pa.RecordBatch.from_arrays([column_of(part, "doc_id"), pa.array(model.score(features(column_of(part, "text"))))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def kept(docs: DataFrame, model: Ranking, least: float = 0.3) -> DataFrame:
    """The rows of docs, all columns as they are, whose score is at least `least`."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SMALL_SLICE):
                yield part.filter(pa.array(model.score(features(column_of(part, "text"))) >= least))

    return docs.mapInArrow(run, schema)
