"""Operator 5: language-model scores by an interpolated modified Kneser-Ney bigram model.

Tokens are the words of the lower-cased text, then one end. Bigrams (the first follows a begin mark) are counted in
Spark: tasks send sorted, compressed blocks by range of the bigram's hash, and each range merges its own. There is a range
for each 32 MB of text; a task deals into DEALT ranges at most at once, and where there are more, into wider ones first and
then each of these again. The model is a folder of the shared file system with, for each range, one file of sorted hash
arrays: bigrams (hash, count) and words (hash, count, continuation count, and as a context the total and how many words
follow once, twice and more often). Counts have 64 bits wherever one of a file's needs more than 32. Workers map the files to
memory, MAPPED at most at a time, and look up a slice's distinct bigrams and words in order.

    p(w | v) = max(c(vw) - D(c(vw)), 0) / c(v.) + (D1 N1(v.) + D2 N2(v.) + D3 N3+(v.)) / c(v.) * p(w)
    p(w)     = max(a(w) - D'(a(w)), 0) / A + (D1' n1 + D2' n2 + D3' n3+) / A / (V + 1)

a(w): words that w follows; A: their sum; V: distinct tokens; the three discounts of each level come from counts of
counts. An unknown word has the uniform share alone, and after an unknown context p(w) holds.

Bigrams are the highest order because trigrams of this corpus need about 2.5 times the disk (see the README).

Defined results: null and empty texts are the end alone; a null doc_id is not learned from where the condition is null,
is scored and stays null; repeated rows each count and get a row; an empty table gives an empty result; without
training tokens every token has probability 1; further columns of the input are ignored.
"""

from __future__ import annotations

import os
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstone.llm.common import SHINGLE, column_of, local_path, mix, pack_sorted, parts_for, saved, shared_dir, slices, text_bytes, unpack_sorted, word_hashes, write_file

BEGIN, END = np.uint64(0x0B5E55ED0B5E55ED), np.uint64(0x0E0D0E0D0E0D0E0D)
FLUSH = 2_000_000
DEALT, MAPPED = 1_024, 16_384
COUNTS = ("count", "left", "total", "once", "twice", "more")  # of a word: own, continuations, and as a context


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens and of those before them, and each text's offsets."""
    words, at = word_hashes(*text_bytes(column))
    texts = len(at) - 1
    out_at = at + np.arange(texts + 1)
    tokens = np.empty(out_at[-1], np.uint64)
    ends = out_at[1:] - 1
    tokens[ends] = END
    inner = np.ones(len(tokens), bool)
    inner[ends] = False
    tokens[inner] = words
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[out_at[:-1]] = BEGIN
    return tokens, before, out_at


def bigram_keys(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mix(before * SHINGLE[7] + tokens * SHINGLE[8] + SHINGLE[9])


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def starts_of(sorted_keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(sorted_keys) else np.zeros(0, np.int64)


def item_of(numbers: np.ndarray) -> int:
    """Bytes for each of these whole numbers."""
    return 8 if len(numbers) and numbers.max() >> 32 else 4


def planes(*columns: np.ndarray) -> bytes:
    """Whole numbers, compressed a byte of each at a time."""
    table = np.concatenate([np.asarray(c, np.int64) for c in columns])
    item = item_of(table)
    return item.to_bytes(1, "little") + len(table).to_bytes(8, "little") + pa.compress(table.astype(f"<u{item}").view(np.uint8).reshape(-1, item).T.tobytes(), "zstd", asbytes=True)


def columns_of(block: bytes, columns: int) -> np.ndarray:
    item, n = block[0], int.from_bytes(block[1:9], "little")
    raw = np.frombuffer(pa.decompress(block[9:], item * n, "zstd", asbytes=True), np.uint8).reshape(item, n)
    return np.ascontiguousarray(raw.T).view(f"<u{item}").astype(np.int64).reshape(columns, -1)


def pair_block(before: np.ndarray, tokens: np.ndarray, counts: np.ndarray) -> tuple[int, bytes, bytes]:
    """Pairs with counts: their distinct words once, then places among these, sorted."""
    words, place = np.unique(np.concatenate([before, tokens]), return_inverse=True)
    a, b = place[: len(before)], place[len(before) :]
    order = np.argsort(a * len(words) + b)
    return len(words), pack_sorted(words), planes(np.diff(a[order], prepend=0), b[order], counts[order])


def pairs_in(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What pair_block() put into each row: first words, second words and counts."""
    for n, words, pairs in zip(*(table.column(table.schema.get_field_index(c)).to_pylist() for c in ("n", "words", "pairs")), strict=True):
        own, (a, b, c) = unpack_sorted(words, n, np.uint64), columns_of(pairs, 3)
        yield own[np.cumsum(a)], own[b], c


def merged_pairs(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys in order, and each one's words and whole count."""
    before, tokens, counts = (np.concatenate(x) for x in zip(*held, strict=True))
    keys = bigram_keys(before, tokens)
    order = np.argsort(keys)
    keys = keys[order]
    first = starts_of(keys)
    return keys[first], before[order[first]], tokens[order[first]], np.add.reduceat(counts[order], first)


def dealt(parts: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], ranges: int) -> Iterator[pa.RecordBatch]:
    """Pairs with counts as blocks by range, equal pairs of about FLUSH summed."""

    def flush() -> pa.RecordBatch:
        keys, before, tokens, counts = merged_pairs(held)
        own = range_of(keys, ranges)
        edges = np.append(starts_of(own), len(own))
        rows = [(int(own[a]), *pair_block(before[a:b], tokens[a:b], counts[a:b])) for a, b in zip(edges, edges[1:], strict=False)]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], BLOCKS)

    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[1])
        if n >= FLUSH:
            yield flush()
            held, n = [], 0
    if n:
        yield flush()


BLOCKS = ["range", "n", "words", "pairs"]


class Maps(OrderedDict):
    """The files of a model that were used last, mapped to memory: keys and columns."""

    def of(self, path: str, columns: int) -> tuple[np.ndarray, list[np.ndarray]]:
        if path in self:
            self.move_to_end(path)
            return self[path]
        raw = np.memmap(path, np.uint8, "r") if os.path.exists(path) else np.zeros(16, np.uint8)
        n, item = (int(x) for x in raw[:16].view(np.uint64))
        keys, rest = raw[16 : 16 + 8 * n].view(np.uint64), raw[16 + 8 * n :]
        self[path] = keys, [rest[c * item * n : (c + 1) * item * n].view(f"<u{item or 4}") for c in range(columns)]
        if len(self) > MAPPED:
            self.popitem(last=False)
        return self[path]


def write_columns(path: str, keys: np.ndarray, columns: np.ndarray) -> None:
    item = item_of(columns)
    write_file(path, np.array([len(keys), item], np.uint64), keys, np.ascontiguousarray(columns, f"<u{item}"))


@dataclass
class Level:
    """Discounts, and what all words share."""

    discounts: np.ndarray

    @staticmethod
    def of(counts_of_counts: list[int]) -> Level:
        n = [float(x) for x in counts_of_counts]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        d = [0.0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] and n[k] else 0.5 * k, 0.1 * k), 0.9 * k) for k in (1, 2, 3)]
        return Level(np.array(d))

    def of_counts(self, counts: np.ndarray) -> np.ndarray:
        return self.discounts[np.minimum(counts, 3).astype(np.int64)]


@dataclass
class Model:
    folder: str
    ranges: dict[str, int]  # of bigrams and of words
    tokens: int  # N
    distinct: int  # V
    pairs: int  # A
    bigrams: Level
    words: Level
    spare: float  # the share of p(w) that is uniform
    files: Maps = field(default_factory=Maps, compare=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "files": Maps()}

    def found(self, kind: str, keys: np.ndarray, columns: int) -> np.ndarray:
        """(columns, keys) numbers of sorted keys; 0 where there is none."""
        out = np.zeros((columns, len(keys)), np.int64)
        own = range_of(keys, self.ranges[kind])
        edges = np.append(starts_of(own), len(own))
        for a, b in zip(edges, edges[1:], strict=False):
            known, numbers = self.files.of(f"{self.folder}/{kind}-{own[a]}", columns)
            if len(known):
                place = np.minimum(np.searchsorted(known, keys[a:b]), len(known) - 1)
                hit = known[place] == keys[a:b]
                for c in range(columns):
                    out[c, a:b] = np.where(hit, numbers[c][place], 0)
        return out

    def score(self, column: pa.Array) -> list[np.ndarray]:
        """For each text: tokens, known tokens, the base's and this model's log10 probability."""
        tokens, before, at = tokens_of(column)
        words, place = np.unique(np.concatenate([tokens, before]), return_inverse=True)
        count, left, total, once, twice, more = self.found("words", words, len(COUNTS))
        low = np.full(len(words), self.spare / (self.distinct + 1))
        if self.pairs:
            low += np.maximum(left - self.words.of_counts(left), 0) / self.pairs
        d = self.bigrams.discounts
        back = np.where(total > 0, (d[1] * once + d[2] * twice + d[3] * more) / np.maximum(total, 1), 1.0)
        w, v = place[: len(tokens)], place[len(tokens) :]
        keys, which = np.unique(bigram_keys(before, tokens), return_inverse=True)
        pairs = self.found("bigrams", keys, 1)[0][which]
        p = np.maximum(pairs - self.bigrams.of_counts(pairs), 0) / np.maximum(total[v], 1) + back[v] * low[w]
        base = np.log10((count[w] + 1) / (self.tokens + self.distinct + 1))
        sums = lambda x: np.add.reduceat(x, at[:-1]) if len(at) > 1 else np.zeros(0)  # noqa: E731  no text is without a token
        return [np.diff(at), sums((count[w] > 0).astype(np.int64)), sums(base), sums(np.log10(p) if self.tokens else np.zeros(len(p)))]


def train(docs: DataFrame, text: str = "text") -> Model:
    """Counts all bigrams of all rows of docs into a model of the shared folder."""
    spark = docs.sparkSession
    folder = shared_dir(spark)
    path = local_path(folder)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    ranges = parts_for(spark, size, 32 << 20)
    wide = min(ranges, DEALT)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tokens() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for batch in batches:
                for part in slices(batch, text):
                    own, before, _ = tokens_of(column_of(part, text))
                    yield before, own, np.ones(len(own), np.int64)

        yield from dealt(tokens(), wide)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from dealt((pairs for batch in batches for i in range(batch.num_rows) for pairs in pairs_in(batch.slice(i, 1))), ranges)

    def bigrams(table: pa.Table) -> pa.Table:
        """Writes a range's bigrams; gives its words' counts in blocks by range of word, and counts of counts as range -1."""
        keys, before, tokens, counts = merged_pairs(list(pairs_in(table)))
        write_columns(f"{path}/bigrams-{table.column('range')[0].as_py()}", keys, counts)
        words, place = np.unique(np.concatenate([tokens, before]), return_inverse=True)
        w, v = place[: len(tokens)], place[len(tokens) :]
        sums = lambda where, x=None: np.bincount(where, x, minlength=len(words)).astype(np.int64)
        stats = np.stack([sums(w, counts), sums(w), sums(v, counts), sums(v, counts == 1), sums(v, counts == 2), sums(v, counts > 2)])
        own = range_of(words, wide)
        edges = np.append(starts_of(own), len(own))
        rows = [(int(own[a]), b - a, pack_sorted(words[a:b]), planes(*stats[:, a:b])) for a, b in zip(edges, edges[1:], strict=False)]
        rows.append((-1, 0, b"", planes(np.bincount(np.minimum(counts, 5), minlength=6)[1:5])))
        return pa.table([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["range", "n", "words", "stats"])

    def merged(table: pa.Table) -> pa.Table:
        """Writes a range's words; gives N, V, A and the counts of continuation counts."""
        words = np.concatenate([unpack_sorted(b, n, np.uint64) for b, n in zip(table.column("words").to_pylist(), table.column("n").to_pylist(), strict=True)])
        stats = np.concatenate([columns_of(b, len(COUNTS)) for b in table.column("stats").to_pylist()], axis=1)
        order = np.argsort(words)
        first = starts_of(words[order])
        stats = np.add.reduceat(stats[:, order], first, axis=1)
        write_columns(f"{path}/words-{table.column('range')[0].as_py()}", words[order[first]], stats)
        left = np.bincount(np.minimum(stats[1], 5), minlength=6)
        return pa.table({"sums": pa.array([[int(stats[0].sum()), int((stats[0] > 0).sum()), int(stats[1].sum()), *(int(x) for x in left[1:5]), int((stats[1] > 2).sum())]])})

    kind = "range int, n int, words binary, pairs binary"
    counted = docs.select(text).mapInArrow(blocks, kind)
    if wide < ranges:
        counted = counted.repartition(wide, "range").mapInArrow(again, kind)
    found = counted.repartition(ranges, "range").groupBy("range").applyInArrow(bigrams, "range int, n int, words binary, stats binary")
    found = saved(found, "stats")
    of_pairs = sum((columns_of(r[0], 4).ravel() for r in found.filter("range < 0").select("stats").toLocalIterator()), np.zeros(4, np.int64))
    words = found.filter("range >= 0").repartition(wide, "range").groupBy("range").applyInArrow(merged, "sums array<long>")
    sums = words.select(*(F.col("sums")[i].alias(f"s{i}") for i in range(8))).agg(*(F.sum(f"s{i}") for i in range(8))).first()
    n, v, pairs, n1, n2, n3, n4, n_more = (int(x or 0) for x in sums)
    low = Level.of([n1, n2, n3, n4])
    spare = (low.discounts[1] * n1 + low.discounts[2] * n2 + low.discounts[3] * n_more) / pairs if pairs else 1.0
    return Model(path, {"bigrams": ranges, "words": wide}, n, v, pairs, Level.of([int(x) for x in of_pairs]), low, float(spare))


_models: dict[str, Model] = {}


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10) of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _models.setdefault(model.folder, model)  # a worker maps each file once
        for batch in batches:
            for part in slices(batch):
                n, known, base, score = own.score(column_of(part, "text"))
                yield pa.RecordBatch.from_arrays([column_of(part, "doc_id"), pa.array(n), pa.array(known), pa.array(np.full(len(n), model.tokens)), pa.array(base), pa.array(score)], ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def perplexity(docs: DataFrame, training: Column) -> DataFrame:
    """Scores all docs by a model of those for which `training` holds; perplexity is of a text's tokens."""
    return scored(docs, train(docs.filter(training))).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
