"""Operator 7: approximate nearest neighbours by additive quantisation.

A vector, brought to length 1, is approximated by a sum of one codeword from each of `books` codebooks of full dimension.
Codebooks start as k-means of the residuals that the earlier books leave and are then solved together by least
squares, in turn with encoding. Encoding is a beam search: of the `beam` best partial sums, extended by every codeword of the next
book, the best stay. Stored are the codes and the length of the sum. A query's table of products with all codewords
scores all codes by look-ups; the `rerank` best are scored exactly, by cosine in double precision.

Codebooks are fitted on at most `sample` vectors, those of least hash; every vector is encoded and searched. Every block of
queries meets every run of blocks of codes in one group, which keeps each query's best of the whole run; so rerank rows
for each query and run are shuffled, and a run has up to `run` blocks.

Defined results: vectors that are null, zero or hold null or non-finite components take no part, nor do null ids; ties go to
the smaller id; equal rows are one row; rows that repeat an id with other vectors are rows of their own, as queries (whose
ranks then repeat) and as candidates, even of each other; a vector is searched among those of its own dimension, each
dimension with codebooks of its own; a query without other vectors gives no row; an empty table gives an empty result;
further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkstone.llm.common import column_of, parts_for, saved

RESULT = "query_id long, rank int, vec_id long, score double"


# ---------------------------------------------------------------- codebooks


class Codebooks:
    def __init__(self, words: np.ndarray, beam: int) -> None:
        """words: (books, codewords, dimension)."""
        self.words, self.beam = words.astype(np.float32), beam
        self.squares = (self.words**2).sum(axis=2)

    def encode(self, x: np.ndarray, books: int | None = None) -> np.ndarray:
        """Codes of each row by beam search."""
        n, books = len(x), books or len(self.words)
        codes, left = np.zeros((n, 1, 0), np.uint8), x[:, None, :].astype(np.float32)
        for m in range(books):
            cost = (left**2).sum(axis=2)[:, :, None] - 2 * left @ self.words[m].T + self.squares[m]
            width = min(self.beam, cost.shape[1] * cost.shape[2]) if m < books - 1 else 1
            flat = cost.reshape(n, -1)
            best = np.argpartition(flat, width - 1, axis=1)[:, :width] if width < flat.shape[1] else np.tile(np.arange(width), (n, 1))
            parent, word = best // len(self.words[m]), best % len(self.words[m])
            codes = np.concatenate([np.take_along_axis(codes, parent[:, :, None], axis=1), word[:, :, None].astype(np.uint8)], axis=2)
            left = np.take_along_axis(left, parent[:, :, None], axis=1) - self.words[m][word]
        return codes[:, 0]

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return sum(self.words[m][codes[:, m]] for m in range(codes.shape[1]))

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """(books, codewords, queries) products."""
        return self.words @ queries.astype(np.float32).T


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, steps: int = 8) -> np.ndarray:
    centres = x[rng.integers(0, len(x), k)].copy()
    for _ in range(steps):
        near = np.concatenate([np.argmin((centres**2).sum(axis=1) - 2 * part @ centres.T, axis=1) for part in np.array_split(x, max(1, len(x) // 4096))])
        counts = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, x[:, d], minlength=k) for d in range(x.shape[1])], axis=1)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], x[rng.integers(0, len(x), k)]).astype(np.float32)
    return centres


def train(x: np.ndarray, books: int, codewords: int, beam: int, rounds: int = 2, seed: int = 7) -> Codebooks:
    x, rng = x.astype(np.float32), np.random.default_rng(seed)
    words, left = [], x
    for _ in range(books):
        words.append(kmeans(left, codewords, rng))
        near = np.concatenate([np.argmin((words[-1] ** 2).sum(axis=1) - 2 * part @ words[-1].T, axis=1) for part in np.array_split(left, max(1, len(left) // 4096))])
        left = left - words[-1][near]
    own = Codebooks(np.stack(words), beam)
    for _ in range(rounds):
        codes = np.concatenate([own.encode(part) for part in np.array_split(x, max(1, len(x) // 512))])
        place = codes + np.arange(books) * codewords
        gram = np.zeros((books * codewords, books * codewords), np.float32)
        for a in range(books):
            for b in range(a, books):
                both = np.bincount(place[:, a].astype(np.int64) % codewords * codewords + place[:, b] % codewords, minlength=codewords * codewords).reshape(codewords, codewords)
                gram[a * codewords : (a + 1) * codewords, b * codewords : (b + 1) * codewords] = both
                gram[b * codewords : (b + 1) * codewords, a * codewords : (a + 1) * codewords] = both.T
        right = np.zeros((books * codewords, x.shape[1]), np.float32)
        for a in range(books):
            np.add.at(right, place[:, a], x)
        gram[np.arange(len(gram)), np.arange(len(gram))] += 0.1
        solved = np.linalg.solve(gram, right + 0.1 * own.words.reshape(-1, x.shape[1]))
        own = Codebooks(solved.reshape(own.words.shape), beam)
    return own


# ---------------------------------------------------------------- Spark


def matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1. They are brought near 1 by powers of two before, so neither squares nor sums leave the range of
    doubles, and nothing is rounded."""
    x = x.astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]) for x in (a, b))
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def taking_part(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """vec_id, mark (a hash of the vector, to tell rows of one id apart) and v (array<double>) of the rows that take part, once each."""
    good = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    good = good.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    return good.distinct().select("vec_id", F.xxhash64("v").alias("mark"), "v")


class Best:
    """The `most` best candidates of one query so far, in falling order of score, then by id."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.score, self.ids, self.marks = np.zeros(0, np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def meet(self, score: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> None:
        least = self.score[-1] if len(self.score) == self.most else -np.inf
        if len(score) > self.most:
            least = max(least, np.partition(score, len(score) - self.most)[len(score) - self.most])
        new = np.flatnonzero((score >= least) & (score > -np.inf))
        if not len(new):
            return
        score, ids, marks = np.concatenate([self.score, score[new]]), np.concatenate([self.ids, ids[new]]), np.concatenate([self.marks, marks[new]])
        order = np.lexsort((marks, ids, -score))[: self.most]
        self.score, self.ids, self.marks = score[order], ids[order], marks[order]


def search(vectors: DataFrame, queries: Column, key: str = "vec_id", column: str = "embedding", k: int = 5, rerank: int = 512, books: int = 16, codewords: int = 256, beam: int = 8, sample: int = 16_384, block: int = 4_096, query_block: int = 4_096, run: int = 64) -> DataFrame:
    """The k nearest of each row for which `queries` (a condition on vec_id) holds, among all other rows: query_id, rank,
    vec_id, score."""
    spark = vectors.sparkSession
    good = saved(taking_part(vectors, key, column), "vectors")
    asked = F.coalesce(queries.cast("boolean"), F.lit(False))
    out = spark.createDataFrame([], RESULT)
    # A row for each dimension that there is.
    for r in good.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"), F.sum(asked.cast("long")).alias("n_queries")).orderBy("size").collect():
        if r["n"] > 1 and r["n_queries"]:
            own = good.filter(F.size("v") == r["size"])
            out = out.unionByName(_nearest(own, own.filter(asked), r["n"], r["n_queries"], k, rerank, books, codewords, beam, sample, block, query_block, run))
    return out


def _nearest(good: DataFrame, asked: DataFrame, n: int, n_queries: int, k: int, rerank: int, books: int, codewords: int, beam: int, sample: int, block: int, query_block: int, run: int) -> DataFrame:
    """search() among vectors of one dimension: n of them, of which n_queries are asked for."""
    spark = good.sparkSession

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in unit(matrix(column_of(batch, "v"))).astype("<f4")], pa.binary())], ["x"])

    chosen = good.orderBy(F.xxhash64("vec_id"), "vec_id", "mark").limit(sample).mapInArrow(units, "x binary").collect()
    x = np.frombuffer(b"".join(r["x"] for r in chosen), "<f4").reshape(len(chosen), -1)
    own = train(x, books, min(codewords, len(x)), beam)
    books_shared = spark.sparkContext.broadcast((own.words, beam))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Codebooks(*books_shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                x = unit(matrix(column_of(part, "v")))
                codes = np.concatenate([model.encode(p) for p in np.array_split(x, -(-len(x) // 256))])
                lengths = np.linalg.norm(model.decode(codes), axis=1).astype("<f4")
                ids, marks = (column_of(part, c).to_numpy().astype("<i8") for c in ("vec_id", "mark"))
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (ids, marks, codes, lengths)], ["ids", "marks", "codes", "more"])

    def gathered(table: pa.Table) -> pa.Table:
        x = unit(matrix(table.column("v"))).astype("<f4")
        ids, marks = (table.column(c).to_numpy().astype("<i8") for c in ("vec_id", "mark"))
        return pa.table({"b": table.column("b")[:1], **{name: pa.array([y.tobytes()], pa.binary()) for name, y in (("ids", ids), ("marks", marks), ("codes", np.zeros(0, np.uint8)), ("more", x))}})

    parts = parts_for(spark, n, 4 * block)
    codes = saved(good.repartition(parts, "vec_id", "mark").mapInArrow(encoded, "ids binary, marks binary, codes binary, more binary"), "codes")
    runs = max(1, -(-codes.count() // run))
    groups = parts_for(spark, float(n) * n_queries, float(run * block) * query_block)
    blocks = max(-(-n_queries // query_block), min(n_queries, -(-groups // runs)))
    spread = lambda c, m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))).alias(c)
    every = codes.select(F.pmod(F.xxhash64("ids"), F.lit(runs)).alias("c"), spread("b", blocks), F.lit(1).alias("kind"), "ids", "marks", "codes", "more")
    questions = asked.withColumn("b", F.pmod(F.xxhash64("vec_id", "mark"), F.lit(blocks))).groupBy("b").applyInArrow(gathered, "b long, ids binary, marks binary, codes binary, more binary")
    every = every.unionByName(questions.select(spread("c", runs), "b", F.lit(0).alias("kind"), "ids", "marks", "codes", "more"))
    # A group's queries come before its codes.
    grouped = every.repartition(max(groups, blocks * runs), "b", "c").sortWithinPartitions("b", "c", "kind")

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Codebooks(*books_shared.value)
        group, best = None, []

        def found() -> Iterator[pa.RecordBatch]:
            for q, m, got in best:
                columns = (np.full(len(got.ids), q), np.full(len(got.ids), m), got.ids, got.marks, got.score.astype(np.float64))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["query_id", "query_mark", "vec_id", "mark", "approximate"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                ids, marks = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["marks"], "<i8")
                if not row["kind"]:
                    yield from found()
                    group, best = (row["b"], row["c"]), [(q, m, Best(rerank)) for q, m in zip(ids.tolist(), marks.tolist(), strict=True)]
                    of, of_marks, x = ids, marks, np.frombuffer(row["more"], "<f4").reshape(len(ids), -1)
                    continue
                if group != (row["b"], row["c"]):
                    continue  # no queries in this block
                own, lengths = np.frombuffer(row["codes"], np.uint8).reshape(len(ids), -1), np.frombuffer(row["more"], "<f4")
                for at in range(0, len(of), 128):
                    tables = model.tables(x[at : at + 128])
                    score = np.zeros((len(ids), tables.shape[2]), np.float32)
                    for m in range(own.shape[1]):
                        score += tables[m][own[:, m]]
                    score /= np.maximum(lengths, 1e-12)[:, None]
                    score[(ids[:, None] == of[None, at : at + 128]) & (marks[:, None] == of_marks[None, at : at + 128])] = -np.inf
                    for j, s in enumerate(np.ascontiguousarray(score.T)):
                        best[at + j][2].meet(s, ids, marks)
        yield from found()

    near = grouped.mapInArrow(looked_up, "query_id long, query_mark long, vec_id long, mark long, approximate double")
    order = Window.partitionBy("query_id", "query_mark").orderBy(F.desc("approximate"), "vec_id", "mark")
    best = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= rerank).drop("place", "approximate")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = cosine(matrix(column_of(batch, "q")), matrix(column_of(batch, "v")))
                yield pa.RecordBatch.from_arrays([*(column_of(batch, c) for c in ("query_id", "query_mark", "vec_id", "mark")), pa.array(score)], ["query_id", "query_mark", "vec_id", "mark", "score"])

    own = asked.select(F.col("vec_id").alias("query_id"), F.col("mark").alias("query_mark"), F.col("v").alias("q"))
    scored = best.join(good, ["vec_id", "mark"]).join(own, ["query_id", "query_mark"]).select("query_id", "query_mark", "vec_id", "mark", "q", "v").mapInArrow(exact, "query_id long, query_mark long, vec_id long, mark long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_mark").orderBy(F.desc("score"), "vec_id", "mark"))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
