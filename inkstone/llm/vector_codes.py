"""Operator 13: product codes of vectors by Lloyd's method with heaps, in whole numbers.

Components become floor(scale * x). A vector is cut into consecutive parts; each part position has a codebook, which starts
as that part of the vectors of least vec_id and is made anew in each round from the parts assigned to each entry
(componentwise floor of their mean; unused entries stay). Distances are squared, exact, ties go to the lower index.

Vectors are kept in blocks, and each block has, for each part position and entry, a heap of the block's parts assigned to it.
A part's key is its slack: a lower bound of the distance to any other entry less an upper bound of that to its own, plus what
its entry's bounds had drifted by then, drift being how far the entry has moved in all rounds and the most any other has.
A round pops the parts whose key the drift has passed, compares these with every entry, and pushes them anew; all others keep
their entry unseen. Keys are lowered by a bound on their rounding, so equal distances are always looked at again. Tasks add
up what parts that moved take away and bring; blocks with their heaps are written to the shared folder after each
round, so a lost executor costs its blocks' last round.

Rows whose vector is null or holds null or non-finite components take no part. Defined results: vectors of different
dimensions have codebooks of their own; dimensions that parts don't divide give the first parts one component more; with
fewer vectors than entries there are so many entries; of equal vec_ids the lesser vector comes first, null ids last; repeated
rows count and come as often as they are there; scaled components beyond 2^53 count as 2^53 with their sign; errors beyond
38 digits are null; an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstone.llm.common import column_of, discarded, saved
from inkstone.llm.whitening import matrix, whole_numbers

BROADCAST_ROWS = 1_000_000
STATE = "x binary, kind string, codes binary, keys binary, heaps binary, part int, entry int, n long, sums array<decimal(38,0)>"


def cuts_of(d: int, parts: int) -> list[int]:
    """The parts' borders."""
    return [k * (d // parts) + min(k, d % parts) for k in range(parts + 1)]


@dataclass
class Codebooks:
    """words: entries x dimension, of int64. drift: parts x entries, what heaps' keys have to exceed. most: the largest absolute
    component of any vector."""

    words: np.ndarray
    parts: int
    most: int
    drift: np.ndarray = field(default=None)

    def __post_init__(self) -> None:
        self.cuts = cuts_of(self.words.shape[1], self.parts)
        if self.drift is None:
            self.drift = np.zeros((self.parts, len(self.words)))
        self.width = max(1, max(np.diff(self.cuts)))

    def part(self, p: int) -> np.ndarray:
        return self.words[:, self.cuts[p] : self.cuts[p + 1]]

    def squares(self, x: np.ndarray, p: int) -> np.ndarray:
        """Exact squared distances of parts x to all entries: as doubles while these hold every sum, else as Python's integers."""
        c = self.part(p)
        if 4 * self.width * self.most**2 < 1 << 53:
            x, c = x.astype(np.float64), c.astype(np.float64)
            return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
        return np.stack([((x.astype(object) - e.astype(object)) ** 2).sum(axis=1) for e in c], axis=1) if x.shape[1] else np.zeros((len(x), len(c)))

    def nearest(self, x: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
        """Each part's entry, and its slack towards the second nearest, lowered by what rounding may add."""
        codes, slack = np.zeros(len(x), np.uint16), np.zeros(len(x))
        for at in range(0, len(x), 1024):
            d = self.squares(x[at : at + 1024], p)
            own = d.argmin(axis=1)
            rows = np.arange(len(d))
            first = d[rows, own]
            if d.shape[1] == 1:
                slack[at : at + 1024] = np.inf
            else:
                d = d.copy()
                d[rows, own] = d.max() + 1
                low, up = np.sqrt(d.min(axis=1).astype(np.float64)), np.sqrt(first.astype(np.float64))
                slack[at : at + 1024] = low - up - 1e-12 * (low + up)
            codes[at : at + 1024] = own
        return codes, slack

    def errors(self, x: np.ndarray, codes: np.ndarray) -> list[int]:
        """Each vector's squared distance to what its codes stand for."""
        own = np.concatenate([self.part(p)[codes[p]] for p in range(self.parts)], axis=1)
        if 4 * x.shape[1] * self.most**2 < 1 << 62:
            return ((x - own) ** 2).sum(axis=1).tolist()
        return [sum((int(a) - int(b)) ** 2 for a, b in zip(r, s, strict=True)) for r, s in zip(x, own, strict=True)]

    def moved(self, words: np.ndarray) -> Codebooks:
        """The next round's: with what a part of each entry may have lost of its slack."""
        drift = self.drift.copy()
        for p in range(self.parts):
            step = (words - self.words)[:, self.cuts[p] : self.cuts[p + 1]].astype(np.float64)
            far = np.sqrt((step * step).sum(axis=1)) * (1 + 1e-12)
            for e in range(len(words)):
                drift[p, e] += far[e] + max(np.delete(far, e), default=0.0)
        return Codebooks(words, self.parts, self.most, drift * (1 + 1e-12))

    def digest(self) -> str:
        """The sha256 of all components by part, entry and place."""
        return hashlib.sha256(",".join(str(v) for p in range(self.parts) for v in self.part(p).ravel().tolist()).encode()).hexdigest()


# ---------------------------------------------------------------- blocks and their heaps


def packed(x: np.ndarray) -> tuple[bytes, str]:
    """The components in the least integers that hold them."""
    kind = next(k for k in ("<i2", "<i4", "<i8") if not x.size or max(abs(int(x.min())), abs(int(x.max()))) < 1 << (8 * int(k[2]) - 1))
    return x.astype(kind).tobytes(), kind


class Heaps:
    """A block's parts at one position: entry and key of each, and for each entry a heap of parts by key."""

    def __init__(self, codes: np.ndarray, keys: np.ndarray, heaps: list[list[tuple[float, int]]]) -> None:
        self.codes, self.keys, self.heaps = codes, keys, heaps

    @classmethod
    def of(cls, codes: np.ndarray, keys: np.ndarray, entries: int) -> Heaps:
        out = cls(codes, keys, [[] for _ in range(entries)])
        for row, (e, key) in enumerate(zip(codes.tolist(), keys.tolist(), strict=True)):
            out.heaps[e].append((key, row))
        for h in out.heaps:
            heapq.heapify(h)
        return out

    @classmethod
    def read(cls, codes: np.ndarray, keys: np.ndarray, order: np.ndarray, entries: int) -> Heaps:
        """order: the rows by entry, each entry's as its heap had them."""
        ends = np.cumsum(np.bincount(codes, minlength=entries))
        pairs = list(zip(keys[order].tolist(), order.tolist(), strict=True))
        return cls(codes, keys, [pairs[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)])

    def order(self) -> np.ndarray:
        return np.array([row for h in self.heaps for _, row in h], np.int32)

    def violated(self, drift: np.ndarray) -> list[int]:
        """Pops the rows whose key the drift of their entry has passed."""
        out = []
        for h, passed in zip(self.heaps, drift.tolist(), strict=True):
            while h and h[0][0] <= passed:
                out.append(heapq.heappop(h)[1])
        return sorted(out)

    def push(self, row: int, code: int, key: float) -> None:
        self.codes[row], self.keys[row] = code, key
        heapq.heappush(self.heaps[code], (key, row))


class Changes:
    """What a task's moved parts add to and take from entries."""

    def __init__(self, books: Codebooks) -> None:
        self.books = books
        self.n = np.zeros((books.parts, len(books.words)), np.int64)
        self.sums = [np.zeros((len(books.words), b - a), object if books.most >= 1 << 36 else np.int64) for a, b in zip(books.cuts, books.cuts[1:], strict=False)]

    def add(self, p: int, codes: np.ndarray, x: np.ndarray, sign: int) -> None:
        np.add.at(self.n[p], codes, sign)
        np.add.at(self.sums[p], codes, sign * (x.astype(object) if self.sums[p].dtype == object else x))

    def rows(self) -> list[tuple[int, int, int, list[Decimal]]]:
        return [(p, e, int(self.n[p, e]), [Decimal(int(v)) for v in self.sums[p][e]]) for p in range(len(self.sums)) for e in range(len(self.n[p])) if self.n[p, e] or self.sums[p][e].any()]


def first_blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (vec_id, label, x) gathered in blocks, wherever they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                x, kind = packed(matrix(column_of(part, "x")))
                one = lambda c: pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), column_of(part, c))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([one("vec_id"), one("label"), pa.array([x], pa.binary()), pa.array([kind])], ["vec_id", "label", "x", "kind"])

    return rows.select("vec_id", "label", "x").mapInArrow(run, f"vec_id array<long>, label array<{rows.schema['label'].dataType.simpleString()}>, x binary, kind string")


def assigned(blocks: DataFrame, books: Codebooks, label: str) -> DataFrame:
    """Blocks with every part at its nearest entry, and rows of what changed: part, entry, n, sums. Blocks without heaps are
    compared with every entry, others where the drift asks for it."""
    shared = blocks.sparkSession.sparkContext.broadcast(books)
    begun = "heaps" in blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        entries, d = own.words.shape
        changes = Changes(own)
        schema = None
        for batch in batches:
            schema = pa.schema([batch.schema.field("vec_id"), batch.schema.field("label"), *FIELDS])
            for k in range(batch.num_rows):
                get = lambda c: column_of(batch, c)[k].as_py()  # noqa: B023, E731
                ids = column_of(batch, "vec_id").slice(k, 1)
                rows = len(ids[0])
                x = np.frombuffer(get("x"), get("kind")).reshape(rows, d).astype(np.int64)
                heaps = []
                for p in range(own.parts):
                    mine = x[:, own.cuts[p] : own.cuts[p + 1]]
                    if not begun:
                        codes, slack = own.nearest(mine, p)
                        changes.add(p, codes, mine, 1)
                        heaps.append(Heaps.of(codes, slack + own.drift[p][codes], entries))
                        continue
                    state = [np.frombuffer(get(c), kind).reshape(own.parts, rows)[p] for c, kind in (("codes", "<u2"), ("keys", "<f8"), ("heaps", "<i4"))]
                    heap = Heaps.read(state[0].copy(), state[1].copy(), state[2], entries)
                    seen = np.array(heap.violated(own.drift[p]), np.int64)
                    before = heap.codes[seen]
                    codes, slack = own.nearest(mine[seen], p)
                    for row, code, key in zip(seen.tolist(), codes.tolist(), (slack + own.drift[p][codes]).tolist(), strict=True):
                        heap.push(row, code, key)
                    other = codes != before
                    changes.add(p, before[other], mine[seen[other]], -1)
                    changes.add(p, codes[other], mine[seen[other]], 1)
                    heaps.append(heap)
                state = [np.stack([f(h) for h in heaps]).astype(kind).tobytes() for f, kind in ((lambda h: h.codes, "<u2"), (lambda h: h.keys, "<f8"), (Heaps.order, "<i4"))]
                values = [get("x"), get("kind"), *state, None, None, None, None]
                yield pa.RecordBatch.from_arrays([ids, column_of(batch, "label").slice(k, 1), *(pa.array([v], f.type) for v, f in zip(values, FIELDS, strict=True))], schema=schema)
        found = changes.rows()
        if schema is not None and found:
            none = [pa.nulls(len(found), f.type) for f in list(schema)[:7]]
            yield pa.RecordBatch.from_arrays([*none, *(pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), FIELDS[5:], strict=True))], schema=schema)

    columns = ["vec_id", "label", "x", "kind", *(["codes", "keys", "heaps"] if begun else [])]
    return blocks.select(*columns).mapInArrow(run, f"vec_id array<long>, label array<{label}>, {STATE}")


FIELDS = [
    pa.field("x", pa.binary()), pa.field("kind", pa.string()), pa.field("codes", pa.binary()), pa.field("keys", pa.binary()), pa.field("heaps", pa.binary()),
    pa.field("part", pa.int32()), pa.field("entry", pa.int32()), pa.field("n", pa.int64()), pa.field("sums", pa.list_(pa.decimal128(38, 0))),
]


def changed(state: DataFrame, width: int) -> list:
    """What all tasks' parts add to each entry: at most parts * entries rows."""
    return state.filter("part IS NOT NULL").groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.coalesce(F.get("sums", F.lit(k)), F.lit(0))).alias(f"s{k}") for k in range(width))).collect()


def smallest(rows: DataFrame, entries: int) -> np.ndarray:
    """x of the rows of least (vec_id, x), in this order. Ids alone are ordered first; their greatest then is a filter of
    the scan."""
    last = rows.select("vec_id").filter("vec_id IS NOT NULL").orderBy("vec_id").limit(entries).agg(F.count("*").alias("n"), F.max("vec_id").alias("last")).first()
    near = rows.filter(F.col("vec_id") <= last["last"]) if last["n"] == entries else rows
    return np.array([r["x"] for r in near.select("vec_id", "x").orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).collect()], np.int64)


def exact(values: list[int]) -> pa.Array:
    kind = pa.decimal128(38, 0)
    if max(values, default=0) < 1 << 62:
        return pa.array(values, pa.int64()).cast(kind)
    return pa.array([Decimal(v) if v < 10**38 else None for v in values], kind)


def coded(state: DataFrame, books: Codebooks, label: str) -> DataFrame:
    """vec_id, label, codes and error of each vector of the blocks."""
    shared = state.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                get = lambda c: column_of(batch, c)[k]  # noqa: B023, E731
                ids, labels = get("vec_id").values, get("label").values
                x = np.frombuffer(get("x").as_py(), get("kind").as_py()).reshape(len(ids), -1).astype(np.int64)
                codes = np.frombuffer(get("codes").as_py(), "<u2").reshape(own.parts, len(ids))
                at = pa.array(np.arange(0, codes.size + 1, own.parts, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([ids, labels, pa.ListArray.from_arrays(at, pa.array(codes.T.ravel().astype(np.int32))), exact(own.errors(x, codes))], ["vec_id", "label", "codes", "error"])

    return state.select("vec_id", "label", "x", "kind", "codes").mapInArrow(run, f"vec_id long, label {label}, codes array<int>, error decimal(38,0)")


def lloyd(rows: DataFrame, most: int, parts: int, entries: int, rounds: int, block: int) -> tuple[DataFrame, Codebooks]:
    """Blocks of rows (vec_id, label, x) of one dimension with their final codes, and the final codebooks."""
    label = rows.schema["label"].dataType.simpleString()
    books = Codebooks(smallest(rows, entries), parts, most)
    n = np.zeros((parts, len(books.words)), object)
    sums = [np.zeros((len(books.words), b - a), object) for a, b in zip(books.cuts, books.cuts[1:], strict=False)]
    state = saved(assigned(first_blocks(rows, block), books, label), "blocks")
    for _ in range(rounds):
        for r in changed(state, books.width):
            p, e = r["part"], r["entry"]
            n[p, e] += r["n"]
            for k in range(sums[p].shape[1]):
                sums[p][e, k] += int(r[f"s{k}"])
        words = books.words.copy()
        for p in range(parts):
            for e in np.flatnonzero(n[p] > 0).tolist():
                words[e, books.cuts[p] : books.cuts[p + 1]] = sums[p][e] // n[p, e]
        if (words == books.words).all():
            break  # nothing moves from here on
        books, last = books.moved(words), state
        state = saved(assigned(last.filter("x IS NOT NULL"), books, label), "blocks")
        discarded(last)
    return state.filter("x IS NOT NULL"), books


def product_codes(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", label: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, block: int = 4_096) -> DataFrame:
    """vec_id, label, codes (an entry's index for each part), error (the squared distance to what they stand for), label_error (the
    errors of all rows of the label, null being one) and codebooks_sha256 of each row that takes part."""
    if entries > 1 << 16:
        raise ValueError("codes have 16 bits")
    spark = vectors.sparkSession
    rows = whole_numbers(vectors, key, column, scale, 0, F.col(label).alias("label"))
    kind = rows.schema["label"].dataType.simpleString()
    done = spark.createDataFrame([], f"vec_id long, label {kind}, codes array<int>, error decimal(38,0), codebooks_sha256 string")
    largest = F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x")))
    for r in rows.groupBy(F.size("x").alias("d")).agg(F.max(largest).alias("most")).orderBy("d").collect():  # a row a dimension
        state, books = lloyd(rows.filter(F.size("x") == r["d"]), r["most"] or 0, parts, entries, rounds, block)
        done = done.unionByName(coded(state, books, kind).withColumn("codebooks_sha256", F.lit(books.digest())))
    done = saved(done, "coded")
    by_label = saved(done.groupBy(F.col("label").alias("of")).agg(F.sum("error").cast("decimal(38,0)").alias("label_error")), "labels")
    few = F.broadcast(by_label) if by_label.count() <= BROADCAST_ROWS else by_label
    return done.join(few, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "label", "codes", "error", "label_error", "codebooks_sha256")
