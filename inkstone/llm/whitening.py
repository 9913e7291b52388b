"""Operator 11: whitening of embeddings by their principal components.

Entries become whole numbers x = floor(scale * c) + offset, as long, so that sums are exact. With n rows and sums S, a
centred row is (n*x - S) / n: the difference is taken in whole numbers, so a large common offset costs no precision. The
covariance is RowMatrix.computeGramianMatrix over the centred rows, divided by n; its eigenvectors come from numpy's eigh on
the driver (a matrix of the dimension's square) and go to the tasks as a broadcast. identity_error is measured: the
whitened rows' covariance, centred before multiplying, less the identity.

Rows whose vector is null or holds null or non-finite entries take no part. Defined results: vectors of different
dimensions are fitted and whitened each with their own kind, n and all else being theirs; repeated rows count and come as
often as they are there; a null vec_id stays null; empty vectors have no component; components whose eigenvalue isn't
above dimension * 2^-52 of the largest have no direction that can be told from rounding: their whitened is null, and
identity_error is over the others (null without any); explained is null where nothing varies; scaled entries beyond 2^53
count as 2^53 with their sign; a deviation beyond 38 digits is null; an empty table gives an empty result; further columns
of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstone.llm.common import column_of, saved

SPLIT = 26  # sums are kept in two halves, of higher and of lower bits
RESULT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whole_numbers(vectors: DataFrame, key: str, column: str, scale: int, offset: int, *more: Column) -> DataFrame:
    """vec_id, x (array<long>) and further columns of the rows that take part."""
    v = F.col(column)
    good = v.isNotNull() & ~F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    most = float(1 << 53)
    whole = lambda c: F.floor(F.least(F.greatest(c.cast("double") * scale, F.lit(-most)), F.lit(most))) + offset
    return vectors.filter(good).select(F.col(key).cast("long").alias("vec_id"), F.transform(v, whole).alias("x"), *more)


def matrix(lists: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def sums(rows: DataFrame) -> dict[int, tuple[int, list[int], int]]:
    """For each dimension: the number of its rows, their sums, and the largest absolute entry. A task gives a row a
    dimension, which Spark adds up."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            x = column_of(batch, "x")
            lengths = x.value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(lengths).tolist():
                own = matrix(x.filter(pa.array(lengths == d))) if d else np.zeros((int((lengths == 0).sum()), 0), np.int64)
                n, high, low, most = held.get(d, (0, 0, 0, 0))
                held[d] = (n + len(own), high + (own >> SPLIT).sum(axis=0), low + (own & ((1 << SPLIT) - 1)).sum(axis=0), max(most, int(np.abs(own).max(initial=0))))
        rows = [(d, n, high.tolist(), low.tolist(), most) for d, (n, high, low, most) in held.items()]
        names = ("d", "n", "high", "low", "most")
        kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    parts = rows.select("x").mapInArrow(partial, "d int, n long, high array<long>, low array<long>, most long")
    big = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    by_place = parts.select("d", "n", "most", F.posexplode_outer(F.arrays_zip("high", "low"))).groupBy("d", "pos").agg(F.sum("n").alias("n"), F.max("most").alias("most"), big("col.high").alias("high"), big("col.low").alias("low"))
    out: dict[int, tuple[int, list[int], int]] = {}
    for r in by_place.orderBy("d", "pos").collect():  # a row for each place of a vector
        n, own, most = out.setdefault(r["d"], (r["n"], [], r["most"]))
        if r["pos"] is not None:
            own.append((int(r["high"]) << SPLIT) + int(r["low"]))
    return out


@dataclass
class Whitening:
    """What one dimension's rows were fitted to."""

    n: int
    sums: list[int]
    most: int
    trace: float
    values: np.ndarray  # the eigenvalues of the components, falling
    components: np.ndarray  # one a row

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, exact: as int64 where these hold it, else as Python's integers."""
        if self.n * max(self.most, max(map(abs, self.sums), default=0) // self.n + 1) < 1 << 62:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)

    def squared(self, x: np.ndarray) -> list[int]:
        """Of each row the sum of squares of n*x - S."""
        d = self.deviations(x)
        if d.dtype != object and d.size and int(np.abs(d).max()) ** 2 * d.shape[1] < 1 << 62:
            return (d * d).sum(axis=1).tolist()
        return [sum(int(v) ** 2 for v in row) for row in d]

    def able(self) -> np.ndarray:
        """Which components have a direction."""
        return self.values > len(self.sums) * 2.0**-52 * max(self.values[:1], default=0.0)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        scale = np.sqrt(np.where(self.able(), self.values, np.nan))
        return (self.centred(x) @ self.components.T) / scale


def gramian(rows: DataFrame, own: Whitening) -> np.ndarray:
    """The centred rows' products, summed."""
    shared = rows.sparkSession.sparkContext.broadcast(own)

    def centred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = shared.value.centred(matrix(column_of(batch, "x")))
            at = pa.array(np.arange(0, c.size + 1, c.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(at, pa.array(c.ravel()))], ["c"])

    vectors = rows.select("x").mapInArrow(centred, "c array<double>").select(array_to_vector("c").alias("c"))
    return RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "c")).computeGramianMatrix().toArray()


def fit(rows: DataFrame, d: int, n: int, sum_of: list[int], most: int, k: int) -> Whitening:
    """rows: x of dimension d, all of which are fitted."""
    own = Whitening(n, sum_of, most, 0.0, np.zeros(0), np.zeros((0, d)))
    covariance = gramian(rows, own) / n
    values, vectors = np.linalg.eigh(covariance)
    own.trace = float(np.trace(covariance))
    own.values, own.components = values[::-1][:k].copy(), vectors.T[::-1][:k].copy()
    return own


def whitened_rows(rows: DataFrame, own: Whitening) -> DataFrame:
    """vec_id, deviation and whitened (an array, null where a component has no direction) of each row."""
    import pandas as pd

    shared = rows.sparkSession.sparkContext.broadcast(own)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                x = np.stack(frame["x"].to_numpy())
                able = shared.value.able()
                z = [[v if a else None for v, a in zip(row, able, strict=True)] for row in shared.value.whiten(x).tolist()] if not able.all() else list(shared.value.whiten(x))
                deviation = [Decimal(v) if v < 10**38 else None for v in shared.value.squared(x)]
                yield pd.DataFrame({"vec_id": frame["vec_id"], "deviation": pd.Series(deviation, frame.index, object), "whitened": pd.Series(z, frame.index, object)})

    return rows.mapInPandas(run, "vec_id long, deviation decimal(38,0), whitened array<double>")


def identity_error(rows: DataFrame, own: Whitening) -> float | None:
    """The largest absolute entry of the covariance of whitened, less the identity."""
    able = np.flatnonzero(own.able()).tolist()
    if not able:
        return None
    z = [F.col("whitened")[k] for k in able]
    off = lambda i, j: F.abs(F.covar_pop(z[i], z[j]) - F.lit(float(i == j)))
    worst: Column = F.greatest(F.lit(0.0), *(off(i, j) for i in range(len(z)) for j in range(i + 1)))
    return rows.agg(worst.alias("e")).first()["e"]


def whitened(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = 8, scale: int = 1024, offset: int = 100_000) -> DataFrame:
    """For each row that takes part and each of the first components: vec_id, component, n, deviation, whitened, explained,
    identity_error."""
    spark = vectors.sparkSession
    rows = whole_numbers(vectors, key, column, scale, offset)
    out = spark.createDataFrame([], RESULT)
    for d, (n, sum_of, most) in sums(rows).items():
        if not d:
            continue
        mine = rows.filter(F.size("x") == d)
        own = fit(mine, d, n, sum_of, most, min(components, d))
        done = saved(whitened_rows(mine, own), "whitened")
        number = lambda v: F.lit(None if v is None else float(v)).cast("double")
        explained = F.array(*(number(e / own.trace if own.trace > 0 else None) for e in own.values))
        got = done.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        out = out.unionByName(
            got.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained[F.col("at")].alias("explained"), number(identity_error(done, own)).alias("identity_error"))
        )
    return out
