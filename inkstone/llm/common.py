"""What the operators share: tables in the shared folder, bounded Arrow slices, and the hashes of words and shingles.

Words are runs of bytes that are not ASCII white space (0x20, 0x09-0x0D), after lower-casing A-Z, of a text's UTF-8.
A null text counts as empty everywhere.
"""

from __future__ import annotations

import importlib.util
import math
import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

MASK = (1 << 64) - 1
SLICE_BYTES = 4 << 20
SMALL_SLICE = 1 << 20  # where several numbers are made of each byte


# ---------------------------------------------------------------- tables and folders


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which the driver and all executors see, deleted when the driver ends. Where
    the setting is unset, a local session (as in tests) gets a temporary folder of this machine, and a cluster an error."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        top = f"file://{tempfile.mkdtemp(prefix='inkstone-')}"
        spark.conf.set("spark.checkpoint.dir", top)
    folder = f"{top.rstrip('/')}/inkstone-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """df, written as a table of the shared folder and read again: cuts lineage, and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discarded(df: DataFrame) -> None:
    """Deletes the files of a saved table that nothing reads any more."""
    spark = df.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def local_path(uri: str) -> str:
    """The path of a file:// URI or plain path. The shared folder has to be mounted for memory-mapped files."""
    got = urlparse(uri)
    if got.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped files need a mounted shared folder, not {uri}")
    return got.path


def write_file(path: str, *arrays: np.ndarray) -> None:
    """Arrays after one another, written under a name of its own and then renamed, so that a repeated task is harmless."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as f:
        for a in arrays:
            f.write(np.ascontiguousarray(a).data)
    os.replace(own, path)


def parts_for(spark: SparkSession, amount: float, per_part: float) -> int:
    """Partitions for an amount: those of the session at least, and as many as keep each near per_part."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(amount / per_part), 1)


TOKENIZERS = os.environ.get("INKSTONE_TOKENIZERS", "/opt/tokenizers")


def tokenizer_path(name: str, folder: str = TOKENIZERS) -> str:
    """Where a public tokenizer's file is, by the folder's own module; the folder is the same on every executor."""
    spec = importlib.util.spec_from_file_location("public_tokenizers", f"{folder}/__init__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module.path(name)


# ---------------------------------------------------------------- Arrow batches


def slices(batch: pa.RecordBatch, text: str = "text", most: int = SLICE_BYTES, *others: str) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts (of one column, and of others) have about `most` bytes, a longer text coming
    alone, so memory is bounded."""
    if not batch.num_rows:
        return
    sizes = sum(pc.fill_null(pc.binary_length(batch.column(t)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for t in (text, *others))
    group = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and their len+1 offsets in them; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if column.offset or not len(column):
        column = pa.concat_arrays([column, pa.array([], pa.large_string())]) if len(column) else pa.array([""], pa.large_string()).slice(0, 0)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def fold(column: str, folds: int):
    """The remainder of crc32(the column as text); null for null."""
    from pyspark.sql import functions as F

    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


# ---------------------------------------------------------------- hashes


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit coefficients that depend on the seed and their place alone."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


SHINGLE = stream(64, 3)
KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def lowered(raw: np.ndarray) -> np.ndarray:
    return raw + ((raw - np.uint8(65)) < 26).view(np.uint8) * np.uint8(32)


ALNUM = np.array([chr(i).isalnum() or i >= 128 for i in range(256)])


def word_spans(raw: np.ndarray, at: np.ndarray, alnum: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First bytes and ends of the words of the texts raw[at[i]:at[i+1]], and the len(at) offsets of each text's words.
    alnum: words are runs of ASCII letters, digits and all bytes beyond ASCII instead."""
    solid = ALNUM[raw] if alnum else (raw != 32) & ((raw - np.uint8(9)) >= 5)
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    edge = at[(at > 0) & (at < len(raw))]  # a word ends with its text
    first[edge] = solid[edge]
    last[edge - 1] = solid[edge - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, at)


def word_hashes(raw: np.ndarray, at: np.ndarray, alnum: bool = False, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word of the texts raw[at[i]:at[i+1]], and the len(at) offsets of each text's words in them.
    most: of each word's first bytes alone."""
    starts, ends, words = word_spans(raw, at, alnum)
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = lowered(raw)
    eights = np.ndarray(len(raw) + 1, np.dtype("<u8"), padded, strides=(1,))  # eight bytes from each place on
    left = ends - starts if most is None else np.minimum(ends - starts, most)
    out = mix(left.astype(np.uint64) + np.uint64(0 if most is None else 1 << 32))
    which, place = None, starts
    while len(place):  # eight more bytes of those words that have any left
        part = eights[place] & KEEP[np.minimum(left, 8)]
        if which is None:
            out = mix((out ^ part) + SHINGLE[63])
            which = np.flatnonzero(left > 8)
            place, left = place[which] + 8, left[which] - 8
        else:
            out[which] = mix((out[which] ^ part) + SHINGLE[63])
            more = left > 8
            which, place, left = which[more], place[more] + 8, left[more] - 8
    return out, words


def distinct_sorted(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def shingle_hashes(words: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each run of `width` words within a text, in order, and each text's offsets; a text of fewer words
    (but one at least) has its whole sequence as one shingle."""
    n, texts = len(words), len(at) - 1
    counts = np.diff(at)
    own = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    out_at = np.concatenate([[0], np.cumsum(own)])
    if not n:
        return np.zeros(0, np.uint64), out_at
    rolled = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width):
        rolled += words[k : n - width + 1 + k] * SHINGLE[k] if len(rolled) else np.uint64(0)
    rolled = mix(rolled + np.uint64(width))
    which = np.repeat(np.arange(texts), own)
    place = np.arange(out_at[-1]) - out_at[which] + at[which]
    out = np.zeros(out_at[-1], np.uint64)
    full = counts[which] >= width
    out[full] = rolled[place[full]]
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        few = words[at[i] : at[i + 1]]
        out[out_at[i]] = mix((few * SHINGLE[: len(few)]).sum(dtype=np.uint64)[None] + np.uint64(len(few)))[0]
    return out, out_at


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; empty for a text without words."""
    got, at = shingle_hashes(*word_hashes(*text_bytes(column)), width)
    return [distinct_sorted(got[a:b]) for a, b in zip(at, at[1:], strict=False)]


# ---------------------------------------------------------------- sorted hashes as compact blocks


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted unsigned integers as compressed differences, a byte of each at a time."""
    gaps = np.diff(keys, prepend=keys.dtype.type(0))
    return pa.compress(gaps.view(np.uint8).reshape(len(keys), keys.itemsize).T.tobytes(), "zstd", asbytes=True) if len(keys) else b""


def unpack_sorted(block: bytes, n: int, dtype: type) -> np.ndarray:
    if not n:
        return np.zeros(0, dtype)
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(block, n * size, "zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(dtype).ravel(), dtype=dtype)
