"""Operator 3: packing documents into training sequences by best-fit decreasing.

A document's ids (with the end id) are cut into full windows and a remainder. Full windows are sequences of their own.
Remainders go, longest first, each into the open window with the tightest sufficient room; a segment tree over
remaining capacities finds it. Remainders are dealt by a number of their own row into groups of about `group_rows`, so equal
rows spread as others do; each group is packed by itself, so a task holds a bounded number of them and at most about one
window a group stays mostly empty.

Defined results: null and empty texts are the end id alone; a null doc_id stays null; repeated rows are each packed;
an empty table gives an empty result; further columns of the input are ignored. Ties in length go by doc_id, then
start, with nulls first.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstone.llm.common import column_of, parts_for, saved, slices

CACHED = 120_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, sequence_id long, offset long"


def _ranges(kind: str) -> str:
    """A character class of the code points below U+0180 of a general category."""
    return "".join(f"\\u{i:04x}" for i in range(0x180) if unicodedata.category(chr(i))[0] == kind)


class WordBPE(dict):
    """Ids (packed little-endian unsigned 32 bits) by piece of text, for a tokenizer that lower-cases, drops white space
    and merges within runs of letters, single numbers and runs of other characters. Texts below U+0180, on which case and
    normal form act on single characters (but for U+0130), are cut into these runs here, go to the tokenizer's merges alone, and frequent runs are remembered; all other
    texts are left whole to the tokenizer."""

    def __init__(self, path: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.whole = not is_word_bpe(self.tokenizer)  # another kind of tokenizer takes whole texts
        space, letter, number = r"\t-\r \x85\xa0", _ranges("L"), _ranges("N")
        self.runs = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{space}{letter}{number}]+")
        self.simple = re.compile(r"[\x00-įı-ſ]*")
        # The merges see bytes as characters: printing ones of Latin-1 as themselves, the others in order from U+0100 on.
        printing = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self.shown = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in printing)}

    def __missing__(self, run: str) -> bytes:
        merged = self.tokenizer.model.tokenize(run.encode().decode("latin-1").translate(self.shown))
        got = np.array([t.id for t in merged], "<u4").tobytes()
        if len(self) < CACHED and len(run) < 64:
            self[run] = got
        return got

    def encode(self, text: str) -> bytes:
        if self.whole or "<|" in text or not self.simple.fullmatch(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, self.runs.findall(text.lower())))


# The sections of a tokenizer's file, as it has them, on which the shorter way relies.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def is_word_bpe(tokenizer) -> bool:
    """Whether a tokenizer's parts are those for which texts may be cut into runs here. Added tokens have to begin with
    "<|": texts with that are left whole."""
    part = lambda x: None if x is None else json.loads(x.__getstate__())  # noqa: E731  its section, without the vocabulary
    added = all(t.content.startswith("<|") for t in tokenizer.get_added_tokens_decoder().values())
    plain = tokenizer.truncation is None and tokenizer.padding is None and type(tokenizer.model).__name__ == "BPE"
    return added and plain and part(tokenizer.normalizer) == NORMALIZER and part(tokenizer.pre_tokenizer) == PRE_TOKENIZER


_tokenizers: dict[str, WordBPE] = {}


def pieces(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Full windows and remainders of each document. tokenizer: the path of its file on every executor."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _tokenizers.setdefault(tokenizer, WordBPE(tokenizer))
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in slices(batch):
                rows = []
                for doc, text in zip(column_of(part, "doc_id").to_pylist(), column_of(part, "text").to_pylist(), strict=True):
                    ids = own.encode(text or "") + end
                    for at in range(0, len(ids), 4 * length):
                        got = ids[at : at + 4 * length]
                        rows.append((doc, at // 4, len(got) // 4, zlib.crc32(got), len(ids) // 4, got if with_ids else None))
                kinds = [pa.int64()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


class Capacities:
    """How many open windows there are of each remaining capacity, and the least capacity of at least some length."""

    def __init__(self, most: int) -> None:
        self.size = 1 << most.bit_length()
        self.open = [0] * (2 * self.size)

    def add(self, capacity: int, n: int) -> None:
        at = self.size + capacity
        while at:
            self.open[at] += n
            at >>= 1

    def tightest(self, length: int) -> int:
        """-1: no open window has room."""
        at = self.size + length
        if self.open[at]:
            return length
        while at > 1:
            if not at & 1 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at + (not self.open[2 * at])
                return at - self.size
            at >>= 1
        return -1


def best_fit_decreasing(lengths: list[int], most: int) -> list[tuple[int, int]]:
    """For each length, given in falling order: its window and its offset there."""
    room, windows, out, n = Capacities(most), {}, [], 0
    for length in lengths:
        capacity = room.tightest(length)
        if capacity < 0:
            window, capacity, n = n, most, n + 1
        else:
            window = windows[capacity].pop()
            room.add(capacity, -1)
        out.append((window, most - capacity))
        if left := capacity - length:
            windows.setdefault(left, []).append(window)
            room.add(left, 1)
    return out


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, with_ids: bool = False, group_rows: int = 4096) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, ids (null unless asked for), sequence_id and
    offset. Every sequence is gapless from 0 and has at most `length` ids."""
    cut = saved(pieces(docs, tokenizer, length, end_id, with_ids), "pieces")
    spark = docs.sparkSession
    groups = max(1, -(-cut.count() // group_rows))
    dealt = cut.withColumn("bin", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        placed = best_fit_decreasing(table.column("length").to_pylist(), length)
        first = table.column("bin")[0].as_py() << 40
        table = table.drop_columns(["bin"])
        return table.append_column("sequence_id", pa.array([first + w for w, _ in placed], pa.int64())).append_column("offset", pa.array([o for _, o in placed], pa.int64()))

    return dealt.repartition(parts_for(spark, groups, 64), "bin").groupBy("bin").applyInArrow(packed, PACKED)
