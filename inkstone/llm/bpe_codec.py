"""Operator 12: byte-pair encoding and decoding with forced boundaries.

A token can only span two neighbouring bytes of a word if some token of the vocabulary has that pair inside. Where none has,
the cut between the two is certain: a word is split there, and its fragments are encoded by themselves and put after one
another. Pairs whose second byte ends a word are told apart, since only tokens that end words have them. Within a fragment
the merge of the least rank goes first, the leftmost of equal ones; a long fragment finds it with a heap.

What turns a text into words is the tokenizer's own: added tokens are cut out first, then its normaliser and splitter run. For
texts of characters below U+0180 and the expected sections, one regular expression gives the same words. Frequent words are
remembered. Decoding joins the tokens of ids as the tokenizer's file says: without a decoder by spaces, with a byte-level one
as bytes, wrong UTF-8 becoming U+FFFD; ids that no token has are left out.

Files that this cannot encode raise: other models than BPE, with dropout, an unknown token, prefixes of continued words,
merges that are ignored, words that aren't bytes, bytes that lack a token, added tokens that strip or normalise what is around them, and a template
behind the encoding is not applied. Truncation and padding are not used.

Defined results: null and empty texts have no ids and decode to an empty text; a null doc_id stays null; repeated rows each
get a row; an empty table gives an empty result; null ids decode to null, null entries of them are left out; further columns
of the input are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from inkstone.llm.common import SMALL_SLICE, column_of, slices
from inkstone.llm.packing import WordBPE

CACHED = 200_000
SHORT = 24  # symbols up to which a fragment's best merge is looked for one by one


class ForcedBPE:
    """Encoder and decoder of a tokenizer's file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec.get("added_tokens") or []
        if model.get("type", "BPE") != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")):
            raise ValueError("only byte-pair models without dropout, unknown tokens and prefixes are encoded")
        if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens that take in what is around them are not encoded")
        if '"ByteLevel"' not in json.dumps(spec.get("pre_tokenizer")):
            raise ValueError("only words of bytes are encoded")
        decoder = spec.get("decoder")
        if decoder and decoder.get("type") != "ByteLevel":
            raise ValueError(f"no such decoder: {decoder.get('type')}")
        self.as_bytes = bool(decoder)
        self.words = WordBPE(path)
        shown = {b: chr(b) for b in range(256)} | {b: chr(c) for b, c in self.words.shown.items()}
        self.shown = {c: b for b, c in shown.items()}
        self.raw = str.maketrans({c: chr(b) for c, b in self.shown.items()})
        end = model.get("end_of_word_suffix") or ""
        vocabulary: dict[str, int] = model["vocab"]
        if any(shown[b] + e not in vocabulary for b in range(256) for e in ("", end)):
            raise ValueError("a byte has no token")
        self.one, self.last = ([vocabulary[shown[b] + e] for b in range(256)] for e in ("", end))
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[vocabulary[a], vocabulary[b]] = (rank, vocabulary[a + b])
        self.inside, self.ending = self._pairs_within(vocabulary, end)
        self.text: dict[int, str] = {i: t for t, i in vocabulary.items()} | {t["id"]: t["content"] for t in added}
        self.special = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in added}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if added else None
        self.known: dict[bytes, bytes] = {}

    def _pairs_within(self, vocabulary: Iterable[str], end: str) -> tuple[list[bytearray], list[bytearray]]:
        """For bytes a and b, whether a token has b right after a: with b not ending a word, and with b ending one."""
        inside, ending = [bytearray(256) for _ in range(256)], [bytearray(256) for _ in range(256)]
        for token in vocabulary:
            final = bool(end) and token.endswith(end)
            raw = [self.shown[c] for c in (token[: -len(end)] if final else token) if c in self.shown]
            for k in range(1, len(raw)):
                (ending if final and k == len(raw) - 1 else inside)[raw[k - 1]][raw[k]] = 1
        return inside, ending if end else inside

    def fragments(self, word: bytes) -> list[tuple[bytes, bool]]:
        """The word between its certain cuts, and whether each fragment ends the word."""
        cuts = [k for k in range(1, len(word) - 1) if not self.inside[word[k - 1]][word[k]]]
        if len(word) > 1 and not self.ending[word[-2]][word[-1]]:
            cuts.append(len(word) - 1)
        return [(word[a:b], b == len(word)) for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)]

    def merged(self, fragment: bytes, final: bool) -> list[int]:
        ids = [self.one[b] for b in fragment]
        if final:
            ids[-1] = self.last[fragment[-1]]
        if len(ids) > SHORT:
            return self._merged_long(ids)
        pairs = self.pairs
        while len(ids) > 1:
            found = [(got, k) for k in range(len(ids) - 1) if (got := pairs.get((ids[k], ids[k + 1])))]
            if not found:
                break
            (_, new), k = min(found)
            ids[k : k + 2] = [new]
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        pairs, n = self.pairs, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(got[0], k, ids[k], ids[k + 1], got[1]) for k in range(n - 1) if (got := pairs.get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            _, k, a, b, new = heapq.heappop(heap)
            nxt = after[k]
            if ids[k] != a or nxt >= n or ids[nxt] != b:
                continue
            ids[k], ids[nxt] = new, -1
            after[k] = after[nxt]
            if after[k] < n:
                before[after[k]] = k
            for left, right in ((before[k], k), (k, after[k])):
                if left >= 0 and right < n and (got := pairs.get((ids[left], ids[right]))):
                    heapq.heappush(heap, (got[0], left, ids[left], ids[right], got[1]))
        return [i for i in ids if i >= 0]

    def word(self, word: bytes) -> bytes:
        """Packed ids (little-endian unsigned 32 bits) of a word."""
        if (got := self.known.get(word)) is None:
            got = np.array([i for fragment in self.fragments(word) for i in self.merged(*fragment)], "<u4").tobytes()
            if len(self.known) < CACHED and len(word) < 64:
                self.known[word] = got
        return got

    def split(self, text: str) -> Iterator[bytes]:
        """The words of a text without added tokens."""
        own = self.words
        if not own.whole and own.simple.fullmatch(text):
            return map(str.encode, own.runs.findall(text.lower()))
        tokenizer = own.tokenizer
        text = tokenizer.normalizer.normalize_str(text) if tokenizer.normalizer else text
        return (w.translate(self.raw).encode("latin-1") for w, _ in tokenizer.pre_tokenizer.pre_tokenize_str(text))

    def encode(self, text: str) -> np.ndarray:
        if self.cut and any(t in text for t in self.special):
            parts = (self.special[p] if k % 2 else b"".join(map(self.word, self.split(p))) for k, p in enumerate(self.cut.split(text)))
            return np.frombuffer(b"".join(parts), "<u4")
        return np.frombuffer(b"".join(map(self.word, self.split(text))), "<u4")

    def decode(self, ids: Iterable[int | None]) -> str:
        tokens = [t for t in map(self.text.get, ids) if t is not None]
        if not self.as_bytes:
            return " ".join(tokens)
        return b"".join(bytes([self.shown[c] for c in t]) if all(c in self.shown for c in t) else t.encode() for t in tokens).decode("utf-8", "replace")


_codecs: dict[str, ForcedBPE] = {}


def codec(path: str) -> ForcedBPE:
    """One a worker and file."""
    if path not in _codecs:
        _codecs[path] = ForcedBPE(path)
    return _codecs[path]


def lists(arrays: list[np.ndarray]) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([np.zeros(0, "<u4"), *arrays]).astype(np.int32)))


def coded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded (the text that the ids decode to) of each row. tokenizer: the path of its file on
    every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in batches:
            for part in slices(batch, most=SMALL_SLICE):
                ids = [own.encode(t or "") for t in column_of(part, "text").to_pylist()]
                decoded = [own.decode(i.tolist()) for i in ids]
                yield pa.RecordBatch.from_arrays([column_of(part, "doc_id"), pa.array([len(i) for i in ids], pa.int64()), lists(ids), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, decoded string")


def decoded(rows: DataFrame, tokenizer: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """key and text of each row's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([None if i is None else own.decode(i) for i in part.column(1).to_pylist()], pa.string())], [key, "text"])

    return rows.select(key, ids).mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, text string")
