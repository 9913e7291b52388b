"""Operator 10: word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie with one root for pieces that begin a word and one for pieces that continue it ("##x"). Each
node has a failure link and the number of pieces that following it pops, so that greedy longest-match lengths come from
one pass over a word's characters and no piece is built. A word is a run of word characters or one other character that
isn't white space; it counts as one unknown token when no greedy match covers it or, where a vocabulary has such a rule, it is
longer than `max_word` characters. Without that rule a word may have any length: the pass is linear.

Defined results: null and empty texts have no words and no tokens; a null doc_id stays null; repeated rows each get a
row; an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from inkstone.llm.common import column_of, slices

WORDS = re.compile(r"\w+|[^\w\s]")
UNKNOWN = 1 << 32  # added to a word's count of one; sums of counts then hold both
CACHED = 400_000  # words that a worker remembers; others are matched again


class LongestMatch:
    """`starts`: pieces that may begin a word; `rest`: pieces that may follow another."""

    def __init__(self, starts: Iterable[str], rest: Iterable[str], max_word: int | None = None) -> None:
        self.max_word = max_word
        self.next: list[dict[str, int]] = [{}, {}]  # node 0 begins a word, node 1 continues it
        ends = self._grow(0, starts) | self._grow(1, rest)
        self.fail: list[int] = [-1] * len(self.next)
        self.popped: list[int] = [0] * len(self.next)
        level = [0, 1]
        while level:
            below = []
            for parent in level:
                for char, node in self.next[parent].items():
                    below.append(node)
                    if node in ends:
                        self.fail[node], self.popped[node] = 1, 1
                        continue
                    at, popped = self.fail[parent], self.popped[parent]
                    while at >= 0 and char not in self.next[at]:
                        popped += self.popped[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[node], self.popped[node] = self.next[at][char], popped
            level = below

    def _grow(self, root: int, pieces: Iterable[str]) -> set[int]:
        ends = set()
        for piece in pieces:
            at = root
            for char in piece:
                if char not in self.next[at]:
                    self.next.append({})
                    self.next[at][char] = len(self.next) - 1
                at = self.next[at][char]
            if at > 1:
                ends.add(at)
        return ends

    def count(self, word: str) -> int:
        """The number of pieces, or 1 + UNKNOWN."""
        if self.max_word is not None and len(word) > self.max_word:
            return 1 + UNKNOWN
        at = total = 0
        step, fail, popped = self.next, self.fail, self.popped
        for char in word:
            while char not in step[at]:
                if fail[at] < 0:
                    return 1 + UNKNOWN
                total += popped[at]
                at = fail[at]
            at = step[at][char]
        while at > 1:
            if fail[at] < 0:
                return 1 + UNKNOWN
            total += popped[at]
            at = fail[at]
        return total


class Counts(dict):
    """Counts by word, with a bound on what is remembered."""

    def __init__(self, automaton: LongestMatch) -> None:
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        got = self.automaton.count(word)
        if len(self) < CACHED and len(word) < 64:
            self[word] = got
        return got


def sentencepiece_vocabulary(model_file: str) -> tuple[list[str], list[str]]:
    """Word pieces of a SentencePiece model: those with the mark of a space begin words, the others continue them."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [p[1:] for p in pieces if p[0] == "▁" and "▁" not in p[1:] and len(p) > 1], [p for p in pieces if "▁" not in p]


_built: dict[int, tuple[object, Counts]] = {}


def _counts(shared, max_word: int | None) -> Counts:
    """One automaton a worker, used again by its later tasks."""
    key = (shared.value[2], max_word)
    if key not in _built:
        _built.clear()
        _built[key] = Counts(LongestMatch(shared.value[0], shared.value[1], max_word))
    return _built[key]


def token_counts(docs: DataFrame, vocabulary: tuple[list[str], list[str]], max_word: int | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens and n_unknown of each text. Only the vocabulary, whose size is fixed, is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast((*vocabulary, hash((tuple(vocabulary[0]), tuple(vocabulary[1])))))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counts(shared, max_word).__getitem__
        for batch in batches:
            for part in slices(batch):
                words, totals = [], []
                for text in column_of(part, "text").to_pylist():
                    found = WORDS.findall(text or "")
                    words.append(len(found))
                    totals.append(sum(map(count, found)))
                yield pa.RecordBatch.from_arrays(
                    [column_of(part, "doc_id"), pa.array(words, pa.int64()), pa.array([t % UNKNOWN for t in totals], pa.int64()), pa.array([t // UNKNOWN for t in totals], pa.int64())],
                    ["doc_id", "n_words", "n_tokens", "n_unknown"],
                )

    return docs.select("doc_id", "text").mapInArrow(counted, "doc_id long, n_words long, n_tokens long, n_unknown long")
