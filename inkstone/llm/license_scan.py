"""Operator 1: licence scans. MinHash bands over overlapping windows of text retrieve templates; exact containment of
the templates' shingles in the windows verifies them.

Words are runs of ASCII letters, digits and bytes beyond ASCII, lower-cased; shingles are runs of `width` words, for a
template of fewer words of as many as it has. Templates fall into classes by that width and by size, the power of two M at or
above their shingle count. A class's windows hold M + M/4 - 1 shingles and start every M/4, so any M shingles in a row lie in one window.
A template matches a window that holds at least `containment` of its distinct shingles. A window with that many has at
least a known Jaccard similarity to the template; the bands are chosen so that such a window shares one with
probability `recall` or more (`band_settings`). Overlapping windows that match one template are one result.

Defined results: null and empty texts match nothing; a null doc_id stays null; repeated rows each get their rows; an empty
table gives an empty result; equal templates under two names both match; further columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from inkstone.llm.common import column_of, distinct_sorted, mix, shingle_hashes, slices, stream, text_bytes, word_hashes

RESULT = "doc_id long, template string, start_word long, end_word long, matched long, template_shingles long, containment double"


def band_settings(similarity: float, recall: float, most_rows: int = 4) -> tuple[int, int]:
    """Bands and rows a band, the fewest functions with the most rows, for which a pair of this similarity shares a
    band with probability `recall` or more."""
    best = None
    for rows in range(1, most_rows + 1):
        bands = 1 if similarity >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if best is None or bands * rows <= 1.5 * best[0] * best[1]:
            best = (bands, rows)
    return best


def shingled(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    return shingle_hashes(*word_hashes(*text_bytes(column), alnum=True), width)


class TemplateClass:
    """Templates of like size, with their windows and bands."""

    def __init__(self, width: int, size: int, names: list[str], sets: list[np.ndarray], containment: float, recall: float) -> None:
        self.width, self.names, self.sets = width, names, sets
        self.need = [math.ceil(containment * len(s) - 1e-9) for s in sets]
        self.stride = max(1, size // 4)
        self.length = size + self.stride - 1
        self.blocks = -(-self.length // self.stride)  # a window is so many blocks; the last may reach further, which only adds
        held = self.blocks * self.stride
        self.bands, self.rows = band_settings(min(n / (held + len(s) - n) for s, n in zip(sets, self.need, strict=True)), recall)
        self.functions = stream(self.bands * self.rows, 11)
        keys, of = [], []
        for k, s in enumerate(sets):
            keys.append(self.band_keys(np.stack([mix(s * f).min() for f in self.functions])[:, None])[:, 0])
            of.append(np.full(self.bands, k))
        order = np.argsort(np.concatenate(keys), kind="stable")
        self.keys, self.of = np.concatenate(keys)[order], np.concatenate(of)[order]

    def band_keys(self, least: np.ndarray) -> np.ndarray:
        """(bands, windows) keys of (functions, windows) minima."""
        least = least.reshape(self.bands, self.rows, -1)
        key = np.arange(self.bands, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
        for r in range(self.rows):
            key = mix(key ^ least[:, r])
        return key

    def windows(self, shingles: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First block, text and block starts: a window begins at every block."""
        count = -(-np.diff(at) // self.stride)
        text = np.repeat(np.arange(len(count)), count)
        place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        return place, text, at[:-1][text] + place * self.stride

    def candidates(self, shingles: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Text, window start and template, wherever a band is shared."""
        _, text, starts = self.windows(shingles, at)
        if not len(starts):
            return
        least = np.empty((len(self.functions), len(starts)), np.uint64)
        for i, f in enumerate(self.functions):
            low = np.minimum.reduceat(mix(shingles * f), starts)
            own = low.copy()
            for k in range(1, min(self.blocks, len(low))):
                same = text[k:] == text[:-k]
                np.minimum(own[:-k], low[k:], out=own[:-k], where=same)
            least[i] = own
        keys = self.band_keys(least)
        found = set()
        for band in keys:
            first = np.searchsorted(self.keys, band, "left")
            hit = np.flatnonzero(self.keys[np.minimum(first, len(self.keys) - 1)] == band)
            for w in hit.tolist():
                k = int(first[w])
                while k < len(self.keys) and self.keys[k] == band[w]:
                    found.add((int(text[w]), int(starts[w]), int(self.of[k])))
                    k += 1
        yield from sorted(found)


class Scanner:
    def __init__(self, templates: dict[str, str], width: int, containment: float, recall: float) -> None:
        self.width = width
        classes: dict[tuple[int, int], tuple[list, list]] = {}
        for name, text in sorted(templates.items()):
            words = len(word_hashes(*text_bytes(pa.array([text])), alnum=True)[0])
            if words:
                own = distinct_sorted(shingled(pa.array([text]), min(width, words))[0])
                names, sets = classes.setdefault((min(width, words), 1 << (len(own) - 1).bit_length()), ([], []))
                names.append(name)
                sets.append(own)
        self.classes = [TemplateClass(*key, *x, containment, recall) for key, x in sorted(classes.items())]

    def scan(self, column: pa.Array) -> list[tuple]:
        """Text, template, start_word, end_word, matched, template_shingles and containment of each match."""
        words, places = word_hashes(*text_bytes(column), alnum=True)
        found = {w: shingle_hashes(words, places, w) for w in sorted({c.width for c in self.classes})}
        out = []
        for c in self.classes:
            shingles, at = found[c.width]
            merged: dict[tuple[int, int], list[list[int]]] = {}
            for text, start, k in c.candidates(shingles, at):
                end = min(start + c.blocks * c.stride, int(at[text + 1]))
                inside = shingles[start:end]
                place = np.minimum(np.searchsorted(c.sets[k], inside), len(c.sets[k]) - 1)
                hits = np.flatnonzero(c.sets[k][place] == inside)
                matched = len(np.unique(place[hits]))
                if matched < c.need[k]:
                    continue
                base = int(at[text])
                first, last = start + int(hits[0]) - base, start + int(hits[-1]) - base
                runs = merged.setdefault((text, k), [])
                if runs and runs[-1][3] >= start:
                    runs[-1][:] = [min(runs[-1][0], first), max(runs[-1][1], last), max(runs[-1][2], matched), end]
                else:
                    runs.append([first, last, matched, end])
            out += [(text, c.names[k], first, last + c.width, matched, len(c.sets[k]), matched / len(c.sets[k])) for (text, k), runs in merged.items() for first, last, matched, _ in runs]
        return sorted(out)


def scan(docs: DataFrame, templates: dict[str, str], width: int = 5, containment: float = 0.75, recall: float = 0.999) -> DataFrame:
    """A row for each match: doc_id, template, start_word, end_word (exclusive), matched and all distinct shingles of the
    template, and containment. The templates, a fixed parameter, go to every task."""
    scanner = Scanner(templates, width, containment, recall)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                if rows := scanner.scan(column_of(part, "text")):
                    text, name, *rest = zip(*rows, strict=True)
                    kinds = [pa.int64()] * 4 + [pa.float64()]
                    yield pa.RecordBatch.from_arrays([column_of(part, "doc_id").take(pa.array(text)), pa.array(name), *(pa.array(x, k) for x, k in zip(rest, kinds, strict=True))], [x.split()[0] for x in RESULT.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)
