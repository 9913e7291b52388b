"""Operator 6: SentencePiece encoding and decoding.

An Aho-Corasick automaton over the pieces reports every piece that ends at a position (its own match and those on its
output links); one pass relaxes the best score at each position, and the best path is read backwards. Characters that no
piece covers cost the lowest score less 10 and become their UTF-8 bytes. The segmentation is the one of highest total
score, earlier starts first among equals. A user-defined piece scores the highest score a byte, less 0.1, and unused pieces
match nothing; the unknown id decodes to the model's surface for it.

No piece has a space mark behind another character, nor a line end inside, so a best path always passes through the
borders of such runs; `Model` proves this from its pieces and then encodes run by run and remembers frequent runs.
Otherwise it encodes whole texts.

Defined results: null and empty texts have no ids and decode to an empty text; a null doc_id stays null; repeated rows
each get a row; an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstone.llm.common import column_of, slices

CACHED = 400_000
SPACE = "▁"


class Model(dict):
    """As a dict: the packed ids (little-endian unsigned 32 bits) of runs of text."""

    def __init__(self, serialized: bytes) -> None:
        super().__init__()
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(serialized)
        if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models with the identity normaliser are encoded")
        self.prefix = SPACE if proto.normalizer_spec.add_dummy_prefix else ""
        self.automaton = ahocorasick.Automaton()
        self.bytes_ids, self.unknown, self.text = [0] * 256, 0, []
        plain = []
        highest = max((p.score for p in proto.pieces if p.type == 1), default=0.0)
        for i, p in enumerate(proto.pieces):
            self.text.append(p.piece.replace(SPACE, " ").encode())
            if p.type in (1, 4):
                score = p.score if p.type == 1 else len(p.piece.encode()) * highest - 0.1
                self.automaton.add_word(p.piece, (len(p.piece), score, i))
                plain.append(p.piece)
            elif p.type == 2:
                self.unknown = i
                self.text[i] = proto.trainer_spec.unk_surface.encode()
            elif p.type == 6:
                value = int(p.piece[3:5], 16)
                self.bytes_ids[value] = i
                self.text[i] = bytes([value])
            elif p.type == 3:
                self.text[i] = b""
        self.automaton.make_automaton()
        self.byte_fallback = any(self.bytes_ids)
        self.lowest = min((p.score for p in proto.pieces if p.type == 1), default=0.0) - 10
        inside = set().union(*plain)
        spaced = any(SPACE in p.lstrip(SPACE) for p in plain)
        alone = "" if "\n" in inside else "\n"
        self.runs = None if spaced else re.compile(f"{alone}|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def best(self, run: str) -> bytes:
        n = len(run)
        score, origin = [0.0] + [-1e300] * n, [None] * (n + 1)
        done = 0  # characters up to which positions are final

        def unknown(upto: int) -> None:
            nonlocal done
            while done < upto:  # a character that nothing better covers
                done += 1
                if (got := score[done - 1] + self.lowest) > score[done] and not single[done]:
                    score[done], origin[done] = got, (1, 0, -1)

        single = [False] * (n + 1)
        for end, match in self.automaton.iter(run):
            if end > done:
                unknown(end)
            length, own, _ = match
            if length == 1:
                single[end + 1] = True
            if (got := score[end + 1 - length] + own) > score[end + 1]:
                score[end + 1], origin[end + 1] = got, match
        unknown(n)
        ids = []
        while n:
            length, _, i = origin[n]
            if i >= 0:
                ids.append(i)
            elif self.byte_fallback:
                ids += [self.bytes_ids[b] for b in reversed(run[n - 1].encode())]
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
            n -= length
        return np.array(ids[::-1], "<u4").tobytes()

    def __missing__(self, run: str) -> bytes:
        got = self.best(run)
        if len(self) < CACHED and len(run) < 64:
            self[run] = got
        return got

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        text = self.prefix + text.replace(" ", SPACE)
        return b"".join(map(self.__getitem__, self.runs.findall(text))) if self.runs else self.best(text)

    def decode(self, ids: bytes) -> str:
        own = np.frombuffer(ids, "<u4").tolist()
        got = b"".join(map(self.text.__getitem__, own))
        return (got[1:] if self.prefix and got[:1] == b" " and own[0] != self.unknown else got).decode(errors="replace")


_models: dict[int, Model] = {}


def _model(shared) -> Model:
    key = hash(shared.value)
    if key not in _models:
        _models.clear()
        _models[key] = Model(shared.value)
    return _models[key]


def _mapped(df: DataFrame, model: bytes, needed: list[str], schema: str, row) -> DataFrame:
    """row(model, value) gives the further columns of one value of the last needed column."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    names = [x.split()[0] for x in schema.split(", ")]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _model(shared)
        for batch in batches:
            for part in slices(batch, needed[-1]):
                rows = [row(own, x) for x in column_of(part, needed[-1]).to_pylist()]
                yield pa.RecordBatch.from_arrays([column_of(part, "doc_id"), *(pa.array(x) for x in zip(*rows, strict=True))], names)

    return df.select(*needed).mapInArrow(made, schema)


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id and ids (packed little-endian unsigned 32 bits) of each text. model: a serialised SentencePiece model."""
    return _mapped(docs, model, ["doc_id", "text"], "doc_id long, ids binary", lambda m, text: (m.encode(text or ""),))


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """doc_id and text of packed ids; null ids give an empty text."""
    return _mapped(encoded, model, ["doc_id", "ids"], "doc_id long, text string", lambda m, ids: (m.decode(ids or b""),))


def ids_array(packed: str = "ids"):
    """The packed ids as an array<long> column, by SQL functions alone."""
    at = lambda i: F.conv(F.concat(*(F.hex(F.substring(packed, i * 4 + k, 1)) for k in (4, 3, 2, 1))), 16, 10).cast("long")
    return F.when(F.length(packed) == 0, F.array().cast("array<long>")).otherwise(F.transform(F.sequence(F.lit(0), (F.length(packed) / 4 - 1).cast("int")), at))


def coded(docs: DataFrame, model: bytes) -> DataFrame:
    """Both ways in one pass, without keeping ids: doc_id, n_ids, ids_crc32 (of the packed ids), decoded_crc32 (of the
    decoded text's UTF-8) and whether the decoded text equals the text."""

    def row(m: Model, text: str | None):
        ids = m.encode(text or "")
        back = m.decode(ids)
        return len(ids) // 4, zlib.crc32(ids), zlib.crc32(back.encode()), back == (text or "")

    return _mapped(docs, model, ["doc_id", "text"], "doc_id long, n_ids long, ids_crc32 long, decoded_crc32 long, round_trip boolean", row)
