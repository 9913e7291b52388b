"""Token counts, SentencePiece, licence scans, TIFF: against brute force, the public library and round trips."""

import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from inkstone.llm import license_scan, sentencepiece_codec, tiff, token_counts
from inkstone.llm.common import shingle_sets, text_bytes, tokenizer_path, word_hashes
from inkstone.llm.license_templates import TEMPLATES

from .conftest import ODD, words_of


def test_word_hashes_agree_with_words():
    texts = [t for _, t in ODD] + ["".join(random.Random(i).choice("ab cdE\n\tFé  ABC中") for _ in range(60)) for i in range(300)]
    hashes, at = word_hashes(*text_bytes(pa.array(texts)))
    seen = {}
    for i, t in enumerate(texts):
        assert len(words_of(t)) == at[i + 1] - at[i]
        for w, h in zip(words_of(t), hashes[at[i] : at[i + 1]].tolist(), strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    for t, s in zip(texts, shingle_sets(pa.array(texts), 5), strict=True):
        w = words_of(t)
        assert len(s) == len({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else ())


def greedy(word, starts, rest, most):
    if len(word) > most:
        return None
    n = at = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in (rest if at else starts)), None)
        if end is None:
            return None
        n, at = n + 1, end
    return n


@pytest.mark.parametrize("seed", range(20))
def test_longest_match_against_greedy(seed):
    rng = random.Random(seed)
    make = lambda: {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(12)}
    starts, rest = make(), make()
    automaton = token_counts.LongestMatch(starts, rest, 12)
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))
        expected = greedy(word, starts, rest, 12)
        assert automaton.count(word) == (1 + token_counts.UNKNOWN if expected is None else expected)


def test_token_counts(spark, odd, none):
    starts, rest = vocabulary = token_counts.sentencepiece_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    starts, rest = set(starts), set(rest)
    rows = sorted((tuple(r) for r in token_counts.token_counts(odd, vocabulary).collect()), key=str)
    expected = []
    for i, t in ODD:
        got = [greedy(w, starts, rest, 1 << 30) for w in token_counts.WORDS.findall(t or "")]
        expected.append((i, len(got), sum(1 if x is None else x for x in got), sum(x is None for x in got)))
    assert rows == sorted(expected, key=str)
    ten = lambda **rule: next(r for r in token_counts.token_counts(odd, vocabulary, **rule).collect() if r["doc_id"] == 10)
    assert ten()["n_tokens"] > 100 and ten()["n_unknown"] == 0 and ten(max_word=100)["n_unknown"] == 1
    assert token_counts.token_counts(none, vocabulary).count() == 0


def test_very_long_words_are_matched_whole():
    automaton = token_counts.LongestMatch({"a", "ab"}, {"ab", "b", "a"})
    assert automaton.count("ab" * 300_000) == 300_000 and automaton.count("ab" * 300_000 + "c") == 1 + token_counts.UNKNOWN


@pytest.fixture(scope="module")
def model():
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def test_sentencepiece_is_no_worse_than_the_library(model):
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    proto.trainer_spec.model_type = 1  # the library then takes the best path, too
    library = SentencePieceProcessor(model_proto=proto.SerializeToString())
    own = sentencepiece_codec.Model(model)
    for _, t in ODD:
        t = (t or "")[:500].replace("\x00", "")
        ids = np.frombuffer(own.encode(t), "<u4").tolist()
        pieces = [proto.pieces[i] for i in ids]
        theirs = [proto.pieces[i] for i in library.encode(t)]
        total = lambda ps: sum(p.score for p in ps)
        assert total(pieces) >= total(theirs) - 1e-3 and own.decode(own.encode(t)) == t
        assert library.decode(ids) == t


def test_sentencepiece_against_brute_force(model):
    own = sentencepiece_codec.Model(model)
    scores = {}
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    for p in proto.pieces:
        if p.type == 1:
            scores[p.piece] = p.score
    for text in ("hello world", "néé  x\ny", "中文字符 ab", "the theatre"):
        run = "▁" + text.replace(" ", "▁")
        best = [0.0] + [-1e300] * len(run)
        for e in range(1, len(run) + 1):
            for b in range(max(0, e - 16), e):
                own_score = scores.get(run[b:e], own.lowest if e - b == 1 else None)
                if own_score is not None:
                    best[e] = max(best[e], best[b] + own_score)
        ids = np.frombuffer(own.encode(text), "<u4").tolist()
        unknown = {c for c in run if c not in scores}
        assert abs(sum(proto.pieces[i].score for i in ids) + own.lowest * sum(c in unknown for c in run) - best[-1]) < 1e-6


def test_user_defined_and_unknown_pieces(model):
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    proto.trainer_spec.model_type = 1
    for piece in ("<mask>", "q#q", "né#e"):
        own = proto.pieces.add()
        own.piece, own.score, own.type = piece, 0.0, 4
    serialized = proto.SerializeToString()
    library, own = SentencePieceProcessor(model_proto=serialized), sentencepiece_codec.Model(serialized)
    for t in ("a <mask> b", "<mask><mask>", "xq#qy né#e", "n\u00e9e", "<mas", "q#<mask>q#q"):
        ids = np.frombuffer(own.encode(t), "<u4").tolist()
        assert [i for i in ids if proto.pieces[i].type == 4] == [i for i in library.encode(t) if proto.pieces[i].type == 4]
        assert own.decode(own.encode(t)) == t
    unknown = np.array([library.unk_id()], "<u4").tobytes()
    assert own.decode(unknown) == library.decode([library.unk_id()])


def test_sentencepiece_round_trips(spark, odd, none, documents, model):
    assert sentencepiece_codec.coded(odd, model).filter("NOT round_trip").count() == 0
    assert sentencepiece_codec.coded(documents, model).filter("NOT round_trip").count() == 0
    ids = sentencepiece_codec.encode(odd, model)
    back = {(r["doc_id"], r["text"]) for r in sentencepiece_codec.decode(ids, model).collect()}
    assert back == {(i, t or "") for i, t in ODD}
    small = ids.filter("doc_id = 6").select(sentencepiece_codec.ids_array().alias("a"), "ids").first()
    assert small["a"] == np.frombuffer(small["ids"], "<u4").tolist()
    assert sentencepiece_codec.coded(none, model).count() == 0


def test_band_settings_reach_the_recall():
    for s in (0.1, 0.3, 0.5, 0.75, 0.9, 1.0):
        bands, rows = license_scan.band_settings(s, 0.999)
        assert 1 - (1 - s**rows) ** bands >= 0.999


def brute_windows(text, scanner):
    """(template, best containment) over all windows, without bands."""
    out = {}
    for c in scanner.classes:
        shingles, at = license_scan.shingled(pa.array([text]), c.width)
        for name, own in zip(c.names, c.sets, strict=True):
            for start in range(0, len(shingles), c.stride):
                share = len(np.intersect1d(shingles[start : start + c.blocks * c.stride], own)) / len(own)
                if share >= 0.75:
                    out[name] = max(out.get(name, 0), share)
    return out


def test_licence_scan(spark, odd, none):
    scanner = license_scan.Scanner(TEMPLATES, 5, 0.75, 0.999)
    filler = " ".join(f"w{i}" for i in range(200))
    rows = [(1, f"{filler} {TEMPLATES['mit']} {filler}"), (2, f"{filler}\n{TEMPLATES['mit-line']}"), (3, filler), (4, None), (5, ""), (6, TEMPLATES["gpl-3.0"].upper()), (6, TEMPLATES["gpl-3.0"].upper())]
    words = TEMPLATES["apache-2.0"].split()
    words[20] = words[40] = "changed"
    rows += [(7, filler + " " + " ".join(words)), (8, " ".join(words[: len(words) // 2])), (9, f"{TEMPLATES['isc']} {filler} {TEMPLATES['isc']}")]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), TEMPLATES).collect()
    found = {}
    for r in got:
        found.setdefault(r["doc_id"], {}).setdefault(r["template"], []).append(r["containment"])
    for i, t in rows:
        assert {k: max(v) for k, v in found.get(i, {}).items()} == brute_windows(t or "", scanner)
    assert "mit" in found[1] and "mit-line" in found[2] and 3 not in found and "apache-2.0" in found[7] and "apache-2.0" not in found.get(8, {})
    assert len(found[9]["isc"]) == 2 and len(found[6]["gpl-3.0"]) == 2
    assert license_scan.scan(odd, TEMPLATES).count() == 0 and license_scan.scan(none, TEMPLATES).count() == 0


def test_short_templates_are_found_inside_texts(spark):
    templates = {"one": "MIT", "three": "Public Domain work", "five": "a b c d e", "none": " . "}
    rows = [(1, "under the (MIT) licence"), (2, "this is public domain work, MIT"), (3, "public domain"), (4, "mit"), (5, "x a b c d e y"), (6, "a b c d"), (7, None)]
    got = {(r["doc_id"], r["template"], r["start_word"], r["end_word"]) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), templates).collect()}
    assert got == {(1, "one", 2, 3), (2, "three", 2, 5), (2, "one", 5, 6), (4, "one", 0, 1), (5, "five", 1, 6)}


def test_licences_of_the_table(documents):
    scanner = license_scan.Scanner(TEMPLATES, 5, 0.75, 0.999)
    expected = {(r["doc_id"], k) for r in documents.collect() for k in brute_windows(r["text"], scanner)}
    assert {(r["doc_id"], r["template"]) for r in license_scan.scan(documents, TEMPLATES).collect()} == expected


@pytest.mark.parametrize("codec", [tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS])
def test_codecs(codec):
    rng = random.Random(codec)
    for n in [0, 1, 2, 3, 127, 128, 129, 253, 254, 255, 256, 1000, *range(3830, 3845), 50_000]:
        for letters in (1, 2, 256):
            data = bytes(rng.randrange(letters) for _ in range(n))
            assert tiff.unpacked(tiff.packed(data, codec), codec) == data


def test_known_codes():
    assert tiff.lzw(bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])).hex() == "8001e0408044080c068080"
    assert tiff.unpackbits(bytes([0xFE, 0xAA, 0x02, 0x80, 0x00, 0x2A, 0xFD, 0xAA, 0x80])) == bytes([0xAA] * 3 + [0x80, 0x00, 0x2A] + [0xAA] * 4)


def test_pages(spark):
    rng = np.random.default_rng(1)
    shapes = [(30, 40), (17, 33, 3), (1, 1), (64, 16)]
    pages = [rng.integers(0, 256, s, dtype=np.uint8) for s in shapes]
    kinds = [(tiff.LZW, True, None, 7), (tiff.DEFLATE, True, (16, 16), 0), (tiff.NONE, False, None, 1), (tiff.PACKBITS, False, (16, 32), 0)]
    for order in "<>":
        data = tiff.write_pages([(p, *k) for p, k in zip(pages, kinds, strict=True)], order)
        back = list(tiff.read_pages(data))
        assert all(np.array_equal(p.reshape(*p.shape[:2], -1), image) for p, (image, _, _) in zip(pages, back, strict=True))
    files = spark.createDataFrame([(1, data), (2, b"junk"), (3, None), (4, b""), (None, data), (5, data[: len(data) // 2])], "doc_id long, content binary")
    rows = tiff.pages(files).collect()
    assert [r["page"] for r in rows if r["doc_id"] == 1] == [0, 1, 2, 3] and len([r for r in rows if r["doc_id"] is None]) == 4
    assert all(r["error"] for r in rows if r["doc_id"] in (2, 3, 4, 5) and r["page"] is None) and {2, 3, 4, 5} <= {r["doc_id"] for r in rows}
    loop = bytearray(tiff.write_pages([(pages[0], tiff.NONE, False, None, 30)]))
    loop[-4:] = loop[4:8]  # the directory that follows is the first one
    assert len(list(tiff.read_pages(bytes(loop)))) == 1


def test_damaged_files_give_rows(spark):
    """Every single byte of a file changed, cuts at every place, and headers that ask for nothing or for too much."""
    grid = np.arange(20 * 12, dtype=np.uint8).reshape(20, 12)
    good = tiff.write_pages([(grid, tiff.LZW, True, None, 7), (grid, tiff.DEFLATE, False, (16, 16), 0), (grid, tiff.PACKBITS, False, None, 20)])
    rng = random.Random(4)
    files = [good[:n] for n in range(0, len(good), 7)]
    for at in range(len(good)):
        own = bytearray(good)
        own[at] = rng.choice([0, 255, own[at] ^ 1 << rng.randrange(8)])
        files.append(bytes(own))
    wide = good.index(struct.pack("<HHI", 256, 4, 1)) + 8
    for value in (0, 2**32 - 1, 2**31):
        own = bytearray(good)
        own[wide : wide + 4] = struct.pack("<I", value)
        files.append(bytes(own))
    bomb = bytearray(tiff.write_pages([(grid, tiff.DEFLATE, False, None, 20)]))
    files.append(bytes(bomb).replace(tiff.packed(grid.tobytes(), tiff.DEFLATE), tiff.packed(b"\0" * 10_000_000, tiff.DEFLATE)[: len(tiff.packed(grid.tobytes(), tiff.DEFLATE))]))
    df = spark.createDataFrame(list(enumerate(files)), "doc_id long, content binary").repartition(4)
    rows = tiff.pages(df).collect()
    assert {r["doc_id"] for r in rows} == set(range(len(files)))
    assert all((r["page"] is None) == (r["error"] is not None) for r in rows)
    assert all(r["error"] for r in rows if r["doc_id"] in range(len(files) - 4, len(files) - 1) and r["page"] is None)


def test_decoding_stops_at_the_size_of_the_page():
    for codec in (tiff.LZW, tiff.DEFLATE, tiff.PACKBITS):
        assert len(tiff.unpacked(tiff.packed(b"\0" * 30_000_000, codec), codec, 1_000)) < 9_000_000


def test_stored_texts(spark, odd, none, documents):
    for docs, rows in ((odd, ODD), (documents, [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()])):
        expected = []
        for i, t in rows:
            raw = (t or "").encode()
            raw += b"\xff" * (576 * max(1, -(-len(raw) // 576)) - len(raw))
            expected.append((i, len((t or "").encode()), len(raw), __import__("hashlib").sha256(raw).hexdigest(), zlib.crc32(raw[-32:])))
        got = tiff.stored_texts(docs, with_media=True)
        assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == sorted(expected, key=str)
        read = tiff.pages(got.withColumnRenamed("content", "content")).groupBy("doc_id").count().collect()
        assert len(read) == len({i for i, _ in rows})
    assert tiff.stored_texts(none).count() == 0
