"""Operator 8: TIFF columns. A file's image directories are walked; strips and tiles are decoded from PackBits, LZW or
deflate, horizontal differencing is undone, and each page gives one row.

Samples are 8-bit, chunky, of any number a pixel. Files may have either byte order. A directory that was walked before
ends the walk. A file that is null, damaged or of another kind gives one row with page null and `error` set, after rows for
the pages before the damage. Nothing is allocated or decoded beyond a page's own size, and a page of more than PAGE_BYTES
is an error.

Texts are stored as grey pages of `width` samples a row, at most `page_rows` rows each; the codec, the layout and the
predictor of a page follow from its number and the file's row count, so equal texts give equal files.

Defined results: a null text counts as empty and is stored as one row of padding; a null doc_id stays null; repeated
rows each get their rows; an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from inkstone.llm.common import column_of, slices

# Fixed values of the format.
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
TYPES = {1: "B", 3: "H", 4: "I"}
CODECS = (DEFLATE, LZW, PACKBITS)
NAMES = {NONE: "none", LZW: "lzw", DEFLATE: "deflate", OLD_DEFLATE: "deflate", PACKBITS: "packbits"}

# ---------------------------------------------------------------- codecs


def packbits(data: bytes) -> bytes:
    """Runs of three equal bytes or more as runs, the rest as literals."""
    raw = np.frombuffer(data, np.uint8)
    edges = np.concatenate([[0], np.flatnonzero(raw[1:] != raw[:-1]) + 1, [len(raw)]]) if len(raw) else np.zeros(1, np.int64)
    lengths = np.diff(edges)
    out, literal = [], 0

    def literals(upto: int) -> None:
        for at in range(literal, upto, 128):
            out.append(bytes([min(128, upto - at) - 1]) + data[at : min(at + 128, upto)])

    for k in np.flatnonzero(lengths >= 3):
        begin, end = int(edges[k]), int(edges[k + 1])
        literals(begin)
        for at in range(begin, end, 128):
            n = min(128, end - at)
            out.append(bytes([(257 - n) & 255 if n > 1 else 0, data[at]]))
        literal = end
    literals(len(data))
    return b"".join(out)


def unpackbits(data: bytes, most: int = 1 << 30) -> bytes:
    out, at, size = [], 0, 0
    while at < len(data) and size < most:
        n = data[at]
        if n < 128:
            out.append(data[at + 1 : at + 2 + n])
            at += n + 2
            size += n + 1
        else:
            if n > 128:
                out.append(data[at + 1 : at + 2] * (257 - n))
                size += 257 - n
            at += 2 if n > 128 else 1
    return b"".join(out)


FULL = 4094  # table entries at which this writer clears
#: The width of each code after a clear, by its number, for writers and readers alike: the format widens one code early.
WIDTHS = np.array([9 if 258 + k < 512 else 10 if 258 + k < 1024 else 11 if 258 + k < 2048 else 12 for k in range(4096)])


def lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, the highest bit first, as the format has it."""
    codes, cleared = [256], [0]  # codes, and where the table is new
    if data:
        known: dict[int, int] = {}
        find, add, size, prefix = known.get, codes.append, 258, data[0]
        for byte in data[1:]:
            key = prefix << 8 | byte
            got = find(key)
            if got is not None:
                prefix = got
                continue
            add(prefix)
            known[key] = size
            size += 1
            prefix = byte
            if size == FULL:
                add(256)
                cleared.append(len(codes) - 1)
                known.clear()
                size = 258
        add(prefix)
        if size + 1 == FULL:
            add(256)
            cleared.append(len(codes) - 1)
    codes.append(257)
    code = np.array(codes, np.int64)
    begin = np.zeros(len(code), np.int64)
    begin[cleared[1:]] = cleared[1:]
    nth = np.arange(len(code)) - np.maximum.accumulate(begin)  # codes since the last clear
    wide = WIDTHS[np.maximum(nth - 1, 0)]
    wide[0] = 9
    if len(cleared) > 1:  # a clear has the width of the code it stands in place of
        wide[cleared[1:]] = 12
    place = np.cumsum(wide) - wide
    bits = np.zeros(place[-1] + wide[-1], np.uint8)
    for k in range(12):
        has = wide > k
        bits[place[has] + wide[has] - 1 - k] = (code[has] >> k) & 1
    return np.packbits(bits).tobytes()


def unlzw(data: bytes, most: int = 1 << 30) -> bytes:
    """Codes are read a table's worth at a time: until a clear their widths depend on their number alone. Between two clears
    are fewer than 4,096 codes, none of more bytes than there were codes before."""
    raw = np.zeros(len(data) + 4, np.int64)
    raw[: len(data)] = np.frombuffer(data, np.uint8)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    first = [bytes([i]) for i in range(256)] + [b"", b""]
    widths = WIDTHS[: len(data)]  # no code is shorter than a byte
    ahead = np.cumsum(widths) - widths
    at, out, size = 0, [], 0
    if len(data) > 1 and window[0] >> 23 == 256:
        at = 9
    while at < 8 * len(data) and size < most:
        place = at + ahead
        place = place[place + 9 <= 8 * len(data)]
        wide = widths[: len(place)]
        codes = (window[place >> 3] >> (32 - (place & 7) - wide)) & ((1 << wide) - 1)
        stop = np.flatnonzero((codes == 256) | (codes == 257))
        n = int(stop[0]) if len(stop) else len(codes)
        known, last = first.copy(), b""
        add, put = known.append, out.append
        for code in codes[:n].tolist():
            try:
                got = known[code]
            except IndexError:
                if code != len(known) or not last:
                    raise ValueError("LZW code out of range") from None
                got = last + last[:1]
            if last:
                add(last + got[:1])
            put(got)
            size += len(got)
            last = got
        if n == len(codes) or codes[n] == 257:
            break
        at = int(place[n] + wide[n])
    return b"".join(out)


def packed(data: bytes, codec: int) -> bytes:
    return {NONE: lambda x: x, LZW: lzw, DEFLATE: lambda x: zlib.compress(x, 1), PACKBITS: packbits}[codec](data)


def inflate(data: bytes, most: int) -> bytes:
    return zlib.decompressobj().decompress(data, most)


def unpacked(data: bytes, codec: int, most: int = 1 << 30) -> bytes:
    """The first `most` bytes that data holds, and maybe some further ones."""
    return {NONE: lambda x, n: x, LZW: unlzw, DEFLATE: inflate, OLD_DEFLATE: inflate, PACKBITS: unpackbits}[codec](data, max(1, most))


#: The most bytes of one page. Larger ones are reported as an error: a row has to hold a page.
PAGE_BYTES = 1 << 29


# ---------------------------------------------------------------- files


def write_pages(pages: list[tuple[np.ndarray, int, bool, tuple[int, int] | None, int]], order: str = "<") -> bytes:
    """pages: samples (rows, columns) or (rows, columns, samples a pixel), codec, differencing, tile (height, width) or
    None for strips, rows a strip."""
    out = bytearray(struct.pack(f"{order}2sHI", b"II" if order == "<" else b"MM", 42, 0))
    link = 4
    for samples, codec, differ, tile, rows in pages:
        cube = samples.reshape(*samples.shape[:2], -1)
        high, wide, deep = cube.shape
        parts = []
        if tile:
            full = np.zeros((-(-high // tile[0]) * tile[0], -(-wide // tile[1]) * tile[1], deep), np.uint8)
            full[:high, :wide] = cube
            parts = [full[y : y + tile[0], x : x + tile[1]] for y in range(0, high, tile[0]) for x in range(0, wide, tile[1])]
        else:
            parts = [cube[y : y + rows] for y in range(0, high, rows)]
        places, sizes = [], []
        for part in parts:
            if differ:
                part = np.concatenate([part[:, :1], part[:, 1:] - part[:, :-1]], axis=1)
            data = packed(part.tobytes(), codec)
            places.append(len(out))
            sizes.append(len(data))
            out += data
        tags = [(256, 4, [wide]), (257, 4, [high]), (258, 3, [8] * deep), (259, 3, [codec]), (262, 3, [2 if deep == 3 else 1]), (277, 3, [deep])]
        tags += [(322, 4, [tile[1]]), (323, 4, [tile[0]]), (324, 4, places), (325, 4, sizes)] if tile else [(273, 4, places), (278, 4, [rows]), (279, 4, sizes)]
        if differ:
            tags.append((317, 3, [2]))
        entries = b""
        for tag, kind, values in sorted(tags):
            data = struct.pack(f"{order}{len(values)}{TYPES[kind]}", *values)
            if len(data) > 4:
                out += b"\0" * (len(out) & 1)
                data, at = struct.pack(f"{order}I", len(out)), data
                out += at
            entries += struct.pack(f"{order}HHI", tag, kind, len(values)) + data.ljust(4, b"\0")
        out += b"\0" * (len(out) & 1)
        struct.pack_into(f"{order}I", out, link, len(out))
        out += struct.pack(f"{order}H", len(tags)) + entries
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def read_pages(data: bytes) -> Iterator[tuple[np.ndarray, str, int]]:
    """The samples (rows, columns, samples a pixel), the codec's name and the predictor of each page."""
    if data[:2] not in (b"II", b"MM"):
        raise ValueError("no TIFF")
    order = "<" if data[:2] == b"II" else ">"
    magic, at = struct.unpack_from(f"{order}HI", data, 2)
    if magic != 42:
        raise ValueError("no TIFF")
    seen = set()
    while at and at not in seen:
        seen.add(at)
        (n,) = struct.unpack_from(f"{order}H", data, at)
        tags = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * k)
            if kind in TYPES:
                size, place = struct.calcsize(TYPES[kind]) * count, at + 10 + 12 * k
                if size > 4:
                    (place,) = struct.unpack_from(f"{order}I", data, place)
                if place + size > len(data):
                    raise ValueError("values beyond the file's end")
                tags[tag] = struct.unpack_from(f"{order}{count}{TYPES[kind]}", data, place)
        one = lambda tag, default: tags.get(tag, (default,))[0]
        wide, high, deep, codec, predictor = tags[256][0], tags[257][0], one(277, 1), one(259, NONE), one(317, 1)
        if set(tags.get(258, (1,))) != {8} or one(284, 1) != 1 or codec not in NAMES or predictor not in (1, 2):
            raise ValueError("a kind of page that isn't read")
        tiled = 324 in tags
        part_wide, part_high = (tags[322][0], tags[323][0]) if tiled else (wide, min(one(278, high), high))
        if not (wide and high and deep and part_wide and part_high):
            raise ValueError("a page or part without samples")
        across, down = -(-wide // part_wide), -(-high // part_high)
        places, sizes = tags[324 if tiled else 273], tags[325 if tiled else 279]
        if not len(places) == len(sizes) == across * down:
            raise ValueError("another number of strips or tiles than the page has")
        if across * part_wide * down * part_high * deep > PAGE_BYTES:
            raise ValueError(f"a page of more than {PAGE_BYTES} bytes")
        if any(place + size > len(data) for place, size in zip(places, sizes, strict=True)):
            raise ValueError("a strip or tile beyond the file's end")
        image = np.zeros((high, wide, deep), np.uint8)
        for k, (place, size) in enumerate(zip(places, sizes, strict=True)):
            y, x = k // across * part_high, k % across * part_wide
            rows = part_high if tiled else min(part_high, high - y)
            need = rows * part_wide * deep
            part = np.frombuffer(unpacked(data[place : place + size], codec, need), np.uint8)[:need].reshape(rows, part_wide, deep)
            if predictor == 2:
                part = np.cumsum(part, axis=1, dtype=np.uint8)
            image[y : y + rows, x : x + part_wide] = part[: high - y, : wide - x]
        yield image, NAMES[codec], predictor
        (at,) = struct.unpack_from(f"{order}I", data, at + 2 + 12 * n)


def text_file(payload: bytes, width: int = 576, page_rows: int = 64) -> bytes:
    """A file of the payload, whose length is a multiple of the width."""
    grid = np.frombuffer(payload, np.uint8).reshape(-1, width)
    pages = []
    for k, y in enumerate(range(0, len(grid), page_rows)):
        page, kind = grid[y : y + page_rows], len(grid) + k
        codec = CODECS[kind % 3]
        pages.append((page, codec, codec != PACKBITS and kind % 2 == 0, (16, 192) if len(page) >= 16 and kind % 5 < 2 else None, 16))
    return write_pages(pages)


# ---------------------------------------------------------------- Spark


def pages(files: DataFrame, key: str = "doc_id", content: str = "content") -> DataFrame:
    """One row per page: key, page (from 0), n_rows, n_columns, n_samples, codec, predictor, samples, error."""
    kind = files.schema[key].dataType.simpleString()
    names = ["page", "n_rows", "n_columns", "n_samples", "codec", "predictor", "samples", "error"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, content):
                rows, of = [], []
                for i, data in enumerate(column_of(part, content).to_pylist()):
                    own = []
                    try:
                        for k, (image, codec, predictor) in enumerate(read_pages(data or b"")):
                            own.append((k, *image.shape, codec, predictor, image.tobytes(), None))
                        if not own:
                            raise ValueError("no pages")
                    except (ValueError, LookupError, ArithmeticError, MemoryError, struct.error, zlib.error) as e:
                        own.append((None,) * 7 + (f"{type(e).__name__}: {e}",))
                    rows += own
                    of += [i] * len(own)
                kinds = [pa.int32()] * 4 + [pa.string(), pa.int32(), pa.binary(), pa.string()]
                columns = zip(*rows, strict=True) if rows else [[]] * 8
                yield pa.RecordBatch.from_arrays([column_of(part, key).take(pa.array(of, pa.int64())), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))], [key, *names])

    return files.select(key, content).mapInArrow(read, f"{key} {kind}, page int, n_rows int, n_columns int, n_samples int, codec string, predictor int, samples binary, error string")


def stored_texts(docs: DataFrame, width: int = 576, page_rows: int = 64, with_media: bool = False) -> DataFrame:
    """Stores each text as a file, reads the file's pages back and describes what was read: doc_id, n_bytes,
    payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, content (null unless asked for)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = []
                for text in column_of(part, "text").to_pylist():
                    raw = (text or "").encode()
                    media = text_file(raw + b"\xff" * (-len(raw) % width or (0 if raw else width)), width, page_rows)
                    read = list(read_pages(media))
                    back = b"".join(image.tobytes() for image, _, _ in read)
                    levels = np.frombuffer(back, np.uint8)
                    feature = f"{len(read)} pages, {'+'.join(sorted({codec for _, codec, _ in read}))}, mean {levels.mean():.4f}, deviation {levels.std():.4f}, {np.count_nonzero(np.bincount(levels, minlength=256))} levels"
                    rows.append((len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature, media if with_media else None))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([column_of(part, "doc_id"), *(pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True))], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "content"])

    return docs.select("doc_id", "text").mapInArrow(made, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, content binary")
