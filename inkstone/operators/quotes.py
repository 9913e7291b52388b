"""Where quotes occur in texts: by grams, joined on equality, then compared exactly.

Characters are hashed in runs of g; of every window of w such runs those of the least hash are kept. A quote of g + w - 1
characters or more has a whole window, so one of its kept runs is kept, at the same place, wherever the quote occurs. Quotes are in
classes by length, each with its g and w, so that long quotes need few runs of a text: about one in 17 from 64 characters on.

Texts and quotes meet only in joins. Runs of texts that no quote has go first; then each quote is looked for by that of its runs that
texts have least often, and a run in very many places is dealt over several keys. Python gets texts in short pieces, so that a batch of
rows is small whatever the texts' lengths; a piece goes on for the characters that its last windows need. Nothing is gathered on the driver but which classes there
are, and one pass over the texts finds all quotes, however many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstone.sources.storage import settled

LONGEST = 6  # the last class: quotes of 2**6 characters and more
SLICE_CHARS = 1 << 18
PIECE = 512  # characters


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def sliding(x: np.ndarray, width: int, f) -> np.ndarray:
    """f (minimum or maximum) of each run of `width`; runs of twice the length come from two."""
    have = 1
    while 2 * have <= width:
        x = f(x[:-have], x[have:])
        have *= 2
    return f(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def kept_runs(text: str, classes: list[int], part: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each class: places of the kept runs of a text and their hashes (signed). part: the number of the text that each
    character is from, where several are joined to one; no window goes from one into another."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    hashes, size = mixed(codes + np.uint64(1)), 1
    for c in sorted(classes):
        least = 1 << c  # characters of the class's shortest quote
        if len(codes) < least:
            return
        g = max(1, least // 2)
        while size < g:
            hashes = mixed(hashes[:-size] * np.uint64(0x9E3779B97F4A7C15) + hashes[size:])
            size *= 2
        w = least - g + 1
        low = sliding(hashes, w, np.minimum)
        if part is not None:
            low[part[: len(low)] != part[least - 1 :]] = 0
        # A run is kept if it is the least of any window that it is in.
        padded = np.concatenate([np.zeros(w - 1, np.uint64), low, np.zeros(w - 1, np.uint64)])
        places = np.flatnonzero(sliding(padded, w, np.maximum) == hashes)
        yield c, places, hashes[places].view(np.int64)


def pieces(rows: DataFrame, key: str, text: str) -> DataFrame:
    """key, start and piece of each text: every PIECE characters of it, with as many more as a run of 2**LONGEST that begins there needs."""
    cut = f"(?s)(?=(.{{1,{PIECE + (1 << LONGEST) - 1}}})).{{1,{PIECE}}}"
    got = rows.select(key, F.posexplode(F.regexp_extract_all(text, F.lit(cut), F.lit(1))).alias("_q_k", "piece"))
    return got.select(key, (F.col("_q_k") * PIECE).alias("start"), "piece")


def runs_of(rows: DataFrame, key: str, text: str, classes: list[int], own_class: bool = False) -> DataFrame:
    """key (long), class, run and place of the kept runs of each text; own_class: those of the text's own class alone. A run near a piece's
    end may come twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ("key", "class", "run", "place"), (pa.int64(), pa.int32(), pa.int64(), pa.int32())
        for batch in batches:
            keys, starts = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            held, chars = [], 0
            for k in range(batch.num_rows):
                held.append(batch.column(2)[k].as_py())
                chars += len(held[-1])
                if own_class or chars >= SLICE_CHARS or k == batch.num_rows - 1:
                    first = k + 1 - len(held)
                    lengths = np.array([len(x) for x in held])
                    part = np.repeat(np.arange(len(held)), lengths)
                    before = np.cumsum(lengths) - lengths - starts[first : k + 1]
                    mine = [min(LONGEST, chars.bit_length() - 1)] if own_class else classes
                    for c, places, hashes in kept_runs("".join(held), mine, part):
                        of = part[places]
                        columns = (keys[first + of], np.full(len(of), c), hashes, places - before[of])
                        yield pa.RecordBatch.from_arrays([pa.array(x.astype(kind.to_pandas_dtype()), kind) for x, kind in zip(columns, kinds, strict=True)], names)
                    held, chars = [], 0

    own = rows.filter(F.col(text) != "")
    cut = own.select(key, F.lit(0).alias("start"), text) if own_class else pieces(own, key, text)
    return cut.mapInArrow(run, "key long, class int, run long, place int")


def quote_spans(texts: DataFrame, quotes: DataFrame, text: str = "text", quote: str = "quote", every: bool = True, hot: int = 100_000) -> DataFrame:
    """Rows of texts joined with the quotes that they hold, and start and end of each occurrence (or the first), from 0.

    hot: the places of a run from which on they are dealt over several keys. Defined results: nulls and empty quotes occur nowhere; repeated
    rows of texts and of quotes each get their own rows; occurrences may overlap; columns of texts and quotes other than these two must
    differ in name, and names that begin with `_q_` are used inside; empty tables give an empty result."""
    asked = settled(quotes.filter(F.col(quote) != "").select(F.xxhash64(quote).alias("_q_id"), F.col(quote).alias("_q_text")).distinct())
    class_of = F.least(F.floor(F.log2(F.length("_q_text") + 0.5)), F.lit(LONGEST)).cast("int")
    classes = sorted(r[0] for r in asked.select(class_of.alias("c")).distinct().collect())  # seven at most
    wanted = settled(runs_of(asked, "_q_id", "_q_text", [], own_class=True))
    bodies = texts.withColumn("_q_key", F.xxhash64(text))
    hits = runs_of(bodies.select("_q_key", text), "_q_key", text, classes).join(wanted.select("class", "run").distinct(), ["class", "run"], "left_semi")
    hits = settled(hits)
    counts = settled(hits.groupBy("class", "run").agg(F.count("*").alias("n")))
    # Each quote's rarest run; a quote one of whose runs no text has occurs nowhere.
    known = wanted.join(counts, ["class", "run"], "left")
    best = known.groupBy(F.col("key").alias("_q_id"), "class").agg(F.count_if(F.col("n").isNull()).alias("missing"), F.min_by(F.struct("run", "place", "n"), F.struct("n", "place")).alias("b")).filter("missing = 0")
    deals = F.ceil(F.col("n") / hot).cast("int")
    anchors = best.select("_q_id", "class", "b.run", F.col("b.place").alias("offset"), F.explode(F.sequence(F.lit(0), F.ceil(F.col("b.n") / hot).cast("int") - 1)).alias("deal"))
    often = counts.filter(F.col("n") > hot).select("class", "run", deals.alias("deals"))
    dealt = hits.join(often, ["class", "run"], "left").withColumn("deal", F.pmod(F.xxhash64("key"), F.coalesce("deals", F.lit(1))).cast("int"))
    found = dealt.join(anchors, ["class", "run", "deal"]).filter("place >= offset").groupBy(F.col("key").alias("_q_key"), "_q_id").agg(F.sort_array(F.collect_set(F.col("place") - F.col("offset"))).alias("_q_starts"))
    both = settled(found).join(bodies, "_q_key").join(asked, "_q_id")
    size = F.length("_q_text")
    holds = F.filter("_q_starts", lambda s: F.substring(F.col(text), s + 1, size) == F.col("_q_text"))
    held = both.withColumn("_q_starts", holds).filter(F.size("_q_starts") > 0)
    starts = F.explode("_q_starts") if every else F.col("_q_starts")[0]
    got = held.select(*texts.columns, "_q_text", starts.alias("start")).withColumn("end", F.col("start") + F.length("_q_text"))
    return got.join(quotes, got["_q_text"] == quotes[quote]).drop("_q_text").select(*texts.columns, *quotes.columns, "start", "end")
