"""Documents: ingestion, chunks, terms, quotes, citations."""

from __future__ import annotations

import hashlib
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstone.functions.text import count_term, find_all, paragraphs
from inkstone.operators.rows import first_rows


def insert_absent(table: DataFrame, rows: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """The first row (by order, or seq, then the rest) of each key that the table lacks: what an insert that ignores conflicts appends."""
    return first_rows(rows, keys, order).join(table.select(*keys), keys, "left_anti")


def spans(lengths: list[int], target: int, overlap: int) -> list[tuple[int, int]]:
    """First and last paragraph of each chunk. With sums of lengths, a chunk's end is the last place at which the sum, two
    characters between paragraphs included, is within the target; the next one's start is the last place from which
    `overlap` characters or more are repeated, and at least one paragraph on."""
    plain = [0, *accumulate(lengths)]
    spaced = [total + 2 * k for k, total in enumerate(plain)]
    out, start = [], 0
    while start < len(lengths):
        end = max(start + 1, bisect_right(spaced, spaced[start] + target + 2) - 1)
        out.append((start, end - 1))
        start = max(start + 1, bisect_right(plain, plain[end] - overlap) - 1) if end < len(lengths) else end
    return out


def chunks(docs: DataFrame, target: int = 1800, overlap: int = 200, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Overlapping chunks of whole paragraphs: key, paragraph_start, paragraph_end, text, hash. The walk depends on its own
    earlier steps, so it runs over each document's paragraphs in Arrow batches; a null or blank text gives no chunk."""
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "paragraph_start", "paragraph_end", "text", "hash"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for a, b in spans([len(p) for p in parts], target, overlap):
                    body = "\n\n".join(parts[a : b + 1])
                    rows.append((doc, a, b, body, hashlib.sha256(body.encode()).hexdigest()[:16]))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            kinds = [batch.schema.field(0).type, pa.int32(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return docs.select(F.col(key), paragraphs(F.col(text)).alias("parts")).mapInArrow(walk, f"{key} {kind}, paragraph_start int, paragraph_end int, text string, hash string")


def unchunked(docs: DataFrame, chunked: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents without chunks."""
    return docs.join(chunked.select(key).distinct(), key, "left_anti")


def term_places(texts: DataFrame, terms: dict[str, str], place: str, text: str = "text") -> DataFrame:
    """term_id, place and n (occurrences without overlap) of each place that has a term of a fixed list, which is an array in
    the plan."""
    listed = F.array(*(F.struct(F.lit(k).alias("term"), F.lit(v).alias("term_id")) for k, v in terms.items()))
    found = F.filter(F.transform(listed, lambda t: F.struct(t["term_id"].alias("term_id"), count_term(F.col(text), t["term"]).alias("n"))), lambda t: t["n"] > 0)
    return texts.select(F.col(place).alias("place"), F.inline(found)).groupBy("term_id", "place").agg(F.sum("n").alias("n"))


def discover_terms(texts: DataFrame, terms: dict[str, str], place: str, text: str = "text", least: int = 1) -> DataFrame:
    """term_id, n, n_places and first_place of each term that occurs `least` times or more. Which places, term_places() says."""
    got = term_places(texts, terms, place, text).groupBy("term_id").agg(F.sum("n").alias("n"), F.count("*").alias("n_places"), F.min("place").alias("first_place"))
    return got.filter(F.col("n") >= least)


def nfc(text: Column) -> Column:
    @F.pandas_udf("string")
    def normal(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))

    return normal(text)


def nfc_each(texts: Column) -> Column:
    @F.pandas_udf("array<string>")
    def normal(lists: pd.Series) -> pd.Series:
        return lists.map(lambda own: None if own is None else [None if x is None else unicodedata.normalize("NFC", x) for x in own])

    return normal(texts)


@cache
def unsure() -> frozenset[int]:
    """The characters without which a text is in normal form C: those that it replaces, and those that join or change places with one
    before them."""
    found = {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}  # parts of Hangul syllables
    for c in (*range(0x80, 0xD800), *range(0xE000, 0x110000)):
        x = chr(c)
        parts = unicodedata.decomposition(x).split()
        if unicodedata.combining(x) or not unicodedata.is_normalized("NFC", x):
            found.add(c)
        if len(parts) == 2 and not parts[0].startswith("<"):
            found.add(int(parts[1], 16))
    return frozenset(found)


@cache
def may_change() -> str:
    """A regular expression for unsure(), which sees first whether a character is in one of the long ranges that hold none."""
    found = unsure()
    starts, ends = sorted(c for c in found if c - 1 not in found), sorted(c for c in found if c + 1 not in found)
    gaps = [(a + 1, b - 1) for a, b in zip([-1, *ends], [*starts, 0x110000], strict=True) if b - a > 512]
    listed = lambda ranges: "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)
    return f"[[^{listed(gaps)}]&&[{listed(zip(starts, ends, strict=True))}]]"


def normalised(df: DataFrame, *columns: str) -> DataFrame:
    """The columns in Unicode normal form C. Spark has no such function, so a vectorised one does it; it is given only the texts that
    may change, and nulls for the others, which a condition around it alone would hand over, too."""
    return df.withColumns({c: F.coalesce(nfc(F.when(F.col(c).rlike(may_change()), F.col(c))), F.col(c)) for c in columns})


def normalised_values(values: Column) -> Column:
    """An array of strings in normal form C."""
    return F.coalesce(nfc_each(F.when(F.exists(values, lambda v: F.coalesce(v.rlike(may_change()), F.lit(False))), values)), values)


def quote_holds(quote: Column, text: Column) -> Column:
    """The verbatim rule: a quote isn't empty and occurs in its chunk."""
    return (F.length(quote) > 0) & F.contains(text, quote)


def justified(justifications: Column, quote: Column) -> Column:
    """Every justification that is there isn't empty and occurs in the quote."""
    return F.forall(F.map_values(justifications), lambda v: (F.length(v) > 0) & F.contains(quote, v))


def fill_spans(citations: DataFrame, chunks: DataFrame) -> DataFrame:
    """id and span of the citations whose span is missing and whose quote occurs exactly once in their chunk, and n_found of
    all that need one. citations: id, chunk_id, span, quote; chunks: id, text."""
    needed = citations.filter(needs_span(F.col("span"))).select("id", "quote", F.col("chunk_id"))
    got = needed.join(chunks.select(F.col("id").alias("chunk_id"), "text"), "chunk_id", "left").withColumn("starts", find_all(F.col("text"), F.col("quote")))
    n = F.coalesce(F.size("starts"), F.lit(0))
    n = F.when(n < 0, 0).otherwise(n)
    return got.select("id", F.when(n == 1, F.array(F.col("starts")[0], F.col("starts")[0] + F.length("quote"))).alias("span"), n.alias("n_found"))


def needs_span(span: Column) -> Column:
    """A citation's span that is null, of another length than two, holds a null, or is empty at 0."""
    return span.isNull() | (F.size(span) != 2) | F.exists(span, lambda x: x.isNull()) | ((F.try_element_at(span, F.lit(1)) == 0) & (F.try_element_at(span, F.lit(2)) == 0))


def aligned(text: Column, start: Column, end: Column, quote: Column) -> Column:
    """Whether a span lies in the text and cuts out the quote."""
    return (start >= 0) & (start <= end) & (end <= F.length(text)) & (F.substring(text, start + 1, end - start) == quote)


def rendered(chunked: DataFrame, key: str = "doc_id") -> DataFrame:
    """A document's chunks in order as one Markdown text."""
    ordered = F.sort_array(F.collect_list(F.struct("paragraph_start", "paragraph_end", "text")))
    block = lambda c: F.concat(F.lit("## "), c["paragraph_start"].cast("string"), F.lit("-"), c["paragraph_end"].cast("string"), F.lit("\n\n```\n"), c["text"], F.lit("\n```"))
    return chunked.groupBy(key).agg(F.array_join(F.transform(ordered, block), "\n\n").alias("markdown"))
