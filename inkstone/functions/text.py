"""Column functions on strings, JSON and hashes."""

from __future__ import annotations

import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

PARAGRAPHS = r"\r?\n+"
EDGE = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def strip(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(text, EDGE, "")


def paragraphs(text: Column) -> Column:
    """Non-empty stripped parts between line ends; null gives no parts."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), PARAGRAPHS), strip), lambda p: p != "")


def count_term(text: Column, term: Column) -> Column:
    """How often a term occurs without overlap."""
    return ((F.length(text) - F.length(F.replace(text, term, F.lit("")))) / F.length(term)).cast("long")


def find_all(text: Column, quote: Column) -> Column:
    """Every offset (from 0) at which the quote occurs, overlaps included; none for an empty quote or nulls. No SQL
    function gives all offsets in one pass over a text, so a vectorised one does."""
    @F.pandas_udf("array<int>")
    def offsets(texts: pd.Series, quotes: pd.Series) -> pd.Series:
        def of(t: str | None, q: str | None) -> list[int]:
            out, at = [], t.find(q) if t and q else -1
            while at >= 0:
                out.append(at)
                at = t.find(q, at + 1)
            return out

        return pd.Series([of(t, q) for t, q in zip(texts, quotes, strict=True)], dtype=object)

    return offsets(text, quote)


def snippet(text: Column, start: Column, length: Column, around: int = 20) -> Column:
    """A quote in brackets with its surroundings on one line."""
    left = F.greatest(start - around, F.lit(0))
    got = F.concat(
        F.when(left > 0, "…").otherwise(""), F.substring(text, left + 1, start - left), F.lit("【"), F.substring(text, start + 1, length), F.lit("】"),
        F.substring(text, start + length + 1, F.lit(around)), F.when(start + length + around < F.length(text), "…").otherwise(""),
    )
    return F.replace(got, F.lit("\n"), F.lit(" ⏎ "))


def slug(name: Column) -> Column:
    """Lower-case words joined by hyphens, for ids; of a name without any, the first 8 hex digits of its hash."""
    words = F.lower(F.regexp_replace(F.regexp_replace(name, r"[^\p{L}\p{N}_]+", "-"), "^-+|-+$", ""))
    return F.when(words == "", hash_hex(name, 8)).otherwise(words)


def hash_hex(text: Column, length: int = 16) -> Column:
    return F.substring(F.sha2(text, 256), 1, length)


def json_text(text: Column) -> Column:
    """A JSON string literal: quotes, backslashes and control characters escaped, hex digits in lower case."""
    got = F.concat(F.lit('"'), F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    escaped = got
    for i in range(32):
        escaped = F.replace(escaped, F.lit(chr(i)), F.lit(json.dumps(chr(i))[1:-1]))
    return F.when(got.rlike(r"[\x00-\x1f]"), escaped).otherwise(got)


def fingerprint(name: Column, variants: Column) -> Column:
    """16 hex digits that the name and the set of variants, in any order, determine."""
    names = F.array_join(F.transform(F.array_sort(F.array_distinct(variants)), json_text), ", ")
    return F.substring(F.sha1(F.concat(F.lit('{"name": '), json_text(name), F.lit(', "variants": ['), names, F.lit("]}"))), 1, 16)


def last_segment(identifier: Column) -> Column:
    return F.substring_index(identifier, ":", -1)


def json_int(text: Column, path: str) -> Column:
    """A whole number inside JSON; null for malformed JSON, JSON null and other values."""
    return F.get_json_object(text, path).try_cast("int")


def json_equal(a: Column, b: Column) -> Column:
    """Whether two JSON texts have one value, key order aside; malformed ones compare as text."""
    canonical = lambda x: F.coalesce(F.to_json(F.try_parse_json(x)), x)
    return canonical(a).eqNullSafe(canonical(b))


def first_failure(*rules: tuple[Column, str]) -> Column:
    """The message of the first rule that doesn't hold (null counts as not), or null."""
    return F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(message)) for ok, message in rules))


def split_list(text: Column) -> Column:
    """The trimmed, non-empty parts of a list with commas."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def chapter_code(chapter: Column) -> Column:
    """A chapter's number with two digits at least."""
    return F.format_string("ch%02d", chapter)


def run_id(stage: str, chapter: Column, version: str, at: Column) -> Column:
    """A run's id, with its start in the session's time zone (UTC)."""
    return F.concat(F.lit(f"run:{stage}-ch"), chapter.cast("string"), F.lit(f"-{version}-"), F.date_format(at, "yyyyMMdd'T'HHmmss"))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
