"""The curator's queue and decisions, as new rows and new versions; cached answers; needs of spans."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkstone.operators.corpus import needs_span  # noqa: F401  a rule of the curator's lists, too
from inkstone.operators.rows import first_rows, last_rows
from inkstone.operators.timeline import numbered


def open_queue(merge_candidates: DataFrame) -> DataFrame:
    """Open merge candidates, the oldest first, each with its place and the ids before and after it."""
    queue = numbered(merge_candidates.filter("status = 'open'"), ["created_at", "id"])
    at = lambda name, by: queue.select((F.col("place") + by).alias("place"), F.col("id").alias(name))
    return queue.join(at("previous_id", 1), "place", "left").join(at("next_id", -1), "place", "left").select(*merge_candidates.columns, "place", "previous_id", "next_id")


def decide(merge_candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """Statuses after decisions (id, status: merged or rejected); only open ones change, so of several
    decisions on one the first counts, by seq."""
    new = first_rows(decisions.filter(F.col("status").isin("merged", "rejected")), ["id"]).select("id", F.col("status").alias("_status"))
    got = merge_candidates.join(new, "id", "left")
    return got.withColumn("status", F.when((F.col("status") == "open") & F.col("_status").isNotNull(), F.col("_status")).otherwise(F.col("status"))).drop("_status").select(*merge_candidates.columns)


def remembered_rejections(rejected: DataFrame, merge_candidates: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """rejected_merges with the pairs of rejected candidates that it lacks. fingerprints: candidate_id, fingerprint."""
    new = merge_candidates.filter("status = 'rejected'").join(fingerprints, "candidate_id").select(F.col("target_id").alias("canonical_id"), "fingerprint").distinct()
    return rejected.unionByName(new.join(rejected, ["canonical_id", "fingerprint"], "left_anti"))


def edited(rows: DataFrame, edits: DataFrame, allowed: list[str]) -> DataFrame:
    """Rows with single fields replaced: edits (id, field, value) of allowed fields, the last by seq winning; others raise."""
    if other := [r["field"] for r in edits.filter(~F.col("field").isin(allowed)).select("field").distinct().collect()]:
        raise ValueError(f"fields that may not be edited: {', '.join(sorted(other))}")
    one = edits.groupBy("id").pivot("field", allowed).agg(F.max_by("value", "seq"))
    got = rows.join(one.select("id", *(F.col(f).alias(f"_{f}") for f in allowed)), "id", "left")
    return got.select(*(F.coalesce(F.col(f"_{c}").cast(rows.schema[c].dataType), F.col(c)).alias(c) if c in allowed else F.col(c) for c in rows.columns))


def resolve_dates(events: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Years of events (id, year_bce, relative_anchor_event_id) as their anchor's less the years later, after decisions (event_id, anchor_id,
    later; an event's last by seq counts), audit entries of what changed, and the refused event_ids (their anchor is undated, unknown or
    themselves)."""
    anchors = events.select(F.col("id").alias("anchor_id"), F.col("year_bce").alias("_anchor_year"))
    judged = last_rows(decisions, ["event_id"]).join(anchors, "anchor_id", "left").withColumn("_ok", F.col("_anchor_year").isNotNull() & (F.col("event_id") != F.col("anchor_id")))
    good = judged.filter("_ok").select(F.col("event_id").alias("id"), F.col("anchor_id").alias("_anchor"), (F.col("_anchor_year") - F.col("later")).alias("_year"))
    got = events.join(good, "id", "left")
    json_of = lambda year, anchor: F.to_json(F.struct(year.alias("year_bce"), anchor.alias("relative_anchor_event_id")), {"ignoreNullFields": "false"})
    audit = got.filter("_anchor IS NOT NULL").select(
        F.lit("event").alias("entity_kind"), F.col("id").alias("entity_id"), F.lit("date_json").alias("field"), F.lit("curator_override").alias("change_kind"),
        json_of(F.col("year_bce"), F.col("relative_anchor_event_id")).alias("before_json"), json_of(F.col("_year"), F.col("_anchor")).alias("after_json"),
    )
    moved = got.withColumn("year_bce", F.coalesce("_year", "year_bce")).withColumn("relative_anchor_event_id", F.coalesce("_anchor", "relative_anchor_event_id")).select(*events.columns)
    return moved, audit, judged.filter("NOT _ok").select("event_id")


def cache_key(request: dict) -> Column:
    """The hash of a request's JSON with sorted keys."""
    return F.sha2(F.lit(json.dumps(request, sort_keys=True, ensure_ascii=False)), 256)


def cached(requests: DataFrame, cache: DataFrame, text: str = "request_json") -> DataFrame:
    """Requests with the answer of the cache (the last of a key, by seq), or null, by the hash of their text."""
    return requests.withColumn("key", F.sha2(text, 256)).join(last_rows(cache, ["key"]).select("key", "response_json"), "key", "left")


def audit_rows(changes: DataFrame) -> DataFrame:
    """Audit entries with ids that their content determines, so that a repeated append can be dropped by id."""
    content = F.to_json(F.struct("entity_kind", "entity_id", "field", "change_kind", "before_json", "after_json", "seq"))
    return changes.withColumn("id", F.concat(F.lit("aud:"), F.substring(F.sha2(content, 256), 1, 16)))


def replaced_token(identifier: Column, old: str, new: str) -> Column:
    """A part of composite ids joined by colons, replaced; a part is one field or several in a row, never part of a field."""
    return F.regexp_replace(identifier, rf"(?<=^|:)\Q{old}\E(?=:|$)", new.replace("\\", "\\\\").replace("$", "\\$"))


def around(citations: DataFrame, chunks: DataFrame, paragraphs: int = 1) -> DataFrame:
    """Citations with the chunks of their document within some paragraphs of theirs, in order."""
    own = citations.join(chunks.select(F.col("id").alias("chunk_id"), "document_id"), "chunk_id")
    near = chunks.select("document_id", F.col("id").alias("near_chunk_id"), "paragraph_start", "paragraph_end", F.col("text").alias("near_text"))
    got = own.join(near, "document_id").filter((F.col("paragraph_start") <= F.col("paragraph") + paragraphs) & (F.col("paragraph_end") >= F.col("paragraph") - paragraphs))
    return got.withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy("paragraph_start", "near_chunk_id")))
