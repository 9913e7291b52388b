"""The command line: python -m inkstone.cli VERB ... Tables are Parquet in a folder; each verb writes new ones."""

from __future__ import annotations

import argparse
import datetime
import functools
import json
import sys
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstone.functions.reign_dates import DATE, STATES
from inkstone.functions.text import fingerprint, json_int, last_segment
from inkstone.operators import articles, corpus, curation, evaluation, golden, linking, loading, merging, timeline, validation
from inkstone.sources import extractions, storage


def ingest(spark: SparkSession, a: argparse.Namespace) -> None:
    storage.read_books(spark, a.json, a.corpus).write.mode("overwrite").parquet(f"{a.folder}/documents.parquet")


def chunk(spark: SparkSession, a: argparse.Namespace) -> None:
    docs = storage.read(spark, a.folder, "documents").select(F.col("id").alias("document_id"), F.col("raw_text").alias("text"))
    got = corpus.chunks(docs, a.target, a.overlap, key="document_id")
    got.withColumn("id", F.concat(F.lit("chk:"), "document_id", F.lit(":"), "paragraph_start")).write.mode("overwrite").parquet(f"{a.folder}/chunks.parquet")


def discover(spark: SparkSession, a: argparse.Namespace) -> None:
    chunks = storage.read(spark, a.folder, "chunks")
    found = corpus.discover_terms(chunks, STATES, "document_id", least=a.least)
    rows = corpus.term_places(chunks, STATES, "document_id").select("term_id", "place").join(found.select("term_id", "n"), "term_id").orderBy(F.desc("n"), "term_id", "place")
    for (term, n), places in groupby(rows.toLocalIterator(), lambda r: (r["term_id"], r["n"])):
        print(term, n, ",".join(r["place"] for r in places), sep="\t")


def link(spark: SparkSession, a: argparse.Namespace) -> None:
    cand, known = (storage.read(spark, a.folder, n) for n in ("candidate_persons", "linkable_persons"))
    best = storage.settled(linking.best_targets(cand, known))
    rejected = storage.empty(spark, "rejected_merges").withColumnRenamed("canonical_id", "target") if a.ignore_rejections else storage.read(spark, a.folder, "rejected_merges").withColumnRenamed("canonical_id", "target")
    opened = storage.read(spark, a.folder, "merge_candidates").filter("status = 'open'").select(F.col("target_id").alias("target"), F.col("candidate_id").alias("cand"))
    got = linking.dispatch(cand.withColumn("fingerprint", fingerprint(F.col("canonical_name"), F.col("variants"))), best, rejected, opened, linking.skipped_siblings(best))
    got.write.mode("overwrite").parquet(f"{a.folder}/link_actions.parquet")
    storage.read(spark, a.folder, "link_actions").groupBy("action").count().orderBy("action").show()


def _put(df: DataFrame, folder: str, name: str) -> None:
    """A table's new version in place of the one that it is made from."""
    storage.settled(df).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def _table(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """A table, or an empty one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return storage.read(spark, folder, name)
    return spark.createDataFrame([], schema)


LOADED = {
    "persons": "id string, canonical_name string, gender string, birth_date_json string, death_date_json string, notes string, state_id string, clan_name string, social_category string, confidence double, provenance string, run string",
    "events": "id string, type string, outcome string, summary string, primary_place_id string, date_json string, confidence double, provenance string",
    "places": "id string, name string, type string, lat double, lon double, coord_confidence double, modern_equiv string, confidence double",
    "states": "id string, name string, type string, ruling_clan string, founded_date_json string, ended_date_json string, confidence double",
    "person_variants": "id string, person_id string, variant string, kind string", "entity_citations": "entity_kind string, entity_id string, citation_id string",
    "audit_log": "entity_kind string, entity_id string, field string, change_kind string, before_json string, after_json string, at timestamp, seq long, run string",
    "conflicts": "id string, entity_kind string, entity_id string, field string, variants_json string, best_idx int, resolution_rule string, status string",
    "pipeline_runs": "id string, stage string, scope_json string, stats_json string, started_at timestamp",
    "event_participants": "event_id string, person_id string, role string, role_detail string, confidence double, provenance string", "event_places": "event_id string, place_id string, role string, confidence double, provenance string",
    "event_relations": "from_event_id string, to_event_id string, kind string, confidence double, provenance string",
    "person_relations": "from_person_id string, to_person_id string, kind string, date_json string, confidence double, provenance string",
    "person_states": "person_id string, state_id string, role string, from_date_json string, to_date_json string, confidence double, provenance string",
}


def extract(spark: SparkSession, a: argparse.Namespace) -> None:
    """What has to be there before a chapter is extracted by hand: its document, its chunks, their texts, and no file yet."""
    docs = storage.read(spark, a.folder, "documents").filter(F.col("chapter_num") == a.chapter)
    chunks = storage.read(spark, a.folder, "chunks").join(docs.select(F.col("id").alias("document_id")), "document_id", "left_semi")
    got = {"documents": docs.count(), "chunks": chunks.count(), "empty chunks": chunks.filter("length(text) = 0").count()}
    print(json.dumps({"chapter": a.chapter, **got}))
    sys.exit(got["documents"] != 1 or got["chunks"] < a.least or got["empty chunks"] > 0)


def extract_load(spark: SparkSession, a: argparse.Namespace) -> None:
    """Checks an extraction's files against the chunks and writes candidates; what fails is printed and left out."""
    run = a.run or f"run:extract-ch{a.chapter}-{a.prompt_version}-{datetime.datetime.now(datetime.UTC):%Y%m%dT%H%M%S}"
    parts = extractions.read_extractions(spark, a.file, run)
    if problems := parts["problems"].orderBy("path").limit(20).collect():
        sys.exit("\n".join(f"{r['path']}: {r['error']}" for r in problems))
    if broken := storage.settled(extractions.broken_rules(parts)).orderBy("kind", "id", "field").limit(20).collect():
        sys.exit("\n".join(f"schema: {r['kind']}/{r['id']}: {r['field']}: {r['rule']}" for r in broken))
    got = extractions.extraction_candidates(parts, storage.read(spark, a.folder, "chunks"), run)
    stats, violations = got.pop("stats"), storage.settled(got.pop("violations"))
    for name, df in got.items():
        old = _table(spark, a.folder, name, df.schema)
        _put(old.filter(F.col("run") != run).unionByName(df), a.folder, name)
    counts = {r["kind"]: r["n"] for r in stats.collect()}
    _put(_table(spark, a.folder, "pipeline_runs", LOADED["pipeline_runs"]).filter(F.col("id") != run).unionByName(
        spark.createDataFrame([(run, "extract-load", json.dumps({"chapter": a.chapter}), json.dumps(counts))], "id string, stage string, scope_json string, stats_json string").withColumn("started_at", F.current_timestamp())
    ), a.folder, "pipeline_runs")
    print(f"pipeline_run_id: {run}")
    print("written:", *(f"{k}={n}" for k, n in counts.items()))
    if n := violations.count():
        print(f"invariant violations: {n}", *(f"  - {r['kind']} {r['id']}: {r['violation']}" for r in violations.orderBy("kind", "id").limit(10).collect()), sep="\n")


def load(spark: SparkSession, a: argparse.Namespace) -> None:
    """Candidates of a run into places, states, persons, events and relations, in this order."""
    candidates = lambda kind: storage.read(spark, a.folder, f"candidate_{kind}").filter(F.col("run") == a.run)
    tables = {name: _table(spark, a.folder, name, schema) for name, schema in LOADED.items()}
    written = {}
    local = lambda df, key: df.select("run", last_segment(F.col("id")).alias("local_id"), F.col(key).alias("id"))
    ids = {}
    appended: dict[str, list[DataFrame]] = {}
    for kind in ("place", "state"):
        own = candidates(f"{kind}s")
        got = loading.load_named(kind, own.withColumn("seq", F.monotonically_increasing_id()), tables)
        ids[f"{kind}s"] = local(own.join(got["ids"], "id"), "entity_id")
        before, tables[f"{kind}s"] = tables[f"{kind}s"], storage.settled(got[f"{kind}s"])
        written[f"{kind}s"] = tables[f"{kind}s"].count() - before.count()
        for name in ("entity_citations", "audit_log"):
            appended.setdefault(name, []).append(got[name])
    people = candidates("persons")
    got = loading.load_persons(validation.resolve_ids(people, "state_id", ids["states"]), tables, a.run)
    ids["persons"] = local(people.join(got["ids"], "id"), "person_id")
    results = {"persons": got["persons"].withColumn("run", F.lit(a.run))}
    old = tables["persons"].select("id", F.col("run").alias("_run"))
    tables["persons"] = results["persons"].join(old, "id", "left").withColumn("run", F.coalesce("_run", "run")).select(*tables["persons"].columns)
    for name in ("person_variants", "entity_citations", "audit_log", "conflicts"):
        appended.setdefault(name, []).append(got[name])
    events = candidates("events")
    got = loading.load_events(validation.resolve_ids(events, "primary_place_id", ids["places"]), tables, a.run)
    ids["events"] = local(events.join(got["ids"], "id"), "event_id")
    tables["events"] = got["events"]
    for name in ("entity_citations", "audit_log", "conflicts"):
        appended[name].append(got[name])
    kinds = {"event_id": "events", "person_id": "persons", "place_id": "places", "state_id": "states", "from_event_id": "events", "to_event_id": "events", "from_person_id": "persons", "to_person_id": "persons"}
    for name, (key, *_) in loading.EDGES.items():
        own = candidates(name)
        for end in (k for k in key if k in kinds):
            own = validation.resolve_ids(own, end, ids[kinds[end]])
        got = loading.load_relations(name, own, tables, a.run)
        for other, rows in got.items():
            appended.setdefault(other, []).append(rows)
    for name, rows in appended.items():
        new = functools.reduce(DataFrame.unionByName, rows)
        if name == "audit_log":
            new = new.withColumns({"at": F.current_timestamp(), "seq": F.monotonically_increasing_id(), "run": F.lit(a.run)})
        tables[name] = tables[name].unionByName(new.select(*tables[name].columns)) if name != "conflicts" else tables[name].unionByName(new.join(tables[name].select("id"), "id", "left_anti").select(*tables[name].columns))
    for name, df in {n: storage.settled(tables[n]) for n in LOADED if n != "pipeline_runs"}.items():  # all are made before any is replaced
        df.write.mode("overwrite").parquet(f"{a.folder}/{name}.parquet")
        written[name] = df.count()
    print(json.dumps(written))


def list_unresolved_dates(spark: SparkSession, a: argparse.Namespace) -> None:
    """Events whose date is relative and has no year."""
    events = storage.read(spark, a.folder, "events")
    open_ = events.filter((F.get_json_object("date_json", "$.inference_kind") == "relative_to_prior_event") & json_int(F.col("date_json"), "$.year_bce").isNull())
    for r in timeline.numbered(open_, ["id"]).orderBy("place").toLocalIterator():
        print(r["place"], r["id"], r["type"], r["date_json"], sep="\t")


def resolve_relative_date(spark: SparkSession, a: argparse.Namespace) -> None:
    """An event's year as so many years after another event's, with an audit entry."""
    events = storage.read(spark, a.folder, "events")
    flat = events.select("id", json_int(F.col("date_json"), "$.year_bce").alias("year_bce"), F.get_json_object("date_json", "$.relative_anchor_event_id").alias("relative_anchor_event_id"))
    decided = spark.createDataFrame([(a.event, a.anchor, a.years_later)], "event_id string, anchor_id string, later int")
    moved, audit, refused = curation.resolve_dates(flat, decided)
    if refused.count() or not flat.filter(F.col("id") == a.event).count():
        sys.exit(f"no dated anchor for {a.event}: {a.anchor}")
    new = storage.settled(moved.filter(F.col("id") == a.event).select("id", "year_bce", "relative_anchor_event_id"))
    date = F.from_json("date_json", DATE)
    changed = events.join(new, "id", "left").withColumn("date_json", F.when(F.col("id") == a.event, F.to_json(date.withField("year_bce", F.col("year_bce")).withField("relative_anchor_event_id", F.col("relative_anchor_event_id")))).otherwise(F.col("date_json")))
    log = _table(spark, a.folder, "audit_log", LOADED["audit_log"])
    _put(log.unionByName(audit.withColumns({"at": F.current_timestamp(), "seq": F.lit(0).cast("long"), "run": F.lit(None).cast("string")})), a.folder, "audit_log")
    _put(changed.select(*events.columns), a.folder, "events")
    print(a.event, new.first()["year_bce"], sep="\t")


def qa_sample(spark: SparkSession, a: argparse.Namespace) -> None:
    """A run's sample of facts as YAML."""
    fields = {"persons": ["canonical_name", "gender", "social_category"], "events": ["type", "outcome", "summary"], "places": ["name", "type"], "states": ["name", "type"]}
    rows = None
    for kind, own in fields.items():
        df = _table(spark, a.folder, f"candidate_{kind}", "id string, run string, " + ", ".join(f"{f} string" for f in own))
        got = evaluation.facts(df.filter(F.col("run") == a.run), kind[:-1], "id", own)
        rows = got if rows is None else rows.unionByName(got)
    print(storage.dump_yaml(evaluation.qa_sample(rows, a.run).orderBy("n"), a.out), "facts")


def smoke_check(spark: SparkSession, a: argparse.Namespace) -> None:
    tables = {name: _table(spark, a.folder, name, LOADED[name]) for name in ("pipeline_runs", "persons", "events", "event_participants", "person_relations")}
    got = evaluation.smoke_check(a.run, tables).first().asDict()
    print(json.dumps(got, ensure_ascii=False))
    sys.exit(got["status"] != "pass")


def golden_eval(spark: SparkSession, a: argparse.Namespace) -> None:
    """Precision and recall of a run's five kinds against a chapter's golden lists; exits with 1 below the gates."""
    known = storage.read_golden(spark, a.golden)
    names = lambda c: F.transform(c, lambda v: v["variant"])
    own = lambda kind: storage.read(spark, a.folder, f"candidate_{kind}").filter(F.col("run") == a.run)
    local = lambda c: F.when(F.col(c).startswith("cand:"), last_segment(F.col(c))).otherwise(F.col(c)).alias(c)
    given = F.from_json("variants_json", "array<struct<variant:string,kind:string>>")
    golden_side = known | {
        "persons": known["persons"].select("id", "canonical_name", names(F.col("variants")).alias("variants"), "state_id", "social_category"),
        "events": known["events"].select("id", "type", F.col("date.year_bce").alias("year_bce"), "primary_place_id"),
    }
    ends = list(golden.RELATION_ENDS)
    relations = None
    for kind, table in (("event_participant", "event_participants"), ("event_place", "event_places"), ("event_relation", "event_relations"), ("person_relation", "person_relations"), ("person_state", "person_states")):
        rows = own(table)
        has = lambda c: local(c) if c in rows.columns else F.lit(None).cast("string").alias(c)  # noqa: B023, E731
        detail = F.col("kind") if "kind" in rows.columns else F.lit(None).cast("string")
        role = F.col("role") if "role" in rows.columns else F.lit(None).cast("string")
        rows = rows.select(F.lit(kind).alias("kind"), *map(has, ends), role.alias("role"), detail.alias("relation_kind"))
        relations = rows if relations is None else relations.unionByName(rows)
    found = {
        "persons": own("persons").select(local("id"), "canonical_name", names(given).alias("variants"), local("state_id"), "social_category"),
        "events": own("events").select(local("id"), "type", json_int(F.col("date_json"), "$.year_bce").alias("year_bce"), local("primary_place_id")),
        "places": own("places").select(local("id"), "name"), "states": own("states").select(local("id"), "name"), "relations": relations,
    }
    rows = golden.evaluated(golden_side, found).orderBy("kind").collect()
    for r in rows:
        print(json.dumps(r.asDict()))
    sys.exit(not all(r["passed"] for r in rows))


def qa_load(spark: SparkSession, a: argparse.Namespace) -> None:
    print(json.dumps(evaluation.mismatch(storage.read_verdicts(spark, a.verdicts)).first().asDict()))


def export(spark: SparkSession, a: argparse.Namespace) -> None:
    tables = {n: storage.read(spark, a.folder, n) for n in a.tables}
    print(json.dumps(storage.export(tables, a.out, a.version, {"id": a.book_id}, datetime.datetime.now(datetime.UTC).isoformat(timespec="seconds")), ensure_ascii=False))


def drift(spark: SparkSession, a: argparse.Namespace) -> None:
    changed = storage.changed_files(spark, a.folder, a.base) if a.base else spark.createDataFrame([(line.strip(),) for line in sys.stdin if line.strip()], "path string")
    rows = articles.drift(articles.mapping_rows(spark.read.text(a.mapping, wholetext=True)), changed).orderBy("article_path", "code_pattern", "path")
    stale = False
    for (article, pattern), files in groupby(rows.toLocalIterator(), lambda r: (r["article_path"], r["code_pattern"])):
        stale = True
        print(article, pattern, ",".join(r["path"] for r in files), sep="\t")
    sys.exit(stale)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="inkstone")
    verbs = top.add_subparsers(dest="verb", required=True)

    def verb(f, *options: tuple[str, dict], name: str | None = None) -> None:
        own = verbs.add_parser(name or f.__name__.replace("_", "-"))
        own.add_argument("folder")
        for name, how in options:
            own.add_argument(name, **how)
        own.set_defaults(act=f)

    verb(ingest, ("json", {}), ("--corpus", {"default": "book"}))
    verb(chunk, ("--target", {"type": int, "default": 1800}), ("--overlap", {"type": int, "default": 200}))
    verb(discover, ("--least", {"type": int, "default": 1}))
    verb(link, ("--ignore-rejections", {"action": "store_true"}))
    verb(qa_load, ("verdicts", {}))
    verb(extract, ("--chapter", {"type": int, "required": True}), ("--least", {"type": int, "default": 1}))
    for name in ("extract-load", "re-extract"):
        verb(extract_load, ("file", {}), ("--chapter", {"type": int, "required": True}), ("--prompt-version", {"default": "v1"}), ("--run", {}), name=name)
    for f in (load, smoke_check):
        verb(f, ("run", {}))
    verb(list_unresolved_dates)
    verb(resolve_relative_date, ("event", {}), ("anchor", {}), ("--years-later", {"type": int, "default": 0}))
    verb(qa_sample, ("run", {}), ("out", {}))
    verb(golden_eval, ("run", {}), ("golden", {}))
    verb(export, ("out", {}), ("version", {}), ("tables", {"nargs": "+"}), ("--book-id", {"default": "book"}))
    verb(drift, ("mapping", {}), ("--base", {}))
    return top


def main(args: list[str] | None = None) -> None:
    a = parser().parse_args(args)
    a.act(SparkSession.builder.appName("inkstone").getOrCreate(), a)


if __name__ == "__main__":
    main()
