"""Tables of the library: schemas, versions, exports, and cutting lineage."""

from __future__ import annotations

import json
import os
import subprocess
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VARIANT = "array<struct<variant:string,kind:string>>"
DATE = "struct<year_bce:int,year_bce_end:int,uncertainty:string,original:string,era:string,inference_kind:string,relative_anchor_event_id:string>"
SCHEMAS = {
    "documents": "id string, corpus string, title string, chapter_num int, chapter_title string, raw_text string, source_edition string, ingested_at timestamp",
    "chunks": "id string, document_id string, paragraph_start int, paragraph_end int, text string, hash string",
    "citations": "id string, chunk_id string, paragraph int, span array<int>, quote string",
    "persons": f"id string, canonical_name string, gender string, social_category string, birth_date {DATE}, death_date {DATE}, state_id string, clan_name string, confidence double, provenance string",
    "person_variants": "person_id string, variant string, kind string",
    "events": f"id string, type string, date {DATE}, outcome string, summary string, primary_place_id string, confidence double, provenance string",
    "places": "id string, name string, type string, lat double, lon double, coord_confidence double, modern_equiv string, confidence double",
    "states": f"id string, name string, type string, ruling_clan string, founded_date {DATE}, ended_date {DATE}, confidence double",
    "event_participants": "event_id string, person_id string, role string, role_detail string, confidence double",
    "event_places": "event_id string, place_id string, role string, confidence double",
    "event_relations": "from_event_id string, to_event_id string, kind string, confidence double",
    "person_relations": f"from_person_id string, to_person_id string, kind string, relation_detail string, from_date {DATE}, to_date {DATE}, confidence double",
    "person_states": f"person_id string, state_id string, role string, from_date {DATE}, to_date {DATE}, confidence double",
    "entity_citations": "entity_kind string, entity_id string, citation_id string",
    "audit_log": "id string, seq long, entity_kind string, entity_id string, field string, change_kind string, before_json string, after_json string, at timestamp",
    "conflicts": "id string, entity_kind string, entity_id string, field string, variants_json string, best_idx int, status string",
    "merge_candidates": "id string, target_id string, candidate_id string, score double, surface_features_json string, status string, created_at timestamp",
    "rejected_merges": "canonical_id string, fingerprint string",
    "pipeline_runs": "id string, stage string, scope_json string, stats_json string, started_at timestamp",
    "qa_samples": "run_id string, record_kind string, record_id string, field string, verdict string",
}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def shared_folder(spark: SparkSession) -> str:
    """A new folder's name below spark.checkpoint.dir, which all executors share; it is deleted when the driver ends. Where none is set, a
    local session gets a temporary one, and a cluster an error."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        top = f"file://{tempfile.mkdtemp(prefix='inkstone-')}"
        spark.conf.set("spark.checkpoint.dir", top)
    folder = f"{top.rstrip('/')}/inkstone-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def settled(df: DataFrame) -> DataFrame:
    """df, written as a table to a shared folder and read again: cuts lineage, survives lost executors, and its size is known to
    later joins."""
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def read_books(spark: SparkSession, path: str, corpus: str) -> DataFrame:
    """Chapters of JSON books ({title, chapters: [{title, content}]}) as documents: ids count chapters from 1."""
    raw = spark.read.schema("title string, chapters array<struct<title:string,content:string>>").json(path, multiLine=True)
    return raw.select(F.col("title"), F.posexplode("chapters").alias("i", "c")).select(
        F.concat(F.lit(f"{corpus}:"), F.col("i") + 1).alias("id"), F.lit(corpus).alias("corpus"), "title", (F.col("i") + 1).cast("int").alias("chapter_num"),
        F.coalesce("c.title", F.concat(F.lit("Chapter "), F.col("i") + 1)).alias("chapter_title"), F.col("c.content").alias("raw_text"),
    )


def read_yaml(spark: SparkSession, paths: Iterable[str], schema: str) -> DataFrame:
    """Lists of mappings in YAML files, small files of curated rows that the driver reads."""
    import yaml

    rows = []
    for path in paths:
        with open(path, encoding="utf-8") as f:
            got = yaml.safe_load(f) or []
        if not isinstance(got, list):
            raise ValueError(f"{path} has no list at its top")
        rows += got
    made = spark.createDataFrame([(json.dumps(r, ensure_ascii=False, default=str),) for r in rows], "j string")
    return made.select(F.from_json("j", schema).alias("r")).select("r.*")


GOLDEN = {
    "persons": "id string, canonical_name string, variants array<struct<variant:string,kind:string>>, gender string, social_category string, state_id string, notes string, citations array<string>",
    "events": f"id string, type string, date {DATE}, outcome string, summary string, primary_place_id string, citations array<string>",
    "places": "id string, name string, type string, lat double, lon double, coord_confidence double, modern_equiv string, citations array<string>",
    "states": f"id string, name string, type string, ruling_clan string, founded_date {DATE}, citations array<string>",
    "citations": "id string, chunk_id string, paragraph int, span array<int>, quote string",
    "relations": "id string, kind string, event_id string, person_id string, place_id string, state_id string, from_event_id string, to_event_id string, from_person_id string, to_person_id string, role string, relation_kind string, citation_id string",
}


def read_golden(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six tables of a chapter's folder of golden YAML lists; a file that isn't there is an empty table, and a missing
    folder or a file without a list at its top raises."""
    if not os.path.isdir(folder):
        raise ValueError(f"no such folder: {folder}")
    path = lambda name: f"{folder}/{name}.yaml"
    return {name: read_yaml(spark, [path(name)] if os.path.exists(path(name)) else [], schema) for name, schema in GOLDEN.items()}


def read_merge_pairs(spark: SparkSession, path: str) -> DataFrame:
    """pos, same (boolean), rationale, source, person_a and person_b of a YAML mapping with same_person_pairs and different_person_pairs."""
    import yaml

    with open(path, encoding="utf-8") as f:
        got = yaml.safe_load(f) or {}
    rows = []
    for key, same in (("same_person_pairs", True), ("different_person_pairs", False)):
        if not isinstance(got, dict) or not isinstance(got.get(key), list):
            raise ValueError(f"{path} has no list {key}")
        for pos, pair in enumerate(got[key]):
            if not isinstance(pair, dict) or any(k not in pair for k in ("person_a", "person_b")):
                raise ValueError(f"{path}: {key}[{pos}] has no two persons")
            rows.append((pos, same, json.dumps(pair, ensure_ascii=False, default=str)))
    person = "struct<canonical_name:string,variants:array<string>,state_id:string,clan_name:string,social_category:string,birth_bce:int,death_bce:int>"
    made = spark.createDataFrame(rows, "pos int, same boolean, j string")
    return made.select("pos", "same", F.from_json("j", f"rationale string, source string, person_a {person}, person_b {person}").alias("r")).select("pos", "same", "r.*")


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """record_kind, record_id, field and verdict of a YAML list, or of JSON lines."""
    schema = "record_kind string, record_id string, field string, verdict string"
    return read_yaml(spark, [path], schema) if path.endswith((".yaml", ".yml")) else spark.read.schema(schema).json(path)


def changed_files(spark: SparkSession, folder: str, base: str) -> DataFrame:
    """path of each file that a Git work tree has changed since `base`."""
    got = subprocess.run(["git", "-C", folder, "diff", "--name-only", base], capture_output=True, text=True, check=True)
    return spark.createDataFrame([(line,) for line in got.stdout.splitlines() if line], "path string")


def copy_texts(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copies chapters' texts (ch<number>.md) below a folder to another, and gives their names in order."""
    texts = spark.read.format("binaryFile").option("pathGlobFilter", "ch[0-9]*.md").load(source)
    conf, context = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs
    names = [r[0] for r in texts.select("path").orderBy("path").collect()]  # one a chapter
    for name in names:
        a, b = context.Path(name), context.Path(f"{target}/{name.rsplit('/', 1)[-1]}")
        context.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, conf)
    return spark.createDataFrame([(n.rsplit("/", 1)[-1],) for n in names], "name string")


def dump_yaml(rows: DataFrame, path: str) -> int:
    """A bounded sample as a YAML list."""
    import yaml

    got = [r.asDict(recursive=True) for r in rows.collect()]
    with open(path, "w", encoding="utf-8") as f:
        yaml.safe_dump(got, f, allow_unicode=True, sort_keys=False)
    return len(got)


def rulers_from_yaml(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Rulers of other states, one YAML mapping a state."""
    import yaml

    rows = []
    for path in paths:
        with open(path, encoding="utf-8") as f:
            got = yaml.safe_load(f)
        rows += [(got["state_id"], r["id"], r.get("posthumous_name"), r.get("given_name"), r["reign_start_bce"], r["reign_end_bce"]) for r in got.get("rulers", [])]
    return spark.createDataFrame(rows, "state_id string, ruler_id string, posthumous_name string, given_name string, reign_start_bce int, reign_end_bce int")


def read_frontmatter(spark: SparkSession, path: str) -> DataFrame:
    """path, key and values of the frontmatter of Markdown files: scalars, [a, b] lists and indented lists."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.regexp_extract("value", r"(?s)\A---\r?\n(.*?)\r?\n---", 1).alias("head"))
    entry = text.select("path", F.explode(F.regexp_extract_all("head", F.lit(r"(?m)^([A-Za-z_][\w-]*:.*(?:\n[ \t]+.*|\n- .*)*)"), F.lit(1))).alias("entry"))
    key, rest = F.regexp_extract("entry", r"^([\w-]+):", 1), F.regexp_replace("entry", r"^[\w-]+:[ \t]*", "")
    items = F.when(rest.startswith("["), F.split(F.regexp_replace(rest, r"^\[|\]\s*$", ""), ",")).when(rest.contains("\n"), F.split(F.regexp_replace(rest, r"^\s*-?\s*", ""), r"\n\s*-\s*")).otherwise(F.array(rest))
    clean = F.filter(F.transform(items, lambda x: F.regexp_replace(F.trim(x), "^[\"']|[\"']$", "")), lambda x: x != "")
    return entry.select("path", key.alias("key"), clean.alias("values"))


def export(tables: dict[str, DataFrame], folder: str, version: str, book: dict, generated_at: str, left_out: tuple[str, ...] = ("candidate_", "llm_cache")) -> dict:
    """Writes a version: every table but staging ones as Parquet, then its manifest as JSON text, last, so that a version
    with a manifest is complete. Returns the manifest."""
    counts = {}
    spark = next(iter(tables.values())).sparkSession
    for name, df in sorted(tables.items()):
        if not name.startswith(left_out):
            df.write.mode("overwrite").parquet(f"{folder}/{version}/{name}.parquet")
            counts[name] = read(spark, f"{folder}/{version}", name).count()
    manifest = {"version": version, "schema_version": 2, "generated_at": generated_at, "book": book, "counts": counts}
    spark.createDataFrame([(json.dumps(manifest, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/{version}/manifest")
    return manifest
