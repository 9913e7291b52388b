"""Confidence, deed importance, sampling, precision and recall, checks, coverage, exports' counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkstone.sources.storage import settled

# Parts of a record's confidence; weights of event types and of rarity.
BASE, PER_CHAR, QUOTE_MOST, JUSTIFIED, CEILING = 0.7, 0.01, 0.15, 0.10, 0.95
TYPE_WEIGHTS = {"战": 3.0, "会盟": 3.0, "盟": 2.5, "弑": 3.0, "灭": 3.0, "即位": 2.5, "立": 2.0, "出奔": 2.5, "奔": 2.5, "伐": 2.0, "围": 2.0, "薨": 2.0, "卒": 2.0, "处死": 2.0, "杀": 2.0}
DEFAULT_WEIGHT, SALIENCE = 1.0, 1.5


def confidence(quote: Column, justifications: Column, fields: list[str]) -> Column:
    """Of an extracted record: a base, more for a longer quote and for justifications of all its scalar fields."""
    full = reduce(lambda a, b: a & b, (F.coalesce(F.length(F.try_element_at(justifications, F.lit(f))) > 0, F.lit(False)) for f in fields)) if fields else F.lit(False)
    bonus = F.least(F.length(F.coalesce(quote, F.lit(""))) * PER_CHAR, F.lit(QUOTE_MOST)) + F.when(full, JUSTIFIED).otherwise(0.0)
    return F.least(F.lit(BASE) + bonus, F.lit(CEILING))


def deed_importance(participations: DataFrame, citations: DataFrame, weights: dict[str, float] = TYPE_WEIGHTS) -> DataFrame:
    """event_id, person_id, event_type and importance: a type's weight grows with participants and citations, and with the
    rarity of the type among the person's deeds. participations: event_id, person_id, event_type (a row for each role);
    citations: event_id. Counts are aggregates, joined back to one row a pair."""
    pairs = participations.groupBy("event_id", "person_id").agg(F.min("event_type").alias("event_type"))
    per = lambda name, *keys: participations.groupBy(*keys).agg(F.count("*").alias(name))
    got = pairs.join(per("n_participants", "event_id"), "event_id").join(per("n_deeds", "person_id"), "person_id").join(per("n_of_type", "person_id", "event_type"), ["person_id", "event_type"])
    got = got.join(citations.groupBy("event_id").agg(F.count("*").alias("n_citations")), "event_id", "left")
    weight = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for p in weights.items() for x in p)), F.col("event_type")), F.lit(DEFAULT_WEIGHT)) if weights else F.lit(DEFAULT_WEIGHT)
    shared = weight * (1 + F.log1p("n_participants")) * (1 + F.log1p(F.coalesce("n_citations", F.lit(0))))
    salience = 1 + SALIENCE * F.log1p(F.col("n_deeds") / F.col("n_of_type") - 1)
    return got.withColumn("importance", F.round(shared * salience, 6)).select("event_id", "person_id", "event_type", "importance")


def sample_size(n: Column) -> Column:
    """Five percent and one, between 30 and 250, and no more than there are."""
    return F.least(F.greatest(F.least(F.floor(n * 0.05) + 1, F.lit(250)), F.lit(30)), n)


def facts(entities: DataFrame, kind: str, key: str, fields: list[str]) -> DataFrame:
    """record_kind, record_id, field and value of each field that is set."""
    return entities.select(F.lit(kind).alias("record_kind"), F.col(key).cast("string").alias("record_id"), F.inline(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields)))).filter("value IS NOT NULL")


def qa_sample(rows: DataFrame, run: str) -> DataFrame:
    """A sample that depends on the run's name and the facts alone: the first by hash. rows: as facts() gives."""
    hashed = rows.withColumn("h", F.substring(F.sha2(F.concat_ws("|", F.lit(run), "record_id", "field"), 256), 1, 16))
    size = hashed.agg(sample_size(F.count("*")).alias("k"))
    order = Window.orderBy("h", "record_id", "field")
    most = hashed.orderBy("h", "record_id", "field").limit(250)  # the sample's bound
    return most.withColumn("n", F.row_number().over(order)).join(F.broadcast(size), F.col("n") <= F.col("k")).drop("k", "h")


def mismatch(verdicts: DataFrame, gate: float = 0.10) -> DataFrame:
    """Counts of yes, partial and no, the rate (no + partial / 2) / all, and whether it breaks the gate."""
    n = lambda v: F.coalesce(F.sum((F.col("verdict") == v).cast("long")), F.lit(0)).alias(f"n_{v}")
    got = verdicts.agg(n("yes"), n("partial"), n("no"), F.count("*").alias("n"))
    rate = F.when(F.col("n") == 0, 0.0).otherwise(F.round((F.col("n_no") + 0.5 * F.col("n_partial")) / F.col("n"), 6))
    return got.withColumn("mismatch", rate).withColumn("breached", F.col("mismatch") > gate)


def multiset_pr(golden: DataFrame, found: DataFrame, key: list[str], by: str | None = None) -> DataFrame:
    """tp, fp, fn, precision and recall of rows matched one to one by an equal key; an empty denominator gives 1."""
    group = [by] if by else []
    count = lambda df, name: df.groupBy(*group, *key).agg(F.count("*").alias(name))
    both = count(golden, "g").join(count(found, "c"), [*group, *key], "full").fillna(0, ["g", "c"])
    got = both.groupBy(*group).agg(F.sum(F.least("g", "c")).alias("tp"), F.sum("g").alias("n_golden"), F.sum("c").alias("n_found"))
    ratio = lambda d: F.when(F.col(d) == 0, 1.0).otherwise(F.round(F.col("tp") / F.col(d), 6))
    return got.select(*group, "tp", (F.col("n_found") - F.col("tp")).alias("fp"), (F.col("n_golden") - F.col("tp")).alias("fn"), ratio("n_found").alias("precision"), ratio("n_golden").alias("recall"))


def greedy_matches(pairs: DataFrame, group: str | list[str], golden: str, found: str) -> DataFrame:
    """One-to-one matches of allowed pairs within each group: golden rows in order take the first free row.

    A golden row takes a row for certain if each is the other's first of all that are left. Such matches are taken by joins, in turns, as
    long as a turn takes at least a half of the pairs that are left; what is left then is matched group by group, as each choice depends
    on those before. Null rows match nothing."""
    by = [group] if isinstance(group, str) else group
    left = settled(pairs.select(*by, golden, found).filter(F.col(golden).isNotNull() & F.col(found).isNotNull()))
    done, n = None, left.count()
    while n:
        both = left.withColumns({"_c": F.min(found).over(Window.partitionBy(*by, golden)), "_g": F.min(golden).over(Window.partitionBy(*by, found))})
        sure = settled(both.filter((F.col("_c") == F.col(found)) & (F.col("_g") == F.col(golden))).select(*by, golden, found).distinct())
        done = sure if done is None else done.unionByName(sure)
        for side in (golden, found):
            gone = sure.select(*(F.col(c).alias(f"_{c}") for c in (*by, side))).hint("merge")
            same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*by, side)))
            left = left.join(gone, same, "left_anti")
        left = settled(left)
        n, before = left.count(), n
        if n > before / 2:
            break
    rest = _matched_in_order(left, by, golden, found)
    return rest if done is None else done.unionByName(rest)


def _matched_in_order(pairs: DataFrame, by: list[str], golden: str, found: str) -> DataFrame:
    """greedy_matches() of each group in one task."""
    import pandas as pd

    schema = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in (*by, golden, found))

    def match(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([golden, found])
        used, taken, keep = set(), set(), []
        for g, f in zip(rows[golden], rows[found], strict=True):
            free = g not in taken and f not in used
            keep.append(free)
            if free:
                taken.add(g)
                used.add(f)
        return rows[keep]

    return pairs.select(*by, golden, found).groupBy(*by).applyInPandas(match, schema)


def orphans(checks: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """check and n_orphans: rows whose reference isn't null and isn't there. checks: child, its column, parent, its key."""
    one = lambda name, c: c[0].filter(F.col(c[1]).isNotNull()).join(c[2].select(F.col(c[3]).alias(c[1])).distinct(), c[1], "left_anti").agg(F.count("*").alias("n_orphans")).select(F.lit(name).alias("check"), "n_orphans")
    return reduce(DataFrame.unionByName, (one(name, c) for name, c in checks.items()))


def smoke_status(orphan_counts: DataFrame) -> DataFrame:
    return orphan_counts.agg(F.sum("n_orphans").alias("n_orphans")).withColumn("status", F.when(F.col("n_orphans") > 0, "fail").otherwise("pass"))


def smoke_check(run: str, tables: dict[str, DataFrame]) -> DataFrame:
    """One row on a load run: status, failures, warnings, fk_orphans, dates_out_of_range and n_persons. It fails if the run
    isn't in pipeline_runs (id, stats_json), or if an edge names a person or event that isn't there; it warns of dates out of
    range (counted in stats_json) and of a run without persons. tables: pipeline_runs, persons (id, run), events,
    event_participants and person_relations."""
    ends = {
        "person_relations.from_person_id": (tables["person_relations"], "from_person_id", tables["persons"], "id"), "person_relations.to_person_id": (tables["person_relations"], "to_person_id", tables["persons"], "id"),
        "event_participants.event_id": (tables["event_participants"], "event_id", tables["events"], "id"), "event_participants.person_id": (tables["event_participants"], "person_id", tables["persons"], "id"),
    }
    lost = orphans(ends).filter("n_orphans > 0").agg(F.sort_array(F.collect_list(F.concat(F.lit("fk_orphan: "), "check", F.lit(" ("), "n_orphans", F.lit(")")))).alias("lost"), F.coalesce(F.sum("n_orphans"), F.lit(0)).alias("fk_orphans"))
    own = tables["pipeline_runs"].filter(F.col("id") == run).agg(F.count("*").alias("n_runs"), F.coalesce(F.max(F.get_json_object("stats_json", "$.dates_out_of_range").try_cast("int")), F.lit(0)).alias("dates_out_of_range"))
    people = tables["persons"].filter(F.col("run") == run).agg(F.count("*").alias("n_persons"))
    got = lost.crossJoin(own).crossJoin(people)  # three single rows
    gone = F.col("n_runs") == 0
    failures = F.when(gone, F.array(F.lit("no_pipeline_run"))).otherwise(F.col("lost"))
    warnings = F.when(gone, F.array().cast("array<string>")).otherwise(F.array_compact(F.array(F.when(F.col("dates_out_of_range") > 0, "dates_out_of_range"), F.when(F.col("n_persons") == 0, "zero_persons"))))
    return got.select(F.lit(run).alias("run_id"), F.when(F.size(failures) > 0, "fail").otherwise("pass").alias("status"), failures.alias("failures"), warnings.alias("warnings"), "fk_orphans", "dates_out_of_range", "n_persons")


def editions(docs: DataFrame, by: str, edition: str) -> DataFrame:
    """The last edition of each corpus."""
    return docs.groupBy(by).agg(F.max(edition).alias("edition"))


def low_confidence(rows: DataFrame, by: str, confidence: str, below: float = 0.55) -> DataFrame:
    """Of each group: n_low, the rows of a confidence below a bound, and n."""
    return rows.groupBy(by).agg(F.sum(F.when(F.col(confidence) < below, 1).otherwise(0)).cast("long").alias("n_low"), F.count("*").alias("n"))


def open_counts(conflicts: DataFrame, merge_candidates: DataFrame) -> DataFrame:
    """what and n: open conflicts and open merge candidates."""
    n = lambda df, what: df.filter("status = 'open'").agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "n")
    return n(conflicts, "conflicts").unionByName(n(merge_candidates, "merge_candidates"))


def repeated_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys of several rows, and how many."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def without(ids: DataFrame, there: DataFrame, key: str) -> DataFrame:
    """Rows of ids whose key isn't there."""
    return ids.join(there.select(key), key, "left_anti")


def coverage(docs: DataFrame, runs: DataFrame, key: str, started: str, run: str) -> DataFrame:
    """Each document with its latest run, or none."""
    last = runs.groupBy(key).agg(F.max_by(run, F.struct(F.col(started), F.col(run))).alias("latest_run"), F.count("*").alias("n_runs"))
    return docs.join(last, key, "left").withColumn("extracted", F.col("latest_run").isNotNull()).withColumn("n_runs", F.coalesce("n_runs", F.lit(0)))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, (df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()))


def require_all(ids: DataFrame, there: DataFrame, key: str, what: str) -> None:
    """Raises if ids are missing, with their number and three of them."""
    missing = without(ids.select(key).distinct(), there, key)
    if n := missing.count():
        raise ValueError(f"{n} {what} are missing: {', '.join(str(r[0]) for r in missing.orderBy(key).limit(3).collect())}")
