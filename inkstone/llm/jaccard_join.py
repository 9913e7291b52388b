"""Operator 9: exact Jaccard join of documents on word shingles, by adaptive multi-match prefixes.

Two sets link when 100 * intersection >= 100 * threshold * union. Equal sets form one class, and classes are what is
joined. Shingles have one total order: those of a table of the most frequent (`frequent`, or a thousandth of all shingles where
that is more, up to 4 million; in `hot` documents or more) come last, by document count; all others come first, by hash. The table, of bounded size, is broadcast; an order
can't change the result, only the work.

Any two linked sets share a class's first |set| - ceil(threshold |set|) + l shingles at least l times, l being the
lesser of the two. A class chooses its own l: the longer prefix costs postings and matches, whose number is
estimated as the document counts of the prefix's frequent shingles, and saves candidates, estimated as matches over l.

Work on groups stays linear. First every posting list is cut into runs of at most `run` classes and linked to its
runs' first classes (stars); verified links form components. Then, for the result to be exact, every pair of classes
that share l prefix shingles, are of suitable sizes and lie in different components is verified too: lists within one
component need nothing more, and in mixed lists only the members outside the list's largest component meet the others.

That gives components, not links. links() and link_counts() find every pair of linked classes, in one component or not:
pairs are made between blocks of about `run` classes of a posting list, and all that share l prefix shingles are verified.
That work grows with the number of links, in a group of near copies the square of its size.

Hashes have 64 bits: sets, and shingles within two sets, are held equal if their hashes are.

Defined results: null, empty and blank texts have no shingles and link with nothing, and are their own component; a null
doc_id takes no part in naming components, but its text links as any other, and it gets its component's name (null if none
of the component has a doc_id); repeated rows
each get a row; rows with one doc_id and different texts are joined as different sets; an empty table gives an empty
result; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from inkstone.llm.common import SMALL_SLICE, column_of, discarded, pack_sorted, parts_for, saved, shingle_sets, slices, unpack_sorted

LENGTHS = (1, 2, 3, 4, 6, 8, 12)  # the choices of l
#: What a match costs that is made, moved and counted, over a candidate that is verified. Matches are weighed high: they
#: grow with a list's size for each of a prefix's shingles, while most candidates are found again by the stars.
ROW_COST = 3
BROADCAST_ROWS = 2_000_000


def class_key(shingles: np.ndarray) -> int:
    """A signed 64-bit hash of a sorted set and its size."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


class NewClasses:
    """Whether a task has seen a class before, as far as it remembers, so that a large group of copies counts once a task."""

    def __init__(self, most: int = 1_000_000) -> None:
        self.seen: set[int] = set()
        self.most = most

    def __call__(self, key: int) -> bool:
        if key in self.seen:
            return False
        if len(self.seen) >= self.most:
            self.seen.clear()
        self.seen.add(key)
        return True


def least_overlap(n: np.ndarray | int, percent: int):
    """ceil(threshold * n), in whole numbers."""
    return -(-n * percent // 100)


# ---------------------------------------------------------------- sets and frequent shingles


def classes_of(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles and the class key (null without shingles) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SMALL_SLICE):
                sets = shingle_sets(column_of(part, "text"), width)
                yield pa.RecordBatch.from_arrays([column_of(part, "doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([class_key(s) if len(s) else None for s in sets], pa.int64())], ["doc_id", "n_shingles", "class"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, class long")


def frequent_shingles(docs: DataFrame, width: int, least: int, most: int, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """At most `most` shingles that most documents have, among those in `least` or more: their hashes' upper 32 bits, sorted,
    and document counts. All shingles of all documents are counted, in compact sorted blocks by range of hash."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            upper = np.sort(np.concatenate(held))
            cuts = np.searchsorted(upper, (np.arange(ranges + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(ranges))
            parts = [upper[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            return pa.RecordBatch.from_arrays([pa.array(range(ranges), pa.int32()), pa.array([len(p) for p in parts], pa.int32()), pa.array([pack_sorted(p) for p in parts], pa.binary())], ["range", "n", "block"])

        new = NewClasses()
        for batch in batches:
            for part in slices(batch, most=SMALL_SLICE):
                upper = np.concatenate([s for s in shingle_sets(column_of(part, "text"), width) if new(class_key(s))] or [np.zeros(0, np.uint64)]) >> np.uint64(32)
                held.append(upper.astype(np.uint32))
                size += len(upper)
                if size >= 4_000_000:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def counted(table: pa.Table) -> pa.Table:
        upper = np.sort(np.concatenate([unpack_sorted(b, n, np.uint32) for b, n in zip(table.column("block").to_pylist(), table.column("n").to_pylist(), strict=True)]))
        first = np.flatnonzero(np.concatenate([[True], upper[1:] != upper[:-1]])) if len(upper) else np.zeros(0, np.int64)
        counts = np.diff(np.append(first, len(upper)))
        often = counts >= least
        return pa.table({"shingle": pa.array(upper[first[often]].astype(np.int64)), "n_docs": pa.array(counts[often].astype(np.int64))})

    often = docs.select("text").mapInArrow(blocks, "range int, n int, block binary").repartition(ranges, "range").groupBy("range").applyInArrow(counted, "shingle long, n_docs long")
    # Few rows of each range are frequent: without the hint each range would write a small file.
    return most_frequent(saved(often.hint("rebalance"), "frequent"), most)


def most_frequent(often: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most `most` of the shingles (shingle: 32 bits of its hash, n_docs) that most documents have, sorted by shingle, and their n_docs. A
    histogram of n_docs, of a few thousand steps whatever the corpus, tells from which step on all are taken and what share, by hash, of
    the step before; tasks then filter by it, and no task sorts more than its own rows."""
    n = F.col("n_docs")
    step = F.when(n < 1024, n).otherwise(1024 + F.floor(64 * (F.log2(n) - 10)))
    bars = often.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    room, whole, share = most, math.inf, 0.0
    for bar in bars:
        if bar["count"] > room:
            # Hashes are even: fewer than five deviations below the room leave no more than it.
            share = max(0.0, room - 5 * math.sqrt(room)) / bar["count"]
            break
        room, whole = room - bar["count"], bar["step"]
    last = bar["step"] if share else -1
    best = often.filter((step >= F.lit(float(whole))) | ((step == last) & (F.col("shingle") < int(share * 2**32)))).toPandas().sort_values("shingle")
    return best["shingle"].to_numpy().astype(np.uint32), best["n_docs"].to_numpy().astype(np.int64)


# ---------------------------------------------------------------- prefixes


def sized(n: int, l: int, n_docs: np.ndarray) -> np.ndarray:  # noqa: E741
    """For each shingle of a prefix one number: the share of the prefix that isn't frequent (8 bits, first in order), the
    set's size (28), l (4), and the shingle's place in the prefix (20, or less than the place)."""
    cold = int(255 * float((n_docs == 0).mean()))
    return (cold << 52 | n << 24 | l << 20) + np.minimum(np.arange(len(n_docs), dtype=np.int64), (1 << 20) - 1)


def prefix(shingles: np.ndarray, hot: tuple[np.ndarray, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The prefix of a sorted set, its document counts (0: not frequent) and the chosen l."""
    n = len(shingles)
    keys, counts = hot
    docs = np.zeros(n, np.int64)
    if len(keys):
        place = np.minimum(np.searchsorted(keys, (shingles >> np.uint64(32)).astype(np.uint32)), len(keys) - 1)
        docs = np.where(keys[place] == (shingles >> np.uint64(32)), counts[place], 0)
    if docs.any():
        order = np.lexsort((shingles, docs))
        shingles, docs = shingles[order], docs[order]
    overlap, equal = least_overlap(n, percent), -(-2 * n * percent // (100 + percent))
    best, least = 1, math.inf
    total = np.cumsum(docs)
    for own in LENGTHS:
        if own <= overlap:
            matches = total[n - equal + own - 1]  # with sets of this size, within what has to match
            cost = n - overlap + own + matches * (ROW_COST + 1 / own)
            if cost < least:
                best, least = own, cost
    size = n - overlap + best
    return shingles[:size], docs[:size], best


def postings_of(docs: DataFrame, width: int, percent: int, hot: tuple[np.ndarray, np.ndarray], run: int) -> DataFrame:
    """shingle, part (of a long list; -1 if the list has one), class and sized, once for each class, prefix shingle and
    task. One further row of a class, with part -2 and the class as shingle, has the place of its prefix's last shingle
    in the order (as far as 62 bits tell) in sized."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new = NewClasses()
        for batch in batches:
            for part in slices(batch, most=SMALL_SLICE):
                columns = [[], [], [], []]
                for s in shingle_sets(column_of(part, "text"), width):
                    if len(s) and new(key := class_key(s)):
                        own, n_docs, l = prefix(s, shared.value, percent)  # noqa: E741
                        runs = -(-n_docs // run)
                        part_of = np.where(runs > 1, (key & 0xFFFFFFFF) % np.maximum(1, runs), -1).astype(np.int32)
                        last = min(int(n_docs[-1]), 1 << 22) << 40 | int(own[-1]) >> 24
                        for c, x, y in zip(columns, (own.view(np.int64), part_of, np.full(len(own), key), sized(len(s), l, n_docs)), (key, -2, key, last), strict=True):
                            c += [x, np.array([y], x.dtype)]
                if columns[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["shingle", "part", "class", "sized"])

    return docs.select("text").mapInArrow(made, "shingle long, part int, class long, sized long")


# ---------------------------------------------------------------- links and components


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets link. texts: class and text of each class. Both sides' texts come by joins
    on the class; a class in many pairs is a skewed key that the adaptive join splits."""

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a", SMALL_SLICE, "text_b"):
                one, two = shingle_sets(column_of(part, "text_a"), width), shingle_sets(column_of(part, "text_b"), width)
                keep = []
                for x, y in zip(one, two, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([column_of(part, "a"), column_of(part, "b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda k: texts.select(F.col("class").alias(k), F.col("text").alias(f"text_{k}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(checked, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """class and component (its least class) of the classes in edges (a, b), by large and small stars in turn. Each
    turn is written to the shared folder; turns go on until the links don't change."""
    edges = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), "a").alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").unionByName(low.select("a", F.col("low").alias("b")))
        last, edges = edges, saved(small.filter("a <> b").distinct(), "edges")
        discarded(last)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("b")).first()
        if state == before:
            low = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "class")
            return low.unionByName(edges.select(F.col("b").alias("class"), F.col("b").alias("component")).distinct().join(low.select("class"), "class", "left_anti"))
        before = state


def keyed(docs: DataFrame, width: int) -> DataFrame:
    """text and class (null without shingles) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SMALL_SLICE):
                keys = [class_key(s) if len(s) else None for s in shingle_sets(column_of(part, "text"), width)]
                yield pa.RecordBatch.from_arrays([column_of(part, "text"), pa.array(keys, pa.int64())], ["text", "class"])

    return docs.select("text").mapInArrow(run, "text string, class long")


def texts_of(docs: DataFrame, rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """class and text of the wanted classes, each from the row of its least doc_id, or where all its rows lack one from any
    of them. The ids are broadcast while they are few; beyond that the join shuffles."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # a doc_id may have other texts too
        for batch in batches:
            for part in slices(batch, most=SMALL_SLICE):
                keys = [class_key(s) for s in shingle_sets(column_of(part, "text"), width)]
                yield part.filter(pa.array([k == c for k, c in zip(keys, column_of(part, "class").to_pylist(), strict=True)], pa.bool_()))

    reps = saved(rows.filter("class IS NOT NULL AND doc_id IS NOT NULL").join(wanted, "class").groupBy("class").agg(F.min("doc_id").alias("doc_id")), "representatives")
    found = docs.select("doc_id", "text").join(F.broadcast(reps) if reps.count() <= BROADCAST_ROWS else reps, "doc_id").select("class", "text")
    if rows.groupBy("doc_id").count().filter("count > 1").limit(1).count():
        found = found.mapInArrow(own, "class long, text string").dropDuplicates(["class"])
    if rows.filter("class IS NOT NULL AND doc_id IS NULL").limit(1).count():
        alone = wanted.join(reps, "class", "left_anti")
        found = found.unionByName(keyed(docs.filter("doc_id IS NULL"), width).join(alone, "class").dropDuplicates(["class"]).select("class", "text"))
    return found


def size(sized: str) -> Column:
    return F.shiftright(sized, 24).bitwiseAND((1 << 28) - 1)


def own_l(sized: str) -> Column:
    return F.shiftright(sized, 20).bitwiseAND(15)


def fits(a: str, b: str, percent: int) -> Column:
    return (size(a) * 100 >= size(b) * percent) & (size(b) * 100 >= size(a) * percent)


def both_l() -> Column:
    return F.least(own_l("sized"), own_l("sized_one"))


def could_link(percent: int) -> Column:
    """Whether the classes of a match (`sized`, `last` and `most` of both, one's with the suffix _one) may link. Linked sets
    of sizes m and n share o of their shingles at least, and so at least l of the first m - o + l and n - o + l. Of two
    classes, the one whose prefix ends first has all that its prefix shares with the other in the other's prefix, too; so it
    has at most `most` shingles in common with the other."""
    place = lambda c: F.col(c).bitwiseAND((1 << 20) - 1)
    common = F.ceil((size("sized") + size("sized_one")) * percent / (100 + percent))  # of linked sets of these sizes
    enough = F.when(F.col("last_one") < F.col("last"), F.col("most_one")).when(F.col("last") < F.col("last_one"), F.col("most")).otherwise(F.greatest("most", "most_one")) >= common
    early = (place("sized") < size("sized") - common + both_l()) & (place("sized_one") < size("sized_one") - common + both_l())
    return fits("sized", "sized_one", percent) & enough & early


def with_most(shared: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """shared with the columns of classes (class, last and others) and most: size - p + s, p being a class's prefix's
    length and s how many of these shingles any other prefix has."""
    own = classes.join(shared.groupBy("class").agg(F.count("*").alias("n_shared")), "class")
    return shared.join(own, "class").withColumn("most", F.ceil(size("sized") * percent / 100) - own_l("sized") + F.col("n_shared")).drop("n_shared")


def met_with_l(matches: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that match l times."""
    return matches.groupBy(F.least("class_one", "class").alias("a"), F.greatest("class_one", "class").alias("b")).agg(F.count("*").alias("n"), F.min(both_l()).alias("least")).filter("n >= least").select("a", "b")


def posting_lists(docs: DataFrame, rows: DataFrame, width: int, percent: int, frequent: int, hot: int, run: int) -> tuple[DataFrame, DataFrame]:
    """The postings of lists with several classes, each with its run's first class (hub, hub_sized), and the classes' last
    places. rows: classes_of(docs)."""
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    most = max(frequent, min(total >> 10, 1 << 22))  # grows with the corpus, up to 50 MB
    often = frequent_shingles(docs, width, hot, most, parts_for(docs.sparkSession, total, 4_000_000))
    lists = postings_of(docs, width, percent, often, run)
    ordered = Window.partitionBy("shingle", "part").orderBy("sized", "class")
    # One row for each class of a list with several: equal rows, from several tasks, are neighbours. Runs of a long
    # list are cut by hash; they are met again by their first classes.
    written = saved(
        lists.withColumn("hub", F.first("class").over(ordered))
        .withColumn("hub_sized", F.first("sized").over(ordered))
        .withColumn("after", F.lead("class").over(ordered))
        .filter("(after IS NULL OR after <> class) AND (hub <> class OR after IS NOT NULL OR part <> -1)")
        .drop("after"),
        "postings",
    )
    return written.filter("part >= -1"), written.filter("part = -2").select("class", F.col("sized").alias("last"))


def links(docs: DataFrame, width: int = 5, threshold: float = 0.75, frequent: int = 1 << 18, hot: int = 12, run: int = 1_000, rows: DataFrame | None = None) -> DataFrame:
    """All pairs (a, b), a < b, of classes whose sets link. rows: classes_of(docs), if there already; it says which rows a
    class has."""
    percent = round(100 * threshold)
    rows = saved(classes_of(docs, width), "classes") if rows is None else rows
    shared, lasts = posting_lists(docs, rows, width, percent, frequent, hot, run)
    placed = saved(with_most(shared.select("shingle", "part", "class", "sized"), lasts, percent), "placed")
    parts = placed.filter("part >= 0").groupBy("shingle").agg((F.max("part") + 1).alias("parts"))
    blocks = placed.join(parts, "shingle", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.greatest("part", F.lit(0)))
    # Each pair of a list's blocks meets under a key of its own: no key has more than a block's rows a side.
    one = blocks.select("shingle", F.col("part").alias("low"), F.explode(F.sequence("part", F.col("parts") - 1)).alias("high"), *(F.col(c).alias(f"{c}_one") for c in ("class", "sized", "last", "most")))
    two = blocks.select("shingle", F.explode(F.sequence(F.lit(0), "part")).alias("low"), F.col("part").alias("high"), "class", "sized", "last", "most")
    pairs = saved(met_with_l(one.join(two, ["shingle", "low", "high"]).filter(could_link(percent) & ((F.col("low") < F.col("high")) | (F.col("class_one") < F.col("class"))))), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    return verified(pairs, texts_of(docs, rows, ends, width), width, percent)


def link_counts(docs: DataFrame, width: int = 5, **how) -> DataFrame:
    """doc_id, n_shingles, class (equal sets have one; null without shingles) and n_links of each row: how many other rows
    its set links with, those of its own class included."""
    rows = saved(classes_of(docs, width), "classes")
    found = saved(links(docs, width, rows=rows, **how), "links")
    own = rows.filter("class IS NOT NULL").groupBy("class").agg(F.count("*").alias("n_rows"))
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(own.withColumnRenamed("class", "b"), "b").groupBy(F.col("a").alias("class")).agg(F.sum("n_rows").alias("n_others"))
    by_class = own.join(others, "class", "left").select("class", (F.col("n_rows") - 1 + F.coalesce("n_others", F.lit(0))).alias("n_links"))
    return rows.join(by_class, "class", "left").select("doc_id", "n_shingles", "class", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def joined_classes(docs: DataFrame, width: int, threshold: float, frequent: int, hot: int, run: int) -> tuple[DataFrame, DataFrame]:
    """classes_of(docs), and class and component of the classes that link with any other."""
    percent = round(100 * threshold)
    rows = saved(classes_of(docs, width), "classes")
    shared, lasts = posting_lists(docs, rows, width, percent, frequent, hot, run)
    stars = shared.filter((F.col("hub") != F.col("class")) & fits("sized", "hub_sized", percent)).select(F.least("hub", "class").alias("a"), F.greatest("hub", "class").alias("b"))
    hubs = shared.select("shingle", F.col("hub").alias("class"), F.col("hub_sized").alias("sized")).join(shared.filter("part >= 0").select("shingle").distinct(), "shingle", "left_semi").distinct()
    first = Window.partitionBy("shingle").orderBy("sized", "class")
    over = hubs.withColumn("hub", F.first("class").over(first)).withColumn("hub_sized", F.first("sized").over(first)).filter((F.col("hub") != F.col("class")) & fits("sized", "hub_sized", percent))
    stars = saved(stars.unionByName(over.select(F.least("hub", "class").alias("a"), F.greatest("hub", "class").alias("b"))).distinct(), "stars")
    ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    near = saved(verified(stars, texts_of(docs, rows, ends(stars), width), width, percent), "near")
    found = saved(components(near), "components")

    # What the stars can't have seen: pairs of one list in different components.
    classes = lasts.join(found, "class", "left").withColumn("component", F.coalesce("component", "class"))
    placed = with_most(shared.select("shingle", "part", "class", "sized"), classes, percent)
    by_component = placed.groupBy("shingle", "component").agg(F.count("*").alias("n"), F.max("part").alias("part"))
    held = by_component.groupBy("shingle").agg(F.count("*").alias("n_components"), F.max_by("component", "n").alias("largest"), F.max("part").alias("last_part")).filter("n_components > 1").drop("n_components")
    # A long list keeps its parts, each of which all of the list's smaller components meet under a key of its own.
    mixed = saved(placed.join(held, "shingle").withColumn("part", F.greatest("part", F.lit(0))), "mixed")
    parts = F.explode(F.sequence(F.lit(0), F.greatest("last_part", F.lit(0)))).alias("part")
    small = mixed.filter("component <> largest").select("shingle", parts, *(F.col(c).alias(f"{c}_one") for c in ("class", "sized", "last", "component", "most")))
    mixed = mixed.drop("last_part")
    # Of two linked sets the one whose prefix ends first has enough in common with other prefixes to link with any at all; so
    # of many sets that share one passage, and have not enough of it, no two meet.
    able, able_one = (F.col(f"most{k}") >= F.ceil(size(f"sized{k}") * percent / 100) for k in ("", "_one"))
    met = lambda a, b: a.join(b, ["shingle", "part"]).filter((F.col("component") != F.col("component_one")) & could_link(percent) & ((F.col("component") == F.col("largest")) | (F.col("class_one") < F.col("class"))))
    matches = met(small.filter(able_one), mixed).unionByName(met(small.filter(~able_one), mixed.filter(able)))
    crossing = met_with_l(matches).join(stars, ["a", "b"], "left_anti")
    crossing = saved(crossing, "crossing")
    more = verified(crossing, texts_of(docs, rows, ends(crossing), width), width, percent)
    return rows, components(near.unionByName(more))


def jaccard_join(docs: DataFrame, width: int = 5, threshold: float = 0.75, frequent: int = 1 << 18, hot: int = 12, run: int = 1_000) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id that links reach) of each row."""
    rows, found = joined_classes(docs, width, threshold, frequent, hot, run)
    named = rows.filter("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("least")).join(found, "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = named.join(least, "component").select("class", "component_id")
    return rows.join(by_class, "class", "left").select("doc_id", "n_shingles", F.coalesce("component_id", F.when(F.col("class").isNull(), F.col("doc_id"))).alias("component_id"))


def with_class(docs: DataFrame, width: int, name: str) -> DataFrame:
    """docs with the class of each text (null without shingles) in a column of that name, which docs doesn't have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SMALL_SLICE):
                keys = [class_key(s) if len(s) else None for s in shingle_sets(column_of(part, "text"), width)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys, pa.int64())], [*part.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def one_of_each(docs: DataFrame, width: int = 5, threshold: float = 0.75, frequent: int = 1 << 18, hot: int = 12, run: int = 1_000) -> DataFrame:
    """One row of docs, all columns as they are, for each component: that of the least doc_id (a null one only where no row
    has another), then of the least class, then any of equal ones. Rows without shingles all stay. What goes is told
    by doc_id where that names one row; of repeated and null ids, by the row's class, too. Ids to drop are broadcast while
    they are few; beyond that the join shuffles."""
    rows, found = joined_classes(docs, width, threshold, frequent, hot, run)
    own = rows.filter("class IS NOT NULL")
    least = own.groupBy("class").agg(F.min("doc_id").alias("doc_id")).join(found, "class", "left")
    first = least.groupBy(F.coalesce("component", "class")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "class")).alias("first"))
    stays = saved(first.select("first.doc_id", "first.class"), "first")
    few = lambda ids: F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    unclear = saved(rows.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").select("doc_id"), "unclear")
    drop = saved(own.filter("doc_id IS NOT NULL").join(stays, ["doc_id", "class"], "left_anti").join(unclear, "doc_id", "left_anti").select("doc_id"), "dropped")
    kept = docs.join(few(drop), "doc_id", "left_anti").select(*docs.columns)
    if not unclear.limit(1).count():
        return kept
    repeated = few(unclear.filter("doc_id IS NOT NULL"))
    longest = "_" * max(map(len, docs.columns))  # no column of docs has a name that ends so
    key, id_of, class_of = f"class{longest}", f"id{longest}", f"first{longest}"
    unsure = with_class(docs.join(repeated, "doc_id", "left_semi").unionByName(docs.filter("doc_id IS NULL")), width, key)
    winners = stays.select(F.col("doc_id").alias(id_of), F.col("class").alias(class_of))
    one = unsure.join(winners, F.col("doc_id").eqNullSafe(F.col(id_of)) & (F.col(key) == F.col(class_of)), "left_semi").dropDuplicates(["doc_id", key])
    sure = kept.filter("doc_id IS NOT NULL").join(repeated, "doc_id", "left_anti")
    return sure.unionByName(unsure.filter(F.col(key).isNull()).select(*docs.columns)).unionByName(one.select(*docs.columns)).select(*docs.columns)
