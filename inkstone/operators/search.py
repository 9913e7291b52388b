"""Searches among names: by shared runs of three characters, and by prefix.

Neither compares every query with every name. Runs of three characters (grams) meet on equality, and of each name and query only as many of
its rarest grams take part as two similar names can't all differ in; prefixes meet names within blocks of a sorted index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkstone.sources.storage import settled


def grams(text: Column | str) -> Column:
    """The distinct runs of three characters of a text in lower case, with two spaces before it and one behind."""
    padded = F.concat(F.lit("  "), F.lower(text), F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substr(padded, i, F.lit(3))))


def _rarest(rows: DataFrame, counts: DataFrame, least: float) -> DataFrame:
    """text, n (how many grams it has), gram and often (how many names have it) of the rarest grams of each text: two sets of which one has
    m grams share `least` of their union only if they share one of its first m - ceil(least * m) + 1 in any one order."""
    each = rows.select("text", "n", F.explode("grams").alias("gram")).join(counts, "gram", "left").withColumn("often", F.coalesce("often", F.lit(0)))
    ordered = each.groupBy("text", "n").agg(F.sort_array(F.collect_list(F.struct("often", "gram"))).alias("g"))
    size = F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1
    return ordered.select("text", "n", F.explode(F.slice("g", F.lit(1), size.cast("int"))).alias("g")).select("text", "n", "g.*")


def trigram_search(names: DataFrame, queries: DataFrame, k: int = 10, least: float = 0.3, hot: int = 100_000) -> DataFrame:
    """query_id, place (from 1), id and score of the k names (id, name) nearest to each query (query_id, query): the share of grams that both
    have among those that either has, where it is `least` or more; ties to the smaller id.

    hot: names of one gram from which on they are dealt over several keys. Defined results: nulls and empty texts take no part; repeated
    rows count once; ids of one name each have a place; a query without a similar name has no rows; further columns are left out."""
    own = settled(names.filter("name <> '' AND id IS NOT NULL").select("id", F.col("name").alias("text")).distinct())
    asked = settled(queries.filter("query <> ''").select("query_id", F.col("query").alias("text")).distinct())
    with_grams = lambda rows: settled(rows.select("text").distinct().withColumn("grams", grams("text")).withColumn("n", F.size("grams")))
    texts, wanted = with_grams(own), with_grams(asked)
    counts = settled(texts.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("often")))
    deals = F.ceil(F.col("often") / hot).cast("int")
    held = _rarest(texts, counts, least).select("gram", F.pmod(F.xxhash64("text"), deals).cast("int").alias("deal"), F.col("text").alias("name"), F.col("n").alias("n_name"))
    sought = _rarest(wanted, counts, least).filter("often > 0").select("gram", F.explode(F.sequence(F.lit(0), deals - 1)).alias("deal"), F.col("text").alias("query"), F.col("n").alias("n_query"))
    sizes = (F.col("n_name") >= F.col("n_query") * least - 1e-9) & (F.col("n_query") >= F.col("n_name") * least - 1e-9)
    pairs = sought.join(held, ["gram", "deal"]).filter(sizes).select("query", "name").distinct()
    side = lambda rows, name: rows.select(F.col("text").alias(name), F.col("grams").alias(f"grams_{name}"))
    both = pairs.join(side(wanted, "query"), "query").join(side(texts, "name"), "name")
    shared = F.size(F.array_intersect("grams_query", "grams_name"))
    scored = both.select("query", "name", (shared / (F.size("grams_query") + F.size("grams_name") - shared)).alias("score")).filter(F.col("score") >= least)
    # No more than k ids of a name, and no more than k names of a query, can be among the k nearest.
    few = own.withColumn("_place", F.row_number().over(Window.partitionBy("text").orderBy("id"))).filter(F.col("_place") <= k).select("id", F.col("text").alias("name"))
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    best = scored.join(few, "name").withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= k)
    return asked.withColumnRenamed("text", "query").join(best.select("query", "place", "id", "score"), "query").select("query_id", "place", "id", "score")


def search_keys(names: DataFrame, variants: DataFrame, spellings: tuple[str, ...] = ("name",), filters: tuple[str, ...] = ()) -> DataFrame:
    """id, key and the filters' columns: what a name (id, its spellings, such as name and pinyin) is found by, its variants (id, variant) too."""
    own = names.select("id", F.explode(F.array(*spellings)).alias("key"), *filters)
    other = variants.select("id", F.col("variant").alias("key")).join(names.select("id", *filters).distinct(), "id").select("id", "key", *filters)
    return own.unionByName(other)


def prefix_search(keys: DataFrame, queries: DataFrame, k: int = 20, filters: tuple[str, ...] = ()) -> DataFrame:
    """query_id, place (from 1), id and key of the first k ids, in order of key and id, that have a key with each query's prefix, whatever
    its case, and the query's value of each filter's column (null: any).

    keys: id, key, filters; queries: query_id, prefix, filters. The keys are sorted into blocks, one a task, whatever share of them
    has one prefix; a query goes to the blocks that its prefix reaches, and meets the keys there on equality of their first characters.
    Defined results: nulls and empty keys and prefixes take no part; an id has one place, by its least key; repeated rows count once; a
    query's id may have several prefixes, whose results are one; further columns are left out."""
    index = keys.filter("key <> '' AND id IS NOT NULL").select("id", F.lower("key").alias("key"), *filters).distinct()
    index = settled(index.repartitionByRange("key", "id").sortWithinPartitions("key", "id").withColumn("_block", F.spark_partition_id()))
    bounds = index.groupBy("_block").agg(F.min("key").alias("_from"), F.max("key").alias("_to"))  # a row for each task
    own = [f"_asked_{f}" for f in filters]
    asked = settled(queries.filter("prefix <> ''").select("query_id", F.lower("prefix").alias("_prefix"), *(F.col(f).alias(f"_asked_{f}") for f in filters)).distinct())
    # Queries that ask the same are answered once.
    questions = settled(asked.select("_prefix", *own).distinct().withColumn("_question", F.monotonically_increasing_id()))
    reaches = (F.col("_to") >= F.col("_prefix")) & ((F.col("_from") <= F.col("_prefix")) | F.startswith("_from", "_prefix"))
    reached = settled(questions.join(F.broadcast(bounds), reaches).drop("_from", "_to"))
    lengths = reached.select("_block", F.length("_prefix").alias("_length")).distinct()
    cut = index.join(lengths, "_block").filter(F.length("key") >= F.col("_length")).withColumn("_prefix", F.left("key", F.col("_length")))
    found = cut.join(reached, ["_block", "_prefix"])
    for f in filters:
        found = found.filter(F.col(f"_asked_{f}").isNull() | (F.col(f"_asked_{f}") == F.col(f)))
    first = lambda by: Window.partitionBy(by).orderBy("key", "id")
    least = found.groupBy("_question", "id").agg(F.min("key").alias("key"))
    nearest = settled(least.withColumn("place", F.row_number().over(first("_question"))).filter(F.col("place") <= k).select("_question", "id", "key"))
    # The first k of several prefixes are among the first k of each.
    same = F.expr(" AND ".join(f"a.{c} <=> q.{c}" for c in ["_prefix", *own]))
    answers = asked.alias("a").join(questions.alias("q"), same).select("a.query_id", "q._question").join(nearest, "_question")
    one = answers.groupBy("query_id", "id").agg(F.min("key").alias("key"))
    return one.withColumn("place", F.row_number().over(first("query_id"))).filter(F.col("place") <= k).select("query_id", "place", "id", "key")
