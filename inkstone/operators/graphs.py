"""Components of a graph and reachability along its edges, by turns whose number is about the logarithm of a path's length, or
as many as the least path's edges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstone.sources.storage import settled


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id and component (its least id) of each end of the edges; rows with a null end are left out. A turn takes the least label
    among neighbours, and then that label's own."""
    links = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("a"), F.col(b).alias("b"))
    both = settled(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    state = settled(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("component")))
    while True:
        near = both.join(state.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("_near"))
        hooked = state.join(near, "id").select("id", F.col("component").alias("_was"), F.least("component", "_near").alias("component"))
        hooked = settled(hooked)
        jumped = hooked.join(hooked.select(F.col("id").alias("component"), F.col("component").alias("_further")), "component")
        turn = settled(jumped.select("id", F.least("component", "_further").alias("component"), "_was"))
        state = turn.drop("_was")
        if not turn.filter("component <> _was").limit(1).count():
            return state


def closure(edges: DataFrame, a: str = "a", b: str = "b", kind: str = "kind") -> DataFrame:
    """a, b, generation (the least number of edges from a to b) and kinds (those of all edges on any path of that length, sorted) of every
    pair of which one reaches the other.

    Each turn joins the edges with the pairs of the last turn alone, and keeps what wasn't reached before; there are as many turns as the
    longest of the least paths has edges. Defined results: whoever is on a cycle reaches itself; edges from one to itself give
    generation 1; repeated edges count once; rows with a null end are left out, null kinds aren't among the kinds; without edges the result
    is empty."""
    steps = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("_via"), F.col(b).alias("_to")).agg(F.collect_set(kind).alias("_kinds"))
    steps = settled(steps)
    frontier = settled(steps.select(F.col("_via").alias("a"), F.col("_to").alias("b"), F.lit(1).alias("generation"), F.sort_array("_kinds").alias("kinds")))
    reached, recent, generation = None, [frontier], 1
    while frontier.limit(1).count():
        generation += 1
        further = frontier.join(steps.hint("merge"), F.col("b") == F.col("_via")).select("a", F.col("_to").alias("b"), F.array_union("kinds", "_kinds").alias("kinds"))
        for seen in [*recent, *([] if reached is None else [reached])]:
            further = further.join(seen.select("a", "b").hint("merge"), ["a", "b"], "left_anti")  # small as files, large once broadcast
        kinds = F.sort_array(F.array_distinct(F.flatten(F.collect_set("kinds"))))
        frontier = settled(further.groupBy("a", "b").agg(kinds.alias("kinds")).select("a", "b", F.lit(generation).alias("generation"), "kinds"))
        recent.append(frontier)
        if len(recent) == 8:  # so that a turn looks into few tables, and a pair is written again once in eight turns
            reached, recent = settled(reduce(DataFrame.unionByName, recent if reached is None else [reached, *recent])), []
    every = reduce(DataFrame.unionByName, recent if reached is None else [reached, *recent])
    return every.select(F.col("a").alias(a), F.col("b").alias(b), "generation", "kinds")
