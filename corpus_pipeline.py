"""The corpus pipeline: quality, toxicity, near duplicates, packing. Each stage takes all that its predecessor kept.

A stage is (name, function of (spark, docs, sf_dir)); run() writes each stage's rows to the shared folder and reads them
again as the next one's docs. All but the last keep the columns of docs. SQL expresses none of the stages: see their tests.

Defined results: a null text counts as empty; the first two stages judge every row by its text alone, so rows of a null or
repeated doc_id are judged each by itself, and labels of a repeated id count for each of its rows; of near duplicates the row of
the least doc_id stays (one without an id only where no other has one; of equal rows any one), and rows without words all stay;
packing packs every row that is left, a null doc_id staying null. Empty tables give an empty result; a table of labels without
rows rejects nothing. Further columns, of any names, are carried by the first three stages and left out of the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstone.llm import jaccard_join, packing, quality, toxicity
from inkstone.llm.common import discarded, saved, table, tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier, learned from the labels of these documents, scores 0.3 or more."""
    return quality.kept(docs, quality.train(docs, table(spark, sf_dir, "labels"), F.lit(True)))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model, learned from the labels of these documents, grades as not toxic."""
    return toxicity.clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), F.lit(True)))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row of the least doc_id."""
    return jaccard_join.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json")).drop("ids")


STAGES = [("quality", keep_good), ("toxicity", keep_clean), ("near duplicates", keep_one_of_each), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        last, docs = docs, saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if k:
            discarded(last)
    return docs
