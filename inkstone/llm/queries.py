"""The operators' queries over the whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstone.llm import additive_quantisation, bpe_codec, jaccard_join, kneser_ney, license_scan, packing, quality, sentencepiece_codec, tiff, token_counts, toxicity, vector_codes, whitening
from inkstone.llm.common import fold, table, tokenizer_path
from inkstone.llm.license_templates import TEMPLATES

def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), TEMPLATES)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return quality.scored(docs, model).select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")).drop("ids")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.graded(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), F.lit(True)))


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = kneser_ney.perplexity(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)
    return got.select("doc_id", F.coalesce(fold("doc_id", 7) == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as f:
        return sentencepiece_codec.coded(table(spark, sf_dir, "documents"), f.read())


def op7_additive_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return additive_quantisation.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.stored_texts(table(spark, sf_dir, "documents")).drop("content")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), token_counts.sentencepiece_vocabulary(tokenizer_path("piece_bpe_32k.model")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = bpe_codec.coded(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    digest = lambda c: F.sha2(c, 256)
    return got.select("doc_id", "n_tokens", digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"), digest("decoded").alias("decoded_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = vector_codes.product_codes(table(spark, sf_dir, "embeddings"))
    hexed = F.concat_ws("", F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")))
    return got.select("vec_id", hexed.alias("code"), F.col("error").cast("long").alias("error"), F.col("label_error").cast("long").alias("label_error"), "codebooks_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    **{f.__name__: f for f in (op1_license_scan, op2_quality, op3_packing, op4_toxicity, op5_kneser_ney, op6_sentencepiece, op7_additive_quantisation, op8_tiff, op9_jaccard_join, op10_token_counts, op11_whitening, op12_bpe, op13_vector_codes)},
}
ORACLES: dict[str, str] = {}
