"""One query for each operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_engine.llm import bpe, brown, crosstok, descent, langid, mixing, puclass, secrets, simhash, substrings, toxicity, vectors, whitening
from feedback_engine.llm.common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op2_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.scores(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    documents = table(spark, sf_dir, "documents")
    return bpe.digests(bpe.encode(documents, vocabulary, public_tokenizers.PATTERN, back=True))


def op4_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats(table(spark, sf_dir, "documents"))


def op5_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.vector_links(table(spark, sf_dir, "embeddings"))


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return descent.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op7_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return puclass.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_predictions(table(spark, sf_dir, "documents"))


def op11_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero tokens have the digest ''; columns as ``crosstok.aligned`` has them, the groups as their SHA-256."""
    byte_level, pieces = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    made = crosstok.aligned(table(spark, sf_dir, "documents"), byte_level, pieces, digest=True)
    return made.withColumnRenamed("groups", "groups_sha256")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.by_component(whitening.whiten(table(spark, sf_dir, "embeddings")))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_simhash, op2_brown_lm, op3_byte_bpe, op4_sentence_spans, op5_vector_near_dedup, op6_nn_descent, op7_pu_quality, op8_source_mixing, op9_secret_scan, op10_language, op11_cross_tokenizer, op12_whitening, op13_toxicity]
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return {"op8_source_mixing": mixing.mixing_sql()}
