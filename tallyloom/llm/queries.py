"""The registered queries of this package: each applies one operator to its whole table with its usual parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    alignment,
    chat,
    decontamination,
    jaccard,
    language,
    lattice,
    mixing,
    passages,
    quality_rules,
    secret_scan,
    token_counts,
    toxicity,
    vector_codes,
)
from tallyloom.llm.common import fold, held_out, read
from tallyloom.llm.oracles import ORACLES
from tallyloom.sources.workspace import new_folder

__all__ = ["ORACLES", "QUERIES"]

#: The most often a source may be repeated in the mixture of the query and the pipeline.
REPETITIONS = 1.25


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), repetitions=REPETITIONS)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read(spark, sf_dir, "documents"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(read(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.learn(docs, F.coalesce(fold(F.col("doc_id"), 4) != 2, F.lit(True)))
    return language.identify(docs, model, held_out(F.col("doc_id"), 4, 2).alias("held_out"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(read(spark, sf_dir, "documents"))


def op7_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    left_out = held_out(F.col("doc_id"), 7, 2)
    return lattice.score(docs, ~left_out).select("doc_id", left_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(read(spark, sf_dir, "conversations"))


def op9_quality_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = passages.learn(docs, read(spark, sf_dir, "labels"), ~held_out(F.col("doc_id"), 5, 0))
    return passages.score(docs, model, held_out(F.col("doc_id"), 5, 0).alias("held_out"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so that every run counts all of its texts."""
    return token_counts.token_counts(read(spark, sf_dir, "documents"), new_folder(spark, "token-cache"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    left_out = held_out(F.col("doc_id"), 5, 0)
    model = toxicity.learn(docs, read(spark, sf_dir, "labels"), ~left_out)
    return toxicity.score(docs, model, left_out.alias("held_out"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups are hashed here; the operator gives them as text."""
    groups = alignment.aligned(read(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    return alignment.with_counts(groups.withColumn("groups_sha256", digest).drop("groups"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, codebooks = vector_codes.coded(read(spark, sf_dir, "embeddings"))
    digest = F.lit(vector_codes.codebooks_digest(codebooks)).alias("codebooks_sha256")
    return vector_codes.with_label_error(codes).select("vec_id", "code", "error", "label_error", digest)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    query.__name__: query
    for query in (
        op1_decontamination,
        op2_mixing,
        op3_secrets,
        op4_ngram_jaccard,
        op5_language,
        op6_quality_rules,
        op7_lattice_lm,
        op8_chat_repair,
        op9_quality_passages,
        op10_token_counts,
        op11_toxicity,
        op12_alignment,
        op13_vector_codes,
        pipeline,
    )
}
