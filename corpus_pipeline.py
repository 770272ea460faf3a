"""The corpus pipeline: five stages from `documents` to a training mixture, each written as Parquet and read again.

Defined cases: null, empty and blank texts have fewer than 20 words and go in the first stage. Rows that repeat an id, or lack
one, are documents of their own; of those with equal or similar texts one stays, that with the smallest id, rows without an
id last, and among rows that repeat the smallest id the first as they were numbered. Null languages and sources are kept;
documents without a source are a source of their own. Texts of any length are worked on whole. Columns beyond those of
`documents` are kept, whatever their names; the last stage adds `block`, `place` and `epoch`, with underscores behind a name
that is taken. Rows that differ in any column stay apart in the mixture. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontamination, jaccard, mixing, quality_rules, secret_scan
from tallyloom.llm.common import read, stored
from tallyloom.llm.queries import REPETITIONS

#: Near duplicates share this share of their word n-grams; op4_ngram_jaccard has its own, tighter rule.
NEAR_WORDS = 5
NEAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest id stays, whatever ids repeat or lack."""
    return jaccard.keep_one(docs, n=NEAR_WORDS, percent=NEAR_PERCENT)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts, and `n_chars` follows; no document goes."""
    return secret_scan.redact(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by block and place of the mixture, repeated or left out as their source's weight has it."""
    return mixing.mix_texts(docs, repetitions=REPETITIONS)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", secrets),
    ("mixing", mixture),
]

#: SQL cannot express the token test of the secrets stage; the stages are tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of the whole `documents` table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
