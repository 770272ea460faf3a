"""Token counts through a cache of digests.

Every text is known by the SHA-256 of its normalised content (null becomes empty; nothing else may change, as the
count must be that of the text itself) and the tokenizer by the SHA-256 of its file. Counts that the cache already has
are joined; of the texts it lacks, each distinct one is encoded once and appended.

Defined cases: a null text counts as an empty one (0 tokens); repeated rows and rows without an id are returned one
for one; columns besides `doc_id` and `text` are not read; an empty table gives no rows and leaves the cache as it was.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import stored

TOKENIZER = "piece_bpe_32k.model"
CACHE = T.StructType(
    [
        T.StructField("digest", T.StringType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("tokenizer", T.StringType()),
    ]
)
#: Characters handed to the tokenizer at a time.
_CHUNK_CHARS = 2_000_000


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file."""
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def load_encoder(path: str):
    """A function from a list of texts to their token counts, for a .model or .json file."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(one.ids) for one in tokenizer.encode_batch(texts, add_special_tokens=False)]


def _encode(path: str):
    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load_encoder(path)
        for texts in batches:
            counts: list[int] = []
            chunk: list[str] = []
            held = 0
            for text in texts:
                chunk.append(text)
                held += len(text)
                if held >= _CHUNK_CHARS:
                    counts += encode(chunk)
                    chunk, held = [], 0
            yield pd.Series(counts + (encode(chunk) if chunk else []), dtype="int64")

    return count


def read_cache(spark, cache: str, version: str) -> DataFrame:
    """Digests and counts that the cache holds for one tokenizer; a cache that does not exist yet is made."""
    spark.createDataFrame([], CACHE).write.mode("append").partitionBy("tokenizer").parquet(cache)
    rows = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def fill_cache(docs: DataFrame, cache: str, path: str, version: str) -> None:
    """Encodes each distinct text that the cache lacks and appends its count."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("content"))
    distinct = texts.select(F.sha2("content", 256).alias("digest"), "content").dropDuplicates(["digest"])
    known = read_cache(docs.sparkSession, cache, version)
    misses = distinct.join(known, "digest", "left_anti")
    counted = misses.select("digest", _encode(path)("content").alias("n_tokens"), F.lit(version).alias("tokenizer"))
    counted.write.mode("append").partitionBy("tokenizer").parquet(cache)


def token_counts(docs: DataFrame, cache: str, path: str | None = None, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than `limit` tokens) of every row."""
    path = path or tokenizer_path()
    version = tokenizer_version(path)
    fill_cache(docs, cache, path, version)
    content = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.octet_length(content).cast("long").alias("n_bytes"), F.sha2(content, 256).alias("digest"))
    counts = stored(read_cache(docs.sparkSession, cache, version), "token-counts")
    return rows.join(counts.hint("merge"), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
