"""What several operators share: tokens, folds, stored intermediate tables, joins whose small side is measured."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.lookup import size_in_bytes
from tallyloom.sources.workspace import new_folder

BROADCAST_LIMIT_BYTES = 24 * 1024 * 1024
WORD = r"[^\x20\x09-\x0D]+"
#: Texts are handed to Python so many at a time, and so many bytes.
_BATCH_BOUNDS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8388608"}
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and leaves every other character alone; null becomes empty."""
    # In text of ASCII alone `lower` does the same, several times faster.
    whole = F.coalesce(text, F.lit(""))
    is_ascii = F.octet_length(whole) == F.char_length(whole)
    return F.when(is_ascii, F.lower(whole)).otherwise(F.translate(whole, _UPPER, _UPPER.lower()))


def words_of(text: Column, pattern: str = WORD) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(pattern), F.lit(0))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; null ids have no fold."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds))


def held_out(doc_id: Column, folds: int, fold_left_out: int) -> Column:
    """Whether the id's fold is the one that is kept from training. Null ids are not held out."""
    return F.coalesce(fold(doc_id, folds) == fold_left_out, F.lit(False))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """While it lasts, rows go to Python functions in batches of bounded size, whatever the session has set."""
    before = {name: spark.conf.get(name, None) for name in _BATCH_BOUNDS}
    for name, value in _BATCH_BOUNDS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written once to the shared folder and read back, so that no later step repeats its work."""
    path = new_folder(df.sparkSession, purpose)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_small(df: DataFrame, small: DataFrame, on: Column, how: str, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Joins with a side that is broadcast if its measured size allows it, and by a shuffle if not."""
    if size_in_bytes(small) <= limit:
        return df.join(F.broadcast(small), on, how)
    return df.join(small.hint("merge"), on, how)


def unused(taken: Iterable[str], name: str) -> str:
    """`name`, lengthened until no column in `taken` has it in any case."""
    known = {one.lower() for one in taken}
    while name.lower() in known:
        name += "_"
    return name


def sampled_each(df: DataFrame, by: str, key: Column, bound: int) -> DataFrame:
    """About `bound` rows of every value of `by` (all, if there are fewer), chosen by a hash of `key`."""
    totals = df.groupBy(by).agg(F.count("*").alias("sampled_total")).withColumnRenamed(by, "sampled_value")
    counted = join_small(df, stored(totals, "totals"), F.col(by).eqNullSafe(F.col("sampled_value")), "inner")
    parts = 1 << 30
    drawn = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(parts)) / parts < F.lit(float(bound)) / F.col("sampled_total")
    return counted.where(drawn | (F.col("sampled_total") <= bound)).drop("sampled_value", "sampled_total")


def bounded_texts(docs: DataFrame, labels: DataFrame, rows: int, size: int) -> list:
    """Rows (doc_id, label, stratum, text) for fitting a classifier: one text per id, at most `rows` of each stratum.

    `labels` has one row per id (doc_id, label, stratum). Ids are chosen by a hash, each stratum for itself, until the
    rows or its share of the `size` bytes are used up; of an id's texts that with the smallest digest counts. Texts of
    more than a hundredth of the bytes are passed over, so that none crowds out the others. What comes to the driver is
    bounded by `rows` and `size` for each of the strata, of which there are to be few.
    """
    parts = 1 << 30
    hashed = labels.withColumn("draw", F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(parts)))
    totals = {row["stratum"]: row["n"] for row in labels.groupBy("stratum").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return []
    # Twice the rows wanted, as some have no text or a long one.
    wanted = F.lit(False)
    for stratum, total in totals.items():
        wanted = wanted | ((F.col("stratum") == F.lit(stratum)) & (F.col("draw") < int(parts * min(1.0, 2 * rows / total))))
    chosen = hashed.where(wanted).withColumnRenamed("doc_id", "labelled_id")
    found = join_small(docs.select("doc_id", "text"), chosen, F.col("doc_id") == F.col("labelled_id"), "inner")
    fitting = found.where(F.col("text").isNotNull() & (F.octet_length("text") <= size // 100))
    digest = F.struct(F.md5("text").alias("digest"), "text")
    one_each = fitting.groupBy("doc_id", "label", "stratum", "draw").agg(F.min(digest)["text"].alias("text"))
    sample = stored(one_each, "sample")
    kept: list = []
    for stratum in totals:
        of_stratum = sample.where(F.col("stratum") == F.lit(stratum))
        sizes = of_stratum.select("draw", "doc_id", F.octet_length("text").alias("n")).orderBy("draw", "doc_id").limit(rows)
        used, last = 0, None
        for row in sizes.collect():
            used += row.n
            if used > size // len(totals):
                break
            last = row
        if last is not None:
            up_to = (F.col("draw") < last.draw) | ((F.col("draw") == last.draw) & (F.col("doc_id") <= F.lit(last.doc_id)))
            kept += of_stratum.where(up_to).collect()
    return sorted(kept, key=lambda row: (row.draw, row.doc_id))
