"""Which files hold which terms: an inverted index kept with every load of a stage.

The index is a log (`<stage>__terms`): each load notes the distinct terms of each of its files as they were delivered,
with the number of rows, and each consumer notes that it has rebuilt its tables for some files. From that follow the files that
hold a term now, and the terms that a file held in any version since a consumer last rebuilt, so that terms only an
earlier version had are not forgotten, however often a load or a rebuilding was broken off.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.generations import PARTITION_COLUMN, with_partition_key
from tallyloom.operators.lookup import restrict
from tallyloom.sources.log import COMPACT_AFTER_RUNS, Log
from tallyloom.sources.workspace import cut_lineage

#: Up to so many files a scan names its partitions one by one.
NAMED_PARTITIONS = 5_000


def index_of(spark: SparkSession, stage_table: str) -> Log:
    return Log(spark, f"{stage_table}__terms")


def rows_of_files(spark: SparkSession, stage_table: str, files: DataFrame) -> DataFrame:
    """The stage rows of some files (column file_id), with the partition column; only their partitions are read."""
    named = with_partition_key(files.select("file_id").distinct(), "file_id").select(F.col(PARTITION_COLUMN).alias("wanted_key"))
    stage = spark.table(stage_table)
    # the ids of a batch come to the driver, as the paths of its files do
    few = named.limit(NAMED_PARTITIONS + 1).collect()
    if len(few) <= NAMED_PARTITIONS:
        return stage.where(F.col(PARTITION_COLUMN).isin(*[row["wanted_key"] for row in few]))
    return restrict(stage, named, [(PARTITION_COLUMN, "wanted_key")])


def _term_column(columns: list[str]) -> str | None:
    return next((c for c in columns if c.lower() == "term"), None)


def note_terms(spark: SparkSession, stage_table: str, files: DataFrame, after_runs: int = COMPACT_AFTER_RUNS) -> None:
    """Notes the terms of files that were just loaded. A stage without a column `term` has no index."""
    name = _term_column(spark.table(stage_table).columns)
    if name is None:
        return
    held = rows_of_files(spark, stage_table, files).groupBy(F.col("FILE_ID").alias("held_by"), F.col(name).alias("term"))
    counted = held.agg(F.count("*").alias("n_rows"))
    # a file without rows is noted too: it holds nothing any more
    noted = files.select("file_id").distinct().join(counted, F.col("file_id") == F.col("held_by"), "left")
    log = index_of(spark, stage_table)
    log.append(noted.select("file_id", "term", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.lit(None).cast("string").alias("consumer")))
    log.compact(_still_needed, after_runs)


def note_rebuilt(spark: SparkSession, stage_table: str, files: DataFrame, consumer: str) -> None:
    """Notes that a consumer's tables hold what the files hold."""
    done = files.select("file_id", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n_rows"))
    index_of(spark, stage_table).append(done.distinct().withColumn("consumer", F.lit(consumer)))


def _versions(log_rows: DataFrame, consumer: Column) -> DataFrame:
    """Per file: the last version (`last`), and the one that the consumer saw when it last rebuilt (`seen`)."""
    loads = log_rows.where("consumer IS NULL").select("file_id", "run").distinct()
    done = log_rows.where(consumer).groupBy(F.col("file_id").alias("done_file")).agg(F.max("run").alias("done"))
    both = loads.join(done, F.col("file_id") == F.col("done_file"), "left")
    seen = F.max(F.when(F.col("run") <= F.col("done"), F.col("run"))).alias("seen")
    return both.groupBy(F.col("file_id").alias("of_file")).agg(F.max("run").alias("last"), seen)


def _still_needed(log_rows: DataFrame) -> DataFrame:
    """The last marks of every consumer, and of every file the versions since the oldest of them."""
    marks = log_rows.where("consumer IS NOT NULL").groupBy("file_id", "consumer").agg(F.max("run").alias("run"))
    oldest = marks.groupBy(F.col("file_id").alias("done_file")).agg(F.min("run").alias("done"))
    loads = log_rows.where("consumer IS NULL")
    versions = loads.select("file_id", "run").distinct().join(oldest, F.col("file_id") == F.col("done_file"), "left")
    least = F.max(F.when(F.col("run") <= F.col("done"), F.col("run"))).alias("least")
    least = versions.groupBy(F.col("file_id").alias("of_file")).agg(least)
    # without a mark every version may still matter to some consumer
    kept = loads.join(least, F.col("file_id") == F.col("of_file")).where("least IS NULL OR run >= least")
    plain = marks.withColumns({"term": F.lit(None).cast("string"), "n_rows": F.lit(0).cast("long")})
    columns = ["file_id", "term", "n_rows", "consumer", "run"]
    return kept.select(*columns).unionByName(plain.select(*columns))


def touched_terms(
    spark: SparkSession, stage_table: str, files: DataFrame, consumer: str, term_of: Callable[[str], Column] = F.col
) -> DataFrame:
    """The terms (column term) that files hold or held in any version since the consumer rebuilt for them."""
    rows = index_of(spark, stage_table).rows()
    of_files = restrict(rows, files.select(F.col("file_id").alias("wanted")).distinct(), [("file_id", "wanted")])
    versions = _versions(of_files, F.col("consumer") == consumer)
    loads = of_files.where("consumer IS NULL AND n_rows > 0").join(versions, F.col("file_id") == F.col("of_file"))
    since = loads.where("seen IS NULL OR run >= seen")
    return cut_lineage(since.select(term_of("term").alias("term")).distinct())


def files_holding(spark: SparkSession, stage_table: str, terms: DataFrame, term_of: Callable[[str], Column] = F.col) -> DataFrame:
    """The files (file_id) whose last version holds a term of `terms` (column term)."""
    loads = index_of(spark, stage_table).rows().where("consumer IS NULL")
    last = loads.groupBy(F.col("file_id").alias("of_file")).agg(F.max("run").alias("last"))
    held = loads.join(last, (F.col("file_id") == F.col("of_file")) & (F.col("run") == F.col("last"))).where("n_rows > 0")
    wanted = terms.select(F.col("term").alias("wanted_term"))
    return restrict(held, wanted, [(term_of("term"), "wanted_term")], null_safe=True).select("file_id").distinct()
