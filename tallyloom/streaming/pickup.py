"""Picking up new deliveries with Structured Streaming.

The stream carries file names, not rows: each micro-batch is a short list of files that the ordinary ingest
then reads, so encodings, differing headers and lineage are handled in one place. The stream's checkpoint
remembers which files were seen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.generations import PARTITION_COLUMN
from tallyloom.operators.lookup import restrict
from tallyloom.plans.runs import replace_terms
from tallyloom.sources.deliveries import LISTING_SCHEMA
from tallyloom.sources.ingest import IngestSpec
from tallyloom.sources.ledger import SURPLUS_TABLE, load_deliveries
from tallyloom.sources.paths import literal_path
from tallyloom.sources.term_index import files_holding, index_of, note_rebuilt, note_terms, rows_of_files, touched_terms
from tallyloom.sources.workspace import new_folder, remove_folder

FILES_PER_BATCH = 200
#: The file source passes over files that are older than this, counted back from the newest one it has seen.
NO_AGE_LIMIT = "36500d"


def arriving_files(
    spark: SparkSession, folder: str, pattern: str = "*.csv", files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Stream of new files in a folder, however old they are: path, modificationTime, length."""
    return (
        spark.readStream.format("binaryFile")
        .schema(LISTING_SCHEMA)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", NO_AGE_LIMIT)
        .load(folder)
        .select("path", "modificationTime", "length")
    )


def pick_up(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    stage_table: str,
    ledger_table: str,
    spec: IngestSpec,
    after_load: Callable[[DataFrame], object] | None = None,
    pattern: str = "*.csv",
    files_per_batch: int = FILES_PER_BATCH,
    root: str | None = None,
    surplus_table: str | None = SURPLUS_TABLE,
) -> StreamingQuery:
    """Load all files that arrived since the last call, then stop.

    Each batch replaces its files' partitions in the stage, so a batch that is run again after a failure leaves
    the same rows. `after_load` gets the files of the batch (path, file_name, ...) once their rows are stored.
    Records with more cells than their header are kept as in load_deliveries.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        # at most files_per_batch
        paths = [literal_path(row["path"]) for row in batch.select("path").collect()]
        if not paths:
            return
        files = load_deliveries(
            spark, paths, stage_table, ledger_table, spec, mode="replace", pattern=pattern, root=root, surplus_table=surplus_table
        )
        if after_load is not None:
            after_load(files)

    return (
        arriving_files(spark, folder, pattern, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def catch_up(
    spark: SparkSession,
    folder: str,
    stage_table: str,
    ledger_table: str,
    spec: IngestSpec,
    after_load: Callable[[DataFrame], object] | None = None,
    pattern: str = "*.csv",
    root: str | None = None,
    surplus_table: str | None = SURPLUS_TABLE,
) -> DataFrame:
    """Load what the stream passes over: files that were delivered again under a name it has seen.

    The folder's listing is compared with the ledger; only files that changed are read. Returns them.
    """
    files = load_deliveries(
        spark, folder, stage_table, ledger_table, spec, pattern=pattern, root=root, surplus_table=surplus_table
    )
    if after_load is not None and not files.isEmpty():
        after_load(files)
    return files


def stage_of_files(spark: SparkSession, stage_table: str, files: DataFrame) -> DataFrame:
    """The stage rows of some files; only their partitions are read."""
    return rows_of_files(spark, stage_table, files).drop(PARTITION_COLUMN)


def rebuild_terms(
    spark: SparkSession,
    stage_table: str,
    files: DataFrame,
    build: Callable[[DataFrame], Mapping[str, DataFrame]],
    database: str,
    replaced: Iterable[str],
    term_of: Callable[[str], Column] = F.col,
) -> DataFrame:
    """Rebuild output tables for the terms that loaded files hold, or held before they were delivered again.

    Rows of the same terms that other files brought are part of the result, so nothing is lost when a term is
    spread over several deliveries; terms that only an earlier version of a file had lose its rows. The index of terms
    says which files are to be read. Their rows of these terms are read from the stage once and kept beside it for
    all tables of `build`, until those are published. `term_of` gives a term as the tables hold it (see replace_terms): spellings that become
    the same term are rebuilt together. Returns the row counts of the tables.
    """
    if not index_of(spark, stage_table).exists():
        # a stage that was loaded before there was an index
        note_terms(spark, stage_table, spark.table(stage_table).select(F.col("FILE_ID").alias("file_id")).distinct())
    terms = touched_terms(spark, stage_table, files, database, term_of)
    rows = stage_of_terms(spark, stage_table, terms, term_of)
    kept = new_folder(spark, "touched")
    rows.write.parquet(kept)
    touched = spark.read.schema(rows.schema).parquet(kept)
    counts = replace_terms(touched, build(touched), database, replaced, terms=terms)
    remove_folder(spark, kept)
    note_rebuilt(spark, stage_table, files, database)
    return counts


def stage_of_terms(
    spark: SparkSession, stage_table: str, terms: DataFrame, term_of: Callable[[str], Column] = F.col
) -> DataFrame:
    """The stage rows of some terms (column term, as `term_of` gives them), from the files that hold one of them."""
    holding = files_holding(spark, stage_table, terms, term_of)
    wanted = terms.select(F.col("term").alias("wanted_term"))
    stage = stage_of_files(spark, stage_table, holding)
    return restrict(stage, wanted, [(term_of("term"), "wanted_term")], null_safe=True)
