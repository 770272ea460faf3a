"""Loading every delivery once.

The ledger tells of the files loaded so far, one row each: file_id, file_name, fingerprint, modified and length. A file
is known by its place (file_id), so equal names in two folders are two files. It is a view over a log (`<ledger>__log`) to
which each run appends its files and nothing else; what the last run said about a file holds. A run looks only at the
entries of the files it has found.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.generations import with_partition_key
from tallyloom.operators.lookup import exclude, restrict
from tallyloom.operators.upkeep import create_partitioned_table, replace_partitions
from tallyloom.sources.deliveries import inspect_files, list_files
from tallyloom.sources.ingest import IngestSpec, read_deliveries, surplus_cells, with_more_commas
from tallyloom.sources.log import COMPACT_AFTER_RUNS, Log, latest
from tallyloom.sources.paths import literal_path
from tallyloom.sources.term_index import note_terms
from tallyloom.sources.workspace import cut_lineage

Mode = Literal["skip", "replace", "force"]
KnownBy = Literal["name and content", "name", "content", "name or content"]

# each entry excludes the files that agree in all of its columns
_MATCH_ON = {
    "name and content": [("file_id", "fingerprint")],
    "name": [("file_id",)],
    "content": [("fingerprint",)],
    "name or content": [("file_id",), ("fingerprint",)],
}
#: Where records with more cells than their header go, unless a run says otherwise.
SURPLUS_TABLE = "{stage}__surplus"
_NOTED = ("file_id", "file_name", "fingerprint", "modified", "length")


def not_yet_loaded(files: DataFrame, ledger: DataFrame, known_by: KnownBy = "name and content") -> DataFrame:
    """Files the ledger does not know. Measures the ledger (a small job or two)."""
    for names in _MATCH_ON[known_by]:
        files = _unknown(files, ledger, names)
    return files


def _unknown(files: DataFrame, ledger: DataFrame, names: Sequence[str]) -> DataFrame:
    known = ledger.select(*[F.col(name).alias(f"known_{name}") for name in names]).distinct()
    return exclude(files, known, [(name, f"known_{name}") for name in names])


def files_to_load(
    files: DataFrame, ledger: DataFrame, mode: Mode = "skip", known_by: KnownBy = "name and content"
) -> DataFrame:
    """Files a run has to read: new ones only, or all of them when replacing or forcing."""
    return not_yet_loaded(files, ledger, known_by) if mode == "skip" else files


def replace_files(target: DataFrame, new_rows: DataFrame, files: DataFrame) -> DataFrame:
    """`target` without the rows of `files` (column file_id), plus the new rows. Measures the ids."""
    ids = files.select(F.col("file_id").alias("replaced_file")).distinct()
    return exclude(target, ids, [("FILE_ID", "replaced_file")]).unionByName(new_rows)


def add_to_ledger(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """The ledger after loading `files`: what it had on them gives way."""
    names = [name for name in _NOTED if name in files.columns and name in ledger.columns]
    return _unknown(ledger.select(*names), files, ["file_id"]).unionByName(files.select(*names))


def _log_of(spark: SparkSession, ledger_table: str) -> Log:
    return Log(spark, f"{ledger_table}__log")


def entries_of(spark: SparkSession, ledger_table: str, files: DataFrame, *names: str) -> DataFrame | None:
    """What the ledger says now of files that agree with `files` in one of the columns; None if there is no ledger.

    Entries of other files are left out before anything is grouped.
    """
    log = _log_of(spark, ledger_table)
    if not log.exists():
        return None
    rows = log.rows()
    ids = None
    for name in names:
        wanted = files.select(F.col(name).alias("wanted")).distinct()
        # a file may have had this content once and another one since
        found = restrict(rows, wanted, [(name, "wanted")]).select(F.col("file_id").alias("entry_id")).distinct()
        ids = found if ids is None else ids.union(found).distinct()
    return latest(restrict(rows, ids, [("file_id", "entry_id")]), ["file_id"])


def _note(spark: SparkSession, ledger_table: str, files: DataFrame, after_runs: int = COMPACT_AFTER_RUNS) -> None:
    log = _log_of(spark, ledger_table)
    log.append(files.select(*_NOTED))
    if not spark.catalog.tableExists(ledger_table):
        base = f"coalesce((SELECT max(part_run) FROM {log.table} WHERE kind = 'base'), -1)"
        others = ", ".join(name for name in _NOTED if name != "file_id")
        spark.sql(
            f"CREATE VIEW {ledger_table} AS SELECT file_id, last.* FROM (SELECT file_id, max_by(struct({others}), run) AS last "
            f"FROM {log.table} WHERE (kind = 'base' AND part_run = {base}) OR (kind = 'run' AND part_run > {base}) GROUP BY file_id)"
        )
    log.compact(lambda rows: latest(rows, ["file_id"]), after_runs)


def _replace_rows(
    spark: SparkSession, table: str, rows: DataFrame, files: DataFrame, mode: Mode, clustered: bool = False
) -> None:
    # a layout without the plan of `rows`: counters in it are to fill while the rows are written
    create_partitioned_table(spark.createDataFrame([], rows.schema), table, key="FILE_ID")
    if mode == "force":
        with_partition_key(rows, "FILE_ID").select(*spark.table(table).columns).write.insertInto(table)
    else:
        replace_partitions(table, files.select(F.col("file_id").alias("FILE_ID")), rows, key="FILE_ID", clustered=clustered)


def load_deliveries(
    spark: SparkSession,
    paths: str | Sequence[str],
    stage_table: str,
    ledger_table: str,
    spec: IngestSpec,
    mode: Mode = "skip",
    known_by: KnownBy = "name and content",
    pattern: str = "*.csv",
    root: str | None = None,
    surplus_table: str | None = SURPLUS_TABLE,
    compact_after_runs: int = COMPACT_AFTER_RUNS,
) -> DataFrame:
    """Load files into a managed stage table, one partition per file, and note them in the ledger.

    Returns the files that were read. In modes skip and replace a file's partition is replaced, so a run that
    stopped half-way can simply be repeated; mode force adds the rows again. The stage is written before the
    ledger: a file is noted only when its rows are there. Mode skip does not open files whose place, time of
    change and length are in the ledger. With `root`, files keep their identity when
    the inbox as a whole is moved; all runs on a ledger must name the same one, or none.
    Records with more cells than the header are kept whole in `surplus_table`, by default one named after the stage;
    None leaves them out. The terms of each file are noted for `rebuild_terms` if the stage has a column `term`.
    """
    if spark.catalog.tableExists(ledger_table) and not _log_of(spark, ledger_table).exists():
        raise ValueError(f"{ledger_table} was stored before ledgers were logs; load into a new one")
    listing = list_files(spark, paths, pattern, root)
    known = entries_of(spark, ledger_table, listing, "file_id") if mode == "skip" else None
    if known is not None:
        # one path per new file comes to the driver, as in Spark's own file index
        changed = _unknown(listing, known, ["file_id", "modified", "length"]).select("path").collect()
        paths = [literal_path(row["path"]) for row in changed]
    if not paths:
        return listing.limit(0)
    noted = listing.select("file_id", "modified", "length")
    inspected = inspect_files(spark, paths, pattern, root).join(noted, "file_id")
    matched = {name for names in _MATCH_ON[known_by] for name in names if name == "file_id" or len(names) == 1}
    known = entries_of(spark, ledger_table, inspected, *sorted(matched)) if mode == "skip" else None
    todo = inspected if known is None else files_to_load(inspected, known, mode, known_by)
    # one pass over the files decides what to load; later steps must not see other answers
    todo = cut_lineage(todo)
    if todo.isEmpty():
        return todo
    counted = None if surplus_table is None else {}
    # readers go through the files in their order, so the rows of a file come to few tasks
    _replace_rows(spark, stage_table, read_deliveries(spark, todo, spec, counted), todo, mode, clustered=True)
    if surplus_table is not None:
        table = surplus_table.format(stage=stage_table)
        if spark.catalog.tableExists(table) or not with_more_commas(todo).isEmpty():
            _replace_rows(spark, table, surplus_cells(spark, todo, counted), todo, mode)
    note_terms(spark, stage_table, todo, compact_after_runs)
    _note(spark, ledger_table, todo, compact_after_runs)
    return todo
