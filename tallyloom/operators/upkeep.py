"""Keeping target tables current: replacing rows by key and extending an insert-only dimension."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.terms import academic_year, parse_term
from tallyloom.operators.conditions import not_blank
from tallyloom.operators.generations import NULL_KEY, PARTITION_COLUMN, with_partition_key
from tallyloom.operators.lookup import exclude


def replace_by_key(
    target: DataFrame, stage: DataFrame, new_rows: DataFrame, key: str = "term", include_null_key: bool = True
) -> DataFrame:
    """`target` without the rows whose key occurs in `stage`, plus `new_rows`.

    A key that is in the stage but gives no new rows is cleared too. With `include_null_key` a null key counts
    like any other, so running the same stage twice changes nothing. Measures the distinct keys (one job).
    """
    keys = stage.select(F.col(key).alias("stage_key")).distinct()
    return exclude(target, keys, [(key, "stage_key")], null_safe=include_null_key).unionByName(new_rows)


def create_partitioned_table(df: DataFrame, table: str, key: str = "term") -> None:
    """An empty managed table with the columns of `df`, partitioned by its key; kept if it exists."""
    if not df.sparkSession.catalog.tableExists(table):
        with_partition_key(df.limit(0), key).write.partitionBy(PARTITION_COLUMN).format("parquet").saveAsTable(table)


def replace_partitions(
    table: str, stage: DataFrame, new_rows: DataFrame, key: str = "term", include_null_key: bool = True, clustered: bool = False
) -> None:
    """Persisted form of replace_by_key for a managed table made by create_partitioned_table.

    Only the partitions of the stage's keys are touched. The new rows are written beside the table first, so a
    failing computation leaves the table as it was; running again after any failure gives the right rows. Between the two
    steps of the exchange a reader misses the keys; `Generations` has no such gap and writes rows once. Rows are gathered by
    key before they are written, unless they are `clustered`: each task has rows of few keys, or all of a key.
    """
    spark = new_rows.sparkSession
    if spark.catalog.getTable(table).tableType != "MANAGED":
        raise ValueError(f"{table} is not a managed table: dropping its partitions would leave the files in place")
    incoming = f"{table}_incoming_{uuid.uuid4().hex}"
    try:
        spread = with_partition_key(new_rows, key)
        spread = spread if clustered else spread.hint("rebalance", PARTITION_COLUMN)
        spread.write.mode("overwrite").partitionBy(PARTITION_COLUMN).format("parquet").saveAsTable(incoming)

        keys = with_partition_key(stage.select(key).distinct(), key).select(PARTITION_COLUMN)
        if not include_null_key:
            keys = keys.where(F.col(PARTITION_COLUMN) != NULL_KEY)
        for names in _batches(keys.toLocalIterator(), 200):
            specs = ", ".join(f"PARTITION ({PARTITION_COLUMN} = {_quoted(row[0])})" for row in names)
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
        columns = spark.table(table).columns
        spark.table(incoming).select(*columns).write.insertInto(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {incoming}")


def new_term_labels(stage: DataFrame, existing: DataFrame | None = None, term: str = "term") -> DataFrame:
    """Label rows (term, acad_year, report_label) for the terms of the stage that have none yet.

    Existing rows are never changed. Without an existing table every term is new.
    """
    codes = stage.where(not_blank(term)).select(parse_term(term).alias("term"))
    terms = codes.where(F.col("term").isNotNull()).distinct()
    if existing is not None:
        terms = terms.join(existing.select(F.col("term").cast("int").alias("term")), "term", "left_anti")
    year = academic_year("term")
    return terms.select("term", year.alias("acad_year"), year.cast("string").alias("report_label"))


def maintain_term_labels(stage: DataFrame, existing: DataFrame | None = None, term: str = "term") -> DataFrame:
    """The label dimension after adding the stage's new terms."""
    added = new_term_labels(stage, existing, term)
    if existing is None:
        return added
    return existing.select("term", "acad_year", "report_label").unionByName(added)


def _batches(rows: Iterator, size: int) -> Iterator[list]:
    while batch := list(islice(rows, size)):
        yield batch


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
