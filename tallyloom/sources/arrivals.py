"""The days on which deliveries arrived, kept as ranges that each load extends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from tallyloom.operators.quality import day_ranges, days_between, merged_ranges
from tallyloom.sources.sinks import refresh_table


def note_arrivals(spark: SparkSession, table: str, arrivals: DataFrame, arrived: str | Column) -> None:
    """Adds the days of new arrivals to the stored ranges. Earlier arrivals are not read again."""
    ranges = day_ranges(arrivals, arrived)
    if spark.catalog.tableExists(table):
        ranges = merged_ranges(ranges.unionByName(spark.table(table)))
    refresh_table(ranges, table)


def missing_days_of(spark: SparkSession, table: str, alias: str = "missing_date") -> DataFrame:
    """Days between the first and the last arrival on which nothing arrived, from the stored ranges alone."""
    return days_between(spark.table(table), alias)
