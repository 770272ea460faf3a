"""Checks on tables: columns, row counts, dropped rows, missing calendar days."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions.keys import strict_id
from tallyloom.functions.text import column
from tallyloom.operators.sets import union_all


def missing_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Required column names that `df` lacks, compared without regard to case (column: column_name)."""
    present = {name.lower() for name in df.columns}
    return _names(df.sparkSession, [name for name in required if name.lower() not in present])


def has_columns(df: DataFrame, required: Iterable[str]) -> bool:
    """Whether all required columns are there. Runs a small job over the two name lists."""
    return missing_columns(df, required).isEmpty()


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: table_name, row_count."""
    return union_all(
        [
            frame.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, frame in tables.items()
        ]
    )


def distinct_count(df: DataFrame, name: str, alias: str) -> DataFrame:
    """One row with the number of distinct non-null values of a column."""
    # counting a deduplicated column lets every task fold its copies before anything is shuffled
    return df.select(name).distinct().agg(F.count(name).alias(alias))


def dropped_ids(df: DataFrame, name: str = "student_id") -> DataFrame:
    """How many rows have no usable respondent id, beside the number of rows read."""
    return df.agg(F.count("*").alias("rows_read"), F.count_if(strict_id(name).isNull()).alias("rows_dropped"))


def watch(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """`df` with counters that fill while it is written, sparing a second pass over the data."""
    observation = Observation()
    return df.observe(observation, *[metric.alias(name) for name, metric in metrics.items()]), observation


def observed(observation: Observation, *names: str) -> dict[str, int]:
    """The counters of `watch` once the frame was written.

    A frame that the optimiser knows to be empty is never run, and its observation gets no row: all counters are 0.
    """
    try:
        return observation.get
    except Py4JError:
        return dict.fromkeys(names, 0)


def missing_days(arrivals: DataFrame, arrived: str | Column, alias: str = "missing_date") -> DataFrame:
    """Calendar days between the first and last arrival on which nothing arrived.

    The arrivals shrink to distinct days before anything else happens; what follows is no larger than the
    calendar, however many arrivals there are.
    """
    days = arrivals.select(column(arrived).cast("date").alias(alias)).where(F.col(alias).isNotNull()).distinct()
    span = days.agg(F.min(alias).alias("first"), F.max(alias).alias("last")).where(F.col("first").isNotNull())
    calendar = span.select(F.explode(F.expr("sequence(first, last, interval 1 day)")).alias(alias))
    return calendar.join(days, alias, "left_anti")


def day_ranges(arrivals: DataFrame, arrived: str | Column) -> DataFrame:
    """The days on which something arrived as disjoint ranges (first, last) that do not touch each other.

    The arrivals shrink to distinct days before anything else happens.
    """
    days = arrivals.select(column(arrived).cast("date").alias("day")).where(F.col("day").isNotNull()).distinct()
    return merged_ranges(days.select(F.col("day").alias("first"), F.col("day").alias("last")))


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges of days (first, last) that overlap or touch, as one. No larger than a calendar, whatever arrived."""
    distinct = ranges.groupBy("first").agg(F.max("last").alias("last"))
    in_order = Window.orderBy("first")
    reach = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("first") > F.date_add(reach, 1), F.lit(True))
    numbered = distinct.withColumn("begins", begins.cast("int")).withColumn("number", F.sum("begins").over(in_order))
    return numbered.groupBy("number").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("number")


def days_between(ranges: DataFrame, alias: str = "missing_date") -> DataFrame:
    """The days between disjoint ranges: what missing_days finds in the arrivals the ranges came from."""
    following = F.lead("first").over(Window.orderBy("first"))
    gaps = ranges.withColumn("next", following).where("next IS NOT NULL")
    return gaps.select(F.explode(F.expr("sequence(date_add(last, 1), date_sub(next, 1), interval 1 day)")).alias(alias))


def _names(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(name,) for name in names], "column_name string")
