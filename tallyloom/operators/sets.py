"""Distinct values, unions and differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.lookup import exclude


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    """The distinct non-null values of one column."""
    return df.where(F.col(name).isNotNull()).select(name).distinct()


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, repeats kept."""
    return reduce(DataFrame.unionByName, frames)


def one_row_per(df: DataFrame, key: str) -> DataFrame:
    """One row per key, for frames whose other columns follow from the key."""
    return df.dropDuplicates([key])


def not_in(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in `known`; both sides use the same column name. Measures the known keys."""
    known_keys = known.select(F.col(key).alias("known_key")).distinct()
    return exclude(df, known_keys, [(key, "known_key")])
