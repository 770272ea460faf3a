"""Row conditions used by the builders."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import ColumnOrName, column, searched_strip


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions)


def any_present(columns: Iterable[ColumnOrName]) -> Column:
    """At least one of the columns is not null. Reaches the parquet scan as a pushed filter."""
    return any_of(column(c).isNotNull() for c in columns)


def any_equals(columns: Iterable[ColumnOrName], value: str = "Y") -> Column:
    """At least one of the columns holds exactly `value`."""
    return any_of(column(c) == value for c in columns)


def flag_or_evidence(flag: ColumnOrName, evidence: ColumnOrName | None = None) -> Column:
    """The flag is Y, or the column that goes with it holds something (even a blank)."""
    ticked = column(flag) == "Y"
    return ticked if evidence is None else ticked | column(evidence).isNotNull()


def not_blank(value: ColumnOrName) -> Column:
    """Present and not made of blanks only."""
    return F.trim(column(value)) != ""


def any_not_blank(columns: Iterable[ColumnOrName]) -> Column:
    """At least one of the columns holds something other than white space."""
    return F.concat_ws("", *[searched_strip(c) for c in columns]) != ""


def slot_reported(count: ColumnOrName, slot: ColumnOrName) -> Column:
    """The respondent reported at least as many items as the slot number says."""
    return column(count) >= column(slot)


def require_present(df: DataFrame, name: str) -> DataFrame:
    """Rows whose `name` is not null."""
    return df.where(F.col(name).isNotNull())
