"""Numbers out of text. Unless the name says otherwise, text that is no number becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import ColumnOrName, column, searched_strip

# Text is matched before it is cast: try_cast alone raises and catches an error for every unusable value, which
# makes it several times slower on columns where such values are common.
INTEGER = r"^[+-]?[0-9]+$"
# Plain decimal notation. Spark's own text-to-double cast also takes Java spellings such as 2d or 0x1p3.
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INFINITE = r"^[+-]?(?i:inf|infinity)$"


def count_checked(value: ColumnOrName) -> Column:
    """Whole number, blank meaning null; the query fails on text that is no whole number."""
    text = F.nullif(F.trim(column(value)), F.lit(""))
    parsed = whole_number(text)
    return F.when(text.isNull() | parsed.isNotNull(), parsed).otherwise(
        F.raise_error(F.concat(F.lit("not a whole number: "), text)).cast("int")
    )


def count_or_null(value: ColumnOrName) -> Column:
    """As count_checked, but unusable text becomes null."""
    return whole_number(F.trim(column(value)))


def count_truncated(value: ColumnOrName) -> Column:
    """Any decimal number cut towards zero: 2.9 counts as 2."""
    return _decimal(value).try_cast("bigint")


def count_whole(value: ColumnOrName) -> Column:
    """Decimal notation of a whole number (2 or 2.0); a fraction becomes null."""
    number = _decimal(value)
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def semesters(value: ColumnOrName) -> Column:
    """Digits only: 2 is two, 2.0 is not understood."""
    return whole_number(searched_strip(value))


def whole_number(text: Column) -> Column:
    """Digits with an optional sign as an int; other text and numbers beyond an int become null."""
    return F.when(text.rlike(INTEGER), text.try_cast("int"))


def amount(value: ColumnOrName) -> Column:
    """A money amount as a double; currency signs and thousands separators make it null."""
    text = searched_strip(value)
    return F.when(text.rlike(DECIMAL) | text.rlike(INFINITE), text.try_cast("double"))


def nan_to_null(value: ColumnOrName) -> Column:
    """NaN of a double column as null, so that no sink ever sees one."""
    return F.nanvl(column(value), F.lit(None).cast("double"))


def _decimal(value: ColumnOrName) -> Column:
    text = searched_strip(value)
    return F.when(text.rlike(DECIMAL), text.try_cast("double"))
