"""Reading checkbox and yes/no answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import ColumnOrName, column, searched_strip, strip

# Answers that count as "box not ticked", as "no contact option", and the yes/no spellings.
NOT_SELECTED = ("", "0", "N", "NO", "NONE")
NOT_PICKED = ("", "N", "No")
YES_WORDS = ("Y", "YES", "TRUE", "T", "1")
NO_WORDS = ("N", "NO", "FALSE", "F", "0")


def is_selected(value: ColumnOrName) -> Column:
    """Whether a checkbox text counts as ticked, ignoring case and outer white space."""
    return ~F.upper(_stripped_answer(value)).isin(*NOT_SELECTED)


def is_selected_number(value: ColumnOrName) -> Column:
    """The same for a numeric or boolean checkbox: any value other than zero, NaN and null."""
    number = column(value).cast("double")
    return F.coalesce((number != 0) & ~F.isnan(number), F.lit(False))


def option_picked(value: ColumnOrName) -> Column:
    """Whether a contact option was taken. Case matters here: only '', N and No count as refusals."""
    return ~_stripped_answer(value).isin(*NOT_PICKED)


def yes_no(value: ColumnOrName) -> Column:
    """Y or N for the known spellings, the first letter for other text, null for blanks."""
    word = F.upper(strip(value))
    return (
        F.when(word.isin(*YES_WORDS), "Y")
        .when(word.isin(*NO_WORDS), "N")
        .otherwise(F.nullif(F.left(word, F.lit(1)), F.lit("")))
    )


def yes_no_number(value: ColumnOrName) -> Column:
    """Y or N for a numeric or boolean answer; null and NaN stay null."""
    number = column(value).cast("double")
    return F.when(number.isNull() | F.isnan(number), F.lit(None).cast("string")).otherwise(
        F.when(number != 0, "Y").otherwise("N")
    )


def _stripped_answer(value: ColumnOrName) -> Column:
    """Stripped text, null as empty text. The usual answers skip the search for white space."""
    answer = F.coalesce(column(value).cast("string"), F.lit(""))
    return F.when(answer.isin("", "Y", "N", "1", "0"), answer).otherwise(searched_strip(answer))
