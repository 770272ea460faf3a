"""Academic terms: four-digit codes (three digits of year, one of season) and labels in file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.numbers import whole_number
from tallyloom.functions.text import ColumnOrName, column, decode, strip

# Season codes in delivered file names.
SEASONS = {"SP": "Spring", "FA": "Fall", "SU": "Summer", "WN": "Winter"}
SPRING_DIGIT = 1


def parse_term(value: ColumnOrName) -> Column:
    """The term code as a number; anything that is no whole number becomes null."""
    return whole_number(strip(value))


def academic_year(term: ColumnOrName) -> Column:
    """Academic year a numeric term belongs to; a spring term belongs to the year before."""
    term = column(term)
    digit = F.pmod(term, F.lit(10))
    return (F.lit(1800) + (term - digit) / 10 - F.when(digit == SPRING_DIGIT, 1).otherwise(0)).cast("int")


def base_name(path: ColumnOrName) -> Column:
    """File name without its folders, for either kind of slash."""
    return F.regexp_extract(column(path), r"([^/\\]*)$", 1)


def season_label(path: ColumnOrName) -> Column:
    """Label such as ``2023-24 Spring`` from the first ``202324SP`` in a file name, else null."""
    name = base_name(path)
    pattern = "(?i)([0-9]{6})(" + "|".join(SEASONS) + ")"
    years = F.nullif(F.regexp_extract(name, pattern, 1), F.lit(""))
    code = F.upper(F.regexp_extract(name, pattern, 2))
    return F.concat(
        F.left(years, F.lit(4)), F.lit("-"), F.right(years, F.lit(2)), F.lit(" "), decode(code, SEASONS)
    )
