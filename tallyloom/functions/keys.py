"""Respondent and term keys. Text keys are padded with zeros, never with blanks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import ColumnOrName, blank_to_null, strip

ID_WIDTH = 9
TERM_WIDTH = 4


def strict_id(value: ColumnOrName) -> Column:
    """Nine characters: longer ids keep their last nine, shorter ones get zeros; blank means null."""
    # substring reads its text once, right() writes it out twice
    return F.lpad(F.substring(blank_to_null(value), -ID_WIDTH, ID_WIDTH), ID_WIDTH, "0")


def lenient_id(value: ColumnOrName) -> Column:
    """At least nine characters: shorter ids get zeros, longer ones are left whole; null stays null."""
    return _pad_only(value, ID_WIDTH)


def strict_term(value: ColumnOrName) -> Column:
    """The stripped term when it is exactly four digits, else null."""
    text = strip(value)
    return F.when(text.rlike("^[0-9]{4}$"), text)


def lenient_term(value: ColumnOrName) -> Column:
    """At least four characters, with no check of what they are; null stays null."""
    return _pad_only(value, TERM_WIDTH)


def term_is_invalid(value: ColumnOrName) -> Column:
    """N for a usable term, Y for anything else."""
    return F.when(strict_term(value).isNotNull(), "N").otherwise("Y")


def _pad_only(value: ColumnOrName, width: int) -> Column:
    # lpad alone would cut longer text down to `width`
    text = strip(value)
    return F.when(F.char_length(text) >= width, text).otherwise(F.lpad(text, width, "0"))
