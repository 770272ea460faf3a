"""Text helpers shared by the key, flag and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Every character Unicode calls white space. Spark's trim() removes blanks only, which would leave
# tabs, line ends and the no-break spaces that spreadsheets put into exported cells.
WHITESPACE = "".join(chr(point) for point in range(0x3001) if chr(point).isspace())

# ISO 8859-1 maps each byte to the code point of the same number, which leaves the bytes 0x80-0x9F as control
# characters where Windows-1252 has printable ones; these two strings turn one reading into the other.
_C1_RANGE = range(0x80, 0xA0)
_LATIN1_CONTROLS = "".join(chr(byte) for byte in _C1_RANGE)
_WINDOWS_CHARACTERS = "".join(bytes([byte]).decode("cp1252", errors="ignore") or chr(byte) for byte in _C1_RANGE)


def column(value: ColumnOrName) -> Column:
    """A column from a name or a column."""
    return F.col(value) if isinstance(value, str) else value


def null_text() -> Column:
    return F.lit(None).cast("string")


def strip(value: ColumnOrName) -> Column:
    """The text without leading and trailing white space of any kind; null stays null.

    Text that begins and ends with a printable ASCII character, as most does, skips the search: it has nothing to strip.
    """
    text = column(value).cast("string")
    bare = text.between("!", "~") & F.substring(text, -1, 1).between("!", "~")
    return F.when(bare, text).otherwise(searched_strip(text))


def searched_strip(value: ColumnOrName) -> Column:
    """As strip, without the short cut: for text that is known to need it, or where generated code must stay small."""
    return F.btrim(column(value).cast("string"), F.lit(WHITESPACE))


def blank_to_null(value: ColumnOrName) -> Column:
    """Stripped text, with nothing left meaning null."""
    return F.nullif(strip(value), F.lit(""))


def left_nonblank(value: ColumnOrName, width: int) -> Column:
    """First `width` characters after removing outer blanks; all-blank text becomes null."""
    return F.left(F.nullif(F.trim(column(value)), F.lit("")), F.lit(width))


def clip(value: ColumnOrName, width: int) -> Column:
    """First `width` characters of the untouched text; null becomes the empty text."""
    return F.substring(F.coalesce(column(value), F.lit("")), 1, width)


def label_or(definition: ColumnOrName, label: ColumnOrName) -> Column:
    """The respondent-facing definition when it says something, otherwise the fixed label."""
    return F.coalesce(blank_to_null(definition), column(label))


def with_other_text(label: ColumnOrName, other: ColumnOrName) -> Column:
    """``label: free text`` when free text was given, otherwise the bare label."""
    text = blank_to_null(other)
    return F.when(text.isNotNull(), F.concat(column(label), F.lit(": "), text)).otherwise(column(label))


def other_spelled_out(definition: ColumnOrName, other: ColumnOrName) -> Column:
    """``Other - free text`` for the definition Other (Unknown when no text), anything else unchanged."""
    definition = column(definition)
    return F.when(
        definition == "Other", F.concat(definition, F.lit(" - "), F.coalesce(column(other), F.lit("Unknown")))
    ).otherwise(definition)


def decode(value: ColumnOrName, meanings: dict) -> Column:
    """The meaning of a code, null for codes without one."""
    value = column(value)
    return first_match([(value == code, F.lit(meaning)) for code, meaning in meanings.items()])


def first_match(rules: list[tuple[Column, Column]]) -> Column:
    """The result of the first rule whose condition holds, null when none does."""
    (condition, result), *rest = rules
    chosen = F.when(condition, result)
    for condition, result in rest:
        chosen = chosen.when(condition, result)
    return chosen


def windows_text(value: Column) -> Column:
    """Text of a Windows-1252 file that was decoded as ISO 8859-1."""
    return F.translate(value, _LATIN1_CONTROLS, _WINDOWS_CHARACTERS)
