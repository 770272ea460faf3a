"""Column expressions. Everything here is a native Spark expression; no UDFs."""

from tallyloom.functions.flags import is_selected, is_selected_number, option_picked, yes_no, yes_no_number
from tallyloom.functions.keys import lenient_id, lenient_term, strict_id, strict_term, term_is_invalid
from tallyloom.functions.numbers import (
    amount,
    count_checked,
    count_or_null,
    count_truncated,
    count_whole,
    nan_to_null,
    semesters,
)
from tallyloom.functions.terms import academic_year, parse_term, season_label
from tallyloom.functions.text import blank_to_null, clip, label_or, left_nonblank, strip, with_other_text

__all__ = [
    "academic_year",
    "amount",
    "blank_to_null",
    "clip",
    "count_checked",
    "count_or_null",
    "count_truncated",
    "count_whole",
    "is_selected",
    "is_selected_number",
    "label_or",
    "left_nonblank",
    "lenient_id",
    "lenient_term",
    "nan_to_null",
    "option_picked",
    "parse_term",
    "season_label",
    "semesters",
    "strict_id",
    "strict_term",
    "strip",
    "term_is_invalid",
    "with_other_text",
    "yes_no",
    "yes_no_number",
]
