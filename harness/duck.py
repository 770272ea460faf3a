"""DuckDB spellings of the text rules, written independently of the library's expressions."""

from __future__ import annotations

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"
NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


def strip(c: str) -> str:
    return f"trim({c}, {SPACES})"


def strict_id(c: str) -> str:
    return f"CASE WHEN {strip(c)} <> '' THEN lpad(right({strip(c)}, 9), 9, '0') END"


def lenient(c: str, width: int) -> str:
    return f"CASE WHEN length({strip(c)}) > {width} THEN {strip(c)} ELSE lpad({strip(c)}, {width}, '0') END"


def lenient_id(c: str) -> str:
    return lenient(c, 9)


def lenient_term(c: str) -> str:
    return lenient(c, 4)


def strict_term(c: str) -> str:
    return f"CASE WHEN regexp_full_match({strip(c)}, '[0-9]{{4}}') THEN {strip(c)} END"


def selected(c: str) -> str:
    return f"coalesce(upper({strip(c)}), '') NOT IN ('', '0', 'N', 'NO', 'NONE')"


def picked(c: str) -> str:
    return f"coalesce({strip(c)}, '') NOT IN ('', 'N', 'No')"


def yes_no(c: str) -> str:
    u = f"upper({strip(c)})"
    return (
        f"CASE WHEN {u} IN ('Y', 'YES', 'TRUE', 'T', '1') THEN 'Y' WHEN {u} IN ('N', 'NO', 'FALSE', 'F', '0') THEN 'N' "
        f"WHEN {u} <> '' THEN substr({u}, 1, 1) END"
    )


def number(c: str) -> str:
    return f"CASE WHEN regexp_full_match({strip(c)}, '{NUMBER}') THEN TRY_CAST({strip(c)} AS DOUBLE) END"


def whole_text(c: str) -> str:
    return f"CASE WHEN regexp_full_match({strip(c)}, '[+-]?[0-9]+') THEN TRY_CAST({strip(c)} AS INTEGER) END"


def count_truncated(c: str) -> str:
    return f"CAST(trunc({number(c)}) AS BIGINT)"


def count_whole(c: str) -> str:
    n = number(c)
    return f"CASE WHEN ({n}) = floor({n}) THEN CAST({n} AS BIGINT) END"


def labelled(definition: str | None, label: str, other: str | None) -> str:
    text = f"'{label}'" if definition is None else f"coalesce(nullif({strip(definition)}, ''), '{label}')"
    if other is None:
        return text
    return f"CASE WHEN {strip(other)} <> '' THEN {text} || ': ' || {strip(other)} ELSE {text} END"


def union_all(selects: list[str]) -> str:
    return "\nUNION ALL\n".join(selects)
