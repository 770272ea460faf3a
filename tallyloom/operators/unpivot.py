"""Turning column groups into rows.

Every step reads the input once. Rows that can give nothing are dropped before they are multiplied, by null
checks the parquet scan can use to skip row groups. The columns of a group are gathered into an array and
exploded with their position: the generated code is one loop with one copy of the row condition, however many
columns there are, and no intermediate rows are built. Labels are put together after the condition, so their
cost follows the ticked boxes, not the columns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.flags import is_selected
from tallyloom.functions.text import label_or, null_text, with_other_text
from tallyloom.operators.conditions import any_of, any_present, flag_or_evidence


@dataclass(frozen=True)
class FlagColumn:
    """One checkbox: where it is, what it stands for, and the columns that go with it."""

    flag: str
    label: str
    code: int | None = None
    definition: str | None = None
    other_text: str | None = None
    slot: int | None = None


def unpivot_selected(
    df: DataFrame,
    flags: Sequence[FlagColumn],
    keep: Sequence[str],
    selected: Callable[[str], Column] = is_selected,
    count: str | None = None,
) -> DataFrame:
    """One row per ticked checkbox: the `keep` columns, then slot, code and label.

    `count` names a numeric column; a checkbox of slot n is then read only when the count reaches n.
    """
    with_definitions = any(f.definition for f in flags)
    with_other_texts = any(f.other_text for f in flags)
    companions = {}
    if with_definitions:
        companions["definitions"] = [f.definition for f in flags]
    if with_other_texts:
        companions["other_texts"] = [f.other_text for f in flags]
    keep_also = [] if count is None else [count]
    rows = _explode_flags(df.where(any_present(f.flag for f in flags)), flags, [*keep, *keep_also], companions)
    if count is not None:
        rows = rows.where(F.col(count) >= _constant([f.slot for f in flags], "int"))
    label = _constant([f.label for f in flags], "string")
    if with_definitions:
        label = label_or(_companion("definitions"), label)
    if with_other_texts:
        label = with_other_text(label, _companion("other_texts"))
    return rows.where(selected("flag")).select(
        *keep,
        _constant([f.slot for f in flags], "int").alias("slot"),
        _constant([f.code for f in flags], "int").alias("code"),
        label.alias("label"),
    )


def unpivot_evidenced(df: DataFrame, flags: Sequence[FlagColumn], keep: Sequence[str]) -> DataFrame:
    """One row per checkbox that is Y or whose accompanying column is filled, under its fixed label."""
    possible = df.where(any_of(flag_or_evidence(f.flag, _evidence(f)) for f in flags))
    rows = _explode_flags(possible, flags, keep, {"evidence": [_evidence(f) for f in flags]})
    label = _constant([f.label for f in flags], "string")
    return rows.where(flag_or_evidence("flag", _companion("evidence"))).select(*keep, label.alias("label"))


def unpivot_groups(
    df: DataFrame, groups: Mapping[int, Mapping[str, str]], keep: Sequence[str | Column], slot: str = "slot"
) -> DataFrame:
    """One row per repeating group: the `keep` columns, the group number, then the group's fields.

    `groups` maps a group number to {output column: input column}; all groups have the same fields.
    """
    structs = [
        F.struct(F.lit(number).alias(slot), *[F.col(source).alias(name) for name, source in group.items()])
        for number, group in groups.items()
    ]
    return df.select(*keep, F.inline(F.array(*structs)))


def _explode_flags(
    df: DataFrame, flags: Sequence[FlagColumn], keep: Sequence[str], companions: Mapping[str, Sequence[str | None]]
) -> DataFrame:
    """One row per flag column: `keep`, the arrays of companion columns, the flag's position and value."""
    arrays = [F.array(*[_optional(name) for name in names]).alias(array) for array, names in companions.items()]
    gathered = df.select(*keep, F.array(*[F.col(f.flag) for f in flags]).alias("flags"), *arrays)
    return gathered.select(*keep, *companions, F.posexplode("flags").alias("position", "flag"))


def _constant(values: Sequence, kind: str) -> Column:
    """The fixed value that belongs to the flag at the current position."""
    return F.element_at(F.array(*[F.lit(value).cast(kind) for value in values]), F.col("position") + 1)


def _companion(array: str) -> Column:
    """The companion column that belongs to the flag at the current position."""
    return F.element_at(array, F.col("position") + 1)


def _evidence(flag: FlagColumn) -> str | None:
    return flag.definition or flag.other_text


def _optional(name: str | None) -> Column:
    return null_text() if name is None else F.col(name)
