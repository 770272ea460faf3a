"""International experience: one row per answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import lenient_id, lenient_term
from tallyloom.operators.sets import union_all
from tallyloom.operators.unpivot import unpivot_evidenced, unpivot_selected
from tallyloom.plans import specs

DIRECT_COLUMNS = ("stud_id", "term", "intl_exp_type")
CLEANED_COLUMNS = (*DIRECT_COLUMNS, "load_date")


def cleaned(stage: DataFrame, load_date: Column | None = None) -> DataFrame:
    """Ticked boxes, under the definition the respondent saw where there is one."""
    # keys are repaired before rows multiply: once per respondent
    keyed = stage.withColumns({"stud_id": lenient_id("student_id"), "term": lenient_term("term")})
    ticked = unpivot_selected(keyed, specs.INTL_EXPERIENCE, ["stud_id", "term"])
    return ticked.select(
        "stud_id",
        "term",
        F.col("label").alias("intl_exp_type"),
        (F.current_timestamp() if load_date is None else load_date).alias("load_date"),
    )


def direct_single(stage: DataFrame) -> DataFrame:
    """The answers that are kept as often as they were given."""
    return _evidenced(stage, specs.INTL_EXPERIENCE_SINGLE)


def direct_none(stage: DataFrame) -> DataFrame:
    """The two ways of saying that there was no experience, each once per respondent and term."""
    return _evidenced(stage, specs.INTL_EXPERIENCE_NONE).distinct()


def direct_revised(stage: DataFrame) -> DataFrame:
    """The five answers of the revised questionnaire, each once per respondent and term."""
    return _evidenced(stage, specs.INTL_EXPERIENCE_REVISED).distinct()


def direct(stage: DataFrame) -> DataFrame:
    """All twelve answers under fixed labels; a filled definition counts as an answer.

    The folded labels of the two groups differ, so folding both groups at once gives what folding each would.
    Only their rows are shuffled. The two branches read different answer columns, so beyond the keys no column
    is read twice.
    """
    folded = _evidenced(stage, specs.INTL_EXPERIENCE_NONE + specs.INTL_EXPERIENCE_REVISED).distinct()
    return union_all([direct_single(stage), folded])


def _evidenced(stage: DataFrame, flags) -> DataFrame:
    return unpivot_evidenced(stage, flags, ["student_id", "term"]).select(
        F.col("student_id").alias("stud_id"), "term", F.col("label").alias("intl_exp_type")
    )
