"""How respondents want to stay in contact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import option_picked, strict_id, strict_term
from tallyloom.functions.text import first_match
from tallyloom.operators.conditions import any_equals, require_present
from tallyloom.plans import specs

DIRECT_COLUMNS = ("stud_id", "term", "conn_to_psu")
CLEANED_COLUMNS = (*DIRECT_COLUMNS, "load_date")


def joined_labels() -> Column:
    """Labels of all picked options in their fixed order; null when none was picked."""
    labels = [F.when(option_picked(name), label) for name, label in specs.CONTACT_LABELS.items()]
    return F.nullif(F.concat_ws(", ", *labels), F.lit(""))


def first_definition() -> Column:
    """Definition that goes with the first option marked Y; it may be null."""
    return first_match([(F.col(name) == "Y", F.col(f"{name}_definition")) for name in specs.CONTACT_PRECEDENCE])


def direct(stage: DataFrame) -> DataFrame:
    """One row per respondent who marked an option, with the leading option's definition."""
    return stage.where(any_equals(specs.CONTACT_PRECEDENCE)).select(
        F.col("student_id").alias("stud_id"), "term", first_definition().alias("conn_to_psu")
    )


def cleaned(stage: DataFrame) -> DataFrame:
    """One row per respondent with a usable id, listing all picked options."""
    rows = stage.select(
        strict_id("student_id").alias("stud_id"),
        strict_term("term").alias("term"),
        joined_labels().alias("conn_to_psu"),
        F.col("LOAD_UTC_DT").alias("load_date"),
    )
    return require_present(rows, "stud_id")
