"""Internships: up to three per respondent, one row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import amount, count_checked, count_or_null, lenient_id, lenient_term, semesters, yes_no
from tallyloom.functions.text import null_text
from tallyloom.operators.conditions import any_not_blank, any_present, not_blank, slot_reported
from tallyloom.operators.lookup import BROADCAST_LIMIT_BYTES, Lookup, lookup_join
from tallyloom.operators.unpivot import unpivot_groups
from tallyloom.plans import specs

DIRECT_COLUMNS = (
    "stud_id",
    "term",
    "intern_numb",
    "intern_co_nm",
    "intern_dept",
    "intern_job_title",
    "intern_len_wks",
    "indc_intern_paid",
    "intern_amt_paid",
)
CLEANED_COLUMNS = (
    *DIRECT_COLUMNS,
    "load_date",
    "intern_country",
    "intern_state",
    "intern_province",
    "intern_college_credit",
    "intern_semesters",
)


def company_lookup(variants: DataFrame) -> Lookup:
    """Standard company names by spelling (columns company_name_variant, standardized_company_name)."""
    return Lookup(variants, "company_name_variant", {"standard_co_nm": "standardized_company_name"})


def direct_slots(stage: DataFrame) -> DataFrame:
    """Every slot that names an organization, a unit or a title, as delivered."""
    groups = specs.intern_groups(specs.INTERN_DIRECT_FIELDS)
    evidence = ("raw_co_nm", "intern_dept", "intern_job_title")
    stage = stage.where(any_present(group[name] for group in groups.values() for name in evidence))
    keep = [F.col("student_id").alias("stud_id"), "term"]
    return unpivot_groups(stage, groups, keep, slot="intern_numb").where(any_present(evidence))


def direct(stage: DataFrame, companies: Lookup, broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Internships as delivered, with company spellings replaced by their standard name.

    The slots become rows first, so one join serves all three.
    """
    joined = lookup_join(direct_slots(stage), companies, "raw_co_nm", broadcast_limit)
    named = joined.withColumn("intern_co_nm", F.coalesce("standard_co_nm", "raw_co_nm"))
    return named.select(*DIRECT_COLUMNS)


def cleaned(stage: DataFrame, load_date: Column | None = None, fail_on_bad_count: bool = False) -> DataFrame:
    """Internships with repaired keys, for the slots the reported count covers and that are not blank."""
    read_count = count_checked if fail_on_bad_count else count_or_null
    groups = specs.intern_groups(specs.INTERN_CLEANED_FIELDS)
    counted = stage.where(not_blank("intern_count")).withColumn("reported", read_count("intern_count"))
    # keys are repaired before rows multiply: once per respondent
    keyed = counted.withColumns({"stud_id": lenient_id("student_id"), "term": lenient_term("term")})
    keep = ["stud_id", "term", "reported"]
    slots = unpivot_groups(keyed.where(F.col("reported") > 0), groups, keep, slot="intern_numb")
    filled = slots.where(slot_reported("reported", "intern_numb") & any_not_blank(specs.INTERN_CLEANED_FIELDS))
    return filled.withColumns(
        {
            "intern_len_wks": null_text(),
            "indc_intern_paid": yes_no("indc_intern_paid"),
            "intern_amt_paid": amount("intern_amt_paid"),
            "load_date": F.current_timestamp() if load_date is None else load_date,
            "intern_college_credit": yes_no("intern_college_credit"),
            "intern_semesters": semesters("intern_semesters"),
        }
    ).select(*CLEANED_COLUMNS)
