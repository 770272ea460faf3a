"""Respondent attributes: one row per respondent and term."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import clip, count_whole, strict_id, strict_term, term_is_invalid
from tallyloom.functions.text import decode, first_match, null_text
from tallyloom.operators.conditions import flag_or_evidence, require_present
from tallyloom.plans import specs

COLLECTION_METHOD_WIDTH = 50


def status_code() -> Column:
    """Code of the first plan marked Y, in order of precedence."""
    return first_match([(F.col(flag) == "Y", F.lit(code)) for flag, code in specs.STATUS_PRECEDENCE.items()])


def experience_indicators() -> dict[str, Column]:
    """Y where the flag is Y or its companion column is filled, otherwise null."""
    return {
        name: F.when(flag_or_evidence(flag, evidence), "Y")
        for name, (flag, evidence) in specs.EXPERIENCE_INDICATORS.items()
    }


def direct(stage: DataFrame) -> DataFrame:
    """All respondents as delivered, with the collection method spelled out."""
    indicators = experience_indicators()
    columns = {
        "stud_id": F.col("student_id"),
        "term": F.col("term"),
        "intern_numb": F.col("intern_count"),
        "coltn_mthd_cd": F.col("collection_method"),
        "coltn_mthd": decode("collection_method", specs.COLLECTION_METHODS),
        "indc_have_information": F.col("Have_PostGrad_Info"),
        "post_graduation_stat_cd": F.col("Plans_Cleaned"),
        "post_graduation_stat": F.col("plans_cleaned_definition"),
        "post_graduation_other": F.col("plans_other"),
        **_plans(job_assistance="SFT_assist", public_service=F.col("indicator_ps_committment")),
        **{name: indicators[name] for name in _BEFORE_NONE},
        "indc_exp_none": F.col("int_exp_none"),
        "exp_other_fill": F.col("int_exp_other_fill"),
        **{name: column for name, column in indicators.items() if name not in _BEFORE_NONE},
    }
    return stage.select(*[column.alias(name) for name, column in columns.items()])


def cleaned(stage: DataFrame) -> DataFrame:
    """Respondents with a usable id: repaired keys, counted internships, status by precedence."""
    columns = {
        "stud_id": strict_id("student_id"),
        "term": strict_term("term"),
        **{name: null_text() for name in ("camp_cd", "majr_cd", "majr_degr_cd", "reporting_coll_cd", "dept_cd")},
        "intern_numb": count_whole("intern_count"),
        "coltn_mthd_cd": null_text(),
        "coltn_mthd": clip("collection_method", COLLECTION_METHOD_WIDTH),
        "indc_have_information": F.col("Have_PostGrad_Info"),
        "post_graduation_stat_cd": status_code(),
        "post_graduation_stat": F.col("plans_cleaned_definition"),
        "post_graduation_other": F.col("plans_other"),
        **_plans(job_assistance="connect_assist", public_service=null_text()),
        **{name: F.col(specs.EXPERIENCE_INDICATORS[name][0]) for name in _BEFORE_NONE},
        "exp_other_fill": F.col("int_exp_other_fill"),
        "indc_exp_none": F.col("int_exp_none"),
        "invalid_term_indc": term_is_invalid("term"),
        "load_date": F.col("LOAD_UTC_DT"),
    }
    return require_present(stage.select(*[column.alias(name) for name, column in columns.items()]), "stud_id")


# indicators that stand before the "none" column in the output
_BEFORE_NONE = ("indc_exp_semAbroad", "indc_exp_AYEA", "indc_exp_embedded", "indc_exp_studorg", "indc_exp_other")


def _plans(job_assistance: str, public_service: Column) -> dict[str, Column]:
    return {
        "indc_intern": F.col("indicator_internship"),
        "indc_intl_exp": F.col("indicator_international_experience"),
        "indc_ug_rsrch": F.col("indicator_undergrad_research"),
        "indc_job_asst": F.col(job_assistance),
        "indc_conn_to_psu": F.col("indicator_stay_connected_PSU"),
        "indc_ft_empl": F.col("indicator_fulltime_employment"),
        "indc_pt_empl": F.col("indicator_parttime_employment"),
        "indc_any_empl": F.col("indicator_any_employment"),
        "indc_fut_edu": F.col("indicator_further_education"),
        "indc_publ_srvc": public_service,
        "indc_fell": F.col("indicator_fellowship"),
        "indc_post_intern_resid": F.col("indicator_post_intern_residency"),
        "indc_still_seeking": F.col("indicator_still_seeking"),
        "indc_mil": F.col("indicator_military"),
        "indc_entre": F.col("indicator_entrepreneurship"),
        "indc_other_plans": F.col("indicator_other_plans"),
    }
