"""Employment, further education, fellowship and public service answers, with looked-up names."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import left_nonblank
from tallyloom.functions.text import first_match, null_text, other_spelled_out
from tallyloom.operators.conditions import any_present
from tallyloom.operators.lookup import BROADCAST_LIMIT_BYTES, KeySketch, Lookup, lookup_join, measure, sketch_keys
from tallyloom.plans import specs
from tallyloom.plans.intern import company_lookup


def country_lookup(countries: DataFrame) -> Lookup:
    return Lookup(countries, "country", {"fell_ctry": "descr"})


def state_lookup(states: DataFrame) -> Lookup:
    """States of the home country only; a state code elsewhere finds nothing."""
    return Lookup(states, "STATE", {"fell_st": "descr"}, where=F.col("country") == specs.HOME_COUNTRY)


def school_lookup(schools: DataFrame) -> Lookup:
    """School names by the first characters of the branch code; branches of a school share them."""
    prefix = F.left("NSC_COLLEGE_AND_BRANCH_CODE", F.lit(specs.SCHOOL_CODE_WIDTH))
    return Lookup(schools, prefix, {"school_name": "NSC_COLLEGE_NAME"})


def organization_lookup(organizations: DataFrame) -> Lookup:
    """College names by external id."""
    is_college = F.col("ls_school_type") == specs.COLLEGE_TYPE
    return Lookup(organizations, "external_system_id", {"org_name": "descr50"}, where=is_college)


@dataclass(frozen=True)
class ResponseLookups:
    """The five lookups of a response row."""

    country: Lookup
    state: Lookup
    school: Lookup
    organization: Lookup
    company: Lookup

    @classmethod
    def of(cls, tables: Mapping[str, DataFrame]) -> ResponseLookups:
        """From tables named country, state, school, organization and company."""
        return cls(
            country_lookup(tables["country"]),
            state_lookup(tables["state"]),
            school_lookup(tables["school"]),
            organization_lookup(tables["organization"]),
            company_lookup(tables["company"]),
        )


def institution_name(term: Column, school: Column, organization: Column) -> Column:
    """School list name for older terms, organization name from then on; Unknown without a term.

    Terms are compared as text.
    """
    cut = specs.FIRST_TERM_WITH_ORG_NAMES
    return first_match([(term < cut, school), (term >= cut, organization), (term.isNull(), F.lit("Unknown"))])


def filled(stage: DataFrame) -> DataFrame:
    """Respondents who filled at least one response column."""
    return stage.where(any_present(specs.RESPONSE_EVIDENCE))


def response(stage: DataFrame, lookups: ResponseLookups, broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """One row per respondent and combination of lookup matches (no match counts as one)."""
    chain = (
        (lookups.country, "FS_country"),
        (lookups.state, "FS_state"),
        (lookups.school, "FE_college_code"),
        (lookups.organization, "FE_college_code"),
        (lookups.company, "EMP_company"),
    )
    measure(*[lookup for lookup, _ in chain])
    rows = filled(stage)
    # All keys are columns of the stage, so one pass over it sketches those of all lookups that are too large. Their
    # nulls are spread, not read apart: each split would run the joins before it twice.
    large = sorted({key for lookup, key in chain if lookup.measured_bytes > broadcast_limit})
    found = sketch_keys(rows, *[[key] for key in large]) if large else []
    sketches = {key: KeySketch(sketch.hot) for key, sketch in zip(large, found, strict=True)}
    for lookup, key in chain:
        rows = lookup_join(rows, lookup, key, broadcast_limit, ["student_id", "term"], sketches.get(key))
    columns = {
        "stud_id": F.col("student_id"),
        "term": F.col("term"),
        "publ_srvc_cd": F.col("PS_committment"),
        "publ_srvc": other_spelled_out("ps_committment_definition", "PS_committment_other"),
        "fell_pgrm_nm": F.col("FS_program"),
        "fell_city": F.col("FS_city"),
        "fell_st_cd": F.col("FS_state"),
        "fell_st": F.col("fell_st"),
        "fell_ctry_cd": F.col("FS_country"),
        "fell_ctry": F.col("fell_ctry"),
        "job_asst_email": F.col("SFT_email"),
        "edu_pursu_cd": F.col("FE_type"),
        "edu_pursu": F.col("FE_type_definition"),
        "edu_coll": F.col("FE_college"),
        "edu_appl_stg_cd": F.col("FE_stage"),
        "edu_appl_stg": F.col("FE_stage_definition"),
        "edu_offers_recv_numb": F.col("FE_offers"),
        "edu_crculm_nm": F.col("FE_program"),
        "edu_inst_cd": F.col("FE_college_code"),
        "edu_inst_nm": institution_name(F.col("term"), F.col("school_name"), F.col("org_name")),
        "empl_mth_job_offer_recv": F.col("EMP_Month"),
        "empl_yr_job_offer_recv": F.col("EMP_Year"),
        "empl_date_job_offer_recv": null_text(),
        "empl_numb_job_offers": F.col("offers_count"),
        "empl_co_nm": F.coalesce("standard_co_nm", "EMP_company"),
        "empl_dept": F.col("EMP_department"),
        "empl_title": F.col("EMP_title"),
        "empl_relate": F.col("EMP_relate"),
        "empl_ctry_cd": left_nonblank("EMP_country", 2),
        "empl_st_cd": F.col("EMP_state"),
        "empl_city": F.col("EMP_city"),
        "empl_sal": F.col("EMP_salary"),
        "empl_bonus_recv_indc": F.col("EMP_bonus"),
        "empl_bonus_amt": F.col("EMP_bonus_amount"),
        "empl_relo_indc": F.col("EMP_relocate"),
        "empl_relo_amt": F.col("EMP_relocate_amount"),
        "empl_job_pri_func_cd": F.col("EMP_functional"),
        "empl_job_pri_func": F.col("EMP_functional_definition"),
        "empld_dur_edu_indc": F.col("EMP_emp_edu"),
        "empld_dur_edu_cd": F.col("EMP_emp_edu_manner"),
        "empld_dur_edu": F.col("EMP_emp_edu_manner_definition"),
        "conxn_email": F.col("connect_email"),
        "conxn_cell_phone_no": F.col("connect_cell"),
        "empl_job_offer_timing_code": F.col("EMP_off_recv"),
        "EMP_remote": F.col("EMP_remote"),
        "EMP_remote_definition": F.col("EMP_remote_definition"),
        "FS_Province": F.col("FS_Province"),
    }
    return rows.select(*[column.alias(name) for name, column in columns.items()])
