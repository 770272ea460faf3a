"""Output tables and their upkeep."""

from __future__ import annotations

from pyspark.sql import functions as F

from harness import carrier, duck
from harness.case import Case
from harness.row_cases import INTL_DIRECT_SQL, ticked_sql
from harness.work import scratch_database
from tallyloom.operators import quality, upkeep
from tallyloom.operators.generations import AuditError
from tallyloom.plans import conn_to_psu, intern, intl_exp, learned, response, runs, specs, stud_attr, term_labels
from tallyloom.plans.schema import REQUIRED_COLUMNS
from tallyloom.sources import lookups as lookup_source
from tallyloom.sources import sinks
from tallyloom.sources.workspace import new_folder

S = carrier.stage_sql()
_ID, _TERM = duck.lenient_id("student_id"), duck.lenient_term("term")
_COUNT = "CASE WHEN regexp_full_match(trim(intern_count), '[+-]?[0-9]+') THEN TRY_CAST(trim(intern_count) AS INTEGER) END"
_FIELDS = ("organization", "title", "unit", "paid", "paid_amt", "country", "state", "province", "college_credit", "semesters")


def _response_lookups(spark, sf_dir, company="company"):
    tables = carrier.lookups(spark, sf_dir)
    return response.ResponseLookups.of({**tables, "company": carrier.lookup(spark, sf_dir, company)})


def _companies(spark, sf_dir, name="company"):
    return intern.company_lookup(carrier.lookup(spark, sf_dir, name))


def _as_text(df, *names):
    """Timestamps as text, so that both engines show them alike."""
    return df.withColumns({name: F.col(name).cast("string") for name in names})


# ---- the oracles of the output tables ---------------------------------------------------------------------------


def response_sql(company="company"):
    return (
        carrier.stage_sql("country", "state", "school", "organization", company)
        + f"""SELECT a.student_id AS stud_id, a.term, a.PS_committment AS publ_srvc_cd,
CASE WHEN a.ps_committment_definition = 'Other' THEN a.ps_committment_definition || ' - ' || coalesce(a.PS_committment_other, 'Unknown')
ELSE a.ps_committment_definition END AS publ_srvc,
a.FS_program AS fell_pgrm_nm, a.FS_city AS fell_city, a.FS_state AS fell_st_cd, s.descr AS fell_st,
a.FS_country AS fell_ctry_cd, c.descr AS fell_ctry, a.SFT_email AS job_asst_email, a.FE_type AS edu_pursu_cd,
a.FE_type_definition AS edu_pursu, a.FE_college AS edu_coll, a.FE_stage AS edu_appl_stg_cd, a.FE_stage_definition AS edu_appl_stg,
a.FE_offers AS edu_offers_recv_numb, a.FE_program AS edu_crculm_nm, a.FE_college_code AS edu_inst_cd,
CASE WHEN a.term < '2165' THEN n.NSC_COLLEGE_NAME WHEN a.term >= '2165' THEN o.descr50 ELSE 'Unknown' END AS edu_inst_nm,
a.EMP_Month AS empl_mth_job_offer_recv, a.EMP_Year AS empl_yr_job_offer_recv, CAST(NULL AS VARCHAR) AS empl_date_job_offer_recv,
a.offers_count AS empl_numb_job_offers, coalesce(m.standardized_company_name, a.EMP_company) AS empl_co_nm,
a.EMP_department AS empl_dept, a.EMP_title AS empl_title, a.EMP_relate AS empl_relate,
left(nullif(trim(a.EMP_country), ''), 2) AS empl_ctry_cd, a.EMP_state AS empl_st_cd, a.EMP_city AS empl_city,
a.EMP_salary AS empl_sal, a.EMP_bonus AS empl_bonus_recv_indc, a.EMP_bonus_amount AS empl_bonus_amt,
a.EMP_relocate AS empl_relo_indc, a.EMP_relocate_amount AS empl_relo_amt, a.EMP_functional AS empl_job_pri_func_cd,
a.EMP_functional_definition AS empl_job_pri_func, a.EMP_emp_edu AS empld_dur_edu_indc, a.EMP_emp_edu_manner AS empld_dur_edu_cd,
a.EMP_emp_edu_manner_definition AS empld_dur_edu, a.connect_email AS conxn_email, a.connect_cell AS conxn_cell_phone_no,
a.EMP_off_recv AS empl_job_offer_timing_code, a.EMP_remote, a.EMP_remote_definition, a.FS_Province
FROM stage a
LEFT JOIN lk_country c ON a.FS_country = c.country
LEFT JOIN lk_state s ON a.FS_state = s.STATE AND s.country = 'USA'
LEFT JOIN lk_school n ON a.FE_college_code = left(n.NSC_COLLEGE_AND_BRANCH_CODE, 6)
LEFT JOIN lk_organization o ON a.FE_college_code = o.external_system_id AND o.ls_school_type = 'COL'
LEFT JOIN lk_{company} m ON a.EMP_company = m.company_name_variant
WHERE """
        + " OR ".join(f"a.{c} IS NOT NULL" for c in specs.RESPONSE_EVIDENCE)
    )


_PLANS = """indicator_internship AS indc_intern, indicator_international_experience AS indc_intl_exp,
indicator_undergrad_research AS indc_ug_rsrch, {assist} AS indc_job_asst, indicator_stay_connected_PSU AS indc_conn_to_psu,
indicator_fulltime_employment AS indc_ft_empl, indicator_parttime_employment AS indc_pt_empl,
indicator_any_employment AS indc_any_empl, indicator_further_education AS indc_fut_edu, {service} AS indc_publ_srvc,
indicator_fellowship AS indc_fell, indicator_post_intern_residency AS indc_post_intern_resid,
indicator_still_seeking AS indc_still_seeking, indicator_military AS indc_mil, indicator_entrepreneurship AS indc_entre,
indicator_other_plans AS indc_other_plans"""


def _yes_if(flag, evidence, out):
    return f"CASE WHEN {flag} = 'Y' OR {evidence} IS NOT NULL THEN 'Y' END AS {out}"


STUD_ATTR_DIRECT_SQL = f"""{S}SELECT student_id AS stud_id, term, intern_count AS intern_numb, collection_method AS coltn_mthd_cd,
CASE collection_method WHEN '0' THEN 'Did not collect/or respond' WHEN '1' THEN 'Survey'
WHEN '2' THEN 'NSLC -- National Student Clearinghouse' WHEN '3' THEN 'Smeal Business  School'
WHEN '4' THEN 'Eberly College of Science' END AS coltn_mthd,
Have_PostGrad_Info AS indc_have_information, Plans_Cleaned AS post_graduation_stat_cd,
plans_cleaned_definition AS post_graduation_stat, plans_other AS post_graduation_other,
{_PLANS.format(assist="SFT_assist", service="indicator_ps_committment")},
{", ".join(_yes_if(*specs.EXPERIENCE_INDICATORS[name], name) for name in specs.EXPERIENCE_INDICATORS)},
int_exp_none AS indc_exp_none, int_exp_other_fill AS exp_other_fill FROM stage"""

STUD_ATTR_CLEANED_SQL = f"""{S}SELECT {duck.strict_id("student_id")} AS stud_id, {duck.strict_term("term")} AS term,
CAST(NULL AS VARCHAR) AS camp_cd, CAST(NULL AS VARCHAR) AS majr_cd, CAST(NULL AS VARCHAR) AS majr_degr_cd,
CAST(NULL AS VARCHAR) AS reporting_coll_cd, CAST(NULL AS VARCHAR) AS dept_cd,
{duck.count_whole("intern_count")} AS intern_numb, CAST(NULL AS VARCHAR) AS coltn_mthd_cd,
substr(coalesce(collection_method, ''), 1, 50) AS coltn_mthd, Have_PostGrad_Info AS indc_have_information,
CASE WHEN indicator_fulltime_employment = 'Y' THEN 1 WHEN indicator_parttime_employment = 'Y' THEN 2
WHEN indicator_further_education = 'Y' THEN 3 WHEN indicator_fellowship = 'Y' THEN 4 WHEN indicator_military = 'Y' THEN 5
WHEN indicator_still_seeking = 'Y' THEN 6 WHEN indicator_other_plans = 'Y' THEN 9 END AS post_graduation_stat_cd,
plans_cleaned_definition AS post_graduation_stat, plans_other AS post_graduation_other,
{_PLANS.format(assist="connect_assist", service="CAST(NULL AS VARCHAR)")},
int_exp_semAbroad AS indc_exp_semAbroad, int_exp_AYEA AS indc_exp_AYEA, int_exp_embedded AS indc_exp_embedded,
int_exp_studorg AS indc_exp_studorg, int_exp_other AS indc_exp_other, int_exp_other_fill AS exp_other_fill,
int_exp_none AS indc_exp_none,
CASE WHEN coalesce(regexp_full_match({duck.strip("term")}, '[0-9]{{4}}'), false) THEN 'N' ELSE 'Y' END AS invalid_term_indc,
CAST(LOAD_UTC_DT AS VARCHAR) AS load_date
FROM stage WHERE {duck.strip("student_id")} <> ''"""


def intern_direct_sql(company="company", where="true"):
    selects = [
        f"""SELECT s.student_id AS stud_id, s.term, {n} AS intern_numb,
coalesce(m.standardized_company_name, s.intern_organization{n}) AS intern_co_nm, s.intern_unit{n} AS intern_dept,
s.intern_title{n} AS intern_job_title, s.intern_exp{n} AS intern_len_wks, s.intern_paid{n} AS indc_intern_paid,
s.intern_paid_amt{n} AS intern_amt_paid
FROM stage s LEFT JOIN lk_{company} m ON s.intern_organization{n} = m.company_name_variant
WHERE (s.intern_organization{n} IS NOT NULL OR s.intern_unit{n} IS NOT NULL OR s.intern_title{n} IS NOT NULL) AND ({where})"""
        for n in (1, 2, 3)
    ]
    return carrier.stage_sql(company) + duck.union_all(selects)


def intern_cleaned_body():
    return duck.union_all(
        [
            f"""SELECT {_ID} AS stud_id, {_TERM} AS term, {n} AS intern_numb, intern_organization{n} AS intern_co_nm,
intern_unit{n} AS intern_dept, intern_title{n} AS intern_job_title, CAST(NULL AS VARCHAR) AS intern_len_wks,
{duck.yes_no(f"intern_paid{n}")} AS indc_intern_paid, {duck.number(f"intern_paid_amt{n}")} AS intern_amt_paid,
intern_country{n} AS intern_country, intern_state{n} AS intern_state, intern_province{n} AS intern_province,
{duck.yes_no(f"intern_college_credit{n}")} AS intern_college_credit, {duck.whole_text(f"intern_semesters{n}")} AS intern_semesters
FROM stage WHERE {_COUNT} >= {n} AND ({" OR ".join(f"{duck.strip(f'intern_{f}{n}')} <> ''" for f in _FIELDS)})"""
            for n in (1, 2, 3)
        ]
    )


INTERN_CLEANED_SQL = S + intern_cleaned_body()


def _key_sql():
    return f"{_ID} AS stud_id, {_TERM} AS term"


INTL_CLEANED_SQL = (
    "SELECT stud_id, term, label AS intl_exp_type FROM (" + ticked_sql(specs.INTL_EXPERIENCE, key=_key_sql()) + ")"
)
INTERN_LEARNED_SQL = (
    "SELECT stud_id, term, slot AS intern_nbr, code AS intern_lrned_abt_cd, label AS intern_lrned_abt FROM ("
    + ticked_sql(specs.INTERN_LEARNED, key=_key_sql(), gate=duck.count_truncated("intern_count"))
    + ")"
)
JOB_LEARNED_SQL = (
    "SELECT stud_id, term, code AS empl_lrned_abt_job_cd, label AS empl_lrned_abt_job FROM ("
    + ticked_sql(specs.JOB_LEARNED, key=f"Have_PostGrad_Info, {_key_sql()}")
    + ") WHERE Have_PostGrad_Info IS NOT NULL"
)

_CONN_FIRST = """CASE WHEN connect_assist = 'Y' THEN connect_assist_definition WHEN connect_emp_panel = 'Y' THEN connect_emp_panel_definition
WHEN connect_ldship = 'Y' THEN connect_ldship_definition WHEN connect_mentor = 'Y' THEN connect_mentor_definition
WHEN connect_network = 'Y' THEN connect_network_definition WHEN connect_no = 'Y' THEN connect_no_definition END"""
_CONN_ANY = " OR ".join(f"connect_{c} = 'Y'" for c in ("assist", "emp_panel", "ldship", "mentor", "network", "no"))
CONN_DIRECT_SQL = f"{S}SELECT student_id AS stud_id, term, {_CONN_FIRST} AS conn_to_psu FROM stage WHERE {_CONN_ANY}"
_CONN_LIST = ", ".join(f"CASE WHEN {duck.picked(c)} THEN '{label}' END" for c, label in specs.CONTACT_LABELS.items())
CONN_CLEANED_SQL = f"""{S}SELECT {duck.strict_id("student_id")} AS stud_id, {duck.strict_term("term")} AS term,
nullif(concat_ws(', ', {_CONN_LIST}), '') AS conn_to_psu, CAST(LOAD_UTC_DT AS VARCHAR) AS load_date
FROM stage WHERE {duck.strip("student_id")} <> ''"""

_LABELS = f""", numbered AS (SELECT DISTINCT {duck.whole_text("term")} AS term FROM stage WHERE trim(term) <> ''),
derived AS (SELECT term, CAST(2000 + (term // 10 - 200) - CASE WHEN term % 10 = 1 THEN 1 ELSE 0 END AS INTEGER) AS acad_year
FROM numbered WHERE term IS NOT NULL)
"""
LABELS_SQL = S.rstrip() + _LABELS + "SELECT term, acad_year, CAST(acad_year AS VARCHAR) AS report_label FROM derived"
LABELS_KEPT_SQL = (
    S.rstrip()
    + _LABELS
    + "SELECT term, acad_year, CASE WHEN term < 2160 THEN 'as it was' ELSE CAST(acad_year AS VARCHAR) END AS report_label FROM derived"
)


def _with_existing_labels(spark, sf_dir):
    stage = carrier.stage(spark, sf_dir)
    existing = term_labels.additions(stage).where("term < 2160").withColumn("report_label", F.lit("as it was"))
    return stage, existing


TABLES = [
    Case("response", "T1", lambda s, d: response.response(carrier.stage(s, d), _response_lookups(s, d)), response_sql()),
    Case(
        "response_repeated_spellings",
        "D7",
        lambda s, d: response.response(carrier.stage(s, d), _response_lookups(s, d, "company_repeated")),
        response_sql("company_repeated"),
    ),
    Case("stud_attr_direct", "T2", lambda s, d: stud_attr.direct(carrier.stage(s, d)), STUD_ATTR_DIRECT_SQL),
    Case(
        "stud_attr_cleaned",
        "T3",
        lambda s, d: _as_text(stud_attr.cleaned(carrier.stage(s, d)), "load_date"),
        STUD_ATTR_CLEANED_SQL,
    ),
    Case("intern_direct", "T4", lambda s, d: intern.direct(carrier.stage(s, d), _companies(s, d)), intern_direct_sql()),
    Case("intern_cleaned", "T5", lambda s, d: intern.cleaned(carrier.stage(s, d)).drop("load_date"), INTERN_CLEANED_SQL),
    Case("intl_exp_direct", "T6", lambda s, d: intl_exp.direct(carrier.stage(s, d)), INTL_DIRECT_SQL),
    Case("intl_exp_cleaned", "T7", lambda s, d: intl_exp.cleaned(carrier.stage(s, d)).drop("load_date"), INTL_CLEANED_SQL),
    Case("conn_to_psu_direct", "T8", lambda s, d: conn_to_psu.direct(carrier.stage(s, d)), CONN_DIRECT_SQL),
    Case(
        "conn_to_psu_cleaned",
        "T9",
        lambda s, d: _as_text(conn_to_psu.cleaned(carrier.stage(s, d)), "load_date"),
        CONN_CLEANED_SQL,
    ),
    Case(
        "intern_lrned", "T10", lambda s, d: learned.intern_learned(carrier.stage(s, d)).drop("load_date"), INTERN_LEARNED_SQL
    ),
    Case("empl_job_lrned", "T11", lambda s, d: learned.job_learned(carrier.stage(s, d)).drop("load_date"), JOB_LEARNED_SQL),
    Case("acadyear_labels", "T12", lambda s, d: term_labels.maintained(carrier.stage(s, d)), LABELS_SQL),
]


# ---- upkeep -------------------------------------------------------------------------------------------------------


def _early(spark, sf_dir):
    """The part of the stage with orders before 1999: what an earlier run loaded."""
    return carrier.stage(spark, sf_dir).where("LOAD_UTC_DT < '1999-01-01'")


def _late(spark, sf_dir):
    """The part with orders from mid-1998 on, which overlaps the early part."""
    return carrier.stage(spark, sf_dir).where("LOAD_UTC_DT >= '1998-07-01'")


def _replaced(spark, sf_dir):
    target = conn_to_psu.direct(_early(spark, sf_dir))
    late = _late(spark, sf_dir)
    return upkeep.replace_by_key(target, late, conn_to_psu.direct(late))


_REPLACED_SQL = f"""{S}SELECT student_id AS stud_id, term, {_CONN_FIRST} AS conn_to_psu FROM stage
WHERE ({_CONN_ANY}) AND LOAD_UTC_DT < TIMESTAMP '1999-01-01'
AND NOT EXISTS (SELECT 1 FROM stage l WHERE l.LOAD_UTC_DT >= TIMESTAMP '1998-07-01' AND l.term IS NOT DISTINCT FROM stage.term)
UNION ALL
SELECT student_id AS stud_id, term, {_CONN_FIRST} AS conn_to_psu FROM stage WHERE ({_CONN_ANY}) AND LOAD_UTC_DT >= TIMESTAMP '1998-07-01'"""


def _replaced_partitions(spark, sf_dir):
    """The same on a stored table, loading the late part twice."""
    database = scratch_database(spark)
    for stage in (_early(spark, sf_dir), _late(spark, sf_dir), _late(spark, sf_dir)):
        runs.replace_terms(stage, {"conn_to_psu": conn_to_psu.direct(stage)}, database, replaced=["conn_to_psu"])
    return spark.table(f"{database}.conn_to_psu").select(*conn_to_psu.DIRECT_COLUMNS)


def _all_inserts(spark, sf_dir):
    """Row counts after writing every direct table into an empty database."""
    stage = carrier.stage(spark, sf_dir)
    return runs.replace_terms(
        stage, runs.direct_tables(stage, _response_lookups(spark, sf_dir)), scratch_database(spark)
    )


def _counted(sql, name):
    return f"SELECT '{name}' AS table_name, (SELECT count(*) FROM ({sql})) AS row_count"


_DIRECT_COUNTS_SQL = duck.union_all(
    [
        _counted(STUD_ATTR_DIRECT_SQL, "stud_attr"),
        _counted(response_sql(), "response"),
        _counted(intern_direct_sql(), "intern"),
        _counted(INTL_DIRECT_SQL, "intl_exp"),
        _counted(CONN_DIRECT_SQL, "conn_to_psu"),
    ]
)


def _labels_twice(spark, sf_dir):
    """Maintaining the dimension again with the same stage changes nothing."""
    stage, existing = _with_existing_labels(spark, sf_dir)
    return term_labels.maintained(stage, term_labels.maintained(stage, existing))


def _refreshed_builder(spark, sf_dir):
    """Builders written one after the other to the same place: each refresh leaves only the last result."""
    path = new_folder(spark, "refresh")
    sinks.write(intl_exp.cleaned(_early(spark, sf_dir)), path)
    sinks.write(intl_exp.cleaned(carrier.stage(spark, sf_dir)), path, intl_exp.CLEANED_COLUMNS)
    return spark.read.parquet(path).select(*intl_exp.DIRECT_COLUMNS)


def _full_run_counts(spark, sf_dir):
    stage = carrier.stage(spark, sf_dir)
    return quality.row_counts(runs.full_tables(stage, _response_lookups(spark, sf_dir)))


def _full_run_stored(times):
    def run(spark, sf_dir):
        database = scratch_database(spark)
        for _ in range(times):
            counts = runs.run_full(carrier.stage(spark, sf_dir), _response_lookups(spark, sf_dir), database)
        return counts

    return run


def _full_run_audited(spark, sf_dir):
    """A run whose checks fail publishes nothing; the next one passes, and its counts were taken while it wrote."""
    database = scratch_database(spark)
    stage, lookups = carrier.stage(spark, sf_dir), _response_lookups(spark, sf_dir)
    try:
        runs.run_full(stage, lookups, database, checks=[runs.share_without_id(0.0)])
        raise AssertionError("respondents without an id must not pass")
    except AuditError:
        pass
    return runs.run_full(stage, lookups, database, checks=[runs.share_without_id(0.5), runs.not_empty("response", "intern")])


def _labels_stored(spark, sf_dir):
    """The stored dimension after an early stage and the whole one."""
    database = scratch_database(spark)
    for stage in (_early(spark, sf_dir), carrier.stage(spark, sf_dir)):
        runs.store_labels(stage, database)
    return spark.table(f"{database}.{runs.LABELS}")


_FULL_COUNTS_SQL = duck.union_all(
    [
        _counted(response_sql(), "response"),
        _counted(CONN_CLEANED_SQL, "conn_to_psu"),
        _counted(LABELS_SQL, "acadyear_labels"),
        _counted(JOB_LEARNED_SQL, "empl_job_lrned"),
        _counted(INTERN_CLEANED_SQL, "intern"),
        _counted(INTERN_LEARNED_SQL, "intern_lrned"),
        _counted(INTL_CLEANED_SQL, "intl_exp"),
        _counted(STUD_ATTR_CLEANED_SQL, "stud_attr"),
    ]
)

UPKEEP = [
    Case("replace_by_term", "I1", _replaced, _REPLACED_SQL),
    Case("replace_by_term_stored", "I1", _replaced_partitions, _REPLACED_SQL),
    Case("insert_all_direct_tables", "I2, I6", _all_inserts, _DIRECT_COUNTS_SQL),
    Case(
        "label_dimension_extended",
        "I3",
        lambda s, d: term_labels.maintained(*_with_existing_labels(s, d)),
        LABELS_KEPT_SQL,
    ),
    Case("label_dimension_unchanged_on_rerun", "I3", _labels_twice, LABELS_KEPT_SQL),
    Case("full_refresh_builder", "I4", _refreshed_builder, INTL_CLEANED_SQL),
    Case("full_run_stored", "I4, I6", _full_run_stored(1), _FULL_COUNTS_SQL),
    Case("full_run_stored_twice", "I4, I6", _full_run_stored(2), _FULL_COUNTS_SQL),
    Case("full_run_audited", "I5, I6, I7", _full_run_audited, _FULL_COUNTS_SQL),
    Case("label_dimension_stored", "I3", _labels_stored, LABELS_SQL),
    Case(
        "required_columns_of_stage",
        "I5",
        lambda s, d: quality.missing_columns(carrier.stage(s, d).drop("term", "EMP_salary"), REQUIRED_COLUMNS),
        "SELECT column_name FROM (VALUES ('term'), ('EMP_salary')) AS missing(column_name)",
    ),
    Case(
        "load_timestamp_given",
        "B23",
        lambda s, d: intern.cleaned(carrier.stage(s, d), F.lit("2024-01-02 03:04:05").cast("timestamp")).select(
            "stud_id", "term", "intern_numb", F.col("load_date").cast("string").alias("load_date")
        ),
        f"SELECT stud_id, term, intern_numb, '2024-01-02 03:04:05' AS load_date FROM ({INTERN_CLEANED_SQL})",
    ),
    Case("full_run_row_counts", "I4, I6", _full_run_counts, _FULL_COUNTS_SQL),
    Case(
        "dropped_respondent_ids",
        "I7",
        lambda s, d: quality.dropped_ids(carrier.stage(s, d)),
        f"{S}SELECT count(*) AS rows_read, count(*) FILTER (coalesce({duck.strip('student_id')}, '') = '') AS rows_dropped FROM stage",
    ),
]


# ---- scans and sinks --------------------------------------------------------------------------------------------------


def _extract_case(table, columns_sql, where=None):
    def run(spark, sf_dir):
        rows = lookup_source.stage_extract(carrier.stage(spark, sf_dir), table)
        return _as_text(rows, "LOAD_UTC_DT") if "LOAD_UTC_DT" in rows.columns else rows

    condition = "" if where is None else f" WHERE {where}"
    return Case(f"stage_scan_{table}", "A12", run, f"{S}SELECT {columns_sql} FROM stage{condition}")


_COUNT_PRESENT = "intern_count IS NOT NULL AND trim(intern_count) <> ''"
_SLOT_STEMS = ("organization", "country", "state", "province", "unit", "title", "exp", "paid", "paid_amt", "college_credit", "semesters")
_OPTIONS = [f"{code:02d}" for code in range(1, 15)] + ["other", "other_fill"]
_CONTACT_SQL = ", ".join(specs.CONTACT_LABELS)

SCANS = [
    _extract_case(
        "intern",
        f"student_id AS stud_id, term, {_COUNT} AS intern_count, "
        + ", ".join(f"intern_{stem}{n}" for n in (1, 2, 3) for stem in _SLOT_STEMS)
        + ", int_exp_studorg, int_exp_studorg_definition",
        _COUNT_PRESENT,
    ),
    _extract_case(
        "intern_lrned",
        "student_id AS stud_id, term, intern_count, "
        + ", ".join(f"intern{n}_how_obtain_{o}" for n in (1, 2, 3) for o in _OPTIONS),
        _COUNT_PRESENT,
    ),
    _extract_case(
        "intl_exp",
        "student_id AS stud_id, term, int_exp_semAbroad, int_exp_AYEA, int_exp_embedded, int_exp_studorg, int_exp_other, "
        "int_exp_other_fill, int_exp_none, int_exp_semAbroad_definition, int_exp_AYEA_definition, int_exp_embedded_definition, "
        "int_exp_studorg_definition, int_exp_long_via_psu, int_exp_short_psu_course, int_exp_short_psu_club_org, "
        "int_exp_educ_prog_not_psu, int_exp_internship, int_exp_did_not_have, int_exp_long_via_psu_defin, "
        "int_exp_short_psu_course_defin, int_exp_short_psu_club_org_def, int_exp_educ_prog_not_psu_defin, "
        "int_exp_internship_definition, int_exp_did_not_have_defin",
    ),
    _extract_case(
        "empl_job_lrned",
        "student_id, term, " + ", ".join(f"EMP_how_obtain_{o}" for o in _OPTIONS),
        "Have_PostGrad_Info IS NOT NULL",
    ),
    _extract_case("conn_to_psu", f"id, student_id, term, {_CONTACT_SQL}, CAST(LOAD_UTC_DT AS VARCHAR) AS LOAD_UTC_DT"),
    _extract_case(
        "stud_attr",
        "id, student_id, term, intern_count, collection_method, Have_PostGrad_Info, indicator_fulltime_employment, "
        "indicator_parttime_employment, indicator_further_education, indicator_fellowship, indicator_military, "
        "indicator_still_seeking, indicator_other_plans, indicator_any_employment, indicator_internship, "
        "indicator_international_experience, indicator_undergrad_research, indicator_post_intern_residency, "
        "indicator_entrepreneurship, indicator_stay_connected_PSU, connect_assist, int_exp_semAbroad, int_exp_AYEA, "
        "int_exp_embedded, int_exp_studorg, int_exp_other, int_exp_other_fill, int_exp_none, plans_cleaned_definition, "
        "plans_other, CAST(LOAD_UTC_DT AS VARCHAR) AS LOAD_UTC_DT",
    ),
    Case(
        "stage_scan_terms",
        "A12",
        lambda s, d: lookup_source.term_extract(carrier.stage(s, d)),
        f"{S}SELECT DISTINCT term FROM stage WHERE term IS NOT NULL AND trim(term) <> ''",
    ),
    *[
        Case(
            f"lookup_scan_{name}",
            "A14",
            lambda s, d, name=name: lookup_source.scan_lookup(carrier.lookup(s, d, name), name),
            f"SELECT {columns} FROM ({carrier.LOOKUP_SQL[name]})",
        )
        for name, columns in {
            "country": "country, descr",
            "state": "STATE, country, descr",
            "school": "NSC_COLLEGE_AND_BRANCH_CODE, NSC_COLLEGE_NAME",
            "organization": "external_system_id, ls_school_type, descr50",
            "company": "company_name_variant, standardized_company_name",
        }.items()
    ],
]


def _appended(spark, sf_dir):
    path = new_folder(spark, "append")
    stage = carrier.stage(spark, sf_dir)
    sinks.append(conn_to_psu.direct(stage), path)
    sinks.append(conn_to_psu.direct(_late(spark, sf_dir)), path)
    return spark.read.parquet(path)


def _appended_once(spark, sf_dir):
    """Two appends, each repeated under its token, the first with other rows."""
    table = f"{scratch_database(spark)}.kept"
    stage = carrier.stage(spark, sf_dir)
    for token, rows in (("first", stage), ("first", _late(spark, sf_dir)), ("it's \\ two", _late(spark, sf_dir)), ("it's \\ two", _late(spark, sf_dir))):
        sinks.append_once(conn_to_psu.direct(rows), table, token)
    return spark.table(table).drop(sinks.TOKEN_COLUMN)


def _refreshed_in_one_step(spark, sf_dir):
    table = f"{scratch_database(spark)}.kept"
    sinks.refresh_table(conn_to_psu.direct(carrier.stage(spark, sf_dir)), table)
    sinks.refresh_table(conn_to_psu.direct(_late(spark, sf_dir)), table)
    return spark.table(table)


def _refreshed(spark, sf_dir):
    path = new_folder(spark, "refresh")
    sinks.full_refresh(conn_to_psu.direct(carrier.stage(spark, sf_dir)), path)
    sinks.full_refresh(conn_to_psu.direct(_late(spark, sf_dir)), path)
    return spark.read.parquet(path)


def _dry_run(spark, sf_dir):
    """A dry run after a real one: the target keeps its rows and the planned rows come back."""
    path = new_folder(spark, "dry")
    stage = carrier.stage(spark, sf_dir)
    sinks.write(conn_to_psu.direct(_late(spark, sf_dir)), path)
    planned = sinks.write(conn_to_psu.direct(stage), path, dry_run=True)
    return quality.row_counts({"planned": planned, "stored": spark.read.parquet(path)})


def _sample(spark, sf_dir):
    rows = carrier.stage(spark, sf_dir).select("id", F.col("student_id").alias("stud_id"), "term")
    return sinks.sample(rows.orderBy("id"))


def _target_columns(spark, sf_dir):
    stage = carrier.stage(spark, sf_dir)
    return sinks.for_target(
        stage.select("id", F.col("student_id").alias("stud_id"), "LOAD_UTC_DT", "term"), ("stud_id", "term")
    )


_LATE = "LOAD_UTC_DT >= TIMESTAMP '1998-07-01'"
_CONN = f"SELECT student_id AS stud_id, term, {_CONN_FIRST} AS conn_to_psu FROM stage WHERE ({_CONN_ANY})"

SINKS = [
    Case("sink_append", "A15", _appended, f"{S}{_CONN}\nUNION ALL\n{_CONN} AND {_LATE}"),
    Case("append_repeated_token", "A15", _appended_once, f"{S}{_CONN}\nUNION ALL\n{_CONN} AND {_LATE}"),
    Case("table_refreshed_in_one_step", "A16", _refreshed_in_one_step, f"{S}{_CONN} AND {_LATE}"),
    Case("sink_full_refresh", "A16", _refreshed, f"{S}{_CONN} AND {_LATE}"),
    Case(
        "dry_run_leaves_target",
        "A17",
        _dry_run,
        f"{S}SELECT 'planned' AS table_name, count(*) AS row_count FROM ({_CONN}) UNION ALL "
        f"SELECT 'stored', count(*) FROM ({_CONN} AND {_LATE})",
    ),
    Case(
        "dry_run_sample",
        "A17, H4",
        _sample,
        f"{S}SELECT id, student_id AS stud_id, term FROM stage ORDER BY id LIMIT 5",
    ),
    Case("target_columns", "A18", _target_columns, f"{S}SELECT student_id AS stud_id, term FROM stage"),
]

CASES = [*TABLES, *UPKEEP, *SCANS, *SINKS]
