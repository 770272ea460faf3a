"""Column expressions over the whole stage, checked value by value."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from harness import carrier, duck
from harness.case import Case
from tallyloom import functions as fn
from tallyloom.functions.text import decode, null_text, other_spelled_out
from tallyloom.operators import conditions
from tallyloom.operators.lookup import lookup_join
from tallyloom.plans import conn_to_psu, response, specs, stud_attr


def _over_stage(name, inventory, outputs, inputs=()):
    """A case that shows some stage columns and computed ones: {output: (maker of the column, DuckDB text)}.

    If it shows any, the computed ones read no others.
    """

    def run(spark, sf_dir):
        rows = carrier.stage(spark, sf_dir, *(["id", *inputs] if inputs else []))
        return rows.select("id", *inputs, *[column().alias(out) for out, (column, _) in outputs.items()])

    computed = ", ".join(f"{sql} AS {out}" for out, (_, sql) in outputs.items())
    shown = ", ".join(["id", *inputs])
    return Case(name, inventory, run, f"{carrier.stage_sql()}SELECT {shown}, {computed} FROM stage")


def _count_of_valid():
    """The strict count of what is a count; other answers would stop the query."""
    return fn.count_checked(F.when(fn.count_or_null("intern_count").isNotNull(), F.col("intern_count")))


def _institution(spark, sf_dir):
    rows = carrier.stage(spark, sf_dir).select("id", "term", "FE_college_code")
    tables = carrier.lookups(spark, sf_dir)
    rows = lookup_join(rows, response.school_lookup(tables["school"]), "FE_college_code")
    rows = lookup_join(rows, response.organization_lookup(tables["organization"]), "FE_college_code")
    name = response.institution_name(F.col("term"), F.col("school_name"), F.col("org_name"))
    return rows.select("id", "term", name.alias("edu_inst_nm"))


_INSTITUTION_SQL = (
    carrier.stage_sql("school", "organization")
    + """SELECT s.id, s.term, CASE WHEN s.term < '2165' THEN n.NSC_COLLEGE_NAME WHEN s.term >= '2165' THEN o.descr50 ELSE 'Unknown' END AS edu_inst_nm
FROM stage s
LEFT JOIN lk_school n ON s.FE_college_code = left(n.NSC_COLLEGE_AND_BRANCH_CODE, 6)
LEFT JOIN lk_organization o ON s.FE_college_code = o.external_system_id AND o.ls_school_type = 'COL'"""
)


def _coalesced_company(spark, sf_dir):
    rows = carrier.stage(spark, sf_dir).select("id", "EMP_company")
    rows = lookup_join(rows, response.company_lookup(carrier.lookup(spark, sf_dir, "company")), "EMP_company")
    return rows.select("id", F.coalesce("standard_co_nm", "EMP_company").alias("empl_co_nm"))


def _nan_scrub(spark, sf_dir):
    events = carrier.table(spark, sf_dir, "events")
    # half of the values are made NaN, as a numeric conversion outside Spark may leave them
    value = F.when(F.col("event_id") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return events.select("event_id", fn.nan_to_null(value).alias("clean_value"))


def _academic_year(spark, sf_dir):
    rows = carrier.stage(spark, sf_dir, "term").select(fn.parse_term("term").alias("term_number"))
    year = fn.academic_year("term_number")
    return (
        rows.where(F.col("term_number").isNotNull())
        .select("term_number", year.alias("acad_year"), year.cast("string").alias("report_label"))
    )


def _label(flag):
    return fn.label_or(flag.definition, F.lit(flag.label))


def _indicator(name):
    return stud_attr.experience_indicators()[name]


_TERM_NUMBER = duck.whole_text("term")

CASES = [
    _over_stage(
        "strict_respondent_id", "B1", {"stud_id": (partial(fn.strict_id, "student_id"), duck.strict_id("student_id"))}, ["student_id"]
    ),
    _over_stage(
        "lenient_respondent_id", "B2", {"stud_id": (partial(fn.lenient_id, "student_id"), duck.lenient_id("student_id"))}, ["student_id"]
    ),
    _over_stage("strict_term", "B3", {"term_norm": (partial(fn.strict_term, "term"), duck.strict_term("term"))}, ["term"]),
    _over_stage("lenient_term", "B4", {"term_norm": (partial(fn.lenient_term, "term"), duck.lenient_term("term"))}, ["term"]),
    _over_stage(
        "invalid_term_indicator",
        "B5",
        {
            "invalid_term_indc": (
                partial(fn.term_is_invalid, "term"),
                f"CASE WHEN coalesce(regexp_full_match({duck.strip('term')}, '[0-9]{{4}}'), false) THEN 'N' ELSE 'Y' END",
            )
        },
        ["term"],
    ),
    _over_stage(
        "checkbox_selected",
        "B6",
        {
            f"{f.flag}_selected": (partial(fn.is_selected, f.flag), duck.selected(f.flag))
            for f in (*specs.INTL_EXPERIENCE, *specs.JOB_LEARNED)
        },
    ),
    _over_stage(
        "contact_option_picked",
        "B7",
        {f"{name}_picked": (partial(fn.option_picked, name), duck.picked(name)) for name in specs.CONTACT_LABELS},
    ),
    _over_stage(
        "yes_no_normalised",
        "B8",
        {
            f"{name}_yn": (partial(fn.yes_no, name), duck.yes_no(name))
            for slot in specs.INTERN_SLOTS
            for name in (f"intern_paid{slot}", f"intern_college_credit{slot}")
        },
    ),
    _over_stage(
        "count_strict",
        "B9a",
        {
            "n": (
                _count_of_valid,
                "CASE WHEN regexp_full_match(trim(intern_count), '[+-]?[0-9]+') THEN TRY_CAST(trim(intern_count) AS INTEGER) END",
            )
        },
        ["intern_count"],
    ),
    _over_stage(
        "count_truncated",
        "B9b",
        {"n": (partial(fn.count_truncated, "intern_count"), duck.count_truncated("intern_count"))},
        ["intern_count"],
    ),
    _over_stage(
        "count_whole", "B9c", {"n": (partial(fn.count_whole, "intern_count"), duck.count_whole("intern_count"))}, ["intern_count"]
    ),
    _over_stage(
        "semesters",
        "B9d",
        {
            f"n{slot}": (partial(fn.semesters, f"intern_semesters{slot}"), duck.whole_text(f"intern_semesters{slot}"))
            for slot in specs.INTERN_SLOTS
        },
    ),
    _over_stage(
        "amount_to_number",
        "B10",
        {
            f"amt{slot}": (partial(fn.amount, f"intern_paid_amt{slot}"), duck.number(f"intern_paid_amt{slot}"))
            for slot in specs.INTERN_SLOTS
        },
    ),
    _over_stage(
        "prefix_and_clip",
        "B11",
        {
            "empl_ctry_cd": (partial(fn.left_nonblank, "EMP_country", 2), "left(nullif(trim(EMP_country), ''), 2)"),
            "school_prefix": (lambda: F.left("FE_college_code", F.lit(6)), "left(FE_college_code, 6)"),
            "coltn_mthd": (partial(fn.clip, "collection_method", 50), "substr(coalesce(collection_method, ''), 1, 50)"),
        },
    ),
    _over_stage(
        "other_text_suffix",
        "B12",
        {
            "publ_srvc": (
                partial(other_spelled_out, "ps_committment_definition", "PS_committment_other"),
                "CASE WHEN ps_committment_definition = 'Other' THEN ps_committment_definition || ' - ' || "
                "coalesce(PS_committment_other, 'Unknown') ELSE ps_committment_definition END",
            ),
            "found_job": (
                lambda: fn.with_other_text(F.lit("Other"), "EMP_how_obtain_other_fill"),
                duck.labelled(None, "Other", "EMP_how_obtain_other_fill"),
            ),
        },
    ),
    _over_stage(
        "definition_over_label",
        "B13",
        {
            f"{f.flag}_label": (partial(_label, f), duck.labelled(f.definition, f.label, None))
            for f in specs.INTL_EXPERIENCE
            if f.definition
        },
    ),
    _over_stage(
        "contact_labels_joined",
        "B14",
        {
            "conn_to_psu": (
                conn_to_psu.joined_labels,
                "nullif(concat_ws(', ', "
                + ", ".join(
                    f"CASE WHEN {duck.picked(name)} THEN '{label}' END"
                    for name, label in {
                        "connect_mentor": "Mentor",
                        "connect_emp_panel": "Employer Panel",
                        "connect_network": "Networking",
                        "connect_assist": "Job Assistance",
                        "connect_ldship": "Leadership",
                        "connect_no": "No",
                        "connect_email": "Email",
                        "connect_cell_phone": "Cell Phone",
                        "indicator_stay_connected_PSU": "Stay Connected to PSU",
                    }.items()
                )
                + "), '')",
            )
        },
    ),
    _over_stage(
        "first_contact_definition",
        "B15",
        {
            "conn_to_psu": (
                conn_to_psu.first_definition,
                "CASE "
                + " ".join(
                    f"WHEN {c} = 'Y' THEN {c}_definition"
                    for c in (
                        "connect_assist",
                        "connect_emp_panel",
                        "connect_ldship",
                        "connect_mentor",
                        "connect_network",
                        "connect_no",
                    )
                )
                + " END",
            )
        },
    ),
    _over_stage(
        "collection_method_decoded",
        "B16",
        {
            "coltn_mthd": (
                partial(decode, "collection_method", specs.COLLECTION_METHODS),
                "CASE collection_method WHEN '0' THEN 'Did not collect/or respond' WHEN '1' THEN 'Survey' "
                "WHEN '2' THEN 'NSLC -- National Student Clearinghouse' WHEN '3' THEN 'Smeal Business  School' "
                "WHEN '4' THEN 'Eberly College of Science' END",
            )
        },
        ["collection_method"],
    ),
    _over_stage(
        "status_precedence",
        "B17",
        {
            "post_graduation_stat_cd": (
                stud_attr.status_code,
                "CASE WHEN indicator_fulltime_employment = 'Y' THEN 1 WHEN indicator_parttime_employment = 'Y' THEN 2 "
                "WHEN indicator_further_education = 'Y' THEN 3 WHEN indicator_fellowship = 'Y' THEN 4 "
                "WHEN indicator_military = 'Y' THEN 5 WHEN indicator_still_seeking = 'Y' THEN 6 "
                "WHEN indicator_other_plans = 'Y' THEN 9 END",
            )
        },
    ),
    _over_stage(
        "flag_or_evidence",
        "B18",
        {
            out: (partial(_indicator, out), f"CASE WHEN {flag} = 'Y' OR {evidence} IS NOT NULL THEN 'Y' END")
            for out, (flag, evidence) in specs.EXPERIENCE_INDICATORS.items()
        },
    ),
    Case("institution_by_term", "B19", _institution, _INSTITUTION_SQL),
    Case(
        "academic_year",
        "B20",
        _academic_year,
        f"""{carrier.stage_sql().rstrip()}, numbered AS (SELECT {_TERM_NUMBER} AS t FROM stage)
SELECT t AS term_number, CAST(2000 + (t // 10 - 200) - CASE WHEN t % 10 = 1 THEN 1 ELSE 0 END AS INTEGER) AS acad_year,
CAST(2000 + (t // 10 - 200) - CASE WHEN t % 10 = 1 THEN 1 ELSE 0 END AS VARCHAR) AS report_label
FROM numbered WHERE t IS NOT NULL""",
    ),
    _over_stage("term_as_number", "B21", {"term_number": (partial(fn.parse_term, "term"), _TERM_NUMBER)}, ["term"]),
    _over_stage(
        "term_not_blank",
        "B22",
        {"has_term": (lambda: F.coalesce(conditions.not_blank("term"), F.lit(False)), "coalesce(trim(term) <> '', false)")},
    ),
    _over_stage(
        "load_timestamp",
        "B23",
        {"load_date": (lambda: F.col("LOAD_UTC_DT").cast("string"), "CAST(LOAD_UTC_DT AS VARCHAR)")},
    ),
    _over_stage(
        "typed_null_placeholders",
        "B24",
        {
            name: (null_text, "CAST(NULL AS VARCHAR)")
            for name in ("camp_cd", "majr_cd", "dept_cd", "coltn_mthd_cd", "empl_date_job_offer_recv")
        },
    ),
    Case(
        "nan_to_null",
        "B25",
        _nan_scrub,
        "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN NULL ELSE value END AS clean_value FROM events",
    ),
    _over_stage(
        "renamed_columns",
        "B26",
        {
            "stud_id": (partial(F.col, "student_id"), "student_id"),
            "indc_intern": (partial(F.col, "indicator_internship"), "indicator_internship"),
            "indc_mil": (partial(F.col, "indicator_military"), "indicator_military"),
        },
    ),
    Case(
        "standard_name_or_raw",
        "B27",
        _coalesced_company,
        carrier.stage_sql("company")
        + """SELECT s.id, coalesce(m.standardized_company_name, s.EMP_company) AS empl_co_nm
FROM stage s LEFT JOIN lk_company m ON s.EMP_company = m.company_name_variant""",
    ),
]
