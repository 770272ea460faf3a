"""Column specifications of the questionnaire.

Everything in this file is a fixed value: the names of delivered columns, codes and labels that the output
tables must show exactly.
"""

from __future__ import annotations

from tallyloom.operators.unpivot import FlagColumn

# ---- international experience -----------------------------------------------------------------------------

# cleaned variant: label used when the definition says nothing
INTL_EXPERIENCE = (
    FlagColumn("int_exp_semAbroad", "Semester abroad", definition="int_exp_semAbroad_definition"),
    FlagColumn("int_exp_AYEA", "Academic year education abroad (AYEA)", definition="int_exp_AYEA_definition"),
    FlagColumn("int_exp_embedded", "Embedded education abroad course", definition="int_exp_embedded_definition"),
    FlagColumn("int_exp_studorg", "Student organization abroad experience", definition="int_exp_studorg_definition"),
    FlagColumn("int_exp_other", "Other international experience", other_text="int_exp_other_fill"),
    FlagColumn("int_exp_none", "No international experience"),
    FlagColumn("int_exp_long_via_psu", "Long-term experience abroad via PSU", definition="int_exp_long_via_psu_defin"),
    FlagColumn("int_exp_short_psu_course", "Short-term PSU course abroad", definition="int_exp_short_psu_course_defin"),
    FlagColumn(
        "int_exp_short_psu_club_org",
        "Short-term PSU club/organization abroad",
        definition="int_exp_short_psu_club_org_def",
    ),
    FlagColumn(
        "int_exp_educ_prog_not_psu",
        "Educational program abroad not via PSU",
        definition="int_exp_educ_prog_not_psu_defin",
    ),
    FlagColumn("int_exp_internship", "International internship", definition="int_exp_internship_definition"),
    FlagColumn(
        "int_exp_did_not_have",
        "Did not have an international experience",
        definition="int_exp_did_not_have_defin",
    ),
)

# direct variant: one row per answer, copies kept
INTL_EXPERIENCE_SINGLE = (
    FlagColumn("int_exp_semAbroad", "Semester Education Abroad", definition="int_exp_semAbroad_definition"),
    FlagColumn("int_exp_AYEA", "Academic Year Education Abroad", definition="int_exp_AYEA_definition"),
    FlagColumn("int_exp_embedded", "Embedded", definition="int_exp_embedded_definition"),
    FlagColumn("int_exp_studorg", "Student Organization", definition="int_exp_studorg_definition"),
    FlagColumn("int_exp_other", "Other", definition="int_exp_other_fill"),
)

# direct variant: copies of (respondent, term, label) are folded
INTL_EXPERIENCE_NONE = (
    FlagColumn("int_exp_none", "None"),
    FlagColumn("int_exp_did_not_have", "No International Experience", definition="int_exp_did_not_have_defin"),
)
INTL_EXPERIENCE_REVISED = (
    FlagColumn("int_exp_long_via_psu", "Semester/Summer/Year Abroad (PSU)", definition="int_exp_long_via_psu_defin"),
    FlagColumn(
        "int_exp_short_psu_course", "Course Short Term Travel (PSU)", definition="int_exp_short_psu_course_defin"
    ),
    FlagColumn(
        "int_exp_short_psu_club_org", "Club/Org Short Term Travel (PSU)", definition="int_exp_short_psu_club_org_def"
    ),
    FlagColumn(
        "int_exp_educ_prog_not_psu", "Educational Exp Abroad (not PSU)", definition="int_exp_educ_prog_not_psu_defin"
    ),
    FlagColumn("int_exp_internship", "International Internship", definition="int_exp_internship_definition"),
)

# ---- internships --------------------------------------------------------------------------------------------

INTERN_SLOTS = (1, 2, 3)

# output column -> stem of the delivered column (the slot number follows the stem)
INTERN_DIRECT_FIELDS = {
    "raw_co_nm": "intern_organization",
    "intern_dept": "intern_unit",
    "intern_job_title": "intern_title",
    "intern_len_wks": "intern_exp",
    "indc_intern_paid": "intern_paid",
    "intern_amt_paid": "intern_paid_amt",
}
INTERN_CLEANED_FIELDS = {
    "intern_co_nm": "intern_organization",
    "intern_dept": "intern_unit",
    "intern_job_title": "intern_title",
    "indc_intern_paid": "intern_paid",
    "intern_amt_paid": "intern_paid_amt",
    "intern_country": "intern_country",
    "intern_state": "intern_state",
    "intern_province": "intern_province",
    "intern_college_credit": "intern_college_credit",
    "intern_semesters": "intern_semesters",
}


def intern_groups(fields: dict[str, str]) -> dict[int, dict[str, str]]:
    return {slot: {name: f"{stem}{slot}" for name, stem in fields.items()} for slot in INTERN_SLOTS}


# ---- how an internship or a job was found ---------------------------------------------------------------------

OPTION_CODES = range(1, 15)
OTHER_CODE = 99

INTERN_LEARNED = tuple(
    flag
    for slot in INTERN_SLOTS
    for flag in (
        *(
            FlagColumn(
                f"intern{slot}_how_obtain_{code:02d}",
                f"Internship obtained via option {code:02d}",
                code=code,
                slot=slot,
            )
            for code in OPTION_CODES
        ),
        FlagColumn(
            f"intern{slot}_how_obtain_other",
            "Internship obtained via Other",
            code=OTHER_CODE,
            slot=slot,
            other_text=f"intern{slot}_how_obtain_other_fill",
        ),
    )
)

JOB_LEARNED = (
    *(FlagColumn(f"EMP_how_obtain_{code:02d}", f"EMP_how_obtain_{code:02d}", code=code) for code in OPTION_CODES),
    FlagColumn("EMP_how_obtain_other", "Other", code=OTHER_CODE, other_text="EMP_how_obtain_other_fill"),
)

# ---- staying in contact -----------------------------------------------------------------------------------------

# cleaned variant, in the order in which labels are listed
CONTACT_LABELS = {
    "connect_mentor": "Mentor",
    "connect_emp_panel": "Employer Panel",
    "connect_network": "Networking",
    "connect_assist": "Job Assistance",
    "connect_ldship": "Leadership",
    "connect_no": "No",
    "connect_email": "Email",
    "connect_cell_phone": "Cell Phone",
    "indicator_stay_connected_PSU": "Stay Connected to PSU",
}
# direct variant, first match wins
CONTACT_PRECEDENCE = (
    "connect_assist",
    "connect_emp_panel",
    "connect_ldship",
    "connect_mentor",
    "connect_network",
    "connect_no",
)

# ---- respondent attributes ----------------------------------------------------------------------------------------

COLLECTION_METHODS = {
    "0": "Did not collect/or respond",
    "1": "Survey",
    "2": "NSLC -- National Student Clearinghouse",
    "3": "Smeal Business  School",
    "4": "Eberly College of Science",
}

STATUS_PRECEDENCE = {
    "indicator_fulltime_employment": 1,
    "indicator_parttime_employment": 2,
    "indicator_further_education": 3,
    "indicator_fellowship": 4,
    "indicator_military": 5,
    "indicator_still_seeking": 6,
    "indicator_other_plans": 9,
}

# output column -> (flag, column that counts as evidence)
EXPERIENCE_INDICATORS = {
    "indc_exp_semAbroad": ("int_exp_semAbroad", "int_exp_semAbroad_definition"),
    "indc_exp_AYEA": ("int_exp_AYEA", "int_exp_AYEA_definition"),
    "indc_exp_embedded": ("int_exp_embedded", "int_exp_embedded_definition"),
    "indc_exp_studorg": ("int_exp_studorg", "int_exp_studorg_definition"),
    "indc_exp_other": ("int_exp_other", "int_exp_other_fill"),
    "indc_exp_long_via_psu": ("int_exp_long_via_psu", "int_exp_long_via_psu_defin"),
    "indc_exp_short_psu_course": ("int_exp_short_psu_course", "int_exp_short_psu_course_defin"),
    "indc_exp_short_psu_cluborg": ("int_exp_short_psu_club_org", "int_exp_short_psu_club_org_def"),
    "indc_exp_ed_not_psu": ("int_exp_educ_prog_not_psu", "int_exp_educ_prog_not_psu_defin"),
    "indc_exp_internship": ("int_exp_internship", "int_exp_internship_definition"),
    "indc_exp_did_not_have": ("int_exp_did_not_have", "int_exp_did_not_have_defin"),
}

# ---- responses ------------------------------------------------------------------------------------------------------

# a respondent gets a response row when at least one of these is filled
RESPONSE_EVIDENCE = (
    "connect_cell",
    "connect_email",
    "FE_stage_definition",
    "FE_stage",
    "FE_program",
    "FE_college_code",
    "FE_college",
    "FE_offers",
    "FE_type_definition",
    "FE_type",
    "EMP_bonus_amount",
    "EMP_bonus",
    "EMP_city",
    "EMP_company",
    "EMP_country",
    "EMP_off_recv",
    "EMP_department",
    "EMP_functional_definition",
    "EMP_functional",
    "EMP_Month",
    "offers_count",
    "EMP_relocate_amount",
    "EMP_relocate",
    "EMP_salary",
    "EMP_state",
    "EMP_title",
    "EMP_relate",
    "EMP_Year",
    "EMP_emp_edu_manner_definition",
    "EMP_emp_edu_manner",
    "EMP_emp_edu",
    "FS_city",
    "FS_country",
    "FS_program",
    "FS_state",
    "SFT_email",
    "ps_committment_definition",
    "PS_committment_other",
    "PS_committment",
)

HOME_COUNTRY = "USA"
COLLEGE_TYPE = "COL"
SCHOOL_CODE_WIDTH = 6
FIRST_TERM_WITH_ORG_NAMES = "2165"
