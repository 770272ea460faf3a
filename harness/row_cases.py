"""Filters, joins, distinct values, set operations, unpivots, orderings."""

from __future__ import annotations

from pyspark.sql import functions as F

from harness import carrier, duck
from harness.case import Case
from tallyloom.functions import academic_year, count_or_null, count_truncated, parse_term, strict_id
from tallyloom.operators import conditions, quality, sets
from tallyloom.operators.lookup import Lookup, lookup_join
from tallyloom.operators.unpivot import unpivot_groups, unpivot_selected
from tallyloom.operators.upkeep import new_term_labels
from tallyloom.plans import intern, intl_exp, response, specs

S = carrier.stage_sql()


def _ids(name, inventory, condition, sql_condition, columns):
    """Ids of the stage rows that meet a condition on some columns."""
    return Case(
        name,
        inventory,
        lambda spark, sf_dir: carrier.stage(spark, sf_dir, "id", *columns).where(condition()).select("id"),
        f"{S}SELECT id FROM stage WHERE {sql_condition}",
    )


def _slot_ids(name, inventory, fields, condition, sql_condition, groups):
    """Ids and slots of internship slots that meet a condition."""

    def run(spark, sf_dir):
        rows = carrier.stage(spark, sf_dir).withColumn("reported", count_truncated("intern_count"))
        slots = unpivot_groups(rows, specs.intern_groups(fields), ["id", "reported"])
        return slots.where(condition()).select("id", "slot")

    selects = [
        f"SELECT id, {n} AS slot FROM stage WHERE {sql_condition.format(n=n)}" for n in groups
    ]
    return Case(name, inventory, run, S + duck.union_all(selects))


_EVIDENCE_SQL = " OR ".join(f"{c} IS NOT NULL" for c in specs.RESPONSE_EVIDENCE)
_BLANK_FIELDS = ("organization", "title", "unit", "paid", "paid_amt", "country", "state", "province", "college_credit", "semesters")

FILTERS = [
    _ids(
        "count_present",
        "C1",
        lambda: conditions.not_blank("intern_count"),
        "nullif(trim(intern_count), '') IS NOT NULL",
        ["intern_count"],
    ),
    _ids("postgrad_info_present", "C2", lambda: F.col("Have_PostGrad_Info").isNotNull(), "Have_PostGrad_Info IS NOT NULL", ["Have_PostGrad_Info"]),
    Case(
        "any_response_column",
        "C3",
        lambda spark, sf_dir: response.filled(carrier.stage(spark, sf_dir)).select("id"),
        f"{S}SELECT id FROM stage WHERE {_EVIDENCE_SQL}",
    ),
    _slot_ids(
        "slot_names_something",
        "C4",
        specs.INTERN_DIRECT_FIELDS,
        lambda: conditions.any_present(["raw_co_nm", "intern_dept", "intern_job_title"]),
        "intern_organization{n} IS NOT NULL OR intern_unit{n} IS NOT NULL OR intern_title{n} IS NOT NULL",
        (1, 2, 3),
    ),
    _ids(
        "any_contact_flag",
        "C5",
        lambda: conditions.any_equals(specs.CONTACT_PRECEDENCE),
        "connect_assist = 'Y' OR connect_emp_panel = 'Y' OR connect_ldship = 'Y' OR connect_mentor = 'Y' "
        "OR connect_network = 'Y' OR connect_no = 'Y'",
        specs.CONTACT_PRECEDENCE,
    ),
    Case(
        "respondent_id_present",
        "C6",
        lambda spark, sf_dir: conditions.require_present(
            carrier.stage(spark, sf_dir).select("id", strict_id("student_id").alias("stud_id")), "stud_id"
        ),
        f"{S}SELECT id, {duck.strict_id('student_id')} AS stud_id FROM stage WHERE {duck.strip('student_id')} <> ''",
    ),
    _slot_ids(
        "slot_not_blank",
        "C7",
        specs.INTERN_CLEANED_FIELDS,
        lambda: conditions.any_not_blank(specs.INTERN_CLEANED_FIELDS),
        " OR ".join(f"{duck.strip('intern_' + f + '{n}')} <> ''" for f in _BLANK_FIELDS),
        (1, 2, 3),
    ),
    _slot_ids(
        "slot_within_count",
        "C8",
        specs.INTERN_CLEANED_FIELDS,
        lambda: conditions.slot_reported("reported", "slot"),
        f"{duck.count_truncated('intern_count')} >= {{n}}".replace("{4}", "{{4}}"),
        (1, 2, 3),
    ),
    Case(
        "flag_or_definition",
        "C9",
        lambda spark, sf_dir: carrier.stage(spark, sf_dir).select(
            "id",
            *[
                F.coalesce(conditions.flag_or_evidence(f.flag, f.definition), F.lit(False)).alias(f"{f.flag}_counts")
                for f in (*specs.INTL_EXPERIENCE_SINGLE, *specs.INTL_EXPERIENCE_NONE, *specs.INTL_EXPERIENCE_REVISED)
            ],
        ),
        f"{S}SELECT id, "
        + ", ".join(
            f"coalesce({f.flag} = 'Y', false)"
            + (f" OR {f.definition} IS NOT NULL" if f.definition else "")
            + f" AS {f.flag}_counts"
            for f in (*specs.INTL_EXPERIENCE_SINGLE, *specs.INTL_EXPERIENCE_NONE, *specs.INTL_EXPERIENCE_REVISED)
        )
        + " FROM stage",
    ),
]


def _join(key, build, values):
    def run(spark, sf_dir, **options):
        rows = carrier.stage(spark, sf_dir, "id", key)
        return lookup_join(rows, build(spark, sf_dir), key, **options).select("id", key, *values)

    return run


_country = _join("FS_country", lambda s, d: response.country_lookup(carrier.lookup(s, d, "country")), ["fell_ctry"])
_state = _join("FS_state", lambda s, d: response.state_lookup(carrier.lookup(s, d, "state")), ["fell_st"])
_school = _join("FE_college_code", lambda s, d: response.school_lookup(carrier.lookup(s, d, "school")), ["school_name"])
_org = _join(
    "FE_college_code", lambda s, d: response.organization_lookup(carrier.lookup(s, d, "organization")), ["org_name"]
)
_company = _join("EMP_company", lambda s, d: intern.company_lookup(carrier.lookup(s, d, "company")), ["standard_co_nm"])
_company_twice = _join(
    "EMP_company", lambda s, d: intern.company_lookup(carrier.lookup(s, d, "company_repeated")), ["standard_co_nm"]
)


def _customer_nation(spark, sf_dir):
    customers = carrier.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = Lookup(carrier.table(spark, sf_dir, "nation"), "n_nationkey", {"nation_name": "n_name"})
    return lookup_join(customers, nations, "c_nationkey")


def _existing_labels(spark, sf_dir):
    """Labels for the terms of the first years, with a text that derived rows would not have."""
    terms = new_term_labels(carrier.stage(spark, sf_dir)).where("term < 2160")
    return terms.withColumn("report_label", F.lit("as it was"))


_LABELS_SQL = (
    S.rstrip()
    + f""", numbered AS (SELECT DISTINCT {duck.whole_text('term')} AS term FROM stage WHERE trim(term) <> ''),
derived AS (SELECT term, CAST(2000 + (term // 10 - 200) - CASE WHEN term % 10 = 1 THEN 1 ELSE 0 END AS INTEGER) AS acad_year
FROM numbered WHERE term IS NOT NULL)
"""
)

_COMPANY_SQL = """SELECT s.id, s.EMP_company, m.standardized_company_name AS standard_co_nm
FROM stage s LEFT JOIN lk_{lookup} m ON s.EMP_company = m.company_name_variant"""

JOINS = [
    Case(
        "join_country",
        "D1",
        _country,
        carrier.stage_sql("country")
        + "SELECT s.id, s.FS_country, c.descr AS fell_ctry FROM stage s LEFT JOIN lk_country c ON s.FS_country = c.country",
    ),
    Case(
        "join_customer_nation",
        "D1",
        _customer_nation,
        "SELECT c_custkey, c_nationkey, n_name AS nation_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
    ),
    Case(
        "join_state_of_home_country",
        "D2",
        _state,
        carrier.stage_sql("state")
        + "SELECT a.id, a.FS_state, s.descr AS fell_st FROM stage a LEFT JOIN lk_state s ON a.FS_state = s.STATE AND s.country = 'USA'",
    ),
    Case(
        "join_school_prefix",
        "D3",
        _school,
        carrier.stage_sql("school")
        + """SELECT s.id, s.FE_college_code, n.NSC_COLLEGE_NAME AS school_name
FROM stage s LEFT JOIN lk_school n ON s.FE_college_code = left(n.NSC_COLLEGE_AND_BRANCH_CODE, 6)""",
    ),
    Case(
        "join_college_organization",
        "D4",
        _org,
        carrier.stage_sql("organization")
        + """SELECT s.id, s.FE_college_code, o.descr50 AS org_name
FROM stage s LEFT JOIN lk_organization o ON s.FE_college_code = o.external_system_id AND o.ls_school_type = 'COL'""",
    ),
    Case("join_company", "D5", _company, carrier.stage_sql("company") + _COMPANY_SQL.format(lookup="company")),
    Case(
        "join_company_repeated_spellings",
        "D5",
        _company_twice,
        carrier.stage_sql("company_repeated") + _COMPANY_SQL.format(lookup="company_repeated"),
    ),
    Case(
        "join_company_by_shuffle",
        "D5",
        lambda spark, sf_dir: _company_twice(spark, sf_dir, broadcast_limit=-1, salt_by=["id"]),
        carrier.stage_sql("company_repeated") + _COMPANY_SQL.format(lookup="company_repeated"),
    ),
    Case(
        "terms_without_label",
        "D6",
        lambda spark, sf_dir: new_term_labels(carrier.stage(spark, sf_dir), _existing_labels(spark, sf_dir)),
        _LABELS_SQL + "SELECT term, acad_year, CAST(acad_year AS VARCHAR) AS report_label FROM derived WHERE term >= 2160",
    ),
]


def _distinct_terms(spark, sf_dir):
    return sets.distinct_values(carrier.stage(spark, sf_dir), "term")


def _table_counts(spark, sf_dir):
    return quality.row_counts({name: carrier.table(spark, sf_dir, name) for name in ("orders", "lineitem", "customer", "events")})


def _one_row_per_term(spark, sf_dir):
    """Label rows derived once per respondent, folded to one per term."""
    terms = carrier.stage(spark, sf_dir).where(conditions.not_blank("term")).select(parse_term("term").alias("term"))
    year = academic_year("term")
    labelled = terms.where(F.col("term").isNotNull()).select(
        "term", year.alias("acad_year"), year.cast("string").alias("report_label")
    )
    return sets.one_row_per(labelled, "term")


AGGREGATES = [
    Case("distinct_terms", "E1", _distinct_terms, f"{S}SELECT DISTINCT term FROM stage WHERE term IS NOT NULL"),
    Case(
        "distinct_order_customers",
        "E1",
        lambda spark, sf_dir: sets.distinct_values(carrier.table(spark, sf_dir, "orders"), "o_custkey"),
        "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL",
    ),
    Case(
        "table_row_counts",
        "E2",
        _table_counts,
        duck.union_all(
            [f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ("orders", "lineitem", "customer", "events")]
        ),
    ),
    Case(
        "distinct_term_count",
        "E3",
        lambda spark, sf_dir: quality.distinct_count(carrier.stage(spark, sf_dir), "term", "term_count"),
        f"{S}SELECT count(DISTINCT term) AS term_count FROM stage",
    ),
    Case(
        "distinct_lineitem_parts",
        "E3",
        lambda spark, sf_dir: quality.distinct_count(carrier.table(spark, sf_dir, "lineitem"), "l_partkey", "part_count"),
        "SELECT count(DISTINCT l_partkey) AS part_count FROM lineitem",
    ),
    Case(
        "one_row_per_term",
        "E4",
        _one_row_per_term,
        _LABELS_SQL + "SELECT term, acad_year, CAST(acad_year AS VARCHAR) AS report_label FROM derived",
    ),
]


def _evidenced_sql(flags, distinct):
    selects = [
        f"SELECT student_id AS stud_id, term, '{f.label}' AS intl_exp_type FROM stage WHERE {f.flag} = 'Y'"
        + (f" OR {f.definition} IS NOT NULL" if f.definition else "")
        for f in flags
    ]
    return ("\nUNION\n" if distinct else "\nUNION ALL\n").join(selects)


SINGLE_SQL = _evidenced_sql(specs.INTL_EXPERIENCE_SINGLE, distinct=False)
NONE_SQL = _evidenced_sql(specs.INTL_EXPERIENCE_NONE, distinct=True)
REVISED_SQL = _evidenced_sql(specs.INTL_EXPERIENCE_REVISED, distinct=True)
INTL_DIRECT_SQL = f"{S}{SINGLE_SQL}\nUNION ALL\nSELECT * FROM ({NONE_SQL})\nUNION ALL\nSELECT * FROM ({REVISED_SQL})"

SETS = [
    Case("no_experience_folded", "F1", lambda s, d: intl_exp.direct_none(carrier.stage(s, d)), S + NONE_SQL),
    Case("revised_answers_folded", "F2", lambda s, d: intl_exp.direct_revised(carrier.stage(s, d)), S + REVISED_SQL),
    Case(
        "bag_union",
        "F3",
        lambda s, d: sets.union_all(
            [
                intl_exp.direct_single(carrier.stage(s, d)),
                intl_exp.direct_none(carrier.stage(s, d)),
                intl_exp.direct_revised(carrier.stage(s, d)),
            ]
        ),
        INTL_DIRECT_SQL,
    ),
    Case(
        "terms_of_stage_not_known",
        "F4",
        lambda s, d: sets.not_in(
            _distinct_terms(s, d), _existing_labels(s, d).select(F.col("term").cast("string").alias("term")), "term"
        ),
        _LABELS_SQL
        + """SELECT DISTINCT term FROM stage WHERE term IS NOT NULL
AND term NOT IN (SELECT CAST(term AS VARCHAR) FROM derived WHERE term < 2160)""",
    ),
]


def _direct_slot_sql(n):
    return f"""SELECT student_id AS stud_id, term, {n} AS intern_numb, intern_organization{n} AS raw_co_nm, intern_unit{n} AS intern_dept,
intern_title{n} AS intern_job_title, intern_exp{n} AS intern_len_wks, intern_paid{n} AS indc_intern_paid, intern_paid_amt{n} AS intern_amt_paid
FROM stage WHERE intern_organization{n} IS NOT NULL OR intern_unit{n} IS NOT NULL OR intern_title{n} IS NOT NULL"""


def _slots_with_answers(spark, sf_dir):
    rows = carrier.stage(spark, sf_dir).withColumn("reported", count_or_null("intern_count")).where("reported > 0")
    slots = unpivot_groups(rows, specs.intern_groups(specs.INTERN_CLEANED_FIELDS), ["id", "reported"], slot="intern_numb")
    kept = slots.where(
        conditions.slot_reported("reported", "intern_numb") & conditions.any_not_blank(specs.INTERN_CLEANED_FIELDS)
    )
    return kept.select("id", "intern_numb", *specs.INTERN_CLEANED_FIELDS)


_COUNT_SQL = "CASE WHEN regexp_full_match(trim(intern_count), '[+-]?[0-9]+') THEN TRY_CAST(trim(intern_count) AS INTEGER) END"


def _answered_slot_sql(n):
    fields = ", ".join(f"{stem}{n} AS {out}" for out, stem in specs.INTERN_CLEANED_FIELDS.items())
    filled = " OR ".join(f"{duck.strip(f'intern_{f}{n}')} <> ''" for f in _BLANK_FIELDS)
    return f"SELECT id, {n} AS intern_numb, {fields} FROM stage WHERE {_COUNT_SQL} >= {n} AND ({filled})"


def _ticked(flags, count=None):
    def run(spark, sf_dir):
        columns = [name for f in flags for name in (f.flag, f.definition, f.other_text) if name]
        rows = carrier.stage(spark, sf_dir, *dict.fromkeys(["id", "intern_count", *columns]))
        rows = rows.withColumn("reported", count_truncated("intern_count"))
        return unpivot_selected(rows, flags, ["id"], count=count)

    return run


def ticked_sql(flags, key="id", gate=None):
    selects = []
    for f in flags:
        slot = "CAST(NULL AS INTEGER)" if f.slot is None else f.slot
        code = "CAST(NULL AS INTEGER)" if f.code is None else f.code
        label = duck.labelled(f.definition, f.label, f.other_text)
        where = duck.selected(f.flag)
        if gate is not None:
            where += f" AND {gate} >= {f.slot}"
        selects.append(f"SELECT {key}, {slot} AS slot, {code} AS code, {label} AS label FROM stage WHERE {where}")
    return S + duck.union_all(selects)


UNPIVOTS = [
    Case(
        "internship_slots_direct",
        "G1",
        lambda s, d: intern.direct_slots(carrier.stage(s, d)),
        S + duck.union_all([_direct_slot_sql(n) for n in (1, 2, 3)]),
    ),
    Case("internship_slots_counted", "G2", _slots_with_answers, S + duck.union_all([_answered_slot_sql(n) for n in (1, 2, 3)])),
    Case("experience_flags", "G3", _ticked(specs.INTL_EXPERIENCE), ticked_sql(specs.INTL_EXPERIENCE)),
    Case("experience_flags_by_evidence", "G3s", lambda s, d: intl_exp.direct_single(carrier.stage(s, d)), S + SINGLE_SQL),
    Case(
        "internship_options",
        "G4",
        _ticked(specs.INTERN_LEARNED, count="reported"),
        ticked_sql(specs.INTERN_LEARNED, gate=duck.count_truncated("intern_count")),
    ),
    Case("job_options", "G5", _ticked(specs.JOB_LEARNED), ticked_sql(specs.JOB_LEARNED)),
]


def _sorted_new_terms(spark, sf_dir):
    return new_term_labels(carrier.stage(spark, sf_dir), _existing_labels(spark, sf_dir)).select("term").orderBy("term")


ORDERINGS = [
    Case(
        "new_terms_sorted",
        "H1",
        _sorted_new_terms,
        _LABELS_SQL + "SELECT term FROM derived WHERE term >= 2160 ORDER BY term",
    ),
]

CASES = [*FILTERS, *JOINS, *AGGREGATES, *SETS, *UNPIVOTS, *ORDERINGS]
