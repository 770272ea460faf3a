"""Builders: output columns, decisions on odd answers, and the shape of the physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from harness import carrier
from tallyloom.operators.generations import AuditError, Check, Generations
from tallyloom.plans import conn_to_psu, intern, intl_exp, learned, response, runs, stud_attr, term_labels
from tallyloom.plans.schema import STAGE_SCHEMA, case_blind_flags


def stage_of(spark, *rows):
    """Stage rows from dicts; everything not named is null."""
    names = STAGE_SCHEMA.fieldNames()
    return spark.createDataFrame([tuple(row.get(name) for name in names) for row in rows], STAGE_SCHEMA)


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.fixture(scope="module")
def lookups(spark, sf_dir):
    return response.ResponseLookups.of(carrier.lookups(spark, sf_dir))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_columns(spark, sf_dir, lookups):
    stage = carrier.stage(spark, sf_dir)
    assert len(response.response(stage, lookups).columns) == 47
    assert len(stud_attr.direct(stage).columns) == 38
    assert len(stud_attr.cleaned(stage).columns) == 39
    assert tuple(intern.direct(stage, lookups.company).columns) == intern.DIRECT_COLUMNS
    assert tuple(intern.cleaned(stage).columns) == intern.CLEANED_COLUMNS
    assert tuple(intl_exp.direct(stage).columns) == intl_exp.DIRECT_COLUMNS
    assert tuple(intl_exp.cleaned(stage).columns) == intl_exp.CLEANED_COLUMNS
    assert tuple(conn_to_psu.direct(stage).columns) == conn_to_psu.DIRECT_COLUMNS
    assert tuple(conn_to_psu.cleaned(stage).columns) == conn_to_psu.CLEANED_COLUMNS
    assert tuple(learned.intern_learned(stage).columns) == learned.INTERN_COLUMNS
    assert tuple(learned.job_learned(stage).columns) == learned.JOB_COLUMNS
    assert tuple(term_labels.additions(stage).columns) == term_labels.COLUMNS


def test_definition_without_flag(spark):
    stage = stage_of(spark, {"student_id": "1", "term": "2235", "int_exp_AYEA": "N", "int_exp_AYEA_definition": "A year"})
    assert intl_exp.direct(stage).count() == 1
    assert intl_exp.cleaned(stage).count() == 0


def test_folding_happens_only_within_the_folded_answers(spark):
    row = {"student_id": "1", "term": "2235", "int_exp_none": "Y", "int_exp_studorg": "Y", "int_exp_internship": "Y"}
    assert tuples(intl_exp.direct(stage_of(spark, row, row))) == [
        ("1", "2235", "International Internship"),
        ("1", "2235", "None"),
        ("1", "2235", "Student Organization"),
        ("1", "2235", "Student Organization"),
    ]


def test_internship_slots(spark):
    stage = stage_of(
        spark,
        {"id": 1, "student_id": "1", "term": "2235", "intern_count": "1", "intern_unit2": "beyond the count"},
        {"id": 2, "student_id": "2", "term": "2235", "intern_count": "3", "intern_title1": " ", "intern_state3": "PA"},
        {"id": 3, "student_id": "3", "term": "2235", "intern_count": "x", "intern_unit1": "u"},
        {"id": 4, "student_id": None, "term": None, "intern_count": " 2 ", "intern_paid1": "maybe", "intern_paid_amt1": "$1"},
    )
    kept = intern.cleaned(stage).select("stud_id", "term", "intern_numb", "indc_intern_paid", "intern_amt_paid")
    assert tuples(kept) == [("000000002", "2235", 3, None, None), (None, None, 1, "M", None)]
    with pytest.raises(Exception, match="not a whole number: x"):
        intern.cleaned(stage, fail_on_bad_count=True).collect()


def test_options_follow_the_count(spark):
    stage = stage_of(
        spark,
        {"student_id": "1", "term": "2235", "intern_count": "2.9", "intern2_how_obtain_other": "Y", "intern2_how_obtain_other_fill": " web "},
        {"student_id": "2", "term": "2235", "intern_count": "x", "intern1_how_obtain_01": "Y"},
        {"student_id": "3", "term": "2235", "intern_count": "1", "intern1_how_obtain_14": "1", "intern2_how_obtain_01": "Y"},
    )
    assert tuples(learned.intern_learned(stage).drop("load_date")) == [
        ("000000001", "2235", 2, 99, "Internship obtained via Other: web"),
        ("000000003", "2235", 1, 14, "Internship obtained via option 14"),
    ]


def test_institution_by_term(spark, lookups):
    stage = stage_of(
        spark, *[{"student_id": "1", "term": term, "FE_college_code": "000000"} for term in ("2164", "2165", "ABCD", None)]
    )
    found = tuples(response.response(stage, lookups).select("term", "edu_inst_nm").distinct())
    # text order puts ABCD after 2165; three branches share the school code
    assert [row for row in found if row[0] != "2164"] == [
        ("2165", "Supplier#000000000 org"),
        ("ABCD", "Supplier#000000000 org"),
        (None, "Unknown"),
    ]
    assert len([row for row in found if row[0] == "2164"]) == 3


def test_contact_labels(spark):
    stage = stage_of(
        spark,
        {"student_id": "1", "term": "x", "connect_mentor": "NO", "connect_no": "No", "connect_email": "a@b.example"},
        {"student_id": "2", "term": "2235"},
        {"student_id": " ", "term": "2235", "connect_no": "Y"},
    )
    assert tuples(conn_to_psu.cleaned(stage).drop("load_date")) == [
        ("000000001", None, "Mentor, Email"),
        ("000000002", "2235", None),
    ]


def test_empty_stage_gives_empty_tables(spark, lookups):
    tables = runs.full_tables(stage_of(spark), lookups)
    assert {name: df.count() for name, df in tables.items()} == dict.fromkeys(tables, 0)


def test_stage_check(spark, sf_dir):
    stage = carrier.stage(spark, sf_dir)
    runs.check_stage(stage)
    with pytest.raises(runs.StageError, match="lacks 2 columns: EMP_salary, term"):
        runs.check_stage(stage.drop("term", "EMP_salary"))


def test_rerun_changes_nothing(spark, database, lookups):
    stage = stage_of(
        spark,
        {"student_id": "1", "term": "2235", "intern_unit1": "u", "connect_no": "Y"},
        {"student_id": "2", "term": None, "intern_unit1": "u", "connect_no": "Y"},
    )
    counts = [
        tuples(runs.replace_terms(stage, runs.direct_tables(stage, lookups), database)) for _ in range(2)
    ]
    assert counts[0] == counts[1]
    assert dict(counts[0])["intern"] == 2
    # a later stage with the same terms but no internships clears them
    later = stage_of(spark, {"student_id": "1", "term": "2235"}, {"student_id": "2", "term": None})
    cleared = dict(tuples(runs.replace_terms(later, {"stud_attr": stud_attr.direct(later)}, database)))
    assert cleared["intern"] == 0 and cleared["stud_attr"] == 2


NARROW = {
    "stud_attr.direct": lambda stage, lk: stud_attr.direct(stage),
    "stud_attr.cleaned": lambda stage, lk: stud_attr.cleaned(stage),
    "intern.direct": lambda stage, lk: intern.direct(stage, lk.company),
    "intern.cleaned": lambda stage, lk: intern.cleaned(stage),
    "intl_exp.cleaned": lambda stage, lk: intl_exp.cleaned(stage),
    "conn_to_psu.direct": lambda stage, lk: conn_to_psu.direct(stage),
    "conn_to_psu.cleaned": lambda stage, lk: conn_to_psu.cleaned(stage),
    "learned.intern": lambda stage, lk: learned.intern_learned(stage),
    "learned.job": lambda stage, lk: learned.job_learned(stage),
    "response": lambda stage, lk: response.response(stage, lk),
}


@pytest.mark.parametrize("name", NARROW)
def test_builders_shuffle_nothing_of_the_stage(spark, sf_dir, lookups, name):
    stage = carrier.stage(spark, sf_dir)
    folder = stage.inputFiles()[0].rsplit("/", 1)[0].split("/")[-1]
    text = plan(NARROW[name](stage, lookups))
    assert text.count(folder) == 1, "the stage must be scanned once"
    assert "SortMergeJoin" not in text and "Python" not in text
    stage_side = text.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in stage_side


def test_null_checks_reach_the_scan(spark, sf_dir, lookups):
    stage = carrier.stage(spark, sf_dir)
    for df in (response.response(stage, lookups), intl_exp.cleaned(stage), intern.direct_slots(stage)):
        assert "PushedFilters: [Or(" in plan(df)


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(conn_to_psu.direct(carrier.stage(spark, sf_dir)))
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    # the keys, six flags and six definitions
    assert len(schema.split(",")) == 14 and "student_id" in schema and "intern_" not in schema


def test_folded_branch_alone_is_shuffled(spark, sf_dir):
    text = plan(intl_exp.direct(carrier.stage(spark, sf_dir)))
    assert text.count("Exchange hashpartitioning") == 1


def test_flags_compare_exactly_unless_asked_otherwise(spark):
    stage = stage_of(spark, {"student_id": "1", "term": "2235", "connect_no": "y ", "int_exp_AYEA": "y"})
    assert conn_to_psu.direct(stage).count() == intl_exp.direct(stage).count() == 0
    blind = case_blind_flags(stage)
    assert conn_to_psu.direct(blind).count() == intl_exp.direct(blind).count() == 1
    assert stud_attr.direct(blind).select("indc_exp_AYEA").first()[0] == "Y"


def test_audited_run_counts_without_a_second_scan(spark, sf_dir, database, lookups):
    stage = carrier.stage(spark, sf_dir)
    with pytest.raises(AuditError, match="no id in stud_attr"):
        runs.run_full(stage, lookups, database, checks=[runs.share_without_id(0.0)])
    assert not spark.catalog.tableExists(f"{database}.stud_attr") or spark.table(f"{database}.stud_attr").count() == 0
    counts = runs.run_full(stage, lookups, database, checks=[runs.not_empty("response", "stud_attr")])
    text = plan(counts)
    assert "live__" in text and "__rows" not in text
    found = dict(tuples(counts))
    assert found["stud_attr"] == spark.table(f"{database}.stud_attr").count() > 0
    with pytest.raises(AuditError):
        runs.run_full(stage.limit(0), lookups, database, checks=[runs.not_empty("response")])
    assert dict(tuples(Generations(spark, database).row_counts(list(found)))) == found


def test_run_that_fails_a_check_does_not_write_the_tables_after_it(spark, sf_dir, database, lookups):
    stage, stored = carrier.stage(spark, sf_dir), Generations(spark, database)
    with pytest.raises(AuditError, match="no id in stud_attr"):
        runs.run_full(stage, lookups, database, checks=[runs.not_empty("intern"), runs.share_without_id(0.0)])
    assert stored.has("stud_attr") and not stored.has("response")
    # a check that does not say what it reads is made when all is written
    wrong = Check(lambda metrics: metrics["response"]["rows"] == 0, "rows in response")
    with pytest.raises(AuditError, match="^rows in response$"):
        runs.run_full(stage, lookups, database, checks=[wrong])
    assert stored.has("response") and stored.manifest().count() == 0


def test_builders_stay_small_enough_to_be_compiled(spark, sf_dir, lookups):
    # the virtual machine interprets methods of 8,000 bytes and more for good
    for name, table in runs.full_tables(carrier.stage(spark, sf_dir), lookups).items():
        text = table._sc._jvm.PythonSQLUtils.explainString(table._jdf.queryExecution(), "codegen")
        assert all(int(size) < 8000 for size in re.findall(r"maxMethodCodeSize:(\d+)", text)), name


def test_load_date_can_be_given(spark):
    stage = stage_of(spark, {"student_id": "1", "term": "2235", "int_exp_none": "Y"})
    given = F.lit("2024-01-01").cast("timestamp")
    assert str(intl_exp.cleaned(stage, given).first()["load_date"]) == "2024-01-01 00:00:00"
