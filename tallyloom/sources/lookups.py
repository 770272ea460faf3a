"""Reading lookup tables and stage extracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import count_or_null
from tallyloom.operators.conditions import not_blank
from tallyloom.plans import specs

# Columns each lookup must have.
LOOKUP_COLUMNS = {
    "country": ("country", "descr"),
    "state": ("STATE", "country", "descr"),
    "school": ("NSC_COLLEGE_AND_BRANCH_CODE", "NSC_COLLEGE_NAME"),
    "organization": ("external_system_id", "ls_school_type", "descr50"),
    "company": ("company_name_variant", "standardized_company_name"),
}


def scan_lookup(table: DataFrame, name: str) -> DataFrame:
    """The columns of a lookup that joins use."""
    return table.select(*LOOKUP_COLUMNS[name])


def read_lookups(spark: SparkSession, tables: Mapping[str, str]) -> dict[str, DataFrame]:
    """Lookups from catalog tables; `tables` maps country, state, school, organization, company to table names."""
    return {name: scan_lookup(spark.table(tables[name]), name) for name in LOOKUP_COLUMNS}


def read_lookups_jdbc(
    spark: SparkSession, url: str, tables: Mapping[str, str], options: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """The same from a database. Only the named columns are fetched."""
    reader = spark.read.format("jdbc").option("url", url).options(**(options or {}))
    return {name: scan_lookup(reader.option("dbtable", tables[name]).load(), name) for name in LOOKUP_COLUMNS}


def stage_extract(stage: DataFrame, table: str) -> DataFrame:
    """The stage columns and rows that the builder of one output table starts from."""
    columns, condition = _extracts()[table]
    rows = stage if condition is None else stage.where(condition)
    return rows.select(*columns)


def _extracts() -> dict[str, tuple[Sequence[str | Column], Column | None]]:
    id_as_key = F.col("student_id").alias("stud_id")
    intern_columns = [c for g in specs.intern_groups(_EXTRACTED_SLOT_FIELDS).values() for c in g.values()]
    return {
        "intern": (
            [
                id_as_key,
                "term",
                count_or_null("intern_count").alias("intern_count"),
                *intern_columns,
                "int_exp_studorg",
                "int_exp_studorg_definition",
            ],
            not_blank("intern_count"),
        ),
        "intern_lrned": (
            [id_as_key, "term", "intern_count", *_columns_of(specs.INTERN_LEARNED)],
            not_blank("intern_count"),
        ),
        "intl_exp": ([id_as_key, "term", *_columns_of(specs.INTL_EXPERIENCE)], None),
        "empl_job_lrned": (
            ["student_id", "term", *_columns_of(specs.JOB_LEARNED)],
            F.col("Have_PostGrad_Info").isNotNull(),
        ),
        "conn_to_psu": (["id", "student_id", "term", *specs.CONTACT_LABELS, "LOAD_UTC_DT"], None),
        "stud_attr": (
            [
                "id",
                "student_id",
                "term",
                "intern_count",
                "collection_method",
                "Have_PostGrad_Info",
                *specs.STATUS_PRECEDENCE,
                "indicator_any_employment",
                "indicator_internship",
                "indicator_international_experience",
                "indicator_undergrad_research",
                "indicator_post_intern_residency",
                "indicator_entrepreneurship",
                "indicator_stay_connected_PSU",
                "connect_assist",
                "int_exp_semAbroad",
                "int_exp_AYEA",
                "int_exp_embedded",
                "int_exp_studorg",
                "int_exp_other",
                "int_exp_other_fill",
                "int_exp_none",
                "plans_cleaned_definition",
                "plans_other",
                "LOAD_UTC_DT",
            ],
            None,
        ),
    }


def term_extract(stage: DataFrame) -> DataFrame:
    """Distinct terms that are not blank, as delivered."""
    return stage.where(not_blank("term")).select("term").distinct()


_EXTRACTED_SLOT_FIELDS = {**specs.INTERN_CLEANED_FIELDS, "intern_exp": "intern_exp"}


def _columns_of(flags) -> list[str]:
    names = [name for f in flags for name in (f.flag, f.definition, f.other_text) if name is not None]
    return list(dict.fromkeys(names))
