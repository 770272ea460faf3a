"""The wide stage: one row per respondent and term, every answer as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.plans import specs

# Delivered column names that no specification in specs.py mentions.
_ATTRIBUTES = (
    "intern_count",
    "collection_method",
    "Have_PostGrad_Info",
    "Plans_Cleaned",
    "plans_cleaned_definition",
    "plans_other",
    "SFT_assist",
    "indicator_internship",
    "indicator_international_experience",
    "indicator_undergrad_research",
    "indicator_stay_connected_PSU",
    "indicator_fulltime_employment",
    "indicator_parttime_employment",
    "indicator_any_employment",
    "indicator_further_education",
    "indicator_ps_committment",
    "indicator_fellowship",
    "indicator_post_intern_residency",
    "indicator_still_seeking",
    "indicator_military",
    "indicator_entrepreneurship",
    "indicator_other_plans",
)
_RESPONSE_EXTRAS = ("EMP_remote", "EMP_remote_definition", "FS_Province")


def _flag_columns(*groups) -> list[str]:
    return [
        name for group in groups for f in group for name in (f.flag, f.definition, f.other_text) if name is not None
    ]


def _unique(names) -> tuple[str, ...]:
    return tuple(dict.fromkeys(names))


ANSWER_COLUMNS = _unique(
    [
        *_ATTRIBUTES,
        *(c for group in specs.intern_groups(specs.INTERN_DIRECT_FIELDS).values() for c in group.values()),
        *(c for group in specs.intern_groups(specs.INTERN_CLEANED_FIELDS).values() for c in group.values()),
        *_flag_columns(specs.INTERN_LEARNED, specs.JOB_LEARNED),
        *_flag_columns(specs.INTL_EXPERIENCE),
        *specs.CONTACT_LABELS,
        *(f"{name}_definition" for name in specs.CONTACT_PRECEDENCE),
        *specs.RESPONSE_EVIDENCE,
        *_RESPONSE_EXTRAS,
    ]
)

STAGE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("student_id", T.StringType()),
        T.StructField("term", T.StringType()),
        *(T.StructField(name, T.StringType()) for name in ANSWER_COLUMNS),
        T.StructField("LOAD_UTC_DT", T.TimestampType()),
    ]
)

# What every builder together reads; the schema check compares a delivery with this.
REQUIRED_COLUMNS = tuple(STAGE_SCHEMA.fieldNames())

# Columns that the builders compare with Y.
FLAG_COLUMNS = _unique(
    [
        *(f.flag for f in specs.INTL_EXPERIENCE),
        *specs.CONTACT_PRECEDENCE,
        *specs.STATUS_PRECEDENCE,
    ]
)


def case_blind_flags(stage: DataFrame) -> DataFrame:
    """The stage with flags that compare without regard to case and trailing blanks, as some databases do.

    By default flags are compared exactly. Direct variants built on this stage take ``y`` and ``Y `` for ``Y``.
    """
    return stage.withColumns({name: F.collate(name, "UTF8_LCASE_RTRIM") for name in FLAG_COLUMNS})
