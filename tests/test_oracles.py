"""Every registered query against DuckDB on the small tables."""

import pytest

import __spark_entry__ as entry_point
from harness import compare
from harness.registry import BY_NAME


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.duck(sf_dir)


@pytest.mark.parametrize("name", BY_NAME)
def test_query_matches_oracle(spark, sf_dir, con, name):
    case = BY_NAME[name]
    assert compare.difference(case.run(spark, sf_dir), con, case.sql) is None


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["stud_id", "term", "intl_exp_type"]
    assert result.count() > 0
    assert set(BY_NAME) <= set(entry_point.queries()) and set(BY_NAME) <= set(entry_point.oracle_sql())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
