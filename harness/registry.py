"""All registered queries."""

from __future__ import annotations

from harness import file_cases, row_cases, scalar_cases, table_cases

CASES = [*table_cases.CASES, *row_cases.CASES, *scalar_cases.CASES, *file_cases.CASES]
BY_NAME = {case.name: case for case in CASES}
if len(BY_NAME) != len(CASES):
    raise ValueError("two cases have the same name")
