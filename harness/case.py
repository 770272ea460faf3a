"""One registered query: how Spark answers it and, where SQL can, how DuckDB does."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Case:
    name: str
    inventory: str  # line of the operator inventory
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
