"""Places for what the cases write."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from tallyloom.sources.workspace import new_folder


def scratch_database(spark: SparkSession) -> str:
    """A new database whose tables lie in the shared folder."""
    name = f"scratch_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(spark, name)}'")
    return name
