"""Paths of files as text and as columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_path(path: str) -> str:
    """A path in which no character is taken for a wildcard."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def plain_path(path: Column) -> Column:
    """A path as files are listed; Spark's metadata column has blanks and other characters as in %20."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
