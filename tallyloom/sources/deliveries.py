"""Looking at delivered files without loading them."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.terms import base_name
from tallyloom.functions.text import ColumnOrName, column
from tallyloom.operators.conditions import any_of
from tallyloom.sources.paths import plain_path
from tallyloom.sources.records import decoded, first_records, opens
from tallyloom.sources.workspace import cut_lineage

# Parts of header names that tell one questionnaire from the other.
UNDERGRADUATE_MARKERS = ("plans_cleaned", "fe_college", "indicator_internship")
POSTGRADUATE_MARKERS = ("wc_postgrad", "postgrad", "pg_")

# Listing columns of Spark's binaryFile source; the contents are not read unless selected.
LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


class DeliveryError(ValueError):
    """The files found are not what a run expects."""


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?"


def file_id(path: ColumnOrName, root: str | None = None) -> Column:
    """Tells files apart wherever they lie: a digest of the path below `root`, or of the whole path of other files."""
    place = F.regexp_replace(column(path), _SCHEME, "")
    base = "" if root is None else re.sub(_SCHEME, "", root).rstrip("/") + "/"
    below = place.substr(F.lit(len(base) + 1), F.length(place))
    return F.md5(F.when(F.startswith(place, F.lit(base)), below).otherwise(place).cast("binary"))


def list_files(
    spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.csv", root: str | None = None
) -> DataFrame:
    """One row per matching file: path, file_id, file_name, modified, length. Contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return reader.load(paths).select(
        "path",
        file_id("path", root).alias("file_id"),
        base_name("path").alias("file_name"),
        F.col("modificationTime").alias("modified"),
        "length",
    )


def newest(listing: DataFrame) -> DataFrame:
    """The file modified last; among equals the one whose path sorts last. Empty when there is no file."""
    last = listing.agg(F.max_by(F.struct(*listing.columns), F.struct("modified", "path")).alias("file"))
    return last.where(F.col("file").isNotNull()).select("file.*")


def newest_first(listing: DataFrame, limit: int | None = None) -> DataFrame:
    """Files from the newest to the oldest, all of them or the first few."""
    ordered = listing.orderBy(F.desc("modified"), F.desc("path"))
    return ordered if limit is None else ordered.limit(limit)


def in_path_order(listing: DataFrame) -> DataFrame:
    return listing.orderBy("path")


def guard_single(listing: DataFrame, *folder: str) -> DataFrame:
    """How many files were found, the path when it is exactly one, and what that means for a run.

    One row for the whole listing, or one per value of the `folder` columns. A null path is no file.
    """
    found = listing.groupBy(*folder).agg(F.count("path").alias("files"), F.min("path").alias("first_path"))
    verdict = F.when(F.col("files") == 0, "nothing to do").when(F.col("files") == 1, "run").otherwise("too many files")
    only = F.when(F.col("files") == 1, F.col("first_path"))
    return found.select(*folder, "files", only.alias("path"), verdict.alias("verdict"))


def single_file(spark: SparkSession, folder: str, pattern: str = "*.csv") -> str | None:
    """Path of the only matching file, None when there is none; several files are an error."""
    found = guard_single(list_files(spark, folder, pattern)).first()
    if found["files"] > 1:
        raise DeliveryError(f"{found['files']} files match {pattern} in {folder}; archive or remove the extra ones")
    return found["path"]


def survey_type(header: ColumnOrName) -> Column:
    """UG, PG or UNKNOWN from a header line; the undergraduate markers are looked for first."""
    names = F.lower(column(header))
    return (
        F.when(_contains_any(names, UNDERGRADUATE_MARKERS), "UG")
        .when(_contains_any(names, POSTGRADUATE_MARKERS), "PG")
        .otherwise("UNKNOWN")
    )


def inspect_files(
    spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.csv", root: str | None = None
) -> DataFrame:
    """One row per file: path, root, file_id, file_name, header, is_utf8, has_line_breaks, most_commas, lines, data_lines, fingerprint.

    A single aggregation over the raw lines, so large files are read in splits by many tasks and only one row
    per task and file is shuffled. The fingerprint is the same for files with the same lines, whatever their
    order. `has_line_breaks` tells of quoted fields that run over several lines, `data_lines` counts the lines
    after the header that are not blank, `most_commas` is the largest number of commas in a line. A header is the
    first record, also if a name has a line break in it; such files (one path each comes to the driver) are looked at
    again. Spark's file sources pass over files without a byte. `root` is for file_id.
    """
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    lines = reader.text(paths).select(
        "value",
        plain_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        # rows of a split are numbered in reading order
        F.monotonically_increasing_id().alias("line_id"),
    )
    commas = F.octet_length("value") - F.octet_length(F.replace(F.col("value"), F.lit(","), F.lit("")))
    first_line = F.min_by("value", F.when(F.col("block_start") == 0, F.col("line_id")))
    hashes = [F.xxhash64("value"), F.xxhash64(F.lit(1), F.col("value"))]
    files = lines.groupBy("path").agg(
        first_line.alias("header"),
        F.bool_and(F.is_valid_utf8("value")).alias("is_utf8"),
        F.bool_or(opens("value")).alias("has_line_breaks"),
        F.max(commas).alias("most_commas"),
        F.count("*").alias("lines"),
        F.greatest(F.count_if(F.col("value").rlike(r"[^\x00-\x20]")) - 1, F.lit(0)).alias("data_lines"),
        *[F.sum(h.cast("decimal(20,0)")).alias(f"hash{i}") for i, h in enumerate(hashes)],
    )
    fingerprint = F.sha2(F.concat_ws(":", *[F.col(c).cast("string") for c in ("lines", "hash0", "hash1")]), 256)
    found = files.select(
        "path",
        F.lit(root).cast("string").alias("root"),
        file_id("path", root).alias("file_id"),
        base_name("path").alias("file_name"),
        "header",
        "is_utf8",
        "has_line_breaks",
        "most_commas",
        "lines",
        "data_lines",
        fingerprint.alias("fingerprint"),
    )
    found = cut_lineage(found)
    broken = [row["path"] for row in found.where(opens("header")).select("path").collect()]
    if broken:
        whole = first_records(spark, broken).withColumnsRenamed({"path": "broken_path", "record": "whole_header"})
        found = found.join(whole, F.col("path") == F.col("broken_path"), "left")
        found = found.withColumn("header", F.coalesce("whole_header", "header")).drop("broken_path", "whole_header")
    header = F.when(F.col("is_utf8"), F.col("header")).otherwise(decoded(F.col("header"), False))
    return found.withColumn("header", header)


def header_names(files: DataFrame) -> DataFrame:
    """One row per file and header name: path, column_name."""
    plain = F.regexp_replace("header", "^\\ufeff|\"", "")
    return files.select("path", F.explode(F.split(plain, ",")).alias("column_name"))


def missing_from_headers(files: DataFrame, required: Iterable[str]) -> DataFrame:
    """Required columns a file lacks, without regard to case: path, column_name.

    Each file is compared with its own header row by row; nothing is shuffled.
    """
    plain = F.regexp_replace(F.lower("header"), "^\\ufeff|\"", "")
    present = F.transform(F.split(plain, ","), lambda name: F.trim(name))
    wanted = F.array(*[F.lit(name) for name in required])
    missing = F.filter(wanted, lambda name: ~F.array_contains(present, F.lower(name)))
    return files.select("path", F.explode(missing).alias("column_name"))


def _contains_any(text: Column, markers: Iterable[str]) -> Column:
    return any_of(text.contains(marker) for marker in markers)
