"""Loading delivered CSV files into the raw stage."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.terms import base_name
from tallyloom.functions.text import blank_to_null, null_text, windows_text
from tallyloom.operators.quality import observed, watch
from tallyloom.operators.sets import union_all
from tallyloom.sources.deliveries import file_id
from tallyloom.sources.paths import literal_path, plain_path
from tallyloom.sources.records import data_records, decoded

@dataclass(frozen=True)
class IngestSpec:
    """How delivered columns become stage columns.

    `columns` maps header names to stage columns, `casts` names the stage columns that are not plain text,
    `defaults` gives values for columns that are missing or blank.
    """

    columns: Mapping[str, str]
    casts: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, str] = field(default_factory=dict)


# The declared raw stage. Header names and stage columns coincide today.
RAW_COLUMNS = (
    "STUDENT_ID",
    "TERM",
    "MAJOR",
    "SURVEY_DATE",
    "CONN_TO_PSU_RESPONSE",
    "EMPL_JOB_LRNED",
    "INTERN_IND",
    "INTERN_LRNED",
)
RAW_STAGE = IngestSpec(
    columns={name: name for name in RAW_COLUMNS},
    casts={"SURVEY_DATE": "timestamp", "INTERN_IND": "string"},
    defaults={"INTERN_IND": "N"},
)
LINEAGE_COLUMNS = ("FILE_ID", "FILE_NAME", "LOAD_TS")
_LINEAGE_SCHEMA = "FILE_ID string, FILE_NAME string, LOAD_TS timestamp"
_RECORD = "_record"
_QUOTED_CELL = r'"(?:[^"]++|"")*+"'


def map_header(df: DataFrame, columns: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Renames by header name, ignoring case; a header that was not delivered becomes a null column.

    Of the other columns only those in `keep` stay.
    """
    delivered = {name.lower(): name for name in df.columns}

    def source(header: str) -> Column:
        name = delivered.get(header.lower())
        return null_text() if name is None else F.col(_quoted(name))

    return df.select(*[source(header).alias(target) for header, target in columns.items()], *keep)


def apply_casts(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Declared types; text that cannot be read as such becomes null."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in casts.items()})


def apply_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Declared defaults for null and blank cells."""
    return df.withColumns(
        {
            name: F.when(blank_to_null(name).isNull(), F.lit(default)).otherwise(F.col(name))
            for name, default in defaults.items()
        }
    )


def shape(df: DataFrame, spec: IngestSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Header mapping, then defaults, then casts."""
    return apply_casts(apply_defaults(map_header(df, spec.columns, keep), spec.defaults), spec.casts)


def read_deliveries(
    spark: SparkSession, files: DataFrame, spec: IngestSpec | None = None, counted: dict[tuple, Observation] | None = None
) -> DataFrame:
    """The rows of all files with FILE_ID, FILE_NAME and LOAD_TS; all-text columns unless `spec` says otherwise.

    `files` comes from inspect_files. Files with the same header and encoding are read together, each file with
    the column order of its own header. Of equal header names the second is called `name_2`, a column without a
    name by its place. Cells beyond the header are left out here and found by surplus_cells. The driver handles
    one short row per file, as Spark's file index does. `counted` gets a counter for each group of files whose records run over
    several lines: how many have surplus cells, known once the rows were written, for surplus_cells.
    """
    groups = _alike(files)
    if not groups:
        raise ValueError("no files to read")
    parts = [_rows(spark, paths, *group, counted) for group, paths in groups.items()]
    if spec is not None:
        return union_all([shape(part, spec, keep=LINEAGE_COLUMNS) for part in parts])
    return reduce(lambda rows, part: rows.unionByName(part, allowMissingColumns=True), parts)


def surplus_cells(spark: SparkSession, files: DataFrame, counted: Mapping[tuple, Observation] | None = None) -> DataFrame:
    """The records with more cells than their file's header: FILE_ID, FILE_NAME, LOAD_TS, n_columns, n_cells, record.

    Files none of whose lines has more commas than the header has are not read again, nor are groups of files of which
    `counted` (from read_deliveries, when its rows were written) says that no record has surplus cells.
    """
    found = []
    files = with_more_commas(files)
    for group, paths in _alike(files).items():
        header, is_utf8, has_line_breaks, root = group
        names = column_names(header)
        if not names:
            continue
        if counted and group in counted and observed(counted[group], "surplus")["surplus"] == 0:
            continue
        if has_line_breaks:
            raw = data_records(spark, paths).withColumn(_RECORD, decoded(F.col("record"), is_utf8)).drop("record")
            lineage, n_cells = _lineage(root, F.col("path")), _n_cells(F.col(_RECORD))
            more = raw.select(*lineage, n_cells.alias("n_cells"), _RECORD).where(F.col("n_cells") > len(names))
            found.append(more.select(*LINEAGE_COLUMNS, F.lit(len(names)).alias("n_columns"), "n_cells", F.col(_RECORD).alias("record")))
            continue
        raw = _raw_rows(spark, paths, names, is_utf8, _RECORD)
        n_cells = _n_cells(F.col(_RECORD))
        # Spark gives the record only where all cells are read, so the condition names them
        length = F.length(F.concat_ws("", *[F.col(_quoted(name)) for name in names]))
        cells = raw.select(*_lineage(root), n_cells.alias("n_cells"), length.alias("length"), _RECORD)
        more = cells.where((F.col("n_cells") > len(names)) & (F.col("length") >= 0))
        record = F.col(_RECORD) if is_utf8 else windows_text(F.col(_RECORD))
        columns = F.lit(len(names)).alias("n_columns")
        found.append(more.select(*LINEAGE_COLUMNS, columns, "n_cells", record.alias("record")))
    if found:
        return union_all(found)
    return spark.createDataFrame([], _LINEAGE_SCHEMA + ", n_columns int, n_cells int, record string")


def with_more_commas(files: DataFrame) -> DataFrame:
    """The files in which a record may have more cells than the header; records over several lines are not told from lines."""
    commas = F.octet_length("header") - F.octet_length(F.replace(F.col("header"), F.lit(","), F.lit("")))
    quoted = F.contains(F.col("header"), F.lit('"'))
    return files.where(F.col("has_line_breaks") | quoted | (F.col("most_commas") > commas))


def reconciled(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Per file of inspect_files: file_id, file_name, data_lines, n_rows and whether they agree.

    Where quoted cells run over several lines the counts cannot be compared, and `agrees` is null.
    """
    counts = rows.groupBy(F.col("FILE_ID").alias("counted_id")).agg(F.count("*").alias("n_rows"))
    both = files.join(counts, F.col("file_id") == F.col("counted_id"), "left")
    n_rows = F.coalesce("n_rows", F.lit(0))
    agrees = F.when(~F.col("has_line_breaks"), n_rows == F.col("data_lines"))
    return both.select("file_id", "file_name", "data_lines", n_rows.alias("n_rows"), agrees.alias("agrees"))


def column_names(header: str) -> list[str]:
    """Names of a header's columns, told apart without regard to case."""
    names, taken = [], {name.lower() for name in (*LINEAGE_COLUMNS, _RECORD)}
    for place, delivered in enumerate(next(csv.reader([header.lstrip("\ufeff")]), [])):
        name = wanted = delivered.strip() or f"_c{place}"
        number = 1
        while name.lower() in taken:
            number += 1
            name = f"{wanted}_{number}"
        taken.add(name.lower())
        names.append(name)
    return names


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _commas(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))


def _n_cells(record: Column) -> Column:
    return _commas(F.regexp_replace(record, _QUOTED_CELL, "")) + 1


def _alike(files: DataFrame) -> dict[tuple, list[str]]:
    """Paths by header, encoding, line breaks and inbox."""
    groups: dict[tuple, list[str]] = {}
    for row in files.select("path", "header", "is_utf8", "has_line_breaks", "root").toLocalIterator():
        groups.setdefault((row["header"], row["is_utf8"], row["has_line_breaks"], row["root"]), []).append(row["path"])
    return groups


def _lineage(root: str | None, path: Column | None = None) -> list[Column]:
    path = plain_path(F.col("_metadata.file_path")) if path is None else path
    return [file_id(path, root).alias("FILE_ID"), base_name(path).alias("FILE_NAME"), F.current_timestamp().alias("LOAD_TS")]


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _raw_rows(spark: SparkSession, paths: Sequence[str], names: Sequence[str], is_utf8: bool, record: str | None = None) -> DataFrame:
    """Cells as text; with `record`, also the text of the records whose number of cells is not the header's."""
    reader = (
        spark.read.schema(_text_schema([*names, record] if record else names))
        .option("header", True)
        .option("enforceSchema", True)
        .option("escape", '"')
        .option("encoding", "UTF-8" if is_utf8 else "ISO-8859-1")
    )
    if record:
        reader = reader.option("columnNameOfCorruptRecord", record)
    return reader.csv([literal_path(path) for path in sorted(paths)])


def _rows(
    spark: SparkSession,
    paths: Sequence[str],
    header: str,
    is_utf8: bool,
    has_line_breaks: bool,
    root: str | None,
    counted: dict[tuple, Observation] | None = None,
) -> DataFrame:
    names = column_names(header)
    if not names:
        return spark.createDataFrame([], _LINEAGE_SCHEMA)
    if has_line_breaks:
        # Spark's reader would take such a file as one task
        found = data_records(spark, paths)
        if counted is not None:
            record = decoded(F.col("record"), is_utf8)
            # quoted cells are looked for only in records with enough commas
            surplus = F.count_if((_commas(record) >= len(names)) & (_n_cells(record) > len(names)))
            found, counted[header, is_utf8, has_line_breaks, root] = watch(found, surplus=surplus)
        columns = ", ".join(f"{_quoted(name)} STRING" for name in names)
        cells = F.from_csv(decoded(F.col("record"), is_utf8), columns, {"escape": '"'})
        parsed = found.select(cells.alias("cells"), "path")
        return parsed.select(*[F.col(f"cells.{_quoted(name)}") for name in names], *_lineage(root, F.col("path")))
    rows = _raw_rows(spark, paths, names, is_utf8)
    cells = [F.col(_quoted(name)) for name in names]
    if not is_utf8:
        cells = [windows_text(cell).alias(name) for cell, name in zip(cells, names, strict=True)]
    return rows.select(*cells, *_lineage(root))
