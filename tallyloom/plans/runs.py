"""Whole runs: every output table from one stage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.generations import Check, ConflictError, Generations, Run
from tallyloom.operators.quality import missing_columns
from tallyloom.plans import conn_to_psu, intern, intl_exp, learned, response, stud_attr, term_labels
from tallyloom.plans.response import ResponseLookups
from tallyloom.plans.schema import REQUIRED_COLUMNS
from tallyloom.sources.workspace import cut_lineage

LABELS = "acadyear_labels"

# Output tables that are replaced term by term when a stage is loaded.
REPLACED_TABLES = ("stud_attr", "response", "intern", "intern_lrned", "intl_exp", "conn_to_psu")


class StageError(ValueError):
    """The stage lacks columns the builders read."""


def check_stage(stage: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS) -> None:
    """Raises with the names of all missing columns."""
    missing = [row["column_name"] for row in missing_columns(stage, required).collect()]
    if missing:
        raise StageError(f"stage lacks {len(missing)} columns: {', '.join(sorted(missing))}")


def direct_tables(stage: DataFrame, lookups: ResponseLookups) -> dict[str, DataFrame]:
    """The five tables that exist in the direct variant."""
    return {
        "stud_attr": stud_attr.direct(stage),
        "response": response.response(stage, lookups),
        "intern": intern.direct(stage, lookups.company),
        "intl_exp": intl_exp.direct(stage),
        "conn_to_psu": conn_to_psu.direct(stage),
    }


def full_tables(
    stage: DataFrame,
    lookups: ResponseLookups,
    existing_labels: DataFrame | None = None,
    load_date: Column | None = None,
) -> dict[str, DataFrame]:
    """All eight tables as a full run leaves them: the cleaned variant wherever there is one.

    Nothing is cached: the builders read mostly different columns of a columnar stage.
    """
    return {
        "response": response.response(stage, lookups),
        "conn_to_psu": conn_to_psu.cleaned(stage),
        "acadyear_labels": term_labels.maintained(stage, existing_labels),
        "empl_job_lrned": learned.job_learned(stage, load_date),
        "intern": intern.cleaned(stage, load_date),
        "intern_lrned": learned.intern_learned(stage, load_date),
        "intl_exp": intl_exp.cleaned(stage, load_date),
        "stud_attr": stud_attr.cleaned(stage),
    }


def replace_terms(
    stage: DataFrame,
    tables: Mapping[str, DataFrame],
    database: str,
    replaced: Iterable[str] = REPLACED_TABLES,
    include_null_key: bool = True,
    term_of: Callable[[str], Column] = F.col,
    terms: DataFrame | None = None,
    checks: Sequence[Check] = (),
) -> DataFrame:
    """Write tables into a database, replacing the rows of the stage's terms; returns the row counts.

    All tables change in one step, after the rows are written and the checks hold (see Generations). A table in
    `replaced` for which there are no new rows at all is cleared for those terms if it exists.
    `term_of` must give the terms as the tables hold them: F.col for the direct variants, strict_term or
    lenient_term for the cleaned ones. `terms` (column term) names the terms if they are not just those of the stage.
    """
    stored = Generations(stage.sparkSession, database)
    with stored.begin() as run:
        keys = _stage_terms(stage, term_of) if terms is None else terms
        present = []
        for name in dict.fromkeys([*replaced, *tables]):
            if name in tables:
                run.write(name, tables[name], **_metrics(tables[name]))
            elif not stored.has(name):
                continue
            run.replace(name, keys, include_null_key=include_null_key)
            present.append(name)
        run.publish(checks)
    return stored.row_counts(present)


def _stage_terms(stage: DataFrame, term_of: Callable[[str], Column] = F.col) -> DataFrame:
    """The distinct terms of a stage, computed once however many tables are replaced."""
    return cut_lineage(stage.select(term_of("term").alias("term")).distinct())


def _metrics(rows: DataFrame) -> dict[str, Column]:
    """What is counted while the rows of a table are written, as far as it has the columns."""
    wanted = {"no_id": "stud_id", "no_term": "term"}
    return {name: F.count_if(F.col(c).isNull()) for name, c in wanted.items() if c in rows.columns}


def _add_labels(run: Run, stage: DataFrame) -> None:
    spark, table = run.tables.spark, f"{run.tables.database}.{LABELS}"
    existing = spark.table(table) if run.tables.has(LABELS) else None
    run.write(LABELS, term_labels.additions(stage, existing), key=None)


def store_labels(stage: DataFrame, database: str, attempts: int = 5) -> None:
    """Append labels for the terms the stored dimension does not have yet; rows that are there stay.

    If another run stores labels meanwhile, the additions are computed again, so no term gets two labels.
    """
    stored = Generations(stage.sparkSession, database)
    for left in reversed(range(attempts)):
        try:
            with stored.begin() as run:
                _add_labels(run, stage)
                run.publish()
            return
        except ConflictError:
            if not left:
                raise


def share_without_id(most: float, table: str = "stud_attr") -> Check:
    """At most this share of a table's stage rows may have been dropped or kept without a respondent id."""

    def holds(metrics: Mapping[str, Mapping[str, int]]) -> bool:
        read, own = metrics["stage"]["rows"], metrics[table]
        return read - own["rows"] + own["no_id"] <= most * read

    return Check(holds, f"more than {most:.0%} of the respondents have no id in {table}", ("stage", table))


def not_empty(*tables: str) -> Check:
    return Check(lambda metrics: all(metrics[t]["rows"] > 0 for t in tables), f"no rows for {', '.join(tables)}", tables)


def run_full(
    stage: DataFrame,
    lookups: ResponseLookups,
    database: str,
    load_date: Column | None = None,
    checks: Sequence[Check] = (),
) -> DataFrame:
    """A stored full run: all eight tables in a database, and how many rows each has once it is loaded.

    The cleaned tables are refreshed as a whole, `response` is replaced for the terms of the stage as they were
    delivered, and labels are added for new terms; all become seen in one step. Nothing changes if the stage lacks
    columns, a computation fails, or a check does not hold. Checks see what was counted while the rows were written,
    and the rows of the stage (`metrics["stage"]["rows"]`). Tables that checks read are written first, and a check is made
    as soon as it can be, so a run that fails one does not write the rest. Running again with the same stage gives the same rows.
    """
    check_stage(stage)
    tables = full_tables(stage, lookups, load_date=load_date)
    del tables[LABELS]  # rows that are stored are not written again
    stored = Generations(stage.sparkSession, database)
    audited = [name for check in sorted(checks, key=lambda check: len(check.reads)) for name in check.reads if name in tables]
    with stored.begin() as run:
        if checks:
            run.metrics_of_input["stage"] = {"rows": stage.count()}  # reads no column
        for name in dict.fromkeys([*audited, *tables]):
            run.write(name, tables[name], **_metrics(tables[name]))
            run.audit_early(checks)
            if name != "response":
                run.refresh(name)
        run.replace("response", _stage_terms(stage))
        _add_labels(run, stage)
        run.publish(checks)
    return stored.row_counts([*tables, LABELS])
