"""Writing output tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.generations import Generations

TOKEN_COLUMN = "run_token"
JDBC_BATCH_ROWS = 1000
SAMPLE_ROWS = 5


def for_target(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly the target's columns in the target's order; surrogate ids and helpers fall away."""
    return df.select(*columns)


def append(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Add rows to a parquet table."""
    (df if columns is None else for_target(df, columns)).write.mode("append").parquet(path)


def append_once(df: DataFrame, table: str, token: str) -> None:
    """Add rows to a managed table under a token; a token that the table has already adds nothing.

    The rows are one partition, named by the token, which appears as a whole. A repeated append, be it of a run
    that does not know whether its first attempt went through, leaves the table as it is; two at once write one partition.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        layout = df.limit(0).withColumn(TOKEN_COLUMN, F.lit(""))
        layout.write.partitionBy(TOKEN_COLUMN).format("parquet").mode("ignore").saveAsTable(table)
    columns = [c for c in spark.table(table).columns if c != TOKEN_COLUMN]
    view = f"rows_{uuid.uuid4().hex}"
    df.select(*columns).createOrReplaceTempView(view)
    try:
        literal = "'" + token.replace("\\", "\\\\").replace("'", "\\'") + "'"
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({TOKEN_COLUMN} = {literal}) IF NOT EXISTS SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def refresh_table(df: DataFrame, table: str) -> None:
    """Replace all rows of a stored table in one step: readers see the old rows or the new ones (see Generations)."""
    database, name = table.rsplit(".", 1)
    with Generations(df.sparkSession, database).begin() as run:
        run.write(name, df, key=None)
        run.refresh(name)
        run.publish()


def full_refresh(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Replace all rows of a parquet table; an empty result leaves an empty table, not the old rows.

    The new rows are computed and written beside the table before it is exchanged, so a computation that fails
    leaves the old rows, and the rows may come from the table itself.
    """
    jvm = df.sparkSession.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    run = uuid.uuid4().hex
    new, old = (jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.{kind}-{run}") for kind in ("new", "old"))
    try:
        (df if columns is None else for_target(df, columns)).write.parquet(new.toString())
    except Exception:
        files.delete(new, True)
        raise
    # two renames: use refresh_table where readers must never miss the table
    if files.exists(target) and not files.rename(target, old):
        raise OSError(f"cannot move {path} aside; the new rows are in {new.toString()}")
    if not files.rename(new, target):
        raise OSError(f"cannot move {new.toString()} to {path}; the old rows are in {old.toString()}")
    files.delete(old, True)


def write(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    truncate_before_load: bool = True,
    dry_run: bool = False,
) -> DataFrame:
    """Write unless it is a dry run; returns the rows meant for the target either way."""
    rows = df if columns is None else for_target(df, columns)
    if not dry_run:
        (full_refresh if truncate_before_load else append)(rows, path)
    return rows


def sample(df: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """A few rows to look at in a dry run."""
    return df.limit(rows)


def jdbc_options(url: str, table: str, truncate: bool = False, batch_rows: int = JDBC_BATCH_ROWS) -> dict[str, str]:
    """Options of a batched database write; `truncate` keeps the table and its identity column when refreshing."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_rows), "truncate": str(truncate).lower()}


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    columns: Sequence[str],
    truncate_before_load: bool = True,
    batch_rows: int = JDBC_BATCH_ROWS,
    options: Mapping[str, str] | None = None,
) -> None:
    """Write to a database in batches, each Spark task over its own connection."""
    settings = {**jdbc_options(url, table, truncate_before_load, batch_rows), **(options or {})}
    mode = "overwrite" if truncate_before_load else "append"
    for_target(df, columns).write.format("jdbc").options(**settings).mode(mode).save()
