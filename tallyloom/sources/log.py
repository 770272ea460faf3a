"""Append-only log tables.

Every run appends its rows under a run number and touches nothing that is there. What holds for a key is what the
last run said about it. Now and then the rows that still matter are written once more as a base, from which readers start;
runs that an earlier base has covered are dropped then, so that whoever began reading before the new base finds its files.

A log has the data column `run` and is partitioned by `kind` (`base` or `run`) and `part_run`. A base has the number of the
last run in it. The runs of two sessions at once may share a number; their rows are all kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPACT_AFTER_RUNS = 64
_LAYOUT = ("kind", "part_run")


class Log:
    """A log table by name. Nothing is stored before the first run."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def _numbers(self) -> tuple[int, int, int]:
        """The last base, the last run and the number of runs after that base. Reads partition names only."""
        parts = self.spark.table(self.table).select(*_LAYOUT).distinct()
        base = F.max(F.when(F.col("kind") == "base", F.col("part_run"))).alias("base")
        found = parts.agg(base, F.max("part_run").alias("last"), F.collect_set(F.when(F.col("kind") == "run", F.col("part_run"))).alias("runs")).first()
        base, last = (-1 if value is None else value for value in (found["base"], found["last"]))
        return base, last, sum(run > base for run in found["runs"])

    def append(self, rows: DataFrame) -> int:
        """Adds the rows of one run and returns its number."""
        run = self._numbers()[1] + 1 if self.exists() else 0
        self._write(rows.withColumn("run", F.lit(run).cast("long")), "run", run)
        return run

    def _write(self, rows: DataFrame, kind: str, run: int) -> None:
        placed = rows.withColumns({"kind": F.lit(kind), "part_run": F.lit(run).cast("long")}).hint("rebalance")
        if self.exists():
            placed.select(*self.spark.table(self.table).columns).write.insertInto(self.table)
        else:
            placed.write.partitionBy(*_LAYOUT).format("parquet").saveAsTable(self.table)

    def rows(self) -> DataFrame:
        """The last base and all runs after it, with `run`."""
        base = self._numbers()[0]
        kept = F.when(F.col("kind") == "base", F.col("part_run") == base).otherwise(F.col("part_run") > base)
        return self.spark.table(self.table).where(kept).drop(*_LAYOUT)

    def compact(self, still_needed: Callable[[DataFrame], DataFrame], after_runs: int = COMPACT_AFTER_RUNS) -> bool:
        """Writes a new base if `after_runs` runs or more came after the last one; `still_needed` picks its rows."""
        base, last, runs = self._numbers()
        if runs < after_runs:
            return False
        self._write(still_needed(self.rows()), "base", last)
        covered = [f"(kind = 'run' AND part_run <= {base})", f"(kind = 'base' AND part_run < {base})"]
        parts = self.spark.table(self.table).where(" OR ".join(covered)).select(*_LAYOUT).distinct().collect()
        if parts:
            specs = ", ".join(f"PARTITION (kind = '{row['kind']}', part_run = {row['part_run']})" for row in parts)
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS {specs}")
        return True


def latest(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """For each key the row of its last run (one of them, if a run names a key twice)."""
    others = [c for c in rows.columns if c not in key]
    last = F.max_by(F.struct(*[F.col(c) for c in others]), "run").alias("last")
    return rows.groupBy(*key).agg(last).select(*key, *[F.col(f"last.{c}").alias(c) for c in others])
