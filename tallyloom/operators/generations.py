"""Stored tables whose new rows are seen all at once.

The rows of a table lie in `<table>__rows`, partitioned by key and generation, and are written once. Which generations
of which keys are live is said by a manifest of the whole database, a small table of its own for every run, and the view
`live` names the manifest that holds. A table is a view that joins its rows with `live`. A run writes its rows, then its
manifest, and puts the view in its place last: whoever reads a table before that step sees all old rows, whoever reads it after
that sees all new ones, in all tables of the run. A run that fails, or whose rows do not pass a check, changes nothing.

Manifests have a row for each table, key and generation, with the number of its rows, so counts need no scan. Reading prunes
by the manifest at run time, so generations that are not live any more cost no reading until they are dropped.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.lookup import exclude
from tallyloom.operators.quality import observed, watch

PARTITION_COLUMN = "part_key"
NULL_KEY = "<null>"
BLANK_KEY = "<blank>"
#: The key of rows that are kept without one.
WHOLE_TABLE = "<all>"
#: Manifests, beside the one that holds, whose rows are kept for readers that began before.
KEPT_MANIFESTS = 2
_MANIFEST = "table_name string, part_key string, generation string, n_rows long"


class ConflictError(RuntimeError):
    """Another run has published since this one began."""


class AuditError(RuntimeError):
    """Rows that were written do not pass a check; nothing was published."""


@dataclass(frozen=True)
class Check:
    """A condition on the metrics of a run (table -> metric -> value), and what to say if it does not hold.

    `reads` names all tables whose metrics it looks at; such a check can be made as soon as those are written.
    """

    holds: Callable[[Mapping[str, Mapping[str, int]]], bool]
    message: str
    reads: tuple[str, ...] = ()


def with_partition_key(df: DataFrame, key: str = "term") -> DataFrame:
    """Adds the partition column. Null and empty keys get names: a partition folder cannot tell them apart."""
    named = F.when(F.col(key).isNull(), NULL_KEY).when(F.col(key) == "", BLANK_KEY).otherwise(F.col(key))
    return df.withColumn(PARTITION_COLUMN, named)


class Generations:
    """The tables of one database."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database
        self.live = f"{database}.live"
        if not spark.catalog.tableExists(self.live):
            self._write_manifest(spark.createDataFrame([], _MANIFEST), "00000000_none")
            self._point_to("00000000_none")

    def _write_manifest(self, rows: DataFrame, number: str) -> None:
        columns = [name.split()[0] for name in _MANIFEST.split(", ")]
        rows.select(*columns).coalesce(1).write.format("parquet").saveAsTable(f"{self.database}.live__{number}")

    def _point_to(self, number: str) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.live} COMMENT '{number}' AS SELECT * FROM {self.database}.live__{number}")

    def current(self) -> str:
        """The number of the manifest that holds."""
        return self.spark.catalog.getTable(self.live).description

    def manifest(self) -> DataFrame:
        return self.spark.table(f"{self.database}.live__{self.current()}")

    def rows_table(self, name: str) -> str:
        return f"{self.database}.{name}__rows"

    def has(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.rows_table(name))

    def create(self, like: DataFrame, name: str) -> None:
        """An empty table with the columns of `like`; kept if it exists."""
        table = f"{self.database}.{name}"
        if not self.has(name):
            if self.spark.catalog.tableExists(table):
                raise ValueError(f"{table} is stored without generations")
            layout = like.limit(0).withColumns({PARTITION_COLUMN: F.lit(""), "generation": F.lit("")})
            layout.write.partitionBy(PARTITION_COLUMN, "generation").format("parquet").saveAsTable(self.rows_table(name))
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"r.{_quoted(c)}" for c in self.columns(name))
            self.spark.sql(
                f"CREATE VIEW {table} AS SELECT {columns} FROM {self.rows_table(name)} r LEFT SEMI JOIN "
                f"(SELECT part_key, generation FROM {self.live} WHERE table_name = '{name}') l "
                "ON r.part_key = l.part_key AND r.generation = l.generation"
            )

    def columns(self, name: str) -> list[str]:
        return [c for c in self.spark.table(self.rows_table(name)).columns if c not in (PARTITION_COLUMN, "generation")]

    def begin(self) -> Run:
        before = self.current()
        return Run(self, before, f"{int(before.split('_')[0]) + 1:08d}_{uuid.uuid4().hex[:12]}")

    def row_counts(self, names: Sequence[str]) -> DataFrame:
        """table_name and row_count of some tables, from the manifest alone."""
        wanted = self.spark.createDataFrame([(name,) for name in names], "table_name string")
        counted = self.manifest().groupBy("table_name").agg(F.sum("n_rows").alias("row_count"))
        return wanted.join(F.broadcast(counted), "table_name", "left").na.fill(0, ["row_count"])

    def clean(self, keep: int = KEPT_MANIFESTS) -> None:
        """Drops manifests but the last ones, and the rows of generations that none of those names.

        Generations begun after the oldest manifest that is kept are let alone: a run may be writing them.
        """
        numbers = sorted(t.name[len("live__") :] for t in self.spark.catalog.listTables(self.database) if t.name.startswith("live__"))
        published = [number for number in numbers if number <= self.current()]
        kept, gone = published[-(keep + 1) :], published[: -(keep + 1)]
        named = self.spark.createDataFrame([], _MANIFEST)
        for number in kept:
            named = named.union(self.spark.table(f"{self.database}.live__{number}"))
        named = named.select(F.col("table_name"), F.col(PARTITION_COLUMN), F.col("generation")).distinct()
        for table in self.spark.catalog.listTables(self.database):
            if not table.name.endswith("__rows"):
                continue
            stored = self.spark.table(f"{self.database}.{table.name}").where(F.col("generation") < kept[0])
            live = named.where(F.col("table_name") == table.name[: -len("__rows")]).select(
                F.col(PARTITION_COLUMN).alias("live_key"), F.col("generation").alias("live_generation")
            )
            parts = stored.select(PARTITION_COLUMN, "generation").distinct()
            dead = exclude(parts, live, [(PARTITION_COLUMN, "live_key"), ("generation", "live_generation")])
            self._drop(f"{self.database}.{table.name}", dead)
        for number in gone:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.database}.live__{number}")

    def _drop(self, table: str, parts: DataFrame) -> None:
        """Drops partitions, a bounded number at a time."""
        specs = []
        for row in parts.toLocalIterator():
            specs.append(f"PARTITION (part_key = {_literal(row[PARTITION_COLUMN])}, generation = '{row['generation']}')")
            if len(specs) == 200:
                self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")
                specs = []
        if specs:
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")


@dataclass
class Run:
    """The rows one run writes and the keys it replaces. Nothing of it is seen before publish."""

    tables: Generations
    before: str
    number: str
    metrics: dict[str, dict[str, int]] = field(default_factory=dict)
    #: Counts of what the run read, for its checks.
    metrics_of_input: dict[str, dict[str, int]] = field(default_factory=dict)
    _replaced: list[DataFrame] = field(default_factory=list)
    _refreshed: list[str] = field(default_factory=list)

    def __enter__(self) -> Run:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None:
            self.discard()

    def write(self, name: str, rows: DataFrame, key: str | None = "term", **metrics: Column) -> None:
        """Writes rows of a table, once; `rows` and the given metrics are counted meanwhile."""
        self.tables.create(rows, name)
        keyed = rows.withColumn(PARTITION_COLUMN, F.lit(WHOLE_TABLE)) if key is None else with_partition_key(rows, key)
        watched, counted = watch(keyed, rows=F.count(F.lit(1)), **metrics)
        placed = watched.withColumn("generation", F.lit(self.number)).hint("rebalance", PARTITION_COLUMN)
        table = self.tables.rows_table(name)
        placed.select(*self.tables.spark.table(table).columns).write.insertInto(table)
        self.metrics[name] = observed(counted, "rows", *metrics)

    def replace(self, name: str, keys: DataFrame, key: str = "term", include_null_key: bool = True) -> None:
        """The rows whose key is in `keys` (column `key`) are to give way to those of this run."""
        named = with_partition_key(keys, key).select(F.lit(name).alias("table_name"), PARTITION_COLUMN)
        self._replaced.append(named if include_null_key else named.where(F.col(PARTITION_COLUMN) != NULL_KEY))

    def refresh(self, name: str) -> None:
        """All rows of a table are to give way to those of this run."""
        self._refreshed.append(name)

    def _written(self) -> DataFrame:
        """What this run wrote; only the footers of its files are read."""
        spark = self.tables.spark
        found = spark.createDataFrame([], _MANIFEST)
        for name in self.metrics:
            own = spark.table(self.tables.rows_table(name)).where(F.col("generation") == self.number)
            counts = own.groupBy(PARTITION_COLUMN).agg(F.count("*").alias("n_rows"))
            found = found.unionByName(counts.withColumns({"table_name": F.lit(name), "generation": F.lit(self.number)}))
        return found

    def audit(self, checks: Sequence[Check]) -> None:
        """Raises if some of the checks do not hold."""
        metrics = {**self.metrics_of_input, **self.metrics}
        failed = [check.message for check in checks if not check.holds(metrics)]
        if failed:
            raise AuditError("; ".join(failed))

    def audit_early(self, checks: Sequence[Check]) -> None:
        """Makes the checks that say what they read and for which all of that is counted; the others wait for publish."""
        known = {*self.metrics_of_input, *self.metrics}
        self.audit([check for check in checks if check.reads and known.issuperset(check.reads)])

    def publish(self, checks: Sequence[Check] = (), clean: bool = True) -> None:
        """Makes the rows seen, in one step, if all checks hold and no other run was quicker."""
        spark, tables = self.tables.spark, self.tables
        self.audit(checks)
        old = spark.table(f"{tables.database}.live__{self.before}")
        if self._refreshed:
            old = old.where(~F.col("table_name").isin(*self._refreshed))
        for named in self._replaced:
            gone = named.distinct().toDF("gone_table", "gone_key")
            old = exclude(old, gone, [("table_name", "gone_table"), (PARTITION_COLUMN, "gone_key")])
        tables._write_manifest(old.unionByName(self._written()), self.number)
        stored = {row["table_name"]: row["n"] for row in self._of_manifest().groupBy("table_name").agg(F.sum("n_rows").alias("n")).collect()}
        lost = [name for name, counted in self.metrics.items() if counted["rows"] != stored.get(name, 0)]
        if lost:
            raise AuditError(f"the rows counted while writing are not those stored: {', '.join(lost)}")
        if tables.current() != self.before:
            raise ConflictError(f"published meanwhile: {tables.current()}")
        tables._point_to(self.number)
        if clean:
            tables.clean()

    def _of_manifest(self) -> DataFrame:
        return self.tables.spark.table(f"{self.tables.database}.live__{self.number}").where(F.col("generation") == self.number)

    def discard(self) -> None:
        """Drops what the run wrote."""
        spark, tables = self.tables.spark, self.tables
        if tables.current() == self.number:
            return
        for table in spark.catalog.listTables(tables.database):
            if table.name.endswith("__rows"):
                own = spark.table(f"{tables.database}.{table.name}").where(F.col("generation") == self.number)
                tables._drop(f"{tables.database}.{table.name}", own.select(PARTITION_COLUMN, "generation").distinct())
        spark.sql(f"DROP TABLE IF EXISTS {tables.database}.live__{self.number}")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
