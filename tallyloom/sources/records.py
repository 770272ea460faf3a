"""Records of CSV files whose quoted cells run over several lines, read in splits.

Spark reads such files with one task per file, as a split cannot know whether it begins inside a quoted cell. Here
every line is a function from the state before it (inside a quoted cell or not) to the state after it; lines either keep
the state, turn it round, or end in one state whatever came before. Running compositions of these functions, first over the
lines of each chunk (a part of a split of bounded size), then over the chunks of each file, give the state before every line,
and so the lines that begin a record. Lines of a record are put together again, and `from_csv` reads its cells. Lines are
shuffled twice and no more: by chunk, then by the stretch of the file in which their record begins. A task gets a few
stretches, each with a good part of its text, so a table by file can be written from there without another shuffle.

A quote opens a quoted cell only where a cell begins; elsewhere it is an ordinary character, as in Spark's own reader.
Line ends inside cells are kept as they are; at the end of a record a carriage return falls away. Blank lines outside
cells are no records. A quote that is never closed makes the rest of its file one record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions.text import windows_text
from tallyloom.sources.paths import literal_path, plain_path

#: The most lines that a window holds.
CHUNK_LINES = 4096
#: Text that a task gets, more or less.
BYTES_PER_TASK = 8 * 1024 * 1024
#: A task gets so many stretches of files, on average.
STRETCHES_PER_TASK = 2
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_CELLS = rf'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+)?+,)*+'


def opens(line: str | Column) -> Column:
    """Whether a line that begins outside a quoted cell ends inside one."""
    value = F.col(line) if isinstance(line, str) else line
    return F.contains(value, F.lit('"')) & value.rlike(rf'(?s)\A{_CELLS}"{_INSIDE}\z')


def stays_open(line: str | Column) -> Column:
    """Whether a line that begins inside a quoted cell ends inside one."""
    value = F.col(line) if isinstance(line, str) else line
    return ~F.contains(value, F.lit('"')) | value.rlike(rf'(?s)\A{_INSIDE}(?:"[^,]*+,{_CELLS}"{_INSIDE})?+\z')


def lines_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The lines of files: path, block_start (of their split), line_id (ascending in a split) and value."""
    lines = spark.read.option("lineSep", "\n").text([literal_path(path) for path in sorted(paths)])
    return lines.select(
        plain_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
        "value",
    )


def _composed(rows: DataFrame, by: list[str], order: list[str], outside: Column, inside: Column) -> DataFrame:
    """Adds from_outside and from_inside: the state after each row if the first row of its group begins in that state.

    `outside` and `inside` (0 or 1) are the state after the row itself, by the state before it.
    """
    running = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    turns = F.sum(F.when((F.col("_o") == 1) & (F.col("_i") == 0), 1).otherwise(0)).over(running)
    fixed = F.when(F.col("_o") == F.col("_i"), F.struct(F.col("_o").alias("state"), F.col("_turns").alias("turns")))
    last = F.last(fixed, ignorenulls=True).over(running)
    rows = rows.withColumns({"_o": outside, "_i": inside}).withColumn("_turns", turns).withColumn("_fixed", last)

    def after(start: int) -> Column:
        turned = F.col("_turns") - F.coalesce(F.col("_fixed.turns"), F.lit(0))
        return F.pmod(F.coalesce(F.col("_fixed.state"), F.lit(start)) + turned, F.lit(2)).cast("int")

    return rows.withColumns({"from_outside": after(0), "from_inside": after(1)}).drop("_o", "_i", "_turns", "_fixed")


def tasks_for(spark: SparkSession, paths: Sequence[str]) -> int:
    """The number of tasks that share the text of the files."""
    jvm, context = spark.sparkContext._jvm, spark.sparkContext
    found = [jvm.org.apache.hadoop.fs.Path(path) for path in paths]
    n_bytes = sum(path.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(path).getLength() for path in found)
    return max(context.defaultParallelism, -(-n_bytes // BYTES_PER_TASK))


def records(lines: DataFrame, tasks: int | None = None) -> DataFrame:
    """path, is_first (whether it is the file's first record) and record of every record; `lines` is from lines_of.

    Lines are worked on in chunks, so that no window holds more than CHUNK_LINES of them, and dealt out to `tasks` tasks (see
    tasks_for; the session's number of shuffle partitions, if it is not given). The records come in stretches of their
    files, dealt out in turn.
    """
    tasks = tasks or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunk = ["path", "block_start", "chunk"]
    numbered = lines.withColumn("chunk", F.expr(f"line_id div {CHUNK_LINES}"))
    # the join below asks this of one of its sides; asked of both, the shuffled lines are the same and serve both
    numbered = numbered.where(" AND ".join(f"{name} IS NOT NULL" for name in chunk))
    dealt = numbered.repartition(tasks, *chunk)
    own = _composed(dealt, chunk, ["line_id"], opens("value").cast("int"), stays_open("value").cast("int"))
    # for both states a chunk can begin in: the state before each line, and how many records have begun
    in_chunk = Window.partitionBy(*chunk).orderBy("line_id")
    states = {"outside": 0, "inside": 1}
    before = {f"starts_{name}": F.coalesce(F.lag(f"from_{name}").over(in_chunk), F.lit(start)) == 0 for name, start in states.items()}
    running = in_chunk.rowsBetween(Window.unboundedPreceding, 0)
    own = own.withColumns(before).withColumns({f"n_{name}": F.sum(F.col(f"starts_{name}").cast("long")).over(running) for name in states})
    own = own.drop(*before)

    # one row per chunk: its function as a whole, the state it begins in, and the last record that began before it
    last = [F.max_by(f"from_{name}", "line_id").alias(f"end_{name}") for name in states]
    n_bytes = F.sum(F.octet_length("value") + 1).alias("n_bytes")
    ends = own.groupBy(*chunk).agg(*last, *[F.max(f"n_{name}").alias(f"n_{name}") for name in states], n_bytes)
    whole = _composed(ends, ["path"], ["block_start", "chunk"], F.col("end_outside"), F.col("end_inside"))
    in_file = Window.partitionBy("path").orderBy("block_start", "chunk")
    top = F.lag("chunk").over(in_file).isNull()
    whole = whole.withColumns({"state": F.coalesce(F.lag("from_outside").over(in_file), F.lit(0)), "top": top})
    whole = whole.withColumn("n", F.when(F.col("state") == 0, F.col("n_outside")).otherwise(F.col("n_inside")))
    earlier_rows = in_file.rowsBetween(Window.unboundedPreceding, -1)
    stretch = F.expr(f"coalesce(bytes_before, 0) div {max(1, BYTES_PER_TASK // STRETCHES_PER_TASK)}")
    share = F.pmod(F.xxhash64("path") + stretch, F.lit(tasks)).cast("int")
    whole = whole.withColumn("bytes_before", F.sum("n_bytes").over(earlier_rows)).withColumn("share", share)

    def record_of(number: str) -> Column:
        return F.when(F.col(number) > 0, F.struct("share", "top", "block_start", "chunk", F.col(number).alias("number")))

    earlier = F.last(record_of("n"), ignorenulls=True).over(earlier_rows)
    begins = whole.select(*chunk, "state", "top", "share", earlier.alias("carried"))

    # lines before the first start of a chunk belong to the last record of an earlier one
    known = own.join(begins.hint("merge"), chunk)  # lines are dealt out by chunk already
    number = F.when(F.col("state") == 0, F.col("n_outside")).otherwise(F.col("n_inside"))
    placed = known.withColumn("number", number).withColumn("of", F.coalesce(record_of("number"), F.col("carried")))

    parts = F.sort_array(F.collect_list(F.struct("block_start", "line_id", "value"))).alias("parts")
    together = placed.select(F.col("of.share").alias("share"), "path", "of", "block_start", "line_id", "value")
    whole = together.repartitionById(tasks, F.col("share")).groupBy("share", "path", "of").agg(parts)
    text = F.regexp_replace(F.array_join(F.col("parts.value"), "\n"), r"\r\z", "")
    is_first = F.col("of.top") & (F.col("of.number") == 1)
    return whole.select("path", is_first.alias("is_first"), text.alias("record"))


def decoded(record: Column, is_utf8: bool) -> Column:
    return record if is_utf8 else windows_text(F.decode(record.cast("binary"), "ISO-8859-1"))


def first_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path and record of the first record of every file."""
    return records(lines_of(spark, paths), tasks_for(spark, paths)).where("is_first").select("path", "record")


def data_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path and record of all records but the first of every file and those that are blank."""
    found = records(lines_of(spark, paths), tasks_for(spark, paths)).where(~F.col("is_first"))
    return found.where(F.col("record").rlike(r"[^\x00-\x20]")).select("path", "record")
