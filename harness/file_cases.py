"""Delivered files: listing, classifying, loading, picking up."""

from __future__ import annotations

from pyspark.sql import functions as F

from harness import carrier, duck
from harness.case import Case
from harness.table_cases import INTL_CLEANED_SQL, LABELS_SQL
from harness.work import scratch_database
from tallyloom.functions import lenient_term, season_label
from tallyloom.operators import quality
from tallyloom.plans import intl_exp, specs, term_labels
from tallyloom.plans.schema import REQUIRED_COLUMNS
from tallyloom.sources import deliveries, ingest, ledger
from tallyloom.sources.arrivals import missing_days_of, note_arrivals
from tallyloom.sources.workspace import new_folder
from tallyloom.streaming import pickup

S = carrier.stage_sql()

# a raw delivery as SQL over the stage, in both engines
_RAW = {
    "id": "CAST(id AS STRING)",
    "STUDENT_ID": "student_id",
    "TERM": "term",
    "MAJOR": "plans_other",
    "SURVEY_DATE": (
        "CASE id % 5 WHEN 0 THEN 'not a date' WHEN 1 THEN '' WHEN 2 THEN CAST(LOAD_UTC_DT AS STRING) "
        "WHEN 3 THEN left(CAST(LOAD_UTC_DT AS STRING), 10) END"
    ),
    "CONN_TO_PSU_RESPONSE": "connect_email",
    "EMPL_JOB_LRNED": "plans_cleaned_definition",
    "INTERN_IND": "indicator_internship",
    "INTERN_LRNED": "int_exp_other_fill",
}
_RAW_TEXT = ", ".join(f"{sql} AS {name}" for name, sql in _RAW.items())
# an empty cell of a CSV file, quoted or not, is null
_RAW_READ = ", ".join(f"nullif({sql}, '') AS {name}" for name, sql in _RAW.items())
_EARLY_SPARK, _EARLY = "LOAD_UTC_DT < '1999-01-01'", "LOAD_UTC_DT < TIMESTAMP '1999-01-01'"


_PERIODS = {
    "first": "year(LOAD_UTC_DT) < 1997",
    "second": "year(LOAD_UTC_DT) BETWEEN 1997 AND 1998",
    "third": "year(LOAD_UTC_DT) > 1998",
}


def _raw(stage):
    return stage.selectExpr(*[f"{sql} AS {name}" for name, sql in _RAW.items()])


def _deliver(rows, folder, encoding="UTF-8"):
    """Writes rows as CSV files with a header."""
    (
        rows.write.mode("append")
        .option("header", True)
        .option("escape", '"')
        .option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )


def _delivered(spark, sf_dir, condition=None):
    """A folder with the raw delivery of the stage, in separate files for three periods."""
    folder = new_folder(spark, "deliveries")
    stage = carrier.derived_stage(spark, sf_dir)
    stage = stage if condition is None else stage.where(condition)
    for period, within in _PERIODS.items():
        _deliver(_raw(stage.where(within)), f"{folder}/period={period}")
    return folder


def _ingested(spark, sf_dir):
    files = deliveries.inspect_files(spark, _delivered(spark, sf_dir))
    return ingest.read_deliveries(spark, files).select(*_RAW)


def _quoted(text):
    return F.concat(F.lit(text[0]), F.col("o_orderpriority"), F.lit(text[1:]))


def _two_encodings(spark, sf_dir):
    """Quotation marks and accents in UTF-8 files for even orders and in Windows-1252 files for odd ones."""
    orders = carrier.table(spark, sf_dir, "orders")
    utf8, windows = new_folder(spark, "utf8"), new_folder(spark, "windows")
    _deliver(orders.where("o_orderkey % 2 = 0").select("o_orderkey", _quoted("“”é€").alias("remark")), utf8)
    # written as ISO 8859-1, U+0093, U+0094 and U+0080 are the bytes Windows-1252 uses for these characters
    _deliver(
        orders.where("o_orderkey % 2 = 1").select("o_orderkey", _quoted("\x93\x94é\x80").alias("remark")),
        windows,
        encoding="ISO-8859-1",
    )
    files = deliveries.inspect_files(spark, [utf8, windows])
    return ingest.read_deliveries(spark, files).select("o_orderkey", "remark")


_SPEC = ingest.IngestSpec(
    columns={"Student_Id": "STUDENT_ID", "id": "RESPONSE_ID", "major": "MAJOR", "CAMPUS": "CAMPUS"},
)


def _mapped(spark, sf_dir):
    """Header names are matched without case; a column nobody delivered is null."""
    return ingest.map_header(_raw(carrier.derived_stage(spark, sf_dir)), _SPEC.columns)


def _mixed_headers(spark, sf_dir):
    """Files whose columns stand in different orders and partly differ, loaded together."""
    stage = carrier.derived_stage(spark, sf_dir)
    raw = _raw(stage)
    one, two = new_folder(spark, "headers"), new_folder(spark, "headers")
    _deliver(raw.where("id % 2 = 0").select("id", "STUDENT_ID", "TERM", "MAJOR"), one)
    _deliver(raw.where("id % 2 = 1").select("TERM", "INTERN_IND", "id", F.col("STUDENT_ID").alias("student_id")), two)
    files = deliveries.inspect_files(spark, [one, two])
    spec = ingest.IngestSpec(columns={n: n for n in ("id", "STUDENT_ID", "TERM", "MAJOR", "INTERN_IND")})
    return ingest.read_deliveries(spark, files, spec).drop(*ingest.LINEAGE_COLUMNS)


def _cast(spark, sf_dir):
    rows = ingest.apply_casts(_raw(carrier.derived_stage(spark, sf_dir)), ingest.RAW_STAGE.casts)
    return rows.select("id", F.col("SURVEY_DATE").cast("string").alias("SURVEY_DATE"), "INTERN_IND")


def _defaulted(spark, sf_dir):
    rows = ingest.apply_defaults(_raw(carrier.derived_stage(spark, sf_dir)), ingest.RAW_STAGE.defaults)
    return rows.select("id", "INTERN_IND")


_CAST_DATE = "CAST(TRY_CAST(nullif(SURVEY_DATE, '') AS TIMESTAMP) AS VARCHAR)"
_DEFAULTED_SQL = f"CASE WHEN coalesce({duck.strip('INTERN_IND')}, '') = '' THEN 'N' ELSE INTERN_IND END"


def _lineage(spark, sf_dir):
    files = deliveries.inspect_files(spark, _delivered(spark, sf_dir))
    rows = ingest.read_deliveries(spark, files, ingest.RAW_STAGE)
    return rows.select(
        "STUDENT_ID",
        F.col("FILE_NAME").rlike(r"^[^/]+\.csv$").alias("has_file_name"),
        F.col("LOAD_TS").isNotNull().alias("has_load_ts"),
    )


def _skipped(spark, sf_dir):
    """Two folders are delivered, the first is in the ledger already: only the second is read."""
    early = deliveries.inspect_files(spark, _delivered(spark, sf_dir, _EARLY_SPARK))
    late = deliveries.inspect_files(spark, _delivered(spark, sf_dir, f"NOT ({_EARLY_SPARK})"))
    todo = ledger.files_to_load(early.unionByName(late), early.select("file_id", "fingerprint"))
    return ingest.read_deliveries(spark, todo).select(*_RAW)


def _replaced(spark, sf_dir):
    """The files of a target are delivered again with upper-cased answers: their rows are exchanged."""
    folder = _delivered(spark, sf_dir)
    files = deliveries.inspect_files(spark, folder)
    target = ingest.read_deliveries(spark, files)
    again = files.where("path LIKE '%period=second%'")
    new_rows = ingest.read_deliveries(spark, again).withColumn("MAJOR", F.upper("MAJOR"))
    return ledger.replace_files(target, new_rows, again).select(*_RAW)


def _forced(spark, sf_dir):
    files = deliveries.inspect_files(spark, _delivered(spark, sf_dir))
    todo = ledger.files_to_load(files, files.select("file_id", "fingerprint"), mode="force")
    rows = ingest.read_deliveries(spark, files)
    return rows.unionByName(ingest.read_deliveries(spark, todo)).select(*_RAW)


def _stored_loads(spark, sf_dir):
    """Early files, then early and late ones, then a forced replacement: each row ends up there once."""
    database = scratch_database(spark)
    stage, book = f"{database}.raw_stage", f"{database}.ledger"
    early = _delivered(spark, sf_dir, _EARLY_SPARK)
    late = _delivered(spark, sf_dir, f"NOT ({_EARLY_SPARK})")
    ledger.load_deliveries(spark, early, stage, book, ingest.RAW_STAGE)
    ledger.load_deliveries(spark, [early, late], stage, book, ingest.RAW_STAGE)
    ledger.load_deliveries(spark, late, stage, book, ingest.RAW_STAGE, mode="replace")
    return spark.table(stage).select(
        "STUDENT_ID", "TERM", "MAJOR", F.col("SURVEY_DATE").cast("string").alias("SURVEY_DATE"), "INTERN_IND"
    )


_STORED_SQL = (
    f"{S.rstrip()}, raw AS (SELECT {_RAW_READ} FROM stage)\n"
    f"SELECT STUDENT_ID, TERM, MAJOR, {_CAST_DATE} AS SURVEY_DATE, {_DEFAULTED_SQL} AS INTERN_IND FROM raw"
)

# ---- listings derived from orders: one file per order, one folder per customer ------------------------------------

_NAMES = (
    "'/in/' || CAST(o_custkey AS STRING) || '/Delivery_' || CASE o_orderkey % 7 WHEN 0 THEN 'final' ELSE "
    "CAST(year(o_orderdate) AS STRING) || right(CAST(year(o_orderdate) + 1 AS STRING), 2) || "
    "CASE o_orderkey % 5 WHEN 0 THEN 'SP' WHEN 1 THEN 'fa' WHEN 2 THEN 'Su' WHEN 3 THEN 'WN' ELSE 'XX' END END "
    "|| '_' || CAST(o_orderkey AS STRING) || '.csv'"
)
_HEADERS = (
    "CASE o_orderkey % 6 WHEN 0 THEN 'STUDENT_ID,TERM,Plans_Cleaned' WHEN 1 THEN 'id,FE_COLLEGE_code,pg_plan' "
    "WHEN 2 THEN 'id,PostGrad_info' WHEN 3 THEN 'wc_PG_1,' || o_orderpriority WHEN 4 THEN '' "
    "ELSE o_orderpriority || ',MAJOR' END"
)


def _listing(spark, sf_dir):
    return carrier.table(spark, sf_dir, "orders").selectExpr(
        f"{_NAMES} AS path", "o_orderdate AS modified", "o_custkey AS length", "o_custkey"
    )


_LISTING = f"listing AS (SELECT {_NAMES} AS path, o_orderdate AS modified, o_custkey AS length, o_custkey FROM orders)"


def _modified_text(df):
    return df.select("path", F.col("modified").cast("string").alias("modified"), "length")


def _guarded(spark, sf_dir):
    customers = carrier.table(spark, sf_dir, "customer").selectExpr("c_custkey AS o_custkey")
    return deliveries.guard_single(customers.join(_listing(spark, sf_dir), "o_custkey", "left"), "o_custkey")


def _classified_files(spark, sf_dir):
    """Kind of questionnaire by the header line of real files."""
    stage = _raw(carrier.derived_stage(spark, sf_dir))
    folders = {
        "UG": stage.select("id", F.col("MAJOR").alias("Plans_Cleaned")),
        "PG": stage.select("id", F.col("MAJOR").alias("wc_PostGrad_1")),
        "UNKNOWN": stage.select("id", "MAJOR"),
    }
    base = new_folder(spark, "kinds")
    for kind, rows in folders.items():
        _deliver(rows, f"{base}/group={kind}")
    files = deliveries.inspect_files(spark, [f"{base}/group={kind}" for kind in folders])
    group = F.regexp_extract("path", "group=([A-Z]+)", 1)
    found = files.select(group.alias("delivered_as"), deliveries.survey_type("header").alias("survey_type"), "lines")
    # each file has one line more than rows
    return found.groupBy("delivered_as", "survey_type").agg(F.sum(F.col("lines") - 1).alias("data_lines"))


def _missing_columns(spark, sf_dir):
    """Required columns that the headers of delivered files lack."""
    files = deliveries.inspect_files(spark, _delivered(spark, sf_dir))
    missing = deliveries.missing_from_headers(files, REQUIRED_COLUMNS)
    return missing.select(F.regexp_extract("path", "period=([a-z]+)", 1).alias("period"), "column_name").distinct()


_REQUIRED_SQL = ", ".join(f"('{name}')" for name in REQUIRED_COLUMNS)
_PRESENT_SQL = ", ".join(f"('{name}')" for name in _RAW)

_ANSWERS = [c for f in specs.INTL_EXPERIENCE for c in (f.flag, f.definition, f.other_text) if c]
_STREAM_SPEC = ingest.IngestSpec(columns={name: name for name in ("id", "student_id", "term", *_ANSWERS)})


def _picked_up(spark, sf_dir):
    """Two streaming runs over a growing folder keep the experience table in step with all deliveries."""
    database, folder, checkpoint = scratch_database(spark), new_folder(spark, "inbox"), new_folder(spark, "stream")
    stage_table = f"{database}.stage"

    def refresh(files):
        pickup.rebuild_terms(
            spark,
            stage_table,
            files,
            lambda stage: {"intl_exp": intl_exp.cleaned(stage)},
            database,
            ["intl_exp"],
            term_of=lenient_term,
        )

    for condition in (_EARLY_SPARK, f"NOT ({_EARLY_SPARK})"):
        rows = carrier.derived_stage(spark, sf_dir).where(condition).select("id", "student_id", "term", *_ANSWERS)
        _deliver(rows, folder)
        pickup.pick_up(
            spark, folder, checkpoint, stage_table, f"{database}.ledger", _STREAM_SPEC, refresh
        ).awaitTermination()
    return spark.table(f"{database}.intl_exp").select(*intl_exp.DIRECT_COLUMNS)


def _labels_picked_up(spark, sf_dir):
    """The label dimension kept by streaming runs."""
    database, folder, checkpoint = scratch_database(spark), new_folder(spark, "inbox"), new_folder(spark, "stream")
    labels = f"{database}.labels"

    def refresh(files):
        arrived = pickup.stage_of_files(spark, f"{database}.stage", files)
        existing = spark.table(labels) if spark.catalog.tableExists(labels) else None
        term_labels.additions(arrived, existing).write.mode("append").format("parquet").saveAsTable(labels)

    spec = ingest.IngestSpec(columns={"id": "id", "term": "term"})
    for condition in (_EARLY_SPARK, f"NOT ({_EARLY_SPARK})"):
        _deliver(carrier.derived_stage(spark, sf_dir).where(condition).select("id", "term"), folder)
        pickup.pick_up(spark, folder, checkpoint, f"{database}.stage", f"{database}.ledger", spec, refresh).awaitTermination()
    return spark.table(labels).select(*term_labels.COLUMNS)


def _files(spark, folder):
    """The file system and the CSV files directly in a folder, by name."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [one.getPath() for one in system.listStatus(path)]
    return system, path, sorted((one for one in found if one.getName().endswith(".csv")), key=lambda one: one.getName())


def _deliver_named(spark, rows, folder, name):
    """Writes rows as files `<name> 0.csv`, `<name> 1.csv` and so on, in place of files of these names."""
    written = new_folder(spark, "written")
    _deliver(rows, written)
    system, _, files = _files(spark, written)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system.mkdirs(target(folder))
    for number, file in enumerate(files):
        place = target(folder, f"{name} {number}.csv")
        system.delete(place, False)
        system.rename(file, place)


def _odd_names(spark, sf_dir):
    """Folder and header names with blanks, wildcards, per cent signs and backticks."""
    folder = f"{new_folder(spark, 'deliveries')}/odd [x] 100% +1"
    rows = _raw(carrier.derived_stage(spark, sf_dir)).select("id", F.col("STUDENT_ID").alias("a`b"), F.col("MAJOR").alias("what?"))
    _deliver_named(spark, rows, folder, "in %20 {a,b}")
    parent = folder.rsplit("/", 1)[0]
    read = ingest.read_deliveries(spark, deliveries.inspect_files(spark, parent))
    return read.select("id", F.col("`a``b`").alias("STUDENT_ID"), F.col("`what?`").alias("MAJOR"))


def _with_surplus(spark, sf_dir):
    """Lines of two cells under a header of two, and for every third order of three."""
    orders = carrier.table(spark, sf_dir, "orders")
    line = F.concat_ws(",", "o_orderkey", "o_orderpriority", F.when(F.col("o_orderkey") % 3 == 0, "extra"))
    folder = new_folder(spark, "deliveries")
    orders.select(line.alias("key,priority")).write.option("header", True).option("sep", "\t").csv(folder)
    return deliveries.inspect_files(spark, folder)


def _surplus(spark, sf_dir):
    found = ingest.surplus_cells(spark, _with_surplus(spark, sf_dir))
    return found.select("n_columns", F.col("n_cells").cast("int").alias("n_cells"), "record")


def _reconciled(spark, sf_dir):
    files = _with_surplus(spark, sf_dir)
    checked = ingest.reconciled(files, ingest.read_deliveries(spark, files))
    return checked.agg(F.sum("n_rows").alias("n_rows"), F.sum("data_lines").alias("data_lines"), F.bool_and("agrees").alias("agrees"))


_TWO_COLUMNS = ingest.IngestSpec(columns={"id": "id", "MAJOR": "MAJOR"})
_TWO_COLUMNS_SQL = f"{S}SELECT CAST(id AS VARCHAR) AS id, nullif(plans_other, '') AS MAJOR FROM stage"


def _two_columns(spark, sf_dir):
    return _raw(carrier.derived_stage(spark, sf_dir)).select("id", "MAJOR")


def _same_names(spark, sf_dir):
    """Files of equal names in two folders, the second folder delivered later, and a last run that finds nothing new."""
    database, inbox = scratch_database(spark), new_folder(spark, "inbox")
    tables = f"{database}.stage", f"{database}.ledger"
    for half in (0, 1):
        _deliver_named(spark, _two_columns(spark, sf_dir).where(f"id % 2 = {half}"), f"{inbox}/{half}", "part")
        ledger.load_deliveries(spark, inbox, *tables, _TWO_COLUMNS)
    ledger.load_deliveries(spark, inbox, *tables, _TWO_COLUMNS)
    return spark.table(tables[0]).select("id", "MAJOR")


def _renamed_copies(spark, sf_dir):
    """All files are copied under other names: their rows are not loaded again."""
    database, inbox = scratch_database(spark), new_folder(spark, "inbox")
    tables = f"{database}.stage", f"{database}.ledger"
    _deliver_named(spark, _two_columns(spark, sf_dir), inbox, "part")
    ledger.load_deliveries(spark, inbox, *tables, _TWO_COLUMNS, known_by="name or content")
    _deliver_named(spark, _two_columns(spark, sf_dir), inbox, "copy")
    ledger.load_deliveries(spark, inbox, *tables, _TWO_COLUMNS, known_by="name or content")
    return spark.table(tables[0]).select("id", "MAJOR")


def _late_files(spark, sf_dir):
    """The second half arrives with a time of change a month before that of the first half."""
    database, inbox = scratch_database(spark), new_folder(spark, "inbox")
    checkpoint, tables = new_folder(spark, "stream"), (f"{database}.stage", f"{database}.ledger")
    for half, name in enumerate(("new", "old")):
        _deliver_named(spark, _two_columns(spark, sf_dir).where(f"id % 2 = {half}"), inbox, name)
        system, _, files = _files(spark, inbox)
        for file in files:
            if file.getName().startswith("old"):
                system.setTimes(file, system.getFileStatus(file).getModificationTime() - 30 * 86_400_000, -1)
        pickup.pick_up(spark, inbox, checkpoint, *tables, _TWO_COLUMNS).awaitTermination()
    return spark.table(tables[0]).select("id", "MAJOR")


def _redelivered(spark, sf_dir):
    """Every file is delivered again under its name, with other answers, after the stream has seen it."""
    database, inbox = scratch_database(spark), new_folder(spark, "inbox")
    checkpoint, tables = new_folder(spark, "stream"), (f"{database}.stage", f"{database}.ledger")
    rows = _two_columns(spark, sf_dir)
    for delivered in (rows.withColumn("MAJOR", F.concat(F.lit("first "), "MAJOR")), rows):
        _deliver_named(spark, delivered, inbox, "part")
        pickup.pick_up(spark, inbox, checkpoint, *tables, _TWO_COLUMNS).awaitTermination()
        pickup.catch_up(spark, inbox, *tables, _TWO_COLUMNS)
    return spark.table(tables[0]).select("id", "MAJOR")


def _term_moved(spark, sf_dir):
    """Files that first name wrong terms for a third of their rows are delivered again with the right ones.

    The wrong terms are in the first versions only; their rows must be gone from the output.
    """
    database, inbox, checkpoint = scratch_database(spark), new_folder(spark, "inbox"), new_folder(spark, "stream")
    tables = f"{database}.stage", f"{database}.ledger"

    def refresh(files):
        build = lambda stage: {"intl_exp": intl_exp.cleaned(stage)}
        pickup.rebuild_terms(spark, tables[0], files, build, database, ["intl_exp"], term_of=lenient_term)

    rows = carrier.derived_stage(spark, sf_dir).select("id", "student_id", "term", *_ANSWERS)
    wrong = F.when(F.col("id") % 3 == 0, F.concat(F.lit("9"), F.col("id") % 5)).otherwise(F.col("term"))
    for delivered in (rows.withColumn("term", wrong), rows):
        _deliver_named(spark, delivered, inbox, "part")
        pickup.pick_up(spark, inbox, checkpoint, *tables, _STREAM_SPEC, refresh).awaitTermination()
        pickup.catch_up(spark, inbox, *tables, _STREAM_SPEC, refresh)
    return spark.table(f"{database}.intl_exp").select(*intl_exp.DIRECT_COLUMNS)


_TERM_MOVED_SQL = INTL_CLEANED_SQL.replace("FROM stage WHERE", "FROM (SELECT * REPLACE (nullif(term, '') AS term) FROM stage) WHERE")


def _streamed_surplus(spark, sf_dir):
    """Cells beyond the header, found where the stream puts them by default."""
    database, inbox, checkpoint = scratch_database(spark), new_folder(spark, "inbox"), new_folder(spark, "stream")
    orders = carrier.table(spark, sf_dir, "orders")
    line = F.concat_ws(",", "o_orderkey", "o_orderpriority", F.when(F.col("o_orderkey") % 3 == 0, "extra"))
    orders.select(line.alias("key,priority")).write.option("header", True).option("sep", "\t").csv(inbox)
    spec = ingest.IngestSpec(columns={"key": "key", "priority": "priority"})
    pickup.pick_up(spark, inbox, checkpoint, f"{database}.stage", f"{database}.ledger", spec).awaitTermination()
    found = spark.table(f"{database}.stage__surplus")
    return found.select("n_columns", F.col("n_cells").cast("int").alias("n_cells"), "record")


def _multiline(spark, sf_dir):
    """Cells and a header name with line breaks, quotes and commas."""
    folder = new_folder(spark, "deliveries")
    orders = carrier.table(spark, sf_dir, "orders")
    remark = F.concat("o_orderpriority", F.lit('\n"'), F.col("o_orderkey").cast("string"), F.lit('",\n'))
    _deliver(orders.select("o_orderkey", remark.alias("two\nlines"), F.col("o_orderpriority").alias("priority")), folder)
    files = deliveries.inspect_files(spark, folder)
    return ingest.read_deliveries(spark, files).select("o_orderkey", F.col("`two\nlines`").alias("remark"), "priority")


def _compacted(spark, sf_dir):
    """A folder a day for seven days, a ledger that is compacted every second run, and a last run that finds nothing new."""
    database, inbox = scratch_database(spark), new_folder(spark, "inbox")
    stage, book = f"{database}.stage", f"{database}.ledger"
    orders = carrier.table(spark, sf_dir, "orders").selectExpr("o_orderkey % 7 AS folder", "o_orderkey AS id")
    spec = ingest.IngestSpec(columns={"id": "id"})
    for folder in range(8):
        if folder < 7:
            _deliver(orders.where(F.col("folder") == folder).select("id").coalesce(2), f"{inbox}/day={folder}")
        ledger.load_deliveries(spark, inbox, stage, book, spec, compact_after_runs=2)
    rows = spark.table(stage).groupBy("FILE_ID", (F.col("id").cast("long") % 7).alias("folder")).agg(F.count("*").alias("n"))
    noted = rows.join(spark.table(book).select(F.col("file_id").alias("noted_id")), F.col("FILE_ID") == F.col("noted_id"), "left")
    return noted.groupBy("folder").agg(F.sum("n").alias("n_rows"), F.bool_and(F.col("noted_id").isNotNull()).alias("noted"))


def _missing_days_kept(spark, sf_dir):
    """Ranges of days that six loads extend, each with the orders of one remainder by customer."""
    table = f"{scratch_database(spark)}.days"
    orders = carrier.table(spark, sf_dir, "orders")
    for part in range(6):
        note_arrivals(spark, table, orders.where(F.col("o_custkey") % 6 == part), "o_orderdate")
    return missing_days_of(spark, table).select(F.col("missing_date").cast("string").alias("missing_date"))


_SHARED_DAYS_SQL = """WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate IS NOT NULL)
SELECT CAST(d AS VARCHAR) AS missing_date FROM (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS d FROM days)
WHERE d NOT IN (SELECT day FROM days)"""


CASES = [
    Case("csv_odd_names", "A1", _odd_names, f"{S}SELECT CAST(id AS VARCHAR) AS id, nullif(student_id, '') AS STUDENT_ID, nullif(plans_other, '') AS MAJOR FROM stage"),
    Case(
        "csv_surplus_cells",
        "A1",
        _surplus,
        "SELECT 2 AS n_columns, 3 AS n_cells, CAST(o_orderkey AS VARCHAR) || ',' || o_orderpriority || ',extra' AS record FROM orders WHERE o_orderkey % 3 = 0",
    ),
    Case("ingest_reconciled", "A1", _reconciled, "SELECT count(*) AS n_rows, count(*) AS data_lines, true AS agrees FROM orders"),
    Case("ledger_same_name_two_folders", "A7", _same_names, _TWO_COLUMNS_SQL),
    Case("ledger_renamed_copy", "A7", _renamed_copies, _TWO_COLUMNS_SQL),
    Case("streaming_late_file", "K1", _late_files, _TWO_COLUMNS_SQL),
    Case("streaming_redelivered_file", "K1", _redelivered, _TWO_COLUMNS_SQL),
    Case("csv_ingest", "A1", _ingested, f"{S}SELECT {_RAW_READ} FROM stage"),
    Case(
        "two_encodings",
        "A2",
        _two_encodings,
        "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, '“' || o_orderpriority || '”é€' AS remark FROM orders",
    ),
    Case(
        "header_mapping",
        "A3",
        _mapped,
        f"{S}SELECT student_id AS STUDENT_ID, CAST(id AS VARCHAR) AS RESPONSE_ID, plans_other AS MAJOR, CAST(NULL AS VARCHAR) AS CAMPUS FROM stage",
    ),
    Case(
        "files_with_different_headers",
        "A3",
        _mixed_headers,
        f"{S}SELECT CAST(id AS VARCHAR) AS id, student_id AS STUDENT_ID, nullif(term, '') AS TERM, "
        "CASE WHEN id % 2 = 0 THEN plans_other END AS MAJOR, "
        "CASE WHEN id % 2 = 1 THEN nullif(indicator_internship, '') END AS INTERN_IND FROM stage",
    ),
    Case(
        "declared_casts",
        "A4",
        _cast,
        f"{S.rstrip()}, raw AS (SELECT {_RAW_TEXT} FROM stage)\nSELECT id, {_CAST_DATE} AS SURVEY_DATE, INTERN_IND FROM raw",
    ),
    Case(
        "declared_defaults",
        "A5",
        _defaulted,
        f"{S.rstrip()}, raw AS (SELECT {_RAW_TEXT} FROM stage)\nSELECT id, {_DEFAULTED_SQL} AS INTERN_IND FROM raw",
    ),
    Case(
        "lineage_columns",
        "A6",
        _lineage,
        f"{S}SELECT student_id AS STUDENT_ID, true AS has_file_name, true AS has_load_ts FROM stage",
    ),
    Case("ledger_skips_known_files", "A7", _skipped, f"{S}SELECT {_RAW_READ} FROM stage WHERE NOT ({_EARLY})"),
    Case(
        "ledger_replaces_files",
        "A7",
        _replaced,
        f"{S.rstrip()}, raw AS (SELECT {_RAW_READ}, year(LOAD_UTC_DT) AS delivery FROM stage)\n"
        "SELECT * EXCLUDE (delivery) REPLACE (CASE WHEN delivery IN (1997, 1998) THEN upper(MAJOR) ELSE MAJOR END AS MAJOR) FROM raw",
    ),
    Case(
        "ledger_forced",
        "A7",
        _forced,
        f"{S}SELECT {_RAW_READ} FROM stage UNION ALL SELECT {_RAW_READ} FROM stage",
    ),
    Case("ledger_stored_loads", "A7", _stored_loads, _STORED_SQL),
    Case(
        "newest_file",
        "A8",
        lambda s, d: _modified_text(deliveries.newest(_listing(s, d))),
        f"WITH {_LISTING} SELECT path, CAST(modified AS VARCHAR) AS modified, length FROM listing ORDER BY listing.modified DESC, path DESC LIMIT 1",
    ),
    Case(
        "exactly_one_file_guard",
        "A9",
        _guarded,
        f"""WITH {_LISTING} SELECT c_custkey AS o_custkey, count(path) AS files, CASE WHEN count(path) = 1 THEN min(path) END AS path,
CASE WHEN count(path) = 0 THEN 'nothing to do' WHEN count(path) = 1 THEN 'run' ELSE 'too many files' END AS verdict
FROM customer LEFT JOIN listing ON c_custkey = o_custkey GROUP BY c_custkey""",
    ),
    Case(
        "survey_type_of_headers",
        "A10",
        lambda s, d: carrier.table(s, d, "orders")
        .selectExpr("o_orderkey", f"{_HEADERS} AS header")
        .select("o_orderkey", deliveries.survey_type("header").alias("survey_type")),
        f"""WITH headers AS (SELECT o_orderkey, lower({_HEADERS}) AS h FROM orders)
SELECT o_orderkey, CASE WHEN contains(h, 'plans_cleaned') OR contains(h, 'fe_college') OR contains(h, 'indicator_internship') THEN 'UG'
WHEN contains(h, 'wc_postgrad') OR contains(h, 'postgrad') OR contains(h, 'pg_') THEN 'PG' ELSE 'UNKNOWN' END AS survey_type FROM headers""",
    ),
    Case(
        "survey_type_of_files",
        "A10",
        _classified_files,
        duck.union_all(
            [
                f"SELECT '{k}' AS delivered_as, '{k}' AS survey_type, count(*) AS data_lines FROM orders"
                for k in ("UG", "PG", "UNKNOWN")
            ]
        ),
    ),
    Case(
        "season_from_file_name",
        "A11",
        lambda s, d: _listing(s, d).select("path", season_label("path").alias("season")),
        f"""WITH {_LISTING}, parts AS (SELECT path, regexp_extract(path, '(?i)([0-9]{{6}})(SP|FA|SU|WN)', ['y', 's']) AS m FROM listing)
SELECT path, CASE WHEN m.y <> '' THEN left(m.y, 4) || '-' || right(m.y, 2) || ' ' || CASE upper(m.s) WHEN 'SP' THEN 'Spring' WHEN 'FA' THEN 'Fall'
WHEN 'SU' THEN 'Summer' WHEN 'WN' THEN 'Winter' END END AS season FROM parts""",
    ),
    Case(
        "missing_days_of_orders",
        "A13",
        lambda s, d: quality.missing_days(carrier.table(s, d, "orders"), "o_orderdate").select(
            F.col("missing_date").cast("string").alias("missing_date")
        ),
        """WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate IS NOT NULL)
SELECT CAST(d AS VARCHAR) AS missing_date FROM (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS d FROM days)
WHERE d NOT IN (SELECT day FROM days)""",
    ),
    Case(
        "missing_days_of_shipments",
        "A13",
        lambda s, d: quality.missing_days(carrier.table(s, d, "lineitem"), "l_shipdate").select(
            F.col("missing_date").cast("string").alias("missing_date")
        ),
        """WITH days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_shipdate IS NOT NULL)
SELECT CAST(d AS VARCHAR) AS missing_date FROM (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS d FROM days)
WHERE d NOT IN (SELECT day FROM days)""",
    ),
    Case("missing_days_incremental", "A13", _missing_days_kept, _SHARED_DAYS_SQL),
    Case("csv_multiline_split", "A1", _multiline, "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority || chr(10) || '\"' || o_orderkey || '\",' || chr(10) AS remark, o_orderpriority AS priority FROM orders"),
    Case("ledger_compacted", "A7", _compacted, "SELECT o_orderkey % 7 AS folder, count(*) AS n_rows, true AS noted FROM orders GROUP BY ALL"),
    Case("streaming_redelivered_term_moved", "K1", _term_moved, _TERM_MOVED_SQL),
    Case(
        "streaming_surplus_cells",
        "K1",
        _streamed_surplus,
        "SELECT 2 AS n_columns, 3 AS n_cells, CAST(o_orderkey AS VARCHAR) || ',' || o_orderpriority || ',extra' AS record FROM orders WHERE o_orderkey % 3 = 0",
    ),
    Case(
        "missing_days_of_events",
        "A13",
        lambda s, d: quality.missing_days(carrier.table(s, d, "events"), "ts").select(
            F.col("missing_date").cast("string").alias("missing_date")
        ),
        """WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE ts IS NOT NULL)
SELECT CAST(d AS VARCHAR) AS missing_date FROM (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS d FROM days)
WHERE d NOT IN (SELECT day FROM days)""",
    ),
    Case(
        "files_in_path_order",
        "H2",
        lambda s, d: deliveries.in_path_order(_listing(s, d)).select("path"),
        f"WITH {_LISTING} SELECT path FROM listing ORDER BY path",
    ),
    Case(
        "newest_files_first",
        "H3",
        lambda s, d: _modified_text(deliveries.newest_first(_listing(s, d), 1)),
        f"WITH {_LISTING} SELECT path, CAST(modified AS VARCHAR) AS modified, length FROM listing ORDER BY listing.modified DESC, path DESC LIMIT 1",
    ),
    Case(
        "required_columns_of_deliveries",
        "I5",
        _missing_columns,
        f"""SELECT DISTINCT CASE WHEN year(o_orderdate) < 1997 THEN 'first' WHEN year(o_orderdate) < 1999 THEN 'second' ELSE 'third' END AS period,
column_name FROM orders CROSS JOIN (VALUES {_REQUIRED_SQL}) AS wanted(column_name)
WHERE lower(column_name) NOT IN (SELECT lower(p) FROM (VALUES {_PRESENT_SQL}) AS present(p))""",
    ),
    Case(
        "streaming_pickup",
        "K1",
        _picked_up,
        INTL_CLEANED_SQL.replace("FROM stage WHERE", "FROM (SELECT * REPLACE (nullif(term, '') AS term) FROM stage) WHERE"),
    ),
    Case("streaming_label_upkeep", "K1", _labels_picked_up, LABELS_SQL),
]
