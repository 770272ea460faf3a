"""Deliveries, ingest, ledger, sinks and the streaming pick-up on real files."""

import os

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import lenient_term
from tallyloom.operators.generations import ConflictError, Generations
from tallyloom.plans import runs, term_labels
from tallyloom.sources import deliveries, ingest, ledger, records, sinks, term_index, workspace
from tallyloom.sources.term_index import index_of
from tallyloom.streaming import pickup


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def put(folder, name, data, modified=None):
    path = folder / name
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    if modified is not None:
        os.utime(path, (modified, modified))
    return str(path)


SPEC = ingest.IngestSpec({"STUDENT_ID": "STUDENT_ID", "TERM": "TERM", "NOTE": "NOTE"}, defaults={"NOTE": "-"})


def test_encodings_headers_and_line_breaks(spark, tmp_path):
    put(tmp_path, "a.csv", 'STUDENT_ID,TERM,NOTE\n1,2235,“é”\n2,2235,"say ""hi"", twice"\n')
    put(tmp_path, "b.csv", b"term,note,student_id\n2238,\x93\xe9\x94 \x80,3\n2238,,4\n")
    put(tmp_path, "c.csv", '\ufeffSTUDENT_ID,NOTE\r\n5,"two\nlines"\r\n')
    put(tmp_path, "readme.txt", "not a delivery")
    files = deliveries.inspect_files(spark, str(tmp_path))
    seen = {row["file_name"]: (row["is_utf8"], row["has_line_breaks"]) for row in files.collect()}
    assert seen == {"a.csv": (True, False), "b.csv": (False, False), "c.csv": (True, True)}
    rows = ingest.read_deliveries(spark, files, SPEC)
    assert tuples(rows.select("STUDENT_ID", "TERM", "NOTE", "FILE_NAME")) == [
        ("1", "2235", "“é”", "a.csv"),
        ("2", "2235", 'say "hi", twice', "a.csv"),
        ("3", "2238", "“é” €", "b.csv"),
        ("4", "2238", "-", "b.csv"),
        ("5", None, "two\nlines", "c.csv"),
    ]
    assert rows.where(F.col("LOAD_TS").isNull()).count() == 0


def test_large_file_is_inspected_in_splits(spark, tmp_path):
    lines = "\n".join(f"{i},2235,text {i}" for i in range(40_000))
    put(tmp_path, "big.csv", "STUDENT_ID,TERM,NOTE\n" + lines + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        files = deliveries.inspect_files(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
        row = files.first()
        assert (row["header"], row["lines"]) == ("STUDENT_ID,TERM,NOTE", 40_001)
        assert ingest.read_deliveries(spark, files, SPEC).count() == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_newest_and_single_file(spark, tmp_path):
    assert deliveries.single_file(spark, str(tmp_path)) is None
    put(tmp_path, "b.csv", "x", modified=2_000)
    assert deliveries.single_file(spark, str(tmp_path)).endswith("b.csv")
    put(tmp_path, "a.csv", "x", modified=3_000)
    put(tmp_path, "c.txt", "x", modified=9_000)
    listing = deliveries.list_files(spark, str(tmp_path))
    assert deliveries.newest(listing).first()["file_name"] == "a.csv"
    assert [row["file_name"] for row in deliveries.newest_first(listing).collect()] == ["a.csv", "b.csv"]
    assert [row["file_name"] for row in deliveries.in_path_order(listing).collect()] == ["a.csv", "b.csv"]
    with pytest.raises(deliveries.DeliveryError, match="2 files match"):
        deliveries.single_file(spark, str(tmp_path))
    assert deliveries.newest(listing.limit(0)).count() == 0


def test_survey_type(spark):
    headers = ["id,Plans_Cleaned,pg_1", "id,PG_1", "x,WC_PostGrad", "id,TERM", "", None, "FE_College_Code"]
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(headers)], "i int, h string")
    found = [row[0] for row in rows.orderBy("i").select(deliveries.survey_type("h")).collect()]
    assert found == ["UG", "PG", "PG", "UNKNOWN", "UNKNOWN", "UNKNOWN", "UG"]


def test_missing_from_headers(spark, tmp_path):
    put(tmp_path, "a.csv", '"Student_Id", term\n1,2\n')
    files = deliveries.inspect_files(spark, str(tmp_path))
    missing = deliveries.missing_from_headers(files, ["STUDENT_ID", "TERM", "NOTE"])
    assert [row["column_name"] for row in missing.collect()] == ["NOTE"]


def test_casts_and_defaults(spark):
    rows = spark.createDataFrame([("2024-01-05", None), ("soon", " "), (None, "Y")], "SURVEY_DATE string, INTERN_IND string")
    shaped = ingest.shape(rows, ingest.RAW_STAGE)
    assert shaped.columns == list(ingest.RAW_COLUMNS)
    assert [str(row["SURVEY_DATE"]) for row in shaped.collect()] == ["2024-01-05 00:00:00", "None", "None"]
    assert [row["INTERN_IND"] for row in shaped.collect()] == ["N", "N", "Y"]


def test_ledger_modes(spark, tmp_path, database):
    stage, book = f"{database}.stage", f"{database}.ledger"

    def load(**options):
        loaded = ledger.load_deliveries(spark, str(tmp_path), stage, book, SPEC, **options)
        return sorted(row["file_name"] for row in loaded.collect())

    def stored():
        return tuples(spark.table(stage).select("STUDENT_ID", "FILE_NAME"))

    header = "STUDENT_ID,TERM,NOTE\n"
    put(tmp_path, "a.csv", header + "1,2235,x\n2,2235,x\n")
    assert load() == ["a.csv"] and load() == []
    put(tmp_path, "b.csv", header + "3,2238,x\n")
    assert load() == ["b.csv"]
    assert stored() == [("1", "a.csv"), ("2", "a.csv"), ("3", "b.csv")]
    # same name with new content: the old rows of that file go
    put(tmp_path, "a.csv", header + "9,2235,x\n")
    assert load(known_by="name") == []
    assert load() == ["a.csv"]
    assert stored() == [("3", "b.csv"), ("9", "a.csv")]
    # same content under another name
    put(tmp_path, "c.csv", header + "3,2238,x\n")
    assert load(known_by="content") == []
    assert load(mode="replace") == ["a.csv", "b.csv", "c.csv"]
    assert stored() == [("3", "b.csv"), ("3", "c.csv"), ("9", "a.csv")]
    assert load(mode="force") == ["a.csv", "b.csv", "c.csv"]
    assert len(stored()) == 6
    assert tuples(spark.table(book).groupBy("file_name").count()) == [("a.csv", 1), ("b.csv", 1), ("c.csv", 1)]


def test_redelivered_empty_file_clears_its_rows(spark, tmp_path, database):
    stage, book = f"{database}.stage", f"{database}.ledger"
    put(tmp_path, "a.csv", "STUDENT_ID,TERM,NOTE\n1,2235,x\n")
    ledger.load_deliveries(spark, str(tmp_path), stage, book, SPEC)
    put(tmp_path, "a.csv", "STUDENT_ID,TERM,NOTE\n")
    ledger.load_deliveries(spark, str(tmp_path), stage, book, SPEC)
    assert spark.table(stage).count() == 0


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(3).selectExpr("id", "id * 2 AS b", "'x' AS extra")
    planned = sinks.write(rows, path, ["b", "id"], dry_run=True)
    assert planned.columns == ["b", "id"] and not os.path.exists(path)
    sinks.write(rows, path, ["b", "id"])
    sinks.write(rows, path, ["b", "id"], truncate_before_load=False)
    assert spark.read.parquet(path).count() == 6 and spark.read.parquet(path).columns == ["b", "id"]
    sinks.full_refresh(rows.limit(0), path, ["b", "id"])
    assert spark.read.parquet(path).count() == 0
    assert sinks.sample(spark.range(100)).count() == 5
    assert sinks.jdbc_options("jdbc:x", "t", truncate=True) == {
        "url": "jdbc:x",
        "dbtable": "t",
        "batchsize": "1000",
        "truncate": "true",
    }


def test_stream_rebuilds_terms_from_all_deliveries(spark, tmp_path, database):
    inbox = tmp_path / "in"
    inbox.mkdir()
    stage, labels = f"{database}.stage", []
    spec = ingest.IngestSpec({"student_id": "student_id", "term": "term"})

    def build(rows):
        return {"people": rows.select("student_id", lenient_term("term").alias("term"))}

    def refresh(files):
        pickup.rebuild_terms(spark, stage, files, build, database, ["people"], term_of=lenient_term)
        labels.extend(tuples(term_labels.additions(pickup.stage_of_files(spark, stage, files))))

    def run():
        query = pickup.pick_up(
            spark, str(inbox), str(tmp_path / "cp"), stage, f"{database}.ledger", spec, refresh, files_per_batch=1
        )
        query.awaitTermination()
        return tuples(spark.table(f"{database}.people").select("student_id", "term"))

    put(inbox, "a.csv", "student_id,term\n1,2235\n2,215\n")
    assert run() == [("1", "2235"), ("2", "0215")]
    assert run() == [("1", "2235"), ("2", "0215")]
    # the same term in other spellings, in two more files
    put(inbox, "b.csv", "term,student_id\n 2235 ,3\n")
    put(inbox, "c.csv", "student_id,term\n4,0215\n5,2238\n")
    assert run() == [("1", "2235"), ("2", "0215"), ("3", "2235"), ("4", "0215"), ("5", "2238")]
    assert (2238, 2023, "2023") in labels


class Session:
    """Just enough of a session to ask for the shared folder."""

    def __init__(self, **settings):
        self.settings = settings
        self.conf = self
        self.sparkContext = self
        self.applicationId = f"app-{id(self)}"

    def get(self, name, default=None):
        return self.settings.get(name.replace(".", "_"), default)


def test_shared_folder_comes_from_the_session(spark):
    assert workspace.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert workspace.new_folder(spark, "x") != workspace.new_folder(spark, "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_folder(Session(spark_master="spark://host:7077"))
    local = Session(spark_master="local[2]")
    assert os.path.isdir(workspace.shared_folder(local))
    assert workspace.shared_folder(local) == workspace.shared_folder(local)


def test_failed_refresh_keeps_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.full_refresh(spark.range(3), path)
    with pytest.raises(Exception, match="no good"):
        sinks.full_refresh(spark.range(1).select(F.raise_error(F.lit("no good")).alias("id")), path)
    assert spark.read.parquet(path).count() == 3
    sinks.full_refresh(spark.read.parquet(path).where("id > 0"), path)
    assert spark.read.parquet(path).count() == 2
    assert [one.name for one in tmp_path.iterdir()] == ["table"]


def test_pick_up_takes_old_files_and_other_patterns(spark, tmp_path, database):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    spec = ingest.IngestSpec({"a": "a"})

    def run():
        tables = f"{database}.stage", f"{database}.ledger"
        pickup.pick_up(spark, str(inbox), str(tmp_path / "seen"), *tables, spec, pattern="*.txt").awaitTermination()
        return sorted(row.a for row in spark.table(f"{database}.stage").collect())

    (inbox / "new.txt").write_text("a\n1\n")
    assert run() == ["1"]
    old = inbox / "old.txt"
    old.write_text("a\n2\n")
    month_ago = old.stat().st_mtime - 30 * 86_400
    os.utime(old, (month_ago, month_ago))
    (inbox / "newer.txt").write_text("a\n3\n")
    assert run() == ["1", "2", "3"]


def test_odd_headers_and_surplus_cells(spark, tmp_path):
    put(tmp_path, "a b+%20[1].csv", 'x,X,,a`b\n1,2,3,4\n5,6,7,8,"9,9",10\n11\n')
    files = deliveries.inspect_files(spark, str(tmp_path))
    assert tuples(files.select("file_name", "lines", "data_lines")) == [("a b+%20[1].csv", 4, 3)]
    rows = ingest.read_deliveries(spark, files)
    assert rows.columns == ["x", "X_2", "_c2", "a`b", *ingest.LINEAGE_COLUMNS]
    assert tuples(rows.select("x", "X_2", "_c2", "`a``b`", "FILE_NAME")) == [
        ("1", "2", "3", "4", "a b+%20[1].csv"),
        ("11", None, None, None, "a b+%20[1].csv"),
        ("5", "6", "7", "8", "a b+%20[1].csv"),
    ]
    surplus = ingest.surplus_cells(spark, files)
    assert tuples(surplus.select("n_columns", "n_cells", "record")) == [(4, 6, '5,6,7,8,"9,9",10')]
    assert surplus.count() == 1
    assert tuples(ingest.reconciled(files, rows).select("data_lines", "n_rows", "agrees")) == [(3, 3, True)]


def test_files_are_known_by_place_and_unchanged_ones_are_not_opened(spark, tmp_path, database, monkeypatch):
    stage, book, aside = f"{database}.stage", f"{database}.ledger", f"{database}.aside"
    opened = []
    inspect = ledger.inspect_files
    monkeypatch.setattr(ledger, "inspect_files", lambda s, paths, *more: opened.append(paths) or inspect(s, paths, *more))

    def load(**options):
        loaded = ledger.load_deliveries(spark, str(tmp_path), stage, book, SPEC, surplus_table=aside, **options)
        return loaded.count()

    for folder in ("x", "y"):
        (tmp_path / folder).mkdir()
        put(tmp_path / folder, "part.csv", f"STUDENT_ID,TERM,NOTE\n{folder},2235,n,surplus\n")
        assert load() == 1
    assert load() == 0 and len(opened) == 2
    assert [len(paths) for paths in opened[1:]] == [1]
    assert tuples(spark.table(stage).select("STUDENT_ID")) == [("x",), ("y",)]
    assert tuples(spark.table(aside).select("record")) == [("x,2235,n,surplus",), ("y,2235,n,surplus",)]
    put(tmp_path, "renamed.csv", "STUDENT_ID,TERM,NOTE\nx,2235,n,surplus\n")
    assert load(known_by="name or content") == 0
    assert load() == 1
    assert spark.table(book).count() == 3


def test_root_keeps_identity_of_a_moved_inbox(spark, tmp_path):
    ids = []
    for inbox in ("here", "there"):
        (tmp_path / inbox / "x").mkdir(parents=True)
        put(tmp_path / inbox / "x", "a.csv", "STUDENT_ID\n1\n")
        folder = str(tmp_path / inbox)
        ids.append([f(spark, folder, root=root).first()["file_id"] for f in (deliveries.list_files, deliveries.inspect_files) for root in (folder, None)])
    here, there = ids
    assert here[0] == here[2] == there[0] == there[2]
    assert here[1] == here[3] != there[1]


def test_failed_refresh_of_a_table_keeps_the_old_rows(spark, database):
    table = f"{database}.kept"
    sinks.refresh_table(spark.range(3), table)
    with pytest.raises(Exception, match="no good"):
        sinks.refresh_table(spark.range(1).select(F.raise_error(F.lit("no good")).alias("id")), table)
    assert spark.table(table).count() == 3
    sinks.refresh_table(spark.table(table).where("id > 0"), table)
    assert spark.table(table).count() == 2
    assert {one.name.split("__")[0] for one in spark.catalog.listTables(database)} == {"kept", "live"}


def test_appends_of_one_token_add_nothing(spark, database):
    table = f"{database}.kept"
    for token, rows in (("a", 3), ("a", 5), ("it's", 2), ("it's", 2)):
        sinks.append_once(spark.range(rows), table, token)
    assert spark.table(table).count() == 5


def test_labels_computed_twice_before_either_is_stored(spark, database):
    stage = spark.createDataFrame([("2235",), ("2241",)], "term string")
    stored = Generations(spark, database)
    first, second = stored.begin(), stored.begin()
    for run in (first, second):
        runs._add_labels(run, stage)
    first.publish()
    with pytest.raises(ConflictError), second:
        second.publish()
    runs.store_labels(stage.union(spark.createDataFrame([("2251",)], "term string")), database)
    assert tuples(spark.table(f"{database}.{runs.LABELS}").select("term")) == [(2235,), (2241,), (2251,)]


def test_a_load_writes_only_new_ledger_files(spark, tmp_path, database):
    stage, book = f"{database}.stage", f"{database}.ledger"

    def files():
        return set(spark.table(f"{book}__log").inputFiles())

    before = set()
    for i in range(7):
        put(tmp_path, f"{i}.csv", f"STUDENT_ID,TERM,NOTE\n{i},2235,x\n")
        put(tmp_path, "again.csv", f"STUDENT_ID,TERM,NOTE\nagain{i},2235,x\n")
        ledger.load_deliveries(spark, str(tmp_path), stage, book, SPEC, compact_after_runs=3)
        now = files()
        assert len(now - before) >= 1 and (i in (5, 6) or before <= now)
        before = now
        assert spark.table(book).count() == i + 2
    assert tuples(spark.table(book).groupBy("file_name").count().where("count > 1")) == []
    assert tuples(spark.table(stage).select("STUDENT_ID")) == sorted([(str(i),) for i in range(7)] + [("again6",)])
    base = spark.table(f"{book}__log").where("kind = 'base'")
    assert base.count() > 0 and spark.table(f"{book}__log").where("kind = 'run'").select("part_run").distinct().count() < 7
    assert ledger.load_deliveries(spark, str(tmp_path), stage, book, SPEC).count() == 0


ODD_LINES = [
    "plain,line", 'a,"open', "inside", 'close",b', '"q ""x""",', '5" pipe,6" pipe', '"a"b,"c', ',"', '",', '"",""', '"""', '""""', "", '"x"",', ',,"y""', 'a"b,"c"', '  "no",x', '"', "\r",
]


def plain_records(text):
    """Records of a CSV text, a character at a time: a quote opens a cell only where the cell begins."""
    out, record, inside, begins, i = [], "", False, True, 0
    while i < len(text):
        c = text[i]
        if inside:
            if c == '"' and text[i + 1 : i + 2] == '"':
                record += '""'
                i += 2
                continue
            if c == '"':
                inside = False
        elif c == '"' and begins:
            inside = True
        elif c == "\n":
            out.append(record)
            record, begins, i = "", True, i + 1
            continue
        begins = c == "," and not inside
        record += c
        i += 1
    if inside and record.endswith("\n"):  # never closed: the end of the last line is no part of it
        record = record[:-1]
    return out + ([record] if record or inside else [])


def test_records_equal_a_plain_scan(spark, tmp_path):
    import random

    rng = random.Random(3)
    texts = []
    for i in range(40):
        lines = [rng.choice(ODD_LINES) for _ in range(rng.randrange(1, 60))]
        texts.append("head,er\n" + "\n".join(lines) + "\n")
        put(tmp_path, f"{i}.csv", texts[-1])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    for size in ("128m", "40"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            found = {}
            for row in records.records(records.lines_of(spark, [str(tmp_path)])).collect():
                found.setdefault(int(row.path.rsplit("/", 1)[1][:-4]), []).append(row.record)
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
            spark.conf.set("spark.sql.files.openCostInBytes", before[1])
        for i, text in enumerate(texts):
            wanted = [r[:-1] if r.endswith("\r") else r for r in plain_records(text)]
            assert sorted(found[i]) == sorted(wanted), (size, text)


def test_records_run_over_chunks_of_lines(spark, tmp_path, monkeypatch):
    import random

    rng = random.Random(5)
    monkeypatch.setattr(records, "CHUNK_LINES", 3)
    texts = []
    for i in range(20):
        texts.append("head,er\n" + "\n".join(rng.choice(ODD_LINES) for _ in range(rng.randrange(1, 60))) + "\n")
        put(tmp_path, f"{i}.csv", texts[-1])
    found, heads = {}, []
    for row in records.records(records.lines_of(spark, [str(tmp_path)])).collect():
        found.setdefault(int(row.path.rsplit("/", 1)[1][:-4]), []).append(row.record)
        heads += [row.record] if row.is_first else []
    for i, text in enumerate(texts):
        assert sorted(found[i]) == sorted(r[:-1] if r.endswith("\r") else r for r in plain_records(text)), text
    assert heads == ["head,er"] * 20


def test_tasks_for_lines_grow_with_the_text(spark, tmp_path, monkeypatch):
    put(tmp_path, "big.csv", "head,er\n" + 'a,"b\nc"\n' * 5000)
    monkeypatch.setattr(records, "BYTES_PER_TASK", 1000)
    paths = [str(tmp_path / "big.csv")]
    assert records.tasks_for(spark, paths) == 41
    monkeypatch.setattr(records, "CHUNK_LINES", 100)
    found = records.records(records.lines_of(spark, paths), 41)
    shares = [row["count"] for row in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(shares) == 5001 and len(shares) > 35


def test_a_large_file_with_line_breaks_is_read_by_many_tasks(spark, tmp_path):
    rows = "".join(f'{i},2235,"first {i}\n""second"", {i}\n"\n' for i in range(30_000))
    put(tmp_path, "big.csv", 'STUDENT_ID,"TE\nRM",NOTE\n' + rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        files = deliveries.inspect_files(spark, str(tmp_path))
        row = files.first()
        assert row["header"] == 'STUDENT_ID,"TE\nRM",NOTE' and row["has_line_breaks"]
        read = ingest.read_deliveries(spark, files)
        assert read.columns[:3] == ["STUDENT_ID", "TE\nRM", "NOTE"] and read.count() == 30_000
        text = read._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" in text and "FileScan csv" not in text
        wrong = read.where((F.col("`TE\nRM`") != "2235") | (F.col("NOTE") != F.concat(F.lit("first "), "STUDENT_ID", F.lit('\n"second", '), "STUDENT_ID", F.lit("\n"))))
        assert wrong.count() == 0 and read.select("STUDENT_ID").distinct().count() == 30_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_surplus_cells_are_kept_by_default(spark, tmp_path, database):
    inbox = tmp_path / "in"
    inbox.mkdir()
    tables = f"{database}.stage", f"{database}.ledger"

    def run():
        pickup.pick_up(spark, str(inbox), str(tmp_path / "cp"), *tables, SPEC).awaitTermination()

    put(inbox, "clean.csv", "STUDENT_ID,TERM,NOTE\n1,2235,x\n")
    run()
    assert not spark.catalog.tableExists(f"{database}.stage__surplus")
    put(inbox, "more.csv", 'STUDENT_ID,TERM,NOTE\n2,2235,x,y\n3,2235,"a,b"\n4,2235\n')
    put(inbox, "lines.csv", 'STUDENT_ID,TERM,NOTE\n5,2235,"x\ny",z\n6,2235,"x\n,y"\n')
    run()
    found = spark.table(f"{database}.stage__surplus").select("FILE_NAME", "n_columns", "n_cells", "record")
    assert tuples(found) == [("lines.csv", 3, 4, '5,2235,"x\ny",z'), ("more.csv", 3, 4, "2,2235,x,y")]
    put(inbox, "more.csv", "STUDENT_ID,TERM,NOTE\n2,2235,x\n")
    pickup.catch_up(spark, str(inbox), *tables, SPEC)
    assert tuples(spark.table(f"{database}.stage__surplus").select("FILE_NAME")) == [("lines.csv",)]


def test_terms_of_earlier_versions_are_rebuilt(spark, tmp_path, database):
    inbox = tmp_path / "in"
    inbox.mkdir()
    stage, book = f"{database}.stage", f"{database}.ledger"
    spec = ingest.IngestSpec({"student_id": "student_id", "term": "term"})
    out = f"{database}_out"
    spark.sql(f"CREATE DATABASE {out} LOCATION '{tmp_path}/out'")
    broken = [False]

    def build(rows):
        people = rows.select("student_id", lenient_term("term").alias("term"))
        return {"people": people.withColumn("student_id", F.raise_error(F.lit("stop")).cast("string")) if broken[0] else people}

    def load():
        return ledger.load_deliveries(spark, str(inbox), stage, book, spec)

    def rebuild(files):
        pickup.rebuild_terms(spark, stage, files, build, out, ["people"], term_of=lenient_term)
        return tuples(spark.table(f"{out}.people").select("student_id", "term"))

    put(inbox, "a.csv", "student_id,term\n1,2235\n2,2238\n")
    put(inbox, "b.csv", "student_id,term\n3, 2238 \n4,\n")
    assert rebuild(load()) == [("1", "2235"), ("2", "2238"), ("3", "2238"), ("4", None)]
    # 2235 is gone from a.csv, and so are its rows; 2238 keeps those of b.csv
    put(inbox, "a.csv", "student_id,term\n1,2241\n")
    assert rebuild(load()) == [("1", "2241"), ("3", "2238"), ("4", None)]
    # two versions come between two rebuildings, the first of which fails: no term is forgotten
    broken[0] = True
    put(inbox, "a.csv", "student_id,term\n1,2245\n")
    with pytest.raises(Exception, match="stop"):
        rebuild(load())
    broken[0] = False
    put(inbox, "a.csv", "student_id,term\n5,2251\n")
    assert rebuild(load()) == [("3", "2238"), ("4", None), ("5", "2251")]
    put(inbox, "b.csv", "student_id,term\n")
    assert rebuild(load()) == [("5", "2251")]
    entries = index_of(spark, stage).rows()
    log = index_of(spark, stage)
    assert log.compact(term_index._still_needed, after_runs=1) and log.rows().count() < entries.count()
    put(inbox, "a.csv", "student_id,term\n6,2261\n")
    assert rebuild(load()) == [("6", "2261")]


def test_rebuilding_reads_only_the_files_that_hold_the_terms(spark, tmp_path, database):
    stage, book = f"{database}.stage", f"{database}.ledger"
    spec = ingest.IngestSpec({"student_id": "student_id", "term": "term"})
    for i in range(6):
        put(tmp_path, f"{i}.csv", f"student_id,term\n{i},22{i // 2}5\n")
    files = ledger.load_deliveries(spark, str(tmp_path), stage, book, spec)
    one = files.where("file_name = '2.csv'")
    terms = term_index.touched_terms(spark, stage, one, "nobody")
    assert tuples(terms) == [("2215",)]
    rows = pickup.stage_of_terms(spark, stage, terms)
    assert tuples(rows.select("student_id")) == [("2",), ("3",)]
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part_key" in text and len(rows.inputFiles()) >= 2
    scan = [line for line in text.splitlines() if "FileScan parquet" in line and "student_id" in line]
    assert len(scan) == 1 and scan[0].split("part_key")[2:]


def test_records_over_several_lines_are_shuffled_twice_and_loaded_in_one_pass(spark, tmp_path, database, monkeypatch):
    inbox = tmp_path / "in"
    inbox.mkdir()
    text = "".join(f'{i},2235,"first, {i}\nsecond"\n' for i in range(3000))
    for name in "ab":
        put(inbox, f"{name}.csv", "STUDENT_ID,TERM,NOTE\n" + text)
    monkeypatch.setattr(records, "CHUNK_LINES", 100)
    monkeypatch.setattr(records, "BYTES_PER_TASK", 8_000)
    calls, real = [], records.records
    monkeypatch.setattr(records, "records", lambda *a: calls.append(real(*a)) or calls[-1])
    stage, book = f"{database}.stage", f"{database}.ledger"
    ledger.load_deliveries(spark, str(inbox), stage, book, SPEC)
    # the cells are read once; that no record has surplus cells was counted meanwhile
    assert len(calls) == 1 and spark.table(f"{stage}__surplus").count() == 0
    assert spark.table(stage).count() == 6000 and spark.table(stage).where("NOTE NOT LIKE 'first, %\nsecond'").isEmpty()
    # rows go from where their records were put together to the files of their table: few pieces of a file each
    assert spark.table(stage).select(F.col("_metadata.file_path")).distinct().count() < 130
    calls[0].collect()
    plan = calls[0]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    shuffled = [line for line in plan.splitlines() if " Exchange " in line and "value" in plan.splitlines()[plan.splitlines().index(line) + 1]]
    assert "ReusedExchange" in plan and plan.count("FileScan text") == 1 and len(shuffled) == 2

    # and where a record has surplus cells, the group of its file is looked at again
    put(inbox, "c.csv", "STUDENT_ID,TERM,NOTE\n" + '1,2235,"x\ny"\n2,2235,"p, q\nr",more\n')
    ledger.load_deliveries(spark, str(inbox), stage, book, SPEC)
    assert len(calls) == 3 and tuples(spark.table(f"{stage}__surplus").select("FILE_NAME", "record")) == [("c.csv", '2,2235,"p, q\nr",more')]
    # nor is there one in a file without records
    put(inbox, "d.csv", 'STUDENT_ID,TERM,"NO\nTE"\n')
    ledger.load_deliveries(spark, str(inbox), stage, book, SPEC)
    assert spark.table(stage).count() == 6002 and spark.table(f"{stage}__surplus").count() == 1


def test_rebuilding_leaves_nothing_in_the_shared_folder(spark, tmp_path, database):
    put(tmp_path, "a.csv", "STUDENT_ID,TERM,NOTE\n1,2235,x\n")
    stage, shared = f"{database}.stage", workspace.shared_folder(spark)
    files = ledger.load_deliveries(spark, str(tmp_path), stage, f"{database}.ledger", SPEC)
    before = {name for name in os.listdir(shared) if name.startswith("touched-")}
    build = lambda rows: {"people": rows.select("STUDENT_ID", F.col("TERM").alias("term"))}
    pickup.rebuild_terms(spark, stage, files, build, database, ["people"], term_of=lenient_term)
    assert tuples(spark.table(f"{database}.people")) == [("1", "2235")]
    assert {name for name in os.listdir(shared) if name.startswith("touched-")} == before
