"""Unpivots, lookups, quality checks and upkeep on small hand-made frames."""

import datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import lookup as lk
from tallyloom.operators import quality, sets, upkeep
from tallyloom.operators.conditions import any_not_blank
from tallyloom.operators.generations import AuditError, Check, ConflictError, Generations
from tallyloom.operators.unpivot import FlagColumn, unpivot_evidenced, unpivot_groups, unpivot_selected


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


FLAGS = [
    FlagColumn("a", "A", code=1, slot=1, definition="a_def"),
    FlagColumn("b", "B", code=2, slot=1),
    FlagColumn("c", "C", code=99, slot=2, other_text="c_text"),
]


def test_unpivot_selected(spark):
    rows = spark.createDataFrame(
        [
            (1, 2, "Y", " Alpha ", "no", "x", " free "),
            (2, 1, "N", "Alpha", "1", "Y", None),
            (3, None, "Y", None, None, "Y", None),
            (4, 2, None, "Alpha", None, None, "text without tick"),
        ],
        "id int, n int, a string, a_def string, b string, c string, c_text string",
    )
    assert tuples(unpivot_selected(rows, FLAGS, ["id"])) == [
        (1, 1, 1, "Alpha"),
        (1, 2, 99, "C: free"),
        (2, 1, 2, "B"),
        (2, 2, 99, "C"),
        (3, 1, 1, "A"),
        (3, 2, 99, "C"),
    ]
    counted = unpivot_selected(rows, FLAGS, ["id"], count="n")
    assert tuples(counted) == [(1, 1, 1, "Alpha"), (1, 2, 99, "C: free"), (2, 1, 2, "B")]


def test_unpivot_row_count_is_number_of_ticks(spark):
    rows = spark.range(2000).select(
        "id", *[F.when(F.hash("id", F.lit(i)) % 3 == 0, "Y").alias(f"f{i}") for i in range(20)]
    )
    flags = [FlagColumn(f"f{i}", f"L{i}", code=i) for i in range(20)]
    ticks = rows.select(sum(F.when(F.col(f.flag) == "Y", 1).otherwise(0) for f in flags).alias("n")).agg(F.sum("n"))
    assert unpivot_selected(rows, flags, ["id"]).count() == ticks.first()[0]


def test_unpivot_evidenced_takes_definition_alone(spark):
    rows = spark.createDataFrame(
        [(1, "Y", None), (2, "N", ""), (3, None, "text"), (4, "y", None)], "id int, a string, a_def string"
    )
    assert tuples(unpivot_evidenced(rows, [FLAGS[0]], ["id"])) == [(1, "A"), (2, "A"), (3, "A")]


def test_unpivot_groups_keeps_empty_slots(spark):
    rows = spark.createDataFrame([(1, "x", None, " ", "")], "id int, p1 string, p2 string, q1 string, q2 string")
    slots = unpivot_groups(rows, {1: {"p": "p1", "q": "q1"}, 2: {"p": "p2", "q": "q2"}}, ["id"])
    assert tuples(slots) == [(1, 1, "x", " "), (1, 2, None, "")]
    assert tuples(slots.where(any_not_blank(["p", "q"]))) == [(1, 1, "x", " ")]


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one key and a third have none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50))
    return spark.range(3000).select("id", key.alias("key"))


@pytest.fixture(scope="module")
def names(spark):
    rows = [("hot", "one"), ("hot", "two"), (None, "never")] + [(f"k{i}", f"n{i}") for i in range(0, 50, 2)]
    return lk.Lookup(spark.createDataFrame(rows, "k string, n string"), "k", {"name": "n"})


def test_shuffled_lookup_equals_broadcast(hot, names):
    broadcast = lk.lookup_join(hot, names, "key")
    shuffled = lk.lookup_join(hot, names, "key", broadcast_limit=-1, salt_by=["id"])
    assert "BroadcastHashJoin" in plan(broadcast) and "BroadcastHashJoin" not in first_plan(shuffled)
    assert tuples(broadcast) == tuples(shuffled)
    # every row is kept, and the key listed twice gives two rows
    assert broadcast.count() == 3000 + 1000
    assert broadcast.where("name = 'never'").count() == 0


def test_salt_spreads_the_hot_key_and_the_nulls(hot, spark):
    salt = F.pmod(F.xxhash64("id"), F.lit(lk.SALTS))
    per_salt = hot.groupBy("key", salt.alias("salt")).count()
    largest = per_salt.groupBy("key").agg(F.max("count").alias("n")).where("key = 'hot' OR key IS NULL").collect()
    assert all(row["n"] < 50 for row in largest)


def test_size_is_measured(spark):
    lookup = lk.Lookup(spark.range(1000).selectExpr("id k", "repeat('x', 100) v"), "k", {"v2": "v"})
    lk.measure(lookup)
    assert 100_000 < lookup.measured_bytes < 300_000
    empty = lk.Lookup(spark.range(0).selectExpr("id k", "'x' v"), "k", {"v2": "v"})
    lk.measure(empty)
    assert empty.measured_bytes == 0


@pytest.mark.parametrize("null_safe", [False, True])
def test_exclude_and_restrict_both_ways(hot, spark, null_safe):
    known = spark.createDataFrame([("hot",), ("k1",), (None,)], "known string")
    for join, nulls in ((lk.exclude, 0 if null_safe else 1000), (lk.restrict, 1000 if null_safe else 0)):
        small = join(hot, known, [("key", "known")], null_safe)
        large = join(hot, known, [("key", "known")], null_safe, broadcast_limit=-1, salt_by=["id"])
        assert tuples(small) == tuples(large)
        assert small.where("key IS NULL").count() == nulls


def test_only_the_rows_of_frequent_keys_are_repeated(hot, spark):
    sketch = lk.sketch_keys(hot, ["key"], share=0.1)[0]
    assert len(sketch.hot) == 1 and sketch.null_share == pytest.approx(1 / 3, abs=0.01)
    other = spark.createDataFrame([("hot", 1), ("hot", 2), (None, 3)] + [(f"k{i}", i) for i in range(1000)], "k string, v int")
    copies = lk.repeated(other, ["k"], sketch.hot)
    assert copies.count() == other.count() + 2 * (lk.SALTS - 1)
    joined = lk.spread_join(hot, other, [("key", "k")], "left", salt_by=["id"], sketch=sketch)
    text = plan(joined)
    assert "BroadcastHashJoin" not in text and "isnotnull(" in text
    # the rows without a key are read apart: the union has a branch without an exchange
    assert joined.count() == 2000 + 1000 + 1000 and "Union" in text
    no_hot = lk.spread_join(hot, other, [("key", "k")], "left", sketch=lk.KeySketch())
    assert "Generate" not in plan(no_hot) and no_hot.count() == joined.count()
    many = hot.withColumn("key", F.concat(F.lit("k"), F.col("id")))
    assert lk.sketch_keys(many, ["key"])[0] == lk.KeySketch((), 0.0)
    assert lk.sketch_keys(hot.limit(0), ["key"])[0] == lk.KeySketch((), 0.0)


def test_missing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "Student_ID int, b int")
    assert tuples(quality.missing_columns(df, ["student_id", "TERM", "B"])) == [("TERM",)]
    assert quality.has_columns(df, ["STUDENT_ID"]) and not quality.has_columns(df, ["x"])


def test_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "term string")
    assert tuples(quality.row_counts({"t": df, "e": df.limit(0)})) == [("e", 0), ("t", 4)]
    assert quality.distinct_count(df, "term", "n").first()["n"] == 2
    assert tuples(sets.distinct_values(df, "term")) == [("a",), ("b",)]


def test_watch_counts_while_writing(spark):
    df = spark.createDataFrame([(" ",), ("1",)], "student_id string")
    watched, counts = quality.watch(df, rows=F.count(F.lit(1)), blank=F.count_if(F.trim("student_id") == ""))
    watched.write.format("noop").mode("overwrite").save()
    assert counts.get == {"rows": 2, "blank": 1}


def test_missing_days(spark):
    day = datetime.date
    arrivals = spark.createDataFrame([(day(2024, 2, 27),), (day(2024, 3, 2),), (day(2024, 3, 2),), (None,)], "d date")
    assert [row[0] for row in quality.missing_days(arrivals, "d").orderBy("missing_date").collect()] == [
        day(2024, 2, 28),
        day(2024, 2, 29),
        day(2024, 3, 1),
    ]
    assert quality.missing_days(arrivals.where("d IS NULL"), "d").count() == 0


FACTS = "stud_id string, term string"


def test_replace_by_key(spark):
    target = spark.createDataFrame([("1", "A"), ("2", "B"), ("3", None), ("4", "C")], FACTS)
    stage = spark.createDataFrame([("A",), ("B",), (None,)], "term string")
    new = spark.createDataFrame([("9", "A"), ("8", None)], FACTS)
    replaced = upkeep.replace_by_key(target, stage, new)
    # B had no new rows and is cleared, C is not in the stage
    assert tuples(replaced) == [("4", "C"), ("8", None), ("9", "A")]
    assert tuples(upkeep.replace_by_key(replaced, stage, new)) == tuples(replaced)
    kept_null = upkeep.replace_by_key(target, stage, new, include_null_key=False)
    assert tuples(kept_null) == [("3", None), ("4", "C"), ("8", None), ("9", "A")]


def test_replace_partitions(spark, database):
    table = f"{database}.facts"
    target = spark.createDataFrame([("1", "A"), ("2", "it's"), ("3", None), ("4", "C"), ("5", ""), ("6", "a\\b")], FACTS)
    upkeep.create_partitioned_table(target, table)
    upkeep.replace_partitions(table, target.select("term"), target)
    assert tuples(spark.table(table).drop("part_key")) == tuples(target)
    stage = spark.createDataFrame([("A",), ("it's",), (None,), ("",), ("a\\b",)], "term string")
    new = spark.createDataFrame([("9", "A"), ("8", None), ("7", "")], FACTS)
    for _ in range(2):
        upkeep.replace_partitions(table, stage, new)
        assert tuples(spark.table(table).drop("part_key")) == [("4", "C"), ("7", ""), ("8", None), ("9", "A")]


def test_failing_rows_leave_the_table_alone(spark, database):
    table = f"{database}.facts"
    target = spark.createDataFrame([("1", "A")], FACTS)
    upkeep.create_partitioned_table(target, table)
    upkeep.replace_partitions(table, target, target)
    failing = target.withColumn("stud_id", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        upkeep.replace_partitions(table, target, failing)
    assert tuples(spark.table(table).drop("part_key")) == [("1", "A")]


def test_replace_partitions_refuses_external_tables(spark, database, tmp_path):
    target = spark.createDataFrame([("1", "A")], FACTS)
    keyed = upkeep.with_partition_key(target)
    keyed.write.partitionBy("part_key").option("path", str(tmp_path / "t")).saveAsTable(f"{database}.outside")
    with pytest.raises(ValueError, match="not a managed table"):
        upkeep.replace_partitions(f"{database}.outside", target, target)


def read_all(spark, database, *names):
    return {name: tuples(spark.table(f"{database}.{name}")) for name in names}


def test_readers_see_all_old_rows_or_all_new_ones(spark, database):
    stored = Generations(spark, database)
    old = {"facts": spark.createDataFrame([("1", "A"), ("2", "B"), ("3", None), ("4", "it's"), ("5", "")], FACTS), "more": spark.createDataFrame([("1", "A")], FACTS)}
    with stored.begin() as run:
        for name, rows in old.items():
            run.write(name, rows)
        run.publish()
    before = read_all(spark, database, *old)
    assert before == {name: tuples(rows) for name, rows in old.items()}
    lasting = spark.table(f"{database}.facts")
    keys = spark.createDataFrame([("A",), (None,), ("it's",), ("",)], "term string")
    new = {"facts": [("9", "A"), ("8", None)], "more": []}
    with stored.begin() as run:
        for name, rows in new.items():
            run.write(name, spark.createDataFrame(rows, FACTS))
            assert read_all(spark, database, *old) == before
            run.replace(name, keys)
            assert read_all(spark, database, *old) == before
        run.publish()
    assert read_all(spark, database, *old) == {"facts": [("2", "B"), ("8", None), ("9", "A")], "more": []}
    # whoever planned before the switch still reads what was there
    assert tuples(lasting) == before["facts"]
    assert tuples(stored.row_counts(["facts", "more", "none"])) == [("facts", 3), ("more", 0), ("none", 0)]
    text = plan(spark.table(f"{database}.facts"))
    assert "dynamicpruning" in text and text.count("FileScan parquet") >= 2


def test_rows_are_written_once_and_dead_generations_go(spark, database):
    stored = Generations(spark, database)
    for i in range(5):
        with stored.begin() as run:
            run.write("facts", spark.createDataFrame([(str(i), "A"), (str(i), f"only{i}")], FACTS))
            run.refresh("facts")
            run.publish()
        assert tuples(spark.table(f"{database}.facts")) == [(str(i), "A"), (str(i), f"only{i}")]
    kept = {row.generation for row in spark.table(f"{database}.facts__rows").select("generation").distinct().collect()}
    assert len(kept) == 3 and stored.current() in kept
    manifests = [t.name for t in spark.catalog.listTables(database) if t.name.startswith("live__")]
    assert len(manifests) == 3
    stored.clean(keep=0)
    assert spark.table(f"{database}.facts__rows").select("generation").distinct().count() == 1
    assert spark.table(f"{database}.facts").count() == 2


def test_failed_and_refused_runs_change_nothing(spark, database):
    stored = Generations(spark, database)
    with stored.begin() as run:
        run.write("facts", spark.createDataFrame([("1", "A")], FACTS))
        run.publish()
    broken = spark.createDataFrame([("1", "A")], FACTS).withColumn("stud_id", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"), stored.begin() as run:
        run.write("other", spark.createDataFrame([("7", "A")], FACTS))
        run.write("facts", broken)
    too_few = Check(lambda metrics: metrics["facts"]["rows"] > 1 and metrics["facts"]["no_id"] == 0, "too few rows")
    with pytest.raises(AuditError, match="too few rows"), stored.begin() as run:
        run.write("facts", spark.createDataFrame([("2", "A")], FACTS), no_id=F.count_if(F.col("stud_id").isNull()))
        run.refresh("facts")
        run.publish([too_few])
    assert run.metrics == {"facts": {"rows": 1, "no_id": 0}}
    assert read_all(spark, database, "facts", "other") == {"facts": [("1", "A")], "other": []}
    assert spark.table(f"{database}.facts__rows").count() == 1 and spark.table(f"{database}.other__rows").count() == 0


def test_two_runs_at_once(spark, database):
    stored = Generations(spark, database)
    first, second = stored.begin(), stored.begin()
    for run, who in ((first, "1"), (second, "2")):
        run.write("facts", spark.createDataFrame([(who, "A")], FACTS))
    first.publish()
    with pytest.raises(ConflictError), second:
        second.publish()
    assert tuples(spark.table(f"{database}.facts")) == [("1", "A")]
    assert spark.table(f"{database}.facts__rows").count() == 1


def test_ranges_of_days(spark):
    day = datetime.date
    given = [day(2024, 1, d) for d in (1, 2, 3, 7, 9, 10)] + [day(2024, 2, 1), None, day(2024, 1, 2)]
    arrivals = spark.createDataFrame([(d,) for d in given], "d date")
    ranges = quality.day_ranges(arrivals, "d")
    assert tuples(ranges) == sorted([(day(2024, 1, 1), day(2024, 1, 3)), (day(2024, 1, 7), day(2024, 1, 7)), (day(2024, 1, 9), day(2024, 1, 10)), (day(2024, 2, 1), day(2024, 2, 1))], key=str)
    assert tuples(quality.days_between(ranges)) == tuples(quality.missing_days(arrivals, "d"))
    wide = spark.createDataFrame([(day(2024, 1, 1), day(2024, 1, 20)), (day(2024, 1, 4), day(2024, 1, 5)), (day(2024, 1, 21), day(2024, 1, 21))], "first date, last date")
    assert tuples(quality.merged_ranges(wide)) == [(day(2024, 1, 1), day(2024, 1, 21))]
    assert quality.day_ranges(arrivals.where("d IS NULL"), "d").count() == 0


def test_term_labels(spark):
    stage = spark.createDataFrame([("2235",), (" 2235 ",), ("02241",), ("ABCD",), (None,), ("  ",), ("2231",)], "term string")
    existing = spark.createDataFrame([(2235, 1999, "kept")], "term int, acad_year int, report_label string")
    added = upkeep.new_term_labels(stage, existing)
    assert tuples(added) == [(2231, 2022, "2022"), (2241, 2023, "2023")]
    full = upkeep.maintain_term_labels(stage, existing)
    assert tuples(full) == [(2231, 2022, "2022"), (2235, 1999, "kept"), (2241, 2023, "2023")]
    assert upkeep.new_term_labels(stage, full).count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def first_plan(df):
    """The plan before adaptive execution looks at run-time sizes."""
    return plan(df)
