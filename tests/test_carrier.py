"""The stage that the queries start from."""

from datetime import datetime

import pytest

from harness import carrier


@pytest.fixture()
def folder(spark, tmp_path):
    """Orders in a single file."""
    rows = [(n, n % 7, "O", 10.0 * n, datetime(1996, 1 + n % 12, 1), "1-URGENT") for n in range(1000)]
    rows += [rows[3], (None, None, None, None, None, None)]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_orders_are_dealt_to_files_that_grow_in_number(spark, folder, monkeypatch):
    monkeypatch.setattr(carrier, "ROWS_PER_FILE", 50)
    dealt = carrier.dealt_orders(spark, folder)
    sizes = [row["count"] for row in dealt.groupBy("_metadata.file_path").count().collect()]
    assert len(sizes) == 21 and max(sizes) <= 100
    assert dealt.exceptAll(carrier.table(spark, folder, "orders")).isEmpty() and dealt.count() == 1002


def test_only_named_columns_are_stored(spark, folder):
    narrow, whole = carrier.stage(spark, folder, "id", "term"), carrier.stage(spark, folder)
    assert narrow.columns == ["id", "term"] and spark.read.parquet(*narrow.inputFiles()).columns == ["id", "term"]
    assert narrow.exceptAll(whole.select("id", "term")).isEmpty() and narrow.count() == whole.count() == 1002


def test_stage_is_stored_in_shares_that_grow_in_number(spark, folder, monkeypatch):
    monkeypatch.setattr(carrier, "ROWS_PER_FILE", 50)
    for columns in ((), ("id", "term")):
        stored = carrier.stage(spark, folder, *columns)
        sizes = [row["count"] for row in stored.groupBy("_metadata.file_path").count().collect()]
        assert len(sizes) == 21 and max(sizes) <= 100 and sum(sizes) == 1002
