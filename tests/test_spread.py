"""Work is shared out by rows, whatever row groups and files an input has."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from deskwright import run_export, run_stream
from deskwright.catalogue import queries
from deskwright.plans.store import TicketStore
from deskwright.sources import numbering
from deskwright.sources.readers import numbered_tickets, read_tickets, spread_tickets

ROWS = 4_000


@pytest.fixture
def one_row_group(spark, tmp_path):
    """A Parquet file of one row group, which small splits cut into many; all but one are empty."""
    path = str(tmp_path / "in.parquet")
    texts = [F.sha2(F.col("id").cast("string"), 256).alias(c) for c in ("ticket_id", "title")]
    spark.range(0, ROWS, 1, 1).select(*texts).write.parquet(path)
    small = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    yield path
    for name, value in before.items():
        spark.conf.set(name, value)


def sizes(rows):
    return [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]


def test_rows_of_one_row_group_are_spread(spark, one_row_group):
    bare = spark.read.parquet(one_row_group)
    cores = spark.sparkContext.defaultParallelism
    assert bare.rdd.getNumPartitions() > cores and sizes(bare) == [ROWS]
    rows = read_tickets(spark, one_row_group)
    assert max(sizes(rows)) < 2 * ROWS / cores
    given = bare.select((F.monotonically_increasing_id() % 2**33 + 1).alias("n"), "ticket_id").collect()
    found = rows.select("row_number", "data.ticket_id").collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, given))


def test_a_micro_batch_is_spread(spark, tmp_path, one_row_group, rules):
    schema, root = spark.read.parquet(one_row_group).schema, str(tmp_path / "store")
    found = run_stream(
        spark, one_row_group, rules, root, name="one", fmt="parquet", schema=schema, incremental=True
    ).first()
    store = TicketStore(spark, root)
    staged = spark.read.parquet(store.path("stage", found["run_id"], 0))
    assert found["total_records"] == ROWS
    assert len(staged.inputFiles()) >= spark.sparkContext.defaultParallelism


@pytest.fixture
def orders(spark, tmp_path):
    day = datetime(1997, 3, 1)
    rows = [(i, i % 7, "OFP"[i % 3], 1.0, day, "3-MEDIUM") for i in range(800)]
    schema = (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp, o_orderpriority string"
    )
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def test_exports_have_more_files_when_they_are_larger(spark, orders, monkeypatch):
    assert queries.in_row_order(spark, orders).rdd.getNumPartitions() == 4
    monkeypatch.setattr(queries, "FILE_ROWS", 50)
    rows = queries.in_row_order(spark, orders)
    assert rows.rdd.getNumPartitions() == 16 and max(sizes(rows)) < 200
    found = read_tickets(spark, queries._written(spark, orders, "parquet"))
    numbered = found.select("row_number", F.regexp_extract("data.description", "Order ([0-9]+)", 1))
    assert sorted(map(tuple, numbered.collect())) == [(i + 1, str(i)) for i in range(800)]
    path, files = queries._arriving(spark, orders)
    assert files == 4 and len(spark.read.parquet(path).inputFiles()) == 16


def test_tasks_that_evaluate_rows_do_not_grow_with_the_input(spark, tmp_path, monkeypatch):
    """Even splits of many rows each, which only evaluation finds too long."""
    path, cores = str(tmp_path / "in.parquet"), spark.sparkContext.defaultParallelism
    texts = [F.sha2(F.col("id").cast("string"), 256).alias(c) for c in ("ticket_id", "title")]
    spark.range(0, ROWS, 1, cores).select(*texts).write.parquet(path)
    monkeypatch.setattr(numbering, "SPREAD_ROWS", 100)
    numbered, scan = numbered_tickets(spark, path)
    assert max(sizes(numbered)) >= ROWS / cores
    assert sorted(sizes(spread_tickets(numbered, scan, "parquet"))) == sorted(sizes(numbered))
    rows = spread_tickets(numbered, scan, "parquet", bounded=True)
    assert max(sizes(rows)) <= 200
    assert sorted(map(tuple, rows.select("row_number", "data.title").collect())) == sorted(
        map(tuple, numbered.select("row_number", "data.title").collect())
    )


def test_a_run_evaluates_rows_in_bounded_tasks(spark, tmp_path, rules, monkeypatch):
    path, root = str(tmp_path / "in.parquet"), str(tmp_path / "store")
    texts = [F.sha2(F.col("id").cast("string"), 256).alias(c) for c in ("ticket_id", "title")]
    spark.range(0, ROWS, 1, spark.sparkContext.defaultParallelism).select(*texts).write.parquet(path)
    monkeypatch.setattr(numbering, "SPREAD_ROWS", 100)
    found = run_export(spark, path, rules, root).first()
    staged = spark.read.parquet(TicketStore(spark, root).path("stage", found["run_id"], 0))
    assert found["total_records"] == ROWS and len(staged.inputFiles()) == ROWS // 100
