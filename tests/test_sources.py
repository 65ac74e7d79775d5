from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from deskwright.sources import fingerprint, synthetic
from deskwright.sources.formats import detect_format, format_of
from deskwright.sources.numbering import batch_index, number_rows, skip_rows
from deskwright.sources.readers import envelope_of, read_tickets, scan_export


@pytest.mark.parametrize(
    ("name", "expected"),
    [("a.csv", "csv"), ("a.JSONL", "jsonl"), ("b.ndjson", "jsonl"), ("dir/c.parquet/", "parquet")],
)
def test_detects_formats(name, expected):
    assert detect_format(name) == expected


def test_unknown_and_explicit_formats(spark):
    assert detect_format("input.txt", "csv") == "csv"
    with pytest.raises(ValueError, match="cannot detect"):
        detect_format("input.txt")
    with pytest.raises(ValueError, match="unknown"):
        detect_format("input.txt", "xml")
    names = spark.createDataFrame([("x/a.CSV",), ("a.txt",), ("a.parquet",)], "n string")
    assert [r[0] for r in names.select(format_of(F.col("n"))).collect()] == ["csv", None, "parquet"]


def listed(rows):
    return [r.asDict(recursive=True) for r in rows.orderBy("row_number").collect()]


def test_csv_rows(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes(
        "﻿ticket_id,title\n1,\"two\nlines, \"\"quoted\"\"\"\n\n2\n3,x,surplus\n4, padded \n".encode()
    )
    rows = listed(read_tickets(spark, str(path)))
    assert [r["row_number"] for r in rows] == [1, 2, 3, 4]
    assert rows[0]["data"] == {"ticket_id": "1", "title": 'two\nlines, "quoted"'}
    assert rows[1]["data"] == {"ticket_id": "2", "title": None}
    assert [r["read_error"] is not None for r in rows] == [False, False, True, False]
    assert rows[3]["data"]["title"] == " padded "


def test_csv_without_header_is_an_error(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("", encoding="utf-8")
    with pytest.raises(ValueError, match="no header"):
        read_tickets(spark, str(path))


def test_json_lines_keep_corrupt_lines(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    lines = ['{"ticket_id":"1"}', "not-json", "", "[1]", "null", '{"a":1,"a":2}', '{"A":1}']
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    rows = read_tickets(spark, str(path)).select(
        "row_number", "line", "read_error", F.try_variant_get("data", "$.a", "int").alias("a")
    )
    rows = listed(rows)
    assert [r["line"] for r in rows] == lines
    assert [r["read_error"] is None for r in rows] == [True, False, False, False, False, True, True]
    assert (rows[5]["a"], rows[6]["a"]) == (2, None)


@pytest.mark.parametrize("fmt", ["csv", "jsonl", "parquet"])
def test_row_numbers_are_dense_over_files_and_splits(spark, tmp_path, fmt):
    path = f"{tmp_path}/in.{fmt}"
    ordered = synthetic.synthetic_rows(spark, 5_000).repartitionByRange(3, "row_number")
    ordered = ordered.sortWithinPartitions("row_number").withColumn(
        "title", F.col("row_number").cast("string")
    )
    synthetic.write_export(ordered.drop("row_number"), path, fmt)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        rows = read_tickets(spark, path, multi_line=False)
        assert rows.rdd.getNumPartitions() > 3 or fmt == "parquet"
        title = (
            F.try_variant_get("data", "$.title", "string") if fmt == "jsonl" else F.col("data.title")
        )
        found = rows.select("row_number", title.cast("long").alias("t")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r["row_number"] for r in found) == list(range(1, 5_001))
    assert all(r["row_number"] == r["t"] for r in found)


def test_offset_and_batches(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join(json.dumps({"id": i}) for i in range(5)), encoding="utf-8")
    rows = read_tickets(spark, str(path))
    assert [r["row_number"] for r in listed(skip_rows(rows, 3))] == [4, 5]
    sizes = rows.groupBy(batch_index(F.col("row_number"), 2).alias("b")).count().orderBy("b")
    assert [r["count"] for r in sizes.collect()] == [2, 2, 1]


def identity(spark, path, fmt):
    envelope = read_tickets(spark, str(path), fmt)
    return fingerprint.input_fingerprint(spark, str(path), envelope).first()


def test_fingerprints(spark, tmp_path):
    one = tmp_path / "one.csv"
    one.write_text("a,b\n1,x\n2,y\n", encoding="utf-8")
    found = identity(spark, one, "csv")
    assert found["input_size_bytes"] == 12 and len(found["fingerprint"]) == 64
    other = tmp_path / "other.csv"
    other.write_text("a,b\n2,y\n1,x\n", encoding="utf-8")  # the same rows in another order
    assert identity(spark, other, "csv")["fingerprint"] != found["fingerprint"]
    other.write_text("a,c\n1,x\n2,y\n", encoding="utf-8")  # another name
    assert identity(spark, other, "csv")["fingerprint"] != found["fingerprint"]
    other.write_text("a,b\n1,x\n2,y\n", encoding="utf-8")
    assert identity(spark, other, "csv")["fingerprint"] == found["fingerprint"]
    rows = spark.range(100).select("id", (F.col("id") % 7).cast("string").alias("x"))
    same = fingerprint.rows_fingerprint(rows.repartition(5)).first()[0]
    assert fingerprint.rows_fingerprint(rows).first()[0] == same
    changed = rows.withColumn("x", F.when(F.col("id") == 3, "y").otherwise(F.col("x")))
    assert fingerprint.rows_fingerprint(changed).first()[0] != same
    with pytest.raises(Exception):
        identity(spark, tmp_path / "absent.csv", "csv")


def test_fingerprints_see_nulls(spark):
    schema = "a string, b string"
    left = spark.createDataFrame([(None, "v"), ("x,1:y", "z")], schema)
    right = spark.createDataFrame([("v", None), ("x", "1:y,1:z")], schema)
    found = [fingerprint.rows_fingerprint(f.limit(n)).first()[0] for f in (left, right) for n in (1, 2)]
    assert len(set(found)) == 4


def test_fingerprints_see_the_order_of_files(spark, tmp_path):
    for name, first, second in (("one", "1", "2"), ("two", "2", "1")):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.jsonl").write_text(json.dumps({"id": first}) + "\n", encoding="utf-8")
        (folder / "b.jsonl").write_text(json.dumps({"id": second}) + "\n", encoding="utf-8")
    one, two = (identity(spark, tmp_path / n, "jsonl")["fingerprint"] for n in ("one", "two"))
    assert one != two


def test_csv_folder_is_read_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ticket_id,title\n1,one\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("title,ticket_id,extra\ntwo,2,more\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text("ticket_id,title\n3,three,surplus\n", encoding="utf-8")
    rows = read_tickets(spark, str(tmp_path), "csv").orderBy("row_number").collect()
    assert [tuple(r["data"]) for r in rows] == [
        ("1", "one", None), ("2", "two", "more"), ("3", "three", None),
    ]
    assert [r["read_error"] is None for r in rows] == [True, True, False]


def test_synthetic_rows_are_a_function_of_seed_and_index(spark):
    rows = synthetic.synthetic_rows(spark, 400, invalid_rate=0.5, duplicate_rate=0.2)
    again = synthetic.synthetic_rows(spark, 400, invalid_rate=0.5, duplicate_rate=0.2)
    assert listed(rows) == listed(again.repartition(3))
    other = synthetic.synthetic_rows(spark, 400, seed=1, invalid_rate=0.5, duplicate_rate=0.2)
    assert listed(other) != listed(rows)
    found = listed(rows)
    assert all(r["requester_email"].endswith("@example.invalid") for r in found)
    assert 0.1 < sum(r["ticket_id"] != f"SD-{i:09d}" for i, r in enumerate(found)) / 400 < 0.3
    assert {r["row_number"] % 4 for r in found if r["title"] == ""} == {1}
    with pytest.raises(ValueError):
        synthetic.write_export(rows, "unused", "xml")


def test_envelope_of_a_numbered_table(spark):
    rows = envelope_of(spark.range(3).select((F.col("id") + 1).alias("row_number"), "id"))
    assert listed(rows)[0] == {"row_number": 1, "data": {"id": 0}, "read_error": None}


def test_manifest_fingerprint_follows_the_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a\n1\n", encoding="utf-8")
    first = fingerprint.manifest_fingerprint(spark, str(tmp_path)).first()
    assert first["input_size_bytes"] == 4
    assert fingerprint.manifest_fingerprint(spark, str(tmp_path)).first() == first
    (tmp_path / "b.csv").write_text("a\n2\n", encoding="utf-8")
    assert fingerprint.manifest_fingerprint(spark, str(tmp_path)).first() != first


def test_numbering_does_not_move_rows(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"id":1}\n{"id":2}\n', encoding="utf-8")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        rows = number_rows(scan_export(spark, str(tmp_path / "in.jsonl")))
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
