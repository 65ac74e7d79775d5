"""Steps of a run do their work once."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from deskwright import fixed
from deskwright.catalogue import queries
from deskwright.operators.classify import masked_payload
from deskwright.operators.merge import TICKET_KEY
from deskwright.plans import load
from deskwright.plans.batch import run_export
from deskwright.plans.store import TICKET_SCHEMA, TicketStore
from deskwright.sources import readers
from deskwright.sources.numbering import BLOCK, FILE, POSITION, number_rows


def plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_rejected_rows_mask_their_texts_once(spark):
    texts = ("t.hall@desk.example rang", "+44 20 7946 0147", None, "plain")
    rows = [(i, i % 2 == 0, texts) for i in range(4)]
    struct = ", ".join(f"{c}: string" for c in ("title", "description", "status", "priority"))
    frame = spark.createDataFrame(rows, f"row_number long, refused boolean, data struct<{struct}>")
    made = frame.select("row_number", masked_payload(frame, only=F.col("refused")).alias("raw"))
    assert plan(made).count(fixed.PHONE_MARK) == 1
    found = {r["row_number"]: r["raw"] for r in made.collect()}
    assert found[1] is None and found[3] is None and found[0] == found[2]
    masked = json.loads(found[0])
    assert masked["title"].endswith(f"{fixed.ALIAS_DOMAIN} rang")
    assert (masked["description"], masked["status"], masked["priority"]) == (fixed.PHONE_MARK, None, "plain")


def test_the_first_load_compares_with_nothing(spark, tmp_path):
    store = TicketStore(spark, str(tmp_path))
    held = []
    for number in [*range(40), None]:
        values = dict.fromkeys(TICKET_SCHEMA.names)
        values |= dict(source_system="desk", ticket_id=None if number is None else f"SD-{number}")
        held.append(tuple(values[n] for n in TICKET_SCHEMA.names))
    incoming = spark.createDataFrame(held, TICKET_SCHEMA)
    made = load.merge_into(store, [], incoming, 41, "tickets/load=1")
    assert made["loaded_records"] == 41 and not made["rewritten"]
    assert store.publish(load_number=1, run_id="test", through_batch=0, **made)
    # As before, a row without a key is counted and not stored.
    wanted = incoming.dropna(subset=TICKET_KEY).select(*TICKET_KEY).collect()
    assert sorted(store.tickets().select(*TICKET_KEY).collect()) == sorted(wanted)
    assert not store.exists(f"{tmp_path}/load_changes")


def test_exports_are_laid_out_before_their_texts_are_made(spark, tmp_path):
    rows = [(i, i % 7, "O", 1.0, datetime(1997, 3, 1), "3-MEDIUM") for i in reversed(range(100))]
    schema = (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp, o_orderpriority string"
    )
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "orders.parquet"))
    export = queries.in_row_order(spark, str(tmp_path))
    assert plan(export).index("Order issue") < plan(export).index("RepartitionByExpression")
    parts = export.groupBy(F.spark_partition_id().alias("p")).agg(
        F.collect_list("row_number").alias("n")
    )
    assert sum((r["n"] for r in parts.orderBy("p").collect()), []) == list(range(1, 101))


def test_a_query_makes_its_own_run_over_the_tables_as_they_are(spark, tmp_path):
    day, schema = datetime(1997, 3, 1), (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp, o_orderpriority string"
    )
    for n in (30, 60):
        rows = [(i, i % 7, "OFP"[i % 3], 1.0, day, "3-MEDIUM") for i in range(n)]
        orders = spark.createDataFrame(rows, schema)
        orders.write.mode("overwrite").parquet(str(tmp_path / "orders.parquet"))
        found = queries.QUERIES["run_checkpoint"](spark, str(tmp_path)).first()
        assert found["row_offset"] == n


def test_the_rows_of_splits_are_counted_in_one_scan(spark):
    scanned = spark.sparkContext.accumulator(0)

    def scan(rows):
        for row in rows:
            scanned.add(1)
            yield row

    placed = [("b", 0, 0, 6), ("a", 0, 0, 1), ("a", 0, 1, 2), ("a", 9, 7, 3), ("a", 9, 8, 4), ("a", 9, 9, 5)]
    rows = spark.sparkContext.parallelize(placed, 3).mapPartitions(scan)
    frame = spark.createDataFrame(rows, f"{FILE} string, {BLOCK} long, {POSITION} long, value long")
    numbered = number_rows(frame)
    assert scanned.value == len(placed)
    assert sorted(tuple(r) for r in numbered.collect()) == [(n, n) for n in range(1, 7)]


def test_an_attempt_finds_the_headers_of_its_files_once(spark, rules, good, tmp_path, monkeypatch):
    folder, root, searched = tmp_path / "in.csv", str(tmp_path / "store"), []
    folder.mkdir()
    for part, order in enumerate((list(good), list(good), list(good)[::-1])):
        lines = [",".join(order)]
        for n in (1, 2):
            row = {**good, "ticket_id": f"SD-{part}-{n}", "description": "none"}
            lines.append(",".join(row[c] for c in order))
        (folder / f"{part}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    found = readers.headers_of
    monkeypatch.setattr(readers, "headers_of", lambda *given: searched.append(given) or found(*given))
    # Units of three rows end inside a file; the second has files of either header.
    summary = run_export(spark, str(folder), rules, root, "csv", commit_rows=3).first()
    assert (summary["total_records"], summary["accepted_records"]) == (6, 6)
    assert len(searched) == 1
    ids = sorted(t["ticket_id"] for t in TicketStore(spark, root).tickets().collect())
    assert ids == [f"SD-{part}-{n}" for part in range(3) for n in (1, 2)]
