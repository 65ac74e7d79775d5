"""Bucketed tickets, keyed state and row ranges of exports."""

from __future__ import annotations

import glob
import hashlib
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from deskwright.operators import listing
from deskwright.plans import load
from deskwright.plans.store import TICKET_SCHEMA, TicketStore
from deskwright.sources import synthetic
from deskwright.sources.readers import IndexedExport, read_tickets
from deskwright.streaming.first_rows import KeyState

START = datetime(2031, 1, 1, tzinfo=timezone.utc)
STATES = ["Open", "Pending", "Closed"]


def tickets(spark, rows):
    """``rows`` of (number, title, minutes)."""
    held = []
    for number, title, minutes in rows:
        values = dict.fromkeys(TICKET_SCHEMA.names)
        values |= dict(source_system="desk", ticket_id=f"SD-{number}", title=title)
        values |= dict(status=STATES[number % 3], priority="Low", updated_at=START + timedelta(minutes=minutes))
        held.append(tuple(values[n] for n in TICKET_SCHEMA.names))
    return spark.createDataFrame(held, TICKET_SCHEMA)


def publish(store, rows, number, newer_by="updated_at"):
    made = load.merge_into(
        store, store.loads(), tickets(store.spark, rows), len(rows), f"tickets/load={number}", newer_by
    )
    assert store.publish(load_number=number, run_id="test", through_batch=0, **made)
    return made


def titles(frame):
    return {r["ticket_id"]: r["title"] for r in frame.select("ticket_id", "title").collect()}


def digests(root):
    return {
        path: hashlib.sha256(open(path, "rb").read()).hexdigest()
        for path in glob.glob(f"{root}/tickets/**/*.parquet", recursive=True)
    }


def test_a_load_rewrites_only_the_buckets_that_it_changes(spark, tmp_path):
    store = TicketStore(spark, str(tmp_path))
    first = [(i, f"old {i}", i) for i in range(200)]
    made = publish(store, first, 1)
    assert (made["loaded_records"], made["rewritten"], len(made["added"])) == (200, [], made["n_buckets"])
    files, before = digests(tmp_path), store.loads()

    # newer, older, equally old and new
    made = publish(store, [(7, "newer", 500), (8, "older", 1), (9, "equal", 9), (900, "fresh", 0)], 2)
    assert made["loaded_records"] == 2 and len(made["rewritten"]) == 1 and len(made["added"]) <= 1
    assert {p: d for p, d in digests(tmp_path).items() if p in files} == files
    wanted = {f"SD-{i}": title for i, title, _ in first} | {"SD-7": "newer", "SD-900": "fresh"}
    assert titles(store.tickets()) == wanted
    # A reader of the version before sees what it saw, until its files are cleared.
    assert titles(store.tickets(before))["SD-7"] == "old 7"
    rewritten = f"tickets/load=1/bucket={made['rewritten'][0]}"
    assert store.vacuum(keep_versions=2) == [] and store.vacuum() == [rewritten]
    assert titles(store.tickets()) == wanted


def test_insert_only_loads_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(load, "MOST_PARTS", 3)
    store, wanted = TicketStore(spark, str(tmp_path)), {}
    for number in range(1, 8):
        rows = [(i, f"load {number}", number) for i in range(10 * number - 10, 10 * number + 5)]
        made = publish(store, rows, number, newer_by=None)
        wanted = {f"SD-{i}": title for i, title, _ in rows} | wanted
        assert made["loaded_records"] == (15 if number == 1 else 10)
        assert max(len(f) for f in store.parts(store.loads()).values()) <= 3
    assert titles(store.tickets()) == wanted
    assert any(r["rewritten"] for r in store.loads())
    assert store.vacuum() and titles(store.tickets()) == wanted
    live = sum(len(f) for f in store.parts(store.loads()).values())
    assert len(glob.glob(f"{tmp_path}/tickets/load=*/bucket=*")) == live


def scanned_rows(frame):
    """Rows that the scans of an executed plan have given."""
    plan = frame._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if hasattr(plan, "executedPlan") and "Adaptive" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_filters_on_stored_tickets_skip_row_groups(spark, tmp_path):
    store = TicketStore(spark, str(tmp_path))
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", "65536")
    hadoop.set("parquet.block.size.row.check.min", "100")
    hadoop.set("parquet.block.size.row.check.max", "200")
    try:
        publish(store, [(i, f"title {i} {hashlib.sha256(str(i).encode()).hexdigest()}", i) for i in range(9_000)], 1)
    finally:
        for name in ("parquet.block.size", "parquet.block.size.row.check.min", "parquet.block.size.row.check.max"):
            hadoop.unset(name)
    vectorized = spark.conf.get("spark.sql.parquet.enableVectorizedReader")
    try:
        found = listing.find_tickets(store.tickets(), "Closed").select("title")
        rows = found.collect()
        assert len(rows) == 3_000 and scanned_rows(found) < 6_000
        found = store.tickets().where("ticket_id = 'SD-77'").select("title")
        assert len(found.collect()) == 1 and scanned_rows(found) < 4_500
    finally:
        spark.conf.set("spark.sql.parquet.enableVectorizedReader", vectorized)


def claims_of(spark, rows):
    return spark.createDataFrame(rows, "ticket_key string, row_number long").repartition(3)


def test_keyed_state_equals_plain_version(spark, tmp_path):
    rng, number = random.Random(6), 0
    seen, folder, sizes = {}, str(tmp_path / "state"), []
    units = []
    for _ in range(6):
        unit = []
        for _ in range(60):
            number += 1
            unit.append(("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 150)}", number))
        units.append(unit)

    def check(state, unit, given):
        new = {}
        for key, row in unit:
            if key not in seen:
                new.setdefault(key, row)
        offset = unit[0][1] - 1
        found = {r[0]: r[1] for r in state.first_rows(claims_of(spark, given), offset).collect()}
        assert found == new
        return new

    with KeyState(spark, folder) as state:
        for unit in units[:3]:
            seen |= check(state, unit, unit)
        sizes += [p["numInputRows"] for p in state.progress() if p["numInputRows"]]
        # The next unit is delivered, but its result is lost with the driver.
        state.first_rows(claims_of(spark, units[3]), units[3][0][1] - 1)
    with KeyState(spark, folder) as state:
        for unit in units[3:]:
            seen |= check(state, unit, unit)
        assert state.first_rows(claims_of(spark, []), number).collect() == []
        sizes += [p["numInputRows"] for p in state.progress() if p["numInputRows"]]
        operators = [p["stateOperators"][0] for p in state.progress() if p["numInputRows"]]
    # Every micro-batch reads and shuffles its unit's claims, and no earlier ones.
    assert sum(sizes) == 6 * 60 and max(sizes) <= 60
    assert all(o["numRowsUpdated"] <= 60 for o in operators)
    assert max(o["numRowsTotal"] for o in operators) == len(seen)


def test_claims_of_a_unit_are_read_in_one_micro_batch(spark, tmp_path):
    """The running stream sees the files of a unit all at once, or none of them."""
    with KeyState(spark, str(tmp_path)) as state:
        state.first_rows(claims_of(spark, [("k0", 1)]), 0)
        for unit in range(1, 4):
            first = unit * 1_000
            claims = spark.range(first, first + 1_000, 1, 50).selectExpr(
                "CAST(id AS STRING) AS ticket_key", "id AS row_number"
            )
            assert state.first_rows(claims, first - 1).count() == 1_000
        assert [p["numInputRows"] for p in state.progress() if p["numInputRows"]] == [1] + [1_000] * 3


@pytest.mark.parametrize("fmt", ["csv", "jsonl", "parquet"])
def test_row_ranges_read_only_their_files(spark, tmp_path, fmt):
    path, index = f"{tmp_path}/in of it.{fmt}", f"{tmp_path}/index"
    ordered = synthetic.synthetic_rows(spark, 1_000).repartitionByRange(5, "row_number")
    ordered = ordered.sortWithinPartitions("row_number").withColumn(
        "title", F.col("row_number").cast("string")
    )
    synthetic.write_export(ordered.drop("row_number"), path, fmt)
    title = F.try_variant_get("data", "$.title", "string") if fmt == "jsonl" else F.col("data.title")

    def listed(rows):
        return sorted((r[0], int(r[1])) for r in rows.select("row_number", title).collect())

    whole = IndexedExport(spark, path, index)
    assert whole.total == 1_000
    again = IndexedExport(spark, path, index)  # from the stored index
    for after, until in ((0, 1), (150, 420), (999, 1_000), (0, 1_000)):
        rows = again.rows(after, until)
        assert listed(rows) == [(i, i) for i in range(after + 1, until + 1)]
        files = again.files(after, until)
        assert len(files) < 4 or until - after == 1_000
    assert listed(read_tickets(spark, path)) == listed(again.rows())
    if fmt == "parquet":
        assert sum(".parquet/part-" in f and "in%20of" in f for f in again.rows(0, 1).inputFiles()) == 1


def test_row_ranges_of_csv_files_with_other_headers(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("ticket_id,title\n1,one\n2,two\n", encoding="utf-8")
    (folder / "b.csv").write_text("title,ticket_id,extra\nthree,3,more\n", encoding="utf-8")
    (folder / "c.csv").write_text("ticket_id,title\n4,four\n", encoding="utf-8")
    export = IndexedExport(spark, str(folder), str(tmp_path / "index"), "csv")
    for after in range(4):
        (row,) = export.rows(after, after + 1).collect()
        assert (row["row_number"], row["data"]["ticket_id"]) == (after + 1, str(after + 1))
        assert list(row["data"].asDict()) == ["ticket_id", "title", "extra"]


def test_an_empty_export_has_no_rows(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text("", encoding="utf-8")
    export = IndexedExport(spark, str(path), str(tmp_path / "index"))
    assert export.total == 0 and export.rows().collect() == []
