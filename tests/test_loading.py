from __future__ import annotations

import dataclasses
import glob
import json
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from deskwright import run_export, run_stream
from deskwright.operators import listing, merge, scoring
from deskwright.plans.load import run_summary
from deskwright.plans.store import TicketStore
from deskwright.rules import QualityRules
from deskwright.sources import synthetic
from test_rules import DOCUMENT

COUNTS = [
    "total_records", "accepted_records", "quarantined_records", "duplicate_records",
    "loaded_records", "unchanged_records", "quality_dimensions", "quality_score",
]


class Stop(RuntimeError):
    pass


def stop_after(commits):
    def check(done):
        if done >= commits:
            raise Stop("stopped on purpose")

    return check


def write_lines(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows), encoding="utf-8")
    return str(path)


def test_merge_actions(spark):
    schema = "source_system string, ticket_id string, title string, updated_at int"
    old = spark.createDataFrame(
        [("s", "1", "a", 5), ("s", "2", "b", 5), ("s", "3", "c", 5), ("s", "4", "d", 5)], schema
    )
    new = spark.createDataFrame(
        [("s", "1", "A", 6), ("s", "2", "B", 5), ("s", "3", "C", 4), ("t", "4", "D", 9)], schema
    )
    rows = merge.merge_actions(old, new).orderBy("source_system", "ticket_id").collect()
    assert [(r["title"], r["action"]) for r in rows] == [
        ("A", "update"), ("b", "unchanged"), ("c", "unchanged"), ("d", "kept"), ("D", "insert"),
    ]
    assert merge.load_counts(merge.merge_actions(old, new)).first().asDict() == {
        "loaded_records": 2,
        "unchanged_records": 2,
    }
    frozen = merge.merge_actions(old, new, newer_by=None)
    assert frozen.where("action = 'update'").isEmpty()
    assert merge.insert_if_absent(old, new, merge.TICKET_KEY).count() == 1


def test_rerun_returns_the_stored_summary(spark, rules, good, tmp_path):
    path = write_lines(tmp_path / "in.jsonl", [{**good, "ticket_id": f"SD-{i}"} for i in range(8)])
    root = str(tmp_path / "store")
    first = run_export(spark, path, rules, root).first()
    store = TicketStore(spark, root)
    events = store.read("runs").count()
    report = glob.glob(f"{root}/reports/{first['run_id']}/markdown/part-*")
    assert "Completeness | 100.00%" in open(report[0], encoding="utf-8").read()
    again = run_export(spark, path, rules, root).first()
    assert again == first and first["status"] == "COMPLETED"
    assert first["total_records"] == first["loaded_records"] == 8
    assert store.tickets().count() == 8 and store.read("runs").count() == events
    assert store.read("lineage").count() == 1


def test_resume_after_a_failure(spark, rules, tmp_path):
    path, root = str(tmp_path / "in.csv"), str(tmp_path / "store")
    rows = synthetic.synthetic_rows(spark, 7, invalid_rate=0.0, duplicate_rate=0.5)
    synthetic.write_export(rows.coalesce(1).drop("row_number"), path, "csv")
    with pytest.raises(Stop):
        run_export(spark, path, rules, root, commit_rows=2, on_commit=stop_after(1))
    store = TicketStore(spark, root)
    assert store.run_states().first()["status"] == "FAILED"
    assert "on purpose" in store.run_states().first()["error_message"]
    done = run_export(spark, path, rules, root, commit_rows=2).first()
    assert (done["status"], done["total_records"], done["batches_committed"]) == ("COMPLETED", 7, 4)
    assert done["resumed_from_offset"] == 7
    whole = run_export(spark, path, rules, str(tmp_path / "other")).first()
    assert [done[c] for c in COUNTS] == [whole[c] for c in COUNTS]


def test_resume_with_other_commit_sizes(spark, rules, tmp_path):
    """Begun with commits of some size, continued with another and without: all rows are there."""
    path, root = str(tmp_path / "in.csv"), str(tmp_path / "store")
    rows = synthetic.synthetic_rows(spark, 9, invalid_rate=0.0, duplicate_rate=0.5)
    synthetic.write_export(rows.coalesce(1).drop("row_number"), path, "csv")
    for size in (2, 3):
        with pytest.raises(Stop):
            run_export(spark, path, rules, root, commit_rows=size, on_commit=stop_after(1))
    done = run_export(spark, path, rules, root).first()
    assert (done["status"], done["total_records"]) == ("COMPLETED", 9)
    whole = run_export(spark, path, rules, str(tmp_path / "other")).first()
    assert [done[c] for c in COUNTS] == [whole[c] for c in COUNTS]


@pytest.mark.parametrize("incremental", [True, False])
def test_loads_at_the_same_time(spark, rules, good, tmp_path, monkeypatch, incremental):
    """Another run publishes between a load's merge and its record: neither is lost or doubled."""
    root = str(tmp_path / "store")
    both = {**good, "ticket_id": "SD-2"}
    first = write_lines(tmp_path / "a.jsonl", [good, both])
    second = write_lines(tmp_path / "b.jsonl", [both, {**good, "ticket_id": "SD-3"}])
    publish, inside = TicketStore.publish, []

    def late(store, **load):
        if not inside:
            inside.append(True)
            run_export(spark, second, rules, root, incremental=incremental)
        return publish(store, **load)

    monkeypatch.setattr(TicketStore, "publish", late)
    summary = run_export(spark, first, rules, root, incremental=incremental).first()
    assert (summary["loaded_records"], summary["unchanged_records"]) == (1, 1)
    stored = TicketStore(spark, root)
    assert sorted(t["ticket_id"] for t in stored.tickets().collect()) == ["SD-1", "SD-2", "SD-3"]
    assert [x["load_number"] for x in stored.loads()] == [1, 2]


def test_summary_uses_the_rules_of_each_run(spark, rules, good, tmp_path):
    root = str(tmp_path / "store")
    path = write_lines(tmp_path / "a.jsonl", [{**good, "title": ""}])
    fewer = dataclasses.replace(rules, required_fields=("ticket_id", "title"), quality_threshold=0.1)
    for own in (rules, fewer):
        run_export(spark, path, own, root, dry_run=True)
    found = run_summary(TicketStore(spark, root)).orderBy("quality_threshold").collect()
    assert [r["quality_dimensions"]["completeness"] for r in found] == [0.5, 0.8]
    assert [r["quality_threshold"] for r in found] == [0.1, 0.7]


def test_stream_updates_tickets(spark, rules, good, tmp_path):
    """In a newer-wins stream a later file's newer row updates a ticket, an older one does not."""
    folder, root = tmp_path / "in", str(tmp_path / "store")
    folder.mkdir()
    options = dict(name="feed", fmt="jsonl", files_per_batch=1, incremental=True)
    titles = []
    for name, minute in (("a", "05"), ("b", "09"), ("c", "07")):
        row = {**good, "title": f"Title of {name}", "updated_at": f"2031-07-14T10:{minute}:00Z"}
        write_lines(folder / f"{name}.jsonl", [row])
        summary = run_stream(spark, str(folder), rules, root, **options).first()
        titles += [t["title"] for t in TicketStore(spark, root).tickets().collect()]
    assert titles == ["Title of a", "Title of b", "Title of b"]
    assert (summary["accepted_records"], summary["duplicate_records"]) == (3, 0)
    assert (summary["loaded_records"], summary["unchanged_records"]) == (2, 1)


def test_stream_refuses_another_header(spark, rules, good, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    columns = list(good)
    for name, order in (("a", columns), ("b", columns[::-1])):
        lines = [",".join(order), ",".join(good[c].replace(",", "") for c in order)]
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    with pytest.raises(Exception, match="header"):
        run_stream(spark, str(folder), rules, str(tmp_path / "store"), name="feed", fmt="csv")


def test_dry_run_writes_no_business_tables(spark, rules, good, tmp_path):
    rows = [{**good, "ticket_id": f"SD-{i}"} for i in range(5)] + [{**good, "status": "?"}]
    path, root = write_lines(tmp_path / "in.jsonl", rows), str(tmp_path / "store")
    summary = run_export(spark, path, rules, root, dry_run=True).first()
    assert (summary["accepted_records"], summary["loaded_records"]) == (5, 0)
    store = TicketStore(spark, root)
    assert store.tickets().isEmpty() and store.read("quarantine").isEmpty()
    assert store.read("quality_metrics").count() == 5


def test_counters_of_the_writing_pass_are_checked(spark, rules, good, tmp_path, monkeypatch):
    """Counters that a repeated task has spoiled are taken again; others are not."""
    rows = [{**good, "ticket_id": f"SD-{i % 4}", "status": "?" if i > 6 else "Open"} for i in range(9)]
    path, found, passes = write_lines(tmp_path / "in.jsonl", rows), [], []
    measure, get = scoring.measure, scoring.Observation.get
    monkeypatch.setattr(scoring, "measure", lambda *a: passes.append(1) or measure(*a))
    for times in (1, 2):
        spoiled = property(lambda self: {k: times * v for k, v in get.fget(self).items()})
        monkeypatch.setattr(scoring.Observation, "get", spoiled)
        summary = run_export(spark, path, rules, str(tmp_path / f"store{times}")).first()
        found.append([summary[c] for c in COUNTS])
        assert len(passes) == times - 1
    assert found[0] == found[1] and found[0][:4] == [9, 4, 5, 3]


def test_incremental_load_takes_only_newer_rows(spark, rules, good, tmp_path):
    root = str(tmp_path / "store")
    newer = {**good, "title": "Newer title", "updated_at": "2031-07-15T11:00:00Z"}
    older = {**good, "title": "Older title", "updated_at": "2031-07-14T10:01:00Z"}
    loads = []
    for name, row in (("a", good), ("b", newer), ("c", older)):
        path = write_lines(tmp_path / f"{name}.jsonl", [row])
        loads.append(run_export(spark, path, rules, root, incremental=True).first())
    assert [r["loaded_records"] for r in loads] == [1, 1, 0]
    assert [r["unchanged_records"] for r in loads] == [0, 0, 1]
    stored = TicketStore(spark, root).tickets()
    assert [t["title"] for t in stored.collect()] == ["Newer title"]
    since = datetime(2031, 7, 15, tzinfo=timezone.utc)
    found = listing.find_tickets(stored, "Open", "Critical", since).select("ticket_id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(status,Open)" in plan and "title" not in plan
    recent = listing.find_tickets(stored, updated_since=since).select("ticket_id")
    assert "GreaterThanOrEqual(updated_at" in recent._jdf.queryExecution().executedPlan().toString()
    assert found.count() == recent.count() == 1


def test_insert_only_load_keeps_existing_rows(spark, rules, good, tmp_path):
    root = str(tmp_path / "store")
    changed = {**good, "title": "Other title", "updated_at": "2031-07-15T11:00:00Z"}
    fresh = {**good, "ticket_id": "SD-2"}
    run_export(spark, write_lines(tmp_path / "a.jsonl", [good]), rules, root)
    second = run_export(
        spark, write_lines(tmp_path / "b.jsonl", [changed, fresh]), rules, root
    ).first()
    assert (second["loaded_records"], second["unchanged_records"]) == (1, 1)
    store = TicketStore(spark, root)
    assert sorted(t["title"] for t in store.tickets().collect()) == [good["title"]] * 2
    assert listing.newest_runs(store.run_states()).count() == 2


def test_empty_input_completes_and_fails_the_gate(spark, rules, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text("", encoding="utf-8")
    row = run_export(spark, str(path), rules, str(tmp_path / "store")).first()
    assert (row["status"], row["total_records"], row["quality_score"]) == ("COMPLETED", 0, 0.0)
    assert not row["quality_gate_passed"]


def test_known_counters_of_the_generated_export(spark, tmp_path):
    """The draws of the published run give its published counters."""
    rng, draws = random.Random(20260804), []
    for i in range(100_000):
        repeats = i > 0 and rng.random() < 0.01
        draws.append((i, repeats, i % 4 if rng.random() < 0.02 else None))
    base = spark.createDataFrame(draws, "i long, repeats boolean, defect long")
    path, root = str(tmp_path / "in.parquet"), str(tmp_path / "store")
    rows = synthetic.tickets_from_draws(base).repartitionByRange(4, "row_number")
    rows = rows.sortWithinPartitions("row_number").drop("row_number")
    synthetic.write_export(rows, path, "parquet")
    rules = QualityRules.from_dict(DOCUMENT)
    summary = run_export(spark, path, rules, root, incremental=True).first()
    assert [summary[c] for c in COUNTS[:6]] == [100_000, 97_152, 2_848, 900, 97_152, 0]
    assert summary["quality_dimensions"].asDict() == {
        "completeness": 0.999317,
        "uniqueness": 0.991,
        "validity": 0.98052,
        "consistency": 1.0,
        "timeliness": 1.0,
    }
    assert summary["quality_score"] == 0.994167 and summary["quality_gate_passed"]
    assert summary["batches_committed"] == 100 and summary["resumed_from_offset"] == 100_000
    store = TicketStore(spark, root)
    assert store.tickets().count() == 97_152
    sample = listing.quarantine_sample(store.committed("quarantine"), limit=10).collect()
    assert len(sample) == 10
    assert all("@example.invalid" not in r["masked_raw"] for r in sample)


def test_stream_with_restart_equals_one_pass(spark, tmp_path):
    rules = QualityRules.from_dict(DOCUMENT)
    folder, root = str(tmp_path / "in.csv"), str(tmp_path / "store")
    rows = synthetic.synthetic_rows(spark, 3_000, duplicate_rate=0.2, invalid_rate=0.1)
    for part in range(3):
        piece = rows.where(F.floor((F.col("row_number") - 1) / 1_000) == part)
        piece = piece.repartitionByRange(1, "row_number").sortWithinPartitions("row_number")
        synthetic.write_export(piece.drop("row_number"), folder, "csv", mode="append")
    options = dict(name="feed", fmt="csv", files_per_batch=1)
    with pytest.raises(Exception, match="on purpose"):
        run_stream(spark, folder, rules, root, **options, on_commit=stop_after(2))
    store = TicketStore(spark, root)
    commits = store.read("commits").collect()
    assert len(commits) == 2 and store.tickets().count() == sum(c["accepted_records"] for c in commits)
    streamed = run_stream(spark, folder, rules, root, **options).first()
    again = run_stream(spark, folder, rules, root, **options).first()
    assert [streamed[c] for c in COUNTS] == [again[c] for c in COUNTS]

    ordered = rows.repartitionByRange(1, "row_number").sortWithinPartitions("row_number")
    synthetic.write_export(ordered.drop("row_number"), str(tmp_path / "all.csv"), "csv")
    other = str(tmp_path / "other")
    whole = run_export(spark, str(tmp_path / "all.csv"), rules, other).first()
    assert [streamed[c] for c in COUNTS] == [whole[c] for c in COUNTS]

    def rejected(root):
        found = TicketStore(spark, root).committed("quarantine")
        return sorted((r["row_number"], r["masked_raw"], str(r["violations"])) for r in found.collect())

    assert rejected(root) == rejected(other)
    assert run_summary(store, threshold=1.0).first()["quality_gate_passed"] is False
