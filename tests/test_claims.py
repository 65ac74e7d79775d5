"""One driver for each run: claims, their release, and drivers that died."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

import pytest

from deskwright.plans.batch import run_export
from deskwright.plans.store import RunClaimed, TicketStore
from deskwright.streaming.ingest import run_stream

ROWS, UNIT = 60, 20
COUNTS = ["status", "total_records", "accepted_records", "duplicate_records", "loaded_records"]


@pytest.fixture
def export(spark, good, tmp_path) -> str:
    """Rows of 50 tickets, so that the last ten are repeats."""
    path = tmp_path / "in.jsonl"
    rows = [{**good, "ticket_id": f"SD-{i % 50}"} for i in range(ROWS)]
    path.write_text("".join(json.dumps(r) + "\n" for r in rows), encoding="utf-8")
    return str(path)


def counts(summary) -> tuple:
    return tuple(summary.select(*COUNTS).first())


def ids(store) -> list[str]:
    return sorted(r["ticket_id"] for r in store.tickets().select("ticket_id").collect())


def test_one_of_many_drivers_gets_a_claim(spark, tmp_path):
    store = TicketStore(spark, str(tmp_path))

    def claim(_):
        try:
            return store.claim("run")
        except RunClaimed:
            return None

    with ThreadPoolExecutor(8) as pool:
        assert sorted(x for x in pool.map(claim, range(16)) if x) == [1]
    assert store.claim("other") == 1
    run = {"run_id": "run", "claim": 1}
    assert store.owns(run)
    store.release(run)
    store.release(run)
    assert store.claim("run") == 2 and not store.owns(run)
    with pytest.raises(RunClaimed):
        store.check_claim(run)


def test_a_second_driver_of_a_run_is_refused(spark, rules, export, tmp_path):
    root, refused = str(tmp_path / "store"), []

    def second(_):
        with pytest.raises(RunClaimed):
            run_export(spark, export, rules, root, commit_rows=UNIT)
        refused.append(True)

    summary = run_export(spark, export, rules, root, commit_rows=UNIT, on_commit=second)
    assert len(refused) == 3 and counts(summary) == ("COMPLETED", ROWS, 50, 10, 50)
    store = TicketStore(spark, root)
    # The refused drivers have logged nothing.
    assert sorted(r["status"] for r in store.read("runs").collect()) == ["COMPLETED", "PENDING", "RUNNING"]
    # The claim has ended with the run, which gives its stored summary from now on.
    assert counts(run_export(spark, export, rules, root)) == counts(summary)


def test_the_run_of_a_dead_driver_is_taken_over(spark, rules, export, tmp_path):
    root = str(tmp_path / "store")
    store = TicketStore(spark, root)

    def dies(done):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        run_export(spark, export, rules, root, commit_rows=UNIT, on_commit=dies)
    run_id = store.read("runs").first()["run_id"]
    assert store.claim(run_id) == 2  # released by the attempt above; this one's driver dies
    with pytest.raises(RunClaimed):
        run_export(spark, export, rules, root, commit_rows=UNIT)
    summary = run_export(spark, export, rules, root, commit_rows=UNIT, take_over=True)
    assert counts(summary) == ("COMPLETED", ROWS, 50, 10, 50)
    assert len(store.commits_of(run_id)) == 3 and len(ids(store)) == 50


def test_a_driver_whose_run_was_taken_over_stops(spark, rules, export, tmp_path):
    root = str(tmp_path / "store")
    store = TicketStore(spark, root)

    def taken(done):
        run_id = store.read("runs").first()["run_id"]
        store.claim(run_id, take_over=True)

    with pytest.raises(RunClaimed):
        run_export(spark, export, rules, root, commit_rows=UNIT, on_commit=taken)
    run_id = store.read("runs").first()["run_id"]
    # It has committed nothing since, and does not call the other driver's run failed.
    assert len(store.commits_of(run_id)) == 1 and store.run_status(run_id) == "RUNNING"
    summary = run_export(spark, export, rules, root, commit_rows=UNIT, take_over=True)
    assert counts(summary) == ("COMPLETED", ROWS, 50, 10, 50) and len(ids(store)) == 50


def test_a_second_driver_of_a_stream_is_refused(spark, rules, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "store")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"ticket_id": "SD-1"}\n', encoding="utf-8")
    options = dict(name="desk", fmt="jsonl")
    refused = []

    def second(_):
        with pytest.raises(RunClaimed):
            run_stream(spark, folder, rules, root, **options)
        refused.append(True)

    first = run_stream(spark, folder, rules, root, **options, on_commit=second).first()
    assert refused == [True] and first["total_records"] == 1
    # A stream goes on with files that came later, under a claim of its own.
    (tmp_path / "in" / "b.jsonl").write_text('{"ticket_id": "SD-2"}\n', encoding="utf-8")
    assert run_stream(spark, folder, rules, root, **options).first()["total_records"] == 2
