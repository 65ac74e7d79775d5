"""One-pass run over an export."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from deskwright import fixed
from deskwright.plans.load import (
    attempt,
    claimed,
    describe_run,
    finish_run,
    load_tickets,
    process_unit,
    stage,
    stored_summary,
)
from deskwright.plans.reports import write_reports
from deskwright.plans.store import TicketStore
from deskwright.rules import QualityRules
from deskwright.session import size_shuffles
from deskwright.sources.fingerprint import input_fingerprint, manifest_fingerprint
from deskwright.sources.formats import detect_format
from deskwright.sources.readers import (
    FilesByHeader,
    IndexedExport,
    numbered_tickets,
    read_tickets,
    spread_tickets,
)
from deskwright.streaming.first_rows import KeyState

# Batch id of the stage folder of a one-pass run.
WHOLE_INPUT = 0


def run_export(
    spark: SparkSession,
    path: str,
    rules: QualityRules,
    root: str,
    fmt: str | None = None,
    dry_run: bool = False,
    incremental: bool = False,
    multi_line: bool = True,
    commit_rows: int | None = None,
    on_commit: Callable[[int], None] | None = None,
    by_manifest: bool = False,
    take_over: bool = False,
) -> DataFrame:
    """Check, load and report one export; returns its one-row summary.

    The same input, rules and flags are the same run: once completed, its stored summary comes
    back. A failed run continues after its last commit. ``commit_rows`` splits the work into
    commits of that many rows; by default the whole input is one. ``on_commit`` is called with the
    number of commits made so far. ``by_manifest`` identifies the input by the names, sizes and
    modification times of its files instead of reading it once more.

    One driver works on a run; another one fails with ``RunClaimed``. The claim of a driver that died
    without ending its attempt stays, and ``take_over`` goes on in its place: should it be alive after
    all, it stops before its next commit.
    """
    store = TicketStore(spark, root)
    fmt, headers = detect_format(path, fmt), FilesByHeader(spark, path, multi_line)
    if by_manifest:
        found = manifest_fingerprint(spark, path).first()
    else:
        rows = read_tickets(spark, path, fmt, multi_line, headers)
        found = input_fingerprint(spark, path, rows).first()
    size_shuffles(spark, found["input_size_bytes"])
    run = describe_run(rules, path, found["fingerprint"], fmt, dry_run, incremental)
    run_id = run["run_id"]
    if store.run_status(run_id) == fixed.COMPLETED:
        return _completed(store, run_id)
    with claimed(store, run, take_over):
        status = store.run_status(run_id)
        if status == fixed.COMPLETED:  # by another driver meanwhile
            return _completed(store, run_id)
        if status is None:
            store.log_run(run, fixed.PENDING)
        store.record_lineage(
            run_id,
            check=status is not None,
            source_system=rules.source_system,
            original_path=path,
            input_size_bytes=found["input_size_bytes"],
            input_hash=run["input_hash"],
            input_format=fmt,
            config_hash=run["config_hash"],
            schema_version=rules.schema_version,
        )
        with attempt(store, run):
            _process(
                spark, path, rules, store, run, fmt, multi_line, commit_rows, on_commit, headers
            )
            finish_run(store, run, rules)
        summary = stored_summary(store, run_id)
        write_reports(store, summary, run_id)
    return summary


def _completed(store: TicketStore, run_id: str) -> DataFrame:
    summary = stored_summary(store, run_id)
    write_reports(store, summary, run_id, only_missing=True)
    return summary


def _process(
    spark, path, rules, store, run, fmt, multi_line, commit_rows, on_commit, headers
) -> None:
    """Process what is not committed yet, whatever the size of the commits before."""
    done = store.commits_of(run["run_id"])
    if not done and commit_rows is None:
        envelope, scan = numbered_tickets(spark, path, fmt, multi_line, headers)
        spread = spread_tickets(envelope, scan, fmt, bounded=True)
        staged = stage(store, run, spread, rules, WHOLE_INPUT)
        process_unit(
            store, run, staged, envelope, rules, WHOLE_INPUT, row_offset=0
        )
        if on_commit:
            on_commit(1)
        return
    offset = done[-1]["row_offset"] if done else 0
    first = done[-1]["batch_id"] + 1 if done else 0
    index = store.path("splits", run["run_id"])
    export = IndexedExport(spark, path, index, fmt, multi_line, headers)
    total, commits = export.total, 0
    with KeyState(spark, store.path("key_state", run["run_id"])) as keys:
        while offset < total:
            until = total if commit_rows is None else min(offset + commit_rows, total)
            unit, scan = export.numbered(offset, until)
            batch_id = first + commits
            spread = spread_tickets(unit, scan, fmt, bounded=True)
            staged = stage(store, run, spread, rules, batch_id)
            process_unit(store, run, staged, unit, rules, batch_id, offset, keys)
            if not run["dry_run"]:
                load_tickets(store, run)
            offset, commits = until, commits + 1
            if on_commit:
                on_commit(commits)
    committed = sum(c["total_records"] for c in store.commits_of(run["run_id"]))
    if committed != total:
        raise RuntimeError(f"{committed} rows are committed, the input has {total}")
