"""Resumable micro-batch ingest with Structured Streaming.

The file source's checkpoint decides which files form a batch; the store's commit rows decide which
batches count. A batch that is delivered again after a crash is skipped when it was committed, and
otherwise redone over its own folders. Late data is never dropped: an old ticket is stale or loses
to the stored one, so there is no watermark. In a newer-wins run every micro-batch is an export of
its own, whose rows update earlier ones; otherwise a ticket of an earlier batch makes a repeat.
"""

from __future__ import annotations

import contextlib
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

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
from deskwright.sources.formats import detect_format
from deskwright.sources.numbering import number_rows
from deskwright.sources.readers import check_headers, scan_export, spread_tickets
from deskwright.streaming.first_rows import KeyState


def ingest_batch(
    store: TicketStore,
    run: dict,
    rules: QualityRules,
    rows: DataFrame,
    batch_id: int,
    keys: KeyState | None,
) -> bool:
    """Process one micro-batch and load its tickets, unless it is already committed."""
    done = store.commits_of(run["run_id"])
    if done and batch_id <= done[-1]["batch_id"]:
        return False
    offset = done[-1]["row_offset"] if done else 0
    if run["input_format"] == "csv":
        check_headers(rows)
    numbered = number_rows(rows, first_number=offset + 1)
    spread = spread_tickets(numbered, rows, run["input_format"], bounded=True)
    staged = stage(store, run, spread, rules, batch_id)
    process_unit(store, run, staged, numbered, rules, batch_id, offset, keys)
    if not run["dry_run"]:
        load_tickets(store, run)
    return True


def run_stream(
    spark: SparkSession,
    folder: str,
    rules: QualityRules,
    root: str,
    name: str,
    fmt: str,
    schema: T.StructType | None = None,
    dry_run: bool = False,
    incremental: bool = False,
    multi_line: bool = True,
    files_per_batch: int = 1_000,
    on_commit: Callable[[int], None] | None = None,
    take_over: bool = False,
) -> DataFrame:
    """Ingest all files of a folder that the run ``name`` has not seen, then load and report.

    The name takes the place of the input hash in the run identity, because the folder grows.
    ``schema`` is needed for Parquet and, when the folder may still be empty, for CSV.
    One driver works on a run, as with ``run_export``.
    """
    store = TicketStore(spark, root)
    fmt = detect_format(folder, fmt)
    input_hash = hashlib.sha256(name.encode()).hexdigest()
    run = describe_run(rules, folder, input_hash, fmt, dry_run, incremental)
    run_id = run["run_id"]
    with claimed(store, run, take_over):
        status = store.run_status(run_id)
        if status is None:
            store.log_run(run, fixed.PENDING)
        store.record_lineage(
            run_id,
            check=status is not None,
            source_system=rules.source_system,
            original_path=folder,
            input_hash=input_hash,
            input_format=fmt,
            config_hash=run["config_hash"],
            schema_version=rules.schema_version,
        )
        # In a newer-wins stream a later micro-batch updates a ticket; within one it is a repeat.
        keys = None if incremental else KeyState(spark, store.path("key_state", run_id))

        def each(rows: DataFrame, batch_id: int) -> None:
            if ingest_batch(store, run, rules, rows, batch_id, keys) and on_commit:
                on_commit(batch_id + 1)

        with attempt(store, run):
            scan = scan_export(
                spark,
                folder,
                fmt,
                multi_line,
                stream=True,
                schema=schema,
                maxFilesPerTrigger=str(files_per_batch),
            )
            query = (
                scan.writeStream.foreachBatch(each)
                .option("checkpointLocation", store.path("stream_checkpoints", run_id))
                .trigger(availableNow=True)
                .start()
            )
            with keys or contextlib.nullcontext():
                query.awaitTermination()
            finish_run(store, run, rules)
        summary = stored_summary(store, run_id)
        write_reports(store, summary, run_id)
    return summary
