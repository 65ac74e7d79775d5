"""Steps shared by one-pass runs and micro-batches."""

from __future__ import annotations

import contextlib
import time
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from deskwright import fixed
from deskwright.functions.keys import run_key_of, ticket_key
from deskwright.operators.classify import (
    STAGE_COLUMNS,
    evaluate,
    identity_of,
    masked_payload,
    with_repeats,
)
from deskwright.operators.merge import TICKET_KEY, changed_keys, key_bucket, latest_per_key
from deskwright.operators.repeats import first_rows, repeated_rows
from deskwright.operators.scoring import (
    Counted,
    add_measures,
    dimension_scores,
    measure,
    metrics_long,
    quality_gate,
    throughput,
)
from deskwright.plans.store import MOST_PARTS, TICKET_SCHEMA, TicketStore
from deskwright.rules import QualityRules
from deskwright.streaming.first_rows import KeyState

# Rows rejected as repeats whose numbers and violations are broadcast; about 200 MB. Beyond that
# they are joined by row number.
BROADCAST_REPEATS = 1_000_000


def describe_run(
    rules: QualityRules,
    input_path: str,
    input_hash: str,
    input_format: str,
    dry_run: bool,
    incremental: bool,
) -> dict:
    """The identity of a run. Its id follows from its key, so equal inputs give the same run."""
    key = run_key_of(input_hash, rules.config_hash, dry_run, incremental)
    return {
        "run_id": str(uuid.UUID(hex=key[:32])),
        "run_key": key,
        "input_path": input_path,
        "input_hash": input_hash,
        "input_format": input_format,
        "config_hash": rules.config_hash,
        "config_json": rules.to_json(),
        "dry_run": dry_run,
        "incremental": incremental,
    }


@contextlib.contextmanager
def claimed(store: TicketStore, run: dict, take_over: bool = False) -> Iterator[None]:
    """Work on a run as its only driver; fails with ``RunClaimed`` if there is one already."""
    run["claim"] = store.claim(run["run_id"], take_over)
    try:
        yield
    finally:
        store.release(run)


@contextlib.contextmanager
def attempt(store: TicketStore, run: dict) -> Iterator[None]:
    """Log when an attempt at a run begins and how it ends, unless the run was taken over meanwhile."""
    store.log_run(run, fixed.RUNNING)
    started = time.monotonic()
    try:
        yield
    except BaseException as error:
        if store.owns(run):
            store.log_run(
                run, fixed.FAILED, error=str(error), duration_seconds=time.monotonic() - started
            )
        raise
    store.check_claim(run)
    store.log_run(run, fixed.COMPLETED, duration_seconds=time.monotonic() - started)


def stage(
    store: TicketStore, run: dict, envelope: DataFrame, rules: QualityRules, batch_id: int
) -> DataFrame:
    """Evaluate the rows of a unit once and keep the masked result; raw values are never stored.

    Rows that are rejected whatever the repeats are get their masked payload in the same pass.
    """
    store.check_claim(run)
    path = store.path("stage", run["run_id"], batch_id)
    evaluated = evaluate(envelope, rules)
    refused = ~F.coalesce(
        F.col("ticket_ok") & ~F.col("invalid") & ~F.col("inconsistent"), F.lit(False)
    )
    only = F.lit(False) if run["dry_run"] else refused
    evaluated.select(
        *STAGE_COLUMNS, masked_payload(evaluated, only=only).alias("masked_raw")
    ).write.mode("overwrite").parquet(path)
    return store.spark.read.parquet(path)


def process_unit(
    store: TicketStore,
    run: dict,
    staged: DataFrame,
    envelope: DataFrame,
    rules: QualityRules,
    batch_id: int,
    row_offset: int,
    keys: KeyState | None = None,
) -> None:
    """Flag repeats, quarantine the rejected rows and commit one unit.

    Only rows rejected as repeats are fetched from ``envelope``, which need not be spread over the cores
    as the rows to evaluate. ``row_offset`` counts the rows of earlier units. ``keys`` holds the first row of every key, for
    runs of several units: a key of an earlier unit makes every later row with it a repeat.
    """
    run_id = run["run_id"]
    claims = F.col("ticket_ok")
    if keys is not None:
        key = ticket_key(staged["source_system"], staged["ticket_id"])
        claimed = staged.where(claims).select(key.alias("ticket_key"), "row_number")
        path = store.write_unit(keys.first_rows(claimed, row_offset), "keys", run_id, batch_id)
        firsts = store.spark.read.parquet(path).select(
            F.col("first_row_number").alias("row_number")
        )
    else:
        firsts = first_rows(staged, identity_of(staged), claims=claims)
    # Written out, so that the planner joins by its true size: broadcast only while it is small.
    repeats_path = store.write_unit(
        repeated_rows(staged.where(claims), firsts), "repeats", run_id, batch_id
    )
    judged = with_repeats(staged, store.spark.read.parquet(repeats_path))
    if run["dry_run"]:
        measured = measure(judged)
    else:
        counted = Counted(judged)
        rejected = counted.rows.where("NOT accepted").select("row_number", "masked_raw", "violations")
        rejected_path = store.write_unit(rejected, "rejected", run_id, batch_id, sparse=True)
        rejected = store.spark.read.parquet(rejected_path)
        measured = counted.measures(staged.count())  # from the files' footers
        # Rows rejected as repeats only fetch their source now.
        bare = rejected.where("masked_raw IS NULL").select("row_number", "violations")
        known = rejected.where("masked_raw IS NOT NULL")
        if bare.limit(BROADCAST_REPEATS + 1).count() <= BROADCAST_REPEATS:
            bare = F.broadcast(bare)
        fetched = envelope.join(bare, "row_number")
        fetched = fetched.select(
            "row_number", masked_payload(fetched).alias("masked_raw"), "violations"
        )
        quarantined = known.unionByName(fetched)
        store.write_unit(
            quarantined.withColumn("quarantined_at", F.current_timestamp()),
            "quarantine",
            run_id,
            batch_id,
            sparse=True,
        )
    offset = F.lit(row_offset) + F.col("total_records")
    commit = measured.select(
        offset.alias("row_offset"),
        F.ceil(offset / rules.batch_size).cast("long").alias("batch_index"),
        F.current_timestamp().alias("committed_at"),
        "*",
    )
    store.check_claim(run)
    store.write_unit(commit.coalesce(1), "commits", run_id, batch_id)


def accepted_tickets(store: TicketStore, run: dict, batches: list[int]) -> DataFrame:
    """Accepted rows of committed units, read from the stage and the list of repeats."""
    run_id = run["run_id"]
    if not batches:
        return store.spark.createDataFrame([], TICKET_SCHEMA).withColumn(
            "row_number", F.lit(0).cast("long")
        )
    staged = store.spark.read.parquet(*[store.path("stage", run_id, n) for n in batches])
    repeats = store.spark.read.parquet(*[store.path("repeats", run_id, n) for n in batches])
    accepted = staged.where("ticket_ok AND NOT invalid AND NOT inconsistent").join(
        repeats, "row_number", "left_anti"
    )
    stamped = accepted.withColumns(
        {
            "source_input_hash": F.lit(run["input_hash"]),
            "source_run_id": F.lit(run_id),
            "loaded_at": F.current_timestamp(),
        }
    )
    return stamped.select(*TICKET_SCHEMA.names, "row_number")


MOST_CONFLICTS = 100


def load_tickets(store: TicketStore, run: dict) -> None:
    """Load the accepted rows of committed units that are not loaded yet and publish the result.

    Insert-only runs add the new keys. Newer-wins runs also rewrite the buckets of tickets that they
    update, and no others. A record in ``loads`` makes the result visible. A load follows from the
    loads before it; if another run has published under its number meanwhile, the result is made again
    after that one.
    """
    for _ in range(MOST_CONFLICTS):
        if _load_once(store, run):
            return
    raise RuntimeError("other loads were published all the time; the run can be started again")


def merge_into(
    store: TicketStore,
    loads: list[Row],
    incoming: DataFrame,
    n_rows: int,
    folder: str,
    newer_by: str | None = "updated_at",
) -> dict:
    """Merge ``incoming``, about ``n_rows`` tickets of unique keys, into the version after ``loads``.

    New keys are added to their buckets. With ``newer_by`` rows that are newer replace stored ones, for
    which their buckets are rewritten; other buckets are not touched. Nothing is visible until the
    result, which is the buckets of either kind and the number of tickets written, is published.
    """
    n_buckets = store.n_buckets(loads, n_rows)
    bucket = key_bucket(TICKET_KEY, n_buckets).alias("bucket")
    incoming = incoming.select(*TICKET_SCHEMA.names, bucket)
    touched = None  # all buckets, where there are many rows
    if n_rows < n_buckets:
        touched = {r["bucket"] for r in incoming.select("bucket").distinct().collect()}
    if loads:
        changes = changed_keys(store.tickets(loads, touched), incoming, newer_by=newer_by)
        path = f"{store.root}/load_changes/{folder}"
        changes.write.mode("overwrite").parquet(path)
        changes = store.spark.read.schema(changes.schema).parquet(path)
        rows = incoming.join(changes.select(*TICKET_KEY), TICKET_KEY, "left_semi")
    else:  # every row is new; one without a key has no place, as in the join
        changes = incoming.select(*TICKET_KEY, "bucket", F.lit("insert").alias("action"))
        rows = incoming.dropna(subset=TICKET_KEY)
    is_update = F.col("action") == "update"
    counted = changes.groupBy("bucket").agg(
        F.count("*").alias("rows"), F.count_if(is_update).alias("updates")
    )
    counts = counted.collect()  # a row per bucket
    parts = store.parts(loads)
    rewritten = sorted(
        r["bucket"] for r in counts if r["updates"] or len(parts.get(r["bucket"], [])) >= MOST_PARTS
    )
    added = sorted({r["bucket"] for r in counts} - set(rewritten))
    if counts:
        if rewritten:
            updated = changes.where(is_update).select(*TICKET_KEY)
            kept = store.tickets(loads, rewritten).join(updated, TICKET_KEY, "left_anti")
            rows = rows.unionByName(kept.select(*TICKET_SCHEMA.names, bucket))
        store.write_tickets(rows, folder)
    return {
        "folder": folder,
        "n_buckets": n_buckets,
        "rewritten": rewritten,
        "added": added,
        "loaded_records": sum(r["rows"] for r in counts),
    }


def _load_once(store: TicketStore, run: dict) -> bool:
    run_id = run["run_id"]
    loads, commits = store.loads(), store.commits_of(run_id)
    merged = max((x["through_batch"] for x in loads if x["run_id"] == run_id), default=-1)
    fresh = [c for c in commits if c["batch_id"] > merged]
    if not fresh:
        return True
    number = loads[-1]["load_number"] + 1 if loads else 1
    folder = f"tickets/load={number}-{run_id}"
    accepted = sum(c["accepted_records"] for c in fresh)
    incoming = accepted_tickets(store, run, [c["batch_id"] for c in fresh if c["accepted_records"]])
    newer_by = None
    if run["incremental"]:
        newer_by = "updated_at"
        # A stream may bring a ticket again in a later unit: the newest counts, of equals the first.
        # Within a unit it would be a repeat.
        if len(fresh) > 1:
            newest = F.struct("updated_at", -F.col("row_number"))
            incoming = latest_per_key(incoming, TICKET_KEY, newest)
    merged = merge_into(store, loads, incoming, accepted, folder, newer_by)
    return store.publish(
        load_number=number,
        run_id=run_id,
        through_batch=fresh[-1]["batch_id"],
        unchanged_records=accepted - merged["loaded_records"],
        published_at=datetime.now(timezone.utc).isoformat(),
        **merged,
    )


def finish_run(store: TicketStore, run: dict, rules: QualityRules) -> None:
    """Load tickets (unless dry) and replace the run's quality metrics."""
    if not run["dry_run"]:
        load_tickets(store, run)
    measures = add_measures(store.read("commits", run["run_id"]))
    metrics = metrics_long(measures, len(rules.required_fields))
    metrics.withColumn("measured_at", F.current_timestamp()).coalesce(1).write.mode(
        "overwrite"
    ).parquet(store.path("quality_metrics", run["run_id"]))


def stored_summary(store: TicketStore, run_id: str) -> DataFrame:
    """The one-row summary of a run, detached from the tables it was computed from."""
    summary = run_summary(store, run_id)
    return store.spark.createDataFrame(summary.collect(), summary.schema)


def run_summary(
    store: TicketStore, run_id: str | None = None, threshold: float | None = None
) -> DataFrame:
    """Identity, counters, scores and gate of one run, or of every run, by the rules of each.

    ``threshold`` judges stored scores by another threshold than the rules'.
    """
    commits = store.read("commits", run_id)
    progress = commits.groupBy("run_id").agg(
        F.max("row_offset").alias("resumed_from_offset"),
        F.max("batch_index").alias("batches_committed"),
    )
    loads = (
        store.read("loads", run_id)
        .groupBy("run_id")
        .agg(
            F.sum("loaded_records").alias("loaded_records"),
            F.sum("unchanged_records").alias("unchanged_records"),
        )
    )
    zero = ["loaded_records", "unchanged_records", "resumed_from_offset", "batches_committed"]
    joined = (
        store.run_states(run_id)
        .join(add_measures(commits, "run_id"), "run_id", "left")
        .join(progress, "run_id", "left")
        .join(loads, "run_id", "left")
    )
    counters = [c for c in joined.columns if c.endswith("_records") or c == "missing_values"]
    filled = joined.fillna(0, [*counters, *zero])
    required = F.json_array_length(F.get_json_object("config_json", "$.required_fields"))
    own_threshold = F.get_json_object("config_json", "$.quality_threshold")
    scored = quality_gate(
        dimension_scores(filled, required), own_threshold if threshold is None else threshold
    )
    reports = F.concat(F.lit(f"{store.root}/reports/"), F.col("run_id"))
    return scored.select(
        "run_id",
        "status",
        "input_path",
        "input_hash",
        "input_format",
        "config_hash",
        "dry_run",
        "incremental",
        "total_records",
        "accepted_records",
        "quarantined_records",
        "duplicate_records",
        "loaded_records",
        "unchanged_records",
        "resumed_from_offset",
        "batches_committed",
        F.round("duration_seconds", 6).alias("duration_seconds"),
        throughput(F.col("total_records"), F.col("duration_seconds")).alias("records_per_second"),
        F.struct(*fixed.DIMENSIONS).alias("quality_dimensions"),
        "quality_score",
        "quality_threshold",
        "quality_gate_passed",
        F.concat(reports, F.lit("/json")).alias("report_json"),
        F.concat(reports, F.lit("/markdown")).alias("report_markdown"),
    )
