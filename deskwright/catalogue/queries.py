"""Named queries: one per operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwright import fixed
from deskwright.catalogue.ticket_view import (
    ORDER_COLUMNS,
    VIEW_RULES,
    table,
    ticket_envelope,
    ticket_view,
    view_of,
)
from deskwright.functions import keys, masking, text, timestamps
from deskwright.functions.formatting import score
from deskwright.operators import listing, merge, repeats, scoring
from deskwright.operators.classify import (
    TICKET_COLUMNS,
    classify,
    clean_fields,
    evaluate,
    masked_payload,
)
from deskwright.plans.batch import run_export
from deskwright.plans.load import merge_into, run_summary
from deskwright.plans.reports import json_report, markdown_report
from deskwright.plans.store import TICKET_SCHEMA, TicketStore
from deskwright.session import scratch_path
from deskwright.sources import byte_tree, fingerprint, numbering, synthetic
from deskwright.sources.formats import format_of
from deskwright.sources.readers import read_tickets
from deskwright.streaming.first_rows import KeyState
from deskwright.streaming.ingest import run_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

REQUIRED = len(VIEW_RULES.required_fields)
OFFSET = 1_000
EVENT_REFERENCE = datetime(2024, 1, 31, tzinfo=timezone.utc)
EVENT_DAYS = 10


def query(function: Query) -> Query:
    """Register a query under its function name; every query runs in UTC."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return function


def codes(violations: Column | str) -> Column:
    return F.array_join(F.transform(violations, lambda v: v["code"]), ",")


def micros(name: str) -> Column:
    return F.unix_micros(name)


def _classified(spark: SparkSession, folder: str, columns: list[str] | None = None) -> DataFrame:
    return classify(ticket_envelope(spark, folder), VIEW_RULES, columns)


# Scalar functions


@query
def clean_text(spark, folder):
    view = ticket_view(spark, folder)
    return view.select(
        "row_number",
        *[text.clean_text(F.col(c)).alias(c) for c in ("title", "status", "priority", "assignee")],
    )


@query
def messages_of_bad_values(spark, folder):
    """What the rules say of statuses and priorities that they do not allow, empty ones marked."""
    rows = _classified(spark, folder).select("row_number", F.explode("violations").alias("v"))
    return rows.where("v.code IN ('invalid_status', 'invalid_priority')").select("row_number", "v.*")


@query
def truncated_texts(spark, folder):
    """The first code points of documents, as raw lines and error messages are kept."""
    docs = numbering.spread(table(spark, folder, "documents"))
    return docs.select(
        "doc_id",
        text.truncate(F.col("text"), fixed.RAW_LINE_CHARS).alias("raw"),
        text.empty_marker(text.clean_text(F.col("source"))).alias("source"),
    )


@query
def clean_text_conversations(spark, folder):
    turns = numbering.spread(table(spark, folder, "conversations"))
    return turns.select("conv_id", "turn", text.clean_text(F.col("text")).alias("text"))


@query
def normalize_status_priority(spark, folder):
    view = ticket_view(spark, folder)
    status, priority = text.clean_text(F.col("status")), text.clean_text(F.col("priority"))
    return view.select(
        "row_number",
        text.map_value(status, VIEW_RULES.status_mapping).alias("status"),
        text.map_value(priority, VIEW_RULES.priority_mapping).alias("priority"),
    )


@query
def parse_ticket_timestamps(spark, folder):
    view = ticket_view(spark, folder)
    return view.select(
        "row_number",
        *[
            F.unix_micros(timestamps.parse_timestamp(F.col(c))).alias(f"{c}_us")
            for c in ("created_at", "updated_at", "resolved_at")
        ],
        text.null_if_empty(text.clean_text(F.col("assignee"))).alias("assignee"),
        text.default_if_empty(
            text.clean_text(F.col("source_system")), VIEW_RULES.source_system
        ).alias("source_system"),
    )


@query
def mask_email(spark, folder):
    view = ticket_view(spark, folder)
    return view.select(
        "row_number", masking.mask_email(F.col("requester_email")).alias("requester_email")
    )


@query
def mask_text_tickets(spark, folder):
    view = ticket_view(spark, folder)
    return view.select("row_number", masking.mask_text(F.col("description")).alias("description"))


@query
def mask_text_documents(spark, folder):
    documents = numbering.spread(table(spark, folder, "documents").select("doc_id", "text"))
    return documents.select("doc_id", masking.mask_text(F.col("text")).alias("text"))


def _contacts(spark, folder) -> DataFrame:
    """Nested payloads made of the events."""
    events = table(spark, folder, "events")
    user = F.col("user_id").cast("string")
    address = F.concat(F.lit("User"), user, F.lit("@Example.invalid"))
    return events.select(
        F.col("event_id").alias("row_number"),
        F.struct(
            "event_id",
            address.alias("email"),
            F.concat(F.lit("from "), address, F.lit(" at 202-555-0"), user).alias("note"),
            F.struct(
                F.concat(F.lit("+1-202-555-"), user).alias("phone"),
                F.when(F.col("event_type") == "click", address).alias("mobile"),
                F.col("props").alias("props"),
            ).alias("nested"),
            F.array(address, F.lit("plain")).alias("tags"),
        ).alias("data"),
        F.lit(None).cast("string").alias("read_error"),
    )


@query
def mask_payload(spark, folder):
    """Typed nested payloads: a native expression built from the schema."""
    rows = _contacts(spark, folder)
    return rows.select("row_number", masked_payload(rows).alias("masked_raw"))


@query
def mask_payload_maps(spark, folder):
    """A map of numbers whose sensitive keys are hidden."""
    orders = numbering.spread(table(spark, folder, "orders"))
    numbers = F.create_map(
        F.lit("phone"), F.col("o_custkey"), F.lit("count"), F.col("o_orderkey")
    ).alias("numbers")
    rows = orders.select("o_orderkey", numbers)
    dtype = rows.schema["numbers"].dataType
    masked = masking.mask_value(F.col("numbers"), dtype)
    return rows.select("o_orderkey", F.to_json(masked).alias("masked"))


@query
def mask_payload_json(spark, folder):
    """The same payloads as JSON lines of unknown shape."""
    lines = _contacts(spark, folder).select(
        "row_number", F.to_json("data", {"ignoreNullFields": "false"}).alias("line")
    )
    return lines.select("row_number", masking.mask_json()(F.col("line")).alias("masked_raw"))


@query
def ticket_key(spark, folder):
    view = ticket_view(spark, folder)
    return view.select(
        "row_number", keys.ticket_key(F.col("source_system"), F.col("ticket_id")).alias("ticket_key")
    )


@query
def run_key_by_source(spark, folder):
    """Run keys of the view's sources, each taken as one input with and without dry run."""
    view = ticket_view(spark, folder)
    inputs = view.groupBy("source_system").agg(
        F.count("*").alias("n"), F.sum("row_number").alias("s")
    )
    described = F.concat_ws(":", "source_system", F.col("n").cast("string"), F.col("s").cast("string"))
    hashed = inputs.select("source_system", F.sha2(described, 256).alias("input_hash"))
    return hashed.select(
        "source_system",
        keys.run_key(
            F.col("input_hash"), F.lit(VIEW_RULES.config_hash), F.lit(False), F.lit(True)
        ).alias("run_key"),
        keys.run_key(
            F.col("input_hash"), F.lit(VIEW_RULES.config_hash), F.lit(True), F.lit(True)
        ).alias("dry_run_key"),
    )


@query
def format_detection(spark, folder):
    orders = table(spark, folder, "orders")
    suffixes = F.lit([".csv", ".JSONL", ".ndjson", ".Parquet", ".txt", ""])
    name = F.concat(
        F.lit("exports/day."),
        F.col("o_orderkey").cast("string"),
        F.element_at(suffixes, (F.col("o_orderkey") % 6 + 1).cast("int")),
    )
    return orders.select("o_orderkey", format_of(name).alias("format"))


# Rules


@query
def required_fields_missing(spark, folder):
    fields = clean_fields(ticket_envelope(spark, folder), VIEW_RULES)
    missing = F.array_compact(
        F.array(*[F.when(F.col(f"c_{n}") == "", F.lit(n)) for n in VIEW_RULES.required_fields])
    )
    return fields.select(
        "row_number", F.array_join(missing, ",").alias("missing"), F.size(missing).alias("n_missing")
    )


def _has(code: str) -> Column:
    return F.exists("violations", lambda v: v["code"] == code)


@query
def rule_invalid_status_priority(spark, folder):
    rows = evaluate(ticket_envelope(spark, folder), VIEW_RULES)
    return rows.select(
        "row_number",
        _has("invalid_status").alias("invalid_status"),
        _has("invalid_priority").alias("invalid_priority"),
    )


@query
def rule_schema_validation(spark, folder):
    rows = evaluate(ticket_envelope(spark, folder), VIEW_RULES)
    return rows.select("row_number", "ticket_ok", _has("schema_validation").alias("violated"))


@query
def rule_consistency(spark, folder):
    rows = evaluate(ticket_envelope(spark, folder), VIEW_RULES)
    return rows.select(
        "row_number",
        _has("resolved_timestamp_missing").alias("lost_resolution"),
        _has("active_ticket_has_resolution").alias("early_resolution"),
    )


@query
def rule_stale_tickets(spark, folder):
    rows = evaluate(ticket_envelope(spark, folder), VIEW_RULES)
    return rows.select("row_number", "stale")


@query
def rule_stale_events(spark, folder):
    cutoff = EVENT_REFERENCE - timedelta(days=EVENT_DAYS)
    stale = timestamps.is_stale(F.col("ts").cast("timestamp"), cutoff)
    return table(spark, folder, "events").select("event_id", stale.alias("stale"))


@query
def row_violations(spark, folder):
    rows = _classified(spark, folder, [])
    return rows.select("row_number", codes("violations").alias("codes"))


# Repeats


@query
def duplicate_flags(spark, folder):
    rows = _classified(spark, folder, [])
    return rows.select("row_number", "duplicate")


@query
def first_row_per_key(spark, folder):
    rows = _classified(spark, folder, [])
    key = keys.ticket_key(F.col("source_system"), F.col("ticket_id"))
    firsts = repeats.first_rows(rows, key, claims=F.col("ticket_ok"))
    return firsts.select(
        F.col("_key").alias("ticket_key"), F.col("row_number").alias("first_row_number")
    )


@query
def dedup_documents(spark, folder):
    documents = numbering.spread(table(spark, folder, "documents").select("doc_id", "text"))
    key = F.sha2(text.clean_text(F.col("text")), 256)
    return repeats.flag_repeats(documents, key, order="doc_id").select("doc_id", "duplicate")


# Classified rows


@query
def accepted_tickets(spark, folder):
    accepted, _ = listing.split_accepted(_classified(spark, folder))
    times = ("created_at", "updated_at", "resolved_at")
    return accepted.select(
        "row_number",
        *[c for c in TICKET_COLUMNS if c not in times],
        *[micros(c).alias(f"{c}_us") for c in times],
    )


@query
def quarantined_tickets(spark, folder):
    """Rejected rows with their masked payload, which only they get."""
    envelope = ticket_envelope(spark, folder)
    _, rejected = listing.split_accepted(classify(envelope, VIEW_RULES, []))
    payload = envelope.join(rejected.select("row_number", "violations"), "row_number")
    return payload.select(
        "row_number",
        masked_payload(payload).alias("masked_raw"),
        codes("violations").alias("codes"),
    )


@query
def row_scores(spark, folder):
    rows = _classified(spark, folder, [])
    return rows.select(
        "row_number", *[score(v).alias(k) for k, v in scoring.row_scores(REQUIRED).items()]
    )


def _scored(spark, folder, *by) -> DataFrame:
    return scoring.dimension_scores(
        scoring.measure(_classified(spark, folder, []), *by), REQUIRED
    )


@query
def quality_dimensions(spark, folder):
    return _scored(spark, folder).select(*fixed.DIMENSIONS, "quality_score")


@query
def quality_by_source(spark, folder):
    """Scores per source system as given; rows without a ticket have none stored."""
    envelope = ticket_envelope(spark, folder)
    rows = classify(envelope, VIEW_RULES, [])
    named = rows.withColumn("source", F.coalesce("source_system", F.lit("(no ticket)")))
    scored = scoring.dimension_scores(scoring.measure(named, "source"), REQUIRED)
    return scored.select("source", "total_records", *fixed.DIMENSIONS, "quality_score")


@query
def run_counters(spark, folder):
    return scoring.measure(_classified(spark, folder, []))


@query
def merged_counters(spark, folder):
    """Partial measures of fixed-size batches, merged."""
    rows = _classified(spark, folder, []).withColumn(
        "batch_index", numbering.batch_index(F.col("row_number"), VIEW_RULES.batch_size)
    )
    return scoring.add_measures(scoring.measure(rows, "batch_index"))


@query
def quality_gate(spark, folder):
    scored = scoring.quality_gate(_scored(spark, folder), VIEW_RULES.quality_threshold)
    strict = scoring.quality_gate(scored, 0.9).withColumnRenamed(
        "quality_gate_passed", "strict_gate_passed"
    )
    lenient = scoring.quality_gate(strict, VIEW_RULES.quality_threshold)
    return lenient.select(
        "quality_score", "quality_threshold", "quality_gate_passed", "strict_gate_passed"
    )


@query
def quality_metrics_long(spark, folder):
    measures = scoring.measure(_classified(spark, folder, []))
    metrics = scoring.metrics_long(measures, REQUIRED)
    return metrics.select("dimension", score(F.col("score")).alias("score"))


@query
def violation_histogram(spark, folder):
    return scoring.violation_histogram(_classified(spark, folder, []))


@query
def tickets_by_source(spark, folder):
    accepted, _ = listing.split_accepted(_classified(spark, folder, []))
    return scoring.tickets_by_source(accepted)


@query
def find_tickets(spark, folder):
    accepted, _ = listing.split_accepted(
        _classified(spark, folder, ["status", "priority", "updated_at"])
    )
    since = datetime(1998, 1, 1, tzinfo=timezone.utc)
    found = listing.find_tickets(accepted, "Resolved", "High", since)
    return found.select("ticket_id", "source_system", micros("updated_at").alias("updated_us"))


@query
def quarantine_sample(spark, folder):
    _, rejected = listing.split_accepted(_classified(spark, folder, []))
    return listing.quarantine_sample(
        rejected.select("row_number", codes("violations").alias("codes")), limit=50
    )


# Loading


def _shipment_tickets(spark, folder) -> DataFrame:
    """A later export of the same tickets: the newest line of every order."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    newest = merge.latest_per_key(
        lines, ["l_orderkey"], F.struct("l_shipdate", "l_linenumber")
    )
    joined = newest.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.concat(F.lit("desk-"), (F.col("o_custkey") % 4).cast("string")).alias("source_system"),
        F.concat(F.lit("SD-"), F.col("l_orderkey").cast("string")).alias("ticket_id"),
        F.concat(F.lit("Shipment line "), F.col("l_linenumber").cast("string")).alias("title"),
        F.col("l_shipdate").cast("timestamp").alias("updated_at"),
    )


def _loaded(spark, folder, newer_by) -> DataFrame:
    accepted, _ = listing.split_accepted(_classified(spark, folder, ["title", "updated_at"]))
    target = accepted.select("source_system", "ticket_id", "title", "updated_at")
    actions = merge.merge_actions(target, _shipment_tickets(spark, folder), newer_by=newer_by)
    return actions.select(
        "source_system", "ticket_id", "title", micros("updated_at").alias("updated_us"), "action"
    )


@query
def load_incremental(spark, folder):
    return _loaded(spark, folder, "updated_at")


@query
def load_insert_only(spark, folder):
    return _loaded(spark, folder, None)


def _as_tickets(rows: DataFrame) -> DataFrame:
    """Rows with all columns of stored tickets, those not given null."""
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TICKET_SCHEMA.fields
        ]
    )


@query
def load_into_buckets(spark, folder):
    """The same as load_incremental, as two loads of a bucketed store."""
    store = TicketStore(spark, scratch_path(spark, "store"))
    accepted, _ = listing.split_accepted(_classified(spark, folder, ["title", "updated_at"]))
    first = accepted.select("source_system", "ticket_id", "title", "updated_at")
    for number, rows in enumerate((first, _shipment_tickets(spark, folder)), 1):
        merged = merge_into(store, store.loads(), _as_tickets(rows), rows.count(), f"tickets/load={number}")
        store.publish(load_number=number, run_id="query", through_batch=0, **merged)
    return store.tickets().select("source_system", "ticket_id", "title", micros("updated_at").alias("updated_us"))


@query
def insert_if_absent(spark, folder):
    """Only the rows an insert-only load would append."""
    accepted, _ = listing.split_accepted(_classified(spark, folder, []))
    new = merge.insert_if_absent(accepted, _shipment_tickets(spark, folder), merge.TICKET_KEY)
    return new.select("source_system", "ticket_id", "title")


@query
def load_incremental_events(spark, folder):
    """Latest event per user of one group of types, merged into that of the other."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    stored = events.where(F.col("event_type").isin("view", "click", "error"))
    arrived = events.where(~F.col("event_type").isin("view", "click", "error"))
    newest = F.struct("ts", "event_id")
    columns = ["user_id", "event_id", "ts", "value"]
    target, incoming = (
        merge.latest_per_key(part.select(*columns), ["user_id"], newest)
        for part in (stored, arrived)
    )
    actions = merge.merge_actions(target, incoming, ["user_id"], "ts")
    return actions.select("user_id", "event_id", micros("ts").alias("ts_us"), "value", "action")


@query
def load_counts(spark, folder):
    return merge.load_counts(_loaded(spark, folder, "updated_at"))


# Sources


@query
def batch_assignment(spark, folder):
    view = ticket_view(spark, folder)
    index = numbering.batch_index(F.col("row_number"), VIEW_RULES.batch_size)
    return view.groupBy(index.alias("batch_index")).agg(
        F.count("*").alias("n_rows"),
        F.min("row_number").alias("first_row"),
        F.max("row_number").alias("last_row"),
    )


@query
def offset_skip(spark, folder):
    return numbering.skip_rows(ticket_view(spark, folder), OFFSET).select("row_number", "ticket_id")


# A file of an export is sorted by one task.
FILE_ROWS = 250_000


def in_row_order(spark: SparkSession, folder: str, files: int = 4) -> DataFrame:
    """The ticket view laid out so that file order is row order, in more ``files`` if it is large."""
    orders = table(spark, folder, "orders").select(*ORDER_COLUMNS)
    files = max(files, -(-orders.count() // FILE_ROWS))
    return _laid_out(orders, files)


def _laid_out(orders: DataFrame, files: int) -> DataFrame:
    """The view of the orders by their number. Bare orders are moved and sorted, not their texts."""
    return view_of(orders.repartitionByRange(files, "o_orderkey").sortWithinPartitions("o_orderkey"))


def _arriving(spark: SparkSession, folder: str) -> tuple[str, int]:
    """The ticket view as four pairs of files written one after the other, in row order.

    Large quarters are of more files; returns the folder and the number of files of a quarter.
    """
    path = f"{scratch_path(spark, 'arriving')}/tickets.parquet"
    orders = table(spark, folder, "orders").select(*ORDER_COLUMNS)
    number = F.col("o_orderkey") + 1
    quarter = orders.agg(F.ceil(F.max(number) / 4).alias("n")).first()["n"]
    part_of = F.ceil(number / quarter)
    # As many as the smallest quarter fills, so that all have the same number.
    sizes = [r["count"] for r in orders.groupBy(part_of.alias("part")).count().where("part <= 4").collect()]
    files = max(2, min(sizes, default=0) // FILE_ROWS)
    for part in range(4):
        rows = _laid_out(orders.where(part_of == part + 1), files)
        synthetic.write_export(rows.drop("row_number"), path, "parquet", mode="append")
    return path, files


def _written(spark: SparkSession, folder: str, fmt: str) -> str:
    path = f"{scratch_path(spark, 'export')}/tickets.{fmt}"
    synthetic.write_export(in_row_order(spark, folder).drop("row_number"), path, fmt)
    return path


_READ_BACK = fixed.EXPORT_COLUMNS


@query
def scan_csv(spark, folder):
    rows = read_tickets(spark, _written(spark, folder, "csv"))
    return rows.select("row_number", *[F.col(f"data.{c}").alias(c) for c in _READ_BACK])


SMALL_SPLIT = 64 * 1024


@query
def scan_csv_multiline(spark, folder):
    """Descriptions with line breaks, quotes and commas, cut anywhere by small splits."""
    view = in_row_order(spark, folder)
    number = F.col("row_number").cast("string")
    broken = F.concat(F.lit('says "'), number, F.lit('",\nthen\r\n\n,"'), "description", F.lit('"\n'))
    rows = view.withColumn("description", F.when(F.col("row_number") % 3 > 0, broken).otherwise(""))
    path = f"{scratch_path(spark, 'export')}/tickets.csv"
    synthetic.write_export(rows.drop("row_number"), path, "csv")
    small = {"spark.sql.files.maxPartitionBytes": SMALL_SPLIT, "spark.sql.files.openCostInBytes": 1}
    before = {name: spark.conf.get(name) for name in small}
    stored = scratch_path(spark, "scanned")
    try:
        for name, value in small.items():
            spark.conf.set(name, str(value))
        # Read while the splits are small, as another split size cuts the files elsewhere.
        read_tickets(spark, path).select(
            "row_number", *[F.col(f"data.{c}").alias(c) for c in _READ_BACK]
        ).write.parquet(stored)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return spark.read.parquet(stored)


@query
def scan_parquet(spark, folder):
    rows = read_tickets(spark, _written(spark, folder, "parquet"))
    return rows.select("row_number", *[F.col(f"data.{c}").alias(c) for c in _READ_BACK])


@query
def scan_jsonl_corrupt(spark, folder):
    """Lines with an empty title are broken, those with a padded one are no objects."""
    fields = F.struct(*fixed.EXPORT_COLUMNS)
    line = F.to_json(fields, {"ignoreNullFields": "false"})
    damaged = (
        F.when(F.col("title") == "", F.concat(F.lit("not-json "), line))
        .when(F.col("title").startswith(" "), F.concat(F.lit("["), line, F.lit("]")))
        .otherwise(line)
    )
    path = f"{scratch_path(spark, 'export')}/tickets.jsonl"
    in_row_order(spark, folder).select(damaged.alias("value")).write.text(path)
    rows = read_tickets(spark, path)
    return rows.select(
        "row_number",
        *[
            F.try_variant_get("data", f"$.{c}", "string").alias(c)
            for c in fixed.EXPORT_COLUMNS
        ],
        F.col("read_error").isNotNull().alias("has_read_error"),
    )


@query
def scan_csv_folder(spark, folder):
    """A folder of CSV files with their columns in two orders."""
    path = f"{scratch_path(spark, 'export')}/tickets.csv"
    view = ticket_view(spark, folder)
    for half, columns in enumerate((_READ_BACK, _READ_BACK[::-1])):
        rows = view.where(F.col("row_number") % 2 == half).select(*columns)
        synthetic.write_export(rows, path, "csv", mode="append")
    rows = read_tickets(spark, path)
    return rows.select(*[F.col(f"data.{c}").alias(c) for c in _READ_BACK])


@query
def scan_jsonl_numbers(spark, folder):
    """Identifiers that are JSON numbers keep their text; zero counts as empty."""
    plain = F.col("row_number").cast("string")
    number = F.when(F.col("row_number") % 3 == 0, F.concat(plain, F.lit(".0")))
    number = number.when(F.col("row_number") % 7 == 0, "0e0").otherwise(plain)
    line = F.concat(F.lit('{"ticket_id":'), number, F.lit(',"title":"a title"}'))
    path = f"{scratch_path(spark, 'export')}/tickets.jsonl"
    in_row_order(spark, folder).select(line.alias("value")).write.text(path)
    rows = clean_fields(read_tickets(spark, path), VIEW_RULES)
    return rows.select("row_number", F.col("c_ticket_id").alias("ticket_id"))


@query
def read_error_rows(spark, folder):
    """What the rules say of lines that cannot be read, with the message."""
    fields = F.struct(*fixed.EXPORT_COLUMNS)
    line = F.to_json(fields, {"ignoreNullFields": "false"})
    damaged = F.when(F.col("row_number") % 50 == 0, F.concat(F.lit("["), line)).otherwise(line)
    path = f"{scratch_path(spark, 'export')}/tickets.jsonl"
    in_row_order(spark, folder).select(damaged.alias("value")).write.text(path)
    rows = classify(read_tickets(spark, path), VIEW_RULES)
    found = rows.select("row_number", F.explode("violations").alias("v"))
    return found.where("v.code = 'read_error'").select("row_number", "v.*")


@query
def input_fingerprint(spark, folder):
    files = byte_tree.file_digests(byte_tree.byte_tree(spark, f"{folder}/*.parquet"))
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "length", "digest")


TREE_FILES, TREE_RANGE, TREE_FANOUT = 8, 1_024, 4


def _order_files(spark, folder, priority: Column) -> str:
    """Orders as lines in files by their number, ascending; returns the folder."""
    path = f"{scratch_path(spark, 'order-files')}/orders"
    line = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", priority)
    rows = table(spark, folder, "orders").select(
        "o_orderkey", line.alias("value"), (F.col("o_orderkey") % TREE_FILES).alias("file")
    )
    rows.repartition("file").sortWithinPartitions("file", "o_orderkey").select(
        "value", "file"
    ).write.partitionBy("file").text(path)
    return path


def _file_number(name: str = "path") -> Column:
    return F.regexp_extract(name, "file=([0-9]+)", 1).cast("long").alias("file")


@query
def file_byte_tree(spark, folder):
    """Every node of the hash trees of files whose bytes follow from the orders."""
    path = _order_files(spark, folder, F.col("o_orderpriority"))
    tree = byte_tree.byte_tree(spark, path, TREE_RANGE, TREE_FANOUT)
    return tree.select(_file_number(), "length", "top", "level", "number", "digest")


@query
def changed_byte_ranges(spark, folder):
    """Ranges that differ after some orders got another priority, found from the top of the trees."""
    given = F.col("o_orderpriority")
    urgent = F.concat(F.lit("0"), F.substr(given, F.lit(2)))
    changed = F.when(F.col("o_orderkey") % 997 == 0, urgent).otherwise(given)
    trees = []
    for priority in (given, changed):
        path = _order_files(spark, folder, priority)
        tree = byte_tree.byte_tree(spark, path, TREE_RANGE, TREE_FANOUT)
        trees.append(tree.withColumn("path", _file_number().cast("string")))
    found = byte_tree.changed_ranges(*trees, TREE_RANGE, TREE_FANOUT)
    return found.select(F.col("path").cast("long").alias("file"), "start", "change")


@query
def rows_fingerprint(spark, folder):
    """The order-free fingerprint of the lines, equal for any order of the rows."""
    lines = table(spark, folder, "lineitem")
    given = fingerprint.rows_fingerprint(lines)
    shuffled = fingerprint.rows_fingerprint(lines.repartition(7, "l_partkey"))
    return given.select("fingerprint").join(shuffled, "fingerprint")


@query
def synthetic_tickets(spark, folder):
    indexes = numbering.spread(table(spark, folder, "orders").select("o_orderkey"))
    return synthetic.synthetic_export(indexes, "o_orderkey")


# Runs. Every query makes a run of its own over the tables as they are, and reads what it stored.

_SUMMARY = [
    "status", "dry_run", "incremental", "input_format",
    "total_records", "accepted_records", "quarantined_records", "duplicate_records",
    "loaded_records", "unchanged_records", "resumed_from_offset", "batches_committed",
    "quality_score", "quality_threshold", "quality_gate_passed",
]


class Interrupted(RuntimeError):
    """Raised on purpose to stop a run between two commits."""


def _stop_after(commits: int) -> Callable[[int], None]:
    def check(done: int) -> None:
        if done >= commits:
            raise Interrupted(f"stopped after {done} commits")

    return check


def _batch_store(spark: SparkSession, folder: str) -> TicketStore:
    root, path = scratch_path(spark, "store"), _written(spark, folder, "parquet")
    run_export(spark, path, VIEW_RULES, root, incremental=True)
    return TicketStore(spark, root)


def _stream_store(spark: SparkSession, folder: str) -> TicketStore:
    """A stream over four pairs of files that is stopped after two commits and started again."""
    root, (path, files) = scratch_path(spark, "store"), _arriving(spark, folder)
    schema = spark.read.parquet(path).schema
    options = dict(name="tickets", fmt="parquet", schema=schema, files_per_batch=files)
    try:
        run_stream(spark, path, VIEW_RULES, root, **options, on_commit=_stop_after(2))
    except Exception as error:  # the streaming engine wraps the interruption
        if Interrupted.__name__ not in str(error):
            raise
    run_stream(spark, path, VIEW_RULES, root, **options)
    return TicketStore(spark, root)


def _summary(store: TicketStore) -> DataFrame:
    summary = run_summary(store)
    return summary.select(*_SUMMARY, *[f"quality_dimensions.{d}" for d in fixed.DIMENSIONS])


@query
def run_summary_batch(spark, folder):
    return _summary(_batch_store(spark, folder))


@query
def rerun_idempotent(spark, folder):
    """The same input again: the stored summary comes back and nothing is loaded twice."""
    store = _batch_store(spark, folder)
    path = run_summary(store).first()["input_path"]
    again = run_export(spark, path, VIEW_RULES, store.root, incremental=True)
    loads = store.read("loads").groupBy("run_id").agg(F.count("*").alias("loads"))
    events = store.read("runs").groupBy("run_id").agg(F.count("*").alias("run_events"))
    joined = again.join(loads, "run_id").join(events, "run_id")
    return joined.select(*_SUMMARY, "loads", "run_events")


@query
def dry_run_summary(spark, folder):
    root, path = scratch_path(spark, "store"), _written(spark, folder, "jsonl")
    run_export(spark, path, VIEW_RULES, root, dry_run=True)
    return _summary(TicketStore(spark, root))


@query
def resume_after_failure(spark, folder):
    """A run of several commits that fails after the first and is started again."""
    root, path = scratch_path(spark, "store"), _written(spark, folder, "csv")
    rows = table(spark, folder, "orders").count()
    options = dict(commit_rows=rows // 3 + 1)
    try:
        run_export(spark, path, VIEW_RULES, root, **options, on_commit=_stop_after(1))
    except Interrupted:
        pass
    run_export(spark, path, VIEW_RULES, root, **options)
    return _summary(TicketStore(spark, root))


@query
def resume_with_other_commit_size(spark, folder):
    """Two failed attempts with commits of different sizes, then one without a size."""
    root, path = scratch_path(spark, "store"), _written(spark, folder, "csv")
    rows = table(spark, folder, "orders").count()
    for parts in (5, 3):
        try:
            stop = _stop_after(1)
            run_export(spark, path, VIEW_RULES, root, commit_rows=rows // parts, on_commit=stop)
        except Interrupted:
            pass
    run_export(spark, path, VIEW_RULES, root)
    store = TicketStore(spark, root)
    failed = store.read("runs").where(
        (F.col("status") == fixed.FAILED) & F.col("error_message").contains("stopped after")
    )
    return _summary(store).crossJoin(failed.agg(F.count("*").alias("failed_attempts")))


@query
def export_fingerprint(spark, folder):
    """The identity of an export: values, nulls and order of its rows."""
    return fingerprint.envelope_fingerprint(ticket_envelope(spark, folder))


@query
def stream_ingest_resume(spark, folder):
    return _summary(_stream_store(spark, folder))


@query
def stream_dedup_keys(spark, folder):
    return _stream_store(spark, folder).committed("keys").select("ticket_key", "first_row_number")


@query
def stream_quarantine(spark, folder):
    rejected = _stream_store(spark, folder).committed("quarantine")
    return rejected.select("row_number", codes("violations").alias("codes"), "masked_raw")


@query
def stream_tickets(spark, folder):
    tickets = _stream_store(spark, folder).tickets()
    return tickets.select("source_system", "ticket_id", "title", micros("updated_at").alias("updated_us"))


UNITS = 6


@query
def keyed_first_rows(spark, folder):
    """The first row of every ticket key, found unit by unit from keyed state."""
    rows = _classified(spark, folder, []).where("ticket_ok")
    key = keys.ticket_key(F.col("source_system"), F.col("ticket_id")).alias("ticket_key")
    path = scratch_path(spark, "claims")
    rows.select(key, "row_number").write.parquet(path)
    claims = spark.read.parquet(path)
    size = claims.agg(F.ceil(F.max("row_number") / UNITS).alias("n")).first()["n"]
    found = scratch_path(spark, "first-rows")
    with KeyState(spark, scratch_path(spark, "key-state")) as state:
        for unit in range(UNITS):
            own = claims.where(F.ceil(F.col("row_number") / size) == unit + 1)
            state.first_rows(own, unit * size).write.mode("append").parquet(found)
    return spark.read.parquet(found)


@query
def tickets_of_a_stopped_run(spark, folder):
    """What readers see of a run that stops after two of its three commits."""
    root, path = scratch_path(spark, "store"), _written(spark, folder, "parquet")
    rows = table(spark, folder, "orders").count()
    try:
        stop = _stop_after(2)
        run_export(spark, path, VIEW_RULES, root, commit_rows=rows // 3 + 1, on_commit=stop)
    except Interrupted:
        pass
    tickets = TicketStore(spark, root).tickets()
    return tickets.select("source_system", "ticket_id", "title", micros("updated_at").alias("updated_us"))


SINCE = datetime(1996, 1, 1, tzinfo=timezone.utc)


@query
def find_stored_tickets(spark, folder):
    """Open tickets of low priority since a day, by filters that skip row groups."""
    found = listing.find_tickets(_batch_store(spark, folder).tickets(), "Open", "Low", SINCE)
    return found.select("source_system", "ticket_id", "title", micros("updated_at").alias("updated_us"))


@query
def stored_tickets(spark, folder):
    tickets = _batch_store(spark, folder).tickets()
    return tickets.select("source_system", "ticket_id", "title", micros("updated_at").alias("updated_us"))


@query
def total_tickets(spark, folder):
    return _batch_store(spark, folder).tickets().agg(F.count("*").alias("tickets"))


@query
def stored_quarantine(spark, folder):
    rejected = _batch_store(spark, folder).committed("quarantine")
    return rejected.select("row_number", codes("violations").alias("codes"), "masked_raw")


@query
def run_checkpoint(spark, folder):
    """Runs joined with their checkpoints."""
    store = _batch_store(spark, folder)
    commits = store.read("commits").select("run_id", "batch_id", "row_offset", "batch_index")
    return store.run_states().join(commits, "run_id").select(
        "status", "batch_id", "row_offset", "batch_index"
    )


@query
def run_lineage(spark, folder):
    lineage = _batch_store(spark, folder).read("lineage")
    return lineage.select(
        "source_system", "input_format", "config_hash", "schema_version",
        (F.col("input_size_bytes") > 0).alias("has_size"),
    )


@query
def runs_listing(spark, folder):
    runs = listing.newest_runs(_batch_store(spark, folder).run_states())
    return runs.select("status", "input_format", "dry_run", "incremental", "config_hash")


@query
def metrics_listing(spark, folder):
    metrics = listing.metrics_of(_batch_store(spark, folder).read("quality_metrics"))
    return metrics.select("dimension", score(F.col("score")).alias("score"))


_IDENTITY_LINES = ("# Ticket export", "Input parquet")


@query
def report_markdown(spark, folder):
    """Report lines that do not depend on the clock or on the bytes of the input file."""
    summary = run_summary(_batch_store(spark, folder))
    lines = markdown_report(summary, timings=False).select(
        F.posexplode(F.split("value", "\n")).alias("line_number", "line")
    )
    identity = F.lit(False)
    for start in _IDENTITY_LINES:
        identity = identity | F.col("line").startswith(start)
    return lines.where(~identity)


@query
def report_json(spark, folder):
    report = json_report(run_summary(_batch_store(spark, folder)))
    paths = [
        "total_records", "accepted_records", "quarantined_records", "duplicate_records",
        "quality_score", "quality_dimensions.validity", "quality_gate_passed",
    ]
    return report.select(
        *[F.get_json_object("value", f"$.{p}").alias(p.replace(".", "_")) for p in paths]
    )
