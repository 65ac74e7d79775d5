"""Rule evaluation: one narrow pass over the envelope, then one flag for repeated tickets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskwright import fixed
from deskwright.functions import masking, sql
from deskwright.functions.keys import ticket_identity
from deskwright.operators.repeats import first_rows, repeated_rows
from deskwright.rules import QualityRules
from deskwright.session import scratch_path
from deskwright.sources.readers import as_text, as_time_text, field_reader, raw_line_payload

TICKET_COLUMNS = fixed.EXPORT_COLUMNS
VERDICT_COLUMNS = ["ticket_ok", "missing_count", "invalid", "inconsistent", "stale"]
VIOLATIONS_TYPE = "array<struct<code:string,dimension:string,message:string>>"
_TEXT_FIELDS = [
    "ticket_id", "title", "description", "status", "priority", "requester_email", "assignee",
    "source_system",
]
_TIME_FIELDS = ["created_at", "updated_at", "resolved_at"]


def violation(code: str, message: str) -> str:
    """SQL of one violation; ``message`` is SQL too."""
    dimension = fixed.VIOLATIONS[code]
    return (
        f"named_struct('code', '{code}', 'dimension', '{dimension}', 'message', {message})"
    )


def _listed(pairs: list[tuple[str, str]]) -> str:
    """The violations whose condition holds, in the given order; most rows have none."""
    anything = " OR ".join(f"({condition})" for condition, _ in pairs)
    found = ", ".join(f"CASE WHEN {condition} THEN {value} END" for condition, value in pairs)
    empty = f"CAST(array() AS {VIOLATIONS_TYPE})"
    return f"CASE WHEN {anything} THEN array_compact(array({found})) ELSE {empty} END"


def clean_fields(envelope: DataFrame, rules: QualityRules) -> DataFrame:
    """Cleaned texts (``c_``) and parsed times (``t_``) of the payload, next to the envelope."""
    read = field_reader(envelope)
    names = list(dict.fromkeys([*_TEXT_FIELDS, *_TIME_FIELDS, *rules.required_fields]))
    given = ", ".join(as_text(*read(name)) for name in names)
    times = {name: read(name) for name in _TIME_FIELDS}
    raw = envelope.selectExpr(
        "*",
        f"transform(array({given}), x -> {sql.clean_text('x')}) AS _texts",
        *[f"{as_time_text(*field)} AS r_{name}" for name, field in times.items()],
    )
    plain = {name: sql.plain_timestamp(f"r_{name}") for name in times}
    usual = [f"CASE WHEN {p} THEN try_cast(r_{name} AS TIMESTAMP) END" for name, p in plain.items()]
    unusual = [f"CASE WHEN NOT {p} THEN r_{name} END" for name, p in plain.items()]
    other = f"CASE WHEN x IS NOT NULL THEN {sql.other_timestamp('x')} END"
    columns = [f"_texts[{i}] AS {sql.name(f'c_{name}')}" for i, name in enumerate(names)]
    for i, (name, (value, dtype)) in enumerate(times.items()):
        native = isinstance(dtype, T.TimestampType)
        parsed = value if native else f"coalesce(_usual[{i}], _unusual[{i}])"
        columns.append(f"{parsed} AS t_{name}")
    return raw.selectExpr(
        "*",
        f"array({', '.join(usual)}) AS _usual",
        f"transform(array({', '.join(unusual)}), x -> {other}) AS _unusual",
    ).selectExpr("*", *columns)


def evaluate(envelope: DataFrame, rules: QualityRules) -> DataFrame:
    """Typed, masked ticket, verdict flags and violations of every row. No shuffle.

    Keeps ``row_number``, ``data``, ``line`` and ``read_error``; Catalyst drops what is not used.
    Filters on the result are best applied after it is stored (see ``classify``): Catalyst would
    push them below the expressions they depend on and evaluate those twice.
    """
    kept = [name for name in ("row_number", "data", "line", "read_error") if name in envelope.columns]
    high = {name: bounds[1] for name, bounds in fixed.LENGTH_BOUNDS.items()}

    def missing(name: str) -> str:
        return f"({sql.name(f'c_{name}')} = '')"

    def one_of(column: str, values: tuple[str, ...] | list[str]) -> str:
        return f"{column} IN ({sql.texts(list(values))})" if values else "false"

    mapped = clean_fields(envelope, rules).selectExpr(
        "*",
        "read_error IS NULL AS readable",
        f"{sql.map_value('c_status', rules.status_mapping)} AS n_status",
        f"{sql.map_value('c_priority', rules.priority_mapping)} AS n_priority",
        f"coalesce(nullif(c_source_system, ''), {sql.text(rules.source_system)}) AS n_source",
    )
    refused = {
        "status": f"readable AND NOT {one_of('n_status', rules.allowed_statuses)}",
        "priority": f"readable AND NOT {one_of('n_priority', rules.allowed_priorities)}",
    }
    to_mask = {
        "m_title": "c_title",
        "m_description": "c_description",
        "m_assignee": "c_assignee",
        **{
            f"m_{name}": f"CASE WHEN {condition} THEN coalesce(nullif(n_{name}, ''), '(empty)') END"
            for name, condition in refused.items()
        },
        "m_read_error": "read_error",
    }
    masked = mapped.selectExpr(
        "*", f"transform(array({', '.join(to_mask.values())}), x -> {sql.mask_text('x')}) AS _masked"
    ).selectExpr("*", *[f"_masked[{i}] AS {name}" for i, name in enumerate(to_mask)])

    count = " + ".join(f"cast({missing(name)} AS INT)" for name in rules.required_fields) or "0"
    unresolved = missing("resolved_at")
    # The lower bound of the title holds after masking when it holds before: every match and every
    # replacement is longer than it.
    bounded = [
        sql.length_ok("c_ticket_id", "ticket_id"),
        sql.length_ok("n_source", "source_system"),
        f"char_length(c_title) >= {fixed.LENGTH_BOUNDS['title'][0]}",
        *[
            sql.masked_length_within(f"c_{name}", f"m_{name}", high[name])
            for name in ("title", "description", "assignee")
        ],
    ]
    judged = masked.selectExpr(
        "*",
        f"CASE WHEN readable THEN {count} ELSE 0 END AS missing_count",
        f"{one_of('n_status', fixed.STATUSES)} AND {one_of('n_priority', fixed.PRIORITIES)} "
        "AS enums_ok",
        f"{' AND '.join(f'({b})' for b in bounded)} AS lengths_ok",
        f"t_created_at IS NOT NULL AND t_updated_at IS NOT NULL "
        f"AND ({unresolved} OR t_resolved_at IS NOT NULL) AS times_ok",
        "NOT (coalesce(t_updated_at < t_created_at, false) "
        "OR coalesce(t_resolved_at < t_created_at, false)) AS order_ok",
    ).selectExpr("*", "readable AND enums_ok AND lengths_ok AND times_ok AND order_ok AS ticket_ok")
    cutoff = int(rules.stale_before.timestamp()) * 1_000_000 + rules.stale_before.microsecond
    flagged = judged.selectExpr(
        "*",
        f"ticket_ok AND {one_of('n_status', fixed.FINISHED_STATUSES)} AND {unresolved} "
        "AS lost_resolution",
        f"ticket_ok AND {one_of('n_status', fixed.ACTIVE_STATUSES)} AND NOT {unresolved} "
        "AS early_resolution",
        f"ticket_ok AND t_updated_at < timestamp_micros({cutoff}) AS stale",
        "NOT ticket_ok OR m_status IS NOT NULL OR m_priority IS NOT NULL AS invalid",
    )

    reasons = {
        "created_at is not a timestamp": "t_created_at IS NULL",
        "updated_at is not a timestamp": "t_updated_at IS NULL",
        "resolved_at is not a timestamp": f"NOT {unresolved} AND t_resolved_at IS NULL",
        "a text is shorter or longer than its bounds": "NOT lengths_ok",
        "status or priority is not a known value": "NOT enums_ok",
        "updated_at or resolved_at is earlier than created_at": "NOT order_ok",
    }
    why = ", ".join(f"CASE WHEN {test} THEN '{reason}' END" for reason, test in reasons.items())
    found = [
        ("NOT readable", violation("read_error", "m_read_error")),
        *[
            (
                f"readable AND {missing(name)}",
                violation(
                    "required_fields_missing", sql.text(f"Missing required field: {name}")
                ),
            )
            for name in rules.required_fields
        ],
        *[
            (
                f"m_{name} IS NOT NULL",
                violation(f"invalid_{name}", f"concat('Unsupported {name}: ', m_{name})"),
            )
            for name in refused
        ],
        (
            "readable AND NOT ticket_ok",
            violation("schema_validation", f"concat_ws('; ', {why})"),
        ),
        (
            "lost_resolution",
            violation("resolved_timestamp_missing", "'A finished ticket needs resolved_at'"),
        ),
        (
            "early_resolution",
            violation("active_ticket_has_resolution", "'An active ticket has resolved_at'"),
        ),
        (
            "stale",
            violation(
                "stale_record",
                f"'Older than {rules.timeliness_days} days at the reference time'",
            ),
        ),
    ]
    ticket = {
        "ticket_id": "c_ticket_id",
        "title": "m_title",
        "description": "m_description",
        "status": "n_status",
        "priority": "n_priority",
        "requester_email": sql.email_alias("c_requester_email"),
        "assignee": "nullif(m_assignee, '')",
        "created_at": "t_created_at",
        "updated_at": "t_updated_at",
        "resolved_at": "t_resolved_at",
        "source_system": "n_source",
    }
    return flagged.selectExpr(
        *kept,
        *[f"CASE WHEN ticket_ok THEN {value} END AS {name}" for name, value in ticket.items()],
        "ticket_ok",
        "missing_count",
        "invalid",
        "lost_resolution OR early_resolution AS inconsistent",
        "stale",
        f"{_listed(found)} AS violations",
    )


def masked_payload(
    frame: DataFrame, mask_lists: bool = True, only: Column | None = None
) -> Column:
    """Masked JSON text of a row's payload; null where ``only`` is given and not true."""
    only = F.lit(True) if only is None else only
    dtype = frame.schema["data"].dataType
    if isinstance(dtype, T.StructType):
        read = F.col("data").getField
        return F.when(only, masking.to_payload(masking.mask_struct(read, dtype, mask_lists)))
    unread = masking.mask_struct(
        raw_line_payload(F.col("line")).getField, T.StructType([T.StructField("raw", T.StringType())])
    )
    readable_line = F.when(only & F.col("read_error").isNull(), F.col("line"))
    return F.coalesce(
        masking.mask_json(mask_lists)(readable_line), F.when(only, masking.to_payload(unread))
    )


REPEAT_VIOLATION = ("duplicate_ticket_id", "'The ticket identifier occurs earlier in this input'")


def add_repeat_verdict(frame: DataFrame) -> DataFrame:
    """Append the uniqueness violation and decide acceptance, given a ``duplicate`` flag."""
    extended = F.when(
        F.col("duplicate"), F.array_append("violations", F.expr(violation(*REPEAT_VIOLATION)))
    ).otherwise(F.col("violations"))
    return frame.withColumns(
        {
            "violations": extended,
            "accepted": F.col("ticket_ok")
            & ~F.col("invalid")
            & ~F.col("inconsistent")
            & ~F.col("duplicate"),
        }
    )


def identity_of(frame: DataFrame) -> Column:
    return ticket_identity(frame["source_system"], frame["ticket_id"])


STAGE_COLUMNS = ["row_number", *TICKET_COLUMNS, *VERDICT_COLUMNS, "violations"]


def stage_evaluated(
    envelope: DataFrame, rules: QualityRules, path: str, columns: list[str] | None = None
) -> DataFrame:
    """Evaluate every row once and store the masked result, or only some columns of it."""
    wanted = STAGE_COLUMNS if columns is None else columns
    evaluate(envelope, rules).select(*wanted).write.mode("overwrite").parquet(path)
    return envelope.sparkSession.read.parquet(path)


def flag_staged(staged: DataFrame) -> DataFrame:
    """Duplicate flag, full violation list and acceptance of stored evaluated rows.

    The repeats are written first: usually few, and joined by their true size.
    """
    claims, spark = F.col("ticket_ok"), staged.sparkSession
    firsts = first_rows(staged, identity_of(staged), claims=claims)
    path = scratch_path(spark, "repeats")
    repeated_rows(staged.where(claims), firsts).write.parquet(path)
    return with_repeats(staged, spark.read.parquet(path))


def with_repeats(staged: DataFrame, repeats: DataFrame) -> DataFrame:
    """Verdicts of evaluated rows, given the row numbers of the repeats."""
    marked = repeats.select("row_number", F.lit(True).alias("_repeat"))
    flagged = staged.join(marked, "row_number", "left").withColumn(
        "duplicate", F.coalesce("_repeat", F.lit(False))
    )
    return add_repeat_verdict(flagged.drop("_repeat"))


def classify(
    envelope: DataFrame, rules: QualityRules, columns: list[str] | None = None
) -> DataFrame:
    """Evaluated rows with duplicate flag, full violation list and acceptance.

    The evaluated rows are stored once under the session's shared folder; the flag and whatever
    follows read back only the columns they need. ``columns`` stores just the given ticket columns.
    """
    wanted = None
    if columns is not None:
        needed = ["row_number", "ticket_id", "source_system", *columns, *VERDICT_COLUMNS]
        wanted = list(dict.fromkeys([*needed, "violations"]))
    path = scratch_path(envelope.sparkSession, "classified")
    return flag_staged(stage_evaluated(envelope, rules, path, wanted))
