"""SQL counterparts of the named queries, in the dialect of DuckDB.

Written independently of the DataFrame code: window functions instead of joins, TIMESTAMPTZ casts
instead of the parser, list functions instead of word-wise masking.
"""

from __future__ import annotations

from deskwright import fixed
from deskwright.catalogue.queries import EVENT_DAYS, OFFSET, TREE_FANOUT, TREE_FILES, TREE_RANGE
from deskwright.catalogue.ticket_view import TICKET_VIEW, VIEW_RULES

_SPACE = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_EMAIL = r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
_PHONE = r"(?:\B\+|\b)\d[\d .()\-]{7,}\d\b"
_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:\d{2})$"
_REQUIRED = list(VIEW_RULES.required_fields)
_THRESHOLD = VIEW_RULES.quality_threshold


def _clean(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{_SPACE}+', ' ', 'g'), ' ')"


def _alias(x: str) -> str:
    return f"substr(sha256(lower({x})), 1, 16) || '@masked.invalid'"


def _mask(x: str) -> str:
    parts = f"regexp_split_to_array({x}, '{_EMAIL}')"
    found = f"regexp_extract_all({x}, '{_EMAIL}')"
    joined = (
        f"array_to_string(list_transform(range(1, len({parts}) + 1), lambda i: "
        f"{parts}[i] || CASE WHEN i <= len({found}) THEN {_alias(f'{found}[i]')} ELSE '' END), '')"
    )
    return f"regexp_replace({joined}, '{_PHONE}', '[PHONE]', 'g')"


def _instant(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches({x}, '{_ISO}') THEN epoch_us(TRY_CAST({x} AS TIMESTAMPTZ)) END"
    )


def _map(x: str, mapping: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE lower({x}) {cases} ELSE {x} END"


def _in(x: str, values) -> str:
    return f"{x} IN ({', '.join(repr(v) for v in values)})"


_VIEW = f"tv AS ({TICKET_VIEW.format(orders='orders')})"
_NORM = f"""norm AS (
  SELECT row_number, {_clean('ticket_id')} AS ticket_id, {_clean('title')} AS title,
    {_clean('description')} AS description, {_clean('status')} AS given_status,
    {_clean('priority')} AS given_priority, {_clean('requester_email')} AS requester_email,
    {_clean('assignee')} AS assignee, {_clean('created_at')} AS created_text,
    {_clean('updated_at')} AS updated_text, {_clean('resolved_at')} AS resolved_text,
    coalesce(nullif({_clean('source_system')}, ''), '{VIEW_RULES.source_system}') AS source_system,
    {_instant('created_at')} AS created_us, {_instant('updated_at')} AS updated_us,
    {_instant('resolved_at')} AS resolved_us
  FROM tv),
mapped AS (
  SELECT *, {_map('given_status', VIEW_RULES.status_mapping)} AS status,
    {_map('given_priority', VIEW_RULES.priority_mapping)} AS priority FROM norm),
judged AS (
  SELECT *, NOT {_in('status', VIEW_RULES.allowed_statuses)} AS bad_status,
    NOT {_in('priority', VIEW_RULES.allowed_priorities)} AS bad_priority,
    {_in('status', VIEW_RULES.allowed_statuses)} AND {_in('priority', VIEW_RULES.allowed_priorities)}
      AND length(ticket_id) BETWEEN 1 AND 100 AND length(title) BETWEEN 3 AND 500
      AND length(description) <= 20000 AND length(assignee) <= 200
      AND length(source_system) BETWEEN 2 AND 100
      AND created_us IS NOT NULL AND updated_us IS NOT NULL
      AND (resolved_text = '' OR resolved_us IS NOT NULL)
      AND coalesce(updated_us >= created_us, true) AND coalesce(resolved_us >= created_us, true)
      AS ticket_ok,
    CAST(ticket_id = '' AS INT) + CAST(title = '' AS INT) + CAST(given_status = '' AS INT)
      + CAST(given_priority = '' AS INT) + CAST(requester_email = '' AS INT)
      + CAST(created_text = '' AS INT) + CAST(updated_text = '' AS INT) AS missing_count
  FROM mapped),
flagged AS (
  SELECT *, ticket_ok AND status IN ('Resolved', 'Closed') AND resolved_text = '' AS lost,
    ticket_ok AND status IN ('Open', 'In Progress', 'Pending') AND resolved_text <> '' AS early,
    ticket_ok AND updated_us < epoch_us(TIMESTAMPTZ '{VIEW_RULES.stale_before.isoformat()}') AS stale,
    NOT ticket_ok OR bad_status OR bad_priority AS invalid,
    source_system || ':' || ticket_id AS identity
  FROM judged),
cls AS (
  SELECT *, lost OR early AS inconsistent,
    ticket_ok AND row_number() OVER (PARTITION BY ticket_ok, identity ORDER BY row_number) > 1 AS duplicate
  FROM flagged),
done AS (
  SELECT *, ticket_ok AND NOT invalid AND NOT inconsistent AND NOT duplicate AS accepted,
    array_to_string(list_filter(list_concat(
      {{listed_missing}},
      [CASE WHEN bad_status THEN 'invalid_status' END, CASE WHEN bad_priority THEN 'invalid_priority' END,
       CASE WHEN NOT ticket_ok THEN 'schema_validation' END,
       CASE WHEN lost THEN 'resolved_timestamp_missing' END,
       CASE WHEN early THEN 'active_ticket_has_resolution' END,
       CASE WHEN stale THEN 'stale_record' END,
       CASE WHEN duplicate THEN 'duplicate_ticket_id' END]), lambda c: c IS NOT NULL), ',') AS codes
  FROM cls)"""
_TEXT_OF = {
    "ticket_id": "ticket_id", "title": "title", "status": "given_status",
    "priority": "given_priority", "requester_email": "requester_email",
    "created_at": "created_text", "updated_at": "updated_text",
}
_NORM = _NORM.replace(
    "{listed_missing}",
    "[" + ", ".join(
        f"CASE WHEN {_TEXT_OF[n]} = '' THEN 'required_fields_missing' END" for n in _REQUIRED
    ) + "]",
)
_MEASURES = """measures AS (
  SELECT count(*) AS total_records, count(*) FILTER (accepted) AS accepted_records,
    count(*) FILTER (NOT accepted) AS quarantined_records,
    count(*) FILTER (duplicate) AS duplicate_records,
    CAST(sum(missing_count) AS BIGINT) AS missing_values, count(*) FILTER (invalid) AS invalid_records,
    count(*) FILTER (inconsistent) AS inconsistent_records, count(*) FILTER (stale) AS stale_records
    {key} FROM done {group})"""
_DIMENSIONS = f"""
    round((total_records * {len(_REQUIRED)} - missing_values) / (total_records * {len(_REQUIRED)}), 6) AS completeness,
    round((total_records - duplicate_records) / total_records, 6) AS uniqueness,
    round((total_records - invalid_records) / total_records, 6) AS validity,
    round((total_records - inconsistent_records) / total_records, 6) AS consistency,
    round((total_records - stale_records) / total_records, 6) AS timeliness"""
_OVERALL = "round((completeness + uniqueness + validity + consistency + timeliness) / 5, 6) AS quality_score"
_SCORED = f"scored AS (SELECT *, {_OVERALL} FROM (SELECT *, {_DIMENSIONS} FROM measures))"


def _view(select: str) -> str:
    return f"WITH {_VIEW} {select}"


def _done(select: str) -> str:
    return f"WITH {_VIEW}, {_NORM} {select}"


def _measured(select: str, key: str = "", group: str = "") -> str:
    measures = _MEASURES.replace("{key}", key).replace("{group}", group)
    return f"WITH {_VIEW}, {_NORM}, {measures}, {_SCORED} {select}"


def _ticket() -> str:
    """Masked ticket columns of a row of ``done``."""
    return (
        f"ticket_id, {_mask('title')} AS title, {_mask('description')} AS description, status, "
        f"priority, {_alias('requester_email')} AS requester_email, "
        f"nullif({_mask('assignee')}, '') AS assignee, source_system, "
        f"created_us AS created_at_us, updated_us AS updated_at_us, resolved_us AS resolved_at_us"
    )


def _json(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'null' ELSE '\"' || {x} || '\"' END"


def _payload() -> str:
    """Masked payload of a row of the ticket view; its texts need no JSON escapes."""
    parts = []
    for name in [
        "ticket_id", "title", "description", "status", "priority", "requester_email",
        "assignee", "created_at", "updated_at", "resolved_at", "source_system",
    ]:
        if name == "requester_email":
            value = (
                f"CASE WHEN contains(v.{name}, '@') THEN {_alias(f'trim(v.{name})')} "
                f"WHEN v.{name} IS NOT NULL THEN '[REDACTED]' END"
            )
        else:
            value = _mask(f"v.{name}")
        parts.append(f"'\"{name}\":' || {_json(f'({value})')}")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


_SHIPMENTS = """ship AS (
  SELECT 'desk-' || CAST(o_custkey % 4 AS VARCHAR) AS source_system,
    'SD-' || CAST(l_orderkey AS VARCHAR) AS ticket_id,
    'Shipment line ' || CAST(l_linenumber AS VARCHAR) AS title, epoch_us(l_shipdate) AS updated_us
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC) AS n
        FROM lineitem) l JOIN orders ON o_orderkey = l_orderkey WHERE n = 1)"""


def _load(newer: str, select: str) -> str:
    return f"""WITH {_VIEW}, {_NORM}, {_SHIPMENTS},
old AS (SELECT source_system, ticket_id, {_mask('title')} AS title, updated_us FROM done WHERE accepted),
acts AS (
  SELECT coalesce(o.source_system, s.source_system) AS source_system,
    coalesce(o.ticket_id, s.ticket_id) AS ticket_id, o.title AS old_title, s.title AS new_title,
    o.updated_us AS old_us, s.updated_us AS new_us,
    CASE WHEN o.ticket_id IS NULL THEN 'insert' WHEN s.ticket_id IS NULL THEN 'kept'
         WHEN {newer} THEN 'update' ELSE 'unchanged' END AS action
  FROM old o FULL OUTER JOIN ship s ON o.source_system = s.source_system AND o.ticket_id = s.ticket_id),
final AS (
  SELECT source_system, ticket_id,
    CASE WHEN action IN ('insert', 'update') THEN new_title ELSE old_title END AS title,
    CASE WHEN action IN ('insert', 'update') THEN new_us ELSE old_us END AS updated_us, action
  FROM acts)
{select}"""


_LATEST = """(SELECT user_id, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n
  FROM events WHERE {condition}) WHERE n = 1)"""
_GROUP = "event_type IN ('view', 'click', 'error')"

def _read(csv: bool) -> str:
    """All columns as a scan gives them; empty CSV values are null."""
    return ", ".join(f"nullif({c}, '') AS {c}" if csv else c for c in fixed.EXPORT_COLUMNS)


def _summary(
    fmt: str, dry: bool = False, incremental: bool = True, batches: str | None = None,
    extra: str = "",
) -> str:
    index = batches or f"CAST(ceil(total_records / {VIEW_RULES.batch_size}) AS BIGINT)"
    return _measured(
        f"""SELECT 'COMPLETED' AS status, {str(dry).lower()} AS dry_run,
  {str(incremental).lower()} AS incremental, '{fmt}' AS input_format, total_records,
  accepted_records, quarantined_records, duplicate_records,
  {'CAST(0 AS BIGINT)' if dry else 'accepted_records'} AS loaded_records, CAST(0 AS BIGINT) AS unchanged_records,
  total_records AS resumed_from_offset, {index} AS batches_committed,
  quality_score, CAST({_THRESHOLD} AS DOUBLE) AS quality_threshold,
  quality_score >= {_THRESHOLD} AS quality_gate_passed{extra} FROM scored"""
    )


_ALL_DIMENSIONS = ", completeness, uniqueness, validity, consistency, timeliness"
_EVENT_USER = "CAST(user_id AS VARCHAR)"
_EVENT_ALIAS = _alias(f"'User' || {_EVENT_USER} || '@Example.invalid'")
_EVENT_NOTE = f"'from User' || {_EVENT_USER} || '@Example.invalid at 202-555-0' || {_EVENT_USER}"
_EVENT_PROPS = "replace(replace(props, '\\', '\\\\'), '\"', '\\\"')"
_EVENT_PAYLOAD = f"""
SELECT event_id AS row_number, '{{"event_id":' || CAST(event_id AS VARCHAR) || ',"email":"' || {_EVENT_ALIAS}
  || '","note":"' || {_mask('note')} || '","nested":{{"phone":"[REDACTED]","mobile":'
  || CASE WHEN event_type = 'click' THEN '"' || {_EVENT_ALIAS} || '"' ELSE 'null' END
  || ',"props":"' || {_EVENT_PROPS} || '"}},"tags":["' || {_mask("'User' || " + _EVENT_USER + " || '@Example.invalid'")}
  || '","plain"]}}' AS masked_raw
FROM (SELECT *, {_EVENT_NOTE} AS note FROM events)"""


def _report_lines() -> str:
    def count(column: str, what: str) -> str:
        return f"'* ' || format('{{:,}}', {column}) || ' {what}'"

    # By line number; line 0 names the run and line 3 its input.
    values = {
        1: "''",
        2: "'Run completed, mode: newer rows win.'",
        4: f"CASE WHEN quality_score >= {_THRESHOLD} THEN 'PASS' ELSE 'FAIL' END || ': the score is ' "
        f"|| printf('%.2f%%', 100 * quality_score) || ', wanted are {100 * _THRESHOLD:.2f}% or more.'",
        5: "''",
        6: count("total_records", "rows read"),
        7: count("accepted_records", "rows accepted"),
        8: count("quarantined_records", "rows in quarantine"),
        9: count("duplicate_records", "rows whose ticket had come before"),
        10: count("accepted_records", "tickets written"),
        11: "'* 0 tickets already as new in the store'",
        12: "''",
        13: "'Completeness | ' || printf('%.2f%%', 100 * completeness)",
        14: "'Uniqueness | ' || printf('%.2f%%', 100 * uniqueness)",
        15: "'Validity | ' || printf('%.2f%%', 100 * validity)",
        16: "'Consistency | ' || printf('%.2f%%', 100 * consistency)",
        17: "'Timeliness | ' || printf('%.2f%%', 100 * timeliness)",
    }
    rows = " UNION ALL ".join(
        f"SELECT {n} AS line_number, {v} AS line FROM scored" for n, v in values.items()
    )
    return _measured(rows)


_HEX = "CAST('0x' || substr(sha256('20260804:' || CAST(o_orderkey AS VARCHAR)), {at}, 8) AS BIGINT) / 4294967296.0"
_ISO_OF = "strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%S') || '+00:00'"
_SYNTHETIC = f"""WITH draws AS (
  SELECT o_orderkey AS i, o_orderkey > 0 AND {_HEX.format(at=1)} < 0.01 AS repeats,
    CASE WHEN {_HEX.format(at=9)} < 0.02 THEN o_orderkey % 4 ELSE -1 END AS defect FROM orders),
timed AS (
  SELECT *, ['Open', 'In Progress', 'Pending', 'Resolved', 'Closed'][i % 5 + 1] AS st,
    1761955200000000 + (i * 37 % 70001) * 60000000 AS c,
    1761955200000000 + (i * 37 % 70001) * 60000000 + (9 + i % 331) * 60000000 AS u FROM draws)
SELECT i + 1 AS row_number, 'SD-' || lpad(CAST(i - CAST(repeats AS INT) AS VARCHAR), 9, '0') AS ticket_id,
  CASE WHEN defect = 0 THEN '' ELSE 'Made-up problem, type ' || CAST(i % 613 AS VARCHAR) END AS title,
  'Nobody reported this as number ' || CAST(i AS VARCHAR) || ', and nobody answers +1-202-555-'
    || lpad(CAST(i % 10000 AS VARCHAR), 4, '0') AS description,
  CASE WHEN defect = 1 THEN 'Mystery' ELSE st END AS status,
  ['Low', 'Medium', 'High', 'Critical'][i % 4 + 1] AS priority,
  'nobody.' || CAST(i % 7919 AS VARCHAR) || '@example.invalid' AS requester_email,
  'team-' || CAST(i % 89 AS VARCHAR) AS assignee,
  {_ISO_OF.format(us='c')} AS created_at,
  CASE WHEN defect = 2 THEN 'not-a-date' ELSE {_ISO_OF.format(us='u')} END AS updated_at,
  CASE WHEN defect = 3 THEN {_ISO_OF.format(us='c - 3600000000')}
       WHEN st IN ('Resolved', 'Closed') THEN {_ISO_OF.format(us='u')} ELSE '' END AS resolved_at,
  'made-up-desk' AS source_system
FROM timed"""

_RUN_INPUT = "sha256(source_system || ':' || CAST(count(*) AS VARCHAR) || ':' || CAST(CAST(sum(row_number) AS BIGINT) AS VARCHAR))"
_STORED = f"SELECT source_system, ticket_id, {_mask('title')} AS title, updated_us FROM done WHERE accepted"
_QUARANTINE = (
    f"SELECT d.row_number, d.codes, {_payload()} AS masked_raw "
    "FROM done d JOIN tv v ON v.row_number = d.row_number WHERE NOT d.accepted"
)

_BROKEN = (
    "CASE WHEN row_number % 3 > 0 THEN 'says \"' || CAST(row_number AS VARCHAR) || '\",' || chr(10) || 'then' "
    "|| chr(13) || chr(10) || chr(10) || ',\"' || description || '\"' || chr(10) END"
)
_MULTILINE = ", ".join(
    f"{_BROKEN} AS description" if c == "description" else f"nullif({c}, '') AS {c}"
    for c in fixed.EXPORT_COLUMNS
)

_FIRST_ROWS = (
    "SELECT sha256(identity) AS ticket_key, min(row_number) AS first_row_number "
    "FROM done WHERE ticket_ok GROUP BY identity"
)

def _order_bodies(last: str, prefix: str) -> str:
    """Files of order lines and their byte ranges; the lines are ASCII, so bytes are characters."""
    line = f"concat_ws(',', o_orderkey, o_custkey, o_orderstatus, {last})"
    return (
        f"{prefix}files AS (SELECT o_orderkey % {TREE_FILES} AS file, "
        f"string_agg({line} || chr(10), '' ORDER BY o_orderkey) AS body FROM orders GROUP BY 1), "
        f"{prefix}ranges AS (SELECT file, length(body) AS length, number, "
        f"substr(body, number * {TREE_RANGE} + 1, {TREE_RANGE}) AS part FROM (SELECT *, "
        f"unnest(range((length(body) + {TREE_RANGE} - 1) // {TREE_RANGE})) AS number "
        f"FROM {prefix}files))"
    )


_URGENT = (
    "CASE WHEN o_orderkey % 997 = 0 THEN '0' || substr(o_orderpriority, 2) ELSE o_orderpriority END"
)


def _tree() -> str:
    """Nodes over ``ranges``, level by level until a file has one."""
    return (
        "tree AS (SELECT file, length, 0 AS level, number, sha256(part) AS digest, "
        "count(*) OVER (PARTITION BY file) AS n FROM ranges UNION ALL "
        f"SELECT file, length, level, number, digest, (n + {TREE_FANOUT} - 1) // {TREE_FANOUT} AS n "
        f"FROM (SELECT file, length, level + 1 AS level, number // {TREE_FANOUT} AS number, "
        "sha256(string_agg(digest, '' ORDER BY number)) AS digest, n FROM tree WHERE n > 1 "
        f"GROUP BY file, length, level, number // {TREE_FANOUT}, n))"
    )


ORACLES: dict[str, str] = {
    "clean_text": _view(
        "SELECT row_number, "
        + ", ".join(f"{_clean(c)} AS {c}" for c in ("title", "status", "priority", "assignee"))
        + " FROM tv"
    ),
    "messages_of_bad_values": _done(
        " UNION ALL ".join(
            f"SELECT row_number, 'invalid_{c}' AS code, 'validity' AS dimension, "
            f"'Unsupported {c}: ' || coalesce(nullif({c}, ''), '(empty)') AS message "
            f"FROM done WHERE bad_{c}"
            for c in ("status", "priority")
        )
    ),
    "truncated_texts": (
        f"SELECT doc_id, substr(text, 1, {fixed.RAW_LINE_CHARS}) AS raw, "
        f"coalesce(nullif({_clean('source')}, ''), '(empty)') AS source FROM documents"
    ),
    "clean_text_conversations": f"SELECT conv_id, turn, {_clean('text')} AS text FROM conversations",
    "normalize_status_priority": _done("SELECT row_number, status, priority FROM done"),
    "parse_ticket_timestamps": _done(
        "SELECT row_number, created_us AS created_at_us, updated_us AS updated_at_us, "
        "resolved_us AS resolved_at_us, nullif(assignee, '') AS assignee, source_system FROM done"
    ),
    "mask_email": _view(
        f"SELECT row_number, {_alias('trim(requester_email)')} AS requester_email FROM tv"
    ),
    "mask_text_tickets": _view(f"SELECT row_number, {_mask('description')} AS description FROM tv"),
    "mask_text_documents": f"SELECT doc_id, {_mask('text')} AS text FROM documents",
    "mask_payload": _EVENT_PAYLOAD,
    "mask_payload_json": _EVENT_PAYLOAD,
    "ticket_key": _view(
        "SELECT row_number, sha256(source_system || ':' || ticket_id) AS ticket_key FROM tv"
    ),
    "run_key_by_source": _view(
        f"SELECT source_system, sha256({_RUN_INPUT} || ':{VIEW_RULES.config_hash}:0:1') AS run_key, "
        f"sha256({_RUN_INPUT} || ':{VIEW_RULES.config_hash}:1:1') AS dry_run_key "
        "FROM tv GROUP BY source_system"
    ),
    "format_detection": (
        "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'csv' WHEN 1 THEN 'jsonl' "
        "WHEN 2 THEN 'jsonl' WHEN 3 THEN 'parquet' END AS format FROM orders"
    ),
    "required_fields_missing": _done(
        "SELECT row_number, array_to_string(list_filter(["
        + ", ".join(f"CASE WHEN {_TEXT_OF[n]} = '' THEN '{n}' END" for n in _REQUIRED)
        + "], lambda c: c IS NOT NULL), ',') AS missing, missing_count AS n_missing FROM done"
    ),
    "rule_invalid_status_priority": _done(
        "SELECT row_number, bad_status AS invalid_status, bad_priority AS invalid_priority FROM done"
    ),
    "rule_schema_validation": _done(
        "SELECT row_number, ticket_ok, NOT ticket_ok AS violated FROM done"
    ),
    "rule_consistency": _done(
        "SELECT row_number, lost AS lost_resolution, early AS early_resolution FROM done"
    ),
    "rule_stale_tickets": _done("SELECT row_number, stale FROM done"),
    "rule_stale_events": (
        f"SELECT event_id, ts < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL {EVENT_DAYS} DAY AS stale "
        "FROM events"
    ),
    "row_violations": _done("SELECT row_number, codes FROM done"),
    "duplicate_flags": _done("SELECT row_number, duplicate FROM done"),
    "first_row_per_key": _done(
        "SELECT sha256(identity) AS ticket_key, min(row_number) AS first_row_number "
        "FROM done WHERE ticket_ok GROUP BY identity"
    ),
    "dedup_documents": (
        f"SELECT doc_id, row_number() OVER (PARTITION BY {_clean('text')} ORDER BY doc_id) > 1 "
        "AS duplicate FROM documents"
    ),
    "accepted_tickets": _done(f"SELECT row_number, {_ticket()} FROM done WHERE accepted"),
    "quarantined_tickets": _done(_QUARANTINE),
    "row_scores": _done(
        f"SELECT row_number, round(1 - missing_count / {len(_REQUIRED)}, 6) AS completeness, "
        "CAST(NOT duplicate AS DOUBLE) AS uniqueness, CAST(NOT invalid AS DOUBLE) AS validity, "
        "CAST(NOT inconsistent AS DOUBLE) AS consistency, CAST(NOT stale AS DOUBLE) AS timeliness "
        "FROM done"
    ),
    "quality_dimensions": _measured(
        "SELECT completeness, uniqueness, validity, consistency, timeliness, quality_score FROM scored"
    ),
    "quality_by_source": _measured(
        "SELECT source, total_records, completeness, uniqueness, validity, consistency, timeliness, "
        "quality_score FROM scored",
        ", CASE WHEN ticket_ok THEN source_system ELSE '(no ticket)' END AS source",
        "GROUP BY source",
    ),
    "run_counters": _measured("SELECT * FROM measures"),
    "merged_counters": _measured("SELECT * FROM measures"),
    "quality_gate": _measured(
        f"SELECT quality_score, CAST({_THRESHOLD} AS DOUBLE) AS quality_threshold, "
        f"quality_score >= {_THRESHOLD} AS quality_gate_passed, quality_score >= 0.9 "
        "AS strict_gate_passed FROM scored"
    ),
    "quality_metrics_long": _measured(
        "UNPIVOT (SELECT completeness, uniqueness, validity, consistency, timeliness FROM scored) "
        "ON completeness, uniqueness, validity, consistency, timeliness "
        "INTO NAME dimension VALUE score"
    ),
    "violation_histogram": _done(
        "SELECT code, CASE WHEN code = 'required_fields_missing' THEN 'completeness' "
        "WHEN code = 'duplicate_ticket_id' THEN 'uniqueness' WHEN code = 'stale_record' "
        "THEN 'timeliness' WHEN code IN ('resolved_timestamp_missing', 'active_ticket_has_resolution') "
        "THEN 'consistency' ELSE 'validity' END AS dimension, count(*) AS violations "
        "FROM (SELECT unnest(string_split(codes, ',')) AS code FROM done WHERE codes <> '') GROUP BY ALL"
    ),
    "tickets_by_source": _done(
        "SELECT source_system, count(*) AS tickets FROM done WHERE accepted GROUP BY source_system"
    ),
    "find_tickets": _done(
        "SELECT ticket_id, source_system, updated_us FROM done WHERE accepted AND status = 'Resolved' "
        "AND priority = 'High' AND updated_us >= epoch_us(TIMESTAMPTZ '1998-01-01T00:00:00Z')"
    ),
    "quarantine_sample": _done(
        "SELECT row_number, codes FROM done WHERE NOT accepted ORDER BY row_number LIMIT 50"
    ),
    "load_incremental": _load("s.updated_us > o.updated_us", "SELECT * FROM final"),
    "load_into_buckets": _load(
        "s.updated_us > o.updated_us", "SELECT source_system, ticket_id, title, updated_us FROM final"
    ),
    "load_insert_only": _load("false", "SELECT * FROM final"),
    "load_counts": _load(
        "s.updated_us > o.updated_us",
        "SELECT count(*) FILTER (action IN ('insert', 'update')) AS loaded_records, "
        "count(*) FILTER (action = 'unchanged') AS unchanged_records FROM final",
    ),
    "insert_if_absent": _load(
        "false", "SELECT source_system, ticket_id, title FROM final WHERE action = 'insert'"
    ),
    "load_incremental_events": (
        f"WITH o AS {_LATEST.format(condition=_GROUP)}, n AS {_LATEST.format(condition='NOT ' + _GROUP)} "
        "SELECT coalesce(o.user_id, n.user_id) AS user_id, "
        "CASE WHEN o.user_id IS NULL OR n.ts > o.ts THEN n.event_id ELSE o.event_id END AS event_id, "
        "epoch_us(CASE WHEN o.user_id IS NULL OR n.ts > o.ts THEN n.ts ELSE o.ts END) AS ts_us, "
        "CASE WHEN o.user_id IS NULL OR n.ts > o.ts THEN n.value ELSE o.value END AS value, "
        "CASE WHEN o.user_id IS NULL THEN 'insert' WHEN n.user_id IS NULL THEN 'kept' "
        "WHEN n.ts > o.ts THEN 'update' ELSE 'unchanged' END AS action "
        "FROM o FULL OUTER JOIN n ON o.user_id = n.user_id"
    ),
    "batch_assignment": _view(
        f"SELECT CAST(floor((row_number - 1) / {VIEW_RULES.batch_size}) AS BIGINT) + 1 AS batch_index, "
        "count(*) AS n_rows, min(row_number) AS first_row, max(row_number) AS last_row FROM tv GROUP BY 1"
    ),
    "offset_skip": _view(f"SELECT row_number, ticket_id FROM tv WHERE row_number > {OFFSET}"),
    "scan_csv_multiline": _view(f"SELECT row_number, {_MULTILINE} FROM tv"),
    "scan_csv": _view(f"SELECT row_number, {_read(csv=True)} FROM tv"),
    "scan_parquet": _view(f"SELECT row_number, {_read(csv=False)} FROM tv"),
    "scan_jsonl_corrupt": _view(
        "SELECT row_number, "
        + ", ".join(
            f"CASE WHEN title = '' OR title LIKE ' %' THEN NULL ELSE {c} END AS {c}"
            for c in fixed.EXPORT_COLUMNS
        )
        + ", title = '' OR title LIKE ' %' AS has_read_error FROM tv"
    ),
    "scan_csv_folder": _view(f"SELECT {_read(csv=True)} FROM tv"),
    "scan_jsonl_numbers": _view(
        "SELECT row_number, CASE WHEN row_number % 3 = 0 THEN CAST(row_number AS VARCHAR) || '.0' "
        "WHEN row_number % 7 = 0 THEN '' ELSE CAST(row_number AS VARCHAR) END AS ticket_id FROM tv"
    ),
    "read_error_rows": _view(
        "SELECT row_number, 'read_error' AS code, 'validity' AS dimension, "
        "'line is not valid JSON' AS message FROM tv WHERE row_number % 50 = 0"
    ),
    "mask_payload_maps": (
        "SELECT o_orderkey, '{\"phone\":\"[REDACTED]\",\"count\":' || CAST(o_orderkey AS VARCHAR) "
        "|| '}' AS masked FROM orders"
    ),
    "synthetic_tickets": _SYNTHETIC,
    "run_summary_batch": _summary("parquet", extra=_ALL_DIMENSIONS),
    "rerun_idempotent": _summary("parquet", extra=", CAST(1 AS BIGINT) AS loads, CAST(3 AS BIGINT) AS run_events"),
    "dry_run_summary": _summary("jsonl", dry=True, incremental=False, extra=_ALL_DIMENSIONS),
    "resume_after_failure": _summary("csv", incremental=False, extra=_ALL_DIMENSIONS),
    "resume_with_other_commit_size": _summary(
        "csv", incremental=False, extra=_ALL_DIMENSIONS + ", CAST(2 AS BIGINT) AS failed_attempts"
    ),
    "export_fingerprint": _view(
        "SELECT sha256(CAST(count(*) AS VARCHAR) || ':' || CAST(sum(CAST('0x' || substr(h, 1, 15) "
        "AS BIGINT)) AS VARCHAR) || ':' || CAST(sum(CAST('0x' || substr(h, 16, 15) AS BIGINT)) "
        "AS VARCHAR)) AS fingerprint FROM (SELECT sha256(concat_ws(',', "
        + ", ".join(
            f"coalesce(CAST(length({v}) AS VARCHAR) || ':' || {v}, 'N')"
            for v in (
                "CAST(row_number AS VARCHAR)",
                "'" + ",".join(fixed.EXPORT_COLUMNS) + "'",
                *fixed.EXPORT_COLUMNS,
                "CAST(NULL AS VARCHAR)",
            )
        )
        + ")) AS h FROM tv)"
    ),
    "file_byte_tree": (
        f"WITH RECURSIVE {_order_bodies('o_orderpriority', '')}, {_tree()} "
        "SELECT file, length, CAST(max(level) OVER (PARTITION BY file) AS INTEGER) AS top, "
        "CAST(level AS INTEGER) AS level, number, digest FROM tree"
    ),
    "changed_byte_ranges": (
        f"WITH {_order_bodies('o_orderpriority', 'old_')}, "
        f"{_order_bodies(_URGENT, 'new_')} "
        f"SELECT file, number * {TREE_RANGE} AS start, 'changed' AS change "
        "FROM old_ranges o JOIN new_ranges n USING (file, number) WHERE o.part <> n.part"
    ),
    "stream_ingest_resume": _summary("parquet", incremental=False, extra=_ALL_DIMENSIONS),
    "stream_dedup_keys": _done(_FIRST_ROWS),
    "keyed_first_rows": _done(_FIRST_ROWS),
    "tickets_of_a_stopped_run": _done(
        f"{_STORED} AND row_number <= 2 * ((SELECT count(*) FROM orders) // 3 + 1)"
    ),
    "find_stored_tickets": _done(
        f"{_STORED} AND status = 'Open' AND priority = 'Low' "
        "AND updated_us >= epoch_us(TIMESTAMPTZ '1996-01-01T00:00:00+00:00')"
    ),
    "stream_quarantine": _done(_QUARANTINE),
    "stream_tickets": _done(_STORED),
    "stored_tickets": _done(_STORED),
    "stored_quarantine": _done(_QUARANTINE),
    "total_tickets": _done("SELECT count(*) AS tickets FROM done WHERE accepted"),
    "run_checkpoint": _measured(
        "SELECT 'COMPLETED' AS status, CAST(0 AS BIGINT) AS batch_id, total_records AS row_offset, "
        f"CAST(ceil(total_records / {VIEW_RULES.batch_size}) AS BIGINT) AS batch_index FROM scored"
    ),
    "run_lineage": (
        f"SELECT '{VIEW_RULES.source_system}' AS source_system, 'parquet' AS input_format, "
        f"'{VIEW_RULES.config_hash}' AS config_hash, {VIEW_RULES.schema_version} AS schema_version, "
        "count(*) > 0 AS has_size FROM orders"
    ),
    "runs_listing": (
        "SELECT 'COMPLETED' AS status, 'parquet' AS input_format, false AS dry_run, "
        f"true AS incremental, '{VIEW_RULES.config_hash}' AS config_hash FROM orders LIMIT 1"
    ),
    "metrics_listing": _measured(
        "UNPIVOT (SELECT completeness, uniqueness, validity, consistency, timeliness FROM scored) "
        "ON completeness, uniqueness, validity, consistency, timeliness "
        "INTO NAME dimension VALUE score"
    ),
    "report_markdown": _report_lines(),
    "report_json": _measured(
        "SELECT CAST(total_records AS VARCHAR) AS total_records, "
        "CAST(accepted_records AS VARCHAR) AS accepted_records, "
        "CAST(quarantined_records AS VARCHAR) AS quarantined_records, "
        "CAST(duplicate_records AS VARCHAR) AS duplicate_records, "
        "CAST(quality_score AS VARCHAR) AS quality_score, "
        "CAST(validity AS VARCHAR) AS quality_dimensions_validity, "
        f"CASE WHEN quality_score >= {_THRESHOLD} THEN 'true' ELSE 'false' END AS quality_gate_passed "
        "FROM scored"
    ),
}
