"""Fixed values that define the ticket contract.

Results depend on these exact values: masking patterns, enumerations, column names, bounds and
violation codes. They are data, kept together and in plain order.
"""

# Columns of a ticket export, in file order.
EXPORT_COLUMNS = [
    "ticket_id",
    "title",
    "description",
    "status",
    "priority",
    "requester_email",
    "assignee",
    "created_at",
    "updated_at",
    "resolved_at",
    "source_system",
]

# Fields that an export must fill by the usual rules, in report order.
USUAL_REQUIRED_FIELDS = [
    "ticket_id",
    "title",
    "status",
    "priority",
    "requester_email",
    "created_at",
    "updated_at",
]

# Enumerations of the stored ticket.
STATUSES = ["Open", "In Progress", "Pending", "Resolved", "Closed"]
ACTIVE_STATUSES = ["Open", "In Progress", "Pending"]
FINISHED_STATUSES = ["Resolved", "Closed"]
PRIORITIES = ["Low", "Medium", "High", "Critical"]

# Length bounds in code points (low, high).
LENGTH_BOUNDS = {
    "ticket_id": (1, 100),
    "title": (3, 500),
    "description": (0, 20_000),
    "assignee": (0, 200),
    "source_system": (2, 100),
}

# Quality dimensions, in report order.
DIMENSIONS = ["completeness", "uniqueness", "validity", "consistency", "timeliness"]

# Violation code -> dimension, in emission order.
VIOLATIONS = {
    "read_error": "validity",
    "required_fields_missing": "completeness",
    "invalid_status": "validity",
    "invalid_priority": "validity",
    "schema_validation": "validity",
    "resolved_timestamp_missing": "consistency",
    "active_ticket_has_resolution": "consistency",
    "stale_record": "timeliness",
    "duplicate_ticket_id": "uniqueness",
}

# Masking output.
ALIAS_DOMAIN = "@masked.invalid"
ALIAS_HEX_DIGITS = 16
ALIAS_LENGTH = ALIAS_HEX_DIGITS + len(ALIAS_DOMAIN)
PHONE_MARK = "[PHONE]"
REDACTED_MARK = "[REDACTED]"
SENSITIVE_KEYS = ["requester_email", "email", "phone", "telephone", "mobile"]
SHORTEST_EMAIL = len("a@b.cc")

# Unicode whitespace, word characters and decimal digits as regex classes (Java syntax).
SPACE_CLASS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
WORD_CLASS = r"[\p{L}\p{N}_]"
DIGIT_CLASS = r"\p{Nd}"

# E-mail: word boundary, local part, @, domain, dot, two or more letters, word boundary; any case.
# The four non-ASCII letters equal ASCII letters when case is ignored.
LETTERS = "A-Za-z\u0130\u0131\u017f\u212a"
EMAIL_PATTERN = (
    rf"(?:(?<!{WORD_CLASS})(?=[{LETTERS}0-9_])|(?<={WORD_CLASS})(?=[.%+-]))"
    rf"[{LETTERS}0-9._%+-]++@[{LETTERS}0-9.-]+\.[{LETTERS}]{{2,}}(?!{WORD_CLASS})"
)

# Phone: optional plus, nine or more digits or separators that begin and end with a digit,
# no word character on either side.
PHONE_PATTERN = (
    rf"(?:\+(?<!{WORD_CLASS}\+){DIGIT_CLASS}|{DIGIT_CLASS}(?<!{WORD_CLASS}{DIGIT_CLASS}))"
    rf"[{DIGIT_CLASS} .()\-]{{7,}}{DIGIT_CLASS}(?!{WORD_CLASS})"
)

# The same two patterns for Python's re module (e-mail with IGNORECASE).
EMAIL_PATTERN_PYTHON = r"\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
PHONE_PATTERN_PYTHON = r"(?<!\w)(?:\+?\d[\d .()\-]{7,}\d)(?!\w)"

# Rule document bounds.
BATCH_SIZE_BOUNDS = (1, 50_000)
TIMELINESS_BOUNDS = (1, 3_650)
THRESHOLD_BOUNDS = (0.0, 1.0)
SOURCE_SYSTEM_BOUNDS = (2, 100)
DEFAULT_BATCH_SIZE = 1_000
DEFAULT_TIMELINESS_DAYS = 90
DEFAULT_THRESHOLD = 0.85

# File suffixes.
SUFFIX_FORMATS = {".csv": "csv", ".jsonl": "jsonl", ".ndjson": "jsonl", ".parquet": "parquet"}

# Truncation of stored texts.
RAW_LINE_CHARS = 1_000
ERROR_CHARS = 2_000

# Run states.
PENDING, RUNNING, FAILED, COMPLETED = "PENDING", "RUNNING", "FAILED", "COMPLETED"
