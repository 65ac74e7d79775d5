"""SQL text of the functions that are more than one built-in call.

Each function takes the SQL text of its argument, which should be a name because it may occur more
than once, and returns SQL text. The Column functions of the sibling modules bind their argument to
a name first, so that it is evaluated once and the plan holds one copy of the code.
"""

from __future__ import annotations

import functools
import json
import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from deskwright import fixed


def text(value: str) -> str:
    """A string literal; raw when it holds backslashes."""
    if "'" in value:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"r'{value}'" if "\\" in value else f"'{value}'"


def name(value: str) -> str:
    """A quoted column name."""
    return "`" + value.replace("`", "``") + "`"


def texts(values: list[str]) -> str:
    return ", ".join(text(v) for v in values)


def each(columns: list[Column], body: str) -> list[Column]:
    """Apply ``body``, an expression of ``x``, to columns of one type."""
    results = F.call_function("transform", F.array(*columns), F.expr(f"x -> {body}"))
    return [F.get(results, F.lit(i)) for i in range(len(columns))]


def bind(column: Column, body: str) -> Column:
    """Apply ``body``, an expression of ``x``, to one column."""
    return each([column], body)[0]


# Texts of printable ASCII need only the cheap functions; the check stops at the first other letter.
_UNUSUAL = "r'[^ -~]'"
_SPACE = fixed.SPACE_CLASS


def strip(x: str) -> str:
    """Remove Unicode whitespace at both ends."""
    anywhere = f"regexp_replace({x}, r'^{_SPACE}+|{_SPACE}+$', '')"
    return f"CASE WHEN {x} RLIKE {_UNUSUAL} THEN {anywhere} ELSE trim({x}) END"


def clean_text(x: str) -> str:
    """Null becomes empty, whitespace runs become one space, ends are trimmed."""
    return (
        f"CASE WHEN {x} IS NULL THEN '' "
        f"WHEN contains({x}, '  ') OR {x} RLIKE {_UNUSUAL} "
        f"THEN trim(regexp_replace({x}, r'{_SPACE}+', ' ')) ELSE trim({x}) END"
    )


@functools.cache
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Unicode full case folding, split by the number of result characters."""
    single_from, single_to, several = [], [], {}
    for code in range(sys.maxunicode + 1):
        letter = chr(code)
        folded = letter.casefold()
        if folded == letter:
            continue
        if len(folded) == 1:
            single_from.append(letter)
            single_to.append(folded)
        else:
            several[letter] = folded
    return "".join(single_from), "".join(single_to), several


def casefold(x: str) -> str:
    """Unicode case folding; plain ``lower`` on ASCII, which nearly all values are."""
    single_from, single_to, several = _fold_tables()
    folded = f"translate({x}, {text(single_from)}, {text(single_to)})"
    table = f"from_json({text(json.dumps(several, ensure_ascii=False))}, 'map<string,string>')"
    letters = f"transform(split({folded}, ''), ch -> coalesce(try_element_at({table}, ch), ch))"
    return (
        f"CASE WHEN NOT {x} RLIKE r'[^\\x00-\\x7F]' THEN lower({x}) "
        f"WHEN {x} RLIKE {text('[' + ''.join(several) + ']')} THEN array_join({letters}, '') "
        f"ELSE {folded} END"
    )


def map_value(x: str, mapping: dict[str, str]) -> str:
    """Look up the case-folded value in a literal map; unmapped values stay as they are."""
    if not mapping:
        return x
    table = f"map({texts([t for pair in mapping.items() for t in pair])})"
    return f"coalesce(try_element_at({table}, {casefold(x)}), {x})"


def email_alias(x: str) -> str:
    """Stable alias of a stripped address: leading hex digits of the SHA-256 of its folded text."""
    digits, domain = fixed.ALIAS_HEX_DIGITS, text(fixed.ALIAS_DOMAIN)
    return f"concat(substring(sha2({casefold(x)}, 256), 1, {digits}), {domain})"


def mask_emails(x: str) -> str:
    """Replace each e-mail match by its alias.

    Addresses hold no space, so the text is cut at spaces and only words with an @ are searched.
    There, spaces mark the matches: after cutting again every second piece is a match.
    """
    pieces = f"split(regexp_replace(w, {text(fixed.EMAIL_PATTERN)}, ' $0 '), ' ', -1)"
    piece = f"CASE WHEN i % 2 = 1 THEN {email_alias('p')} ELSE p END"
    word = f"array_join(transform({pieces}, (p, i) -> {piece}), '')"
    words = f"transform(split({x}, ' ', -1), w -> CASE WHEN contains(w, '@') THEN {word} ELSE w END)"
    return f"CASE WHEN contains({x}, '@') THEN array_join({words}, ' ') ELSE {x} END"


def mask_text(x: str) -> str:
    """E-mail addresses first, then phone-like runs; an all-digit alias is a phone-like run."""
    pattern, mark = text(fixed.PHONE_PATTERN), text(fixed.PHONE_MARK)
    return f"regexp_replace({mask_emails(x)}, {pattern}, {mark})"


def masked_length_within(x: str, masked: str, high: int) -> str:
    """Whether the masked form of ``x`` has at most ``high`` characters.

    Masking lengthens a text by at most alias length / shortest address, so short texts, which
    nearly all are, need no masking to know.
    """
    surely = high * fixed.SHORTEST_EMAIL // fixed.ALIAS_LENGTH
    return f"CASE WHEN char_length({x}) <= {surely} THEN true ELSE char_length({masked}) <= {high} END"


def length_ok(x: str, column: str) -> str:
    low, high = fixed.LENGTH_BOUNDS[column]
    return f"char_length({x}) BETWEEN {low} AND {high}"


# ISO-8601 times. Spellings that Spark's own cast reads: with an offset, and without one (then taken
# as UTC). The first and last day of the calendar are left to the range check of the full parser.
_SECONDS = (
    r"^(?!0000|0001-01-01|9999-12-31)"
    r"[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?"
)
_WITH_OFFSET = _SECONDS + r"(Z|[+-](0[0-9]|1[0-7]):[0-5][0-9])$"
_WITHOUT_OFFSET = _SECONDS + r"$"

# All other spellings, as one pattern whose groups are the parts below. Dates may be calendar or
# week dates, extended or basic ("b..."); clock times may stop after the hour or the minute.
_PARTS = [
    "year", "month", "day",
    "byear", "bmonth", "bday",
    "wyear", "week", "weekday",
    "bwyear", "bweek", "bweekday",
    "hour", "minute", "second", "bminute", "bsecond", "fraction",
    "sign", "ohour", "ominute", "osecond", "obminute", "obsecond", "ofraction",
]
# In a basic week date the parity of the digit run tells a weekday from a separator.
_WEEKDAY = r"(\d)(?=\D|$|\d(?:\d\d)*(?:\D|$))|(?!\d(?:\D|$)|(?:\d\d)+(?:\D|$))"
_DATE = (
    r"(?:(\d{4})-(\d{2})-(\d{2})|(\d{4})(\d{2})(\d{2})"
    rf"|(\d{{4}})-W(\d{{2}})(?:-(\d)(?!\d))?|(\d{{4}})W(\d{{2}})(?:{_WEEKDAY}))"
)
# One stray character before the offset is tolerated, but not after a fraction of up to 6 digits.
_CLOCK = (
    r"(\d{2})(?::(\d{2})(?::(\d{2}))?|(\d{2})(\d{2})?)?"
    r"(?:[.,](\d+)(?:(?<=\d{7})[^+-](?=[+-])|(?=[+-]|$))|[^+-]?(?=[+-])|$)"
)
_FULL = rf"^{_DATE}(?:[\s\S]{_CLOCK}(?:([+-]){_CLOCK})?)?$"
_REPLACEMENT = "|".join(f"${i + 1}" for i in range(len(_PARTS)))

_FIRST_MICROS = -62_135_596_800_000_000  # 0001-01-01T00:00:00Z
_LAST_MICROS = 253_402_300_799_999_999  # 9999-12-31T23:59:59.999999Z
_DAY_MICROS = 86_400_000_000


def plain_timestamp(x: str) -> str:
    """Whether Spark's cast reads the text as it stands."""
    return f"{x} RLIKE r'{_WITH_OFFSET}'"


def _named(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _from_parts(pieces: str) -> str:
    """Integer arithmetic on the matched parts."""
    part = {name: f"{pieces}[{i}]" for i, name in enumerate(_PARTS)}

    def number(*names: str) -> str:
        found = ", ".join(f"nullif({part[n]}, '')" for n in names)
        return f"try_cast(coalesce({found}, '0') AS BIGINT)"

    def micros(name: str) -> str:
        return f"try_cast(substring(concat({part[name]}, '000000'), 1, 6) AS BIGINT)"

    def joined(*names: str) -> str:
        return "concat(" + ", ".join(part[n] for n in names) + ")"

    calendar = (
        f"try_cast(concat_ws('-', {joined('year', 'byear')}, {joined('month', 'bmonth')}, "
        f"{joined('day', 'bday')}) AS DATE)"
    )
    # ISO week 1 holds 4 January; a week that the year does not have lands in another week-year.
    fourth = f"try_cast(concat({joined('wyear', 'bwyear')}, '-01-04') AS DATE)"
    weekday = f"try_cast(coalesce(nullif({joined('weekday', 'bweekday')}, ''), '1') AS INT)"
    week = f"cast({number('week', 'bweek')} AS INT)"
    candidate = f"date_add(date_sub({fourth}, weekday({fourth})), ({week} - 1) * 7 + {weekday} - 1)"
    by_week = _named(
        candidate,
        "d",
        f"CASE WHEN {week} >= 1 AND {weekday} BETWEEN 1 AND 7 "
        f"AND extract(YEAROFWEEK FROM d) = {number('wyear', 'bwyear')} THEN d END",
    )
    date = f"CASE WHEN {joined('week', 'bweek')} <> '' THEN {by_week} ELSE {calendar} END"

    hour, minute, second = number("hour"), number("minute", "bminute"), number("second", "bsecond")
    offset = (
        f"(({number('ohour')} * 3600 + {number('ominute', 'obminute')} * 60 "
        f"+ {number('osecond', 'obsecond')}) * 1000000 + {micros('ofraction')})"
    )
    clock = f"(({hour} * 3600 + {minute} * 60 + {second}) * 1000000 + {micros('fraction')})"
    signed = f"CASE WHEN {part['sign']} = '-' THEN -{offset} ELSE {offset} END"
    total = f"unix_date({date}) * {_DAY_MICROS} + {clock} - {signed}"
    in_range = f"CASE WHEN m BETWEEN {_FIRST_MICROS} AND {_LAST_MICROS} THEN timestamp_micros(m) END"
    return (
        f"CASE WHEN size({pieces}) = {len(_PARTS)} AND {joined('year', 'byear')} <> '0000' "
        f"AND {joined('wyear', 'bwyear')} <> '0000' AND {hour} <= 23 AND {minute} <= 59 "
        f"AND {second} <= 59 AND {offset} < {_DAY_MICROS} THEN {_named(total, 'm', in_range)} END"
    )


def other_timestamp(x: str) -> str:
    """Timestamp of any accepted ISO-8601 spelling, null when there is none."""
    stripped, marked = strip(x), f"regexp_replace(replace(s, 'Z', '+00:00'), r'{_FULL}', '{_REPLACEMENT}')"
    parsed = _named(f"split({marked}, r'\\|', -1)", "parts", _from_parts("parts"))
    return _named(
        stripped,
        "s",
        f"CASE WHEN s RLIKE r'{_WITH_OFFSET}' THEN try_cast(s AS TIMESTAMP) "
        f"WHEN s RLIKE r'{_WITHOUT_OFFSET}' THEN try_cast(concat(s, 'Z') AS TIMESTAMP) "
        f"WHEN s RLIKE r'^[0-9]{{4}}[0-9W-][\\s\\S]{{2,100}}$' AND NOT contains(s, '|') "
        f"THEN {parsed} END",
    )
