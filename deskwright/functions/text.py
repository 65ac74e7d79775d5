"""Text cleaning as Column -> Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deskwright.functions import sql


def strip(c: Column) -> Column:
    """Remove Unicode whitespace at both ends."""
    return sql.bind(c, sql.strip("x"))


def clean_text(c: Column) -> Column:
    """Null becomes empty, whitespace runs become one space, ends are trimmed."""
    return sql.bind(c, sql.clean_text("x"))


def casefold(c: Column) -> Column:
    """Unicode full case folding."""
    return sql.bind(c, sql.casefold("x"))


def map_value(cleaned: Column, mapping: dict[str, str]) -> Column:
    """Look up the case-folded value in a literal map; unmapped values stay as they are."""
    return sql.bind(cleaned, sql.map_value("x", mapping))


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def default_if_empty(c: Column, default: str) -> Column:
    return F.coalesce(null_if_empty(c), F.lit(default))


def empty_marker(c: Column) -> Column:
    return default_if_empty(c, "(empty)")


def truncate(c: Column, chars: int) -> Column:
    return F.substring(c, 1, chars)


def length_ok(c: Column, column: str) -> Column:
    """Whether the number of code points is within the bounds of a ticket column."""
    return sql.bind(c, sql.length_ok("x", column))
