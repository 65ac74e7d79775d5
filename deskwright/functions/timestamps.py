"""ISO-8601 parsing that neither depends on the session time zone nor raises."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from deskwright.functions import sql


def parse_timestamp(c: Column) -> Column:
    """Timestamp of a text, null where it cannot be read; without an offset it is UTC."""
    return sql.bind(
        c,
        f"CASE WHEN {sql.plain_timestamp('x')} THEN try_cast(x AS TIMESTAMP) "
        f"ELSE {sql.other_timestamp('x')} END",
    )


def is_stale(updated_at: Column, stale_before: datetime) -> Column:
    """Strictly older than the cutoff; instants in the future are timely."""
    return updated_at < F.lit(stale_before)
