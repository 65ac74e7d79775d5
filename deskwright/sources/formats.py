"""Input format by explicit choice or file suffix."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column
from pyspark.sql import functions as F

from deskwright import fixed


def detect_format(path: str, explicit: str | None = None) -> str:
    if explicit is not None:
        if explicit not in fixed.SUFFIX_FORMATS.values():
            raise ValueError(f"unknown input format: {explicit}")
        return explicit
    found = fixed.SUFFIX_FORMATS.get(PurePosixPath(path.rstrip("/")).suffix.casefold())
    if found is None:
        raise ValueError(f"cannot detect the input format of {PurePosixPath(path).name}")
    return found


def format_of(file_name: Column) -> Column:
    """Format of each file name in a listing, null when the suffix is unknown."""
    suffix = F.lower(F.regexp_extract(file_name, r"[^/](\.[^./]*)/*$", 1))
    table = F.create_map(*[F.lit(x) for pair in fixed.SUFFIX_FORMATS.items() for x in pair])
    return F.try_element_at(table, suffix)
