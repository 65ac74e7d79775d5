"""Rounding and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def score(c: Column) -> Column:
    return F.round(c, 6)


def rate(c: Column) -> Column:
    return F.round(c, 2)


def percent(c: Column) -> Column:
    return F.format_string("%.2f%%", c * 100)


def thousands(c: Column, digits: int = 0) -> Column:
    return F.format_number(c, digits)


def yes_no(c: Column, yes: str, no: str) -> Column:
    return F.when(c, yes).otherwise(no)
