"""First-occurrence flags that stay exact and balanced when one key dominates.

The first row of a key is found with ``min`` (partial aggregation leaves at most one value per key
and task), and the answer goes back to the rows by their unique row number. Rows are never grouped
or joined by the key itself, so a key that holds a third of the input costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_rows(
    rows: DataFrame, key: Column, order: str = "row_number", claims: Column | None = None
) -> DataFrame:
    """One row per key: ``_key`` and the smallest ``order`` value among the rows that claim it."""
    claiming = rows if claims is None else rows.where(claims)
    return (
        claiming.select(key.alias("_key"), order).groupBy("_key").agg(F.min(order).alias(order))
    )


def flag_repeats(
    rows: DataFrame,
    key: Column,
    order: str = "row_number",
    claims: Column | None = None,
    flag: str = "duplicate",
) -> DataFrame:
    """Add a flag that is true for claiming rows which are not the first of their key."""
    firsts = first_rows(rows, key, order, claims).select(order, F.lit(True).alias("_first"))
    is_claiming = F.lit(True) if claims is None else F.coalesce(claims, F.lit(False))
    joined = rows.join(firsts, order, "left")
    return joined.withColumn(flag, is_claiming & F.col("_first").isNull()).drop("_first")


def repeated_rows(narrow: DataFrame, firsts: DataFrame, order: str = "row_number") -> DataFrame:
    """Order values of the rows that are not first; usually far fewer than the rows."""
    return narrow.select(order).join(firsts.select(order), order, "left_anti")
