"""Filters, orders and small reports over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_BOUNDS = (1, 10_000)


def quarantine_sample(quarantine: DataFrame, run_id: str | None = None, limit: int = 100):
    """The first rejected rows of a run by row number (a bounded top-k, not a full sort)."""
    low, high = SAMPLE_BOUNDS
    if not low <= limit <= high:
        raise ValueError(f"limit must be between {low} and {high}")
    rows = quarantine if run_id is None else quarantine.where(F.col("run_id") == run_id)
    return rows.orderBy("row_number").limit(limit)


def split_accepted(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    return classified.where("accepted"), classified.where("NOT accepted")


def find_tickets(
    tickets: DataFrame,
    status: str | None = None,
    priority: str | None = None,
    updated_since=None,
) -> DataFrame:
    """Stored tickets by status, priority and update time; the filters reach the Parquet scan."""
    if status is not None:
        tickets = tickets.where(F.col("status") == status)
    if priority is not None:
        tickets = tickets.where(F.col("priority") == priority)
    if updated_since is not None:
        tickets = tickets.where(F.col("updated_at") >= F.lit(updated_since))
    return tickets


def newest_runs(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.col("started_at").desc(), F.col("run_id"))


def metrics_of(metrics: DataFrame, run_id: str | None = None) -> DataFrame:
    rows = metrics if run_id is None else metrics.where(F.col("run_id") == run_id)
    return rows.orderBy("run_id", "dimension")
