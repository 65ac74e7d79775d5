"""Scores, counters and histograms over classified rows.

Scores are kept as integer counts until one final division, so that they do not depend on how the
rows were partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from deskwright import fixed
from deskwright.functions.formatting import rate, score


def row_scores(required: int) -> dict[str, Column]:
    """Score of one row per dimension."""
    c = F.col
    share = F.lit(1.0) - c("missing_count") / F.lit(max(1, required))
    return {
        "completeness": F.greatest(F.lit(0.0), share),
        "uniqueness": F.when(c("duplicate"), 0.0).otherwise(1.0),
        "validity": F.when(c("invalid"), 0.0).otherwise(1.0),
        "consistency": F.when(c("inconsistent"), 0.0).otherwise(1.0),
        "timeliness": F.when(c("stale"), 0.0).otherwise(1.0),
    }


def _count_if(c: Column) -> Column:
    return F.coalesce(F.count_if(c), F.lit(0))


# Additive measures: partial results of splits, tasks and micro-batches sum up to the run's.
MEASURES = {
    "total_records": lambda: F.count("*"),
    "accepted_records": lambda: _count_if(F.col("accepted")),
    "quarantined_records": lambda: _count_if(~F.col("accepted")),
    "duplicate_records": lambda: _count_if(F.col("duplicate")),
    "missing_values": lambda: F.coalesce(F.sum("missing_count"), F.lit(0)),
    "invalid_records": lambda: _count_if(F.col("invalid")),
    "inconsistent_records": lambda: _count_if(F.col("inconsistent")),
    "stale_records": lambda: _count_if(F.col("stale")),
}


def measures() -> list[Column]:
    """All additive measures, as aggregates over classified rows."""
    return [make().alias(name) for name, make in MEASURES.items()]


def measure(classified: DataFrame, *by: str) -> DataFrame:
    """All additive measures in one aggregation, per group when ``by`` is given."""
    return classified.groupBy(*by).agg(*measures())


class Counted:
    """Measures of rows, taken in the pass that writes something made of them.

    Spark counts what tasks have seen, so a task that ran again after a lost executor may count
    twice. Then the rows do not add up to ``n_rows``, and the measures are taken by a pass of their own.
    """

    def __init__(self, classified: DataFrame) -> None:
        self._classified = classified
        self._observation = Observation()
        self.rows = classified.observe(self._observation, *measures())

    def measures(self, n_rows: int) -> DataFrame:
        """One row of measures, after ``rows`` was written."""
        seen = self._observation.get
        if seen.get("total_records") != n_rows:
            return measure(self._classified)
        spark = self._classified.sparkSession
        return spark.range(1).select(
            *[F.lit(seen[name]).cast("long").alias(name) for name in MEASURES]
        )


def add_measures(parts: DataFrame, *by: str) -> DataFrame:
    """Merge partial measures."""
    return parts.groupBy(*by).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in MEASURES]
    )


def raw_dimensions(required: int | Column) -> dict[str, Column]:
    """Unrounded dimension scores from additive measures; 0 when there are no rows."""
    rows = F.col("total_records")
    required = F.greatest(F.lit(1), F.lit(required))
    kept = {
        "completeness": (rows * required - F.col("missing_values"), rows * required),
        "uniqueness": (rows - F.col("duplicate_records"), rows),
        "validity": (rows - F.col("invalid_records"), rows),
        "consistency": (rows - F.col("inconsistent_records"), rows),
        "timeliness": (rows - F.col("stale_records"), rows),
    }
    return {
        name: F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
        for name, (part, whole) in kept.items()
    }


def dimension_scores(measures: DataFrame, required: int | Column) -> DataFrame:
    """Add the five rounded dimension scores and the rounded unweighted mean of them."""
    scored = measures.withColumns(
        {name: score(value) for name, value in raw_dimensions(required).items()}
    )
    total = sum((F.col(d) for d in fixed.DIMENSIONS), F.lit(0.0))
    return scored.withColumn("quality_score", score(total / len(fixed.DIMENSIONS)))


def quality_gate(scored: DataFrame, threshold: float | Column) -> DataFrame:
    limit = F.lit(threshold).cast("double")
    return scored.withColumns(
        {"quality_threshold": limit, "quality_gate_passed": F.col("quality_score") >= limit}
    )


def throughput(records: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, rate(records / seconds)).otherwise(F.lit(0.0))


def metrics_long(measures: DataFrame, required: int, *ids: str) -> DataFrame:
    """One row per dimension with the unrounded score."""
    wide = measures.select(*ids, *[v.alias(n) for n, v in raw_dimensions(required).items()])
    return wide.unpivot(list(ids), fixed.DIMENSIONS, "dimension", "score")


def violation_histogram(classified: DataFrame) -> DataFrame:
    """Violations by code and dimension."""
    exploded = classified.select(F.explode("violations").alias("v"))
    return (
        exploded.groupBy(F.col("v.code").alias("code"), F.col("v.dimension").alias("dimension"))
        .agg(F.count("*").alias("violations"))
    )


def tickets_by_source(tickets: DataFrame) -> DataFrame:
    return tickets.groupBy("source_system").agg(F.count("*").alias("tickets"))
