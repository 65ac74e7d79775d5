"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwright.llm.common import stored

MOST_STEPS = 100


def _state(edges: DataFrame) -> tuple:
    digest = F.xxhash64("a", "b").cast("decimal(38, 0)")
    return tuple(edges.agg(F.count("*"), F.sum(digest)).first())


def star_step(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; components stay as they are, paths get shorter."""
    # Every larger neighbour of a node points at the smallest node that this one knows.
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    larger = (
        both.join(least, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
    )
    larger = stored(spark, larger, "edges-larger")
    # A node and its smaller neighbours point at the smallest of them.
    least = larger.groupBy("a").agg(F.min("b").alias("least"))
    smaller = (
        larger.join(least, "a")
        .select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
        .where("a != b")
        .distinct()
    )
    return stored(spark, smaller, "edges")


def stars(spark: SparkSession, edges: DataFrame, steps: int | None = None) -> DataFrame:
    """a and b (the smallest node of its component) of every other node of ``edges(a, b)``.

    The number of steps grows with the logarithm of the size of a component. With ``steps`` given,
    no more are made, and b is then some smaller node of the component.
    """
    edges = stored(spark, edges.select("a", "b").where("a != b").distinct(), "edges")
    before = None if steps else _state(edges)
    for _ in range(steps or MOST_STEPS):
        edges = star_step(spark, edges)
        if not steps:
            after = _state(edges)
            if after == before:
                return edges
            before = after
    if not steps:
        raise RuntimeError("components did not settle")
    return edges
