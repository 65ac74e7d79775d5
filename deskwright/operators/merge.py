"""Loading accepted tickets into a table keyed by (source_system, ticket_id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TICKET_KEY = ["source_system", "ticket_id"]


def insert_if_absent(target: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Incoming rows whose key the target does not have."""
    return incoming.join(target.select(*key), key, "left_anti")


def latest_per_key(rows: DataFrame, key: list[str], newest_by: Column) -> DataFrame:
    """The newest row of every key; partial aggregation absorbs hot keys."""
    values = [c for c in rows.columns if c not in key]
    packed = F.max_by(F.struct(*values), newest_by).alias("_newest")
    return rows.groupBy(*key).agg(packed).select(*key, "_newest.*")


def merge_actions(
    target: DataFrame,
    incoming: DataFrame,
    key: list[str] = TICKET_KEY,
    newer_by: str | None = "updated_at",
) -> DataFrame:
    """The target after the load, with an ``action`` per row.

    ``insert``: new key. ``update``: the incoming row is strictly newer by ``newer_by``.
    ``unchanged``: the key arrived but the stored row stays. ``kept``: the key did not arrive.
    Without ``newer_by`` existing rows always stay (insert-only). Both sides must have unique keys
    and the same columns.
    """
    values = [c for c in target.columns if c not in key]
    old = target.select(*key, F.struct(*values).alias("_old"))
    new = incoming.select(*key, F.struct(*values).alias("_new"))
    joined = old.join(new, key, "full_outer")
    newer = F.lit(False)
    if newer_by:
        newer = F.coalesce(
            F.col(f"_new.{newer_by}") > F.col(f"_old.{newer_by}"), F.lit(False)
        )
    action = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "kept")
        .when(newer, "update")
        .otherwise("unchanged")
    )
    acted = joined.withColumn("action", action)
    result = F.when(F.col("action").isin("insert", "update"), F.col("_new")).otherwise(F.col("_old"))
    return acted.select(*key, result.alias("_row"), "action").select(*key, "_row.*", "action")


def key_bucket(key: list[str], n_buckets: int) -> Column:
    """The bucket of a row by the hash of its key."""
    return F.pmod(F.xxhash64(*key), F.lit(n_buckets)).cast("int")


def changed_keys(
    target: DataFrame, incoming: DataFrame, key: list[str] = TICKET_KEY, newer_by: str | None = "updated_at"
) -> DataFrame:
    """key, bucket and action (``insert`` or ``update``) of the incoming rows that change the target.

    A narrow join: only the key and ``newer_by`` of the target are read. Without ``newer_by``
    existing rows stay. Both sides must have unique keys; ``incoming`` has its ``bucket``.
    """
    compared = [newer_by] if newer_by else []
    old = target.select(*key, *[F.col(c).alias("_old") for c in compared], F.lit(True).alias("_there"))
    joined = incoming.select(*key, "bucket", *compared).join(old, key, "left")
    action = F.when(F.col("_there").isNull(), "insert")
    if newer_by:
        action = action.when(F.col(newer_by) > F.col("_old"), "update")
    return joined.select(*key, "bucket", action.alias("action")).where("action IS NOT NULL")


def load_counts(actions: DataFrame) -> DataFrame:
    """Rows written and rows left unchanged by a merge."""
    return actions.agg(
        F.count_if(F.col("action").isin("insert", "update")).alias("loaded_records"),
        F.count_if(F.col("action") == "unchanged").alias("unchanged_records"),
    )
