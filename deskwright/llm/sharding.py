"""Shards of nearly equal size: a minimax contiguous partition of atomic groups.

Rows with equal texts stay together. Texts are hashed into a fixed number of ordered buckets, which
are the atomic groups; the smallest shard capacity for which a greedy walk over the bucket sizes
needs no more than the wished number of shards is found by binary search, and the walk at that
capacity gives the cuts. A bucket larger than the mean of what is left (many copies of one text)
would raise the capacity of all shards, so it takes a shard of its own first.

What is gathered into one row are the bucket sizes, whose number is a parameter, and what reaches
the driver are at most ``shards`` cuts. Rows themselves move once, narrow, to be numbered.

Defined results: null text counts as empty text (crc32 0, size ``overhead``); repeated rows keep
their own slots; an empty table gives an empty result; other columns are ignored. Null ids are
numbered first in their cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskwright.llm.common import stored

OVERHEAD = 16
SHARDS = 40
BUCKETS = 1 << 16
CELLS = 1 << 10


def minimax_cuts(sizes: DataFrame, shards: int) -> DataFrame:
    """One row with ``alone``, ``capacity`` and ``cuts`` for ``sizes(bucket, bytes)``.

    ``alone`` lists the buckets with a shard of their own, ``cuts`` the buckets at which a new
    shard begins among the others. ``sizes`` must be of bounded length.
    """
    return sizes.sparkSession.sql(
        f"""
    WITH listed AS (
      SELECT sort_array(collect_list(struct(bucket, bytes))) AS groups FROM {{sizes}}),
    largest AS (
      SELECT groups, aggregate(groups, 0L, (t, g) -> t + g.bytes) AS total,
        slice(array_sort(groups, (a, b) -> CASE WHEN a.bytes > b.bytes THEN -1
          WHEN a.bytes < b.bytes THEN 1 WHEN a.bucket < b.bucket THEN -1 ELSE 1 END),
          1, {shards - 1}) AS heads FROM listed),
    apart AS (
      SELECT groups, aggregate(heads,
        named_struct('buckets', CAST(array() AS ARRAY<INT>), 'left', total, 'n', {shards}),
        (s, g) -> IF(g.bytes * s.n > s.left AND size(s.buckets) = {shards} - s.n,
          named_struct('buckets', concat(s.buckets, array(g.bucket)),
            'left', s.left - g.bytes, 'n', s.n - 1), s)) AS own FROM largest),
    rest AS (
      SELECT own.buckets AS alone, own.n AS n, own.left AS total,
        filter(groups, g -> NOT array_contains(own.buckets, g.bucket)) AS groups FROM apart),
    searched AS (
      SELECT alone, groups, aggregate(sequence(1, 63),
        named_struct('lo', greatest(coalesce(array_max(transform(groups, g -> g.bytes)), 0L),
          CAST(ceil(total / n) AS BIGINT)), 'hi', total),
        (b, step) -> IF(b.lo >= b.hi, b,
          IF(aggregate(groups, named_struct('used', 1, 'load', 0L),
               (s, g) -> IF(s.load + g.bytes > b.lo + (b.hi - b.lo) DIV 2,
                 named_struct('used', s.used + 1, 'load', g.bytes),
                 named_struct('used', s.used, 'load', s.load + g.bytes))).used <= n,
             named_struct('lo', b.lo, 'hi', b.lo + (b.hi - b.lo) DIV 2),
             named_struct('lo', b.lo + (b.hi - b.lo) DIV 2 + 1, 'hi', b.hi)))).lo AS capacity
      FROM rest)
    SELECT alone, capacity, aggregate(groups,
        named_struct('load', 0L, 'cuts', CAST(array() AS ARRAY<INT>)),
        (s, g) -> IF(s.load + g.bytes > capacity,
          named_struct('load', g.bytes, 'cuts', concat(s.cuts, array(g.bucket))),
          named_struct('load', s.load + g.bytes, 'cuts', s.cuts))).cuts AS cuts
    FROM searched""",
        sizes=sizes,
    )


def _shard_of(bucket: Column, alone: list[int], cuts: list[int]) -> Column:
    """Buckets with a shard of their own come first, then the contiguous pieces."""
    piece = F.lit(len(alone))
    for cut in cuts:
        piece = piece + (bucket >= cut).cast("int")
    shard = F.when(F.lit(False), F.lit(0))
    for place, own in enumerate(alone):
        shard = shard.when(bucket == own, F.lit(place))
    return shard.otherwise(piece)


def assign_shards(
    spark: SparkSession,
    docs: DataFrame,
    shards: int = SHARDS,
    buckets: int = BUCKETS,
    cells: int = CELLS,
    overhead: int = OVERHEAD,
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of ``docs(doc_id, text)``.

    Slots count from 0 without gaps in every shard. They are given in cells of a shard (a hash of
    the id), so that no task numbers a whole shard.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stored(
        spark,
        docs.select(
            "doc_id",
            (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.pmod(F.xxhash64(text), F.lit(buckets)).cast("int").alias("bucket"),
            F.pmod(F.xxhash64("doc_id"), F.lit(cells)).cast("int").alias("cell"),
        ),
        "sharding-rows",
    )
    plan = minimax_cuts(rows.groupBy("bucket").agg(F.sum("size").alias("bytes")), shards).first()
    rows = rows.withColumn("shard", _shard_of(F.col("bucket"), plan["alone"], plan["cuts"]))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "cell")
        .count()
        .select("shard", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("place", F.row_number().over(inside) - 1)
        .join(starts, ["shard", "cell"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("start") + F.col("place")).alias("slot"),
        )
    )
