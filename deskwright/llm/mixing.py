"""Mixing sources to target weights by temperature.

A source's weight is its share of the tokens raised to an exponent between 0 and 1 and normalised: 1
keeps the shares, 0 makes all sources equal. The exponent is the largest on a grid that reaches the
wanted entropy (a fraction of that of equal weights), raised to what the limit on repetition needs.
Entropy and repetition both fall as the exponent grows, so both are found by bisection; a step sums
over the table of sources.

Weights become budgets of tokens. The source that is repeated least is read exactly once and every
other in proportion, so that nothing is left out. A budget is met by permutations of the source's
blocks, one per epoch: documents are dealt into blocks by a hash; whole epochs take every block; the
last takes blocks in hashed order while they fit, and of the first that does not fit, documents in
hashed order while they fit. Running sums go over the totals of blocks, and over the documents of
one block, so that no task orders a whole source; a larger source has more blocks, not larger ones.

Defined results: a null source is a source of its own; texts without words have no tokens and are
taken like others; rows that share an id are taken together; an empty table gives an empty result;
other columns are kept by ``mixed_documents`` whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskwright.llm.common import WORD, stored

ENTROPY = 0.95  # of the entropy of equal weights
MOST_REPEATS = 3.0  # times that a source may be read
GRID = 4096  # steps of the exponent between 0 and 1
BLOCK_TOKENS = 1 << 22
SEED = "mixing"


def hashed(*parts: Column) -> Column:
    """A number below 2**60 from the parts, the same in every engine that has MD5."""
    digest = F.md5(F.concat_ws(":", F.lit(SEED), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _marked(docs: DataFrame, *keep: Column) -> DataFrame:
    """source, tokens and two hashes of every document, beside ``keep``."""
    doc_id = F.col("doc_id").cast("string")
    return docs.select(
        *keep,
        F.coalesce(F.col("source"), F.lit("")).alias("source"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("n_tokens"),
        hashed(F.lit("block"), doc_id).alias("block_hash"),
        hashed(F.lit("order"), doc_id).alias("order_hash"),
    )


def temperature(
    sources: DataFrame, entropy: float = ENTROPY, most_repeats: float = MOST_REPEATS
) -> float:
    """The exponent for ``sources(tokens)``."""
    logs = sources.where("tokens > 0").select(F.ln(F.col("tokens").cast("double")).alias("x"))
    top, low, n = logs.agg(F.max("x"), F.min("x"), F.count("*")).first()
    if not n:
        return 1.0

    def enough_entropy(step: int) -> bool:
        a = step / GRID
        power = F.exp(a * (F.col("x") - top))
        total, moment = logs.agg(F.sum(power), F.sum(power * (F.col("x") - top))).first()
        return math.log(total) - a * moment / total >= entropy * math.log(n) - 1e-12

    def few_repeats(step: int) -> bool:
        return (1 - step / GRID) * (top - low) <= math.log(most_repeats) + 1e-12

    # The largest step with enough entropy (0 if none has), the smallest with few repeats.
    lo, hi = 0, GRID
    while lo < hi:
        step = (lo + hi + 1) // 2
        lo, hi = (step, hi) if enough_entropy(step) else (lo, step - 1)
    by_entropy, lo, hi = lo, 0, GRID
    while lo < hi:
        step = (lo + hi) // 2
        lo, hi = (lo, step) if few_repeats(step) else (step + 1, hi)
    return max(by_entropy, lo) / GRID


def budgets(spark: SparkSession, rows: DataFrame, entropy: float, most_repeats: float) -> DataFrame:
    """source, weight, budget, epochs (whole ones), rest (tokens of the last) and n_blocks."""
    sources = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    sources = stored(spark, sources, "mixing-sources")
    a = temperature(sources, entropy, most_repeats)
    most = sources.agg(F.max("tokens")).first()[0] or 0
    some = F.col("tokens") > 0
    power = F.when(some, F.exp(a * F.ln(F.col("tokens") / F.lit(float(most or 1)))))
    total = sources.agg(F.sum(power)).first()[0] or 1.0
    budget = F.coalesce(F.round(power * most).cast("long"), F.lit(0))
    found = sources.select(
        "source",
        F.round(F.coalesce(power / total, F.lit(0.0)), 9).alias("weight"),
        "tokens",
        F.greatest(budget, "tokens").alias("budget"),
    ).select(
        "source",
        "weight",
        "budget",
        F.when(some, F.expr("budget div tokens")).otherwise(1).cast("int").alias("epochs"),
        F.when(some, F.expr("budget % tokens")).otherwise(0).alias("rest"),
        F.ceil(F.greatest("tokens", F.lit(1)) / BLOCK_TOKENS).cast("int").alias("n_blocks"),
    )
    return stored(spark, found, "mixing-budgets")


def _last_epoch(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """source, block and the last ``order_hash`` that the last epoch takes of each of its blocks."""
    blocks = (
        rows.groupBy("source", "block")
        .agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
        .withColumn("place", hashed(F.lit("last"), "source", F.col("block").cast("string")))
    )
    running = Window.partitionBy("source").orderBy("place", "block")
    blocks = blocks.withColumn("before", F.sum("n").over(running) - F.col("n"))
    blocks = blocks.where(F.col("before") < F.col("rest")).select(
        "source", "block", "n", (F.col("rest") - F.col("before")).alias("fits")
    )
    blocks = stored(spark, blocks, "mixing-blocks")
    everything = blocks.where(F.col("n") <= F.col("fits")).select(
        "source", "block", F.lit((1 << 60) - 1).cast("long").alias("until")
    )
    # At most one block of a source is cut.
    inside = Window.partitionBy("source", "block").orderBy("order_hash")
    cut = (
        rows.join(blocks.where(F.col("n") > F.col("fits")), ["source", "block"])
        .withColumn("running", F.sum("n_tokens").over(inside))
        .where(F.col("running") <= F.col("fits"))
        .groupBy("source", "block")
        .agg(F.max("order_hash").alias("until"))
    )
    return stored(spark, everything.unionByName(cut), "mixing-last")


def mix(
    spark: SparkSession,
    docs: DataFrame,
    *keep: Column,
    entropy: float = ENTROPY,
    most_repeats: float = MOST_REPEATS,
) -> DataFrame:
    """source, n_tokens, weight, budget, block and copies of every document, beside ``keep``."""
    rows = stored(spark, _marked(docs), "mixing-rows")
    plan = budgets(spark, rows, entropy, most_repeats)
    block = F.pmod("block_hash", F.col("n_blocks")).cast("int").alias("block")
    last = _last_epoch(spark, rows.join(plan, "source").select("*", block))
    copies = F.col("epochs") + F.coalesce(F.col("order_hash") <= F.col("until"), F.lit(False)).cast(
        "int"
    )
    return (
        _marked(docs, *keep)
        .join(plan, "source")
        .select("*", block)
        .join(last, ["source", "block"], "left")
        .withColumn("copies", copies)
    )


def mixing_weights(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, n_tokens, weight, budget, block and copies of every document."""
    return mix(spark, docs, F.col("doc_id"), **options).select(
        "doc_id", "source", "n_tokens", "weight", "budget", "block", "copies"
    )


def mixed_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` as often as the mixture takes them, with their columns.

    Each epoch of a source is a permutation of its blocks: a block of an epoch lies in one
    partition, blocks follow each other in hashed order and documents in hashed order in a block.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    epoch = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("epoch")
    drawn = mix(spark, docs, row, **options).select("row", "source", "block", "order_hash", epoch)
    numbers = [F.col(c).cast("string") for c in ("epoch", "block")]
    drawn = drawn.withColumn("place", hashed(F.lit("block order"), "source", *numbers))
    drawn = drawn.withColumn(
        "order", hashed(F.lit("order"), numbers[0], F.col("order_hash").cast("string"))
    )
    return (
        drawn.repartition("place")
        .sortWithinPartitions("epoch", "place", "order")
        .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
    )
