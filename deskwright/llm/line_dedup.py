"""Repeated lines: levelled sorted runs of line keys.

Keys that earlier batches have seen lie in runs, each sorted by key and disjoint from the others. A
batch reduces its lines to one holder per key, anti-joins the runs by sort-merge, and adds what
remains as a run of its own. When a level has ``fanout`` runs they are merged into one run of the
next level, so that the number of runs grows with the logarithm of the number of batches.

A line goes if it is not held by its document. That test joins by key *and* holder, which are spread
evenly however common a line is; a holder is found by partial aggregation. Lines are two 64-bit
hashes and a position until the few that go meet their documents again.

Defined results: null and empty text are one empty line; rows that share an id are one document (all
of them keep its lines); a null id is smaller than any other; an empty table gives an empty result;
other columns are kept by ``drop_repeated_lines`` whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwright.llm.common import SPACES, ascii_lower, stored
from deskwright.session import scratch_path

LEAST_CHARS = 10
BATCHES = 4
FANOUT = 2
SMALLEST_ID = -(1 << 63)
KEY = ["h1", "h2"]


class LineRuns:
    """The keys seen so far, as sorted runs by level; survives as files in shared storage."""

    def __init__(self, spark: SparkSession, root: str | None = None, fanout: int = FANOUT):
        self.spark = spark
        self.root = root or scratch_path(spark, "line-runs")
        self.fanout = fanout
        self.levels: list[list[str]] = []
        self.written = 0

    def _write(self, keys: DataFrame) -> str:
        path = f"{self.root}/run-{self.written}"
        self.written += 1
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        keys.repartition(parts, *KEY).sortWithinPartitions(*KEY).write.parquet(path)
        return path

    def runs(self) -> list[DataFrame]:
        return [self.spark.read.parquet(path) for level in self.levels for path in level]

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch ``lines(doc, h1, h2, ...)`` and return those that their documents lose.

        Every document of the batch must come after those of earlier batches.
        """
        held = lines.groupBy(*KEY).agg(F.min("doc").alias("doc"))
        for run in self.runs():
            held = held.join(run.select(*KEY), KEY, "left_anti")
        path = self._write(held)
        self._place(path, 0)
        return lines.join(self.spark.read.parquet(path), [*KEY, "doc"], "left_anti")

    def _place(self, path: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) == self.fanout:
            runs = [self.spark.read.parquet(p) for p in self.levels[level]]
            self.levels[level] = []
            self._place(self._write(reduce(DataFrame.unionByName, runs)), level + 1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _marked(docs: DataFrame) -> DataFrame:
    """Columns of ``docs`` in one struct, beside document order, text identity and lines."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col("doc_id"), F.lit(SMALLEST_ID)).alias("doc"),
        F.xxhash64(text).alias("text_hash"),
        F.split(text, "\n", -1).alias("lines"),
    )


def find_repeated_lines(
    spark: SparkSession,
    docs: DataFrame,
    least_chars: int = LEAST_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """doc, text_hash, pos (from 0) of the lines that go; documents arrive by ascending id."""
    marked = _marked(docs)
    cuts = docs.agg(
        F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000)
    ).first()[0]
    batch = sum(((F.col("doc") > cut).cast("int") for cut in cuts or []), F.lit(0))
    line = marked.select(
        "doc", "text_hash", F.posexplode("lines").alias("pos", "line"), batch.alias("batch")
    ).select("doc", "text_hash", "pos", line_key(F.col("line")).alias("key"), "batch")
    line = line.where(F.char_length("key") >= least_chars).select(
        "doc",
        "text_hash",
        "pos",
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit("second"), "key").alias("h2"),
        "batch",
    )
    line = stored(spark, line, "line-keys", "batch")
    runs = LineRuns(spark, fanout=fanout)
    lost = [runs.add(line.where(F.col("batch") == i).drop("batch")) for i in range(batches)]
    return reduce(DataFrame.unionByName, lost).select("doc", "text_hash", "pos")


def _with_losses(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    lost = (
        find_repeated_lines(spark, docs, **options)
        .groupBy("doc", "text_hash")
        .agg(F.collect_set("pos").alias("lost"))
    )
    lost = stored(spark, lost, "lost-lines")
    none = F.array().cast("array<int>")
    rest = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("lost", none))
    kept = F.transform(rest, lambda i: F.get("lines", i))
    return _marked(docs).join(lost, ["doc", "text_hash"], "left").select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size(F.coalesce("lost", none)), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("lost").isNotNull(), F.array_join(kept, "\n"))
        .otherwise(F.coalesce(F.col("row.text"), F.lit("")))
        .alias("kept"),
    )


def repeated_lines(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept (the text that stays) of every document."""
    return _with_losses(spark, docs, **options).select(
        "row.doc_id", "n_lines", "n_dropped", "kept"
    )


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """``docs`` with its columns, texts without the lines that earlier documents hold.

    ``n_chars``, where there is such a column, follows the text. Null texts stay null.
    """
    new_text = F.when(F.col("row.text").isNotNull(), F.col("kept"))
    changed = {"text": new_text, "n_chars": F.char_length(new_text).cast("long")}
    return _with_losses(spark, docs, **options).select(
        *[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    )
