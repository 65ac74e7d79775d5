"""Identity of files by their bytes: a hash tree over ranges of a fixed size.

A leaf is the SHA-256 of one range of a file; a node is the SHA-256 of its children's hexadecimal
digests, one after another, ``fanout`` of them or fewer at the end. The node without a parent stands
for the file. Its shape follows from the file's length, so length and top digest are the identity, and
one definition holds for files of any size. An empty file has no ranges and no tree.

Ranges are rows that Spark spreads over tasks, however few the files are; a task reads its ranges in
pieces and holds one piece. The levels above are aggregates of at most ``fanout`` digests a group.
Trees of two times are compared from the top: only children of nodes that differ are looked at.

A path without files is an error, as for every reader. A file that changed its length after it was listed
fails the job.
"""

from __future__ import annotations

import contextlib
import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwright.session import scratch_path
from deskwright.sources.fingerprint import input_files

RANGE_BYTES = 16 * 1024 * 1024
FANOUT = 256
# Ranges are small rows that stand for much reading, so their tasks are counted here: by bytes, by
# ranges where these are short, and some for every core if there are a few ranges for each.
BYTES_A_TASK, RANGES_A_TASK, FEW_RANGES, TASKS_A_CORE = 8 * RANGE_BYTES, 4_096, 8, 4
MOST_TASKS = 20_000
PIECE_BYTES = 1 << 20
# Schemes of object stores under the names that Arrow knows.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}
NODES = "path string, length long, top int, level int, number long, digest string"


def byte_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, length, number, start and size of the ranges of files(path, length)."""
    last = (F.ceil(F.col("length") / range_bytes) - 1).cast("long")
    start = F.col("number") * range_bytes
    return files.where("length > 0").select(
        "path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("number")
    ).select(
        "*",
        start.alias("start"),
        F.least(F.lit(range_bytes), F.col("length") - start).cast("long").alias("size"),
    )


def _opened(path: str):
    """A file by the path that Spark names it by, which is not percent-encoded."""
    scheme, rest = path.split(":", 1)
    if scheme == "file":
        return pa.fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    system, place = pa.fs.FileSystem.from_uri(f"{ARROW_SCHEMES.get(scheme, scheme)}:{quote(rest)}")
    return system.open_input_file(place)


def _range_digest(file, start: int, size: int) -> str:
    digest = hashlib.sha256()
    file.seek(start)
    while size:
        piece = file.read(min(size, PIECE_BYTES))
        if not piece:
            raise RuntimeError("a file changed while it was read")
        digest.update(piece)
        size -= len(piece)
    return digest.hexdigest()


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digests of ranges that come file by file; one file is open at a time."""
    with contextlib.ExitStack() as opened:
        current, file = None, None

        def digest_of(path: str, length: int, start: int, size: int) -> str:
            nonlocal current, file
            if (path, length) != current:
                opened.close()
                current, file = (path, length), opened.enter_context(_opened(path))
                if file.size() != length:
                    raise RuntimeError(f"{path} changed while it was read")
            return _range_digest(file, start, size)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("path", "length", "start", "size")]
            digests = pa.array([digest_of(*row) for row in zip(*columns)], pa.string())
            kept = [batch.column(c) for c in ("path", "length", "number")]
            yield pa.RecordBatch.from_arrays([*kept, digests], ["path", "length", "number", "digest"])


def _top_level(leaves: Column, fanout: int, levels: int) -> Column:
    """The level at which a file of so many leaves has one node, by whole numbers only."""
    above = F.lit(0)
    for level in range(levels):
        above = above + (leaves > fanout**level).cast("int")
    return above


def byte_tree(
    spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT
) -> DataFrame:
    """path, length, top (level of the file's own node), level, number and digest of every node."""
    if range_bytes < 1 or fanout < 2:
        raise ValueError("a range has a byte or more, a node two children or more")
    files = input_files(spark, path).select("path", "length")
    leaves = F.ceil(F.col("length") / range_bytes).cast("long")
    total, most, size = files.agg(
        F.coalesce(F.sum(leaves), F.lit(0)), F.max(leaves), F.coalesce(F.sum("length"), F.lit(0))
    ).first()
    levels = 0
    while fanout**levels < (most or 1):
        levels += 1
    few = min(-(-total // FEW_RANGES), TASKS_A_CORE * spark.sparkContext.defaultParallelism)
    tasks = min(max(-(-size // BYTES_A_TASK), -(-total // RANGES_A_TASK), few, 1), MOST_TASKS)
    root = scratch_path(spark, "byte-tree")

    def write(nodes: DataFrame, level: int) -> DataFrame:
        nodes.select("path", "length", "number", "digest").write.parquet(f"{root}/level={level}")
        return spark.read.parquet(f"{root}/level={level}")

    # Neighbouring ranges in one task, so that it opens a file once.
    ranges = byte_ranges(files, range_bytes).repartitionByRange(tasks, "path", "number")
    ranges = ranges.sortWithinPartitions("path", "number")
    nodes = write(
        ranges.mapInArrow(_leaves, "path string, length long, number long, digest string"), 0
    )
    for level in range(1, levels + 1):
        # Files that have one node on the level below are complete.
        open_files = nodes.where(leaves > fanout ** (level - 1))
        children = F.sort_array(F.collect_list(F.struct("number", "digest")))
        joined = F.array_join(F.transform(children, lambda c: c["digest"]), "")
        parent = F.floor(F.col("number") / fanout).cast("long").alias("number")
        nodes = write(
            open_files.groupBy("path", "length", parent).agg(F.sha2(joined, 256).alias("digest")),
            level,
        )
    stored = spark.read.schema(
        "path string, length long, number long, digest string, level int"
    ).parquet(root)
    return stored.withColumn("top", _top_level(leaves, fanout, levels)).select(
        *[name.split()[0] for name in NODES.split(", ")]
    )


def file_digests(tree: DataFrame) -> DataFrame:
    """path, length and digest of each file."""
    return tree.where("level = top").select("path", "length", "digest")


def changed_ranges(
    before: DataFrame, after: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT
) -> DataFrame:
    """path, start and change (changed, added or removed) of ranges that differ between two trees.

    Both trees must have these sizes, and files are told apart by ``path``. A last range that grew
    or shrank is changed.
    """
    levels = max(t.agg(F.coalesce(F.max("top"), F.lit(0))).first()[0] for t in (before, after))
    differing: DataFrame | None = None
    for level in range(levels, -1, -1):
        sides = []
        for tree, name in ((before, "old"), (after, "new")):
            own = tree.where(F.col("level") == level).select("path", "number", "digest", "top")
            if differing is not None:
                parents = differing.select("path", F.col("number").alias("parent"))
                own = own.withColumn("parent", F.floor(F.col("number") / fanout).cast("long"))
                below = own.join(parents, ["path", "parent"], "left_semi").select(
                    "path", "number", "digest"
                )
                # A file's own node has no parent in this tree, but may have one in the other.
                tops = own.where(F.col("top") == level).select("path", "number", "digest")
                own = below.unionByName(tops).distinct()
            sides.append(own.select("path", "number", F.col("digest").alias(name)))
        pairs = sides[0].join(sides[1], ["path", "number"], "full_outer")
        pairs = pairs.where(~F.col("old").eqNullSafe(F.col("new")))
        kept = scratch_path(before.sparkSession, "byte-differences")
        pairs.write.parquet(kept)
        differing = before.sparkSession.read.schema(pairs.schema).parquet(kept)
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed")
    return differing.select(
        "path", (F.col("number") * range_bytes).alias("start"), change.otherwise("changed").alias("change")
    )
