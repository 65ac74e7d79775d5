"""Hard negatives by slots of scores.

An anchor's positives are its best rows of the same label. Each positive asks for the best rows of
other labels whose scores lie in a window below its own. The windows of an anchor overlap, but their
upper limits split the scores into disjoint slots, and the best k scores up to a limit are among the
best k of each slot below it. So one pass over all rows keeps k rows per slot, in every task and again
after the shuffle, however wide the windows are. Then the slots are merged from the lowest limit up;
the merge so far, cut at its k best, answers the window of that limit by its rows from the lower limit
on.

Anchors are a stated query set: they meet all rows in blocks of a bounded number, each by two passes,
for positives and for negatives. A block and the limits of its anchors are broadcast. Scores are
integer inner products by matrix products of floats, whose size is checked to leave them exact.

Defined results: rows with a null label, a null vector or a component that is null or not finite take
no part, nor do rows with a null id; a row is another one than the anchor if its id is another, and
rows that repeat count as often as they occur, also as anchors; vectors of different lengths are
filled up with zeros; ties go to the smaller id; a negative positive score has an empty window; an
empty table gives an empty result; other columns are ignored. Scores beyond 2**53 are an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deskwright.llm.arrow import map_columns
from deskwright.llm.common import stored
from deskwright.session import scratch_path

ANCHORS_EVERY = 100
POSITIVES = 5
NEGATIVES = 10
LOW_PERCENT, HIGH_PERCENT = 30, 90  # of the positive's score
SCALE = 256
BLOCK_ANCHORS = 4096  # about 4 MB of vectors and limits
CELLS = 1 << 21  # scores of one matrix product

_NONE = -(1 << 62)  # a score below all scores
_LAST = (1 << 63) - 1  # an id after all ids
_BEST = "anchor int, slot int, score long, vec_id long"
_RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, "
    "positive_score long, negative_score long"
)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label (long) and embedding of the rows that take part."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    held = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    rows = vectors.where(held & F.forall("embedding", finite))
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding"
    )


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Components times SCALE, rounded down, one row per vector."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    found = np.zeros((len(column), width))
    if (lengths == width).all():
        found[:] = flat.reshape(len(column), width)
    else:
        row, at = np.repeat(np.arange(len(column)), lengths), np.arange(len(flat))
        at -= np.repeat(np.cumsum(lengths) - lengths, lengths)
        found[row[at < width], at[at < width]] = flat[at < width]
    return np.floor(SCALE * found)


def scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products of all rows with all anchors, exact."""
    largest = np.abs(rows).max(initial=0) * np.abs(anchors).max(initial=0) * max(rows.shape[1], 1)
    if largest >= 1 << 53:
        raise ValueError("inner products beyond 2**53 are not exact")
    kind = np.float32 if largest < 1 << 24 else np.float64
    return rows.astype(kind) @ anchors.astype(kind).T


class Best:
    """The k best (score, id) of numbered groups."""

    def __init__(self, groups: int, k: int):
        self.score = np.full((groups, k), _NONE, np.int64)
        self.vec_id = np.full((groups, k), _LAST, np.int64)

    def offer(self, group: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        last_score, last_id = self.score[group, -1], self.vec_id[group, -1]
        better = (score > last_score) | (score == last_score) & (vec_id < last_id)
        group, score, vec_id = group[better], score[better], vec_id[better]
        if not len(group):
            return
        k = self.score.shape[1]
        known = np.unique(group)
        group = np.concatenate([group, np.repeat(known, k)])
        score = np.concatenate([score, self.score[known].ravel()])
        vec_id = np.concatenate([vec_id, self.vec_id[known].ravel()])
        order = np.lexsort((vec_id, -score, group))
        group = group[order]
        starts = np.searchsorted(group, known)
        place = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
        first = place < k
        self.score[group[first], place[first]] = score[order][first]
        self.vec_id[group[first], place[first]] = vec_id[order][first]

    def rows(self) -> tuple[np.ndarray, ...]:
        """group, score and vec_id of all places that are taken."""
        group, place = np.nonzero(self.score > _NONE)
        return group, self.score[group, place], self.vec_id[group, place]


@dataclass
class Block:
    """Anchors by number. ``upper`` holds the limits of the slots of each, falling, then -inf."""

    vec_id: np.ndarray
    label: np.ndarray
    copies: np.ndarray
    vectors: np.ndarray
    upper: np.ndarray | None = None
    lowest: np.ndarray | None = None


def _offer_positives(best: Best, block: Block, found: np.ndarray, label: np.ndarray, vec_id: np.ndarray) -> None:
    same = label[:, None] == block.label[None, :]
    same &= vec_id[:, None] != block.vec_id[None, :]
    same &= found >= best.score[:, -1].astype(found.dtype)
    row, anchor = np.nonzero(same)
    best.offer(anchor, found[row, anchor].astype(np.int64), vec_id[row])


def _offer_negatives(best: Best, block: Block, found: np.ndarray, label: np.ndarray, vec_id: np.ndarray) -> None:
    n_slots = block.upper.shape[1]
    other = label[:, None] != block.label[None, :]
    other &= vec_id[:, None] != block.vec_id[None, :]
    last = best.score[:, -1].reshape(-1, n_slots).astype(np.float64)
    for slot in range(n_slots):
        above = block.upper[:, slot + 1] if slot + 1 < n_slots else np.full(len(last), -np.inf)
        least = np.maximum(np.maximum(above + 1, block.lowest), last[:, slot])
        inside = other & (found <= block.upper[:, slot]) & (found >= least)
        row, anchor = np.nonzero(inside)
        best.offer(anchor * n_slots + slot, found[row, anchor].astype(np.int64), vec_id[row])


def _best_rows(rows: DataFrame, shared, n_slots: int, k: int, offer) -> DataFrame:
    """anchor, slot, score and vec_id of the k best rows of each slot, in every task."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    struct = StructType.fromDDL(_BEST)
    wire = to_arrow_schema(struct).serialize().to_pybytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = pa.ipc.read_schema(pa.py_buffer(wire))
        block = shared.value
        n, width = block.vectors.shape
        best = Best(n * n_slots, k)
        most, size = max(CELLS // max(n, 1), 1), 64
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                # Few rows at first, as all of them pass until the places are taken.
                part = batch.slice(at, min(size, most))
                at += part.num_rows
                size *= 2
                found = scores(matrix(part.column("embedding"), width), block.vectors)
                offer(best, block, found, part.column("label").to_numpy(), part.column("vec_id").to_numpy())
        group, score, vec_id = best.rows()
        made = [group // n_slots, group % n_slots, score, vec_id]
        yield pa.RecordBatch.from_arrays(
            [pa.array(m, type=f.type) for m, f in zip(made, target)], schema=target
        )

    return rows.mapInArrow(run, struct)


def _first(best: DataFrame, k: int) -> DataFrame:
    """The k best of every slot over all tasks."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _limits(block: Block, found: pa.Table) -> dict[int, list[tuple[int, int]]]:
    """Sets the limits of a block's slots; the positives (score, id) of each anchor in order."""
    positives: dict[int, list[tuple[int, int]]] = {}
    columns = (found.column(c).to_pylist() for c in ("anchor", "score", "vec_id"))
    for anchor, score, vec_id in sorted(zip(*columns), key=lambda p: (p[0], -p[1], p[2])):
        positives.setdefault(anchor, []).append((score, vec_id))
    n = len(block.vec_id)
    block.upper, block.lowest = np.full((n, POSITIVES), -np.inf), np.full(n, np.inf)
    for anchor, held in positives.items():
        uppers = sorted({upper_of(score) for score, _ in held}, reverse=True)
        block.upper[anchor, : len(uppers)] = uppers
        block.lowest[anchor] = min(lower_of(score) for score, _ in held)
    return positives


def upper_of(score: int) -> int:
    """The largest s with 100 * s <= HIGH_PERCENT * score."""
    return HIGH_PERCENT * score // 100


def lower_of(score: int) -> int:
    """The smallest s with 100 * s >= LOW_PERCENT * score."""
    return -(-LOW_PERCENT * score // 100)


def answers(
    slots: dict[int, list[tuple[int, int]]], positives: list[tuple[int, int]]
) -> Iterator[tuple[int, int, int, int, int]]:
    """positive id, rank, negative id, positive score, negative score of one anchor.

    ``slots`` are (-score, id) by the number of the slot, the highest limit first.
    """
    uppers = sorted({upper_of(score) for score, _ in positives}, reverse=True)
    merged: list[tuple[int, int]] = []
    for slot in reversed(range(len(uppers))):
        merged = sorted([*slots.get(slot, []), *merged])[:NEGATIVES]
        for score, positive in positives:
            if upper_of(score) == uppers[slot]:
                low = lower_of(score)
                for rank, (negated, vec_id) in enumerate(merged, 1):
                    if -negated < low:
                        break
                    yield positive, rank, vec_id, score, -negated


def _answered(best: DataFrame, shared_positives) -> DataFrame:
    """Results of a block from the best rows of its slots."""

    def make():
        block, positives = shared_positives.value

        def work(columns):
            found = []
            for anchor, held in zip(columns["anchor"], columns["held"]):
                slots: dict[int, list[tuple[int, int]]] = {}
                for x in held:
                    slots.setdefault(x["slot"], []).append((-x["score"], x["vec_id"]))
                for row in answers(slots, positives.get(anchor, [])):
                    found += [(int(block.vec_id[anchor]), *row)] * int(block.copies[anchor])
            names = [f.split()[0] for f in _RESULT.split(", ")]
            return dict(zip(names, zip(*found))) if found else {name: [] for name in names}

        return work

    held = F.collect_list(F.struct("slot", "score", "vec_id")).alias("held")  # at most 50
    return map_columns(best.groupBy("anchor").agg(held), make, _RESULT)


def _block(anchors: pa.Table) -> Block:
    column = anchors.column("embedding").combine_chunks()
    width = int(np.diff(column.offsets.to_numpy()).max(initial=0))
    numbers = (anchors.column(c).to_numpy() for c in ("vec_id", "label", "copies"))
    return Block(*numbers, matrix(column, width))


def mine(
    spark: SparkSession,
    vectors: DataFrame,
    anchors_every: int = ANCHORS_EVERY,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """Hard negatives of the anchors, the rows of ``vectors(vec_id, label, embedding)`` whose id is
    divisible by ``anchors_every``: a row per anchor, positive and rank."""
    rows = usable(vectors)
    anchors = (
        rows.where(F.col("vec_id") % anchors_every == 0)
        .groupBy("vec_id", "label", "embedding")
        .agg(F.count("*").alias("copies"))
    )
    anchors = stored(spark, anchors, "anchors")
    n_blocks = -(-anchors.count() // block_anchors)
    dealt = F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(max(n_blocks, 1)))
    paths = []
    for number in range(n_blocks):
        held = anchors.where(dealt == number).toArrow()
        if not held.num_rows:
            continue
        block = _block(held)
        shared = spark.sparkContext.broadcast(block)
        found = _best_rows(rows, shared, 1, POSITIVES, _offer_positives)
        positives = _limits(block, _first(found, POSITIVES).toArrow())  # POSITIVES an anchor
        limited = spark.sparkContext.broadcast(block)
        known = spark.sparkContext.broadcast((block, positives))
        found = _best_rows(rows, limited, POSITIVES, NEGATIVES, _offer_negatives)
        paths.append(scratch_path(spark, "negatives"))
        _answered(_first(found, NEGATIVES), known).write.parquet(paths[-1])
        for used in (shared, limited, known):
            used.destroy()
    if not paths:
        return spark.createDataFrame([], _RESULT)
    return spark.read.schema(_RESULT).parquet(*paths)


def relabelled(vectors: DataFrame, every: int = 7, n_labels: int = 10) -> DataFrame:
    """``vectors`` with the label of every so many ids moved on to the next."""
    moved = (F.col("label").cast("long") + 1) % n_labels
    label = F.when(F.col("vec_id") % every == 0, moved).otherwise(F.col("label").cast("long"))
    return vectors.select("vec_id", label.alias("label"), "embedding")
