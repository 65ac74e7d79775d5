"""Document fingerprints: counts of hashed byte triplets, as quartiles, and the length.

Every three successive bytes of the UTF-8 text hash into one of BUCKETS counters. The quartiles of a
document's own counters turn each counter into a code from 0 to 3; the fingerprint is the logarithm
of the length (one byte) and the codes (four to a byte), as hexadecimal text. The difference of two
fingerprints is the sum of their codes' differences, against the most it could be, plus a bounded
term for the lengths; likeness is one minus that, at least 0.

``with_next`` pairs each document with the next by id. Ids are cut into ranges at quantiles; ranges
are sorted in tasks, and the first document of a range is also sent to the range before, so that
texts are shuffled once and no task holds a range in memory.

Defined results: null text is empty text, whose codes are all 0; the likeness of two empty texts is
1; a null id comes first; rows with equal ids follow each other by text; a single row is its own
next; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwright.llm.arrow import map_columns, slices

BUCKETS = 1024
LENGTH_STEPS = 8  # codes of the length for each doubling
LENGTH_WEIGHT = 0.1  # what a doubling of the length adds to the difference
MOST_DOUBLINGS = 4
SMALLEST_ID = -(1 << 63)
RANGES_PER_PARTITION = 4


def _triplet_counts(texts: list[bytes]) -> np.ndarray:
    """A row of counters for each text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros((len(texts), BUCKETS), np.int64)
    hashed = data[:-2] * np.uint32(0x9E3779B1)
    hashed ^= data[1:-1] * np.uint32(0x85EBCA6B)
    hashed ^= data[2:] * np.uint32(0xC2B2AE35)
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(0x2C1B3C6D)
    hashed >>= np.uint32(12)
    hashed %= np.uint32(BUCKETS)
    owner = np.repeat(np.arange(len(texts)), lengths)
    inside = owner[:-2] == owner[2:]
    place = owner[:-2][inside] * BUCKETS + hashed[inside]
    return np.bincount(place, minlength=len(texts) * BUCKETS).reshape(len(texts), BUCKETS)


def digests(texts: list[bytes]) -> np.ndarray:
    """One row per text: the code of the length, then the code of every bucket."""
    counts = _triplet_counts(texts)
    cuts = [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]
    quartiles = np.partition(counts, cuts, axis=1)[:, cuts]
    codes = sum((counts > quartiles[:, i : i + 1]).astype(np.uint8) for i in range(3))
    lengths = np.array([len(t) for t in texts], np.float64)
    size = np.minimum(np.rint(LENGTH_STEPS * np.log2(1 + lengths)), 255).astype(np.uint8)
    return np.concatenate([size[:, None], codes], axis=1)


def to_text(digest: np.ndarray) -> str:
    four = digest[1:].reshape(-1, 4)
    packed = four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]
    return bytes([int(digest[0])]).hex() + packed.tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    data = np.frombuffer(bytes.fromhex(fingerprint), np.uint8)
    codes = np.stack([data[1:] >> shift & 3 for shift in (6, 4, 2, 0)], axis=1)
    return np.concatenate([data[:1], codes.reshape(-1)])


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1 for each pair of rows of digests."""
    a, b = a.astype(np.int16), b.astype(np.int16)
    apart = np.abs(a[:, 1:] - b[:, 1:]).sum(axis=1)
    most = np.maximum(a[:, 1:], b[:, 1:]).sum(axis=1)
    doublings = np.minimum(np.abs(a[:, 0] - b[:, 0]) / LENGTH_STEPS, MOST_DOUBLINGS)
    difference = apart / np.maximum(most, 1) + LENGTH_WEIGHT * doublings
    return np.maximum(0.0, 1.0 - difference)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every document."""

    def make():
        def work(columns):
            found = digests([(t or "").encode() for t in columns["text"]])
            return {"doc_id": columns["doc_id"], "fingerprint": [to_text(d) for d in found]}

        return work

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_columns(rows, make, "doc_id long, fingerprint string")


def _range_of(key: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are below ``key``, by binary search."""
    if not cuts:
        return F.lit(0)
    every = F.lit(cuts)
    steps = [1 << b for b in reversed(range(len(cuts).bit_length()))]

    def step(below: Column, size: Column) -> Column:
        cut = F.get(every, below + size - 1)
        return F.when(cut < key, below + size).otherwise(below)

    return F.aggregate(F.lit(steps), F.lit(0), step)


def in_id_order(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, text, range and ``ahead``, sorted in each partition by range, ahead, id and text.

    Rows with ``ahead`` are the first of the next range (after the last, of the first).
    """
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(SMALLEST_ID))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        key.alias("key"),
    )
    keys = rows.select("key")
    fractions = [i / ranges for i in range(1, ranges)]
    quantiles = keys.agg(F.percentile_approx("key", fractions, 100 * ranges)).first()[0]
    cuts = sorted(set(quantiles or []))
    part = _range_of(F.col("key"), cuts)
    # One row per range, whose number follows from the configuration.
    first = sorted(keys.groupBy(part.alias("part")).agg(F.min("key").alias("first")).collect())
    firsts, before = [SMALLEST_ID] * (len(cuts) + 1), [0] * (len(cuts) + 1)
    for i, row in enumerate(first):
        firsts[row["part"]] = row["first"]
        before[row["part"]] = first[i - 1]["part"]
    here = F.struct(F.col("part"), F.lit(False).alias("ahead"))
    there = F.struct(F.get(F.lit(before), F.col("part")).alias("part"), F.lit(True).alias("ahead"))
    is_first = F.col("key") == F.get(F.lit(firsts), F.col("part"))
    targets = F.when(is_first, F.array(here, there)).otherwise(F.array(here))
    return (
        rows.withColumn("part", part)
        .withColumn("to", F.explode(targets))
        .select("doc_id", "text", "key", "to.part", "to.ahead")
        .repartition("part")
        .sortWithinPartitions("part", "ahead", "key", "text")
        .select("doc_id", "text", "part", "ahead")
    )


WITH_NEXT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def edited_text(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and its edited text, and likenesses to it and the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # a row and its digest that wait for the next row
        for batch in slices(batches):
            rows = list(zip(*(batch.column(i).to_pylist() for i in range(4))))
            own = digests([text.encode() for _, text, _, _ in rows])
            if last is not None:
                rows, own = [last[0], *rows], np.concatenate([last[1], own])
            last = rows[-1], own[-1:].copy()
            pairs = [
                i for i in range(len(rows) - 1) if not rows[i][3] and rows[i][2] == rows[i + 1][2]
            ]
            if not pairs:
                continue
            edited = [edited_text(rows[i][1], rows[i + 1][1]).encode() for i in pairs]
            changed, at = digests(edited), np.array(pairs)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([rows[i][0] for i in pairs], pa.int64()),
                    "n_chars": pa.array([len(rows[i][1]) for i in pairs], pa.int64()),
                    "edited_sha256": [hashlib.sha256(e).hexdigest() for e in edited],
                    "fingerprint": [to_text(own[i]) for i in pairs],
                    "edited_fingerprint": [to_text(d) for d in changed],
                    "near_edited": likeness(own[at], changed),
                    "near_next": likeness(own[at], own[at + 1]),
                }
            )

    return in_id_order(spark, docs).mapInArrow(run, WITH_NEXT)
