"""Fill-in-middle texts by secondary sort.

A text is cut into units: words with the white space before them, and white space at its end. Two
hashes of the id choose where prefix and middle end, two more whether and how the parts change
places. Every part is emitted as pieces of a bounded number of units, keyed by document and by place
in the output. One shuffle by document and a sort by place stream the pieces of each output in order
through an incremental digest. What streams by is read back from the output and its form alone: marks
name the parts, and a second sort of the same partitions brings the pieces into the order of the
text, again through a digest. No task holds more than a piece of a text, unless texts are asked for.

Rows are told apart by id, text and the partition that they come from; rows of a partition that agree
in all are one set of pieces with a count, and come out as often as they came in. So copies of one
text, however many, are spread over the partitions that they come from.

Defined results: null text is empty text; empty texts, and texts that hold a mark, stay plain; a null
id hashes like the empty text; rows that share an id are cut by the same hashes; an empty table gives
an empty result; other columns are ignored; a text may have any length, but a unit is never split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwright.llm.arrow import map_columns, slices
from deskwright.llm.common import SPACES

SEED = 42
MOVED_PERCENT = 50  # of the texts that are not empty and hold no mark
SPM_PERCENT = 80  # of the moved ones: suffix, prefix, middle; the others prefix, suffix, middle
PIECE_UNITS = 4096

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLACES = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}  # of the parts in the text
PLAIN, PSM, SPM = "plain", "psm", "spm"
_END = 3  # after all parts

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES.encode())] = True

KEY = ["origin", "doc_id", "text_id"]
_ABOUT = "copies long, n long, form string, prefix_chars long, middle_chars long"
_PIECES = f"origin int, doc_id long, text_id binary, place int, piece string, {_ABOUT}"
_PARTS = (
    "origin int, doc_id long, text_id binary, part int, place int, piece string, "
    f"{_ABOUT}, output_sha256 string, output string"
)
_RESULT = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
    "output_sha256 string, restored_sha256 string, output string, restored string"
)


def unit_ends(data: bytes) -> np.ndarray:
    """Where the units of a text end, in bytes."""
    space = _IS_SPACE[np.frombuffer(data, np.uint8)]
    if not len(space):
        return np.zeros(0, np.int64)
    last = ~space
    last[:-1] &= space[1:]
    last[-1] = True  # a word, or white space at the end
    return np.flatnonzero(last) + 1


def choices(doc_id: int | None, seed: int) -> list[int]:
    """The four hashes of an id."""
    spelled = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(spelled[i : i + 8], 16) for i in range(0, 32, 8)]


def cut(
    doc_id: int | None, text: str, data: bytes, ends: np.ndarray, seed: int, moved: int, spm: int
) -> tuple[str, list[tuple[str, int, int]]]:
    """The form, and the output's parts in order as (mark, first unit, unit after the last)."""
    n = len(ends)
    h1, h2, h3, h4 = choices(doc_id, seed)
    if not n or h3 % 100 >= moved or any(mark in text for mark in PLACES):
        return PLAIN, [("", 0, n)]
    p, q = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = (PREFIX, 0, p), (MIDDLE, p, q), (SUFFIX, q, n)
    if h4 % 100 < spm:
        return SPM, [suffix, prefix, middle]
    return PSM, [prefix, suffix, middle]


def _pieces(docs: DataFrame, seed: int, moved: int, spm: int, units: int) -> DataFrame:
    """The outputs' pieces by place; what is known of the document stands at its first piece."""

    def make():
        def work(columns):
            rows: dict[tuple, int] = {}
            for row in zip(columns["origin"], columns["doc_id"], columns["text"]):
                rows[row] = rows.get(row, 0) + 1
            found = []
            for (origin, doc_id, text), copies in rows.items():
                text = text or ""
                data = text.encode()
                key = (origin, doc_id, hashlib.blake2b(data, digest_size=16).digest())
                ends = unit_ends(data)
                form, parts = cut(doc_id, text, data, ends, seed, moved, spm)
                at = [0, *ends.tolist()]
                chars = {m: len(data[at[i] : at[j]].decode()) for m, i, j in parts if m}
                about = (copies, len(ends), form, chars.get(PREFIX), chars.get(MIDDLE))
                place = 0
                for mark, first, stop in parts:
                    for i in range(first, max(stop, first + 1), units):
                        piece = data[at[i] : at[min(i + units, stop)]].decode()
                        found.append((*key, place, mark + piece, *about))
                        mark, place, about = "", place + 1, (None,) * 5
            names = [f.split()[0] for f in _PIECES.split(", ")]
            return dict(zip(names, zip(*found))) if found else {name: [] for name in names}

        return work

    rows = docs.select(
        F.spark_partition_id().alias("origin"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    return map_columns(rows, make, _PIECES)


def _streamed(frame: DataFrame, schema: str, make) -> DataFrame:
    """``frame`` through ``make()``: a function from a row to rows, then None for the end."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    struct = StructType.fromDDL(schema)
    wire = to_arrow_schema(struct).serialize().to_pybytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = pa.ipc.read_schema(pa.py_buffer(wire))
        step = make()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [()] * len(target)
            arrays = [pa.array(c, type=f.type) for c, f in zip(columns, target)]
            return pa.RecordBatch.from_arrays(arrays, schema=target)

        for batch in slices(batches):
            columns = [column.to_pylist() for column in batch.columns]
            yield batch_of([made for row in zip(*columns) for made in step(row)])
        yield batch_of(list(step(None)))

    return frame.mapInArrow(run, struct)


def _assembled(with_texts: bool):
    """Pieces of outputs in order to their parts, and after them what is known of the document."""
    key = about = digest = place = None
    part = number = 0
    texts: list[str] = []

    def finish():
        if key is not None:
            whole = "".join(texts) if with_texts else None
            yield (*key, _END, 0, None, *about, digest.hexdigest(), whole)

    def step(row):
        nonlocal key, about, digest, place, part, number
        if row is None:
            yield from finish()
            return
        *own, at, piece, copies, n, form, prefix_chars, middle_chars = row
        if own != key:
            yield from finish()
            key, about, digest, place = own, [0, n, form, prefix_chars, middle_chars], hashlib.sha256(), -1
            part = number = 0
            texts.clear()
        if at == 0:
            about[0] += copies
        if at == place:  # the same piece of equal rows
            return
        place = at
        digest.update(piece.encode())
        if with_texts:
            texts.append(piece)
        mark = piece[: len(PREFIX)]
        if about[2] != PLAIN and mark in PLACES:
            part, number, piece = PLACES[mark], 0, piece[len(mark) :]
        yield (*key, part, number, piece, *(None,) * 7)
        number += 1

    return step


def _restored(with_texts: bool):
    """Parts in the order of the text to one row per document."""
    digest = hashlib.sha256()
    texts: list[str] = []

    def step(row):
        nonlocal digest
        if row is None:
            return
        _, doc_id, _, part, _, piece, copies, *about, output = row
        if part < _END:
            digest.update(piece.encode())
            if with_texts:
                texts.append(piece)
            return
        whole = "".join(texts) if with_texts else None
        found = (doc_id, *about, digest.hexdigest(), output, whole)
        digest = hashlib.sha256()
        texts.clear()
        for _ in range(copies):
            yield found

    return step


def transform(
    spark: SparkSession,
    docs: DataFrame,
    seed: int = SEED,
    moved_percent: int = MOVED_PERCENT,
    spm_percent: int = SPM_PERCENT,
    piece_units: int = PIECE_UNITS,
    with_texts: bool = True,
) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output_sha256, restored_sha256, and the
    texts themselves, ``output`` and ``restored`` (null unless ``with_texts``), of every document of
    ``docs(doc_id, text)``.

    ``moved_percent`` of the texts get their parts in another order, ``spm_percent`` of these with
    the suffix first. ``restored`` is made from the output and its form.
    """
    pieces = _pieces(docs, seed, moved_percent, spm_percent, piece_units)
    dealt = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "place")
    parts = _streamed(dealt, _PARTS, lambda: _assembled(with_texts))
    ordered = parts.sortWithinPartitions(*KEY, "part", "place")
    return _streamed(ordered, _RESULT, lambda: _restored(with_texts))
