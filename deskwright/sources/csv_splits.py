"""CSV with line breaks inside quotes, read split by split.

Whether a line break ends a record depends on all quotes before it. But a line only turns one of two
states, inside or outside quotes, into one of two, and such transitions compose associatively. The
first pass gives the transition of each split with the number of records that start in it, for either
state at its beginning. Composing them along a file, one row per split, gives every split its true
state and first record number. The second pass cuts the splits into records, all at once; pieces of
records that cross a border are put together by record number, at most two for each split.

A field is quoted if it begins with a quote; a doubled quote inside is a quote. Characters after the
closing quote make the field unquoted up to the next comma. Empty lines are no records. Lines end with
a line feed. If a carriage return precedes the first one of a file, it is left out before all of them,
as Spark's own reader does. A record open at the end of its file ends there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskwright.session import scratch_path
from deskwright.sources.numbering import BLOCK, BROADCAST_SPLITS, FILE, POSITION

_LINE = "_line"
_SPLITS = (
    f"{FILE} string, {BLOCK} long, inside_if_outside boolean, inside_if_inside boolean, "
    "starts_if_outside long, starts_if_inside long, returns boolean"
)
_ENTRIES = f"{FILE} string, {BLOCK} long, inside boolean, before long, returns boolean"
_PIECES = f"{FILE} string, {BLOCK} long, number long, piece string, whole boolean"
_RECORDS = f"{FILE} string, number long, piece string"

# A field and the comma after it, from a place outside quotes.
_FIELD = re.compile(r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|),')
_OPEN = re.compile(r'"[^"]*+(?:""[^"]*+)*+\Z')
# The rest of a quoted field and of its line up to the next comma, from a place inside quotes.
_CLOSE = re.compile(r'[^"]*+(?:""[^"]*+)*+"[^,]*+')


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside quotes that begins inside or outside of them."""
    if '"' not in line:
        return inside
    at = 0
    if inside:
        closed = _CLOSE.match(line)
        if closed is None:
            return True
        at = closed.end()
        if at == len(line):
            return False
        at += 1  # the comma
    while True:
        field = _FIELD.match(line, at)
        if field is None:
            return _OPEN.match(line, at) is not None
        at = field.end()


# Splits may be much smaller than what is worth a task.
TASK_BYTES, TASKS_A_CORE = 32 * 1024 * 1024, 4


def in_larger_tasks(scan: DataFrame) -> DataFrame:
    """A file scan whose tasks take several whole splits each, where its splits are small."""
    spark = scan.sparkSession
    splits = scan.rdd.getNumPartitions()
    tasks = max(-(-splits * split_bytes(spark) // TASK_BYTES), TASKS_A_CORE * spark.sparkContext.defaultParallelism)
    return scan.coalesce(tasks) if tasks < splits else scan


def split_bytes(spark: SparkSession) -> int:
    """The most bytes of a split."""
    given = spark.conf.get("spark.sql.files.maxPartitionBytes")
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(given)


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """_file, _block and _line of the files' lines, in order inside a split."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    placed = lines.select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.col("value").alias(_LINE),
    )
    return in_larger_tasks(placed)


def _mapped(frame: DataFrame, schema: str, make) -> DataFrame:
    """``frame`` through ``make()``, a function from a row (None at the end) to rows."""
    from pyspark.sql.pandas.types import to_arrow_schema

    struct = T.StructType.fromDDL(schema)
    wire = to_arrow_schema(struct).serialize().to_pybytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = pa.ipc.read_schema(pa.py_buffer(wire))
        step = make()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [()] * len(target)
            arrays = [pa.array(c, type=f.type) for c, f in zip(columns, target)]
            return pa.RecordBatch.from_arrays(arrays, schema=target)

        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            yield batch_of([made for row in zip(*columns) for made in step(row)])
        yield batch_of(list(step(None)))

    return frame.mapInArrow(run, struct)


def _transitions():
    """Lines of splits to one row per split."""
    split, ends, starts, returns = None, [False, True], [0, 0], False

    def step(row):
        nonlocal split, ends, starts, returns
        if row is None or row[:2] != split:
            if split is not None:
                yield (*split, *ends, *starts, returns)
            if row is None:
                return
            split, ends, starts = row[:2], [False, True], [0, 0]
            returns = row[2].endswith("\r")
        line = row[2]
        for i in (0, 1):
            if not ends[i] and line not in ("", "\r"):
                starts[i] += 1
            ends[i] = ends_inside(line, ends[i])

    return step


def _entries(splits: DataFrame) -> DataFrame:
    """The state at the beginning of every split and the records that start before it in the file."""

    def compose(table):
        rows = sorted(table.to_pylist(), key=lambda r: r[BLOCK])
        inside, before, returns, found = False, 0, rows[0]["returns"], []
        for r in rows:
            entry = {"inside": inside, "before": before, "returns": returns}
            found.append({FILE: r[FILE], BLOCK: r[BLOCK], **entry})
            kind = "inside" if inside else "outside"
            inside, before = r[f"inside_if_{kind}"], before + r[f"starts_if_{kind}"]
        kinds = [(FILE, pa.string()), (BLOCK, pa.int64()), ("inside", pa.bool_()), ("before", pa.int64())]
        return pa.Table.from_pylist(found, schema=pa.schema([*kinds, ("returns", pa.bool_())]))

    # A row per split of one file, not its lines.
    return splits.groupBy(FILE).applyInArrow(compose, _ENTRIES)


def _cut():
    """Lines with the state and number at their split's beginning to records and pieces of them."""
    split, lines, number, inside, whole = None, [], 0, False, True

    def piece(at_end: bool):
        """The record so far; it is whole unless the split's border cuts it."""
        return (*split, number, "\n".join(lines), whole and not at_end)

    def step(row):
        nonlocal split, lines, number, inside, whole
        if row is None or row[:2] != split:
            if lines:
                yield piece(at_end=True)
            if row is None:
                return
            split, lines = row[:2], []
            inside, number = row[3], row[4]
            whole = not inside  # what begins inside quotes belongs to the last record before
        line = row[2].removesuffix("\r") if row[5] else row[2]
        if not inside:
            if line in ("", "\r"):
                return
            number += 1
            whole = True
        lines.append(line)
        inside = ends_inside(line, inside)
        if not inside:
            yield piece(at_end=False)
            lines, whole = [], True

    return step


def csv_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """_file, number (from 1 in the file, the header is 1) and record of CSV files."""
    lines = read_lines(spark, paths)
    path = scratch_path(spark, "csv-splits")
    _entries(_mapped(lines, _SPLITS, _transitions)).write.parquet(path)
    entries = spark.read.schema(_ENTRIES).parquet(path)
    if entries.count() <= BROADCAST_SPLITS:
        entries = F.broadcast(entries)
    known = F.when(F.col("before").isNotNull(), F.col("before")).otherwise(
        F.raise_error(F.lit("input files changed while records were cut")).cast("long")
    )
    entered = lines.join(entries, [FILE, BLOCK], "left").select(
        FILE, BLOCK, _LINE, "inside", known.alias("before"), "returns"
    )
    # Written once: rows are numbered from the pieces and read from them.
    cut, joined = scratch_path(spark, "csv-pieces"), scratch_path(spark, "csv-crossing")
    _mapped(entered, _PIECES, _cut).write.parquet(cut)
    pieces = in_larger_tasks(spark.read.schema(_PIECES).parquet(cut))
    ordered = F.sort_array(F.collect_list(F.struct(BLOCK, "piece")))
    pieces.where("NOT whole").groupBy(FILE, "number").agg(
        F.array_join(F.transform(ordered, lambda p: p["piece"]), "\n").alias("piece")
    ).write.parquet(joined)
    crossing = in_larger_tasks(spark.read.schema(_RECORDS).parquet(joined))
    found = pieces.where("whole").select(FILE, "number", "piece").unionByName(crossing)
    return found.select(FILE, "number", _record(F.col("piece"), F.col("number")).alias("record"))


def _record(piece: Column, number: Column) -> Column:
    """The text of a record, without the mark before a file's first."""
    marked = (number == 1) & piece.startswith("\ufeff")
    return F.when(marked, F.substr(piece, F.lit(2))).otherwise(piece)


def parsed_records(
    spark: SparkSession, paths: str | list[str], names: list[str]
) -> DataFrame:
    """_file, _block (0), _position in the file and the columns ``names`` of CSV files with a header."""
    schema = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in names)
    options = {"escape": '"', "multiLine": "true", "lineSep": "\n"}
    rows = csv_records(spark, paths).where("number > 1")
    values = F.from_csv("record", schema, options).alias("values")
    return rows.select(
        FILE, F.lit(0).cast("long").alias(BLOCK), (F.col("number") - 2).alias(POSITION), values
    ).select(FILE, BLOCK, POSITION, "values.*")
