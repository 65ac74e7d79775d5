"""Dense source row numbers, offsets and batch indexes.

Numbers follow (file path, position in the file). Nothing is sorted or moved: a first narrow pass
counts rows per file split, a running sum over those counts gives each split its start, and the
second pass adds the position inside the split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskwright.session import scratch_path

# Columns a reader adds so that rows can be numbered.
FILE, BLOCK, POSITION = "_file", "_block", "_position"
BROADCAST_SPLITS = 500_000  # about 100 MB
_MINIMUM_SPLITS = "spark.sql.files.minPartitionNum"


def pin_split_layout(spark: SparkSession) -> None:
    """Make every scan of the same files cut them alike.

    Spark sizes splits by the cores it has at that moment, which change as executors come and go;
    a fixed minimum makes the layout a function of the files alone.
    """
    if spark.conf.get(_MINIMUM_SPLITS, None) is None:
        spark.conf.set(_MINIMUM_SPLITS, str(spark.sparkContext.defaultParallelism))


def scan_position(row_index: bool, stream: bool = False) -> list[Column]:
    """Where a scanned row sits: exact index for Parquet, running id per split for text.

    A streaming plan cannot hold the running id; ``number_rows`` adds it inside the micro-batch.
    """
    if row_index:
        return [
            F.col("_metadata.file_path").alias(FILE),
            F.lit(0).cast("long").alias(BLOCK),
            F.col("_metadata.row_index").alias(POSITION),
        ]
    return [
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        *([] if stream else [F.monotonically_increasing_id().alias(POSITION)]),
    ]


def file_starts(scan: DataFrame, rows: Column | None = None) -> DataFrame:
    """One row per file: its number of rows and the number of rows in the files before it.

    The window has one row per input file and no partition key. That is the listing which the Spark
    driver already holds to plan the scan, not data.
    """
    files = scan.groupBy(FILE).agg((F.count("*") if rows is None else rows).alias("_file_rows"))
    before = Window.orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_file_rows").over(before), F.lit(0))
    return files.select(FILE, "_file_rows", start.alias("_file_start"))


def split_rows(scan: DataFrame) -> DataFrame:
    """One row per file split: first position and number of rows."""
    return scan.groupBy(FILE, BLOCK).agg(F.min(POSITION).alias("_first"), F.count("*").alias("_rows"))


def split_starts(splits: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """The first position of every one of ``splits`` (see ``split_rows``) and the number of rows before it.

    ``files`` are the file starts of a scan of these files or of more; if not given, of these splits.
    """
    if files is None:
        files = file_starts(splits, F.sum("_rows"))
    before_split = (
        Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    )
    return splits.join(files.select(FILE, "_file_start"), FILE).select(
        FILE,
        BLOCK,
        "_first",
        (
            F.col("_file_start") + F.coalesce(F.sum("_rows").over(before_split), F.lit(0))
        ).alias("_start"),
    )


def _stored(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def number_rows(
    scan: DataFrame,
    first_number: int = 1,
    single_file: bool = False,
    files: DataFrame | None = None,
) -> DataFrame:
    """Replace the position columns by a dense ``row_number`` starting at ``first_number``.

    The rows of every split are counted in one scan and written out, as file and split starts both
    need them, and so are the split starts. Up to BROADCAST_SPLITS of these are broadcast, so that
    rows are not moved; beyond that rows join by split (for Parquet and multi-line CSV, by file).
    ``single_file`` says that positions are already row indexes of one file. With the ``files`` of a
    larger scan, numbers are those that the rows have there.
    """
    if single_file:
        number = F.col(POSITION) + F.lit(first_number).cast("long")
        return scan.select(number.alias("row_number"), "*").drop(FILE, BLOCK, POSITION)
    if POSITION not in scan.columns:
        scan = scan.withColumn(POSITION, F.monotonically_increasing_id())
    counted = _stored(split_rows(scan), "split-rows")
    starts = _stored(split_starts(counted, files), "splits")
    if starts.count() <= BROADCAST_SPLITS:
        starts = F.broadcast(starts)
    number = F.col("_start") + F.col(POSITION) - F.col("_first") + F.lit(first_number)
    checked = F.when(F.col("_start").isNotNull(), number).otherwise(
        F.raise_error(F.lit("input files changed while rows were numbered")).cast("long")
    )
    numbered = scan.join(starts, [FILE, BLOCK], "left").select(checked.alias("row_number"), "*")
    return numbered.drop(FILE, BLOCK, POSITION, "_first", "_start")


def skip_rows(rows: DataFrame, offset: int) -> DataFrame:
    """Rows after a durable offset."""
    return rows.where(F.col("row_number") > offset)


def batch_index(row_number: Column, batch_size: int) -> Column:
    """1-based index of the fixed-size batch a row falls in; the last batch may be short."""
    return (F.floor((row_number - 1) / F.lit(batch_size)) + 1).cast("long")


# A task with so many times its fair share of the rows makes the others wait.
UNEVEN = 2
# Rows that are moved go to tasks of about so many, which take seconds to evaluate.
SPREAD_ROWS = 100_000


def spread(
    rows: DataFrame,
    scan: DataFrame | None = None,
    row_groups: bool = False,
    by: str | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Use all cores when an input was cut into fewer tasks than there are cores, or into uneven ones.

    Large texts already have many more splits than cores and are returned as they are, not shuffled.
    ``scan`` is the bare file scan behind ``rows``: asking it for its number of splits runs nothing.
    With ``row_groups`` the scan is of Parquet files. A split of these may hold nothing, since row groups
    are read whole, or millions of rows: rows are counted by split, from the files' footers. ``bounded``
    is for long work on each row: rows of Parquet files are moved as well if a task would have many more
    than SPREAD_ROWS, so that the longest does not grow with the input. ``by`` names a unique column,
    which saves sorting rows that are moved.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    scan = rows if scan is None else scan
    wanted, uneven = cores, scan.rdd.getNumPartitions() < cores
    if row_groups:
        held = scan.groupBy(F.spark_partition_id().alias("split")).agg(F.count("*").alias("n"))
        most, total = held.agg(F.max("n"), F.sum("n")).first()
        fair = (total or 0) / cores
        uneven = uneven or (most or 0) > UNEVEN * (min(fair, SPREAD_ROWS) if bounded else fair)
        wanted = max(cores, -(-(total or 0) // SPREAD_ROWS))
    return rows.repartition(wanted, *([by] if by else [])) if uneven else rows
