"""Ticket exports as one row envelope.

Envelope columns: ``row_number``, ``data`` (a struct, or a VARIANT for JSON Lines), ``line`` (JSON
Lines only: the text itself) and ``read_error``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskwright import fixed
from deskwright.functions import sql
from deskwright.functions.text import truncate
from deskwright.session import scratch_path
from deskwright.sources.csv_splits import in_larger_tasks, parsed_records, split_bytes
from deskwright.sources.formats import detect_format
from deskwright.sources.numbering import (
    BLOCK,
    FILE,
    POSITION,
    file_starts,
    number_rows,
    pin_split_layout,
    scan_position,
    spread,
)

# CSV rows with more fields than the header put the first surplus value here.
SURPLUS = "__surplus"
FILE_INDEX = f"{FILE} string, _file_rows long, _file_start long"


def csv_columns(spark: SparkSession, path: str, multi_line: bool = True) -> list[str]:
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    columns = reader.option("escape", '"').csv(path).columns
    if not columns:
        raise ValueError("CSV input has no header")
    return columns


def _has_long_files(spark: SparkSession, path: str) -> bool:
    """Whether a file is longer than a split; its listing is read, not the file."""
    lengths = spark.read.format("binaryFile").load(path).agg(F.max("length"))
    return (lengths.first()[0] or 0) > split_bytes(spark)


def headers_of(spark: SparkSession, files: list[str]) -> DataFrame:
    """file and header (the first line with text) of CSV files."""
    lines = in_larger_tasks(spark.read.text(files)).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("place"),
        "value",
    )
    header = F.min_by("value", F.when(F.trim("value") != "", F.col("place"))).alias("header")
    return lines.groupBy("file").agg(header)


class FilesByHeader:
    """The files of a CSV export by their headers, found once however often the export is scanned.

    Finding them reads the lines of all files.
    """

    def __init__(self, spark: SparkSession, path: str, multi_line: bool = True) -> None:
        self.spark, self.path, self.multi_line = spark, path, multi_line

    @functools.cached_property
    def groups(self) -> list[tuple[list[str], list[str]]]:
        """Files and their columns, a pair per different header; none if there are not two headers."""
        # Listings and columns have names encoded.
        files = [unquote(f) for f in self.spark.read.text(self.path).inputFiles()]
        if len(files) < 2:
            return []
        headed = headers_of(self.spark, files).where(F.col("header").isNotNull())
        groups = headed.groupBy("header").agg(F.collect_list("file").alias("files"))
        # A row per different header; the files are those of the driver's own listing.
        found = sorted(groups.collect(), key=lambda r: min(r["files"]))
        if len(found) < 2:
            return []
        held = [[unquote(f) for f in r["files"]] for r in found]
        return [(files, csv_columns(self.spark, files[0], self.multi_line)) for files in held]


def _from_csv(
    spark: SparkSession,
    reader,
    path: str,
    columns: list[str],
    multi_line: bool,
    stream: bool,
    only: list[str] | None = None,
    headers: FilesByHeader | None = None,
) -> DataFrame:
    """CSV values by the name in their own file's header; the first file's columns count."""
    in_splits = multi_line and not stream and _has_long_files(spark, path)

    def scan(files: str | list[str], names: list[str]) -> DataFrame:
        if in_splits:
            return placed(parsed_records(spark, files, [*names, SURPLUS]), names, [FILE, BLOCK, POSITION])
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, SURPLUS]])
        rows = (
            reader.schema(schema)
            .option("header", True)
            .option("multiLine", multi_line)
            .option("escape", '"')
            .csv(files)
        )
        return placed(rows, names, scan_position(row_index=False, stream=stream))

    def placed(rows: DataFrame, names: list[str], position: list) -> DataFrame:
        too_long = F.when(F.col(SURPLUS).isNotNull(), F.lit("row has more fields than the header"))
        values = [F.col(sql.name(c)) if c in names else F.lit(None).cast("string") for c in columns]
        return rows.select(
            *position,
            F.struct(*[v.alias(c) for v, c in zip(values, columns)]).alias("data"),
            too_long.alias("read_error"),
        )

    if stream:
        return scan(path, columns)
    named = (headers or FilesByHeader(spark, path, multi_line)).groups
    if not named:
        return scan(only or path, columns)
    columns = list(dict.fromkeys(name for _, names in named for name in names))
    held = [([f for f in files if not only or f in only], names) for files, names in named]
    return reduce(DataFrame.unionByName, [scan(files, names) for files, names in held if files])


def check_headers(rows: DataFrame) -> None:
    """Refuse a micro-batch of CSV files whose headers are not the stream's columns in order.

    A stream reads by position, as its files are not known when it starts.
    """
    named = rows.select(FILE).where(F.lower(FILE).endswith(".csv")).distinct()
    files = [unquote(r[0]) for r in named.collect()]  # at most the files of one trigger
    if not files:
        return
    spark, columns = rows.sparkSession, rows.schema["data"].dataType.names
    headed = headers_of(spark, files).where(F.col("header").isNotNull())
    for r in headed.groupBy("header").agg(F.min("file").alias("file")).collect():
        if csv_columns(spark, unquote(r["file"])) != columns:
            raise ValueError(f"the header of {r['file']} is not that of the stream")


def _from_json_lines(reader, path: str, stream: bool) -> DataFrame:
    scan = reader.text(path).select(
        *scan_position(row_index=False, stream=stream),
        F.col("value").alias("line"),
        F.try_parse_json("value").alias("data"),
    )
    is_object = F.schema_of_variant("data").startswith("OBJECT")
    return scan.withColumn(
        "read_error",
        F.when(F.col("data").isNull(), F.lit("line is not valid JSON")).when(
            ~is_object, F.lit("JSON Lines value must be an object")
        ),
    )


def _from_parquet(reader, paths: list[str], schema: T.StructType | None) -> DataFrame:
    reader = reader.schema(schema) if schema is not None else reader
    scan = reader.parquet(*paths)
    return scan.select(
        *scan_position(row_index=True),
        F.struct(*[F.col(sql.name(c)) for c in scan.columns]).alias("data"),
        F.lit(None).cast("string").alias("read_error"),
    )


def scan_export(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    multi_line: bool = True,
    stream: bool = False,
    schema: T.StructType | None = None,
    only: list[str] | None = None,
    headers: FilesByHeader | None = None,
    **options: str,
) -> DataFrame:
    """Unnumbered envelope with the position columns, as a batch or a stream.

    ``multi_line`` lets CSV values span lines. A batch with files longer than a split is then read split
    by split (see csv_splits), other files and all files of a stream in one task each. Switch it off for
    exports without quoted newlines, which are read in one pass. A Parquet stream needs the ``schema``;
    a batch takes it from the files. ``only`` reads some of a batch's files, as if they
    were scanned among all. ``headers`` are those of the export, for a job that scans it several times.
    """
    pin_split_layout(spark)
    # Duplicate JSON keys keep the last value instead of spoiling the line.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    fmt = detect_format(path, fmt)
    reader = (spark.readStream if stream else spark.read).options(**options)
    if fmt == "csv":
        columns = schema.names if schema else csv_columns(spark, path, multi_line)
        return _from_csv(spark, reader, path, columns, multi_line, stream, only, headers)
    if fmt == "jsonl":
        return _from_json_lines(reader, only or path, stream)
    if only and schema is None:
        schema = reader.parquet(path).schema
    return _from_parquet(reader, only or [path], schema)


def numbered_tickets(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    multi_line: bool = True,
    headers: FilesByHeader | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Numbered envelope of an export, in the tasks that its files are cut into, and the bare scan."""
    fmt = detect_format(path, fmt)
    scan = scan_export(spark, path, fmt, multi_line, headers=headers)
    single = fmt == "parquet" and len(scan.inputFiles()) == 1
    return number_rows(scan, single_file=single), scan


def spread_tickets(numbered: DataFrame, scan: DataFrame, fmt: str, bounded: bool = False) -> DataFrame:
    """A numbered envelope with its rows spread over the cores, ``bounded`` for long work on each."""
    return spread(numbered, scan, row_groups=fmt == "parquet", by="row_number", bounded=bounded)


def read_tickets(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    multi_line: bool = True,
    headers: FilesByHeader | None = None,
) -> DataFrame:
    """Numbered envelope of an export file or of a folder of export files."""
    fmt = detect_format(path, fmt)
    return spread_tickets(*numbered_tickets(spark, path, fmt, multi_line, headers), fmt)


class IndexedExport:
    """An export whose row ranges are read from the files that hold them.

    The index has the number of rows and the first row of every file. It is written to ``index`` by
    the first pass and read again by every later one, also of another session. So units of work and
    a resumed run read their share of the files and not the export; a single file is read whole.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        index: str,
        fmt: str | None = None,
        multi_line: bool = True,
        headers: FilesByHeader | None = None,
    ) -> None:
        self.spark, self.path, self.multi_line = spark, path, multi_line
        self.headers = headers or FilesByHeader(spark, path, multi_line)
        self.fmt = detect_format(path, fmt)
        self.index = self._stored(index)
        if self.index is None:  # one file, so that it is there as a whole or not at all
            file_starts(self._scan()).coalesce(1).write.mode("overwrite").parquet(index)
            self.index = spark.read.schema(FILE_INDEX).parquet(index)
        self.total = self.index.agg(F.coalesce(F.sum("_file_rows"), F.lit(0))).first()[0]

    def _stored(self, index: str) -> DataFrame | None:
        try:
            found = self.spark.read.schema(FILE_INDEX).parquet(index)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return None if found.isEmpty() else found

    def _scan(self, only: list[str] | None = None) -> DataFrame:
        return scan_export(
            self.spark, self.path, self.fmt, self.multi_line, only=only, headers=self.headers
        )

    def files(self, after: int, until: int) -> list[str]:
        """The files with rows after number ``after`` up to ``until``; part of the driver's listing."""
        end = F.col("_file_start") + F.col("_file_rows")
        overlapping = self.index.where((F.col("_file_start") < until) & (end > after))
        return sorted(r[0] for r in overlapping.select(FILE).collect())

    def numbered(self, after: int = 0, until: int | None = None) -> tuple[DataFrame, DataFrame]:
        """Numbered envelope of the rows after number ``after`` up to ``until``, and the bare scan."""
        until = self.total if until is None else until
        scan = self._scan([unquote(f) for f in self.files(after, until)] or None)
        numbered = number_rows(scan, files=self.index)
        inside = (F.col("row_number") > after) & (F.col("row_number") <= until)
        return numbered.where(inside), scan

    def rows(self, after: int = 0, until: int | None = None) -> DataFrame:
        """The same envelope alone, spread over the cores."""
        return spread_tickets(*self.numbered(after, until), self.fmt)


def envelope_of(rows: DataFrame, row_number: Column | str = "row_number") -> DataFrame:
    """Envelope of a table that already carries its row numbers."""
    number = F.col(row_number) if isinstance(row_number, str) else row_number
    fields = [c for c in rows.columns if c != row_number]
    return rows.select(
        number.cast("long").alias("row_number"),
        F.struct(*[F.col(sql.name(c)) for c in fields]).alias("data"),
        F.lit(None).cast("string").alias("read_error"),
    )


class LineValue(T.VariantType):
    """Type of a JSON Lines value, with the SQL of a number's text in its line if there is one."""

    def __init__(self, number: str | None):
        self.number = number


# How the schema of a variant names numbers.
NUMBER_KINDS = "^(BIGINT|DOUBLE|FLOAT|DECIMAL)"


def field_reader(envelope: DataFrame) -> Callable[[str], tuple[str, T.DataType]]:
    """Access to a payload field by its exact name: its SQL and type.

    A field the payload does not have is a null string. Names are case-sensitive.
    """
    dtype = envelope.schema["data"].dataType
    if isinstance(dtype, T.StructType):
        known = {f.name: f.dataType for f in dtype.fields}

        def read(name: str) -> tuple[str, T.DataType]:
            if name not in known:
                return "CAST(NULL AS STRING)", T.StringType()
            return f"data.{sql.name(name)}", known[name]

        return read

    def read_variant(name: str) -> tuple[str, T.DataType]:
        quoted = name.replace("\\", "\\\\").replace('"', '\\"')
        path = sql.text('$["' + quoted + '"]')
        # Numbers keep the text that they have in the line: a variant does not tell 1 from 1.0.
        plain = "'" not in name and "]" not in name and "\\" not in name
        number = f"get_json_object(line, {sql.text(chr(36) + '[' + chr(39) + name + chr(39) + ']')})"
        return f"try_variant_get(data, {path}, 'variant')", LineValue(number if plain else None)

    return read_variant


def as_text(x: str, dtype: T.DataType) -> str:
    """SQL text of a payload value; zero, false and empty collections count as empty."""
    if isinstance(dtype, T.StringType):
        return x
    if isinstance(dtype, T.BooleanType):
        return f"CASE WHEN {x} THEN 'True' ELSE '' END"
    if isinstance(dtype, T.NumericType):
        return f"CASE WHEN {x} <> 0 THEN cast({x} AS STRING) ELSE '' END"
    if isinstance(dtype, T.VariantType):
        given = f"try_variant_get({x}, '$', 'string')"
        if isinstance(dtype, LineValue) and dtype.number:
            text = as_text(x, T.VariantType())
            zero = f"try_cast({dtype.number} AS DOUBLE) = 0"
            return (
                f"CASE WHEN rlike(schema_of_variant({x}), '{NUMBER_KINDS}') "
                f"THEN CASE WHEN {zero} THEN '' ELSE {dtype.number} END ELSE {text} END"
            )
        return (
            f"CASE WHEN {given} IN ('0', 'true', 'false', '[]', '{{}}') "
            f"AND schema_of_variant({x}) <> 'STRING' "
            f"THEN CASE WHEN {given} = 'true' THEN 'True' ELSE '' END ELSE {given} END"
        )
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return f"CASE WHEN size({x}) > 0 THEN to_json({x}) ELSE '' END"
    if isinstance(dtype, T.StructType):
        return f"to_json({x})"
    return f"cast({x} AS STRING)"


def as_time_text(x: str, dtype: T.DataType) -> str:
    """SQL text of a payload value that should be a time; numbers keep their digits."""
    if isinstance(dtype, T.VariantType):
        return f"try_variant_get({x}, '$', 'string')"
    return f"cast({x} AS STRING)"


def raw_line_payload(line: Column) -> Column:
    """What is kept of a line that could not be read."""
    return F.struct(truncate(line, fixed.RAW_LINE_CHARS).alias("raw"))
