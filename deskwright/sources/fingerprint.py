"""Identity of an input by its content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskwright.functions import sql

def input_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and modification time of every input file, without reading contents."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")


def _summed(digest: Column) -> list[Column]:
    """The number of rows and two sums of 60-bit parts of a SHA-256, whatever the partitioning."""
    parts = [
        F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(38,0)") for start in (1, 16)
    ]
    sums = [F.coalesce(F.sum(p), F.lit(0)).cast("string") for p in parts]
    return [F.count("*").cast("string"), *sums]


def _value_text(name: str, dtype: T.DataType) -> Column:
    """A value as its length and text, which no other list of values has; null is ``N``."""
    value = F.col(sql.name(name))
    text = value.cast("string") if isinstance(dtype, T.AtomicType) else F.to_json(value)
    return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("N"))


def rows_fingerprint(rows: DataFrame) -> DataFrame:
    """One row ``fingerprint``: SHA-256 sums over the values of every row, nulls included.

    The order of rows counts where a column gives their places.
    """
    texts = [_value_text(f.name, f.dataType) for f in rows.schema.fields]
    digest = F.sha2(F.concat_ws(",", *texts), 256)
    parts = rows.select(digest.alias("digest")).agg(
        F.concat_ws(":", *_summed(F.col("digest"))).alias("parts")
    )
    return parts.select(F.sha2("parts", 256).alias("fingerprint"))


def envelope_fingerprint(envelope: DataFrame) -> DataFrame:
    """Identity of the numbered rows of an export: their values and their order."""
    if "line" in envelope.columns:
        return rows_fingerprint(envelope.select("row_number", "line"))
    names = envelope.schema["data"].dataType.names
    fields = [F.col(f"data.{sql.name(c)}").alias(f"v{i}") for i, c in enumerate(names)]
    return rows_fingerprint(
        envelope.select("row_number", F.lit(",".join(names)).alias("names"), *fields, "read_error")
    )


def input_fingerprint(spark: SparkSession, path: str, envelope: DataFrame) -> DataFrame:
    """One row with ``fingerprint`` and ``input_size_bytes``.

    The identity is that of the rows as they are read, in order: file by file and row by row. It
    has one definition for any number and size of files.
    """
    size = input_files(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return envelope_fingerprint(envelope).withColumn("input_size_bytes", F.lit(size))


def manifest_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """Identity by file names, sizes and modification times, without reading contents."""
    files = input_files(spark, path)
    size = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return rows_fingerprint(files).withColumn("input_size_bytes", F.lit(size))
