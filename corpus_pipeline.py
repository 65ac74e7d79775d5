"""From raw documents to token ids: five stages over the ``documents`` table.

1. quality: documents that the document or host rules reject go.
2. line_dedup: lines that an earlier document holds go; the documents stay.
3. near_dedup: one document of each group of near copies stays (five words, similarity 0.8).
4. mixing: sources are repeated towards their target weights; nothing is left out.
5. bpe: texts become token ids, with a digest of the bytes decoded from them.

All stages but the last return the columns of ``documents``. Stages meet in Parquet files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from deskwright.llm import bpe, line_dedup, mixing, near_dedup, quality
from deskwright.llm.common import documents, stored

NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good_documents(spark, docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(spark, docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one_of_each(spark, docs, NEAR_PERCENT)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(spark, docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.tokenize(spark, docs)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

# Byte-level BPE and the chosen-path join have no SQL form; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
