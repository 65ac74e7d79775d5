"""One query per operator over the ``documents`` table, and the SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskwright.llm import (
    bpe,
    decontaminate,
    fill_in_middle,
    fingerprint,
    hard_negatives,
    language,
    line_dedup,
    mixing,
    near_dedup,
    quality,
    secret_scan,
    sharding,
    toxicity,
)
from deskwright.llm.common import documents
from deskwright.llm.oracles import ORACLES  # noqa: F401

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_toxicity(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.score_held_out(spark, documents(spark, folder), labels)


@query
def op2_fingerprint(spark, folder):
    return fingerprint.with_next(spark, documents(spark, folder))


@query
def op3_bpe(spark, folder):
    return bpe.round_trip(spark, documents(spark, folder))


@query
def op4_secret_scan(spark, folder):
    return secret_scan.secret_digest(spark, documents(spark, folder))


@query
def op5_quality(spark, folder):
    return quality.judge(spark, documents(spark, folder))


@query
def op6_language(spark, folder):
    return language.predict_held_out(spark, documents(spark, folder))


@query
def op7_mixing(spark, folder):
    return mixing.mixing_weights(spark, documents(spark, folder))


@query
def op8_near_dedup(spark, folder):
    return near_dedup.near_duplicates(spark, documents(spark, folder))


@query
def op9_line_dedup(spark, folder):
    found = line_dedup.repeated_lines(spark, documents(spark, folder))
    return found.select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op10_sharding(spark, folder):
    placed = sharding.assign_shards(spark, documents(spark, folder))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op11_fill_in_middle(spark, folder):
    found = fill_in_middle.transform(spark, documents(spark, folder), with_texts=False)
    return found.drop("output", "restored")


@query
def op12_decontamination(spark, folder):
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = decontaminate.find_leaks(spark, documents(spark, folder), benchmark, keep=["doc_id"])
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "row.doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


@query
def op13_hard_negatives(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return hard_negatives.mine(spark, hard_negatives.relabelled(vectors))
