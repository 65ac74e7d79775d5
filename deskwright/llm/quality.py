"""Quality rules per document and per host.

Rules on a document: too few words, too many repeated three-word windows, too many symbols, too many
repeated lines. The first two reject a document by themselves. All four are also counted per host
(column ``source``): with a beta prior fitted to the hosts' failure rates by their mean and variance,
a host's rate is shrunk towards the rate of all hosts, the more so the fewer documents it has, and a
host whose shrunk rate of some rule reaches ``host_limit`` loses all its documents.

Everything is SQL functions. A document's words stay in its row; repeated windows are found by
sorting the hashes of its windows, with their places in the low bits, and comparing the words of
neighbours. Hosts are counted by partial aggregation, and verdicts return by an equi-join that
adaptive execution may broadcast or split.

Defined results: null text has no words and fails; a null host is a host of its own; an empty
table gives an empty result; repeated rows count each; other columns are kept by
``keep_good_documents`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwright.llm.common import WORD, bound, stored

LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
MOST_SYMBOLS = 10  # per cent of the code points in words
MOST_DUP_LINES = 30  # per cent of the lines with a word
HOST_LIMIT = 0.5
# The rules that hosts are judged by.
RULES = ["short", "repetitive", "symbols", "dup_lines"]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeat_words(words: Column) -> Column:
    """Number of words that lie in a three-word window found twice or more in ``words``."""

    def counted(low: Column) -> Column:
        # low: as many one bits as the places of the windows need
        def window(i: Column) -> Column:
            hashed = F.xxhash64(*[F.get(words, i + k) for k in range(3)])
            return hashed.bitwiseOR(low).bitwiseXOR(low).bitwiseOR(i.cast("long"))

        def same(x: Column, y: Column) -> Column:
            equal = x.bitwiseOR(low) == y.bitwiseOR(low)
            for k in range(3):
                a, b = (F.get(words, w.bitwiseAND(low).cast("int") + k) for w in (x, y))
                equal = equal & (a == b)
            return equal

        def repeated(ordered: Column) -> Column:
            return F.filter(
                ordered,
                lambda x, i: same(x, F.get(ordered, i - 1)) | same(x, F.get(ordered, i + 1)),
            )

        ordered = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - 3), window))
        places = F.transform(bound(ordered, repeated), lambda x: x.bitwiseAND(low))
        covered = F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2)))
        return F.size(F.array_distinct(covered)).cast("long")

    low = F.expr("shiftleft(1L, 31) - 1")
    for bits in (24, 16, 12, 10, 8):
        low = F.when(F.size(words) < (1 << bits), F.lit((1 << bits) - 1)).otherwise(low)
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(
        bound(low.cast("long"), counted)
    )


def document_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep`` of ``docs(text, ...)``, the counts, and ``n_lines`` (lines with a word).

    Words and lines are bound inside the expression, so that filters on the counts, which the
    optimizer moves below the projection, do not split the text again for every word.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    by_word = bound(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
        ),
    )
    by_line = bound(
        lines,
        lambda x: F.struct(
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.size(x).cast("long").alias("n_lines"),
        ),
    )
    counted = docs.select(
        *keep,
        by_word.alias("by_word"),
        by_line.alias("by_line"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    return counted.select(*keep, "by_word.*", "n_symbols", "by_line.*")


def failures(counts: DataFrame) -> DataFrame:
    """``counts`` with one boolean for each of RULES and ``base_failed``."""
    return counts.withColumns(
        {
            "short": F.col("n_words") < LEAST_WORDS,
            "repetitive": 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"),
            "symbols": 100 * F.col("n_symbols") > MOST_SYMBOLS * F.col("word_chars"),
            "dup_lines": 100 * F.col("n_dup_lines") > MOST_DUP_LINES * F.col("n_lines"),
        }
    ).withColumn("base_failed", F.col("short") | F.col("repetitive"))


def host_verdicts(failed: DataFrame, host: str, host_limit: float = HOST_LIMIT) -> DataFrame:
    """host, docs, a shrunk rate per rule and ``host_failed`` of every host.

    The prior of a rule is the beta distribution with the hosts' mean failure rate and the variance
    of their rates beyond binomial noise; without such variance every host has the mean rate.
    """
    hosts = failed.groupBy(host).agg(
        F.count("*").alias("docs"), *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES]
    )
    moments = hosts.agg(
        F.sum("docs").alias("all_docs"),
        F.count("*").alias("n_hosts"),
        *[F.sum(r).alias(f"{r}_all") for r in RULES],
        *[F.sum(F.col(r) * F.col(r) / F.col("docs")).alias(f"{r}_square") for r in RULES],
        F.sum(F.col("docs") * F.col("docs")).alias("docs_square"),
    )
    mean = {r: F.col(f"{r}_all") / F.col("all_docs") for r in RULES}
    spread = F.col("all_docs") - F.col("docs_square") / F.col("all_docs")
    prior = moments.select(
        *[mean[r].alias(f"{r}_mean") for r in RULES],
        *[
            # Weighted between-host variance, as in one-way random effects.
            (
                (
                    (F.col(f"{r}_square") - F.col("all_docs") * mean[r] * mean[r])
                    - (F.col("n_hosts") - 1) * mean[r] * (1 - mean[r])
                )
                / spread
            ).alias(f"{r}_variance")
            for r in RULES
        ],
    ).first()
    rates = {}
    for r in RULES:
        mu, variance = prior[f"{r}_mean"], prior[f"{r}_variance"]
        if mu is None or not 0 < mu < 1 or variance is None or variance <= 0:
            rates[r] = F.lit(mu or 0.0)
        else:
            weight = max(mu * (1 - mu) / variance - 1, 0.0)  # documents that the prior is worth
            rates[r] = (F.col(r) + weight * mu) / (F.col("docs") + weight)
    failed_host = F.lit(False)
    for r in RULES:
        failed_host = failed_host | (rates[r] >= host_limit)
    return hosts.select(
        host, "docs", *[rates[r].alias(f"{r}_rate") for r in RULES], failed_host.alias("host_failed")
    )


def judge(spark: SparkSession, docs: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """doc_id, the counts, ``base_failed``, ``host_failed`` and ``kept`` of every document."""
    named = docs.select("doc_id", F.coalesce(F.col("source"), F.lit("")).alias("host"), "text")
    failed = stored(spark, failures(document_counts(named, "doc_id", "host")), "quality-counts")
    return _with_hosts(failed, host_limit).select(
        "doc_id",
        *COUNTS,
        "base_failed",
        "host_failed",
        (~(F.col("base_failed") | F.col("host_failed"))).alias("kept"),
    )


def _with_hosts(failed: DataFrame, host_limit: float) -> DataFrame:
    verdicts = host_verdicts(failed, "host", host_limit).select("host", "host_failed")
    return failed.join(verdicts, "host")


def keep_good_documents(
    spark: SparkSession, docs: DataFrame, host_limit: float = HOST_LIMIT
) -> DataFrame:
    """Rows of ``docs`` that no rule rejects, with their columns."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col("source"), F.lit("")).alias("host"),
        "text",
    )
    counted = failures(document_counts(rows, "row", "host"))
    narrow = stored(spark, counted.select("host", *RULES, "base_failed"), "quality-hosts")
    verdicts = host_verdicts(narrow, "host", host_limit).where(~F.col("host_failed"))
    good = counted.where(~F.col("base_failed")).join(verdicts.select("host"), "host", "left_semi")
    return good.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
