"""Language of a text: known words first, then shorter and shorter character n-grams.

For every language the logarithm of a word's share among the language's words is looked up. A word
outside the vocabulary is spelled with its ends marked, and scored by the mean over its character
n-grams of the longest length of which it has a known one. A text's language has the highest mean
over its words.

The models are fitted on a documented, bounded sample: documents of a language enter with the
probability that makes ``sample_docs`` of them expected, decided by a hash of the id; the
``vocabulary`` most frequent words and ``ngrams`` most frequent n-grams of each length are kept.
Every document is scored over its whole text. More than MOST_LANGUAGES languages are refused.

Defined results: null text, and text without a letter, is ``und`` with score 0; a training table
without a language gives ``und`` for all; rows with a null language are not learned from; repeated
rows and empty tables need no care; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwright.llm.arrow import map_columns
from deskwright.llm.common import id_remainder, stored

UNKNOWN = "und"
SAMPLE_DOCS = 4_000
VOCABULARY = 50_000
NGRAMS = 30_000
LONGEST = 4
SMOOTHING = 0.5
CACHE_WORDS = 200_000
CHUNK_WORDS = 50_000
SCORED_WORDS = 20
MOST_LANGUAGES = 500
WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def has_letter(words: list[str]) -> bool:
    return any(w.isalpha() for w in words) or any(c.isalpha() for w in words for c in w)


def ngrams_of(word: str, length: int) -> list[str]:
    if length == 1:
        return list(word)
    marked = f"<{word}>"
    return [marked[i : i + length] for i in range(len(marked) - length + 1)]


class Model:
    """Log shares of words and n-grams: a row of ``shares`` per item, a column per language."""

    def __init__(self, languages: list[str], places: list[dict[str, int]], shares: np.ndarray):
        self.languages = languages
        self.places = places  # of words, then of n-grams from the longest to single characters
        self.shares = shares
        self.spelled: dict[str, int] | None = None

    def _place(self, word: str) -> int:
        """Row of a word; a word outside the vocabulary gets one from its n-grams."""
        found = self.places[0].get(word)
        if found is not None:
            return found
        found = self.spelled.get(word)
        if found is None:
            if len(self.spelled) >= CACHE_WORDS:
                self.spelled.clear()
            found = len(self.shares) - CACHE_WORDS + len(self.spelled)
            self.shares[found] = self._from_ngrams(word)
            self.spelled[word] = found
        return found

    def _from_ngrams(self, word: str) -> np.ndarray:
        for length, places in zip(range(LONGEST, 0, -1), self.places[1:]):
            known = [places[g] for g in ngrams_of(word, length) if g in places]
            if known:
                return self.shares[known].mean(axis=0)
        return np.zeros(len(self.languages))

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text or "")
        if not self.languages or not has_letter(words):
            return UNKNOWN, 0.0
        if self.spelled is None:
            room = np.zeros((CACHE_WORDS, len(self.languages)), self.shares.dtype)
            self.shares, self.spelled = np.concatenate([self.shares, room]), {}
        mean = np.zeros(len(self.languages))
        for start in range(0, len(words), CHUNK_WORDS):
            chunk = words[start : start + CHUNK_WORDS]
            if len(self.spelled) + len(chunk) > CACHE_WORDS:
                self.spelled.clear()  # between chunks, so that rows in use stay
            mean += self.shares[[self._place(w) for w in chunk]].sum(axis=0) / len(words)
        best = int(np.argmax(mean))
        # Evidence of at most so many words, so that long texts do not all score 1.
        apart = (mean - mean[best]) * min(len(words), SCORED_WORDS)
        return self.languages[best], float(1.0 / np.exp(apart).sum())


def count_items(sample: DataFrame) -> DataFrame:
    """kind, item, n, c: how often a word (kind 0) or n-gram occurs in language number ``n``."""

    def make():
        def work(columns):
            found: dict[tuple[int, int], Counter] = {}
            for n, text in zip(columns["n"], columns["text"]):
                found.setdefault((0, n), Counter()).update(words_of(text or ""))
            for (_, n), words in list(found.items()):
                for kind, length in enumerate(range(LONGEST, 0, -1), 1):
                    counter = found.setdefault((kind, n), Counter())
                    for word, times in words.items():
                        for gram in ngrams_of(word, length):
                            counter[gram] += times
            rows = [(k, n, g, c) for (k, n), counter in found.items() for g, c in counter.items()]
            return {name: [r[i] for r in rows] for i, name in enumerate(("kind", "n", "item", "c"))}

        return work

    counted = map_columns(sample, make, "kind int, n int, item string, c long", rows=4096)
    return counted.groupBy("kind", "item", "n").agg(F.sum("c").alias("c"))


def fit(
    spark: SparkSession,
    docs: DataFrame,
    sample_docs: int = SAMPLE_DOCS,
    vocabulary: int = VOCABULARY,
    ngrams: int = NGRAMS,
) -> Model:
    """A model from ``docs(doc_id, text, lang)``."""
    labelled = docs.where(F.col("lang").isNotNull())
    sizes = labelled.groupBy("lang").count().limit(MOST_LANGUAGES + 1)
    counts = {r["lang"]: r["count"] for r in sizes.collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"there are more than {MOST_LANGUAGES} languages")
    languages = sorted(counts)
    if not languages:
        return Model([], [{}], np.zeros((0, 0), np.float32))
    number = F.array_position(F.lit(languages), F.col("lang")).cast("int") - 1
    share = F.get(F.lit([min(1.0, sample_docs / counts[x]) for x in languages]), number)
    chance = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.where((number >= 0) & (chance < share)).select(number.alias("n"), "text")
    items = stored(spark, count_items(sample), "language-items")

    totals = np.zeros((LONGEST + 1, len(languages)))
    for row in items.groupBy("kind", "n").agg(F.sum("c").alias("c")).collect():
        totals[row["kind"], row["n"]] = row["c"]
    by_item = items.groupBy("kind", "item").agg(
        F.sum("c").alias("all"), F.collect_list(F.struct("n", "c")).alias("by")
    )
    places, shares, start = [], [], 0
    for kind in range(LONGEST + 1):
        most = ngrams if kind else vocabulary
        top = by_item.where(F.col("kind") == kind).orderBy(F.desc("all"), "item").limit(most)
        kept = top.select("item", "by").toArrow()
        held = np.full((kept.num_rows, len(languages)), SMOOTHING)
        for chunk, at in _chunks(kept.column("by")):
            row = np.repeat(np.arange(len(chunk)) + at, np.diff(chunk.offsets.to_numpy()))
            n, c = (chunk.flatten().field(i).to_numpy() for i in range(2))
            held[row, n] += c
        log_total = np.log(totals[kind] + SMOOTHING * (kept.num_rows + 1))
        shares.append(np.log(held) - log_total)
        names = kept.column("item").to_pylist()
        places.append(dict(zip(names, range(start, start + len(names)))))
        start += len(names)
    return Model(languages, places, np.concatenate(shares).astype(np.float32))


def _chunks(column):
    at = 0
    for chunk in column.chunks:
        yield chunk, at
        at += len(chunk)


def predict(spark: SparkSession, model: Model, docs: DataFrame) -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    shared = spark.sparkContext.broadcast(model)  # bounded by the model's parameters

    def make():
        held = shared.value

        def work(columns):
            found = [held.predict(text) for text in columns["text"]]
            return {
                "doc_id": columns["doc_id"],
                "lang_pred": [f[0] for f in found],
                "score": [f[1] for f in found],
            }

        return work

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_columns(rows, make, "doc_id long, lang_pred string, score double")


def predict_held_out(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Predictions for all documents by a model that has not seen a quarter of them."""
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    model = fit(spark, docs.where(~held_out))
    found = predict(spark, model, docs)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
