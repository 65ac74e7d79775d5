"""Toxicity: two Kneser-Ney word models, one of toxic and one of ordinary text.

Each model has the word and bigram counts of its class, discounted. What is left over goes to one
shared distribution, the continuation counts of both classes together (after how many different
words a word occurs). Expressions that are too rare to be more frequent in toxic text than chance
would have it, or that have too few contexts there, have no counts of their own: both models score
them by the shared counts. A text's score is the difference of its two log-likelihoods per word, put
on a rising curve that gives a probability. The curve is fitted on documents of each half of the
training rows by models of the other half.

Words and bigrams are counted over all labelled documents, in two passes with partial sums in the
tasks. All words seen LEAST_SEEN times are known; rarer ones are one rare word. A bigram has counts of
its own only if its last word has, so an expression of everyday words alone adds nothing. Only the
curve is fitted on a bounded sample. Labels are broadcast if they are few, else joined by shuffle.

Nothing is cut: up to VOCABULARY known words and BIGRAMS telling bigrams every task holds the model;
with more of either the same model is made of tables, and documents get their scores by joins.

Defined results: null and empty texts score like rare words; documents with several labels count as
toxic if one says so; null labels are ignored; without labels of both classes every score is the
share of toxic labels; repeated rows and empty tables need no care; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwright.llm.arrow import map_columns
from deskwright.llm.common import id_remainder, stored
from deskwright.llm.language import words_of

# What a task holds; larger models are joined.
VOCABULARY = 1_000_000  # words; about 200 MB
BIGRAMS = 500_000
CURVE_DOCS = 20_000
BROADCAST_LABELS = 2_000_000  # rows; about 32 MB
TOXIC_FROM = 0.7
LEAST_SEEN = 5  # rarer words are one with all rare words
TELLING = 3.0  # standard deviations above the expected count in toxic text
LEAST_RATIO = 4.0  # times as frequent in toxic text as in ordinary text, at least
LEAST_CONTEXTS = 3  # different words before a telling word, in toxic text
# Counters are kept apart by class and by half of the training documents.
GROUPS = 4  # 2 * half + toxic
RARE = 0


def labelled_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, half (0, 1) and toxic (0, 1) of the documents that may be learned from."""
    remainder = id_remainder(F.col("doc_id"), 3)
    label = (
        labels.where(F.col("toxic").isNotNull() & (remainder != 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    if label.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        label = F.broadcast(label)
    return (
        docs.select("doc_id", "text")
        .where(remainder != 1)
        .join(label, "doc_id")
        .select("doc_id", "text", (remainder == 2).cast("int").alias("half"), "toxic")
    )


def _counts(docs: DataFrame, keys_of, kind: str = "string") -> DataFrame:
    """key and c0 ... c3: how often each key of ``keys_of(text)`` occurs in each group."""

    def make():
        keys = keys_of()

        def work(columns):
            found = [Counter() for _ in range(GROUPS)]
            for text, half, toxic in zip(columns["text"], columns["half"], columns["toxic"]):
                found[2 * half + int(toxic)].update(keys(words_of(text or "")))
            all_keys = list(set().union(*found))
            columns = {f"c{g}": [found[g][k] for k in all_keys] for g in range(GROUPS)}
            return {"key": all_keys, **columns}

        return work

    schema = f"key {kind}, " + ", ".join(f"c{g} long" for g in range(GROUPS))
    rows = map_columns(docs.select("text", "half", "toxic"), make, schema, rows=8192)
    return rows.groupBy("key").agg(*[F.sum(f"c{g}").alias(f"c{g}") for g in range(GROUPS)])


def _words():
    return lambda words: words


def numbered(places: dict[str, int], words: list[str]) -> list[int]:
    return [places.get(w, RARE) for w in words]


# The halves whose counts a model uses.
FIRST, SECOND, BOTH = (0,), (1,), (0, 1)
CASES = [FIRST, SECOND, BOTH]


@dataclass
class Statistics:
    """What the driver knows: arrays over the vocabulary and the kept bigrams, by group."""

    places: dict[str, int]
    tokens: np.ndarray  # GROUPS
    types: np.ndarray  # GROUPS: different words
    rarely: np.ndarray  # GROUPS x 2 x 2: words, bigrams seen once and twice
    words: np.ndarray  # GROUPS x (RARE and the vocabulary)
    bigrams: np.ndarray  # keys, sorted
    bigram_counts: np.ndarray  # GROUPS x kept bigrams
    contexts: np.ndarray  # GROUPS x contexts: words after each context
    toxic_before: dict[tuple[int, ...], np.ndarray]  # by halves: contexts in toxic text
    before: np.ndarray  # different words before each word, in both classes together

    @property
    def width(self) -> int:
        return len(self.places) + 2  # RARE, the vocabulary, the start of a text


def _group(half: int, toxic: int) -> int:
    return 2 * half + toxic


@dataclass
class Counted:
    """The words of the training documents with their counts, and sums over all of them."""

    table: DataFrame  # key and counts
    tokens: np.ndarray  # GROUPS
    types: np.ndarray  # GROUPS: different words
    rarely: np.ndarray  # GROUPS x 2: words seen once and twice

    @property
    def share(self) -> float:
        """Of the words, those in toxic text."""
        return self.tokens[[_group(h, 1) for h in BOTH]].sum() / max(self.tokens.sum(), 1.0)

    @property
    def known(self) -> DataFrame:
        return self.table.where(_every() >= LEAST_SEEN)


COUNTS = [f"c{g}" for g in range(GROUPS)]


def _of(halves: tuple[int, ...], toxic: int) -> Column:
    return sum(F.col(f"c{_group(half, toxic)}") for half in halves)


def _every() -> Column:
    return sum(F.col(c) for c in COUNTS)


def _excess(share: float) -> Column:
    """Standard deviations above the expected count in toxic text."""
    return (_of(BOTH, 1) - _every() * share) / F.sqrt(_every() * share + 1)


def _may_tell(share: float) -> Column:
    """Whether a bigram may have counts of its own."""
    return (_every() >= LEAST_SEEN) & (_excess(share) > TELLING / 2)


def count_words(spark: SparkSession, train: DataFrame) -> Counted:
    counted = stored(spark, _counts(train, _words), "toxicity-words")
    overall = counted.agg(
        *[F.coalesce(F.sum(c), F.lit(0)) for c in COUNTS],
        *[F.count(F.when(F.col(c) > 0, 1)) for c in COUNTS],
        *_seen_rarely(COUNTS),
    ).first()
    return Counted(
        counted,
        np.array(overall[:GROUPS], np.float64),
        np.array(overall[GROUPS : 2 * GROUPS], np.float64),
        np.array(overall[2 * GROUPS :], np.float64).reshape(GROUPS, 2),
    )


def gather(
    spark: SparkSession,
    train: DataFrame,
    counted: Counted,
    vocabulary: int = VOCABULARY,
    bigrams: int = BIGRAMS,
) -> Statistics | None:
    """All statistics; None if there are more known words or telling bigrams than a task may hold."""
    columns = COUNTS
    tokens = counted.tokens
    if counted.known.limit(vocabulary + 1).count() > vocabulary:
        return None
    table = counted.known.toArrow().sort_by("key")
    places = {word: i for i, word in enumerate(table.column("key").to_pylist(), 1)}
    words = np.zeros((GROUPS, len(places) + 1))
    words[:, 1:] = [table.column(c).to_numpy() for c in columns]
    words[:, RARE] = tokens - words.sum(axis=1)

    start, width = len(places) + 1, len(places) + 2
    shared = spark.sparkContext.broadcast(places)  # at most ``vocabulary`` words

    def bigram_keys():
        held = shared.value

        def keys(words: list[str]) -> list[int]:
            ids = np.array([start, *numbered(held, words)], np.int64)
            return (ids[:-1] * width + ids[1:]).tolist()

        return keys

    pairs = stored(spark, _counts(train, bigram_keys, "long"), "toxicity-bigrams")
    telling = pairs.where(_may_tell(counted.share))
    if telling.limit(bigrams + 1).count() > bigrams:
        return None
    kept = telling.toArrow().sort_by("key")
    # A row per word of the vocabulary.
    contexts = np.zeros((GROUPS, width))
    first = F.floor(F.col("key") / width).cast("int").alias("v")
    found = pairs.groupBy(first).agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    contexts[:, found.column("v").to_numpy()] = [found.column(c).to_numpy() for c in columns]
    seen = [F.count(F.when(_of(halves, 1) > 0, 1)).alias(f"s{i}") for i, halves in enumerate(CASES)]
    before = np.zeros((1 + len(CASES), len(places) + 1))
    second = (F.col("key") % width).cast("int").alias("w")
    found = pairs.groupBy(second).agg(F.count("*"), *seen).toArrow()
    before[:, found.column("w").to_numpy()] = [c.to_numpy() for c in found.columns[1:]]
    rarely = [counted.rarely, pairs.agg(*_seen_rarely(columns)).first()]
    return Statistics(
        places,
        tokens,
        counted.types,
        np.array([np.reshape(r, (GROUPS, 2)) for r in rarely], np.float64).transpose(1, 0, 2),
        words,
        kept.column("key").to_numpy(),
        np.array([kept.column(c).to_numpy() for c in columns], np.float64),
        contexts,
        dict(zip(CASES, before[1:])),
        before[0],
    )


def _seen_rarely(columns: list[str]) -> list[Column]:
    return [F.count(F.when(F.col(c) == n, 1)) for c in columns for n in (1, 2)]


def _discount(seen: np.ndarray) -> float:
    """From the numbers of things seen once and twice; 0.75 if there are none."""
    once, twice = seen
    return once / (once + 2 * twice) if once and twice else 0.75


@dataclass
class Model:
    """Log-likelihood differences, toxic minus ordinary, and the curve over their mean."""

    places: dict[str, int]
    bigrams: np.ndarray
    bigram_differences: np.ndarray
    word_differences: np.ndarray
    backoff_differences: np.ndarray
    curve: tuple[list[float], list[float]] = ((0.0,), (0.0,))

    def difference(self, text: str | None) -> float:
        """Per word; a text without words is like one of rare words."""
        words = words_of(text or "")
        if not words:
            return float(self.word_differences[RARE])
        start, width = len(self.places) + 1, len(self.places) + 2
        ids = np.array([start, *numbered(self.places, words)], np.int64)
        before, now = ids[:-1], ids[1:]
        found = self.backoff_differences[before] + self.word_differences[now]
        if len(self.bigrams):
            keys = before * width + now
            at = np.minimum(np.searchsorted(self.bigrams, keys), len(self.bigrams) - 1)
            found = np.where(self.bigrams[at] == keys, self.bigram_differences[at], found)
        return float(found.mean())

    def score(self, text: str | None) -> float:
        return float(np.interp(self.difference(text), *self.curve))


def model_of(found: Statistics, halves: tuple[int, ...]) -> Model:
    """The models of the counts of the given halves.

    Words and bigrams that are not more frequent in toxic text than chance would have it, or that
    have too few contexts there (copies of one text), are scored by the shared counts in both.
    """
    groups = [[_group(half, toxic) for half in halves] for toxic in (0, 1)]
    tokens = [found.tokens[own].sum() for own in groups]
    share = tokens[1] / max(sum(tokens), 1.0)

    def telling(counts: np.ndarray) -> np.ndarray:
        ordinary, toxic = (counts[own].sum(axis=0) for own in groups)
        expected = (ordinary + toxic) * share
        clear = toxic - expected > TELLING * np.sqrt(expected + 1)
        return clear & (toxic * tokens[0] > LEAST_RATIO * ordinary * tokens[1])

    own_words = telling(found.words) & (found.toxic_before[halves] >= LEAST_CONTEXTS)
    own_words[RARE] = False
    context, after = found.bigrams // found.width, found.bigrams % found.width
    own_bigrams = telling(found.bigram_counts) & own_words[after] if len(after) else after == -1
    shared = (found.before + 1) / (found.before + 1).sum()
    words, bigrams, backoffs = [], [], []
    for own, total in zip(groups, tokens):
        rarely = found.rarely[own].sum(axis=0)
        discount = _discount(rarely[0])
        left = np.maximum(found.words[own].sum(axis=0) - discount, 0) / max(total, 1.0)
        to_shared = discount * found.types[own].sum() / max(total, 1.0)
        word = left + min(to_shared, 1.0) * shared
        rest = max(1 - word[own_words].sum(), 1e-6)
        word = np.where(own_words, word, rest * shared / max(shared[~own_words].sum(), 1e-9))
        discount = _discount(rarely[1])
        left = np.maximum(found.bigram_counts[own].sum(axis=0) - discount, 0) * own_bigrams
        after_context = np.maximum(found.contexts[own].sum(axis=0), 1e-9)
        # What is not held by telling bigrams goes to the words.
        backoff = 1 - np.bincount(context, left, minlength=found.width) / after_context
        backoff = np.maximum(backoff, 1e-6)
        words.append(np.log(word))
        backoffs.append(np.log(backoff))
        bigrams.append(np.log(left / after_context[context] + backoff[context] * word[after]))
    return Model(
        found.places,
        found.bigrams,
        *((x[1] - x[0]).astype(np.float32) for x in (bigrams, words, backoffs)),
    )


# The same model as tables, for any number of words and bigrams.

START, UNKNOWN = " ", ""  # the start of a text and a rare word; neither is a word


def _word_pairs():
    return lambda words: [f"{v}\n{w}" for v, w in zip([START, *words], words)]


class Tables:
    """Counts of all bigrams (``v``, ``w``), words and contexts, rare words as one."""

    def __init__(self, spark: SparkSession, train: DataFrame, counted: Counted) -> None:
        self.spark, self.counted = spark, counted
        self.known = stored(spark, counted.known.select(F.col("key").alias("word")), "toxicity-known")
        sums = [F.sum(c).alias(c) for c in COUNTS]
        raw = _counts(train, _word_pairs).select(
            F.substring_index("key", "\n", 1).alias("v"),
            F.substring_index("key", "\n", -1).alias("w"),
            *COUNTS,
        )
        mapped = self.with_rare(self.with_rare(raw, "v"), "w")
        self.pairs = stored(spark, mapped.groupBy("v", "w").agg(*sums), "toxicity-pairs")
        seen = [
            F.count(F.when(_of(halves, 1) > 0, 1)).alias(f"toxic_before_{i}")
            for i, halves in enumerate(CASES)
        ]
        words = self.pairs.groupBy("w").agg(*sums, F.count("*").alias("before"), *seen)
        self.words = stored(spark, words, "toxicity-vocabulary")
        self.contexts = stored(spark, self.pairs.groupBy("v").agg(*sums), "toxicity-contexts")
        n_pairs, *rarely = self.pairs.agg(F.count("*"), *_seen_rarely(COUNTS)).first()
        self.rarely = [counted.rarely, np.array(rarely, np.float64).reshape(GROUPS, 2)]
        # Every known word and the rare one: their different contexts, and one more.
        self.norm = n_pairs + self.known.count() + 1

    def with_rare(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with rare words in a column replaced by one."""
        known = self.known.select(F.col("word").alias(name), F.lit(True).alias("_known"))
        word = F.when(F.col("_known") | (F.col(name) == START), F.col(name)).otherwise(UNKNOWN)
        return rows.join(known, name, "left").withColumn(name, word).drop("_known")

    def model(self, halves: tuple[int, ...]) -> JoinedModel:
        """What ``model_of`` makes of the counts of the given halves."""
        counted = self.counted
        groups = [[_group(half, toxic) for half in halves] for toxic in (0, 1)]
        tokens = [counted.tokens[own].sum() for own in groups]
        share = tokens[1] / max(sum(tokens), 1.0)
        ordinary, toxic = (_of(halves, t) for t in (0, 1))
        expected = (ordinary + toxic) * F.lit(share)
        telling = (toxic - expected > TELLING * F.sqrt(expected + 1)) & (
            toxic * F.lit(tokens[0]) > LEAST_RATIO * ordinary * F.lit(tokens[1])
        )
        enough = F.col(f"toxic_before_{CASES.index(halves)}") >= LEAST_CONTEXTS
        likely = []
        for own, total, count in zip(groups, tokens, (ordinary, toxic)):
            discount = _discount(self.rarely[0][own].sum(axis=0))
            to_shared = min(discount * counted.types[own].sum() / max(total, 1.0), 1.0)
            left = F.greatest(count - F.lit(discount), F.lit(0.0)) / max(total, 1.0)
            likely.append(left + F.lit(to_shared) * (F.col("before") + 1) / self.norm)
        words = self.words.where((F.col("w") != UNKNOWN) & telling & enough)
        words = stored(
            self.spark,
            words.select("w", *[p.alias(f"p{t}") for t, p in enumerate(likely)]),
            "toxicity-own-words",
        )
        held = words.agg(*[F.coalesce(F.sum(f"p{t}"), F.lit(0.0)) for t in (0, 1)]).first()
        rest = [max(1 - mass, 1e-6) for mass in held]
        other = float(np.log(rest[1]) - np.log(rest[0]))

        lefts = []
        for t, (own, count) in enumerate(zip(groups, (ordinary, toxic))):
            discount = _discount(self.rarely[1][own].sum(axis=0))
            lefts.append(F.greatest(count - F.lit(discount), F.lit(0.0)).alias(f"l{t}"))
        own_pairs = self.pairs.where(_may_tell(counted.share) & telling).select("v", "w", *lefts)
        own_pairs = stored(self.spark, own_pairs.join(words, "w"), "toxicity-own-pairs")
        after = [
            F.greatest(count.cast("double"), F.lit(1e-9)).alias(f"a{t}")
            for t, count in enumerate((ordinary, toxic))
        ]
        contexts = own_pairs.groupBy("v").agg(*[F.sum(f"l{t}").alias(f"s{t}") for t in (0, 1)])
        contexts = contexts.join(self.contexts.select("v", *after), "v").select(
            "v",
            "a0",
            "a1",
            *[F.greatest(1 - F.col(f"s{t}") / F.col(f"a{t}"), F.lit(1e-6)).alias(f"b{t}") for t in (0, 1)],
        )
        contexts = stored(self.spark, contexts, "toxicity-own-contexts")
        pair = [
            F.log(F.col(f"l{t}") / F.col(f"a{t}") + F.col(f"b{t}") * F.col(f"p{t}")) for t in (0, 1)
        ]
        apart = [F.log(F.col(f"b{t}") * F.col(f"p{t}")) for t in (0, 1)]
        value = pair[1] - pair[0] - (apart[1] - apart[0])
        return JoinedModel(
            self,
            other,
            words.select("w", (F.log("p1") - F.log("p0") - other).alias("value")),
            contexts.select("v", (F.log("b1") - F.log("b0")).alias("value")),
            stored(
                self.spark,
                own_pairs.join(contexts, "v").select("v", "w", value.alias("value")),
                "toxicity-pair-values",
            ),
        )


@dataclass
class JoinedModel:
    """A model as tables: what words, contexts and bigrams add to ``other``, that of any word."""

    tables: Tables
    other: float
    words: DataFrame  # w, value
    contexts: DataFrame  # v, value
    pairs: DataFrame  # v, w, value: beyond their context's and word's
    curve: tuple[list[float], list[float]] = ((0.0,), (0.0,))

    def differences(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``x``, the difference of each text per word."""
        spark = self.tables.spark
        numbered = docs.select(F.monotonically_increasing_id().alias("_row"), "*")
        numbered = stored(spark, numbered, "toxicity-documents")

        def make():
            def work(columns):
                made: dict[str, list] = {"_row": [], "v": [], "w": [], "n": []}
                for row, text in zip(columns["_row"], columns["text"]):
                    words = words_of(text or "")
                    for (v, w), n in Counter(zip([START, *words], words)).items():
                        for name, value in zip(made, (row, v, w, n)):
                            made[name].append(value)
                return made

            return work

        found = map_columns(numbered.select("_row", "text"), make, "_row long, v string, w string, n long")
        found = stored(spark, found, "toxicity-document-pairs")

        def parts(rows: DataFrame, value: Column) -> DataFrame:
            return rows.select("_row", F.lit(0).alias("n"), (F.col("n") * value).alias("value"))

        # Rare words and starts are in most documents: their values are no join.
        common = self.contexts.where(F.col("v").isin(START, UNKNOWN)).collect()
        common = {r["v"]: r["value"] for r in common}
        rare = found.where(F.col("v") != START).join(
            self.tables.known.select(F.col("word").alias("v")), "v", "left_anti"
        )
        # Only words with counts of their own end a bigram that has some.
        ends = self.tables.with_rare(found.join(self.words.select("w"), "w", "left_semi"), "v")
        sums = found.select("_row", "n", F.lit(0.0).alias("value"))
        for part in (
            parts(found.join(self.words, "w"), F.col("value")),
            parts(found.where(F.col("v") != START).join(self.contexts, "v"), F.col("value")),
            parts(found.where(F.col("v") == START), F.lit(common.get(START, 0.0))),
            parts(rare, F.lit(common.get(UNKNOWN, 0.0))),
            parts(ends.join(self.pairs, ["v", "w"]), F.col("value")),
        ):
            sums = sums.unionByName(part)
        sums = sums.groupBy("_row").agg(F.sum("n").alias("_n"), F.sum("value").alias("_value"))
        x = F.coalesce(F.col("_value") / F.col("_n"), F.lit(0.0)) + self.other
        return numbered.join(sums, "_row", "left").withColumn("x", x).drop("_row", "_n", "_value")

    def scores(self, docs: DataFrame) -> DataFrame:
        curve = self.curve

        def make():
            def work(columns):
                return {"doc_id": columns["doc_id"], "score": np.interp(columns["x"], *curve).tolist()}

            return work

        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        found = self.differences(rows).select("doc_id", "x")
        return map_columns(found, make, "doc_id long, score double")


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[list[float], list[float]]:
    """Knots of the rising curve nearest to the labels ``y`` (isotonic regression)."""
    blocks: list[list[float]] = []  # sum of labels, documents, least and largest difference
    for at in np.argsort(x, kind="stable"):
        blocks.append([y[at], 1, x[at], x[at]])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    knots = [(edge, (b[0] + 0.5) / (b[1] + 1)) for b in blocks for edge in (b[2], b[3])]
    heights = np.maximum.accumulate([height for _, height in knots])
    return [float(edge) for edge, _ in knots], [float(h) for h in heights]


def fit(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    vocabulary: int = VOCABULARY,
    bigrams: int = BIGRAMS,
    curve_docs: int = CURVE_DOCS,
) -> Model | JoinedModel:
    train = labelled_documents(docs, labels)
    counted = count_words(spark, train)
    found = gather(spark, train, counted, vocabulary, bigrams)
    n = max(train.count(), 1)
    chance = F.pmod(F.xxhash64("doc_id", F.lit("curve")), F.lit(1 << 30)) / float(1 << 30)
    sample = train.where(chance < min(1.0, curve_docs / n)).select("text", "half", "toxic")
    # The curve: documents of each half by the counts of the other.
    if found is None:
        tables = Tables(spark, train, counted)
        model = tables.model(BOTH)
        crossed = [tables.model(SECOND), tables.model(FIRST)]
        halves = [
            crossed[h].differences(sample.where(F.col("half") == h)).select("x", "toxic") for h in BOTH
        ]
        scored = halves[0].unionByName(halves[1]).toArrow()
    else:
        model = model_of(found, BOTH)
        shared = spark.sparkContext.broadcast([model_of(found, SECOND), model_of(found, FIRST)])

        def make():
            models = shared.value

            def work(columns):
                made = [models[h].difference(t) for h, t in zip(columns["half"], columns["text"])]
                return {"x": made, "toxic": columns["toxic"]}

            return work

        scored = map_columns(sample, make, "x double, toxic int").toArrow()
    x, toxic = (scored.column(c).to_numpy().astype(np.float64) for c in ("x", "toxic"))
    if counted.tokens.all() and 0 < toxic.sum() < len(toxic):
        model.curve = fit_curve(x, toxic)
    else:
        model.curve = ([0.0], [float(toxic.mean()) if len(toxic) else 0.0])
    return model


def score(spark: SparkSession, model: Model | JoinedModel, docs: DataFrame) -> DataFrame:
    """doc_id and score of every document."""
    if isinstance(model, JoinedModel):
        return model.scores(docs)
    shared = spark.sparkContext.broadcast(model)  # bounded by the model's parameters

    def make():
        held = shared.value

        def work(columns):
            scores = [held.score(text) for text in columns["text"]]
            return {"doc_id": columns["doc_id"], "score": scores}

        return work

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_columns(rows, make, "doc_id long, score double")


def score_held_out(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents by a model that has not seen a third of the labels."""
    found = score(spark, fit(spark, docs, labels), docs)
    return found.select(
        "doc_id",
        (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )
