"""Benchmark passages in training text, through an FM-index of every training shard.

A test phrase is a window of consecutive words of a benchmark item. Every task gathers its documents
into shards of a bounded number of words. Words that no phrase has are one separator, and runs of
other words that are shorter than all phrases hold none, so they stay out. The suffixes of a shard
are sorted by prefix doubling; the words before them, in that order, go into a wavelet tree, stored as
a matrix of bits with their counts. Backward search takes all phrases one word further at a time, by
two ranks each, and drops those that do not occur. Occurrences are located by walking back to the
nearest sampled suffix; a walk never crosses a separator, as suffixes at the start of a run are all
sampled. Overlapping occurrences are merged into spans, which can be removed.

Nothing is shuffled: a document stays in its row. Phrases reach the tasks in blocks of a bounded
number of (phrase, item) pairs, dealt out by hash, so that an item or a phrase of any frequency fits;
each further block is one more pass over the documents.

Defined results: null text has no words and no hits; a text may have any length (long ones enter the
shards in overlapping parts); an item without words has no phrase; items are told apart by id, so that
rows of one id are one item, and a null id counts as the empty id; rows that repeat are judged each by
itself; an empty table gives an empty result, and an empty benchmark no hits; other columns are kept
by ``remove_leaks`` whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwright.llm.arrow import slices
from deskwright.llm.common import ascii_lower, stored

WINDOW = 10
BLOCK_PAIRS = 200_000  # (phrase, item) pairs that are searched in one pass; about 20 MB
SHARD_WORDS = 1 << 20
SHARD_DOCS = 1 << 14
SHARD_BYTES = 16 << 20
SAMPLE = 8

# The words of lower-cased texts, the same for texts as they are.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

_SPAN = "array<struct<start: long, stop: long>>"
_FOUND = f"n_words long, spans {_SPAN}, cuts {_SPAN}, items array<string>, rest string"


def _word_table() -> bytes:
    """Bytes of words as lower case, all others as a blank."""
    held = bytearray(b" " * 256)
    for byte in range(256):
        lower = bytes([byte]).lower()
        if byte >= 0x80 or lower.isalnum():
            held[byte] = lower[0]
    return bytes(held)


_TABLE = _word_table()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


class Bits:
    """A row of bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.zeros((n // 64 + 1) * 8, np.uint8)
        held = np.packbits(bits, bitorder="little")
        packed[: len(held)] = held
        self.words = packed.view(np.uint64)
        ones = np.bitwise_count(self.words)
        self.before = np.concatenate([[0], np.cumsum(ones[:-1], dtype=np.int64)])
        self.n_zeros = n - int(ones.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class WaveletTree:
    """Ranks of symbols below ``n_symbols``, one row of bits per binary digit, the highest first."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.rows: list[tuple[int, Bits]] = []
        for digit in reversed(range(max(1, (n_symbols - 1).bit_length()))):
            bits = (symbols >> digit & 1).astype(bool)
            self.rows.append((digit, Bits(bits)))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
        every = np.arange(n_symbols)
        self.starts = self._descend(every, np.zeros(n_symbols, np.int64))

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for digit, bits in self.rows:
            ones = bits.ones(at)
            at = np.where(symbols >> digit & 1, bits.n_zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self._descend(symbols, at) - self.starts[symbols]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at the places, and how often each occurs before its place."""
        symbols = np.zeros(len(at), np.int64)
        for digit, bits in self.rows:
            one, ones = bits[at], bits.ones(at)
            symbols |= one.astype(np.int64) << digit
            at = np.where(one, bits.n_zeros + ones, at - ones)
        return symbols, at - self.starts[symbols]


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in their order; the last symbol has to be unique.

    Prefix doubling: suffixes that agree in their first h symbols are ordered by what follows these,
    which are suffixes that have a rank already. Only groups that still agree are sorted again.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)
    active, h = np.arange(n), 1
    first, second = symbols[order], None
    while True:
        head = np.ones(len(active), bool)
        head[1:] = first[1:] != first[:-1]
        if second is not None:
            head[1:] |= second[1:] != second[:-1]
        starts = np.flatnonzero(head)
        rank[order[active]] = active[starts][np.cumsum(head) - 1]
        sizes = np.diff(np.append(starts, len(active)))
        active = active[np.repeat(sizes > 1, sizes)]
        if not len(active):
            return order
        held = order[active]
        first, second = rank[held], rank[np.minimum(held + h, n - 1)]
        by = np.argsort(first * n + second, kind="stable")
        order[active], first, second = held[by], first[by], second[by]
        h *= 2


class FmIndex:
    """Search in ``symbols``: 0 separates, the last one is 0, others are below ``n_symbols``."""

    def __init__(self, symbols: np.ndarray, n_symbols: int, sample: int = SAMPLE):
        n = len(symbols)
        separator = symbols == 0
        n_separators = int(separator.sum())
        # Separators differ, by their place, so that no two suffixes agree beyond one.
        distinct = np.where(separator, np.cumsum(separator) - 1, symbols + n_separators - 1)
        order = suffix_order(distinct)
        self.tree = WaveletTree(symbols[order - 1], n_symbols)
        counts = np.bincount(symbols, minlength=n_symbols)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        sampled = np.arange(n) % sample == 0
        sampled[1:] |= separator[:-1]
        self.sampled = Bits(sampled[order])
        self.places = order[sampled[order]]

    def ranges(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and row after the last of the suffixes that begin with each phrase.

        ``phrases`` holds the words of a phrase in a row, from the last one to the first.
        """
        low, high = self.first[phrases[:, 0]], self.first[phrases[:, 0] + 1]
        going = np.arange(len(phrases))
        for step in range(1, phrases.shape[1]):
            going = going[(lengths[going] > step) & (high[going] > low[going])]
            if not len(going):
                break
            word = phrases[going, step]
            low[going] = self.first[word] + self.tree.rank(word, low[going])
            high[going] = self.first[word] + self.tree.rank(word, high[going])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of the rows start."""
        found = np.empty(len(rows), np.int64)
        left, steps = np.arange(len(rows)), 0
        while len(left):
            known = self.sampled[rows]
            found[left[known]] = self.places[self.sampled.ones(rows[known])] + steps
            left, rows = left[~known], rows[~known]
            symbols, before = self.tree.access(rows)
            rows = self.first[symbols] + before
            steps += 1
        return found


class Phrases:
    """A block of phrases: their words as numbers from 1, and the items that each belongs to."""

    def __init__(self, phrases: list[str], items: list[str]):
        split = {p: p.encode().split(b" ") for p in dict.fromkeys(phrases)}
        self.vocabulary: dict[bytes, int] = {}
        for words in split.values():
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        self.lengths = np.array([len(w) for w in split.values()], np.int64)
        self.longest = int(self.lengths.max(initial=1))
        self.shortest = int(self.lengths.min(initial=1))
        self.backward = np.zeros((len(split), self.longest), np.int64)
        for i, words in enumerate(split.values()):
            self.backward[i, : len(words)] = [self.vocabulary[w] for w in reversed(words)]
        numbers = {p: i for i, p in enumerate(split)}
        self.items: list[list[str]] = [[] for _ in split]
        for phrase, item in zip(phrases, items):
            self.items[numbers[phrase]].append(item)


class Searcher:
    """Hits of documents that are added one after the other; complete after ``search``."""

    def __init__(self, phrases: Phrases):
        self.phrases = phrases
        self.words: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.owners: list[np.ndarray] = []
        self.n = 0
        self.hits: dict[int, list[np.ndarray]] = {}
        self.items: dict[int, set[str]] = {}

    def add(self, owner: int, words: list[bytes]) -> None:
        known, held = self.phrases.vocabulary, self.phrases
        step = SHARD_WORDS - held.longest + 1
        for start in range(0, max(len(words) - held.longest + 1, 1), step):
            part = words[start : start + SHARD_WORDS]
            numbers = np.array([*[known.get(w, 0) for w in part], 0], np.int64)
            edges = np.flatnonzero(np.diff(numbers > 0, prepend=False))
            firsts, stops = edges[::2], edges[1::2]
            enough = stops - firsts >= held.shortest
            firsts, stops = firsts[enough], stops[enough]
            if not len(firsts):
                continue
            # The words of each run and the separator after it.
            sizes = stops - firsts + 1
            at = np.arange(sizes.sum()) + np.repeat(firsts - np.cumsum(sizes) + sizes, sizes)
            self.words.append(numbers[at])
            self.places.append(at + start)
            self.owners.append(np.full(len(at), owner))
            self.n += len(at)
            if self.n >= SHARD_WORDS:
                self.search()

    def search(self) -> None:
        """Index what was added since and look all phrases up."""
        if self.n:
            symbols = np.concatenate(self.words)
            places, owners = np.concatenate(self.places), np.concatenate(self.owners)
            held = self.phrases
            index = FmIndex(symbols, len(held.vocabulary) + 1)
            low, high = index.ranges(held.backward, held.lengths)
            occurring = np.flatnonzero(high > low)
            times = high[occurring] - low[occurring]
            rows = np.arange(times.sum()) + np.repeat(low[occurring] - np.cumsum(times) + times, times)
            phrase, start = np.repeat(occurring, times), index.locate(rows)
            self._mark(start, held.lengths[phrase], places, owners)
            pairs = np.unique(owners[start] * len(held.lengths) + phrase)
            for pair in pairs.tolist():
                owner, number = divmod(pair, len(held.lengths))
                self.items.setdefault(owner, set()).update(held.items[number])
        self.words, self.places, self.owners, self.n = [], [], [], 0

    def _mark(self, start, length, places, owners) -> None:
        covered = np.zeros(len(places) + 1, np.int64)
        np.add.at(covered, start, 1)
        np.add.at(covered, start + length, -1)
        hit = np.flatnonzero(np.cumsum(covered[:-1]))
        borders = np.flatnonzero(np.diff(owners[hit], prepend=-1))
        for places_of, owner in zip(np.split(places[hit], borders[1:]), owners[hit][borders].tolist()):
            self.hits.setdefault(owner, []).append(places_of)

    def take(self, owner: int, spans: list[dict], items: list[str]) -> tuple[list, list]:
        """Merged spans of words and sorted items, with those that earlier blocks have found."""
        found = self.hits.pop(owner, None)
        more = self.items.pop(owner, None)
        if more:
            items = sorted({*items, *more})
        if found:
            hit = [np.arange(s["start"], s["stop"]) for s in spans]
            at = np.unique(np.concatenate([*hit, *found]))
            breaks = np.flatnonzero(np.diff(at) > 1)
            starts, stops = at[[0, *(breaks + 1)]], at[[*breaks, -1]] + 1
            spans = [{"start": a, "stop": b} for a, b in zip(starts.tolist(), stops.tolist())]
        return spans, items


def cuts_of(text: str, spans: list[dict]) -> list[dict]:
    """Code points from the first to the last word of each span."""
    if not spans:
        return []
    words = [m.span() for m in ANY_WORD.finditer(text)]
    return [{"start": words[s["start"]][0], "stop": words[s["stop"] - 1][1]} for s in spans]


def rest_of(text: str, cuts: list[dict]) -> str:
    kept = zip([0, *[c["stop"] for c in cuts]], [*[c["start"] for c in cuts], len(text)])
    return "".join(text[a:b] for a, b in kept)


def phrase_table(benchmark: DataFrame, window: int) -> DataFrame:
    """phrase, item: the windows of words of every item; an item of fewer words is one."""
    words = F.regexp_extract_all(ascii_lower(F.coalesce("text", F.lit(""))), F.lit(WORD), 0)
    item = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")
    held = benchmark.select(item, words.alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    phrase = F.transform(starts, lambda i: F.array_join(F.slice("words", i, window), " "))
    return held.select("item", F.explode(phrase).alias("phrase")).distinct()


def _searched(frame: DataFrame, shared, last: bool, with_rest: bool) -> DataFrame:
    """``frame(row, text, spans, items)`` after one more block of phrases."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    more = StructType.fromDDL(_FOUND if last else f"text string, spans {_SPAN}, items array<string>")
    struct = StructType([frame.schema["row"], *more.fields])
    wire = to_arrow_schema(struct).serialize().to_pybytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = pa.ipc.read_schema(pa.py_buffer(wire))
        searcher = Searcher(shared.value)
        waiting: list[tuple[pa.RecordBatch, list[str], list[int]]] = []
        owner = size = 0

        def finished() -> Iterator[pa.RecordBatch]:
            searcher.search()
            number = owner - sum(len(texts) for _, texts, _ in waiting)
            for batch, texts, n_words in waiting:
                known = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
                held = [searcher.take(number + i, *pair) for i, pair in enumerate(known)]
                number += len(texts)
                spans, items = [h[0] for h in held], [h[1] for h in held]
                made = {"row": batch.column("row"), "text": batch.column("text"), "n_words": n_words}
                made |= {"spans": spans, "items": items}
                if last:
                    made["cuts"] = [cuts_of(t, s) for t, s in zip(texts, spans)]
                    wanted = zip(texts, made["cuts"])
                    made["rest"] = [rest_of(t, c) if c and with_rest else None for t, c in wanted]
                arrays = [
                    made[f.name] if f.name in ("row", "text") else pa.array(made[f.name], type=f.type)
                    for f in target
                ]
                yield pa.RecordBatch.from_arrays(
                    [a.cast(f.type) for a, f in zip(arrays, target)], schema=target
                )
            waiting.clear()

        for batch in slices(batches):
            texts, n_words = [t or "" for t in batch.column("text").to_pylist()], []
            for text in texts:
                words = words_of(text)
                searcher.add(owner, words)
                n_words.append(len(words))
                owner += 1
                size += len(text)
            waiting.append((batch, texts, n_words))
            if size >= SHARD_BYTES or sum(len(w[1]) for w in waiting) >= SHARD_DOCS:
                yield from finished()
                size = 0
        yield from finished()

    return frame.select("row", "text", "spans", "items").mapInArrow(run, struct)


def find_leaks(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    keep: list[str] | None = None,
    with_rest: bool = False,
    block_pairs: int = BLOCK_PAIRS,
) -> DataFrame:
    """row, n_words, spans, cuts, items and rest of every document of ``docs(text, ...)``.

    ``row`` is a struct of the columns ``keep`` (all, if not given). ``spans`` are merged ranges of
    words that occurrences of test phrases cover, ``cuts`` the same in code points; ends are
    exclusive. ``items`` are the ids, as sorted strings, of the ``benchmark(item_id, text)`` items with
    an occurring phrase. ``rest`` is the text without the cuts, null without hits or unless
    ``with_rest``.
    """
    pairs = stored(spark, phrase_table(benchmark, window), "leak-phrases")
    n_blocks = max(1, -(-pairs.count() // block_pairs))
    block = F.pmod(F.xxhash64("phrase", "item"), F.lit(n_blocks))
    columns = docs.columns if keep is None else keep
    none = F.array()
    frame = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        "text",
        none.cast(_SPAN).alias("spans"),
        none.cast("array<string>").alias("items"),
    )
    for number in range(n_blocks):
        rows = pairs.where(block == number).toArrow()
        held = Phrases(rows.column("phrase").to_pylist(), rows.column("item").to_pylist())
        shared = spark.sparkContext.broadcast(held)  # bounded by block_pairs
        last = number == n_blocks - 1
        frame = _searched(frame, shared, last, with_rest)
        if not last:
            frame = stored(spark, frame, "leaks")
            shared.destroy()
    return frame


def remove_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` with its columns, texts without the spans that test phrases cover."""
    found = find_leaks(spark, docs, benchmark, with_rest=True, **options)
    return found.select(
        *[
            (F.coalesce("rest", "row.text") if c == "text" else F.col(f"row.`{c}`")).alias(c)
            for c in docs.columns
        ]
    )
