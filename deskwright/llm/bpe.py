"""Byte-level BPE: boundaries by a scan of transition functions, cached merges, exact decoding.

Pre-tokenisation needs no regular expression. Every code point has a class (letter, number, white
space, other); with one or two code points of lookahead it becomes a symbol, and each symbol is a
function from lexer state to lexer state. The functions that can arise by composition are few, so a
function is one byte and composing two is one table lookup. Composition is associative: blocks are
scanned side by side, their totals by doubling, and the state before every code point tells whether
a piece begins there. All documents of a slice are scanned together, kept apart by a symbol that
forgets the state.

A piece is merged by rank and the result is cached; a full cache is emptied. Long pieces are merged
with a heap. The byte offset of every token is kept, so that any run of tokens can be decoded.

Defined results: null text is empty text, which has no tokens; repeated rows, empty tables and other
columns need no care; a piece or text may have any length.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwright.llm.arrow import map_columns

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CACHE_PIECES = 400_000
HEAP_FROM = 96
WINDOW = 1 << 20
BLOCK = 64

# Classes of code points, then symbols (a class with its lookahead).
LETTER, NUMBER, SPACE, OTHER, BREAK = range(5)
S_LETTER, S_NUMBER, S_OTHER, S_APOSTROPHE1, S_APOSTROPHE2, S_JOINED, S_INNER, S_LAST, S_RESET = (
    range(9)
)
# Lexer states: nothing open, runs, a space that the next run takes, letters due of a contraction.
NONE, LETTERS, NUMBERS, OTHERS, TAKEN, SPACES, DUE1, DUE2 = range(8)
END = 0x110000
# Contractions that are pieces of their own, by letters after the apostrophe.
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a piece begins with this symbol."""
    if symbol == S_RESET:
        return NONE, True
    if symbol == S_LETTER:
        if state in (LETTERS, TAKEN):
            return LETTERS, False
        if state == DUE2:
            return DUE1, False
        return (NONE, False) if state == DUE1 else (LETTERS, True)
    if symbol == S_NUMBER:
        return NUMBERS, state not in (NUMBERS, TAKEN)
    if symbol == S_OTHER or state in (OTHERS, TAKEN) and symbol in (S_APOSTROPHE1, S_APOSTROPHE2):
        return OTHERS, state not in (OTHERS, TAKEN)
    if symbol == S_APOSTROPHE1:
        return DUE1, True
    if symbol == S_APOSTROPHE2:
        return DUE2, True
    if symbol == S_JOINED:
        return TAKEN, True
    if symbol == S_INNER:
        return SPACES, state != SPACES
    return NONE, True


def _tables() -> tuple[np.ndarray, ...]:
    """Function of each symbol, composition, application, and where pieces begin."""
    states = range(DUE2 + 1)
    own = [tuple(_step(s, x)[0] for s in states) for x in range(S_RESET + 1)]
    found = {tuple(states): 0}
    for function in own:
        found.setdefault(function, len(found))
    queue = list(found)
    for first in queue:
        for then in own:
            both = tuple(then[s] for s in first)
            if both not in found:
                found[both] = len(found)
                queue.append(both)
    every = list(found)
    if len(every) > 256:
        raise AssertionError("a transition function no longer fits a byte")
    compose = np.zeros((len(every), len(every)), np.uint8)
    for i, first in enumerate(every):
        for j, then in enumerate(every):
            compose[i, j] = found[tuple(then[s] for s in first)]
    symbol_function = np.array([found[f] for f in own], np.uint8)
    begins = np.array([[_step(s, x)[1] for x in range(S_RESET + 1)] for s in states])
    return symbol_function, compose, np.array(every, np.uint8), begins


SYMBOL_FUNCTION, COMPOSE, APPLY, BEGINS = _tables()


def states_before(symbols: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """The lexer state before each symbol and after the last one."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.uint8), state
    lanes = -(-n // BLOCK)
    functions = np.zeros(lanes * BLOCK, np.uint8)  # 0 is the identity
    functions[:n] = SYMBOL_FUNCTION[symbols]
    scan = np.ascontiguousarray(functions.reshape(lanes, BLOCK).T)
    for j in range(1, BLOCK):
        scan[j] = COMPOSE[scan[j - 1], scan[j]]
    totals = scan[-1].copy()
    width = 1
    while width < lanes:
        totals[width:] = COMPOSE[totals[:-width], totals[width:]]
        width *= 2
    entry = np.empty(lanes, np.uint8)
    entry[0] = state
    entry[1:] = APPLY[totals[:-1], state]
    after = APPLY[scan, entry].T.reshape(-1)[:n]
    before = np.empty(n, np.uint8)
    before[0] = state
    before[1:] = after[:-1]
    return before, int(after[-1])


def symbols_of(points: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Symbols of code points, which end with END."""
    kind = classes[points]
    after = np.append(kind[1:], BREAK)
    symbols = np.array([S_LETTER, S_NUMBER, S_INNER, S_OTHER, S_RESET], np.uint8)[kind]
    spaces = np.flatnonzero(kind == SPACE)
    ends = spaces[after[spaces] < BREAK]
    ends = ends[after[ends] != SPACE]
    symbols[ends] = np.where(points[ends] == 0x20, S_JOINED, S_LAST)
    quotes = np.flatnonzero(points == 0x27)
    if len(quotes):
        padded = np.append(points, [END, END])
        one, two = padded[quotes + 1], padded[quotes + 2]
        for text in CONTRACTIONS:
            fits = one == ord(text[0])
            if len(text) == 2:
                fits &= two == ord(text[1])
            symbols[quotes[fits]] = S_APOSTROPHE1 if len(text) == 1 else S_APOSTROPHE2
    return symbols


def piece_starts(points: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Positions where a piece or a text's END begins, in texts each followed by END."""
    found, state = [], NONE
    for start in range(0, len(points), WINDOW):
        # Two code points of lookahead from the next window.
        ahead = points[start : start + WINDOW + 2]
        symbols = symbols_of(ahead, classes)[:WINDOW]
        before, state = states_before(symbols, state)
        found.append(np.flatnonzero(BEGINS[before, symbols]) + start)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def code_point_classes() -> list[tuple[int, int]]:
    """(first code point, class) of every run of equal classes.

    Taken from the tables of the tokenizer library: a pattern of one class drops all other text.
    """
    import tiktoken

    single_bytes = {bytes([i]): i for i in range(256)}
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, END))))
    classes = np.full(END, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        one = tiktoken.Encoding(
            "one-class", pat_str=pattern, mergeable_ranks=single_bytes, special_tokens={}
        )
        held = one.decode(one.encode_ordinary(every))
        classes[np.frombuffer(held.encode("utf-32-le"), np.uint32)] = kind
    starts = np.flatnonzero(np.diff(classes, prepend=np.uint8(255)))
    return [(int(s), int(classes[s])) for s in starts]


def expand_classes(runs: list[tuple[int, int]]) -> np.ndarray:
    starts = [s for s, _ in runs]
    lengths = np.diff([*starts, END])
    return np.append(np.repeat(np.array([c for _, c in runs], np.uint8), lengths), BREAK)


class Pieces(dict):
    """Token ids of a piece of text, merged on first use."""

    def __init__(self, ranks: dict[bytes, int], limit: int = CACHE_PIECES):
        super().__init__()
        self.ranks = ranks
        self.limit = limit

    def __missing__(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        rank = self.ranks.get(data)
        if rank is not None:
            ids = (rank,)
        else:
            ids = self.merge_long(data) if len(data) >= HEAP_FROM else self.merge(data)
        if len(self) >= self.limit:
            self.clear()
        if len(data) < HEAP_FROM:
            self[piece] = ids
        return ids

    def merge(self, data: bytes) -> tuple[int, ...]:
        rank_of = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        never = len(self.ranks)
        pairs = [rank_of(a + b, never) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = min(pairs)
            if best == never:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank_of(parts[i - 1] + parts[i], never)
            if i < len(pairs):
                pairs[i] = rank_of(parts[i] + parts[i + 1], never)
        return tuple(self.ranks[p] for p in parts)

    def merge_long(self, data: bytes) -> tuple[int, ...]:
        """The same merges with a heap of pairs, for pieces of any length."""
        rank_of, n = self.ranks.get, len(data)
        ends, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def push(i: int) -> None:
            j = right[i]
            if j < n and (rank := rank_of(data[i : ends[j]])) is not None:
                heap.append((rank, i, ends[j])) if building else heapq.heappush(
                    heap, (rank, i, ends[j])
                )

        building = True
        for i in range(n):
            push(i)
        heapq.heapify(heap)
        building = False
        while heap:
            _, i, end = heapq.heappop(heap)
            j = right[i] if ends[i] else n
            if j >= n or not ends[j] or ends[j] != end:
                continue
            ends[i], ends[j] = end, 0
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            push(i)
            if left[i] >= 0:
                push(left[i])
        return tuple(self.ranks[data[i : ends[i]]] for i in range(n) if ends[i])


class ByteBpe:
    """Encodes and decodes in a task."""

    def __init__(self, rank_file: bytes, class_runs: list[tuple[int, int]]):
        lines = (line.split() for line in rank_file.splitlines() if line)
        ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.classes = expand_classes(class_runs)
        self.pieces = Pieces(ranks)
        self.tokens = {rank: token for token, rank in ranks.items()}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).copy()
        ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) - 1
        points[ends] = END
        starts = piece_starts(points, self.classes)
        last = np.searchsorted(starts, ends)  # the pieces of a text come before its END
        begin, encoded, bounds = 0, [], starts.tolist()
        for stop in last.tolist():
            pieces = map(
                self.pieces.__getitem__,
                [joined[a:b] for a, b in zip(bounds[begin:stop], bounds[begin + 1 : stop + 1])],
            )
            encoded.append(np.fromiter(chain.from_iterable(pieces), np.uint32))
            begin = stop + 1
        return encoded

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """First byte of each token in the UTF-8 text, and the text's length."""
        return np.cumsum([0, *(len(self.tokens[i]) for i in ids.tolist())])

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


# The coder of a worker process, which serves many tasks and keeps its merged pieces.
_CODERS: dict[str, ByteBpe] = {}


def _coder(spark: SparkSession, vocabulary: str | None):
    """A function for tasks that makes the coder; the driver reads the vocabulary once."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path(VOCABULARY)
    with open(vocabulary, "rb") as file:
        rank_file = file.read()
    shared = spark.sparkContext.broadcast((rank_file, code_point_classes()))
    name = hashlib.sha256(rank_file).hexdigest()

    def coder() -> ByteBpe:
        if name not in _CODERS:
            _CODERS.clear()
            _CODERS[name] = ByteBpe(*shared.value)
        return _CODERS[name]

    return coder


def encode_documents(
    spark: SparkSession, docs: DataFrame, vocabulary: str | None = None
) -> DataFrame:
    """doc_id, ids and offsets (first byte of each token, then the number of bytes)."""
    coder = _coder(spark, vocabulary)

    def make():
        bpe = coder()

        def work(columns):
            ids = bpe.encode([t or "" for t in columns["text"]])
            return {
                "doc_id": columns["doc_id"],
                "ids": [x.astype(np.int32) for x in ids],
                "offsets": [bpe.offsets(x) for x in ids],
            }

        return work

    return map_columns(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        make,
        "doc_id long, ids array<int>, offsets array<long>",
    )


def decode_documents(
    spark: SparkSession, encoded: DataFrame, vocabulary: str | None = None
) -> DataFrame:
    """doc_id and text of ``encoded(doc_id, ids)``; bytes that are not UTF-8 are replaced."""
    coder = _coder(spark, vocabulary)

    def make():
        bpe = coder()

        def work(columns):
            ids = (np.array(x or [], np.uint32) for x in columns["ids"])
            text = [bpe.decode(x).decode("utf-8", "replace") for x in ids]
            return {"doc_id": columns["doc_id"], "text": text}

        return work

    return map_columns(encoded.select("doc_id", "ids"), make, "doc_id long, text string")


def tokenize(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, source, ids, n_tokens and the digest of the decoded bytes of every document."""
    coder = _coder(spark, vocabulary)

    def make():
        bpe = coder()

        def work(columns):
            ids = bpe.encode([t or "" for t in columns["text"]])
            return {
                "doc_id": columns["doc_id"],
                "source": columns["source"],
                "n_tokens": [len(x) for x in ids],
                "ids": [x.astype(np.int32) for x in ids],
                "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids],
            }

        return work

    return map_columns(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text"),
        make,
        "doc_id long, source string, n_tokens long, ids array<int>, decoded_sha256 string",
    )


def round_trip(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the bytes decoded from them."""
    coder = _coder(spark, vocabulary)

    def make():
        bpe = coder()

        def work(columns):
            ids = bpe.encode([t or "" for t in columns["text"]])
            return {
                "doc_id": columns["doc_id"],
                "n_tokens": [len(x) for x in ids],
                "ids_sha256": [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids],
            }

        return work

    return map_columns(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        make,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
