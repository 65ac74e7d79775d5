"""Secrets by one automaton: rules compiled by subset construction, minimised, run once per byte.

The rules' regular expressions become one nondeterministic automaton that may start anywhere, then a
deterministic one over classes of bytes that no rule tells apart, then the minimal one, stored as one
transition array. States in which some rule has matched come last, so the pass compares one number
per byte. Where a rule has matched, the automaton of the reversed rule walks back to the leftmost
start and that of the rule forward to the longest end. After a match the rule goes on by an automaton
of its own, which starts anew at the match's end, until that knows as much as the combined one; so
what began inside a match is never looked at again. Walks back end where the rule's last match did,
and the time of a scan is in proportion to the text.

Matches of a rule are leftmost, longest and do not overlap. This equals what a backtracking engine
finds, because each rule ends in one greedy run and its parts before that leave no choice. A match
whose tail (or whole) is shorter than the rule wants is consumed and dropped.

Defined results: null text is empty text; spans count code points, the end is exclusive; repeated
rows, empty tables and other columns need no care; a text may have any length.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwright.llm.arrow import map_columns


@dataclass(frozen=True)
class Rule:
    """``head`` and ``tail`` are joined; a match counts if it and its tail are long enough."""

    kind: str
    head: str
    tail: str
    least: int = 0
    least_tail: int = 0
    any_case: bool = False


# The three base rules, whose spans are contract, then the added ones.
BASE = [
    Rule(
        "assign",
        "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?",
        "[A-Za-z0-9+/_.=-]+",
        least_tail=8,
        any_case=True,
    ),
    Rule("access", "AKIA", "[A-Z0-9]+", least=16),
    # Runs under eight never count; leaving them out keeps common words from being looked at.
    Rule("hex", "", "[0-9a-f]{8,}", least=32),
]
ADDED = [
    Rule("private", "-----BEGIN ([A-Z]+ )*PRIVATE KEY", "-----"),
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]+", least_tail=36),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]+", least_tail=10),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.", "[A-Za-z0-9_-]+"),
]
RULES = BASE + ADDED


class Nfa:
    """Automaton with empty moves, built from a pattern's syntax as it is read.

    The syntax is that of the rules above: literals, escapes, classes, groups, alternatives and the
    repetitions ``? * + {n,}``. ``backward`` builds the automaton of the reversed language.
    """

    def __init__(self):
        self.empty: dict[int, list[int]] = defaultdict(list)
        self.moves: dict[int, tuple[frozenset[int], int]] = {}
        self.size = 0

    def new(self) -> int:
        self.size += 1
        return self.size - 1

    def add(self, pattern: str, any_case: bool, backward: bool) -> tuple[int, int]:
        """First and last state of ``pattern``."""
        self.text, self.at, self.any_case, self.backward = pattern, 0, any_case, backward
        return self._alternatives()

    def _alternatives(self) -> tuple[int, int]:
        first, last = self.new(), self.new()
        while True:
            a, b = self._sequence()
            self.empty[first].append(a)
            self.empty[b].append(last)
            if self.text[self.at : self.at + 1] != "|":
                return first, last
            self.at += 1

    def _sequence(self) -> tuple[int, int]:
        first = last = self.new()
        while self.at < len(self.text) and self.text[self.at] not in "|)":
            a, b = self._repeated()
            if self.backward:
                self.empty[b].append(first)
                first = a
            else:
                self.empty[last].append(a)
                last = b
        return first, last

    def _repeated(self) -> tuple[int, int]:
        start = self.at
        a, b = self._atom()
        least, endless = 1, False
        sign = self.text[self.at : self.at + 1]
        if sign and sign in "?*+":
            self.at += 1
            least, endless = int(sign == "+"), sign != "?"
        elif sign == "{":
            close = self.text.index("}", self.at)
            least, endless = int(self.text[self.at + 1 : close].rstrip(",")), True
            self.at = close + 1
        else:
            return a, b
        after = self.at
        first, last = a, b
        for _ in range(least - 1):  # read the atom again for each copy
            self.at = start
            a, b = self._atom()
            self.empty[last].append(a)
            last = b
        self.at = after
        if endless:
            self.empty[b].append(a)
        if least == 0:
            outer, end = self.new(), self.new()
            self.empty[outer] += [first, end]
            self.empty[last].append(end)
            return outer, end
        return first, last

    def _atom(self) -> tuple[int, int]:
        if self.text[self.at] == "(":
            self.at += 1
            found = self._alternatives()
            self.at += 1
            return found
        held = self._class() if self.text[self.at] == "[" else {self._character()}
        if self.any_case:
            held |= {x ^ 0x20 for x in held if chr(x).isalpha()}
        first, last = self.new(), self.new()
        self.moves[first] = (frozenset(held), last)
        return first, last

    def _character(self) -> int:
        c = self.text[self.at]
        self.at += 1
        if c != "\\":
            return ord(c)
        c = self.text[self.at]
        self.at += 1
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord(c)

    def _class(self) -> set[int]:
        self.at += 1
        held: set[int] = set()
        while self.text[self.at] != "]":
            low = high = self._character()
            if self.text[self.at] == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                high = self._character()
            held |= set(range(low, high + 1))
        self.at += 1
        return held

    def closure(self, states) -> frozenset[int]:
        seen, queue = set(states), list(states)
        while queue:
            for s in self.empty[queue.pop()]:
                if s not in seen:
                    seen.add(s)
                    queue.append(s)
        return frozenset(seen)


@dataclass
class Automaton:
    """``table[state + class of byte]`` is the next state; states are multiples of ``width``.

    States from ``first_accepting`` on accept: ``accepts`` lists the rules of each. ``dead`` is the
    state without a way to accept, or -1.
    """

    classes: bytes
    width: int
    table: list[int]
    start: int
    first_accepting: int
    accepts: dict[int, tuple[int, ...]]
    dead: int


def compile_rules(rules: list[Rule], anywhere: bool, backward: bool = False) -> Automaton:
    nfa = Nfa()
    ends: dict[int, int] = {}
    starts = []
    for number, rule in enumerate(rules):
        first, last = nfa.add(rule.head + rule.tail, rule.any_case, backward)
        starts.append(first)
        ends[last] = number
    classes, width = _byte_classes([held for held, _ in nfa.moves.values()])
    steps = {
        s: (frozenset(classes[byte] for byte in held), target)
        for s, (held, target) in nfa.moves.items()
    }

    always = set(starts) if anywhere else set()
    initial = nfa.closure(starts)
    found = {initial: 0}
    queue, rows = [initial], []
    closures: dict[frozenset[int], frozenset[int]] = {}
    for states in queue:  # subset construction
        reached = [set(always) for _ in range(width)]
        for s in states:
            if s in steps:
                for kind in steps[s][0]:
                    reached[kind].add(steps[s][1])
        row = []
        for target in map(frozenset, reached):
            if target not in closures:
                closures[target] = nfa.closure(target)
            target = closures[target]
            if target not in found:
                found[target] = len(found)
                queue.append(target)
            row.append(found[target])
        rows.append(row)
    marks = [tuple(sorted(ends[s] for s in states if s in ends)) for states in queue]
    return _minimal(rows, marks, classes, width)


def _byte_classes(held: list[frozenset[int]]) -> tuple[bytes, int]:
    """The class of each byte, and the number of classes."""
    kinds: dict[tuple[bool, ...], int] = {}
    classes = bytes(
        kinds.setdefault(tuple(byte in h for h in held), len(kinds)) for byte in range(256)
    )
    return classes, len(kinds)


def _minimal(rows, marks, classes: bytes, width: int) -> Automaton:
    """Merge states by refinement: first by their marks, then by the blocks of their successors."""
    kinds: dict = {}
    block = [kinds.setdefault(m, len(kinds)) for m in marks]
    while True:
        finer: dict = {}
        after = [
            finer.setdefault((block[s], *(block[t] for t in rows[s])), len(finer))
            for s in range(len(rows))
        ]
        if len(finer) == len(set(block)):
            break
        block = after
    one_of = {b: s for s, b in reversed(list(enumerate(block)))}
    order = sorted(one_of, key=lambda b: (bool(marks[one_of[b]]), b))
    place = {b: i * width for i, b in enumerate(order)}
    table = [place[block[t]] for b in order for t in rows[one_of[b]]]
    accepts = {place[b]: marks[one_of[b]] for b in order if marks[one_of[b]]}
    stuck = [
        place[b]
        for b in order
        if not marks[one_of[b]] and all(block[t] == b for t in rows[one_of[b]])
    ]
    return Automaton(
        classes,
        width,
        table,
        place[block[0]],
        min(accepts, default=len(table)),
        accepts,
        stuck[0] if stuck else -1,
    )


class Scanner:
    """Spans of all rules in bytes."""

    def __init__(self, rules: list[Rule] = RULES):
        self.rules = rules
        self.all = compile_rules(rules, anywhere=True)
        self.own = [compile_rules([r], anywhere=True) for r in rules]
        self.same = [self._projection(own) for own in self.own]
        self.forward = [compile_rules([r], False) for r in rules]
        self.back = [compile_rules([r], False, backward=True) for r in rules]
        self.heads = [compile_rules([Rule("", r.head, "", any_case=r.any_case)], False) for r in rules]

    def _projection(self, own: Automaton) -> dict[int, int]:
        """The state of a rule's own automaton after any text, by the state of the combined one."""
        bytes_of = {kind: byte for byte, kind in enumerate(self.all.classes)}
        found = {self.all.start: own.start}
        queue = [self.all.start]
        for state in queue:
            for kind, byte in bytes_of.items():
                after = self.all.table[state + kind]
                if after not in found:
                    found[after] = own.table[found[state] + own.classes[byte]]
                    queue.append(after)
        return found

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, by start and then rule."""
        found = []
        resume = [0] * len(self.rules)
        anew: dict[int, int] = {}  # rules that go on by their own automaton, with its state
        table, state, first = self.all.table, self.all.start, self.all.first_accepting
        for at, kind in enumerate(data.translate(self.all.classes)):
            state = table[state + kind]
            if state < first and not anew:
                continue
            matched = [r for r in self.all.accepts.get(state, ()) if r not in anew]
            for rule in list(anew):
                if at >= resume[rule]:
                    own = self.own[rule]
                    anew[rule] = after = own.table[anew[rule] + own.classes[data[at]]]
                    if after >= own.first_accepting:
                        matched.append(rule)
                    elif after == self.same[rule][state]:
                        del anew[rule]
            for rule in matched:
                start, end = self._around(data, rule, at + 1, resume[rule])
                resume[rule], anew[rule] = end, self.own[rule].start
                if self._counts(data, rule, start, end):
                    found.append((start, rule, end))
        return sorted(found)

    def _around(self, data: bytes, rule: int, end: int, floor: int) -> tuple[int, int]:
        """The match that is known to end at ``end``, not starting before ``floor``, made longest."""
        start, a = end, self.back[rule]
        state, at = a.start, end
        while at > floor and state != a.dead:
            at -= 1
            state = a.table[state + a.classes[data[at]]]
            if state >= a.first_accepting:
                start = at
        return start, self._longest(data, self.forward[rule], start)

    @staticmethod
    def _longest(data: bytes, a: Automaton, start: int) -> int:
        """End of the longest match from ``start``."""
        state, end = a.start, start
        for at in range(start, len(data)):
            state = a.table[state + a.classes[data[at]]]
            if state >= a.first_accepting:
                end = at + 1
            elif state == a.dead:
                break
        return end

    def _counts(self, data: bytes, rule: int, start: int, end: int) -> bool:
        wanted = self.rules[rule]
        if end - start < wanted.least:
            return False
        if not wanted.least_tail:
            return True
        return end - self._longest(data, self.heads[rule], start) >= wanted.least_tail

    def code_point_spans(self, text: str) -> list[tuple[int, int, int]]:
        data = text.encode()
        spans = self.spans(data)
        if len(data) == len(text) or not spans:
            return spans
        place, at, points = {}, 0, 0
        for edge in sorted({e for s, _, t in spans for e in (s, t)}):
            points += len(data[at:edge].decode())
            place[edge] = points
            at = edge
        return [(place[s], rule, place[t]) for s, rule, t in spans]


def find_secrets(
    spark: SparkSession, docs: DataFrame, rules: list[Rule] | None = None
) -> DataFrame:
    """doc_id and ``found``, an array of (kind, start, end) by start and then kind as listed."""
    rules = rules or RULES
    shared = spark.sparkContext.broadcast(Scanner(rules))  # its size depends on the rules only

    def make():
        scanner = shared.value

        def work(columns):
            return {
                "doc_id": columns["doc_id"],
                "found": [
                    [
                        {"kind": rules[r].kind, "start": s, "end": e}
                        for s, r, e in scanner.code_point_spans(text or "")
                    ]
                    for text in columns["text"]
                ],
            }

        return work

    return map_columns(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        make,
        "doc_id long, found array<struct<kind: string, start: long, end: long>>",
    )


def secret_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, the number of spans of each base kind, a digest of these, and all spans as text."""
    base = [r.kind for r in BASE]

    def spelled(spans: Column) -> Column:
        one = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
        return F.array_join(one, ",")

    def count(kind: str) -> Column:
        own = F.filter("found", lambda x: x["kind"] == kind)
        return F.size(own).cast("long").alias(f"n_{kind}")

    found = find_secrets(spark, docs)
    own = F.filter("found", lambda x: x["kind"].isin(base))
    return found.select(
        "doc_id",
        *map(count, base),
        F.sha2(spelled(own), 256).alias("base_sha256"),
        spelled(F.col("found")).alias("spans"),
    )
