"""Plain versions of the operators, row by row, for comparison."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACES = " \t\n\x0b\x0c\r"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {i + k for found in windows.values() if len(found) > 1 for i in found for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def kept_lines(docs: list[tuple[int | None, str | None]]) -> list[tuple[int, int, str]]:
    """n_lines, n_dropped and kept text, in the order of ``docs``."""
    order = [-(1 << 63) if k is None else k for k, _ in docs]
    keys = [
        [line.strip(SPACES).translate(LOWER) for line in (t or "").split("\n")] for _, t in docs
    ]
    first: dict[str, int] = {}
    for doc, found in zip(order, keys):
        for key in found:
            first[key] = min(first.get(key, doc), doc)
    made = []
    for doc, found, (_, text) in zip(order, keys, docs):
        lines = (text or "").split("\n")
        kept = [x for x, key in zip(lines, found) if len(key) < 10 or first[key] == doc]
        made.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return made


def shingles(text: str | None) -> frozenset[str]:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) >= 5:
        return frozenset(" ".join(words[i : i + 5]) for i in range(len(words) - 4))
    return frozenset([" ".join(words)]) if words else frozenset()


def near_components(texts: list[str | None], percent: int) -> list[int]:
    """A number per text, equal in a component."""
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)


def base_secrets(text: str | None) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end)."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
        for m in re.finditer(pattern, text):
            if len(m[0]) >= least:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def remainder(doc_id: int | None, divisor: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % divisor
