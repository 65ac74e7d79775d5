"""Spans of secrets in chained text against the rules' regular expressions, and the time they take."""

from __future__ import annotations

import random
import re
import time

import pytest

from deskwright.llm.secret_scan import RULES, Scanner

PARTS = [
    "token", "secret", "password", "api_key", "PASSWD", "=", ":", " ", "'", '"', "_", "é", "\n",
    "AKIA", "ABCD1234", "deadbeef", "0123456789abcdef0", "x", "a1B2c3D4", ".", "-", "-----", "BEGIN ",
    "RSA ", "PRIVATE KEY", "-----BEGIN RSA PRIVATE KEY-----", "eyJ", "eyJab", "ghp_", "xoxb-",
]


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    found = []
    for number, rule in enumerate(RULES):
        head = f"(?i:{rule.head})" if rule.any_case else f"(?:{rule.head})"
        for m in re.finditer(f"{head}(?P<tail>{rule.tail})", text):
            enough = m.end() - m.start() >= rule.least and len(m["tail"]) >= rule.least_tail
            if enough:
                found.append((m.start(), number, m.end()))
    return sorted(found)


def test_chained_rules_equal_their_regular_expressions():
    rng, scanner = random.Random(1), Scanner()
    texts = ["".join(rng.choices(PARTS, k=rng.randint(1, 60))) for _ in range(3_000)]
    texts += ["".join(rng.choices(PARTS[:10], k=rng.randint(10, 300))) for _ in range(300)]
    held = [plain_spans(t) for t in texts]
    assert [scanner.code_point_spans(t) for t in texts] == held
    assert {rule for spans in held for _, rule, _ in spans} == set(range(len(RULES)))


@pytest.mark.parametrize(
    "piece", ["token=secret:", "eyJa.", "AKIA", "password ", "ghp_", "xoxb-", "-----BEGIN ", "deadbeef"]
)
def test_time_is_in_proportion_to_chained_text(piece):
    scanner, seconds = Scanner(), []
    for size in (50_000, 400_000):
        started = time.process_time()
        scanner.spans((piece * size)[:size].encode() + b"x" * size)
        seconds.append(time.process_time() - started)
    assert seconds[1] < 40 * max(seconds[0], 0.02)  # 64 times, were it quadratic
    assert seconds[1] < 10
