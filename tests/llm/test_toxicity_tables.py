"""Toxicity models with more words or bigrams than a task holds."""

from __future__ import annotations

import random

import pytest

from deskwright.llm import toxicity


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(31)
    common = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    docs, labels = [], []
    for i in range(400):
        words = rng.choices(common, k=rng.randint(5, 40))
        toxic = int(rng.random() < 0.3)
        for _ in range(3 * toxic):
            at = rng.randint(0, len(words))
            rare = "only" + chr(97 + i // 26) + chr(97 + i % 26)
            words[at:at] = rng.choice([["vile"], ["you", "scum"], ["scum"], [rare, "scum"], ["vile", "scum"]])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    docs += [(400, ""), (401, None), (402, "never seen"), (403, "scum you"), (403, "scum you"), (None, "vile")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def scores(spark, model, docs):
    rows = toxicity.score(spark, model, docs).collect()
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["score"]) for r in rows))


@pytest.mark.parametrize("bounds", [{"vocabulary": 3}, {"bigrams": 1}])
def test_larger_models_are_joined_and_give_the_same_scores(spark, tables, bounds):
    docs, labels = tables
    held = toxicity.fit(spark, docs, labels)
    joined = toxicity.fit(spark, docs, labels, **bounds)
    assert isinstance(held, toxicity.Model) and isinstance(joined, toxicity.JoinedModel)
    assert {r["w"] for r in joined.words.collect()} >= {"vile", "scum"} and joined.pairs.count()
    texts = docs.distinct()
    found = {(r["doc_id"], r["text"]): r["x"] for r in joined.differences(texts).collect()}
    assert len(found) == texts.count()
    for (_, text), x in found.items():
        assert x == pytest.approx(held.difference(text), abs=1e-4)
    assert scores(spark, joined, docs) == [
        (a, b, pytest.approx(c, abs=0.02)) for a, b, c in scores(spark, held, docs)
    ]


def test_no_known_word_is_left_out(spark):
    """More telling words than the 10,000 that the model once had."""
    words = [f"{a}{b}{c}x" for a in map(chr, range(97, 123)) for b in map(chr, range(97, 123)) for c in "abcdefghijklmnopqrst"]
    rows, labels = [], []
    for i in range(0, 60):
        rows.append((i, " ".join(words) if i % 2 else " ".join(w + "y" for w in words)))
        labels.append((i, 1, i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = toxicity.fit(spark, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert isinstance(held, toxicity.Model) and len(held.places) == 2 * len(words)
