"""Fill-in-middle, decontamination and hard negatives against plain versions."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskwright.llm import decontaminate, fill_in_middle, hard_negatives

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 997}" for i in range(30_000))
DOCS = "doc_id long, text string, row string, place int, origin int, `a.b` string, spans int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, texts, parts=3):
    rows = [(k, t, "r", 1, 2, "dot", 3) for k, t in texts]
    return spark.createDataFrame(rows, DOCS).repartition(parts)


# Fill-in-middle


def plain_fill(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return (doc_id, n, "plain", None, None, text, text)
    p, q = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b, c = ("".join(x) for x in (units[:p], units[p:q], units[q:]))
    spm = h4 % 100 < 80
    output = f"<S>{c}<P>{a}<M>{b}" if spm else f"<P>{a}<S>{c}<M>{b}"
    return (doc_id, n, "spm" if spm else "psm", len(a), len(b), output, text)


def fill_texts():
    rng = random.Random(4)
    pieces = ["one", "two ", "  three", "\n", "\t\x0b", "é中😀", "\u0085x", " ", "<P", ">", "x<S>", "."]
    texts = [(i, "".join(rng.choices(pieces, k=rng.randint(1, 30)))) for i in range(150)]
    same = [(7, "a text that is there more than once, with words enough")] * 40
    return texts + same + [
        (None, "no id at all"), (None, "no id at all"), (None, None), (200, None), (201, ""), (202, "  "),
        (203, LONG), (204, "x" * 50_000), (205, " lead"), (206, "trail "), (207, "<M>"), (7, "the same id"),
    ]


@pytest.mark.parametrize("units", [1, 3, 4096])
def test_fill_in_middle_equals_plain_version(spark, units):
    texts = fill_texts() if units > 1 else [t for t in fill_texts() if len(t[1] or "") < 1_000]
    found = fill_in_middle.transform(spark, frame(spark, texts), piece_units=units).collect()
    key = repr
    wanted = sorted((plain_fill(*t) for t in texts), key=key)
    got = sorted(
        ((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["restored"])
         for r in found), key=key,
    )
    assert got == wanted
    assert {"plain", "psm", "spm"} == {r["form"] for r in found}
    for r in found:
        assert (r["output_sha256"], r["restored_sha256"]) == (sha(r["output"]), sha(r["restored"]))


def test_fill_in_middle_plan_and_empty_table(spark):
    docs = frame(spark, [(1, "a b c")])
    assert fill_in_middle.transform(spark, docs.where("false")).collect() == []
    held = fill_in_middle.transform(spark, spark.createDataFrame([(1, "a b c")], "doc_id long, text string"))
    assert held._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    texts = fill_in_middle.transform(spark, docs, with_texts=False).first()
    assert texts["output"] is None and texts["restored_sha256"] == sha("a b c")


# Decontamination


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_leaks(text, benchmark, window=10):
    own, hit, items = words(text), set(), set()
    for item, phrase_text in benchmark:
        phrase = words(phrase_text)
        size = min(window, len(phrase))
        for i in range(len(phrase) - size + 1 if size else 0):
            for at in range(len(own) - size + 1):
                if own[at : at + size] == phrase[i : i + size]:
                    hit.update(range(at, at + size))
                    items.add("" if item is None else str(item))
    return len(own), sorted(hit), sorted(items)


def leak_texts(rng):
    def some(n):
        return " ".join(rng.choices(["a", "b", "C", "é", "d1", "so", "on"], k=n))

    bench = [(i, some(rng.choice([12, 15, 30]))) for i in range(12)]
    bench += [(None, some(11)), (3, some(14)), (40, bench[1][1]), (41, "only three words"), (42, "..."),
              (43, None), (44, "rare")]
    texts = []
    for i in range(120):
        a, b = rng.choice(bench)[1] or "", rng.choice(bench)[1] or ""
        cut = rng.randint(0, 20)
        texts.append((i, f"{some(rng.randint(0, 9))} x, {a[cut:]} {some(3)}; ONLY-three words {b[: 3 * cut]}"))
    texts += [(500, None), (501, ""), (502, "?!"), (None, bench[0][1]), (500, bench[2][1].upper())]
    texts += [(7, bench[4][1])] * 5
    texts.append((600, f"{some(400)} {bench[5][1]} {some(300)} rare"))
    return bench, texts


@pytest.mark.parametrize("block_pairs", [200_000, 20])
def test_leaks_equal_plain_version(spark, monkeypatch, block_pairs):
    bench, texts = leak_texts(random.Random(8))
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    found = decontaminate.find_leaks(
        spark, frame(spark, texts), benchmark, keep=["doc_id", "text", "a.b"], block_pairs=block_pairs,
        with_rest=True,
    ).collect()
    assert len(found) == len(texts)
    key = repr
    got = sorted(
        ((r["row"]["doc_id"], r["row"]["text"], r["n_words"],
          [i for s in r["spans"] for i in range(s["start"], s["stop"])], list(r["items"])) for r in found),
        key=key,
    )
    wanted = sorted(((k, t, *plain_leaks(t, bench)) for k, t in texts), key=key)
    assert got == wanted
    assert any(w[3] for w in wanted) and any(not w[3] for w in wanted)
    for r in found:
        text = r["row"]["text"] or ""
        cut = [text[c["start"] : c["stop"]] for c in r["cuts"]]
        assert [words(c) for c in cut] == [words(text)[s["start"] : s["stop"]] for s in r["spans"]]
        assert r["rest"] is None or len(r["rest"]) + sum(map(len, cut)) == len(text)


def test_long_texts_are_indexed_in_overlapping_parts(monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 64)
    bench, texts = leak_texts(random.Random(9))
    pairs = {
        (" ".join(words(t)[i : i + 10]), "" if k is None else str(k))
        for k, t in bench if words(t) for i in range(max(1, len(words(t)) - 9))
    }
    phrases, items = zip(*sorted(pairs))
    searcher = decontaminate.Searcher(decontaminate.Phrases(list(phrases), list(items)))
    for owner, (_, text) in enumerate(texts):
        searcher.add(owner, decontaminate.words_of(text))
    searcher.search()
    for owner, (_, text) in enumerate(texts):
        spans, held = searcher.take(owner, [], [])
        n, hit, wanted = plain_leaks(text, bench)
        assert ([i for s in spans for i in range(s["start"], s["stop"])], held) == (hit, wanted)


def test_fm_index_against_plain_search():
    rng = np.random.default_rng(5)
    for n_symbols in (2, 3, 9, 40):
        symbols = rng.integers(0, n_symbols, 700)
        symbols[300:400] = symbols[100:200]
        symbols[-1] = 0
        index = decontaminate.FmIndex(symbols, n_symbols, sample=5)
        phrases = [rng.integers(1, n_symbols, rng.integers(1, 5)) for _ in range(60)] + [symbols[110:114]]
        phrases = [p for p in phrases if (p > 0).all()]
        backward = np.zeros((len(phrases), 4), np.int64)
        for i, p in enumerate(phrases):
            backward[i, : len(p)] = p[::-1]
        low, high = index.ranges(backward, np.array([len(p) for p in phrases]))
        for p, a, b in zip(phrases, low, high):
            wanted = [i for i in range(len(symbols) - len(p) + 1) if (symbols[i : i + len(p)] == p).all()]
            got = sorted(index.locate(np.arange(a, b)).tolist()) if b > a else []
            assert got == wanted


def test_remove_leaks_keeps_columns_and_clean_texts(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    benchmark = spark.createDataFrame([(1, passage)], "item_id long, text string")
    texts = [(1, f"Before it, {passage.title()}! After."), (2, "clean text"), (3, None)]
    docs = frame(spark, texts)
    rows = {r["doc_id"]: r for r in decontaminate.remove_leaks(spark, docs, benchmark).collect()}
    assert list(rows[1].asDict()) == docs.columns
    assert [rows[k]["text"] for k in (1, 2, 3)] == ["Before it, ! After.", "clean text", None]
    assert rows[1]["spans"] == 3 and rows[1]["a.b"] == "dot"
    empty = decontaminate.find_leaks(spark, docs, benchmark.where("false")).collect()
    assert len(empty) == 3 and not any(r["spans"] for r in empty)
    assert decontaminate.remove_leaks(spark, docs.where("false"), benchmark).collect() == []


# Hard negatives


def plain_negatives(rows, every=100):
    held = []
    for vec_id, label, vector in rows:
        bad = vector is None or any(x is None or not np.isfinite(x) for x in vector)
        if vec_id is not None and label is not None and not bad:
            held.append((vec_id, label, [int(np.floor(256 * np.float64(np.float32(x)))) for x in vector]))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    found = []
    for anchor, label, vector in held:
        if anchor % every:
            continue
        others = sorted(((-score(vector, v), i, lab) for i, lab, v in held if i != anchor))
        negatives = [(-s, i) for s, i, lab in others if lab != label]
        for s, positive, _ in [o for o in others if o[2] == label][:5]:
            inside = [n for n in negatives if 30 * -s <= 100 * n[0] <= 90 * -s][:10]
            found += [(anchor, positive, k, i, -s, n) for k, (n, i) in enumerate(inside, 1)]
    return sorted(found)


def vectors_of(rng, n, width=6):
    def vector():
        return [round(float(x), 2) for x in rng.normal(size=width) + 0.4]

    rows = [(i, int(rng.integers(0, 3)), vector()) for i in range(n)]
    rows += [(10, 1, rows[11][2])] * 3 + [(n + 1, 0, rows[3][2])] * 4  # repeated rows and ties
    rows += [(None, 1, vector()), (20, None, vector()), (21, 1, None), (22, 1, [None] * width),
             (23, 2, [float("nan")] * width), (24, 2, [float("inf")] + [0.0] * (width - 1)),
             (25, 0, []), (30, 0, [1.0, 2.0]), (40, 1, vector() + [9.0, -3.0])]
    return rows


@pytest.mark.parametrize("block_anchors", [4096, 7])
def test_hard_negatives_equal_plain_version(spark, block_anchors):
    rows = vectors_of(np.random.default_rng(3), 400)
    given = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    given = given.withColumns({"slot": F.lit(1), "score": F.lit("x"), "anchor": F.lit(2)}).repartition(5)
    found = hard_negatives.mine(spark, given, anchors_every=10, block_anchors=block_anchors)
    got = sorted(tuple(r) for r in found.collect())
    wanted = plain_negatives(rows, every=10)
    assert got == wanted and len(got) > 500


def test_hard_negatives_of_nothing(spark):
    schema = "vec_id long, label int, embedding array<float>"
    for rows in ([], [(100, 1, [1.0])], [(1, 1, [1.0]), (2, 2, [1.0])], [(100, None, None)]):
        given = hard_negatives.relabelled(spark.createDataFrame(rows, schema))
        assert hard_negatives.mine(spark, given).collect() == []
    moved = hard_negatives.relabelled(
        spark.createDataFrame([(7, 9, None), (8, 9, None), (None, 9, None)], schema)
    )
    assert [r["label"] for r in moved.orderBy("vec_id").collect()] == [9, 0, 9]


def test_inexact_scores_are_refused():
    with pytest.raises(ValueError, match="exact"):
        hard_negatives.scores(np.full((1, 4), 1e9), np.full((1, 4), 1e9))
    exact = hard_negatives.scores(np.full((1, 2), 4097.0), np.full((1, 2), 4099.0))
    assert exact[0, 0] == 2 * 4097 * 4099
