"""Language and toxicity models against row-by-row versions of the same formulas."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import plain
import pytest

from deskwright.llm import fingerprint, language, toxicity


def plain_language(docs):
    """The scoring function of a model of all labelled ``docs(text, lang)``."""
    counts = [defaultdict(Counter) for _ in range(language.LONGEST + 1)]
    for text, lang in docs:
        for word in language.WORDS.findall(text.lower()):
            counts[0][lang][word] += 1
            for kind, length in enumerate(range(language.LONGEST, 0, -1), 1):
                marked = word if length == 1 else f"<{word}>"
                for i in range(len(marked) - length + 1):
                    counts[kind][lang][marked[i : i + length]] += 1
    languages = sorted({lang for _, lang in docs})
    items = [{item for c in held.values() for item in c} for held in counts]

    def share(kind, lang, item):
        total = sum(counts[kind][lang].values()) + 0.5 * (len(items[kind]) + 1)
        return math.log((counts[kind][lang][item] + 0.5) / total)

    def word_shares(word):
        if word in items[0]:
            return [share(0, lang, word) for lang in languages]
        for kind, length in enumerate(range(language.LONGEST, 0, -1), 1):
            marked = word if length == 1 else f"<{word}>"
            grams = [marked[i : i + length] for i in range(len(marked) - length + 1)]
            known = [g for g in grams if g in items[kind]]
            if known:
                return [sum(share(kind, lang, g) for g in known) / len(known) for lang in languages]
        return [0.0] * len(languages)

    def predict(text):
        words = language.WORDS.findall(text.lower())
        if not words:
            return "und", 0.0
        means = [sum(s) / len(words) for s in zip(*map(word_shares, words))]
        best = max(range(len(languages)), key=lambda i: (means[i], -i))
        evidence = min(len(words), language.SCORED_WORDS)
        return languages[best], 1 / sum(math.exp((m - means[best]) * evidence) for m in means)

    return predict


def random_docs(rng, n):
    syllables = {"aa": ["ba", "lo", "mi", "ta"], "bb": ["sch", "ung", "er", "ta"], "cc": ["eau", "x", "mi", "que"]}
    docs = []
    for i in range(n):
        lang = rng.choice(sorted(syllables))
        words = ["".join(rng.choices(syllables[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(1, 30))]
        docs.append((i, " ".join(words), lang))
    return docs


def test_language_scores_equal_the_plain_model(spark):
    docs = random_docs(random.Random(3), 160)
    model = language.fit(spark, spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    predict = plain_language([d[1:] for d in docs])
    texts = [text for _, text, _ in random_docs(random.Random(4), 80)]
    texts += ["zzz", "Schungeau blx", "ta", "12 _", "ünbekannt ta ta", "w " * 50]
    for text in texts:
        lang, score = model.predict(text)
        wanted, wanted_score = predict(text)
        assert score == pytest.approx(wanted_score, abs=1e-4)
        assert lang == wanted or score < 0.51
    right = sum(model.predict(t)[0] == lang for _, t, lang in random_docs(random.Random(5), 200))
    assert right > 180


def plain_toxicity(train):
    """Toxic minus ordinary log-likelihood per word, from rows of (words, half, toxic)."""
    words, pairs = defaultdict(Counter), defaultdict(Counter)
    for own, half, toxic in train:
        words[half, toxic].update(own)
    total = Counter()
    for held in words.values():
        total.update(held)
    known = {w for w, c in total.items() if c >= toxicity.LEAST_SEEN}
    for own, half, toxic in train:
        ids = ["<start>", *[w if w in known else "" for w in own]]
        pairs[half, toxic].update(zip(ids, ids[1:]))
    tokens = {t: sum(sum(words[h, t].values()) for h in (0, 1)) for t in (0, 1)}
    share = tokens[1] / sum(tokens.values())

    def of(held, key, toxic):
        return sum(held[h, toxic][key] for h in (0, 1))

    def telling(ordinary, toxic):
        expected = (ordinary + toxic) * share
        return (
            toxic - expected > toxicity.TELLING * math.sqrt(expected + 1)
            and toxic * tokens[0] > toxicity.LEAST_RATIO * ordinary * tokens[1]
        )

    all_pairs = set().union(*pairs.values())
    ids = sorted(known) + [""]
    before = Counter(b for _, b in all_pairs)
    toxic_before = Counter(b for a, b in all_pairs if of(pairs, (a, b), 1))
    mapped = defaultdict(Counter)
    for group, held in words.items():
        for w, c in held.items():
            mapped[group][w if w in known else ""] += c
    own_words = {
        w for w in known
        if telling(of(mapped, w, 0), of(mapped, w, 1)) and toxic_before[w] >= toxicity.LEAST_CONTEXTS
    }
    own_pairs = set()
    for a, b in all_pairs:
        x, y = of(pairs, (a, b), 0), of(pairs, (a, b), 1)
        excess = (y - (x + y) * share) / math.sqrt((x + y) * share + 1)
        kept = x + y >= toxicity.LEAST_SEEN and excess > toxicity.TELLING / 2
        if kept and telling(x, y) and b in own_words:
            own_pairs.add((a, b))
    norm = sum(before[w] + 1 for w in ids)
    shared = {w: (before[w] + 1) / norm for w in ids}

    def discount(held, toxic):
        once, twice = (sum(c == n for h in (0, 1) for c in held[h, toxic].values()) for n in (1, 2))
        return once / (once + 2 * twice) if once and twice else 0.75

    models = {}
    for t in (0, 1):
        d = discount(words, t)
        types = sum(len(words[h, t]) for h in (0, 1))
        word = {
            w: max(of(mapped, w, t) - d, 0) / tokens[t] + min(d * types / tokens[t], 1) * shared[w]
            for w in ids
        }
        rest = max(1 - sum(word[w] for w in own_words), 1e-6)
        plain_mass = sum(shared[w] for w in ids if w not in own_words)
        word = {w: word[w] if w in own_words else rest * shared[w] / plain_mass for w in ids}
        d = discount(pairs, t)
        after = Counter()
        for h in (0, 1):
            for (a, _), c in pairs[h, t].items():
                after[a] += c
        left = {p: max(of(pairs, p, t) - d, 0) for p in own_pairs}
        held = Counter()
        for (a, _), c in left.items():
            held[a] += c
        back = {a: max(1 - held[a] / after[a], 1e-6) if after[a] else 1.0 for a in [*ids, "<start>"]}
        models[t] = (word, left, after, back)

    def difference(own):
        if not own:
            return math.log(models[1][0][""] / models[0][0][""])
        at, sums = "<start>", 0.0
        for w in (w if w in known else "" for w in own):
            likely = []
            for t in (0, 1):
                word, left, after, back = models[t]
                held = left[at, w] / after[at] if (at, w) in own_pairs and after[at] else 0.0
                likely.append(held + back[at] * word[w])
            sums += math.log(likely[1] / likely[0])
            at = w
        return sums / len(own)

    return difference, own_words, own_pairs


def test_toxicity_differences_equal_the_plain_model(spark):
    rng = random.Random(12)
    def letters(i):
        return chr(97 + i // 26) + chr(97 + i % 26)

    common = [f"w{letters(i)}" for i in range(60)]
    docs, labels = [], []
    for i in range(400):
        words = rng.choices(common, k=rng.randint(5, 40))
        toxic = int(rng.random() < 0.3)
        if toxic:
            for _ in range(rng.randint(1, 3)):
                at = rng.randint(0, len(words))
                words[at:at] = rng.choice([["vile"], ["you", "scum"], ["scum"], ["vile", "scum"]])
        docs.append((i, " ".join(words) + rng.choice(["", f" once{letters(i)}"])))
        labels.append((i, 1, toxic))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    held = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(spark, frame, held)
    train = [
        (text.split(), int(plain.remainder(i, 3) == 2), toxic)
        for (i, text), (_, _, toxic) in zip(docs, labels) if plain.remainder(i, 3) != 1
    ]
    difference, own_words, own_pairs = plain_toxicity(train)
    assert {"vile", "scum"} <= own_words and own_pairs
    for text in [t for _, t in docs] + ["", "never seen", "vile", "you scum vile scum", "scum you"]:
        assert model.difference(text) == pytest.approx(difference(text.split()), abs=1e-4)
    out = [(t, y) for (i, t), (_, _, y) in zip(docs, labels) if plain.remainder(i, 3) == 1]
    right = sum((model.score(t) >= 0.7) == bool(y) for t, y in out)
    assert right > 0.97 * len(out)


def test_fingerprints_tell_small_changes_from_other_texts():
    data = b"the quick brown fox jumps over the lazy dog, again and again and again"
    row = fingerprint.digests([data])[0]
    same, other = fingerprint.digests([data[:-1] + b"x", bytes(range(256))])
    near, far = (float(fingerprint.likeness(row[None], x[None])[0]) for x in (same, other))
    assert near > 0.9 > far
