"""The models against plain versions: likelihoods by loops, gradients by differences."""

import math
import re
import zlib
from collections import Counter
from itertools import groupby

import numpy as np
import pytest

from ledgerlake.llm import language, quality, toxicity, training

TEXTS = [
    "You are a fool. Go away!", "", "A calm day\nin the harbour, a calm sea", "fool fool fool", "...", "Été  à la plage",
    "the the end end", "Was für ein Tag? Ein guter", "x",
]


def slot(gram: str, bits: int) -> int:
    rolled = 0
    for letter in gram:
        rolled = (rolled * 0x100000001B3 + ord(letter)) % 2**64
    return (rolled + len(gram)) * 0x9E3779B97F4A7C15 % 2**64 >> (64 - bits)


def grams(text: str, orders, bits: int) -> list[int]:
    return [slot(text[at:at + n], bits) for n in orders for at in range(len(text) - n + 1)]


def sigmoid(value: float) -> float:
    return 1 / (1 + math.exp(-value))


def step_gradient(module, monkeypatch, texts, targets, weights) -> np.ndarray:
    """The gradient of one step over all texts, from the change that AdaGrad makes of it."""
    monkeypatch.setattr(module, "batches", lambda size, seed: iter([np.arange(size)]))
    moved = (weights - module.learn(texts, np.array(targets), weights.copy())) / module.RATE
    return 0.1 * moved / np.sqrt(1 - moved * moved)


def check_gradient(loss, weights, found, places):
    for place in places:
        up, down = weights.copy(), weights.copy()
        up[place] += 1e-5
        down[place] -= 1e-5
        assert found[place] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=1e-3, abs=1e-6)
    others = np.ones(len(weights), bool)
    others[places] = False
    assert not found[others].any()


def quality_row(text: str) -> dict[int, float]:
    counts = Counter(grams(f" {text} ", quality.ORDERS, quality.BITS))
    words = text.split()
    again = sum(a == b for a, b in zip(words, words[1:]))
    if again:
        counts[quality.REPEATED] += again
    length = math.sqrt(sum(counts.values()))
    return {place: math.sqrt(n) / length for place, n in counts.items()}


def quality_tails(text: str, weights: np.ndarray) -> list[float]:
    z = sum(weights[place] * value for place, value in quality_row(text).items())
    first, step = weights[1 << quality.BITS:]
    return [sigmoid(z - first), sigmoid(z - first - math.exp(step))]


def test_quality_gradient_and_grades(monkeypatch):
    targets = [0, 1, 2, 0, 1, 2, 0, 2, 1]
    places = sorted({place for text in TEXTS for place in quality_row(text)})
    places += [1 << quality.BITS, (1 << quality.BITS) + 1]
    weights = np.zeros((1 << quality.BITS) + 2)
    weights[places] = np.random.default_rng(1).normal(size=len(places))

    def loss(now):
        total = 0.0
        for text, target in zip(TEXTS, targets):
            above = [1.0, *quality_tails(text, now), 0.0]
            total -= math.log(above[target] - above[target + 1])
        return total / len(TEXTS) + quality.DECAY / 2 * (now[: 1 << quality.BITS] ** 2).sum()

    found = step_gradient(quality, monkeypatch, TEXTS, targets, weights)
    check_gradient(loss, weights, found, places)
    cuts = quality.thresholds(weights)
    assert cuts[0] < cuts[1]
    for text in TEXTS:
        expected, tails = quality.grade(text, weights[: 1 << quality.BITS], cuts)
        assert tails == pytest.approx(quality_tails(text, weights))
        # The mean of the grades 0, 1, 2 under their own probabilities.
        assert expected == pytest.approx((tails[0] - tails[1]) + 2 * tails[1])
    assert quality.grade(None, weights[: 1 << quality.BITS], cuts) == quality.grade("", weights[: 1 << quality.BITS], cuts)


def toxic_sentences(text: str) -> list[list[int]]:
    """Slots of the word beginnings of each sentence."""
    found = []
    for sentence in re.split(r"[.!?\n]", text.lower()):
        words = ["".join(run) for is_word, run in groupby(sentence, str.isalpha) if is_word]
        found.append([
            slot(f"{word} "[:n], toxicity.BITS) for word in words for n in toxicity.ORDERS if n <= len(word) + 1
        ])
    return found


def plain_toxicity(text: str, weights: np.ndarray) -> float:
    clean = 1.0
    for slots in toxic_sentences(text):
        clean *= 1 - sigmoid(weights[-1] + sum(weights[place] for place in slots))
    return 1 - clean


def test_toxicity_gradient_and_scores(monkeypatch):
    targets = [1, 0, 0, 1, 0, 1, 1, 0, 1]
    places = sorted({place for text in TEXTS for slots in toxic_sentences(text) for place in slots})
    places.append(1 << toxicity.BITS)
    weights = np.zeros((1 << toxicity.BITS) + 1)
    weights[places] = np.random.default_rng(2).normal(size=len(places))

    def loss(now):
        chances = [plain_toxicity(text, now) for text in TEXTS]
        total = -sum(math.log(p if target else 1 - p) for p, target in zip(chances, targets))
        return total / len(TEXTS) + toxicity.DECAY / 2 * (now[:-1] ** 2).sum()

    found = step_gradient(toxicity, monkeypatch, TEXTS, targets, weights)
    check_gradient(loss, weights, found, places)
    for text in TEXTS:
        score, offending = toxicity.judge(text, weights)
        assert score == pytest.approx(plain_toxicity(text, weights) if text else 0.0)
        alone = [plain_toxicity(text[one["start"]:one["end"]].rstrip(".!?\n"), weights) for one in offending]
        assert [one["score"] for one in offending] == pytest.approx(alone)
        assert bool(offending) == (score >= 0.5)


def test_start_weights_are_log_odds():
    texts, targets = ["bad word"] * 3 + ["good word"] * 5, np.array([1] * 3 + [0] * 5)
    odds = toxicity._log_odds([toxicity.bag(text) for text in texts], targets, 1 << toxicity.BITS)
    added = toxicity.ADDED
    want = math.log((3 + added) / (3 + 2 * added)) - math.log(added / (5 + 2 * added))
    assert odds[slot("bad", toxicity.BITS)] == pytest.approx(want)
    assert odds[slot("goo", toxicity.BITS)] == 0
    both = math.log((3 + added) / (3 + 2 * added)) - math.log((5 + added) / (5 + 2 * added))
    assert odds[slot("wor", toxicity.BITS)] == pytest.approx(max(both, 0))


def test_language_equals_counting_naive_bayes(spark):
    known = [
        ("en", "the sea is calm and the day is long"), ("en", "a harbour of the north"), ("de", "das Meer ist ruhig und der Tag ist lang"),
        ("de", "ein Hafen im Norden"), ("fr", "la mer est calme et le jour est long"), (None, "no language"), ("fr", None), ("xx", ""),
    ]
    rows = [(n, text, lang) for n, (lang, text) in enumerate(known * 4)] + [(100 + n, text, "en") for n, text in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts: dict[str, Counter] = {}
    for doc_id, text, lang in rows:
        if zlib.crc32(str(doc_id).encode()) % 3 != 1 and lang is not None and text is not None:
            counts.setdefault(lang, Counter()).update(grams(f" {text.lower()} ", language.ORDERS, 15))

    def plain(text):
        if text is None or not any(map(str.isalpha, text)):
            return "und", 0.0
        found = {}
        for lang, held in counts.items():
            total = sum(held.values()) + language.SMOOTHING * language.BUCKETS
            found[lang] = sum(
                math.log((held[place] + language.SMOOTHING) / total)
                for place in grams(f" {text.lower()} ", language.ORDERS, 15)
            )
        best = max(sorted(found), key=found.get)
        return best, 1 / sum(math.exp(value - found[best]) for value in found.values())

    got = {row.doc_id: row for row in language.identify(docs).collect()}
    assert len(got) == len(rows)
    for doc_id, text, _ in rows:
        lang, score = plain(text)
        assert got[doc_id].lang_pred == lang and got[doc_id].score == pytest.approx(score, rel=1e-6)
        assert got[doc_id].held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1)


def test_grades_and_targets_out_of_bounds_raise(spark):
    docs = spark.createDataFrame([(n, f"text {n}") for n in range(200)], "doc_id long, text string")
    rated = spark.createDataFrame([(1, 0), (2, 1), (3, 3)], "doc_id long, target int")
    with pytest.raises(Exception, match="grade outside 0 to 2: 3"):
        quality.score_quality(docs, rated).collect()
    halves = spark.createDataFrame([(1, 0.5)], "doc_id long, target double")
    with pytest.raises(Exception, match="grade outside 0 to 2: 0.5"):
        quality.score_quality(docs, halves).collect()
    targets = docs.selectExpr("doc_id", "cast(doc_id as int) as target")
    with pytest.raises(ValueError, match="more than 64"):
        training.labelled_sample(docs, targets)
