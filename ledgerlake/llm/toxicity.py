"""Toxicity: sentence scores, joined by noisy-or and trained from document labels."""

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import workers_import
from ledgerlake.llm.training import (
    PER_CLASS, batches, characters, fit, gram_slots, held_out, labelled_sample,
)

# Lengths of the word beginnings that count, the blank after a short word included.
ORDERS = (3, 4, 5, 6, 7, 8)
BITS = 18
ROUNDS = 6
RATE = 0.1
DECAY = 1e-4
# Log-odds to start from: added counts, and toxic documents a word beginning must be in.
ADDED = 4.0
MIN_TOXIC = 3
# A sentence nobody complains of starts at one in 400.
START_BIAS = -6.0
STOPS = np.array([ord(mark) for mark in ".!?\n"], np.uint32)
BLANK = ord(" ")


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(code).isalpha() for code in range(0x110000)), bool, 0x110000)


def _lower(text: str) -> str:
    """Lower case with as many characters as before, so positions stay."""
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(one if len(one.lower()) != 1 else one.lower() for one in text)


def bag(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of the word beginnings, the sentence each is in, and where sentences start.

    All but letters read as blanks. A sentence ends after a stop or a line end; a word
    belongs to the sentence it starts in.
    """
    codes = characters(_lower(f"{text} "))
    ends = np.flatnonzero(np.isin(codes, STOPS)) + 1
    starts = np.concatenate(([0], ends[ends < len(codes)]))
    letter = _letters()[codes]
    first = letter & ~np.concatenate(([False], letter[:-1]))
    begins = np.flatnonzero(first)
    # A word ends before the next blank; the last character is always one.
    lengths = np.flatnonzero(~letter & np.concatenate(([False], letter[:-1]))) - begins
    home = np.searchsorted(starts, begins, side="right") - 1
    slots, sentences = [], []
    for order, own in zip(ORDERS, gram_slots(np.where(letter, codes, BLANK), ORDERS, BITS)):
        long = lengths + 1 >= order
        slots.append(own[begins[long]])
        sentences.append(home[long])
    if not slots:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), starts
    return np.concatenate(slots), np.concatenate(sentences), starts


def sentence_logits(
    slots: np.ndarray, sentences: np.ndarray, starts: np.ndarray, weights: np.ndarray
) -> np.ndarray:
    """Bias plus the weights of each sentence's word beginnings; the bias comes last."""
    return np.bincount(sentences, weights[slots], minlength=len(starts)) + weights[-1]


def _softplus(values: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, values)


def _log_odds(bags: list, targets: np.ndarray, size: int) -> np.ndarray:
    """Weights to start from: how much likelier toxic documents hold a word beginning."""
    held = np.zeros((2, size))
    for (slots, _, _), target in zip(bags, targets):
        held[int(target > 0)][np.unique(slots)] += 1
    number = np.array([(targets <= 0).sum(), (targets > 0).sum()])
    clean, toxic = np.log((held + ADDED) / (number[:, None] + 2 * ADDED))
    return np.where(held[1] >= MIN_TOXIC, np.maximum(toxic - clean, 0), 0)


def learn(texts: list[str], targets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A round of AdaGrad on the noisy-or likelihood.

    A document is clean if every sentence is: ``log P(clean) = -sum softplus(z)``. The
    gradient by a sentence's logit is its probability, for toxic documents times
    ``-P(clean) / P(toxic)``: only sentences that explain the label are raised.
    """
    bags = [bag(text) for text in texts]
    if not weights[:-1].any():
        weights[:-1] = _log_odds(bags, targets, len(weights) - 1)
    squares = np.full(len(weights), 1e-2)
    for batch in batches(len(texts), 11):
        slots, pulls, bias = [], [], 0.0
        for at in batch:
            own, sentences, starts = bags[at]
            z = sentence_logits(own, sentences, starts, weights)
            alarm = _softplus(z).sum()
            share = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            pull = share if not targets[at] else -share / np.expm1(np.clip(alarm, 1e-9, 40))
            bias += pull.sum()
            slots.append(own)
            pulls.append(pull[sentences])
        gradient = np.bincount(
            np.concatenate(slots), np.concatenate(pulls), minlength=len(weights)
        )
        gradient[-1] += bias
        gradient /= len(batch)
        gradient[:-1] += DECAY * weights[:-1]
        squares += gradient * gradient
        weights -= RATE * gradient / np.sqrt(squares)
    return weights


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> np.ndarray:
    """Weights learned from at most ``per_class`` toxic and clean documents each."""
    sample = labelled_sample(docs, labels.select("doc_id", F.col("toxic").alias("target")), per_class)
    start = np.zeros((1 << BITS) + 1)
    start[-1] = START_BIAS
    return fit(sample, start, learn, ROUNDS)


def judge(text: str | None, weights: np.ndarray) -> tuple[float, list[dict]]:
    """Score of a whole text and its offending sentences: start, end (exclusive), score.

    Sentences at 0.5 or more offend; if only their sum does, the worst one is named.
    """
    if not text:
        return 0.0, []
    slots, sentences, starts = bag(text)
    z = sentence_logits(slots, sentences, starts, weights)
    score = float(-np.expm1(-_softplus(z).sum()))
    if score < 0.5:
        return score, []
    share = 1 / (1 + np.exp(-z))
    bad = np.flatnonzero(share >= 0.5)
    ends = np.minimum(np.concatenate((starts[1:], [len(text)])), len(text))
    return score, [
        {"start": int(starts[at]), "end": int(ends[at]), "score": float(share[at])}
        for at in (bad if len(bad) else [int(share.argmax())])
    ]


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and ``offending`` of each row.

    Learns from rows whose id's checksum is not divisible by 5 only; a null id is never
    learned from. Null and empty texts score 0. Without usable labels the scores come
    from the start values. Equal texts get equal scores; texts are read whole. Columns
    other than ``doc_id`` and ``text`` (``toxic`` for labels) are not looked at.
    """
    rows = docs.select("doc_id", "text")
    spark = docs.sparkSession
    workers_import(spark)
    model = spark.sparkContext.broadcast(train(rows, labels, per_class).astype(np.float32))

    @F.pandas_udf("score double, offending array<struct<start:int,end:int,score:double>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judge(text, model.value) for text in texts], columns=["score", "offending"])

    return rows.select("doc_id", held_out().alias("held_out"), run("text").alias("r")).select(
        "doc_id", "held_out", F.col("r.score").alias("score"),
        (F.col("r.score") >= 0.5).cast("int").alias("predicted"), F.col("r.offending").alias("offending"),
    )
