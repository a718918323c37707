"""Quality classifier: ordinal cumulative-link regression on graded ratings."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import workers_import
from ledgerlake.llm.training import (
    PER_CLASS, batches, characters, fit, gram_slots, held_out, labelled_sample,
)

ORDERS = (1, 2, 3)
BITS = 16
GRADES = 3
REPEATED = 0
ROUNDS = 6
RATE = 0.5
DECAY = 1e-5


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the character n-grams, case and marks included, in a vector of length 1.

    Words that repeat the word before count under a slot of their own.
    """
    found = gram_slots(characters(f" {text} "), ORDERS, BITS)
    words = text.split()
    again = sum(map(str.__eq__, words, words[1:]))
    found.append(np.full(again, REPEATED))
    slots, times = np.unique(np.concatenate(found), return_counts=True)
    # Damped counts, so that a text's length does not drown its rarer marks.
    values = np.sqrt(times)
    return slots, values / np.sqrt((values * values).sum())


def _sigmoid(values: np.ndarray | float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -40, 40)))


def thresholds(parameters: np.ndarray) -> np.ndarray:
    """Ascending thresholds: a first one, then positive steps."""
    steps = parameters[1 << BITS:]
    return np.cumsum(np.concatenate((steps[:1], np.exp(steps[1:]))))


def learn(texts: list[str], targets: np.ndarray, parameters: np.ndarray) -> np.ndarray:
    """A round of AdaGrad on ``P(grade >= k) = sigmoid(w x - threshold k)``."""
    rows = [features(text) for text in texts]
    squares = np.full(len(parameters), 1e-2)
    size = 1 << BITS
    for batch in batches(len(texts), 7):
        gradient = np.zeros(len(parameters))
        cuts = thresholds(parameters)
        for at in batch:
            slots, values = rows[at]
            z = float(parameters[slots] @ values)
            grade = int(targets[at])
            low = float(_sigmoid(z - cuts[grade - 1])) if grade else 1.0
            high = float(_sigmoid(z - cuts[grade])) if grade < GRADES - 1 else 0.0
            chance = max(low - high, 1e-9)
            slope_low, slope_high = low * (1 - low) / chance, high * (1 - high) / chance
            gradient[slots] -= (slope_low - slope_high) * values
            by_cut = np.zeros(GRADES - 1)
            if grade:
                by_cut[grade - 1] += slope_low
            if grade < GRADES - 1:
                by_cut[grade] -= slope_high
            # A step moves its own threshold and all above.
            tail = np.cumsum(by_cut[::-1])[::-1]
            gradient[size] += tail[0]
            gradient[size + 1:] += tail[1:] * np.exp(parameters[size + 1:])
        gradient /= len(batch)
        gradient[:size] += DECAY * parameters[:size]
        squares += gradient * gradient
        parameters -= RATE * gradient / np.sqrt(squares)
    return parameters


def ratings(labels: DataFrame) -> DataFrame:
    """Graded ratings from the given labels: 0 poor, 1 good but toxic, 2 good and clean."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("target"))


def checked(rated: DataFrame) -> DataFrame:
    """``rated``, where a grade that is no whole number from 0 to 2 raises an error."""
    grade = F.col("target")
    known = grade.isNull() | grade.isin(list(range(GRADES)))
    return rated.select("doc_id", F.when(known, grade).otherwise(
        F.raise_error(F.concat(F.lit("grade outside 0 to 2: "), grade.cast("string")))
    ).cast("int").alias("target"))


def train(docs: DataFrame, rated: DataFrame, per_class: int = PER_CLASS) -> np.ndarray:
    sample = labelled_sample(docs, checked(rated), per_class)
    start = np.zeros((1 << BITS) + GRADES - 1)
    start[1 << BITS] = -0.5
    return fit(sample, start, learn, ROUNDS)


def grade(text: str | None, weights: np.ndarray, cuts: np.ndarray) -> tuple[float, list[float]]:
    """Expected grade and ``P(grade >= k)`` for k = 1, 2, ..."""
    slots, values = features(text or "")
    tails = _sigmoid(float(weights[slots] @ values) - cuts)
    return float(tails.sum()), tails.tolist()


def score_quality(
    docs: DataFrame, rated: DataFrame, min_grade: int = 1, min_tail: float = 0.5,
    per_class: int = PER_CLASS,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``expected_grade``, ``tails`` and ``kept`` of each row.

    ``tails[k - 1]`` is P(grade >= k); a row is kept if that of ``min_grade`` is at least
    ``min_tail``. ``rated(doc_id, target)`` holds grades from 0 to 2, any other
    raises an error and null is ignored; rows whose id's checksum is divisible by 5, and null ids, are not learned from. Null text reads as
    empty text. Without ratings the scores come from the start values. Equal texts get
    equal results; texts are read whole. Other columns are not looked at.
    """
    rows = docs.select("doc_id", "text")
    spark = docs.sparkSession
    workers_import(spark)
    fitted = train(rows, rated, per_class)
    model = spark.sparkContext.broadcast((fitted[: 1 << BITS], thresholds(fitted)))

    @F.pandas_udf("expected double, tails array<double>")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([grade(text, *model.value) for text in texts], columns=["expected", "tails"])

    return rows.select("doc_id", held_out().alias("held_out"), run("text").alias("r")).select(
        "doc_id", "held_out", F.col("r.expected").alias("expected_grade"), F.col("r.tails").alias("tails"),
        (F.get("r.tails", F.lit(min_grade - 1)) >= min_tail).alias("kept"),
    )
