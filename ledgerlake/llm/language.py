"""Language ID: multinomial naive Bayes over hashed character n-grams."""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.common import fold, workers_import
from ledgerlake.session import materialize

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
SMOOTHING = 0.5
UNKNOWN = "und"
# The learned matrix goes to every worker: languages x BUCKETS doubles, 0.25 MB each.
MAX_LANGUAGES = 400
# Documents are cut into pieces of this many characters while they are counted.
PIECE = 1 << 20


def gram_buckets(text: str) -> np.ndarray:
    """Hash bucket of every character n-gram of the whole text, spaces around it."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes.astype(np.uint64)
    parts = []
    rolled = np.zeros(len(codes), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        if len(codes) < order:
            break
        rolled = rolled[: len(codes) - order + 1] * np.uint64(0x100000001B3) + codes[order - 1:]
        if order in ORDERS:
            mixed = (rolled + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
            parts.append((mixed >> np.uint64(64 - 15)).astype(np.int64))
    return np.concatenate(parts)


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    total = np.zeros(BUCKETS, np.int64)
    for start in range(0, max(1, len(text)), PIECE):
        # Pieces overlap by the longest n-gram less one; the few doubled short n-grams
        # of very long texts fall the same way in training and prediction.
        piece = text[max(0, start - max(ORDERS) + 1):start + PIECE]
        total += np.bincount(gram_buckets(piece), minlength=BUCKETS)
    found = np.flatnonzero(total)
    return found, total[found]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def gram_counts(docs: DataFrame) -> DataFrame:
    """``(lang, bucket, n)`` over all rows of ``docs(text, lang)``."""
    workers_import(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang")):
                text, lang = text.as_py(), lang.as_py()
                if lang not in totals:
                    if len(totals) == MAX_LANGUAGES:
                        yield from emit(totals)
                        totals.clear()
                    totals[lang] = np.zeros(BUCKETS, np.int64)
                found, times = _counts(text)
                totals[lang][found] += times
        yield from emit(totals)

    def emit(totals: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, total in totals.items():
            found = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(total[found])],
                ["lang", "bucket", "n"],
            )

    return (
        docs.select("text", "lang").where("text is not null and lang is not null")
        .mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their log probability of each bucket, ``BUCKETS x languages``.

    Counts are summed per task, then over tasks, from all rows; only the finished
    table, at most ``MAX_LANGUAGES * BUCKETS`` numbers, comes to the driver. Languages
    are equally likely beforehand. No labelled row gives no languages.
    """
    counts = materialize(gram_counts(docs), "gram-counts")
    languages = [row.lang for row in counts.select("lang").distinct().orderBy("lang")
                 .limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    column = {lang: at for at, lang in enumerate(languages)}
    weights = np.full((BUCKETS, len(languages)), SMOOTHING)
    rows = counts.toPandas()
    np.add.at(weights, (rows["bucket"].to_numpy(int), rows["lang"].map(column).to_numpy(int)), rows["n"])
    return languages, np.log(weights / weights.sum(axis=0, keepdims=True))


def predict(text: str | None, languages: list[str], logs: np.ndarray) -> tuple[str, float]:
    """Most likely language and its posterior probability; ties go to the first name."""
    if text is None or not languages or not has_letter(text):
        return UNKNOWN, 0.0
    found, times = _counts(text)
    scores = times @ logs[found]
    best = int(scores.argmax())
    return languages[best], float(1 / np.exp(scores - scores[best]).sum())


def predictor(docs: DataFrame) -> Callable[[Column], Column]:
    """A column function ``text -> struct<lang, score>`` learned from ``docs(text, lang)``."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(train(docs))

    @F.pandas_udf("lang string, score double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        languages, logs = model.value
        return pd.DataFrame(
            [predict(text, languages, logs) for text in texts], columns=["lang", "score"]
        )

    # Else Spark may copy the call into each filter that reads its result.
    return guess.asNondeterministic()


def learning_rows(docs: DataFrame) -> DataFrame:
    """Rows to learn from: labelled, and not held out by the checksum of the id.

    A null id has no checksum; such rows are not learned from.
    """
    return docs.where(fold(F.col("doc_id"), 3) != 1)


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of each row.

    Null texts and texts without a letter are ``und`` with score 0, and so is every text
    if there is nothing to learn from. Long texts are read whole. Equal texts get equal
    results. Columns other than ``doc_id``, ``text`` and ``lang`` are not looked at.
    """
    rows = docs.select("doc_id", "text", "lang")
    guess = predictor(learning_rows(rows))
    return rows.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        guess("text").alias("p"),
    ).select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def keep_identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """``docs`` without rows of no known language or below ``min_score``; same columns."""
    guess = predictor(learning_rows(docs.select("doc_id", "text", "lang")))
    judged = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"), guess(F.col("text")).alias("p"))
    return judged.where((F.col("p.lang") != UNKNOWN) & (F.col("p.score") >= min_score)).select("row.*")
