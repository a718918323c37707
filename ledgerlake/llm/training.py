"""Fitting a text model on a bounded sample of labelled rows, in parts that are averaged."""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.common import fold, workers_import
from ledgerlake.session import materialize

# Labelled documents of one class that a model is fitted on: the documented bound.
PER_CLASS = 4000
# Most targets of a model, since each is a part of the sample of its own.
MAX_CLASSES = 64
# Documents that learn together; with two or three classes there are at most 12 parts.
PART_DOCS = 1000
FOLDS = 5
# In each round a part takes this many steps, each over a batch of its documents.
STEPS = 120
BATCH = 32

Learner = Callable[[list[str], np.ndarray, np.ndarray], np.ndarray]


def held_out() -> Column:
    """Rows that no model learns from: checksum of the id divisible by ``FOLDS``."""
    return F.coalesce(fold(F.col("doc_id"), FOLDS) == 0, F.lit(False))


def labelled_sample(docs: DataFrame, targets: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``(doc_id, text, target, part)``: at most ``per_class`` documents of each target.

    ``targets(doc_id, target)`` may repeat ids (the largest target counts), hold nulls
    or ids without a document (ignored). The choice follows a hash of the id, so it is
    the same in every run. Only the chosen ids, whose number is bounded, are broadcast.
    More than ``MAX_CLASSES`` different targets are an error.
    """
    known = (
        targets.where("doc_id is not null and target is not null")
        .where(fold(F.col("doc_id"), FOLDS) != 0)
        .groupBy("doc_id").agg(F.max("target").alias("target"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    )
    known = materialize(known, "targets")
    classes = [
        row.target
        for row in known.select("target").distinct().orderBy("target").limit(MAX_CLASSES + 1).collect()
    ]
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} different targets")
    chosen = None
    for target in classes:
        part = known.where(F.col("target") == target).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        chosen = known
    sample = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id").agg(
            F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("target").alias("target")
        )
    )
    sample = materialize(sample, "sample")
    parts = max(1, -(-sample.count() // PART_DOCS))
    return sample.withColumn(
        "part", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(parts)).cast("int")
    )


def batches(size: int, seed: int) -> Iterator[np.ndarray]:
    """``STEPS`` batches of row numbers: shuffled passes, as many as that takes."""
    draw = np.random.default_rng(seed)
    order = np.concatenate([draw.permutation(size) for _ in range(-(-STEPS * BATCH // size))])
    yield from np.split(order[: STEPS * BATCH], STEPS)


def fit(sample: DataFrame, start: np.ndarray, learn: Learner, rounds: int) -> np.ndarray:
    """Parameters after ``rounds`` of parallel learning from ``start``.

    In each round every part learns from the common parameters on its own documents,
    in order of their ids, and the results are averaged by number of documents. A part
    has at most a few thousand documents, since the sample is bounded. Each task
    depends on its part and the common parameters only, so it can run again anywhere.
    An empty sample leaves the start as it is.
    """
    spark = sample.sparkSession
    workers_import(spark)
    parameters = start.astype(np.float64)
    for _ in range(rounds):
        step = _step(learn, spark.sparkContext.broadcast(parameters))
        parts = sample.groupBy("part").applyInPandas(step, "docs long, learned binary").collect()
        if not parts:
            break
        total = sum(part.docs for part in parts)
        parameters = sum(
            np.frombuffer(part.learned, np.float32).astype(np.float64) * (part.docs / total)
            for part in sorted(parts, key=lambda part: (part.docs, part.learned))
        )
    return parameters


def _step(learn: Learner, common: Broadcast) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def step(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        learned = learn(rows["text"].tolist(), rows["target"].to_numpy(), common.value.copy())
        return pd.DataFrame({
            "docs": [len(rows)], "learned": [learned.astype(np.float32).tobytes()],
        })

    return step


def gram_slots(codes: np.ndarray, orders: tuple[int, ...], bits: int) -> list[np.ndarray]:
    """For each order, the hash slot of the n-gram that starts at each character."""
    codes = codes.astype(np.uint64)
    found, rolled = [], np.zeros(len(codes), np.uint64)
    for order in range(1, max(orders) + 1):
        if len(codes) < order:
            break
        rolled = rolled[: len(codes) - order + 1] * np.uint64(0x100000001B3) + codes[order - 1:]
        if order in orders:
            mixed = (rolled + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
            found.append((mixed >> np.uint64(64 - bits)).astype(np.int64))
    return found


def characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
