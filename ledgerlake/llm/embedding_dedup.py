"""Embedding near-dedup: p-stable Euclidean hashing, then exact cosines."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import (
    components, dealt, groups_of, in_blocks, local_roots, wide_hash, workers_import,
)
from ledgerlake.session import materialize

MIN_COSINE = 0.98
# Unit vectors at cosine 0.98 are 0.2 apart. One projection of that distance stays in a
# bucket of width 1.6 with probability 0.90, so 12 of them agree with 0.28 and at least
# one of 24 tables holds the pair with 0.9996; closer pairs are found more surely.
# Unrelated vectors (distance 1.4) share a bucket with about 2e-5.
WIDTH = 1.6
PROJECTIONS = 12
TABLES = 24
SEED = 17


def _planes(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Gaussian (2-stable) directions and offsets; the same on every worker."""
    draw = np.random.default_rng((SEED, size))
    return (
        draw.standard_normal((size, TABLES * PROJECTIONS)),
        draw.uniform(0, WIDTH, TABLES * PROJECTIONS),
    )


def _buckets(vectors: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """One 64-bit bucket per vector and table, label and length included."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    directions, offsets = _planes(vectors.shape[1])
    cells = np.floor((unit @ directions + offsets) / WIDTH).astype(np.int64)
    cells = cells.reshape(len(vectors), TABLES, PROJECTIONS).view(np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    mixed = np.arange(1, TABLES + 1, dtype=np.uint64)[None, :] * factor
    mixed = mixed ^ (labels.astype(np.uint64)[:, None] * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = mixed + np.uint64(vectors.shape[1])
    for at in range(PROJECTIONS):
        mixed = (mixed ^ cells[:, :, at]) * factor
        mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column("vector")
        sizes = np.asarray(vectors.value_lengths())
        for size in np.unique(sizes):
            rows = batch.filter(pa.array(sizes == size))
            values = rows.column("vector").flatten().to_numpy(zero_copy_only=False)
            labels = rows.column("label").to_numpy(zero_copy_only=False)
            found = _buckets(values.reshape(-1, size).astype(np.float64), labels)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.FixedSizeListArray.from_arrays(
                    pa.array(found.ravel()), TABLES).cast(pa.list_(pa.int64()))],
                [*rows.schema.names, "buckets"],
            )


def _matrix(group: pa.Table, name: str, kind: type) -> np.ndarray:
    column = group.column(name).combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(kind)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact cosines in each group; partner weight and one edge per linked class.

    A pair that shares several buckets counts in the first of its tables only.
    """
    for group in groups_of(batches, ("bucket", "left_block", "right_block")):
        if pa.compute.count_distinct(group.column("dims")).as_py() > 1:
            continue  # a hash collision between lengths, never a link
        vectors = _matrix(group, "vector", np.float64)
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        linked = (vectors @ vectors.T) / (norms[:, None] * norms[None, :]) >= MIN_COSINE
        np.fill_diagonal(linked, False)
        labels = group.column("label").to_numpy()
        linked &= labels[:, None] == labels[None, :]
        block = group.column("block").to_numpy()
        if group.column("left_block")[0].as_py() != group.column("right_block")[0].as_py():
            linked &= block[:, None] != block[None, :]
        first, second = np.nonzero(linked)
        if not len(first):
            continue
        buckets = _matrix(group, "buckets", np.int64)
        this = group.column("table").to_numpy()
        # Pair by pair in slices, so a full group needs little memory.
        for start in range(0, len(first), 1 << 16):
            a, b = first[start:start + (1 << 16)], second[start:start + (1 << 16)]
            earliest = (buckets[a] == buckets[b]).argmax(axis=1)
            late = earliest != this[a]
            linked[a[late], b[late]] = False
        weight = group.column("weight").to_numpy().astype(np.float64)
        links = (linked @ weight).astype(np.int64)
        roots = local_roots(linked)
        rows = np.flatnonzero(linked.any(axis=1))
        if len(rows):
            names = group.column("class").combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(rows)), pa.array(links[rows]),
                 names.take(pa.array(roots[rows]))],
                ["class", "links", "root"],
            )


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """One row per vector row: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Vectors link if their labels are equal and not null and their cosine, in double
    precision, is at least 0.98. ``n_links`` counts the other rows linked directly,
    copies included; ``component_id`` is the smallest vec_id reachable.

    Vectors that are null, empty, zero or hold a null or non-finite component, rows
    without label and rows without vec_id link with nothing and are their own component.
    Vectors of different length never link. Equal vectors under one label collapse to
    a weighted class first, so copies cost nothing. Other columns are not looked at.
    """
    workers_import(vectors.sparkSession)
    value = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (
        F.col("embedding").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
        & finite & F.exists(value, lambda x: x != 0)
    )
    # Adding zero makes -0.0 equal to 0.0 before the hash.
    plain = F.transform(value, lambda x: x + F.lit(0.0))
    h1, h2 = wide_hash(F.col("label"), F.col("vector"))
    rows = vectors.select(
        "vec_id", F.col("label").cast("long").alias("label"),
        F.when(F.coalesce(usable, F.lit(False)), plain).alias("vector"),
    ).withColumn(
        "class", F.when(F.col("vector").isNotNull(), F.concat(F.lpad(F.hex(h1), 16, "0"), F.lpad(F.hex(h2), 16, "0")))
    )
    rows = materialize(rows, "vectors")
    classes = rows.where("class is not null").groupBy("class").agg(
        F.min("vec_id").alias("smallest"), F.count("*").alias("weight"),
        F.any_value("label").alias("label"), F.any_value("vector").alias("vector"),
    )
    schema = "class string, smallest long, weight long, label long, vector array<double>, buckets array<long>"
    hashed = materialize(classes.mapInArrow(_hash, schema), "buckets")
    members = materialize(
        hashed.select("class", F.posexplode("buckets").alias("table", "bucket")), "members"
    )
    groups = in_blocks(members, "bucket", "class").join(
        hashed.select("class", "label", "weight", "vector", "buckets", F.size("vector").alias("dims")),
        "class",
    )
    found = materialize(
        dealt(groups, "bucket").mapInArrow(_verify, "class string, links long, root string"),
        "links",
    )
    linked = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    counted = found.groupBy("class").agg(F.sum("links").alias("links"))
    rooted = (
        hashed.select("class", "smallest", "weight").join(counted, "class", "left")
        .join(linked.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    # Stored, so that both sides of the join below are shuffled and Spark can split a hub.
    owner = materialize(rooted.groupBy("root").agg(F.min("smallest").alias("component_id")), "owners")
    named = materialize(
        rooted.join(owner, "root").select(
            "class", "component_id",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        ), "components",
    )
    joined = rows.select("vec_id", "class").join(named, "class", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
