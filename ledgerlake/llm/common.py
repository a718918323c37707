"""Shared pieces: table access, grouping rows inside a task, connected components."""

import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlake.session import materialize

# Members of one bucket that one task compares at once; larger buckets are split.
BLOCK_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Installed packages and ``--py-files`` need nothing; this serves a session that
    was started without the repository on its path.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, root)))


def bound_batches(spark: SparkSession, rows: int = 250, size: str = "2m") -> None:
    """Let the session send at most so many rows and bytes to Python at a time.

    A session with its defaults sends 10,000 whole texts, and a worker keeps the memory
    of its largest batch while later stages run. A smaller setting stays as it is.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def wide_hash(*columns: Column) -> list[Column]:
    """Two 64-bit hashes under different seeds: 128 bits, collisions are negligible."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)]


def fold(doc_id: Column, parts: int) -> Column:
    """The part a document belongs to: crc32 of its id as text, modulo ``parts``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the rows named by ``gone(doc_id, version)``; all columns as given.

    ``version`` is ``xxhash64`` of the text. Null ids and null texts match as well. Only
    names are gathered in ``gone``; the documents move once.
    """
    names = gone.select(F.struct("doc_id", "version").alias("owner")).distinct()
    rows = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"))
    key = F.struct(F.col("row.doc_id").alias("doc_id"), F.xxhash64("row.text").alias("version"))
    return rows.join(names, key.eqNullSafe(F.col("owner")), "left_anti").select("row.*")


def bucket_sizes(members: DataFrame, bucket: str) -> DataFrame:
    """``(bucket, bucket_size)`` of the buckets with two members or more.

    A stored table: joined back to the members, both sides are shuffled as they are and
    Spark can split a hot bucket.
    """
    counted = members.groupBy(bucket).agg(F.count("*").alias("bucket_size"))
    return materialize(counted.where(F.col("bucket_size") > 1), "bucket-sizes")


def blocks_of(
    members: DataFrame, sizes: DataFrame, bucket: str, member: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Rows of the buckets named by ``sizes``, dealt into bounded comparison groups.

    A bucket above ``block_rows`` is cut into blocks by a hash of the member, and every two
    blocks meet in a group of their own, so each pair of the bucket meets in exactly one
    group and no group exceeds about two blocks. A member is repeated once per block of its
    bucket. Adds ``block`` and the group's ``left_block`` and ``right_block``.
    """
    blocks = F.ceil(F.col("bucket_size") / F.lit(block_rows)).cast("int")
    sized = members.join(sizes, bucket).withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64(F.lit("block"), F.col(member)), F.col("blocks")).cast("int")
    )
    # Once per partner block; the partner of a block is also itself.
    return (
        sized.withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("left_block", F.least("block", "partner"))
        .withColumn("right_block", F.greatest("block", "partner"))
        .drop("partner", "bucket_size", "blocks")
    )


def in_blocks(
    members: DataFrame, bucket: str, member: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """All buckets of ``members`` by :func:`blocks_of`; rows of singleton buckets go.

    ``members`` has one row per bucket and member and is read twice: pass a stored table.
    """
    return blocks_of(members, bucket_sizes(members, bucket), bucket, member, block_rows)


def dealt(groups: DataFrame, bucket: str) -> DataFrame:
    """Each comparison group contiguous inside one partition, for :func:`groups_of`."""
    keys = [bucket, "left_block", "right_block"]
    return groups.repartition(*keys).sortWithinPartitions(*keys)


def groups_of(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str]
) -> Iterator[pa.Table]:
    """Cut a stream of batches, sorted by integer ``keys``, into one table per group.

    Holds one batch and the group it ends in.
    """
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows]).combine_chunks()
        change = np.zeros(rows.num_rows - 1, bool)
        for key in keys:
            values = rows.column(key).to_numpy()
            change |= values[1:] != values[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for start, stop in zip(cuts, cuts[1:]):
            if stop - start > 1:
                yield rows.slice(start, stop - start)
        rest = rows.slice(cuts[-1])
    if rest is not None and rest.num_rows > 1:
        yield rest


def local_roots(linked: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each row of a symmetric boolean matrix."""
    size = len(linked)
    roots = np.arange(size)
    while True:
        best = np.minimum(np.where(linked, roots[None, :], size).min(axis=1), roots)
        best = best[best]
        if np.array_equal(best, roots):
            return roots
        roots = best


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``(node, root)``, root the smallest node.

    Alternates two star steps until the edge set stays the same, a number of rounds
    that grows with the logarithm of the longest chain. Large star: every larger
    neighbour of a node moves to the node's smallest neighbour. Small star: the node
    itself and its smaller neighbours move to the smallest. Minima are combined before
    their shuffle and stored, so that the join that hands them back shuffles both sides
    and Spark can split a hub; the side of the minima has one row per node. Each round is a stored table: no lineage grows
    and a lost executor costs at most one round. Nodes without an edge are absent.
    """
    current = materialize(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b").distinct(), "edges",
    )
    state = _fingerprint(current)
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = materialize(both.groupBy("a").agg(F.min("b").alias("m")), "smallest")
        large = (
            both.join(smallest, "a").where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        )
        large = materialize(large, "large-star")
        smallest = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "smallest")
        moved = large.join(smallest, "a").where("b <> m").select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
        current = materialize(
            moved.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct(),
            "small-star",
        )
        before, state = state, _fingerprint(current)
        if state == before:
            break
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)
