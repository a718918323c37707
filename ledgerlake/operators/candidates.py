"""Candidate load per notice and portal, before and after bucket suppression.

Before suppression a bucket may hold a third of all notices, and its pairs are never
listed. The load there is the comparison work, each other notice of each bucket a notice is
in, counted from bucket sizes, and the exact number of distinct candidates, counted by
content classes as bits of blocks. After suppression pairs are few enough to be listed and
counted.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.operators.lsh import (
    BUCKET, BUCKET_CAP, hashed_classes, hashed_notices, pairs_within,
)
from ledgerlake.operators.percentiles import percentiles
from ledgerlake.operators.ranking import dense_numbers
from ledgerlake.operators.skew import HOT_ROWS, lookup_join, shared_rows, split_join
from ledgerlake.session import materialize

HOTTEST = 10
STAGES = ("before", "after")
# Classes are met in blocks of 2^12: a cell of two blocks is 2 MB of bits.
BLOCK_BITS = 12
# Cells of one bucket that a task makes: a cell holds up to 2^12 classes on either side.
TASK_CELLS = 10_000
# Sketches of 2^14 registers: a standard error of about 0.8 percent.
SKETCH_BITS = 14


def distinct_candidates(
    signatures: DataFrame, rows: int, bands: int, exact_work: int | None = None,
    sketch_bits: int = SKETCH_BITS, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Stored ``(notice_id, candidate_count, is_exact)`` with no bucket suppressed.

    Exact (:func:`distinct_of_hashed`), unless a caller asks for estimates: given an
    ``exact_work``, classes whose buckets hold more other classes than that, summed over
    bands, merge one sketch of notice ids per bucket. No query asks for them.
    """
    hashed = hashed_notices(signatures, rows, bands)
    if exact_work is None:
        return distinct_of_hashed(hashed, hot_rows)
    classes, shared = _shared_classes(hashed, hot_rows)
    work = materialize(
        shared.groupBy("class_no").agg(F.sum(F.col("bucket_classes") - 1).alias("work")), "class-work"
    )
    light = work.where(F.col("work") <= exact_work).select("class_no")
    few = shared.where(F.col("bucket_classes") <= exact_work + 1)
    counted = lookup_join(met_notices(few, classes, hot_rows=hot_rows), light, ["class_no"], "left_semi")
    heavy = lookup_join(
        shared, work.where(F.col("work") > exact_work).select("class_no"), ["class_no"], "left_semi"
    ).select("class_no", *BUCKET)
    sketched = _sketched(hashed, classes, shared, heavy, sketch_bits, hot_rows)
    return _of_notices(hashed, classes, counted.withColumn("is_exact", F.lit(True)).unionByName(sketched))


def distinct_of_hashed(hashed: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Stored ``(notice_id, candidate_count, is_exact)`` of :func:`hashed_notices`, all exact.

    Notices of a class share all buckets, so classes are counted: a notice's candidates are
    the other notices of its class and those of every class that shares a bucket.
    """
    classes, shared = _shared_classes(hashed, hot_rows)
    counted = met_notices(shared, classes, hot_rows=hot_rows)
    return _of_notices(hashed, classes, counted.withColumn("is_exact", F.lit(True)))


def _shared_classes(hashed: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Stored classes with numbers, which keep band rows narrow, and their rows in buckets
    of two classes or more."""
    classes = materialize(
        hashed_classes(hashed).withColumn("class_no", F.monotonically_increasing_id()), "classes"
    )
    keyed = classes.select("class_no", F.posexplode("hashes").alias("band_no", "band_hash"))
    return classes, materialize(shared_rows(keyed, BUCKET, "bucket_classes", hot_rows), "shared-bands")


def _of_notices(hashed: DataFrame, classes: DataFrame, counted: DataFrame) -> DataFrame:
    """The counts of each notice; ``counted(class_no, met, is_exact)`` has its class itself too."""
    per_class = classes.select("class_id", "class_no", "notices").join(counted, "class_no", "left").select(
        "class_id",
        (F.coalesce("met", "notices") - 1).cast("bigint").alias("candidate_count"),
        F.coalesce("is_exact", F.lit(True)).alias("is_exact"),
    )
    members = hashed.where(F.col("class_id").isNotNull()).select("notice_id", "class_id")
    return materialize(
        lookup_join(members, per_class, ["class_id"], "inner").drop("class_id"), "distinct-candidates"
    )


def met_notices(
    shared: DataFrame, classes: DataFrame, block_bits: int = BLOCK_BITS, hot_rows: int = HOT_ROWS,
    task_cells: int = TASK_CELLS,
) -> DataFrame:
    """``(class_no, met)``: the notices of all classes that share a bucket with each class of
    ``shared``, its own among them, each counted once.

    No pair is a row. Classes are numbered along their largest buckets, so that near
    duplicates are neighbours, and numbers are cut into blocks. A bucket is one part per
    block, a list of places; buckets of the same classes, dozens per group of near
    duplicates, are one. Two blocks are a cell: a task reads the parts that meet there one
    after the other, sets their bits and adds up the notices of the bits of each row. A
    bucket of n classes makes (n / 2^block_bits)^2 rows at best, and a task holds one cell.
    """
    largest = shared.groupBy("class_no").agg(
        F.max(F.struct("bucket_classes", *BUCKET)).alias("largest")
    )
    numbered = materialize(
        dense_numbers(largest, [F.desc("largest"), F.asc("class_no")], "place").select("class_no", "place"),
        "class-places",
    )
    weighted = numbered.join(classes.select("class_no", "notices"), "class_no")
    # Parts have few places, so numbers of 32 bits or less.
    at = F.col("place") - 1
    placed = materialize(
        lookup_join(
            shared.select("class_no", *BUCKET),
            weighted.select(
                "class_no", "notices", "place", F.shiftright(at, block_bits).alias("block"),
                at.bitwiseAND(F.lit((1 << block_bits) - 1)).cast("short").alias("at"),
            ),
            ["class_no"], "inner", hot_rows=hot_rows,
        ).drop("class_no"), "placed-bands",
    )
    members = [F.bit_xor(F.xxhash64("place", F.lit(salt))).alias(f"members_{salt}") for salt in (0, 1)]
    same = placed.groupBy(*BUCKET).agg(F.count("*").alias("n"), *members)
    # Buckets of equal members, told by 128 bits: the first stands for all.
    lists = materialize(
        same.groupBy("n", "members_0", "members_1").agg(F.min(F.struct(*BUCKET)).alias("first"))
        .select("first.*").withColumn("list_no", F.monotonically_increasing_id()), "bucket-lists",
    )
    parts = materialize(
        lookup_join(placed, lists, BUCKET, "inner", hot_rows=hot_rows)
        .groupBy("list_no", "block").agg(F.collect_list(F.struct("at", "notices")).alias("part"))
        .select("list_no", "block", "part.at", "part.notices"), "bucket-parts",
    )
    others = parts.select(
        "list_no", F.col("block").alias("other_block"), F.col("at").alias("other_at"), "notices"
    )
    cells = split_join(
        parts.select("list_no", "block", "at"), others, ["list_no"], max_broadcast_rows=1_000,
        task_pairs=task_cells, left_by=["block"], right_by=["other_block"],
    )
    met = cells.drop("list_no").repartition("block", "other_block").sortWithinPartitions(
        "block", "other_block"
    ).mapInArrow(_cell_counter(block_bits), "place long, met long")
    return met.groupBy("place").agg(F.sum("met").alias("met")).join(numbered, "place").select("class_no", "met")


def _cell_counter(block_bits: int) -> Callable:
    """Notices met in each cell by the classes of its block; travels to workers by itself."""
    size = 1 << block_bits

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros((size, -(-size // 64)), dtype=np.uint64)
        rows, notices = np.zeros(size, dtype=bool), np.zeros(size, dtype=np.int64)
        cell = None

        def packed(mask: np.ndarray) -> np.ndarray:
            whole = np.zeros(bits.shape[1] * 64, dtype=bool)
            whole[:size] = mask
            return np.packbits(whole).view(np.uint64)

        def counted() -> pa.RecordBatch:
            """One power of two of the numbers of notices at a time; the cell is empty then."""
            touched = np.flatnonzero(rows)
            found, total = bits[touched], np.zeros(len(touched), dtype=np.int64)
            for power in range(int(notices.max()).bit_length()):
                plane = packed((notices >> power) & 1 == 1)
                total += np.bitwise_count(found & plane).sum(axis=1, dtype=np.int64) << power
            bits[touched] = 0
            rows[:], notices[:] = False, 0
            return pa.RecordBatch.from_arrays(
                [pa.array((cell[0] << block_bits) + touched + 1, pa.int64()), pa.array(total, pa.int64())],
                ["place", "met"],
            )

        for batch in batches:
            blocks, others = (batch.column(name).to_numpy() for name in ("block", "other_block"))
            lists = [batch.column(name) for name in ("at", "other_at", "notices")]
            for row, own in enumerate(zip(blocks.tolist(), others.tolist())):
                if own != cell:
                    if cell is not None:
                        yield counted()
                    cell = own
                at, other_at, weights = (one[row].values.to_numpy(zero_copy_only=False) for one in lists)
                rows[at] = True
                notices[other_at] = weights
                mask = np.zeros(size, dtype=bool)
                mask[other_at] = True
                bits[at] |= packed(mask)
        if cell is not None:
            yield counted()

    return work


def _sketched(
    hashed: DataFrame, classes: DataFrame, shared: DataFrame, heavy: DataFrame,
    sketch_bits: int, hot_rows: int,
) -> DataFrame:
    """``(class_no, met, is_exact)`` of heavy classes, themselves counted too."""
    of_class = materialize(
        hashed.where(F.col("class_id").isNotNull()).groupBy("class_id")
        .agg(F.hll_sketch_agg(F.col("notice_id").cast("string"), F.lit(sketch_bits)).alias("sketch"))
        .join(classes.select("class_id", "class_no"), "class_id").select("class_no", "sketch"),
        "class-sketches",
    )
    asked = heavy.select(*BUCKET).distinct()
    members = shared.select("class_no", *BUCKET).join(asked, list(BUCKET), "left_semi")
    of_bucket = materialize(
        lookup_join(members, of_class, ["class_no"], "inner", None, 1_000, hot_rows)
        .groupBy(*BUCKET).agg(F.hll_union_agg("sketch").alias("sketch")), "bucket-sketches",
    )
    merged = lookup_join(heavy, of_bucket, BUCKET, "inner", None, 1_000, hot_rows)
    return merged.groupBy("class_no").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("met")
    ).withColumn("is_exact", F.lit(False))


def candidate_load(
    notices: DataFrame, bands: DataFrame, unsuppressed: DataFrame, cap: int = BUCKET_CAP,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Stored load: one row per stage and notice of ``notices(notice_id, portal_id)``.

    ``candidate_work`` counts a candidate once per shared bucket; ``candidate_count``
    counts distinct candidates, before suppression those of ``unsuppressed``
    (:func:`distinct_candidates`). ``bands`` is read twice: pass a table that is stored, or
    exploded from a stored one (``lsh.hashed_bands``).
    """
    sized = materialize(shared_rows(bands, BUCKET, "bucket_size", hot_rows), "sized-bands")
    others = F.col("bucket_size") - 1
    work = sized.groupBy("notice_id").agg(
        F.sum(others).alias("before"),
        F.sum(F.when(F.col("bucket_size") <= cap, others).otherwise(0)).alias("after"),
    )
    counts = counts_from_pairs(pairs_within(sized, cap))
    before = unsuppressed.select("notice_id", F.col("candidate_count").alias("count_before"))
    each = (
        notices.select("notice_id", "portal_id")
        .join(work, "notice_id", "left").join(counts, "notice_id", "left")
        .join(before, "notice_id", "left")
    )
    zero = F.lit(0).cast("bigint")
    stages = F.array(
        F.struct(
            F.lit("before").alias("stage"), F.coalesce("before", zero).alias("candidate_work"),
            F.coalesce("count_before", zero).alias("candidate_count"),
        ),
        F.struct(
            F.lit("after").alias("stage"), F.coalesce("after", zero).alias("candidate_work"),
            F.coalesce("candidate_count", zero).alias("candidate_count"),
        ),
    )
    return materialize(
        each.select("notice_id", "portal_id", F.explode(stages).alias("of"))
        .select("of.stage", "notice_id", "portal_id", "of.candidate_work", "of.candidate_count"),
        "candidate-load",
    )


def counts_from_pairs(pairs: DataFrame) -> DataFrame:
    """Distinct candidates per notice; both ends come from one read of the pairs."""
    sides = pairs.select(F.explode(F.array("notice_id_a", "notice_id_b")).alias("notice_id"))
    return sides.groupBy("notice_id").agg(F.count("*").alias("candidate_count"))


def candidate_stats(load: DataFrame) -> DataFrame:
    """Per stage: work and candidates per notice; both percentile definitions are in use."""
    totals = load.groupBy("stage").agg(
        (F.sum("candidate_work") / 2).cast("bigint").alias("bucket_pair_hits"),
        F.avg("candidate_work").alias("average_work"),
        F.max("candidate_work").alias("max_work"),
        (F.sum("candidate_count") / 2).cast("bigint").alias("candidate_pairs"),
        F.avg("candidate_count").alias("average_candidates"),
        F.max("candidate_count").alias("max_candidates"),
    )
    work = percentiles(load, "candidate_work", ["stage"]).select(
        "stage", F.col("nearest_rank").alias("p95_work")
    )
    counts = percentiles(load, "candidate_count", ["stage"]).select(
        "stage", F.col("interpolated").alias("p95_candidates"),
        F.col("nearest_rank").alias("p95_nearest_rank"),
    )
    return totals.join(work, "stage").join(counts, "stage", "left")


def portal_load(load: DataFrame) -> DataFrame:
    """Per stage and portal: work, its share of the stage's work, and candidates."""
    per_portal = load.groupBy("stage", "portal_id").agg(
        F.count("*").alias("notices"),
        F.sum("candidate_work").alias("work_assignments"),
        F.round(F.avg("candidate_work"), 2).alias("avg_work"),
        F.max("candidate_work").alias("max_work"),
        F.sum("candidate_count").alias("candidate_assignments"),
    )
    totals = load.groupBy("stage").agg(F.sum("candidate_work").alias("stage_work"))
    share = F.try_divide("work_assignments", "stage_work")
    return per_portal.join(F.broadcast(totals), "stage").withColumn("share", share).drop("stage_work")


def heaviest_first() -> list[Column]:
    """Portals by their work, the name decides ties."""
    return [F.desc("work_assignments"), F.asc("portal_id")]


def heaviest_portal_first(load: DataFrame) -> DataFrame:
    return load.orderBy(*heaviest_first())


def hottest_notices(load: DataFrame, top: int = HOTTEST) -> DataFrame:
    """Per stage the notices with most candidates; one without any never shows."""
    busy = load.where("candidate_count > 0")
    parts = [
        busy.where(F.col("stage") == stage).orderBy(F.desc("candidate_count"), "notice_id").limit(top)
        for stage in STAGES
    ]
    return parts[0].unionByName(parts[1])
