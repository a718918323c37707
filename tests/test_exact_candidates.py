"""Distinct candidates before suppression are exact at any size of a bucket."""

import random

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from ledgerlake.operators import candidates, lsh
from ledgerlake.session import materialize

SIGNED = "notice_id long, signature array<long>"


def test_a_bucket_beyond_twenty_thousand_classes_is_counted_exactly(spark):
    size = 21_000
    # All share the first band and differ in the last, so that no two are one class.
    rows = [(n, [1, 1, n, n % 7 // 6]) for n in range(size)]
    hashed = lsh.hashed_notices(spark.createDataFrame(rows, SIGNED), 2, 2)
    found = candidates.distinct_of_hashed(hashed)
    assert as_set(found, "candidate_count", "is_exact") == {(size - 1, True)} and found.count() == size


@pytest.mark.parametrize("block_bits, hot_rows, cells", [(3, 10, 2), (5, 10**6, 10**4), (12, 10**6, 10**4)])
def test_bits_of_cells_are_the_classes_met(spark, block_bits, hot_rows, cells):
    draw = random.Random(8)
    rows = [(n, [draw.choice([1, 2, n]), draw.randrange(9), draw.randrange(40)]) for n in range(300)]
    hashed = [(n, f"c{n}", keys, 1 + n % 5 * (n % 3)) for n, keys in rows]
    frame = spark.createDataFrame(hashed, "class_no long, class_id string, hashes array<long>, notices long")
    classes = materialize(frame.withColumn("class_no", F.col("class_no") * 10**10), "test-classes")
    keyed = classes.select("class_no", F.posexplode("hashes").alias("band_no", "band_hash"))
    shared = materialize(candidates.shared_rows(keyed, lsh.BUCKET, "bucket_classes"), "test-shared")
    want = set()
    for n, _, keys, _ in hashed:
        met = {m: w for m, _, other, w in hashed if any(a == b for a, b in zip(keys, other))}
        if len(met) > 1:
            want.add((n * 10**10, sum(met.values())))
    found = candidates.met_notices(shared, classes, block_bits, hot_rows, cells)
    assert as_set(found, "class_no", "met") == want and found.count() == len(want) > 250
