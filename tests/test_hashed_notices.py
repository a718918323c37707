"""Stored band hashes in place of signatures: equal rows, copies expanded once."""

import random

from pyspark.sql import functions as F

from ledgerlake.operators import candidates, lsh
from ledgerlake.session import materialize


def signed_rows(spark):
    chance = random.Random(4)
    rows = [(-1, None), (40, [7] * 8), (40, [8] * 8), (None, [7] * 8)]
    for n in range(120):
        own = [chance.randrange(10**9) for _ in range(8)]
        if n % 3 == 0:
            own[0:4] = [1, 2, n // 30, n // 30]
        elif n % 4 == 1:
            own = [5] * 8
        rows += [(n, own)] * (2 if n % 50 == 0 else 1)
    return materialize(spark.createDataFrame(rows, "notice_id long, signature array<long>"), "test-signed")


def as_list(rows):
    return sorted(map(str, (row.asDict() for row in rows.collect())))


def test_probes_by_class_equal_probes_by_band(spark):
    signed = signed_rows(spark)
    bands = materialize(lsh.band_rows(signed, 2, 4), "test-bands")
    hashed = lsh.hashed_notices(signed, 2, 4)
    assert as_list(lsh.hashed_bands(hashed)) == as_list(bands)
    is_probe = F.col("notice_id") % 10 == 0
    want = as_list(lsh.probe_candidates(bands.where(is_probe), bands))
    assert len(want) > 100
    for broadcast, pairs in ((1000, 10**6), (0, 15)):
        assert as_list(lsh.probe_hashed(hashed, is_probe, 20, broadcast, pairs)) == want


def test_copies_are_not_expanded_before_they_are_distinct(spark):
    """2,000 copies: 2,000 rows of one class, not 4 bands of 2,000 x 100 pairs made distinct."""
    rows = [(n, [3] * 8) for n in range(2000)]
    signed = spark.createDataFrame(rows, "notice_id long, signature array<long>")
    found = lsh.probe_hashed(lsh.hashed_notices(signed, 2, 4), F.col("notice_id") % 20 == 0)
    assert "HashAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 100 * 1999


def test_buckets_of_equal_members_are_listed_once(spark):
    rows = [(n, [n // 2] * 8) for n in range(40)]
    signed = materialize(spark.createDataFrame(rows, "notice_id long, signature array<long>"), "test-signed")
    bands = lsh.hashed_bands(lsh.hashed_notices(signed, 2, 4))
    assert sorted(tuple(row) for row in lsh.suppressed_pairs(bands, 5).collect()) == [
        (n, n + 1) for n in range(0, 40, 2)]
    counts = candidates.distinct_candidates(signed, 2, 4).collect()
    assert {(row.notice_id, row.candidate_count) for row in counts} == {(n, 1) for n in range(40)}
    plan = lsh.suppressed_pairs(bands, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [ids" in plan


def test_suppression_joins_only_large_buckets(spark):
    rows = [(n, [1] * 8 if n < 30 else [n] * 8) for n in range(60)]
    signed = spark.createDataFrame(rows, "notice_id long, signature array<long>")
    bands = lsh.hashed_bands(lsh.hashed_notices(signed, 2, 4))
    for hot_rows in (10, 10**6):
        kept = lsh.suppress_oversized(bands, 20, hot_rows)
        assert kept.count() == 30 * 4 and kept.where("notice_id < 30").isEmpty()
    assert "LeftAnti" in kept._jdf.queryExecution().optimizedPlan().toString()
