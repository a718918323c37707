import random
from collections import Counter, defaultdict
from itertools import combinations
from math import ceil

import numpy as np
import pytest
from conftest import as_set
from pyspark.sql import functions as F

from ledgerlake.operators import candidates, lsh
from ledgerlake.operators.minhash import (
    estimated_jaccard, portable_family, signature, signature_size, wide_family,
)
from ledgerlake.plans import tables
from ledgerlake.session import materialize


def test_signature_size_follows_the_error_bound():
    assert signature_size() == 738
    assert signature_size() // lsh.OPERATING_ROWS == 82
    assert round(1 - (1 - 0.8**9) ** 82, 7) == 0.9999926


def sign(spark, sets, family):
    rows = spark.createDataFrame([(n, s) for n, s in sets.items()], "notice_id int, s array<string>")
    signed = rows.select("notice_id", signature(F.col("s"), family).alias("signature"))
    return materialize(signed, "test-signatures")


def test_lanes_equal_plain_integers(spark):
    sets = {1: [f"shingle {n}" for n in range(5000)], 2: ["one"], 3: [], 4: None}
    for family in (wide_family(70), portable_family(70)):
        rows = spark.createDataFrame([(n, s) for n, s in sets.items()], "id int, s array<string>")
        bases = {r.id: r.b for r in rows.select("id", F.transform("s", family.base).alias("b")).collect()}
        got = {r.notice_id: r.signature for r in sign(spark, sets, family).collect()}
        modulus = family.modulus or 2**64
        for number in (1, 2):
            want = [
                min((a * (base % 2**64) + b) % modulus for base in bases[number])
                for a, b in zip(family.multipliers, family.offsets)
            ]
            assert [value % 2**64 for value in got[number]] == want
        assert got[3] is None and got[4] is None


def test_estimate_stays_within_its_target(spark):
    chance = random.Random(3)
    sets, exact = {}, {}
    for pair in range(60):
        common, own = chance.randrange(20, 300), chance.randrange(10, 200)
        shared = [f"{pair} c {n}" for n in range(common)]
        sets[2 * pair] = shared + [f"{pair} l {n}" for n in range(own)]
        sets[2 * pair + 1] = shared + [f"{pair} r {n}" for n in range(own)]
        exact[2 * pair] = common / (common + 2 * own)
    size = signature_size()
    signed = sign(spark, sets, wide_family())
    left = signed.where("notice_id % 2 = 0")
    right = signed.select((F.col("notice_id") - 1).alias("notice_id"), F.col("signature").alias("other"))
    got = left.join(right, "notice_id").select(
        "notice_id", estimated_jaccard(F.col("signature"), F.col("other"), size).alias("e")
    ).collect()
    errors = np.array([abs(r.e - exact[r.notice_id]) for r in got])
    assert len(errors) == 60
    assert errors.mean() < 0.0183 and (errors <= 0.05).mean() >= 0.95


BANDS = 4


def corpus(seed, notices, hot):
    """Band keys per notice. A third of all are copies and share every bucket; one
    more bucket holds a third of all, whose other bands differ."""
    chance = random.Random(seed)
    keys = {}
    for n in range(notices):
        own = [f"{band}-{chance.randrange(notices // 2)}" for band in range(BANDS)]
        if hot and n % 3 == 0:
            own = [f"{band}-copy" for band in range(BANDS)]
        elif hot and n % 3 == 1:
            own[0] = "0-boilerplate"
            own[1] = f"1-{chance.randrange(4)}"
        keys[n] = own
    return keys


def band_table(spark, keys):
    rows = [(n, band, key) for n, own in keys.items() for band, key in enumerate(own)]
    return materialize(
        spark.createDataFrame(rows, "notice_id long, band_no int, band_hash string")
        .withColumn("band_hash", F.col("band_hash").cast("binary")), "test-bands"
    )


def buckets_of(keys):
    buckets = defaultdict(list)
    for n, own in keys.items():
        for band, key in enumerate(own):
            buckets[band, key].append(n)
    return buckets


def pairs_of(keys, cap=None):
    return {
        pair
        for ids in buckets_of(keys).values()
        if cap is None or len(ids) <= cap
        for pair in combinations(sorted(ids), 2)
    }


def as_notices(spark, keys):
    return spark.createDataFrame([(n, f"P{n % 3}") for n in keys], "notice_id long, portal_id string")


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("hot_rows", [10**6, 15])
def test_load_equals_listing_every_bucket(spark, hot, hot_rows):
    keys, cap = corpus(7, 150, hot), 6
    distinct = Counter(n for pair in pairs_of(keys) for n in pair)
    unsuppressed = spark.createDataFrame(list(distinct.items()), "notice_id long, candidate_count long")
    load = candidates.candidate_load(
        as_notices(spark, keys), band_table(spark, keys), unsuppressed, cap, hot_rows)
    for stage, most in (("before", 10**6), ("after", cap)):
        work = Counter({n: 0 for n in keys})
        for ids in buckets_of(keys).values():
            for n in ids if len(ids) <= most else ():
                work[n] += len(ids) - 1
        rows = load.where(F.col("stage") == stage)
        assert dict(as_set(rows, "notice_id", "candidate_work")) == dict(work)
    want = Counter({n: 0 for n in keys}) + Counter()
    want.update(n for pair in pairs_of(keys, cap) for n in pair)
    after = dict(as_set(load.where("stage = 'after'"), "notice_id", "candidate_count"))
    assert {n: c for n, c in after.items() if c} == dict(want)
    before = dict(as_set(load.where("stage = 'before'"), "notice_id", "candidate_count"))
    assert before == {n: distinct[n] for n in keys}


def test_candidate_buckets_are_complete_and_linear(spark):
    """A bucket with a third of all notices, all of different classes, stays one row each."""
    chance = random.Random(2)
    signs = {}
    for n in range(300):
        own = [chance.randrange(10**9) for _ in range(8)]
        if n % 3 == 0:
            own[0:2] = [1, 2]
        elif n % 3 == 1:
            own = [5] * 8
        signs[n] = own
    signed = spark.createDataFrame(list(signs.items()), "notice_id long, signature array<long>")
    members = dict(as_set(lsh.content_classes(signed)))
    buckets = materialize(lsh.candidate_buckets(signed, 2, 4), "test-buckets")
    assert buckets.count() == 100
    together = {}
    for row in buckets.collect():
        together.setdefault((row.band_no, bytes(row.band_hash)), set()).add(row.class_id)
    found = {
        (a, b) for a, b in combinations(range(300), 2)
        if members[a] == members[b]
        or any({members[a], members[b]} <= classes for classes in together.values())
    }
    want = {
        (a, b) for a, b in combinations(range(300), 2)
        if any(signs[a][at:at + 2] == signs[b][at:at + 2] for at in range(0, 8, 2))
    }
    assert found == want


def test_bucket_of_100_stays_and_of_101_goes(spark):
    keys = {n: ["a" if n < 100 else "b"] for n in range(201)}
    kept = lsh.suppress_oversized(band_table(spark, keys))
    assert as_set(kept, "notice_id") == {(n,) for n in range(100)}
    pairs = lsh.suppressed_pairs(band_table(spark, keys), lsh.BUCKET_CAP)
    assert pairs.count() == 4950 and pairs.where("notice_id_a >= notice_id_b").count() == 0


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_probes_find_all_others_in_their_buckets(spark, broadcast_rows):
    keys = corpus(11, 120, True)
    bands = band_table(spark, keys)
    wanted = {0, 1, 2, 50}
    probes = bands.where(F.col("notice_id").isin(*wanted))
    found = as_set(lsh.probe_candidates(probes, bands, broadcast_rows, 15))
    both = pairs_of(keys) | {(b, a) for a, b in pairs_of(keys)}
    assert found == {(a, b) for a, b in both if a in wanted}


def test_bucket_work_counts_without_pairs(spark):
    keys = corpus(5, 100, True)
    table = band_table(spark, keys).withColumn("band_rows", F.lit(9))
    for hot_rows in (10**6, 10):
        row = lsh.bucket_work(table, hot_rows).first()
        work = Counter({n: 0 for n in keys})
        for ids in buckets_of(keys).values():
            for n in ids:
                work[n] += len(ids) - 1
        assert row.bucket_pair_hits == sum(work.values()) / 2
        assert row.max_work == max(work.values()) and row.bands == BANDS
        assert row.p95_work == sorted(work.values())[ceil(0.95 * len(work)) - 1]
        assert abs(row.average_work - sum(work.values()) / len(work)) < 1e-9


def test_bands_cover_the_signature(spark):
    sets = {1: ["a", "b"], 2: ["a", "b"], 3: ["c"], 4: []}
    signed = sign(spark, sets, portable_family(12))
    bands = lsh.band_rows(signed, 3, 4)
    assert bands.count() == 12 and as_set(bands, "band_no") == {(0,), (1,), (2,), (3,)}
    assert as_set(lsh.suppressed_pairs(materialize(bands, "test"), 100)) == {(1, 2)}
    sweep = lsh.bands_of_configurations(signed, ((3, 4), (6, 2)))
    assert sweep.groupBy("band_rows").count().orderBy("band_rows").collect() == [(3, 12), (6, 6)]
    assert as_set(sweep.where("band_rows = 3"), "notice_id", "band_no", "band_hash") == as_set(bands)


def test_sweep_of_classes_equals_the_work_of_every_notice(spark):
    chance = random.Random(3)
    texts = [[chance.choice([1, 2]) for _ in range(12)] for _ in range(40)]
    texts += [texts[0]] * 30 + [list(range(12)), None]
    signed = spark.createDataFrame(list(enumerate(texts)), "notice_id int, signature array<long>")
    settings = ((2, 6), (3, 4), (4, 3), (6, 2), (5, 2))
    want = set()
    for rows, bands in settings:
        cut = {n: [tuple(t[b * rows:(b + 1) * rows]) for b in range(bands)] for n, t in enumerate(texts) if t}
        sizes = Counter((at, band) for found in cut.values() for at, band in enumerate(found))
        work = sorted(sum(sizes[key] - 1 for key in enumerate(found)) for found in cut.values())
        want.add((rows, bands, sum(work) // 2, round(sum(work) / len(work), 6), work[-1], work[ceil(0.95 * len(work)) - 1]))

    def found(table):
        columns = "band_rows", "bands", "bucket_pair_hits", "average_work", "max_work", "p95_work"
        return as_set(table.withColumn("average_work", F.round("average_work", 6)), *columns)

    for hot_rows in (10**6, 5):
        assert found(lsh.sweep_work(signed, settings, hot_rows)) == want
    assert found(lsh.bucket_work(materialize(lsh.bands_of_configurations(signed, settings), "test"))) == want
    assert lsh.sweep_work(signed.where("signature is null"), settings).count() == 0


def test_nested_bands_read_a_lane_once(spark):
    signed = spark.createDataFrame([(1, list(range(738)))], "notice_id int, signature array<long>")
    plan = lsh.bands_of_configurations(signed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("slice(signature") == 1


def test_load_reports(spark):
    rows = [("after", n, "P1" if n < 15 else "P2", n, n) for n in range(20)]
    rows += [("before", n, "P1", 2 * n, None) for n in range(3)]
    load = spark.createDataFrame(
        rows, "stage string, notice_id long, portal_id string, candidate_work long, candidate_count long")
    stats = {row.stage: row for row in candidates.candidate_stats(load).collect()}
    # Interpolated and nearest rank differ on 0..19.
    after = stats["after"]
    assert round(after.p95_candidates, 6) == 18.05 and after.p95_nearest_rank == after.p95_work == 18
    assert after.candidate_pairs == after.bucket_pair_hits == 95 and after.average_candidates == 9.5
    assert stats["before"].bucket_pair_hits == 3 and stats["before"].candidate_pairs is None
    after_load = candidates.portal_load(load).where("stage = 'after'")
    by_portal = candidates.heaviest_portal_first(after_load).collect()
    assert [(r.portal_id, r.notices, r.work_assignments, r.max_work) for r in by_portal] == [
        ("P1", 15, 105, 14), ("P2", 5, 85, 19)]
    assert abs(sum(r.share for r in by_portal) - 1) < 1e-9
    tied = load.unionByName(spark.createDataFrame([("after", 0, "P1", 1, 19)], load.schema))
    hottest = candidates.hottest_notices(tied.where("stage = 'after'")).collect()
    assert [r.notice_id for r in hottest] == [0, 19, 18, 17, 16, 15, 14, 13, 12, 11]
    assert len(candidates.hottest_notices(load.where("stage = 'after' AND notice_id < 2")).collect()) == 1


def test_saved_index_is_probed_without_moving_the_band_table(spark):
    keys = corpus(3, 200, True)
    bands = band_table(spark, keys)
    notices = spark.createDataFrame([(n, "P1") for n in keys], "notice_id long, portal_id string")
    spark.sql("CREATE DATABASE IF NOT EXISTS notices_test")
    try:
        tables.save_tables({"portal": notices.select("portal_id").distinct()}, "notices_test")
        tables.save_notice_index(notices, bands, 4, "notices_test")
        stored = spark.table("notices_test.lsh_band")
        assert as_set(stored) == as_set(bands) and spark.table("notices_test.portal").count() == 1
        probes = stored.where("notice_id = 1").select(
            F.col("notice_id").alias("probe_id"), *lsh.BUCKET)
        joined = stored.join(probes.hint("merge"), list(lsh.BUCKET))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        others = as_set(lsh.probe_candidates(stored.where("notice_id = 1"), stored))
        both = pairs_of(keys) | {(b, a) for a, b in pairs_of(keys)}
        assert others == {pair for pair in both if pair[0] == 1}
    finally:
        spark.sql("DROP DATABASE notices_test CASCADE")
