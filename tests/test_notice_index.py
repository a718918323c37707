"""The stored index: lookups by join and by pruning, hot keys, plans."""

import random
import re
import uuid
from collections import defaultdict

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from ledgerlake.operators import lsh, notice_index
from ledgerlake.session import materialize


def corpus(seed, size):
    """Signatures of 8 lanes: copies, near-copies that share a band, and strangers."""
    chance = random.Random(seed)
    signs = {}
    for n in range(size):
        own = [chance.randrange(10**9) for _ in range(8)]
        if n % 3 == 0:
            own[0:2] = [1, 2]
        if n % 5 == 0:
            own = [7] * 8
        if n % 7 == 1 and n > 7:
            own[4:6] = signs[n - 1][4:6]
        signs[n] = own
    return signs


def signed_table(spark, signs):
    rows = [*signs.items(), (-1, None)]
    return materialize(spark.createDataFrame(rows, "notice_id long, signature array<long>"), "test-signatures")


def want(signs, members, probes):
    found = defaultdict(int)
    for probe in probes:
        for other, own in signs.items():
            if other != probe and any(own[at:at + 2] == signs[probe][at:at + 2] for at in range(0, 8, 2)):
                found[probe, members[other]] += 1
    return {(*key, n) for key, n in found.items()}


@pytest.mark.parametrize("few_keys,hot_rows", [(0, 10**6), (10_000, 10**6), (0, 20)])
def test_lookup_equals_comparing_all(spark, few_keys, hot_rows):
    signs = corpus(few_keys + 3, 240)
    signed = signed_table(spark, signs)
    index = notice_index.build_index(signed, f"t{uuid.uuid4().hex}", 2, 4, 8, hot_rows=hot_rows)
    assert index.table(spark, "hot").isEmpty() == (hot_rows > 20)
    probes = signed.where("notice_id % 4 = 0 or notice_id = -1").withColumnRenamed("notice_id", "probe_id")
    members = dict(as_set(lsh.content_classes(signed)))
    found = notice_index.lookup(spark, index, probes, few_keys)
    assert as_set(found) == want(signs, members, range(0, 240, 4))
    # Probes from outside keep every notice of their class.
    outside = probes.withColumn("probe_id", F.col("probe_id") + 1000).where("probe_id in (1000, 1004)")
    whole = as_set(notice_index.lookup(spark, notice_index.open_index(index.name, 2, 4, 8), outside, few_keys, indexed=False))
    assert {(a - 1000, b, n - (members[a - 1000] == b)) for a, b, n in whole} - {
        (a, b, 0) for a in (0, 4) for b in members.values()} == want(signs, members, (0, 4))


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_band_table_does_not_move(spark):
    signed = signed_table(spark, corpus(1, 200))
    index = notice_index.build_index(signed, f"t{uuid.uuid4().hex}", 2, 4, 16)
    classes = signed.where("signature is not null").select(F.col("notice_id").alias("probe_class"), "signature")
    keys = lsh.band_rows(classes.withColumnRenamed("probe_class", "notice_id"), 2, 4)
    wanted = materialize(
        keys.select(F.col("notice_id").alias("probe_class"), notice_index.band_key().alias("band_key")), "wanted")
    plan = executed(notice_index.lookup_keys(spark, index, wanted, 0))
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    moved = re.findall(r"Exchange hashpartitioning\([^)]*", plan)
    # Only the probes are dealt, the way the table is.
    assert len(moved) == 1 and moved[0].endswith(", 16")
    bands_side = plan[:plan.index("Bucketed: true")]
    assert plan.count("Exchange") == 1 and bands_side.count("Exchange") == 0
    # The planner prunes files by bucket either way; it names the number in this setting.
    automatic = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(automatic, "false")
    try:
        few = executed(notice_index.lookup_keys(spark, index, wanted.where("probe_class = 3"), 100))
    finally:
        spark.conf.unset(automatic)
    chosen = re.search(r"SelectedBucketsCount: (\d+) out of 16", few)
    assert chosen and int(chosen[1]) <= 4
    assert "Exchange hashpartitioning" not in few


def test_empty_index_and_probes(spark):
    none = spark.createDataFrame([], "notice_id long, signature array<long>")
    index = notice_index.build_index(none, f"t{uuid.uuid4().hex}", 2, 4, 4)
    assert notice_index.lookup(spark, index, none.withColumnRenamed("notice_id", "probe_id")).count() == 0
