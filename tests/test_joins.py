import datetime as dt
import random
from datetime import timedelta
from collections import Counter
from math import ceil

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.percentiles import percentiles
from ledgerlake.operators.skew import (
    fits_broadcast, hot_keys, lookup_join, with_group_size,
)
from ledgerlake.operators.temporal import newest_version_join, validity_join


def bag(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """Three thousand rows; one key has a third of them, another third is null."""
    chance = random.Random(5)
    rows = [
        (n, "hot" if n % 3 == 0 else None if n % 3 == 1 else f"k{chance.randrange(40)}")
        for n in range(3000)
    ]
    left = spark.createDataFrame(rows, "id int, key string")
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("unused", 9), (None, 8)] + [(f"k{n}", n) for n in range(0, 40, 2)],
        "key string, value int",
    )
    return left, right


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_lookup_equals_broadcast_lookup(skewed, how):
    left, right = skewed
    condition = F.col("value") < 100
    near = lookup_join(left, right, ["key"], how, condition)
    far = lookup_join(left, right, ["key"], how, condition, max_broadcast_rows=0, hot_rows=50)
    assert near.columns == far.columns
    assert bag(near) == bag(far)


def test_salted_lookup_splits_the_hot_key(skewed, spark):
    left, right = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(left, right, ["key"], "left", max_broadcast_rows=0, hot_rows=50)
        parts = joined.where("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(parts) > 1


def test_hot_keys_are_bounded_and_ordered(skewed):
    left, _ = skewed
    assert [r["key"] for r in hot_keys(left.dropna(), ["key"], 50, limit=1).collect()] == ["hot"]
    assert fits_broadcast(left, 3000) and not fits_broadcast(left, 2999)


def test_group_size_equals_plain_count(skewed):
    left, _ = skewed
    rows = left.dropna()
    plain = Counter(r["key"] for r in rows.collect())
    for hot_rows in (10_000, 20):
        for row in with_group_size(rows, ["key"], "size", hot_rows).collect():
            assert row["size"] == plain[row["key"]]
    assert with_group_size(rows, ["key"], "size", 20).count() == rows.count()


D = dt.date


@pytest.fixture(scope="module")
def versions(spark):
    return spark.createDataFrame(
        [
            ("P1", 1, D(2024, 1, 1), D(2024, 5, 31)),
            ("P1", 2, D(2024, 6, 1), D(9999, 12, 31)),
            ("P2", 3, D(2024, 1, 1), D(2024, 12, 31)),
        ],
        "code string, sk int, starts date, ends date",
    )


@pytest.mark.parametrize("max_rows", [100, 0])
def test_validity_interval_is_closed_on_both_ends(spark, versions, max_rows):
    sales = spark.createDataFrame(
        [(1, "P1", D(2024, 5, 31)), (2, "P1", D(2024, 6, 1)), (3, "P1", D(2024, 1, 1)),
         (4, "P1", D(2023, 12, 31)), (5, "DISC", D(2024, 3, 1)), (6, "P2", D(2024, 12, 31)),
         (7, None, D(2024, 3, 1))],
        "line int, code string, day date",
    )
    joined = validity_join(sales, versions, "code", "day", "starts", "ends", max_rows, 1)
    found = {r["line"]: r["sk"] for r in joined.collect()}
    assert found == {1: 1, 2: 2, 3: 1, 4: None, 5: None, 6: 3, 7: None}


def test_overlap_guard_keeps_the_newest_version(spark, versions):
    nested = versions.unionByName(
        spark.createDataFrame([("P2", 4, D(2024, 3, 1), D(2024, 3, 31))], versions.schema)
    )
    sales = spark.createDataFrame(
        [(1, "P2", D(2024, 3, 15)), (2, "P2", D(2024, 6, 1)), (3, "none", D(2024, 6, 1))],
        "line int, code string, day date",
    )
    loose = validity_join(sales, nested, "code", "day", "starts", "ends")
    assert loose.count() == 4
    kept = newest_version_join(sales, nested, "code", "day", "starts", "ends", ["sk"])
    assert {r["line"]: r["sk"] for r in kept.collect()} == {1: 4, 2: 3, 3: None}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "BroadcastHashJoin" in plan and "Exchange hash" not in plan


def test_segments_equal_ranking_every_day(spark):
    chance = random.Random(12)
    first = D(2024, 1, 1)
    rows = []
    for sk in range(40):
        start = chance.randrange(60)
        rows.append((f"P{sk % 5}", sk, first + timedelta(start), first + timedelta(start + chance.randrange(25))))
    rows.append(("P0", 99, rows[0][2], rows[0][3]))  # same interval: the smaller sk wins
    versions = spark.createDataFrame(rows, "code string, sk int, starts date, ends date")
    days = [(code, first + timedelta(day)) for code in ("P0", "P1", "P2", "P3", "P4") for day in range(90)]
    sales = spark.createDataFrame(days, "code string, day date")
    kept = newest_version_join(sales, versions, "code", "day", "starts", "ends", ["sk"])
    want = {}
    for code, day in days:
        valid = [(-(s - first).days, sk) for c, sk, s, e in rows if c == code and s <= day <= e]
        want[code, day] = min(valid)[1] if valid else None
    found = kept.collect()
    assert len(found) == len(days) and {(r.code, r.day): r.sk for r in found} == want


@pytest.mark.parametrize("count", [1, 2, 20, 99, 40_000])
def test_percentiles_equal_sorting_all_values(spark, count):
    chance = random.Random(count)
    rows = [(f"g{n % 2}", chance.choice([0, 0, 1, chance.randrange(10**6)])) for n in range(2 * count)]
    df = spark.createDataFrame(rows, "g string, v long")
    got = {r.g: r for r in percentiles(df, "v", ["g"]).collect()}
    for group in ("g0", "g1"):
        values = sorted(v for g, v in rows if g == group)
        position = 0.95 * (len(values) - 1)
        low = int(position)
        high = min(low + 1, len(values) - 1)
        between = values[low] + (values[high] - values[low]) * (position - low)
        assert got[group].nearest_rank == values[ceil(0.95 * len(values)) - 1]
        assert abs(got[group].interpolated - between) < 1e-6
    whole = percentiles(df, "v").first()
    assert whole.nearest_rank == sorted(v for _, v in rows)[ceil(0.95 * len(rows)) - 1]


def test_percentiles_of_a_million_doubles_rank_a_chunk_only(spark):
    total = 1_000_000
    # Distinct doubles: an odd factor permutes the numbers below 2^20.
    value = (F.pmod(F.col("id") * 386_093, F.lit(1 << 20)) / 7).alias("v")
    df = spark.range(total).select(F.lit("g").alias("g"), value)
    values = sorted((n * 386_093 % (1 << 20)) / 7 for n in range(total))
    for fraction in (0.0, 0.5, 0.95, 1.0):
        found = percentiles(df, "v", ["g"], fraction).first()
        position = fraction * (total - 1)
        low = int(position)
        high = min(low + 1, total - 1)
        assert found.nearest_rank == values[max(ceil(fraction * total), 1) - 1]
        between = values[low] + (values[high] - values[low]) * (position - low)
        assert abs(found.interpolated - between) < 1e-6


def test_percentiles_window_over_chunks(spark):
    df = spark.range(100).select(F.lit("g").alias("g"), F.col("id").alias("v"))
    plan = percentiles(df, "v", ["g"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window " in line]
    assert windows and all("chunk" in line for line in windows)


@pytest.mark.parametrize("max_rows", [10**6, 0])
def test_binned_versions_equal_pair_by_pair(spark, max_rows):
    chance = random.Random(5)
    first = D(2023, 1, 1)
    rows = [(None, 900, first, D(9999, 12, 31)), ("P1", 901, None, D(2023, 5, 1)), ("P1", 902, first, None),
            ("P1", 903, D(2023, 3, 2), D(2023, 3, 1)), ("P1", 904, D(2023, 2, 1), D(9999, 12, 31)),
            ("P1", 905, D(1990, 1, 1), D(1990, 2, 1)), ("P1", 906, D(1990, 1, 1), D(2023, 1, 1))]
    for sk in range(80):
        start = first + timedelta(chance.randrange(300))
        rows.append((f"P{sk % 2}", sk, start, start + timedelta(chance.randrange(70))))
    versions = spark.createDataFrame(rows, "code string, sk int, starts date, ends date")
    lines = [(n, chance.choice(["P0", "P1", "P2", None]), first + timedelta(chance.randrange(400))) for n in range(300)]
    lines.append((300, "P1", None))
    sales = spark.createDataFrame(lines, "line int, code string, day date")
    args = (sales, versions, "code", "day", "starts", "ends", max_rows, 50)
    binned = validity_join(*args, bin_versions=2)
    assert binned.columns == ["line", "code", "day", "sk", "starts", "ends"]
    want = Counter()
    for line, code, day in lines:
        valid = [sk for c, sk, s, e in rows if None not in (code, day, s, e) and c == code and s <= day <= e]
        want.update((line, sk) for sk in valid or [None])
    assert Counter((r.line, r.sk) for r in binned.collect()) == want
    assert Counter((r.line, r.sk) for r in validity_join(*args, bin_versions=10**6).collect()) == want
    none = validity_join(sales.where("false"), versions, "code", "day", "starts", "ends", max_rows, 50, bin_versions=2)
    assert none.count() == 0


@pytest.mark.parametrize("max_rows", [10**6, 0])
def test_a_key_of_many_versions_compares_by_month(spark, max_rows):
    start = F.date_add(F.lit(D(1995, 1, 1)), F.col("id").cast("int"))
    versions = spark.range(10_000).select(
        F.lit("P").alias("code"), F.col("id").alias("sk"), start.alias("starts"), start.alias("ends")
    )
    sales = spark.range(100_000).select(
        F.lit("P").alias("code"), F.col("id").alias("line"),
        F.date_add(F.lit(D(1995, 1, 1)), F.pmod("id", F.lit(10_000)).cast("int")).alias("day"),
    )
    joined = validity_join(sales, versions, "code", "day", "starts", "ends", max_rows, 1000)
    wrong = joined.where("sk is null or sk <> line % 10000")
    assert joined.count() == 100_000 and wrong.isEmpty()
    assert "validity_month" in joined._jdf.queryExecution().optimizedPlan().toString()
