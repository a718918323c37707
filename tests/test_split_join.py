"""Joins whose two sides share a heavy key, and lookups of wide rows."""

import random
from collections import Counter

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from ledgerlake import datasets
from ledgerlake.operators import candidates, evaluate, lsh
from ledgerlake.operators.skew import split_join, split_keys
from ledgerlake.session import materialize


def test_equal_rows_however_split(spark):
    draw = random.Random(1)
    key = lambda: draw.choice([1, 1, 1, 2, 3, None, *range(10, 40)])
    left = spark.createDataFrame([(key(), n) for n in range(600)], "k int, a int")
    right = spark.createDataFrame([(key(), n) for n in range(400)], "k int, b int")
    plain = Counter(map(tuple, left.join(right, "k").select("k", "a", "b").collect()))
    for broadcast, pairs in ((1000, 10), (0, 10), (0, 500), (0, 10**9)):
        found = split_join(left, right, ["k"], None, None, broadcast, pairs)
        assert found.columns == ["k", "a", "b"]
        assert Counter(map(tuple, found.collect())) == plain
    odd = split_join(left, right, ["k"], F.col("a") != F.col("b"), None, 0, 50)
    assert Counter(map(tuple, odd.collect())) == Counter({row: n for row, n in plain.items() if row[1] != row[2]})


def test_one_key_of_ten_thousand_by_ten_thousand(spark):
    """10^8 pairs of one key are made by cells of about a hundredth each."""
    left = spark.range(10_000).selectExpr("1 AS k", "id AS a")
    right = spark.range(10_000).selectExpr("1 AS k", "id AS b")
    bound = 1_000_000
    row = split_keys(left, right, ["k"], None, bound).first()
    assert (row.left_parts, row.right_parts) == (10, 10)
    joined = split_join(left, right, ["k"], None, None, 0, bound)
    lanes = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "400")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        tasks = joined.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", lanes)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sum(row.n for row in tasks) == 10**8
    # 100 cells over 400 tasks: a task holds few cells, a cell stays near the bound.
    assert len(tasks) > 70 and max(row.n for row in tasks) < 5 * bound


def test_wide_rows_split_by_their_values(spark):
    left = spark.range(3000).selectExpr("if(id % 2 = 0, 1, cast(id AS int)) AS k", "id AS a")
    right = spark.range(3000).selectExpr("cast(id AS int) AS k", "array_repeat(id, if(id = 1, 20000, 3)) AS wide")
    heavy = split_keys(left, right, ["k"], F.size("wide"), 1_000_000).collect()
    # The payload is one row: only the left side can be dealt.
    assert [(row.k, row.left_parts, row.right_parts) for row in heavy] == [(1, 31, 1)]
    found = split_join(left, right, ["k"], None, F.size("wide"), 0, 1_000_000, left_by=["a"], right_by=["k"])
    assert found.count() == 3000 and found.where("size(wide) = 20000").count() == 1501


@pytest.mark.parametrize("values", [10**9, 40])
def test_both_lookups_of_a_pair(spark, values):
    pairs = [(0, n, "same") for n in range(1, 60)] + [(n, 60, "different") for n in range(1, 60)]
    frame = spark.createDataFrame(pairs, "notice_id_a long, notice_id_b long, label string")
    notices = spark.createDataFrame([(n, list(range(n % 7 + 1))) for n in range(61)], "notice_id long, v array<int>")
    both = evaluate.attach_both(frame, notices, "v", 0, values, F.size("v"))
    assert {(row.notice_id_a, row.notice_id_b, row.label, len(row.left_v), len(row.right_v)) for row in both.collect()} == {
        (a, b, label, a % 7 + 1, b % 7 + 1) for a, b, label in pairs}
    assert both.count() == len(pairs)


def signatures(spark, size):
    draw = random.Random(size)
    rows = []
    for n in range(size):
        own = [draw.randrange(10**9) for _ in range(8)]
        if n % 3 == 0:
            own[0:2] = [1, 2]  # one bucket of a third
        if n % 10 == 0:
            own = [5] * 8  # copies
        if n % 4 == 1:
            own[2:4] = [n // 40, 0]
        rows.append((n, own))
    return rows


def partners(rows):
    bands = {}
    for n, own in rows:
        for at in range(0, 8, 2):
            bands.setdefault((at, *own[at:at + 2]), []).append(n)
    met = {n: set() for n, _ in rows}
    for ids in bands.values():
        for n in ids:
            met[n].update(ids)
    return {n: len(ids) - 1 for n, ids in met.items()}


def test_distinct_candidates(spark):
    rows = signatures(spark, 600)
    table = materialize(
        spark.createDataFrame([*rows, (-1, None)], "notice_id long, signature array<long>"), "test-signatures")
    want = partners(rows)
    exact = candidates.distinct_candidates(table, 2, 4)
    assert as_set(exact) == {(n, count, True) for n, count in want.items()}
    mixed = candidates.distinct_candidates(table, 2, 4, exact_work=50, hot_rows=60).collect()
    assert {row.is_exact for row in mixed} == {True, False} and len(mixed) == 600
    for row in mixed:
        if row.is_exact:
            assert row.candidate_count == want[row.notice_id]
        else:
            assert abs(row.candidate_count - want[row.notice_id]) <= max(2, 0.03 * want[row.notice_id])
    none = candidates.distinct_candidates(table.limit(0), 2, 4)
    assert none.count() == 0


def test_every_document_is_a_whole_notice(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text")
    notices = datasets.notices(spark, path)
    whole = docs.join(notices, docs.doc_id == notices.notice_id)
    assert whole.count() == docs.count() and whole.where("not contains(body, text)").count() == 0
    letters = notices.where(F.col("notice_id") >= datasets.FORM_IDS)
    assert 0 < letters.count() < docs.count() / 3 and notices.count() == docs.count() + letters.count()
    # Every kind probes, form letters too.
    probes = notices.where("notice_id % 20 = 0")
    starts = {row.s[:12] for row in probes.select(F.substring("body", 1, 12).alias("s")).collect()}
    assert {"Tender refer", "State Procur", "Preface.\nNam"} <= starts
