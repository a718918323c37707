"""Quoted multi-line shards read by many tasks, and numbers over many ranges."""

import csv
import io
import random

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from ledgerlake.operators.ranking import dense_numbers, read_ordered, write_ordered
from ledgerlake.plans import star
from ledgerlake.sources import notices

NAMES = ["notice_id", "portal_id", "title", "body", "published_at", "estimated_value"]


def _rows(seed, size):
    draw = random.Random(seed)
    parts = ["plain", "line\nbreak", 'quote "x"', '"', '""', "\n\n", 'end"\n', ",", "é\n漢", "\r\nwindows", "x" * 70]
    return [
        [str(draw.randrange(size)), f"P{n % 3}", draw.choice(parts), "".join(draw.choices(parts, k=draw.randint(0, 6))), "2024", str(n)]
        for n in range(size)
    ]


def _write(path, rows, end="\n", mark=""):
    text = io.StringIO()
    writer = csv.writer(text, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
    writer.writerow(NAMES)
    writer.writerows(rows)
    path.write_bytes((mark + text.getvalue()).encode())


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("end,mark,broadcast", [("\n", "﻿", 100_000), ("\r\n", "", 0)])
def test_splits_at_quotes_and_breaks(spark, small_splits, tmp_path, end, mark, broadcast):
    shards = [_rows(1, 25), _rows(2, 12)]
    paths = []
    for number, rows in enumerate(shards):
        paths.append(str(tmp_path / f"shard{number}.csv"))
        _write(tmp_path / f"shard{number}.csv", rows, end, mark)
    assert spark.read.text(paths[0]).rdd.getNumPartitions() > 10  # one file, many tasks
    records = notices.quoted_records(spark, paths, broadcast).collect()
    for number, rows in enumerate(shards):
        mine = {row.record: row.text for row in records if row.shard == number}
        assert sorted(mine) == list(range(1, len(rows) + 2))
        parsed = [next(csv.reader(io.StringIO(mine[at], newline=""))) for at in range(2, len(rows) + 2)]
        assert parsed == rows
    newest = {}
    for rows in shards:
        for row in rows:
            newest[row[0]] = row
    # An unquoted empty field is null.
    want = {tuple(value or None for value in row[:4]) for row in newest.values()}
    found = notices.read_notices(spark, paths).select(*(F.col(name).cast("string") for name in NAMES[:4]))
    assert as_set(found) == want


def test_empty_shards(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    _write(tmp_path / "header.csv", [])
    assert notices.read_notices(spark, [str(tmp_path / "none.csv"), str(tmp_path / "header.csv")]).count() == 0


def test_numbers_equal_one_task_ranking(spark):
    rows = spark.range(1_000_000).select((F.col("id") * 7919 % 1_000_003).alias("k"))
    found = dense_numbers(rows, [F.col("k")], "n")
    assert found.agg(F.count("*"), F.min("n"), F.max("n"), F.countDistinct("n")).first() == (10**6, 1, 10**6, 10**6)
    sorted_keys = sorted(n * 7919 % 1_000_003 for n in range(1_000_000))
    some = found.where("n % 99991 = 0 or n = 1").collect()
    assert len(some) == 11 and all(sorted_keys[row.n - 1] == row.k for row in some)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(k" not in plan
    masters = spark.createDataFrame([("c", 1), ("a", 2), ("b", 3)], "natural string, v int")
    assert as_set(star.numbered(masters, "natural", "key", 0)) == as_set(star.numbered(masters, "natural", "key"))
    assert dict(star.numbered(masters, "natural", "key", 0).dtypes)["key"] == "int"
    assert dense_numbers(masters.limit(0), [F.col("natural")], "n").count() == 0


def test_order_survives_a_read_back(spark, tmp_path):
    rows = spark.range(5000).select((F.col("id") * 37 % 5003).alias("v"), F.when(F.col("id") % 9 != 0, F.col("id") % 5).alias("g"))
    order = [F.asc_nulls_last("g"), F.desc("v")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_ordered(rows, str(tmp_path / "o"), order)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = sorted(((row.v, row.g) for row in rows.collect()), key=lambda one: (one[1] is None, one[1] or 0, -one[0]))
    found = read_ordered(spark, str(tmp_path / "o")).collect()
    assert [(row.v, row.g) for row in sorted(found, key=lambda row: row.position)] == want
    # File by file, names ascending, the rows are in order.
    files = sorted(path for path in (tmp_path / "o").iterdir() if path.suffix == ".parquet")
    read = [row.position for path in files for row in spark.read.parquet(str(path)).collect()]
    assert read == list(range(1, 5001)) and len(files) > 1
    top = read_ordered(spark, str(tmp_path / "o"), 10)
    assert [row.position for row in top.orderBy("position").collect()] == list(range(1, 11))
    assert "LessThanOrEqual(position,10)" in top._jdf.queryExecution().executedPlan().toString()
