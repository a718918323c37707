"""Lines are landed once: neither a hot-key count nor a second load lands them again."""

import datetime as dt
from decimal import Decimal

from conftest import as_set
from pyspark.sql import functions as F

from ledgerlake import datasets, workloads
from ledgerlake.operators.landing import land
from ledgerlake.operators.temporal import newest_version_join
from ledgerlake.plans import tables

_ITEM = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
)


def _item(order, number, part, supplier, flags, day):
    return (order, part, supplier, number, 2.0, 3.5, flags[0], flags[1], dt.datetime(1996, 3, day))


def _tables(spark, folder):
    items = [
        _item(1, 1, 10, 5, "NO", 4), _item(1, 1, 10, 2, "NO", 4), _item(1, 1, 11, 2, "RF", 4),
        _item(1, 2, 11, 5, "AF", 5), _item(2, 7, 50, 7, "RO", 6), _item(None, 1, 50, 7, "NO", 6),
        _item(None, 1, 10, 1, "NO", 6), _item(3, 1, 10, None, "NO", 6), _item(3, 2, 10, 4, "AO", 7),
    ]
    spark.createDataFrame(items, _ITEM).write.parquet(f"{folder}/lineitem.parquet")
    parts = [(key, f"part {key}", "Brand#1", "TYPE", 7, 9.5) for key in (10, 11, 50)]
    spark.createDataFrame(
        parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ).write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame(
        [(key, f"s{key}", 0) for key in range(1, 13)], "s_suppkey long, s_name string, s_nationkey long"
    ).write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(0, "N", 0)], "n_nationkey long, n_name string, n_regionkey long").write.parquet(
        f"{folder}/nation.parquet")
    spark.createDataFrame([(0, "R")], "r_regionkey long, r_name string").write.parquet(f"{folder}/region.parquet")
    return str(folder)


def test_landing_before_file_names_gives_the_same_rows(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    landed = datasets.landed_lines(spark, folder)
    plain = land(datasets.conformed_lines(spark, folder))
    assert landed.schema == plain.schema
    assert as_set(landed) == as_set(plain) and landed.count() == plain.count() == 6


def test_hot_keys_come_from_the_cheaper_frame(spark):
    day = dt.date(1996, 3, 4)
    rows = spark.createDataFrame([("p", day, n) for n in range(20)] + [(None, day, 20), ("q", day, 21)],
                                 "code string, day date, n int")
    versions = spark.createDataFrame([("p", day, day, 1), ("q", day, day, 2)],
                                     "code string, first date, last date, version int")
    # A condition that shows in the plan wherever the rows are computed.
    marked = rows.where(F.col("n") != 987654)
    join = lambda **more: newest_version_join(
        marked, versions, "code", "day", "first", "last", ["version"], 0, 5, **more
    )
    found = join(hot_from=rows.select("code"))
    assert as_set(found) == as_set(join())
    executed = found._jdf.queryExecution().optimizedPlan().toString()
    assert executed.count("987654") == 1


def test_both_loads_of_the_star_read_one_stored_fact(spark, tmp_path, monkeypatch):
    folder, saved = _tables(spark, tmp_path), []
    save = tables.save_tables
    monkeypatch.setattr(tables, "save_tables", lambda given: (saved.append(given), save(given)))
    found = as_set(workloads.stored_star(spark, folder))
    facts = [frame for given in saved for name, frame in given.items() if name.startswith("fact_")]
    assert len(facts) == 2
    assert all("/fact-" in file for frame in facts for file in frame.inputFiles())
    revenue = {row[0]: row[-1] for row in found}
    assert revenue["S03"] == Decimal("7.00")
