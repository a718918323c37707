"""Numbers and order over whole tables without one task that sees all rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerlake.operators.skew import lookup_join
from ledgerlake.session import materialize, shared_path

_ROW_BITS = 33  # of monotonically_increasing_id: the row's place in its partition


def _numbered_ranges(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``rows`` dealt by ranges of ``order`` and sorted, with range ``part`` and place ``at``."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    return dealt.select(
        "*", F.shiftright(place, _ROW_BITS).alias("part"),
        place.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("at"),
    )


def dense_numbers(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``rows`` with ``name`` = 1, 2, ... in the order given, gapless over all partitions.

    Rows are dealt by ranges, sorted there and stored once; a row's number is its place in
    its range plus the rows of the ranges before, which are one count per range. Ties are
    numbered in some order that stays as stored. ``part`` and ``at`` must not be columns.
    """
    stored = materialize(_numbered_ranges(rows, order), "ranges")
    sizes = stored.groupBy("part").agg(F.count("*").alias("n"))
    # One row per range.
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return lookup_join(stored, before, ["part"], "inner").select(
        (F.col("before") + F.col("at") + 1).alias(name), *rows.columns
    )


def write_ordered(rows: DataFrame, path: str, order: Sequence[Column], name: str = "position") -> None:
    """Files in order: each holds a range of rows, sorted, with their ``name`` from 1 on.

    File names ascend with the ranges, so reading the files one after the other gives the
    order; the first rows are found by ``name``, whose bounds each file and row group has.
    """
    numbered = dense_numbers(rows, order, name)
    numbered.repartitionByRange(name).sortWithinPartitions(name).write.mode("overwrite").parquet(path)


def read_ordered(
    spark: SparkSession, path: str, first: int | None = None, name: str = "position"
) -> DataFrame:
    """The rows of :func:`write_ordered`, or the ``first`` of them, by a pushed filter."""
    rows = spark.read.parquet(path)
    return rows if first is None else rows.where(F.col(name) <= first)


def ordered(rows: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """``rows`` written in order to the shared folder and read back."""
    path = shared_path(rows.sparkSession, "ordered")
    write_ordered(rows, path, order, name)
    return read_ordered(rows.sparkSession, path, name=name)
