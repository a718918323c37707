"""The landed sales lake: partitioned Parquet by store, year and month."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ledgerlake import schemas


def write_lake(
    lines: DataFrame,
    path: str,
    observation: Observation | None = None,
    metrics: Sequence[Column] = (),
) -> None:
    """Write lines partitioned by store, year and month.

    The rebalance hint lets AQE split a heavy store-month over several tasks and
    merge light ones, so one busy store does not become one long task. ``metrics``
    are aggregates gathered into ``observation`` by the writing tasks.
    """
    placed = lines.hint("rebalance", *schemas.SALES_PARTITIONS)
    if observation is not None:
        placed = placed.observe(observation, *metrics)
    (
        placed.write.mode("overwrite")
        .option("compression", "zstd")
        .partitionBy(*schemas.SALES_PARTITIONS)
        .parquet(path)
    )


def write_manifest(lines: DataFrame, path: str) -> None:
    """Write the same rows as one unpartitioned snapshot."""
    lines.hint("rebalance").write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """Read the lake with its declared schema, so month stays text."""
    return spark.read.schema(schemas.SALES_LAKE).parquet(path)


def in_partition(store_id: str, year: int, month: int) -> Column:
    return (
        (F.col("store_id") == store_id)
        & (F.col("year") == year)
        & (F.col("month") == f"{month:02d}")
    )


def in_period(start: dt.date, end: dt.date) -> Column:
    """Half-open date range, with the year and month bounds that prune partitions."""
    last = end - dt.timedelta(days=1)
    stamp = F.col("year") * 100 + F.col("month").cast("int")
    return (
        (F.col("business_date") >= F.lit(start))
        & (F.col("business_date") < F.lit(end))
        & F.col("year").between(start.year, last.year)
        & stamp.between(start.year * 100 + start.month, last.year * 100 + last.month)
    )
