"""From till lines with re-sends to one row per sold line."""

from pyspark.sql import DataFrame, Window, functions as F

from ledgerlake import schemas

# Every other column breaks ties inside one file, so the kept row is the same
# on each run.
_TIE_BREAK = ("product_code", "qty", "unit_price", "line_type", "ts")


def first_file_wins(lines: DataFrame) -> DataFrame:
    """Keep each line from the first file that holds it.

    A re-send may be incomplete, so the unit is the line, not the file. The rank
    filter is applied inside each input task before the shuffle, which keeps a
    line re-sent very often from filling one task.
    """
    order = Window.partitionBy(*schemas.LINE_KEY).orderBy("file", *_TIE_BREAK)
    return lines.withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank")


def with_partition_keys(lines: DataFrame) -> DataFrame:
    return lines.withColumn("year", F.year("business_date")).withColumn(
        "month", F.lpad(F.month("business_date").cast("string"), 2, "0")
    )


def land(lines: DataFrame) -> DataFrame:
    """Normalized sales: deduplicated lines with year and month."""
    return normalized(first_file_wins(lines))


def normalized(kept: DataFrame) -> DataFrame:
    """Deduplicated lines in the lake's columns, with year and month."""
    return with_partition_keys(kept).select(
        "store_id", "business_date", *schemas.LINE_KEY, "product_code", "qty",
        "unit_price", "line_type", "ts", "year", "month",
    )
