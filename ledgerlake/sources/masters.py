"""Master tables from a database or from files, and the finance file."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake import schemas


def read_master(
    spark: SparkSession,
    table: str,
    path: str | None = None,
    jdbc_url: str | None = None,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
) -> DataFrame:
    """One master table in its declared schema.

    With ``jdbc_url`` the table is scanned in the database (filters and columns
    are pushed down; ``partition_column`` with ``bounds`` splits the scan), else
    the Parquet copy under ``path`` is read.
    """
    schema = schemas.MASTERS[table]
    if jdbc_url is None:
        rows = spark.read.parquet(f"{path}/{table}")
    elif partition_column is None:
        rows = spark.read.jdbc(jdbc_url, table, properties=properties)
    else:
        rows = spark.read.jdbc(
            jdbc_url, table, column=partition_column, lowerBound=bounds[0],
            upperBound=bounds[1], numPartitions=partitions, properties=properties,
        )
    return as_declared(rows, table)


def as_declared(rows: DataFrame, table: str) -> DataFrame:
    """Cast to the declared types and fill the declared defaults."""
    defaults = schemas.MASTER_DEFAULTS.get(table, {})
    columns = []
    for field in schemas.MASTERS[table].fields:
        column = F.col(field.name).cast(field.dataType)
        if field.name in defaults:
            column = F.coalesce(column, F.lit(defaults[field.name]).cast(field.dataType))
        columns.append(column.alias(field.name))
    return rows.select(*columns)


def read_finance(spark: SparkSession, path: str) -> DataFrame:
    """Finance's monthly revenue, typed; a malformed row fails the load."""
    return (
        spark.read.schema(schemas.FINANCE_MONTHLY)
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )
