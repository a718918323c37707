"""Versioned publishing of a landed table, and its run log."""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ledgerlake import schemas
from ledgerlake.operators.quality import checksum_metrics, table_checksum
from ledgerlake.sources.lake import read_lake, write_lake


class PublishError(RuntimeError):
    """The staged version differs from what was to be published."""


def publish_log(spark: SparkSession, root: str) -> DataFrame:
    """One row per published run: run number, version, row count and checksum."""
    try:
        return spark.read.schema(schemas.PUBLISH_LOG).parquet(f"{root}/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.PUBLISH_LOG)


def publish(lines: DataFrame, root: str) -> str:
    """Stage ``lines`` as a new version, verify it, then make it current.

    Nothing is moved or removed: a version becomes current when its log row is
    appended, so a failure at any earlier point leaves the old version current and
    whole. This needs no rename, so it holds on object stores. One publisher at a
    time is assumed.
    """
    spark = lines.sparkSession
    last = publish_log(spark, root).agg(F.coalesce(F.max("run"), F.lit(0))).first()[0]
    version = uuid.uuid4().hex
    path = f"{root}/versions/{version}"
    written = Observation()
    write_lake(lines, path, written, checksum_metrics())
    staged = table_checksum(read_lake(spark, path)).first()
    if staged.asDict() != written.get:
        # A retried stage may count twice, so only a recount decides.
        expected = table_checksum(lines).first()
        if staged != expected:
            raise PublishError(f"staged {staged}, expected {expected}")
    row = [(last + 1, version, staged["row_count"], staged["checksum"])]
    spark.createDataFrame(row, schemas.PUBLISH_LOG).coalesce(1).write.mode("append").parquet(
        f"{root}/log"
    )
    return version


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The lines of the newest published version."""
    newest = publish_log(spark, root).orderBy(F.desc("run")).first()
    if newest is None:
        raise FileNotFoundError(f"nothing published under {root}")
    return read_lake(spark, f"{root}/versions/{newest['version']}")


def write_result_csv(result: DataFrame, path: str) -> None:
    """A small result table as one CSV file with a header.

    A shuffle of its own keeps the work above it on all tasks.
    """
    result.repartition(1).write.mode("overwrite").option("header", True).csv(path)
