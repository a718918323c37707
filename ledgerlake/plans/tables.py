"""Saved tables: the star schema, and the notice and band tables for lookups."""

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ledgerlake.operators.lsh import BUCKET


def save_tables(tables: Mapping[str, DataFrame], database: str = "default") -> None:
    """Create or replace one catalog table per entry."""
    for name, table in tables.items():
        table.write.mode("overwrite").saveAsTable(f"{database}.{name}")


def save_notice_index(
    notices: DataFrame, bands: DataFrame, buckets: int = 64, database: str = "default",
    notice_table: str = "notice", band_table: str = "lsh_band",
) -> None:
    """Save notices with their signature, and band rows laid out for lookups.

    Band rows are bucketed and sorted by band hash, so a join of many probes with
    the table moves only the probes, and small probe sets read it in one pass. The
    files of one bucket grow with the data: choose ``buckets`` so that each fits a
    task.
    """
    notices.write.mode("overwrite").saveAsTable(f"{database}.{notice_table}")
    (
        bands.write.mode("overwrite")
        .bucketBy(buckets, *BUCKET)
        .sortBy(*BUCKET)
        .saveAsTable(f"{database}.{band_table}")
    )
