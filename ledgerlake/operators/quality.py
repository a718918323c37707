"""Counts, checksums and key checks."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake import schemas

# The columns a landed line is identified by in the rerun check.
CHECKSUM_COLUMNS = ("bill_no", "line_no", "product_code", "qty", "unit_price", "line_type")
NULL_MARK = "\\N"


def row_text(columns: Sequence[str]) -> Column:
    """The row as text; a marker keeps a null from merging its neighbours."""
    return F.concat_ws(
        "|", *[F.coalesce(F.col(name).cast("string"), F.lit(NULL_MARK)) for name in columns]
    )


def fast_row_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(row_text(columns)).cast("decimal(38,0)")


def portable_row_hash(columns: Sequence[str]) -> Column:
    """60 bits of md5: slower, but any engine can compute it."""
    return F.conv(F.substring(F.md5(row_text(columns)), 1, 15), 16, 10).cast("decimal(38,0)")


def checksum_metrics(
    columns: Sequence[str] = CHECKSUM_COLUMNS, row_hash=fast_row_hash
) -> tuple[Column, Column]:
    """Row count and order-independent checksum, as aggregates."""
    return F.count("*").alias("row_count"), F.sum(row_hash(columns)).alias("checksum")


def table_checksum(
    df: DataFrame, columns: Sequence[str] = CHECKSUM_COLUMNS, row_hash=fast_row_hash
) -> DataFrame:
    """One row that is equal after an equal reload."""
    return df.agg(*checksum_metrics(columns, row_hash))


def _per_line(rows: DataFrame, **counts: Column) -> DataFrame:
    """One row per source line: its number of rows, and sums of the given counts.

    Lines are dealt by (bill_no, line_no), as they are after landing, so a second
    shuffle is not needed.
    """
    return rows.groupBy(*schemas.LINE_KEY).agg(
        F.count("*").alias("copies"), *(count.alias(name) for name, count in counts.items())
    )


def landed_counts(lines: DataFrame) -> DataFrame:
    return _per_line(lines).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("landed_rows"),
        F.count("*").alias("distinct_lines"),
    )


def key_uniqueness(df: DataFrame, key: str, source: Sequence[str]) -> DataFrame:
    """One row on a hash key made from ``source``: whether it names one source row each.

    ``null_keys`` counts rows without key, ``shared_keys`` keys of different sources (hash
    collisions), and ``repeated_keys`` keys of several rows, copies of one source included.
    Counts and extremes are combined before the only shuffle; no group is gathered.
    """
    named = F.struct(*source)
    keys = df.groupBy(key).agg(
        F.count("*").alias("key_rows"), F.min(named).alias("first"), F.max(named).alias("last")
    )
    has_key = F.col(key).isNotNull()
    return keys.agg(
        F.coalesce(F.sum("key_rows"), F.lit(0)).alias("key_rows"),
        F.count_if(has_key).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(~has_key, F.col("key_rows"))), F.lit(0)).alias("null_keys"),
        F.count_if(has_key & (F.col("key_rows") > 1)).alias("repeated_keys"),
        F.count_if(has_key & ~F.col("first").eqNullSafe(F.col("last"))).alias("shared_keys"),
    )


def fact_integrity(fact: DataFrame) -> DataFrame:
    """Proof that no source line was multiplied or lost its product unnoticed."""
    unresolved = (
        F.col("line_type").isin("SALE", "RETURN", "VOID")
        & (F.col("product_code") != "DISC")
        & F.col("product_key").isNull()
    )
    control = (F.col("line_type") == "VOID") & (F.col("product_code") == "DISC")
    total = lambda column: F.coalesce(F.sum(column), F.lit(0))
    return _per_line(
        fact, unresolved=F.count_if(unresolved), control=F.count_if(control)
    ).agg(
        total("copies").alias("fact_rows"),
        F.count("*").alias("distinct_source_lines"),
        total(F.col("copies") - 1).alias("duplicate_rows"),
        total("unresolved").alias("unresolved_item_lines"),
        total("control").alias("void_discount_control_lines"),
    )


def reissued_codes(dim_product: DataFrame) -> DataFrame:
    codes = (
        dim_product.groupBy("product_code")
        .agg(F.countDistinct("product_key").alias("product_keys"))
        .where("product_keys = 2")
    )
    return codes.agg(F.count("*").alias("reissued_codes_with_two_historical_keys"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        table.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def master_violations(masters: dict[str, DataFrame]) -> DataFrame:
    """One row per declared key, reference and NOT NULL set, with its violations."""

    def row(name: str, bad: DataFrame) -> DataFrame:
        return bad.agg(F.count("*").alias("violations")).select(
            F.lit(name).alias("check_name"), "violations"
        )

    checks = []
    for table, key in schemas.MASTER_KEYS.items():
        repeated = masters[table].groupBy(key).count().where("count > 1")
        checks.append(row(f"{table}.{key} unique", repeated))
        required = [f.name for f in schemas.MASTERS[table].fields if not f.nullable]
        missing = reduce(Column.__or__, [F.col(name).isNull() for name in required])
        checks.append(row(f"{table} required columns", masters[table].where(missing)))
    for (table, column), (parent, parent_key) in schemas.MASTER_REFERENCES.items():
        known = masters[parent].select(F.col(parent_key).alias(column)).distinct()
        # Distinct child keys: no key repeats, whatever the skew of the child.
        orphans = (
            masters[table].groupBy(column).agg(F.count("*").alias("rows"))
            .where(F.col(column).isNotNull())
            .join(known, column, "left_anti")
            .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations"))
        )
        checks.append(
            orphans.select(F.lit(f"{table}.{column} known").alias("check_name"), "violations")
        )
    return reduce(DataFrame.unionByName, checks)
