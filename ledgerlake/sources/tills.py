"""Till export files: three dialects, conformed to one line schema."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerlake import schemas


@dataclass(frozen=True)
class Dialect:
    """How one till generation writes its files."""

    stores: str  # glob part that selects the stores
    schema: StructType
    separator: str
    columns: dict[str, str]  # canonical name -> name in the file


_PLAIN = {name: name for name in
          ("bill_no", "line_no", "product_code", "qty", "unit_price", "line_type", "ts")}

# Which stores run which till software, and its column names.
COMMA = Dialect("S0[1-5]", schemas.TILL_COMMA, ",", _PLAIN)
SEMICOLON = Dialect(
    "S0[6-9]", schemas.TILL_SEMICOLON, ";",
    {"bill_no": "bill_no", "line_no": "line_no", "product_code": "item_code",
     "qty": "quantity", "unit_price": "rate", "line_type": "type", "ts": "txn_time"},
)
EPOCH = Dialect("S1[0-2]", schemas.TILL_EPOCH, ",", _PLAIN)
DIALECTS = (COMMA, SEMICOLON, EPOCH)
# Fixed value: store and business date in a file's name.
FILE_NAME = r"SALES_([^_]+)_([0-9]{8})"


def store_of(file: Column) -> Column:
    return F.regexp_extract(file, FILE_NAME, 1)


def business_date_of(file: Column) -> Column:
    """The date in the file name; timestamps inside may run past midnight."""
    return F.to_date(F.regexp_extract(file, FILE_NAME, 2), "yyyyMMdd")


def conform(rows: DataFrame, dialect: Dialect, file: Column) -> DataFrame:
    """Rename and cast one dialect's rows to the canonical line schema."""
    column = {name: F.col(source) for name, source in dialect.columns.items()}
    return rows.select(
        store_of(file).alias("store_id"),
        business_date_of(file).alias("business_date"),
        file.alias("file"),
        column["bill_no"].alias("bill_no"),
        column["line_no"].cast("int").alias("line_no"),
        column["product_code"].alias("product_code"),
        column["qty"].cast(schemas.QTY).alias("qty"),
        column["unit_price"].cast(schemas.PRICE).alias("unit_price"),
        column["line_type"].alias("line_type"),
        column["ts"].alias("ts"),
    )


def read_dialect(spark: SparkSession, pattern: str | list[str], dialect: Dialect) -> DataFrame:
    """Read the files of one dialect; a malformed row or another header fails the load.

    The base name, not the full path, orders files: an original sorts before its
    re-sends because '.' precedes '_'.
    """
    rows = (
        spark.read.schema(dialect.schema)
        .option("header", True)
        .option("sep", dialect.separator)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(pattern)
    )
    file = F.regexp_extract(F.col("_metadata.file_path"), r"(SALES_[^/]+)", 1)
    return conform(rows.withColumn("source_file", file), dialect, F.col("source_file"))


def read_tills(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """All till lines of ``folder`` with their source file name."""
    parts = [
        read_dialect(spark, f"{folder}/{prefix}SALES_{dialect.stores}_*.csv", dialect)
        for dialect in DIALECTS
    ]
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    return lines
