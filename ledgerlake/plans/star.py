"""Star schema: calendar, store, category and product dimensions, sales fact."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlake import schemas
from ledgerlake.operators.ranking import dense_numbers
from ledgerlake.operators.skew import BROADCAST_ROWS, fits_broadcast, lookup_join
from ledgerlake.operators.temporal import newest_version_join

_FACT_COLUMNS = (
    "sales_line_key", "bill_no", "line_no", "store_key", "product_key", "category_key",
    "date_key", "business_date", "product_code", "qty", "unit_price", "line_type",
    "is_revenue", "revenue_amount", "ts",
)


def date_key(column: str) -> Column:
    return F.date_format(column, "yyyyMMdd").cast("int")


def calendar(span: DataFrame) -> DataFrame:
    """``dim_date`` for the one row (first_day, last_day) in ``span``."""
    days = span.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("calendar_date")
    )
    return days.select(
        date_key("calendar_date").alias("date_key"),
        "calendar_date",
        F.year("calendar_date").alias("calendar_year"),
        F.month("calendar_date").alias("calendar_month"),
        F.date_format("calendar_date", "MMMM").alias("month_name"),
        F.date_trunc("week", "calendar_date").cast("date").alias("week_start"),
        F.date_format("calendar_date", "EEEE").alias("day_name"),
        (F.dayofweek("calendar_date") - 1).alias("day_of_week"),  # Sunday is 0
    )


def whole_years(rows: DataFrame, column: str = "business_date") -> DataFrame:
    """First and last day of the years that ``rows`` touch."""
    return rows.agg(
        F.trunc(F.min(column), "year").alias("first_day"),
        F.last_day(F.add_months(F.trunc(F.max(column), "year"), 11)).alias("last_day"),
    )


def numbered(
    masters: DataFrame, natural_key: str, name: str, max_single_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Number a master list by its natural key.

    A list counted to be short is ranked in one task; a longer one by sorted ranges and
    their offsets. Both give the same numbers.
    """
    if not fits_broadcast(masters, max_single_rows):
        found = dense_numbers(masters, [F.col(natural_key)], name)
        return found.withColumn(name, F.col(name).cast("int"))
    order = Window.orderBy(natural_key)
    return masters.select(F.row_number().over(order).cast("int").alias(name), "*")


def dim_store(stores: DataFrame) -> DataFrame:
    return numbered(stores, "store_id", "store_key")


def dim_category(categories: DataFrame) -> DataFrame:
    return numbered(categories, "category_id", "category_key")


def dim_product(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Product versions with their category key; unknown categories drop out."""
    keyed = lookup_join(
        products, categories.select("category_id", "category_key"), ["category_id"], "inner"
    )
    return keyed.select(
        F.col("product_sk").cast("bigint").alias("product_key"), "product_code",
        "product_name", "category_key", "category_id", "brand", "pack_size", "uom",
        "valid_from", "valid_to", "is_current",
    )


def resolve_products(
    lines: DataFrame, products: DataFrame, codes: DataFrame | None = None
) -> DataFrame:
    """Add the product version that was valid on the business date.

    ``codes`` is a cheaper frame that tells frequent product codes, so that ``lines`` need
    not be computed to count them.
    """
    versions = products.select(
        "product_code", "product_key", "category_key", "valid_from", "valid_to"
    )
    return newest_version_join(
        lines, versions, "product_code", "business_date", "valid_from", "valid_to",
        tie_break=["product_key"], hot_from=codes,
    )


def fact_sales_line(
    lines: DataFrame, stores: DataFrame, products: DataFrame, codes: DataFrame | None = None
) -> DataFrame:
    """One row per landed line; lines of unknown stores drop out.

    ``lines`` must be landed, that is, unique by bill and line number. ``codes`` is that of
    :func:`resolve_products`.
    """
    located = lookup_join(lines, stores.select("store_id", "store_key"), ["store_id"], "inner")
    is_revenue = F.col("line_type").isin(*schemas.REVENUE_LINE_TYPES)
    return (
        resolve_products(located, products, codes)
        .withColumn(
            "sales_line_key",
            F.xxhash64(F.concat(F.col("bill_no"), F.lit(":"), F.col("line_no").cast("string"))),
        )
        .withColumn("date_key", date_key("business_date"))
        .withColumn("is_revenue", is_revenue)
        .withColumn(
            "revenue_amount",
            F.when(is_revenue, F.col("qty") * F.col("unit_price")).otherwise(
                F.lit(0).cast("decimal(18,2)")
            ),
        )
        .select(*_FACT_COLUMNS)
    )
