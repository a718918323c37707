"""Revenue, dashboard and historical-price reports.

Reports add lines up per product and day before they meet a dimension: a product
that makes up a third of all lines is then a few rows per day and store, and the
dimension joins and final shuffles work on those.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake import schemas
from ledgerlake.operators.skew import lookup_join
from ledgerlake.operators.temporal import validity_join


def _net() -> Column:
    return F.sum(F.col("qty") * F.col("unit_price"))


def _money(total: Column) -> Column:
    return F.round(total, 2).cast(schemas.MONEY)


def is_revenue_line() -> Column:
    return F.col("line_type").isin(*schemas.REVENUE_LINE_TYPES)


def _where(df: DataFrame, predicate: Column | None) -> DataFrame:
    return df if predicate is None else df.where(predicate)


def daily_revenue(lines: DataFrame, predicate: Column | None = None) -> DataFrame:
    """Net revenue per store and business date."""
    return (
        _where(lines, predicate).where(is_revenue_line())
        .groupBy("store_id", "business_date")
        .agg(_money(_net()).alias("net_revenue"))
    )


def partition_revenue(lines: DataFrame, predicate: Column | None = None) -> DataFrame:
    """Net revenue per lake partition."""
    return (
        _where(lines, predicate).where(is_revenue_line())
        .groupBy(*schemas.SALES_PARTITIONS)
        .agg(_money(_net()).alias("net_revenue"))
    )


def federated_revenue(
    lines: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    predicate: Column | None = None,
) -> DataFrame:
    """Lake lines joined to master tables: revenue by store, category and product."""
    daily = (
        _where(lines, predicate).where(is_revenue_line())
        .groupBy("store_id", "product_code", "business_date")
        .agg(_net().alias("net"))
    )
    located = lookup_join(daily, stores.select("store_id", "store_name"), ["store_id"], "inner")
    versions = products.select(
        "product_code", "product_name", "category_id", "valid_from", "valid_to"
    )
    named = validity_join(
        located, versions, "product_code", "business_date", "valid_from", "valid_to"
    )
    filed = lookup_join(named, categories.select("category_id", "category_name"), ["category_id"])
    return (
        filed.groupBy("store_id", "store_name", "category_name", "product_name")
        .agg(_money(F.sum("net")).alias("revenue"))
    )


def category_and_product() -> list[Column]:
    """The report's printing order, nulls last; the other columns make it total."""
    return [
        F.asc_nulls_last("category_name"), F.asc_nulls_last("product_name"),
        F.asc("store_id"), F.asc("store_name"),
    ]


def by_category_and_product(report: DataFrame) -> DataFrame:
    return report.orderBy(*category_and_product())


def dashboard_revenue(
    fact: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    calendar: DataFrame,
    store_id: str | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Revenue by store, product, category, day, week, month and year."""
    sold = fact.where("is_revenue")
    if start is not None:
        sold = sold.where(F.col("business_date") >= F.lit(start))
    if end is not None:
        sold = sold.where(F.col("business_date") < F.lit(end))
    if store_id is not None:
        stores = stores.where(F.col("store_id") == store_id)
    daily = sold.groupBy("store_key", "product_key", "date_key").agg(
        F.sum("revenue_amount").alias("net")
    )
    rows = lookup_join(daily, stores.select("store_key", "store_name"), ["store_key"], "inner")
    rows = lookup_join(
        rows, products.select("product_key", "product_name", "category_key"), ["product_key"]
    )
    rows = lookup_join(
        rows, categories.select("category_key", "category_name"), ["category_key"]
    )
    days = calendar.select(
        "date_key", "calendar_date", "week_start", "calendar_year", "calendar_month"
    )
    rows = lookup_join(rows, days, ["date_key"], "inner")
    return (
        rows.groupBy(
            "store_name", "product_name", "category_name", "calendar_date", "week_start",
            "calendar_year", "calendar_month",
        )
        .agg(_money(F.sum("net")).alias("revenue"))
    )


def historical_prices(fact: DataFrame, revisions: DataFrame, periods: DataFrame) -> DataFrame:
    """Printed and list-price revenue for each (period_start, period_stop) row.

    ``period_stop`` is the first day after the period. Every line is priced by the
    revision valid on its date, or by its printed price if there is none. All
    periods share one pass over the fact.
    """
    bounds = periods.agg(F.min("period_start").alias("first"), F.max("period_stop").alias("stop"))
    sold = fact.where("is_revenue").where(
        (F.col("business_date") >= bounds.select("first").scalar())
        & (F.col("business_date") < bounds.select("stop").scalar())
    )
    daily = sold.groupBy("product_key", "business_date").agg(
        F.count("*").alias("lines"),
        F.sum("qty").alias("qty"),
        F.sum("revenue_amount").alias("printed"),
        _net().alias("net"),
    )
    prices = revisions.select(
        F.col("product_sk").alias("product_key"), "selling_price", "effective_from", "effective_to"
    )
    priced = validity_join(
        daily, prices, "product_key", "business_date", "effective_from", "effective_to"
    )
    revised = F.col("selling_price").isNotNull()
    per_day = priced.groupBy("business_date").agg(
        F.sum("lines").alias("lines"),
        F.sum(F.when(revised, F.col("lines")).otherwise(0)).alias("revised"),
        F.sum("printed").alias("printed"),
        F.sum(F.coalesce(F.col("qty") * F.col("selling_price"), F.col("net"))).alias("listed"),
    )
    days = periods.withColumn(
        "business_date",
        F.explode(
            F.sequence(
                "period_start", F.date_sub("period_stop", 1), F.expr("interval 1 day")
            )
        ),
    )
    report = days.join(per_day, "business_date", "left").groupBy("period_start", "period_stop").agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("revenue_lines"),
        F.coalesce(F.sum("revised"), F.lit(0)).alias("lines_using_revision_price"),
        F.sum("printed").alias("printed"),
        F.sum("listed").alias("listed"),
    )
    return report.select(
        "period_start",
        F.date_sub("period_stop", 1).alias("period_end"),
        "revenue_lines",
        "lines_using_revision_price",
        (F.col("revenue_lines") - F.col("lines_using_revision_price")).alias(
            "lines_using_printed_price"
        ),
        _money(F.col("printed")).alias("printed_till_revenue"),
        _money(F.col("listed")).alias("historical_price_revenue"),
        _money(F.col("listed") - F.col("printed")).alias("historical_minus_printed"),
    )


def historical_price_report(
    fact: DataFrame, revisions: DataFrame, start: dt.date, end: dt.date
) -> DataFrame:
    """``historical_prices`` for the one period from ``start`` up to ``end``."""
    period = fact.sparkSession.createDataFrame(
        [(start, end)], "period_start date, period_stop date"
    )
    sold = fact.where(F.col("business_date") >= F.lit(start)).where(
        F.col("business_date") < F.lit(end)
    )
    return historical_prices(sold, revisions, period)


def register_price_function(
    fact: DataFrame, revisions: DataFrame, name: str = "historical_price_report"
) -> None:
    """Offer the report to SQL as ``SELECT * FROM name(DATE ..., DATE ...)``.

    The SQL restates ``historical_price_report`` for one period; it too adds lines
    up per product and day before they meet the prices.
    """
    fact.createOrReplaceTempView(f"{name}_fact")
    revisions.createOrReplaceTempView(f"{name}_revisions")
    fact.sparkSession.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(report_start DATE, report_end DATE)
        RETURNS TABLE
        RETURN WITH daily AS (
            SELECT product_key, business_date, count(*) AS line_count, sum(qty) AS qty,
                   sum(revenue_amount) AS printed, sum(qty * unit_price) AS net
            FROM {name}_fact
            WHERE is_revenue AND business_date >= {name}.report_start
              AND business_date < {name}.report_end
            GROUP BY product_key, business_date
        ), priced AS (
            SELECT d.*, r.selling_price, coalesce(d.qty * r.selling_price, d.net) AS listed
            FROM daily d LEFT JOIN {name}_revisions r
              ON r.product_sk = d.product_key
             AND d.business_date BETWEEN r.effective_from AND r.effective_to
        )
        SELECT {name}.report_start AS period_start,
               date_sub({name}.report_end, 1) AS period_end,
               coalesce(sum(line_count), 0) AS revenue_lines,
               coalesce(sum(line_count) FILTER (WHERE selling_price IS NOT NULL), 0)
                 AS lines_using_revision_price,
               coalesce(sum(line_count) FILTER (WHERE selling_price IS NULL), 0)
                 AS lines_using_printed_price,
               cast(round(sum(printed), 2) AS {schemas.MONEY}) AS printed_till_revenue,
               cast(round(sum(listed), 2) AS {schemas.MONEY}) AS historical_price_revenue,
               cast(round(sum(listed) - sum(printed), 2) AS {schemas.MONEY})
                 AS historical_minus_printed
        FROM priced
    """)
