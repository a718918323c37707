"""A lookup side that was counted to be too large is never broadcast by an estimate."""

from pyspark.sql import functions as F

from ledgerlake.operators import temporal
from ledgerlake.operators.temporal import newest_segments
from ledgerlake.plans import reports


def test_prices_above_the_count_are_not_broadcast(spark, monkeypatch):
    sizes = temporal.version_counts
    monkeypatch.setattr(temporal, "version_counts", lambda versions, key: (10**6, sizes(versions, key)[1]))
    day = F.lit("2024-03-05").cast("date")
    fact = spark.range(50).select(
        (F.col("id") % 20).alias("product_key"), day.alias("business_date"), F.lit(True).alias("is_revenue"),
        F.lit(2).cast("decimal(18,3)").alias("qty"), F.lit(10).cast("decimal(18,2)").alias("unit_price"),
        F.lit(20).cast("decimal(18,2)").alias("revenue_amount"),
    )
    revisions = spark.range(10).select(
        F.col("id").alias("product_sk"), F.lit(12).cast("decimal(12,2)").alias("selling_price"),
        F.lit("2024-01-01").cast("date").alias("effective_from"), F.lit("9999-12-31").cast("date").alias("effective_to"),
    )
    periods = spark.sql("SELECT DATE '2024-03-01' AS period_start, DATE '2024-04-01' AS period_stop")
    found = reports.historical_prices(fact, revisions, periods)
    plan = found._jdf.queryExecution().executedPlan().toString()
    prices = [line for line in plan.splitlines() if "Join" in line and "salt" in line]
    assert prices and all("SortMergeJoin" in line for line in prices)
    row = found.first()
    assert (row.revenue_lines, row.lines_using_revision_price) == (50, 30)
    assert (row.printed_till_revenue, row.historical_price_revenue) == (1000, 1120)


def test_versions_are_cut_without_a_broadcast(spark):
    versions = spark.createDataFrame(
        [("a", 1, "2024-01-01", "9999-12-31"), ("a", 2, "2024-02-01", "2024-02-29"), ("b", 3, "2024-01-01", "2024-01-31")],
        "code string, sk int, starts string, ends string",
    ).withColumns({"starts": F.col("starts").cast("date"), "ends": F.col("ends").cast("date")})
    cut = newest_segments(versions, "code", "starts", "ends")
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan
    assert {(row.code, row.sk, str(row.starts)) for row in cut.collect()} == {
        ("a", 1, "2024-01-01"), ("a", 2, "2024-02-01"), ("a", 1, "2024-03-01"), ("b", 3, "2024-01-01")}
