"""Monthly revenue against finance, with known differences explained."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlake import schemas

# Wording of the reconciliation report.
MATCH, BUG = "match", "pipeline bug"
NO_OWNER = "none"
BUG_OWNER = "data engineering: investigate and repair pipeline"
MATCH_TEXT = "Pipeline revenue matches the finance amount."
KNOWN_DIFFERENCES = (
    ("2024-03", "definition difference",
     "finance: decide whether institutional invoice belongs in till revenue",
     "Finance includes the 486250.00 institutional order invoiced outside the till."),
    ("2024-07", "source data",
     "store operations: recover or explain S07 missing export days",
     "S07 exports are absent for 2024-07-09 through 2024-07-11; finance has manually "
     "supplied those days."),
    ("2024-12", "definition difference",
     "finance: align bill-level rounding policy",
     "Finance rounds each bill to the rupee; the pipeline sums line amounts to cents."),
)


def known_differences(spark: SparkSession, rows=KNOWN_DIFFERENCES) -> DataFrame:
    return spark.createDataFrame(
        list(rows), "month string, known_cause string, known_owner string, known_text string"
    )


def monthly_revenue(fact: DataFrame) -> DataFrame:
    return (
        fact.where("is_revenue")
        .groupBy(F.date_format("business_date", "yyyy-MM").alias("month"))
        .agg(F.round(F.sum("revenue_amount"), 2).cast(schemas.MONEY).alias("pipeline_revenue"))
    )


def reconcile(
    pipeline: DataFrame, finance: DataFrame, known: DataFrame, how: str = "inner"
) -> DataFrame:
    """Variance per month with its cause, owner and explanation.

    ``how='full'`` also shows months that only one side has, with a null variance.
    """
    compared = (
        finance.select("month", F.col("revenue_inr").cast(schemas.MONEY).alias("finance_revenue"))
        .join(pipeline, "month", how)
        .withColumn("variance", F.round(F.col("finance_revenue") - F.col("pipeline_revenue"), 2)
                    .cast(schemas.MONEY))
        .join(known, "month", "left")
    )
    matches = F.abs("variance") < 0.01

    def labelled(match: str, known_column: str, other: str) -> Column:
        return F.when(matches, match).otherwise(F.coalesce(F.col(known_column), F.lit(other)))

    return compared.select(
        "month", "pipeline_revenue", "finance_revenue", "variance",
        labelled(MATCH, "known_cause", BUG).alias("cause"),
        labelled(NO_OWNER, "known_owner", BUG_OWNER).alias("owner_to_take_back"),
        F.coalesce("known_text", F.lit(MATCH_TEXT)).alias("explanation"),
    )
