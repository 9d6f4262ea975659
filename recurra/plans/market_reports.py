"""Q32-Q36: industries, sizes, countries and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions.numbers import count_where, mean, money, pct, rnd, share_true
from recurra.functions.rules import segment_label
from recurra.plans.shares import with_share

PAYING = "active_paying"


def revenue_by_industry(dim_customers: DataFrame) -> DataFrame:
    """Q32."""
    grouped = dim_customers.groupBy("industry").agg(
        F.count("*").alias("customers"),
        count_where(F.col("customer_status") == PAYING).alias("active_paying"),
        money(F.sum("current_mrr")).alias("current_mrr"),
        rnd(mean(F.col("current_mrr")), 2).alias("avg_mrr"),
        rnd(mean(F.col("lifetime_revenue")), 2).alias("avg_ltv"),
    )
    return with_share(grouped, "current_mrr", "pct_of_mrr").orderBy(F.desc("current_mrr"), "industry")


def penetration_by_size(dim_customers: DataFrame) -> DataFrame:
    """Q33."""
    return (
        dim_customers.groupBy("company_size")
        .agg(
            F.count("*").alias("customers"),
            pct(count_where(F.col("customer_status") == PAYING), F.count("*")).alias("paying_rate_pct"),
            rnd(mean(F.col("current_mrr")), 2).alias("arpu"),
            money(F.sum("current_mrr")).alias("segment_mrr"),
            rnd(mean(F.col("lifetime_revenue")), 2).alias("avg_ltv"),
        )
        .orderBy(F.desc("arpu"), "company_size")
    )


def revenue_by_country(dim_customers: DataFrame) -> DataFrame:
    """Q34."""
    grouped = dim_customers.groupBy("country").agg(
        F.count("*").alias("customers"),
        money(F.sum("current_mrr")).alias("current_mrr"),
        rnd(share_true(F.col("has_churned")) * 100.0, 1).alias("churn_rate_pct"),
    )
    return with_share(grouped, "current_mrr", "pct_of_mrr").orderBy(F.desc("current_mrr"), "country")


def industry_by_tier(dim_customers: DataFrame) -> DataFrame:
    """Q35."""
    grouped = (
        dim_customers.where(F.col("current_plan_tier").isNotNull())
        .groupBy("industry", "current_plan_tier")
        .agg(F.count("*").alias("customers"), money(F.sum("current_mrr")).alias("current_mrr"))
    )
    return with_share(grouped, "customers", "pct_within_industry", ["industry"]).orderBy(
        "industry", F.desc("current_mrr"), "current_plan_tier"
    )


def segment_health(dim_customers: DataFrame, min_customers: int = 10) -> DataFrame:
    """Q36, with the paying rate that the segment chart adds."""
    return (
        dim_customers.groupBy("company_size", "industry")
        .agg(
            F.count("*").alias("customers"),
            rnd(mean(F.col("current_mrr")), 2).alias("arpu"),
            rnd(share_true(F.col("has_churned")) * 100.0, 1).alias("churn_rate_pct"),
            money(F.sum("current_mrr")).alias("segment_mrr"),
            pct(count_where(F.col("customer_status") == PAYING), F.count("*")).alias("paying_rate_pct"),
        )
        .where(F.col("customers") >= min_customers)
        .withColumn(
            "segment_label",
            segment_label(F.col("churn_rate_pct"), F.col("arpu"), F.col("customers"), F.col("segment_mrr")),
        )
        .orderBy(F.desc("segment_mrr"), "company_size", "industry")
    )
