"""Q1-Q4: cohort retention, revenue retention, comparison and behaviour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions.dates import month_key, month_start, months_between_boundaries, parse_month
from recurra.functions.numbers import count_where, mean, money, pct, rnd, share_true
from recurra.functions.rules import engagement_score
from recurra.operators.retention import cohort_sizes


def retention_matrix(dim_customers: DataFrame, events: DataFrame, periods: int = 12) -> DataFrame:
    """Q1: share of each signup month still paying, by month since signup."""
    cohort = dim_customers.select("customer_id", month_start(F.col("signup_date")).alias("cohort_month"))
    active = (
        events.where(F.col("mrr_after") > 0)
        .select("customer_id", month_start(F.col("event_date")).alias("activity_month"))
        .distinct()
    )
    return (
        active.join(cohort, "customer_id")
        .where(F.col("activity_month") >= F.col("cohort_month"))
        .withColumn("month_number", months_between_boundaries(F.col("activity_month"), F.col("cohort_month")))
        .where(F.col("month_number") <= periods)
        .groupBy("cohort_month", "month_number")
        .agg(F.count("customer_id").alias("active_customers"))
        .join(cohort_sizes(dim_customers), "cohort_month")
        .select(
            month_key(F.col("cohort_month")).alias("cohort"), "cohort_size", "month_number", "active_customers",
            pct(F.col("active_customers"), F.col("cohort_size")).alias("retention_pct"),
        )
        .orderBy("cohort", "month_number")
    )


def revenue_retention(dim_customers: DataFrame, events: DataFrame, periods: int = 12) -> DataFrame:
    """Q2: customers and MRR of each cohort month against its month 0."""
    # One row per customer and month first, so no customer's events gather in one task.
    per_customer = (
        events.where(F.col("mrr_after") > 0)
        .groupBy("customer_id", month_start(F.col("event_date")).alias("mrr_month"))
        .agg(F.sum("mrr_after").alias("mrr"))
    )
    cohort = dim_customers.select("customer_id", F.col("signup_cohort_month").alias("cohort_month"))
    number = months_between_boundaries(F.col("mrr_month"), parse_month(F.col("cohort_month")))
    months = (
        per_customer.join(cohort, "customer_id")
        .withColumn("month_number", number)
        .where(F.col("month_number").between(0, periods))
        .groupBy("cohort_month", "month_number")
        .agg(F.sum("mrr").alias("total_mrr"), F.count("customer_id").alias("active_customers"))
    )
    base = months.where(F.col("month_number") == 0).select(
        "cohort_month", F.col("total_mrr").alias("_m0"), F.col("active_customers").alias("m0_customers")
    )
    return (
        months.join(base, "cohort_month")
        .select(
            "cohort_month", "month_number", "active_customers", "m0_customers",
            pct(F.col("active_customers"), F.col("m0_customers")).alias("customer_retention_pct"),
            money("total_mrr").alias("mrr"),
            money("_m0").alias("m0_mrr"),
            pct(F.col("total_mrr"), F.col("_m0")).alias("net_revenue_retention_pct"),
        )
        .orderBy("cohort_month", "month_number")
    )


def cohort_comparison(dim_customers: DataFrame) -> DataFrame:
    """Q3."""
    paying = F.col("customer_status") == "active_paying"
    total = F.col("total_customers")
    return (
        dim_customers.groupBy(F.col("signup_cohort_month").alias("cohort"))
        .agg(
            F.count("customer_id").alias("total_customers"),
            count_where(paying).alias("active_customers"),
            count_where(F.col("has_churned")).alias("churned_customers"),
            rnd(mean(F.col("lifetime_revenue")), 2).alias("avg_ltv"),
            rnd(mean(F.when(paying, F.col("current_mrr"))), 2).alias("avg_current_mrr"),
            rnd(mean(F.col("days_since_signup"))).alias("avg_tenure_days"),
            count_where(F.col("upgrade_count") > 0).alias("customers_upgraded"),
            count_where(F.col("converted_from_trial")).alias("trial_conversions"),
        )
        .withColumns(
            {
                "current_retention_pct": pct(F.col("active_customers"), total),
                "churn_pct": pct(F.col("churned_customers"), total),
                "upgrade_pct": pct(F.col("customers_upgraded"), total),
                "trial_conversion_pct": pct(F.col("trial_conversions"), total),
            }
        )
        .orderBy("cohort")
    )


def cohort_behaviour(dim_customers: DataFrame, min_customers: int = 10) -> DataFrame:
    """Q4: retention and engagement by starting plan, size, channel kind and trial."""
    score = engagement_score(F.col("upgrade_count"), F.col("downgrade_count"), F.col("customer_status"))
    keys = ["initial_plan_name", "company_size", "is_paid_acquisition", "is_trial"]
    return (
        dim_customers.groupBy(*keys)
        .agg(
            F.count("*").alias("customers"),
            rnd(share_true(~F.col("has_churned")) * 100.0, 1).alias("retention_rate"),
            rnd(mean(score), 2).alias("avg_engagement_score"),
            rnd(share_true(F.col("converted_from_trial")) * 100.0, 1).alias("trial_conversion_rate"),
        )
        .where(F.col("customers") >= min_customers)
        .orderBy(F.desc("retention_rate"), *keys)
    )
