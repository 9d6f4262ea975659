"""Q18-Q22: stages, trials, time to value, plan paths and survival."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions.numbers import count_where, mean, money, pct, rnd
from recurra.functions.rules import customer_tenure_rank, lifecycle_stage
from recurra.plans.shares import with_share


def stage_distribution(dim_customers: DataFrame) -> DataFrame:
    """Q18."""
    stage = lifecycle_stage(F.col("customer_status"), F.col("upgrade_count"))
    grouped = dim_customers.groupBy(stage.alias("lifecycle_stage")).agg(
        F.count("*").alias("customers"),
        money(F.sum("current_mrr")).alias("stage_mrr"),
        rnd(mean(F.col("current_mrr")), 2).alias("avg_mrr"),
    )
    return with_share(grouped, "customers", "pct_of_base").orderBy("lifecycle_stage")


def trial_conversion(dim_customers: DataFrame) -> DataFrame:
    """Q19."""
    return (
        dim_customers.groupBy("is_trial")
        .agg(
            F.count("*").alias("customers"),
            count_where(F.col("converted_from_trial")).alias("converted"),
            rnd(mean(F.col("current_mrr")), 2).alias("avg_mrr"),
        )
        .withColumn("trial_conversion_rate_pct", pct(F.col("converted"), F.col("customers")))
    )


def time_to_value(history: DataFrame, exact: bool = False) -> DataFrame:
    """Q20: days to first payment and to churn, over customers with events.

    The median is approximate with a bounded summary per task; ``exact`` interpolates.
    """
    days = F.col("days_since_signup")
    customers = history.groupBy("customer_id", "has_ever_churned", "has_ever_upgraded").agg(
        F.min(F.when(F.col("is_first_paid_conversion"), days)).alias("to_paid"),
        F.max(F.when(F.col("event_category") == "churn", days)).alias("to_churn"),
    )
    median = F.percentile("to_paid", 0.5) if exact else F.percentile_approx("to_paid", 0.5, 10_000)
    return customers.agg(
        F.count("*").alias("customers"),
        rnd(mean(F.col("to_paid")), 1).alias("avg_days_to_paid"),
        rnd(median).alias("median_days_to_paid"),
        rnd(mean(F.when(F.col("has_ever_churned") == 1, F.col("to_churn"))), 1).alias("avg_days_to_churn"),
        F.sum("has_ever_upgraded").alias("customers_who_upgraded"),
        F.sum("has_ever_churned").alias("customers_who_churned"),
    )


def plan_progression(dim_customers: DataFrame, min_customers: int = 5) -> DataFrame:
    """Q21."""
    return (
        dim_customers.where(F.col("initial_plan_name").isNotNull())
        .groupBy("initial_plan_name", "current_plan_name")
        .agg(
            F.count("*").alias("customers"),
            rnd(mean(F.col("current_mrr")), 2).alias("avg_current_mrr"),
            rnd(mean(F.col("upgrade_count")), 2).alias("avg_upgrades"),
            rnd(mean(F.col("downgrade_count")), 2).alias("avg_downgrades"),
        )
        .where(F.col("customers") >= min_customers)
        .orderBy("initial_plan_name", F.desc("customers"), "current_plan_name")
    )


def tenure_survival(dim_customers: DataFrame) -> DataFrame:
    """Q22."""
    return (
        dim_customers.groupBy("tenure_bucket")
        .agg(
            F.count("*").alias("customers"),
            count_where(F.col("customer_status") != "churned").alias("still_active"),
            rnd(mean(F.col("lifetime_revenue")), 2).alias("avg_lifetime_revenue"),
        )
        .withColumn("survival_rate_pct", pct(F.col("still_active"), F.col("customers")))
        .orderBy(customer_tenure_rank(F.col("tenure_bucket")))
    )
