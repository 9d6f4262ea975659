"""D13, D22, D27 and weekly cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.functions.dates import (
    days_between, month_key, month_label, month_start, months_between_boundaries, week_start,
)
from recurra.functions.numbers import mean, money, pct, rnd
from recurra.settings import Settings


def cohort_sizes(customers: DataFrame) -> DataFrame:
    """Customers per signup month; a repeated id counts once."""
    month = month_start(F.col("signup_date")).alias("cohort_month")
    return customers.select("customer_id", month).distinct().groupBy("cohort_month").agg(
        F.count("customer_id").alias("cohort_size")
    )


def cohort_retention(movements: DataFrame, customers: DataFrame, settings: Settings) -> DataFrame:
    """One row per signup month and month since signup.

    ``m0`` figures come from the first observed period, which need not be month 0.
    """
    who = customers.select("customer_id", month_start(F.col("signup_date")).alias("cohort_month"))
    age = months_between_boundaries(F.col("month_date"), F.col("cohort_month"))
    periods = (
        movements.where(F.col("ending_mrr") > 0)
        .select("customer_id", "month_date", "ending_mrr")
        .join(who, "customer_id")
        .withColumn("months_since_signup", age)
        .where(F.col("months_since_signup").between(0, settings.max_cohort_months))
        .groupBy("cohort_month", "months_since_signup")
        .agg(
            F.count("customer_id").alias("active_customers"),
            F.sum("ending_mrr").alias("total_mrr"),
            mean(F.col("ending_mrr")).alias("avg_mrr"),
        )
        .join(cohort_sizes(customers), "cohort_month")
    )
    w = Window.partitionBy("cohort_month").orderBy("months_since_signup")
    size, active, cohort = F.col("cohort_size"), F.col("active_customers"), F.col("cohort_month")
    rows = periods.withColumns(
        {
            "m0_customers": F.first("active_customers").over(w),
            "m0_mrr": F.first("total_mrr").over(w),
            "previous_period_customers": F.lag("active_customers").over(w),
            "retained_mrr": money("total_mrr"),
        }
    )
    return rows.select(
        "cohort_month",
        month_key(cohort).alias("cohort_month_key"),
        month_label(cohort).alias("cohort_month_name"),
        "months_since_signup",
        F.concat(F.lit("M"), F.col("months_since_signup").cast("string")).alias("period_label"),
        "cohort_size",
        "active_customers",
        pct(active, size).alias("retention_rate"),
        "retained_mrr",
        rnd(F.col("avg_mrr"), 2).alias("avg_mrr_per_customer"),
        pct(active, F.col("m0_customers")).alias("retention_from_m0"),
        pct(F.col("retained_mrr"), F.col("m0_mrr")).alias("mrr_retention_from_m0"),
        (size - active).alias("churned_customers"),
        pct(size - active, size).alias("cumulative_churn_rate"),
        "previous_period_customers",
        (active - F.col("previous_period_customers")).alias("customers_change"),
    )


def _period(period: str) -> tuple:
    if period == "month":
        return month_start, months_between_boundaries
    if period == "week":
        def weeks(later: Column, earlier: Column) -> Column:
            return (days_between(later, earlier) / 7).cast("int")

        return week_start, weeks
    raise ValueError(f"period must be 'month' or 'week', not {period!r}")


def activity_retention(activity: DataFrame, period: str = "month") -> DataFrame:
    """Retention straight from (customer_id, signup_date, activity_date) rows.

    Every customer with a row belongs to its cohort; activity before signup keeps its
    negative period number. Rows shrink to one per customer and period before counting.
    """
    start, gap = _period(period)
    seen = activity.select(
        "customer_id",
        start(F.col("signup_date")).alias("cohort"),
        start(F.col("activity_date")).alias("active_in"),
    ).distinct()
    sizes = seen.select("customer_id", "cohort").distinct().groupBy("cohort").agg(F.count("*").alias("cohort_customers"))
    return (
        seen.withColumn("period_no", gap(F.col("active_in"), F.col("cohort")))
        .groupBy("cohort", "period_no")
        .agg(F.count("customer_id").alias("active_customers"))
        .join(sizes, "cohort")
        .select(
            "cohort", "period_no", "active_customers", "cohort_customers",
            pct(F.col("active_customers"), F.col("cohort_customers")).alias("retention_pct"),
        )
    )
