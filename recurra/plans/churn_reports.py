"""Q5-Q10: when, where and after what customers churn, and who is at risk."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions import rules
from recurra.functions.dates import days_between
from recurra.functions.numbers import count_where, mean, money, pct, rnd, share_true
from recurra.plans.shares import with_share
from recurra.settings import Settings


def monthly_churn(events: DataFrame, fct_mrr: DataFrame) -> DataFrame:
    """Q5: churned customers and MRR against the same month's active base."""
    churned = (
        events.where(F.col("event_category") == "churn")
        .groupBy("event_month_key", "customer_id")
        .agg(F.sum(F.abs("mrr_change")).alias("lost"))
        .groupBy(F.col("event_month_key").alias("month"))
        .agg(F.count("customer_id").alias("churned_customers"), F.sum("lost").alias("churned_mrr"))
    )
    base = fct_mrr.select(
        F.col("month_key").alias("month"),
        F.col("active_customers").alias("beginning_customers"),
        F.col("active_mrr").alias("beginning_mrr"),
    )
    return (
        churned.join(base, "month", "left")
        .select(
            "month", "churned_customers", "beginning_customers",
            pct(F.col("churned_customers"), F.col("beginning_customers"), 2).alias("customer_churn_rate"),
            money("churned_mrr").alias("churned_mrr"),
            money("beginning_mrr").alias("beginning_mrr"),
            pct(F.col("churned_mrr"), F.col("beginning_mrr"), 2).alias("mrr_churn_rate"),
        )
        .orderBy("month")
    )


def churn_by_segment(dim_customers: DataFrame, min_customers: int = 10) -> DataFrame:
    """Q6."""
    keys = ["industry", "company_size", "initial_plan_name", "acquisition_channel", "is_paid_acquisition"]
    gone = F.col("has_churned")
    return (
        dim_customers.groupBy(*keys)
        .agg(
            F.count("*").alias("total_customers"),
            count_where(gone).alias("churned_customers"),
            rnd(share_true(gone) * 100.0, 1).alias("churn_rate"),
            rnd(mean(F.when(gone, F.col("days_since_signup")))).alias("avg_days_to_churn"),
            rnd(mean(F.when(gone, F.col("lifetime_revenue"))), 2).alias("avg_churned_ltv"),
            rnd(mean(F.when(~gone, F.col("lifetime_revenue"))), 2).alias("avg_retained_ltv"),
        )
        .where(F.col("total_customers") >= min_customers)
        .orderBy(F.desc("churn_rate"), *keys)
    )


def churn_timing(events: DataFrame) -> DataFrame:
    """Q7: churn events by customer tenure."""
    lost = F.abs("mrr_change")
    grouped = (
        events.where(F.col("event_category") == "churn")
        .groupBy("tenure_bucket")
        .agg(
            F.count("*").alias("churn_count"),
            rnd(mean(lost), 2).alias("avg_mrr_lost"),
            money(F.sum(lost)).alias("total_mrr_lost"),
        )
    )
    return with_share(grouped, "churn_count", "pct_of_total_churn").orderBy(
        rules.customer_tenure_rank(F.col("tenure_bucket"))
    )


def events_before_churn(events: DataFrame, window_days: int = 90) -> DataFrame:
    """Q8: what happened in the ``window_days`` before a churn.

    Both sides shrink to one row per customer, day and type with a multiplicity. Days
    fall into blocks as long as the window, and a churn day meets only the one or two
    blocks its window covers, so a join group holds at most a few windows of days
    however many events a customer has.
    """
    daily = events.groupBy(
        "customer_id", F.col("event_date").alias("day"), "event_type", "event_category"
    ).agg(F.count("*").alias("n"))
    churn_day, first_day = F.col("churn_day"), F.date_sub("churn_day", window_days)

    def block_of(day):
        return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / window_days)

    churns = (
        daily.where(F.col("event_category") == "churn")
        .groupBy("customer_id", F.col("day").alias("churn_day"))
        .agg(F.sum("n").alias("churns"))
        .withColumn(
            "block", F.explode(F.sequence(block_of(first_day), block_of(F.date_sub(churn_day, 1))))
        )
    )
    before = F.datediff("churn_day", "day")
    pairs = (
        daily.withColumn("block", block_of(F.col("day")))
        .join(churns, ["customer_id", "block"])
        .where(before.between(1, window_days))
    )
    return (
        pairs.withColumn("timing", rules.pre_churn_bucket(before))
        .groupBy("timing", "event_type", "customer_id")
        .agg(F.sum(F.col("n") * F.col("churns")).alias("occurrences"))
        .groupBy("timing", "event_type")
        .agg(
            F.sum("occurrences").alias("occurrence_count"), F.count("customer_id").alias("unique_customers")
        )
        .orderBy(rules.pre_churn_rank(F.col("timing")), F.desc("occurrence_count"), "event_type")
    )


def at_risk_customers(dim_customers: DataFrame, settings: Settings, top: int = 100) -> DataFrame:
    """Q9: paying customers with a positive quick risk score, highest first."""
    idle = days_between(settings.as_of, F.col("last_payment_date"))
    tier = F.col("current_plan_tier")

    def points(cond, n):
        return F.when(cond, n).otherwise(0)

    score = (
        points(F.col("downgrade_count") > 0, 20)
        + points(F.col("failed_payments") > 0, 15)
        + F.when(idle > 45, 25).when(idle > 30, 10).otherwise(0)
        + points(F.col("days_since_signup") <= 90, 15)
        - points(F.col("upgrade_count") > 0, 15)
        - F.when(tier == "enterprise", 10).when(tier == "business", 5).otherwise(0)
    )
    return (
        dim_customers.where(F.col("customer_status") == "active_paying")
        .select(
            "customer_id", "company_name", "current_mrr", "days_since_signup",
            idle.alias("days_since_last_payment"), "downgrade_count", "failed_payments",
            score.alias("risk_score"),
        )
        .withColumn("risk_category", rules.quick_risk_label(F.col("risk_score")))
        .where(F.col("risk_score") > 0)
        .orderBy(F.desc("risk_score"), F.desc("current_mrr"), "customer_id")
        .limit(top)
    )


def churned_versus_retained(dim_customers: DataFrame) -> DataFrame:
    """Q10: profile of both groups, one row each even when a group is empty."""
    gone = F.col("has_churned")
    segment = F.when(gone, "Churned").when(~gone & (F.col("customer_status") == "active_paying"), "Retained")
    groups = dim_customers.sparkSession.createDataFrame(pa.table({"segment": ["Churned", "Retained"]}))
    profile = (
        dim_customers.withColumn("segment", segment)
        .where(F.col("segment").isNotNull())
        .groupBy("segment")
        .agg(
            F.count("*").alias("customers"),
            rnd(mean(F.col("days_since_signup"))).alias("avg_tenure_days"),
            rnd(mean(F.col("lifetime_revenue")), 2).alias("avg_lifetime_revenue"),
            rnd(mean(F.col("upgrade_count")), 2).alias("avg_upgrades"),
            rnd(mean(F.col("downgrade_count")), 2).alias("avg_downgrades"),
            rnd(share_true(F.col("is_paid_acquisition")) * 100.0, 1).alias("pct_paid_acquisition"),
            rnd(share_true(F.col("is_trial")) * 100.0, 1).alias("pct_started_trial"),
            rnd(share_true(F.col("converted_from_trial")) * 100.0, 1).alias("pct_trial_converted"),
        )
    )
    return groups.join(profile, "segment", "left").withColumn(
        "customers", F.coalesce(F.col("customers"), F.lit(0))
    )
