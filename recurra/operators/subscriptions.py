"""The subscription dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions import rules
from recurra.functions.dates import month_key, quarter_key
from recurra.functions.numbers import count_where, dbl, money, rnd
from recurra.settings import Settings


def subscription_event_metrics(events: DataFrame) -> DataFrame:
    """D20."""
    kind = F.col("event_category")
    return events.groupBy("subscription_id").agg(
        F.count("*").alias("total_events"),
        F.min("event_at").alias("first_event_at"),
        F.max("event_at").alias("last_event_at"),
        count_where(kind == "expansion").alias("upgrade_count"),
        count_where(kind == "contraction").alias("downgrade_count"),
    )


def dim_subscriptions(
    subscriptions: DataFrame, customers: DataFrame, events: DataFrame, plans: DataFrame, settings: Settings
) -> DataFrame:
    """One row per subscription."""
    who = customers.select("customer_id", "company_name", "industry", "company_size", "country")
    plan = plans.select(
        "plan_id", "plan_name", "plan_tier",
        F.col("monthly_price").alias("plan_monthly_price"),
        F.col("annual_price").alias("plan_annual_price"),
        F.col("storage_gb").alias("plan_storage_gb"),
        F.col("max_users").alias("plan_max_users"),
    )
    wide = (
        subscriptions.join(who, "customer_id", "left")
        .join(subscription_event_metrics(events), "subscription_id", "left")
        .join(plan, "plan_id", "left")
    )
    cycle, status, days = F.col("billing_cycle"), F.col("status"), F.col("subscription_length_days")
    monthly, annual = F.col("plan_monthly_price"), F.col("plan_annual_price")
    start, mrr, tier = F.col("start_date"), F.col("mrr"), F.col("plan_tier")
    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("total_events", "upgrade_count", "downgrade_count")]
    return wide.select(
        "subscription_id", "customer_id", "company_name", "industry", "company_size", "country",
        "plan_id", "plan_name", "plan_tier", "plan_monthly_price", "plan_annual_price", "plan_storage_gb",
        "plan_max_users", "status", "billing_cycle",
        money(mrr).alias("mrr"),
        money(mrr * 12).alias("arr"),
        rules.effective_monthly_price(cycle, monthly, annual).alias("effective_monthly_price"),
        rules.annual_discount_pct(cycle, monthly, annual).alias("annual_discount_pct"),
        "start_date", "end_date", "created_at", "updated_at", "subscription_length_days",
        rnd(dbl(days) / 30.44, 1).alias("subscription_length_months"),
        rules.subscription_tenure(days).alias("tenure_bucket"),
        *counts,
        "first_event_at", "last_event_at",
        (status == "active").alias("is_active"),
        (status == "churned").alias("is_churned"),
        (cycle == "annual").alias("is_annual"),
        (mrr > 0).alias("is_paying"),
        (tier == "free").alias("is_free_tier"),
        (tier == "enterprise").alias("is_enterprise"),
        month_key(start).alias("subscription_cohort_month"),
        quarter_key(start).alias("subscription_cohort_quarter"),
        rules.churn_timing(status, days).alias("churn_timing"),
    )
