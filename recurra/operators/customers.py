"""The customer dimension and the aggregates it is made of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions import rules
from recurra.functions.dates import days_between, month_key, months_between_boundaries, quarter_key
from recurra.functions.numbers import count_where, mean, money, pct, rnd, sum_where
from recurra.settings import Settings


def subscription_rollup(subscriptions: DataFrame) -> DataFrame:
    """Latest subscription and history of each customer, in one pass.

    The latest row is the greatest by (created_at, subscription_id). An aggregate, unlike
    a ranked window, combines before the shuffle, so a customer with very many
    subscriptions stays spread out. ``subscription_id`` is unique (checked by T1), so a
    plain count is the distinct count.
    """
    row = F.struct(
        "created_at", "subscription_id", "plan_id", "status", "billing_cycle", "mrr", "start_date",
        "subscription_length_days",
    )
    return subscriptions.groupBy("customer_id").agg(
        F.max(row).alias("latest"),
        F.count("subscription_id").alias("total_subscriptions"),
        F.min("start_date").alias("first_subscription_date"),
        F.max("start_date").alias("latest_subscription_date"),
        count_where(F.col("status") == "churned").alias("churn_count"),
    )


_CURRENT = {
    "current_subscription_id": "subscription_id",
    "current_plan_id": "plan_id",
    "current_status": "status",
    "current_billing_cycle": "billing_cycle",
    "current_mrr": "mrr",
    "current_subscription_start": "start_date",
    "current_subscription_tenure_days": "subscription_length_days",
}
_HISTORY = ["total_subscriptions", "first_subscription_date", "latest_subscription_date", "churn_count"]


def _current_columns() -> list:
    return [F.col(f"latest.{source}").alias(name) for name, source in _CURRENT.items()]


def current_subscription(subscriptions: DataFrame) -> DataFrame:
    """Each customer's most recently created subscription."""
    return subscription_rollup(subscriptions).select("customer_id", *_current_columns())


def subscription_history(subscriptions: DataFrame) -> DataFrame:
    """D17."""
    return subscription_rollup(subscriptions).select("customer_id", *_HISTORY)


def event_metrics(events: DataFrame) -> DataFrame:
    """D18."""
    kind, on = F.col("event_category"), F.col("event_date")
    return events.groupBy("customer_id").agg(
        F.count("*").alias("total_events"),
        count_where(kind == "expansion").alias("upgrade_count"),
        count_where(kind == "contraction").alias("downgrade_count"),
        count_where(kind == "churn").alias("churn_events"),
        F.max(F.when(kind == "expansion", on)).alias("last_upgrade_date"),
        F.max(F.when(kind == "contraction", on)).alias("last_downgrade_date"),
        F.max(F.when(kind == "churn", on)).alias("last_churn_date"),
        F.max("mrr_after").alias("peak_mrr"),
    )


def payment_metrics(payments: DataFrame) -> DataFrame:
    """D19."""
    ok, amount = F.col("is_successful"), F.col("amount")
    return payments.groupBy("customer_id").agg(
        F.count("*").alias("total_payments"),
        count_where(ok).alias("successful_payments"),
        count_where(F.col("is_failed")).alias("failed_payments"),
        sum_where(ok, amount).alias("lifetime_revenue"),
        mean(F.when(ok, amount)).alias("avg_payment_amount"),
        F.min("payment_date").alias("first_payment_date"),
        F.max("payment_date").alias("last_payment_date"),
    )


def dim_customers(
    customers: DataFrame,
    subscriptions: DataFrame,
    events: DataFrame,
    payments: DataFrame,
    channels: DataFrame,
    plans: DataFrame,
    settings: Settings,
) -> DataFrame:
    """One row per customer; three aggregates by customer_id, then left joins on that key."""
    today = settings.as_of
    wide = customers
    for side in (
        subscription_rollup(subscriptions).select("customer_id", *_current_columns(), *_HISTORY),
        event_metrics(events),
        payment_metrics(payments),
    ):
        wide = wide.join(side, "customer_id", "left")
    channel = channels.select(
        F.col("channel_id").alias("acquisition_channel_id"),
        F.col("channel_name").alias("acquisition_channel"),
        F.col("channel_category").alias("acquisition_channel_category"),
        F.col("is_paid").alias("is_paid_acquisition"),
    )
    first_plan = plans.select(
        F.col("plan_id").alias("initial_plan_id"), F.col("plan_name").alias("initial_plan_name")
    )
    plan_now = plans.select(
        F.col("plan_id").alias("current_plan_id"),
        F.col("plan_name").alias("current_plan_name"),
        F.col("plan_tier").alias("current_plan_tier"),
    )
    wide = (
        wide.join(channel, "acquisition_channel_id", "left")
        .join(first_plan, "initial_plan_id", "left")
        .join(plan_now, "current_plan_id", "left")
    )

    def zero(name: str, kind: str = "bigint"):
        return F.coalesce(F.col(name), F.lit(0).cast(kind)).alias(name)

    amount = "decimal(18,4)"
    status, mrr, signup = F.col("current_status"), F.col("current_mrr"), F.col("signup_date")
    mrr_now = F.coalesce(mrr, F.lit(0).cast(amount))
    age = days_between(today, signup)
    churns = F.col("churn_count")
    return wide.select(
        "customer_id", "company_name", "email", "industry", "company_size", "country", "signup_date",
        "signed_up_at", "acquisition_channel_id", "acquisition_channel", "acquisition_channel_category",
        "is_paid_acquisition", "initial_plan_id", "initial_plan_name", "is_trial", "trial_end_date",
        rules.trial_converted(F.col("is_trial"), status, mrr).alias("converted_from_trial"),
        "current_subscription_id", "current_plan_id", "current_plan_name", "current_plan_tier",
        "current_status", "current_billing_cycle",
        money(mrr_now).alias("current_mrr"),
        money(mrr_now * 12).alias("current_arr"),
        "current_subscription_start", "current_subscription_tenure_days",
        rules.customer_status(status, mrr).alias("customer_status"),
        age.alias("days_since_signup"),
        months_between_boundaries(today, signup).alias("months_since_signup"),
        rules.customer_tenure(age).alias("tenure_bucket"),
        zero("total_subscriptions"),
        "first_subscription_date", "latest_subscription_date",
        F.coalesce(churns, F.lit(0)).alias("times_churned"),
        (churns > 0).alias("has_churned"),
        ((churns > 0) & (status == "active")).alias("is_resurrected"),
        zero("total_events"), zero("upgrade_count"), zero("downgrade_count"),
        "last_upgrade_date", "last_downgrade_date", "last_churn_date",
        money(F.coalesce(F.col("peak_mrr"), F.lit(0).cast(amount))).alias("peak_mrr"),
        zero("total_payments"), zero("successful_payments"), zero("failed_payments"),
        money(F.coalesce(F.col("lifetime_revenue"), F.lit(0).cast(amount))).alias("lifetime_revenue"),
        rnd(F.coalesce(F.col("avg_payment_amount"), F.lit(0.0)), 2).alias("avg_payment_amount"),
        "first_payment_date", "last_payment_date",
        pct(F.col("successful_payments"), F.col("total_payments"), 2).alias("payment_success_rate"),
        month_key(signup).alias("signup_cohort_month"),
        quarter_key(signup).alias("signup_cohort_quarter"),
        F.year(signup).alias("signup_year"),
        rules.customer_health(
            status, F.col("upgrade_count"), F.col("downgrade_count"), F.col("failed_payments"),
            F.col("successful_payments"), days_between(today, F.col("last_payment_date")),
        ).alias("health_status"),
    )
