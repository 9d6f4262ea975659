"""Every subscription event in its customer's timeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions import rules
from recurra.functions.dates import (
    days_between, month_key, months_between_boundaries, quarter_key, weekday_name,
)
from recurra.functions.numbers import money
from recurra.operators.timeline import PART, Steps, sequence
from recurra.settings import Settings

STEPS = Steps(
    "customer_id", ("event_at", "event_id"),
    number="event_sequence",
    lag={"previous_event_type": "event_type", "previous_plan_id": "plan_id"},
    lead={"next_event_type": "event_type", "next_event_date": "event_date"},
    total={"has_ever_churned": ("max", "_churn"), "has_ever_upgraded": ("max", "_up")},
)


def timeline_rows(events: DataFrame) -> DataFrame:
    """What D6 reads of the events: to be arranged by ``STEPS``."""
    category = F.col("event_category")
    return events.select(
        "customer_id", "event_id", "subscription_id", "event_type", "event_category", "event_date", "event_at",
        "plan_id", "mrr_change", "mrr_after",
        (category == "churn").cast("int").alias("_churn"), (category == "expansion").cast("int").alias("_up"),
    )


def customer_subscription_history(
    customers: DataFrame, events: DataFrame, plans: DataFrame, settings: Settings, carried: DataFrame | None = None
) -> DataFrame:
    """One row per event of a known customer, with tenure, neighbours and milestones.

    ``events`` are staged events, or the arranged rows of ``timeline_rows`` with their carries.
    """
    who = customers.select(
        "customer_id", "company_name", "industry", "company_size", "country", "signup_date",
        "acquisition_channel_id", "is_trial",
    )
    rows = events if PART in events.columns else timeline_rows(events)
    rows = sequence(rows, STEPS, carried).drop("_churn", "_up").join(who, "customer_id")
    named = plans.select("plan_id", "plan_name", "plan_tier", F.col("monthly_price").alias("plan_price"))
    on, signup = F.col("event_date"), F.col("signup_date")
    return rows.join(named, "plan_id", "left").withColumns(
        {
            "days_since_signup": days_between(on, signup),
            "months_since_signup": months_between_boundaries(on, signup),
            "is_first_paid_conversion": rules.first_paid_conversion(
                F.col("event_sequence"), F.col("event_category"), F.col("plan_id"), F.col("previous_plan_id")
            ),
            "days_until_next_event": days_between(F.col("next_event_date"), on),
        }
    )


def fct_subscription_events(history: DataFrame, channels: DataFrame) -> DataFrame:
    """The history with its acquisition channel, buckets and calendar parts; a month it was dealt by stays."""
    channel = channels.select(
        F.col("channel_id").alias("acquisition_channel_id"),
        F.col("channel_name").alias("acquisition_channel"),
        F.col("channel_category").alias("acquisition_channel_category"),
        F.col("is_paid").alias("is_paid_acquisition"),
    )
    on, signup = F.col("event_date"), F.col("signup_date")
    return history.join(channel, "acquisition_channel_id", "left").select(
        "event_id", "subscription_id", "customer_id", "event_type", "event_category", "event_date", "event_at",
        "plan_id", "plan_name", "plan_tier", "plan_price",
        money("mrr_change").alias("mrr_change"),
        money("mrr_after").alias("mrr_after"),
        money(F.abs("mrr_change")).alias("mrr_impact_absolute"),
        "company_name", "industry", "company_size", "country", "signup_date", "is_trial",
        "acquisition_channel_id", "acquisition_channel", "acquisition_channel_category", "is_paid_acquisition",
        "days_since_signup", "months_since_signup",
        rules.customer_tenure(F.col("days_since_signup")).alias("tenure_bucket"),
        "event_sequence", "previous_event_type", "previous_plan_id", "next_event_type", "next_event_date",
        "days_until_next_event", "is_first_paid_conversion", "has_ever_churned", "has_ever_upgraded",
        F.year(on).alias("event_year"),
        F.month(on).alias("event_month"),
        F.quarter(on).alias("event_quarter"),
        month_key(on).alias("event_month_key"),
        quarter_key(on).alias("event_quarter_key"),
        weekday_name(on).alias("event_day_of_week"),
        month_key(signup).alias("signup_cohort_month"),
        quarter_key(signup).alias("signup_cohort_quarter"),
        *[c for c in history.columns if c == "month_key_part"],
    )
