"""Lifecycle events and subscriptions derived from a customer's plan states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.operators.timeline import Steps, sequence

ORDER = ["state_at", "state_id"]


def steps(key: str) -> Steps:
    """Previous state and running number of subscriptions: one starts whenever a plan follows no plan."""
    return Steps(
        key, tuple(ORDER),
        lag={"previous_plan_id": "plan_id", "previous_mrr": "mrr"},
        running={
            "subscription_no": (
                ("plan_id",), lambda now, before: (now("plan_id").isNotNull() & before("plan_id").isNull()).cast("int")
            )
        },
    )


def number_subscriptions(states: DataFrame, key: str, carried: DataFrame | None = None) -> DataFrame:
    """Previous state and subscription number of every plan state; states before the first plan carry number 0."""
    return sequence(states, steps(key), carried)


def lifecycle_events(timeline: DataFrame) -> DataFrame:
    """Started / reactivated / upgraded / downgraded / churned / renewed rows.

    States without a plan that follow no plan are not events. A churn event carries
    the plan that was left.
    """
    now, before = F.col("plan_id"), F.col("previous_plan_id")
    kind = (
        F.when(now.isNull(), "subscription_churned")
        .when(before.isNull() & (F.col("subscription_no") == 1), "subscription_started")
        .when(before.isNull(), "subscription_reactivated")
        .when(F.col("mrr") > F.col("previous_mrr"), "subscription_upgraded")
        .when(F.col("mrr") < F.col("previous_mrr"), "subscription_downgraded")
        .otherwise("subscription_renewed")
    )
    return timeline.where(now.isNotNull() | before.isNotNull()).withColumns(
        {
            "event_type": kind,
            "event_plan_id": F.coalesce(now, before),
            "mrr_change": F.col("mrr") - F.coalesce(F.col("previous_mrr"), F.lit(0)),
        }
    )


def subscriptions_of(events: DataFrame, key: str) -> DataFrame:
    """Final state of every subscription, from its events."""
    at = F.struct(*ORDER)
    ended = F.max(F.when(F.col("event_type") == "subscription_churned", F.col("state_at")))
    return (
        events.groupBy("subscription_id", key)
        .agg(
            F.max_by("event_plan_id", at).alias("plan_id"),
            F.max_by("mrr", at).alias("mrr"),
            F.min("state_at").alias("started_at"),
            ended.alias("ended_at"),
            F.max("state_at").alias("last_event_at"),
        )
        .withColumn("status", F.when(F.col("ended_at").isNull(), "active").otherwise("churned"))
    )
