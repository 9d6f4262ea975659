"""Q11-Q17: acquisition channels, attribution models and journeys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions.numbers import count_where, mean, money, pct, ratio, rnd, share_true
from recurra.functions.rules import JOURNEY_STAGES, paid_or_organic, position
from recurra.operators.attribution import MODELS
from recurra.plans.shares import with_share


def channel_overview(dim_customers: DataFrame) -> DataFrame:
    """Q11."""
    total = F.col("total_customers")
    return (
        dim_customers.groupBy("acquisition_channel", "acquisition_channel_category", "is_paid_acquisition")
        .agg(
            F.count("customer_id").alias("total_customers"),
            count_where(F.col("customer_status") == "active_paying").alias("active_customers"),
            count_where(F.col("has_churned")).alias("churned_customers"),
            F.sum("lifetime_revenue").alias("total_revenue"),
            F.sum("current_mrr").alias("current_mrr"),
            rnd(mean(F.col("lifetime_revenue")), 2).alias("avg_ltv"),
            rnd(mean(F.col("current_mrr")), 2).alias("avg_mrr"),
        )
        .withColumns(
            {
                "retention_rate": pct(F.col("active_customers"), total),
                "churn_rate": pct(F.col("churned_customers"), total),
            }
        )
        .orderBy(F.desc("total_revenue"), "acquisition_channel")
    )


def attribution_comparison(touchpoints: DataFrame) -> DataFrame:
    """Q12: each channel's customers and revenue under the five models.

    Revenue is summed as DECIMAL so the totals do not depend on row order. Touches
    shrink to one row per channel and customer before customers are counted.
    """
    keys = ["channel_name", "channel_category", "is_paid"]
    per_customer = touchpoints.groupBy(*keys, "customer_id").agg(
        count_where(F.col("is_first_touch")).alias("firsts"),
        count_where(F.col("is_last_touch")).alias("lasts"),
        *[F.sum(F.col(f"{m}_revenue").cast("decimal(28,10)")).alias(m) for m in MODELS],
        F.count("*").alias("touches"),
        F.sum("days_to_conversion").alias("days"),
        F.count("days_to_conversion").alias("days_known"),
    )
    known = F.col("customer_id").isNotNull()
    summed = per_customer.groupBy(*keys).agg(
        count_where((F.col("firsts") > 0) & known).alias("first_touch_customers"),
        count_where((F.col("lasts") > 0) & known).alias("last_touch_customers"),
        F.count("customer_id").alias("any_touch_customers"),
        *[F.sum(m).alias(f"_{m}") for m in MODELS],
        F.sum("touches").alias("total_touches"),
        rnd(ratio(F.sum("days"), F.sum("days_known")), 1).alias("avg_days_to_conversion"),
    )
    return (
        summed.withColumns({f"{m}_revenue": money(f"_{m}") for m in MODELS})
        .withColumn("first_vs_last_delta", money(F.col("_first_touch") - F.col("_last_touch")))
        .orderBy(F.desc_nulls_last("_position_based"), "channel_name")
        .drop(*[f"_{m}" for m in MODELS])
    )


def journey_positions(touchpoints: DataFrame) -> DataFrame:
    """Q13: where in the journey each channel appears."""
    per_customer = touchpoints.groupBy("channel_name", "journey_stage", "customer_id").agg(
        F.count("*").alias("touches"), F.sum("initial_mrr").alias("value"), F.count("initial_mrr").alias("valued")
    )
    grouped = per_customer.groupBy("channel_name", "journey_stage").agg(
        F.sum("touches").alias("touches"),
        F.count("customer_id").alias("unique_customers"),
        rnd(ratio(F.sum("value"), F.sum("valued")), 2).alias("avg_customer_value"),
    )
    return with_share(grouped, "touches", "pct_of_channel_touches", ["channel_name"]).orderBy(
        "channel_name", position(F.col("journey_stage"), JOURNEY_STAGES)
    )


def journeys_by_length(touchpoints: DataFrame) -> DataFrame:
    """Q14: customers, value and duration by number of touches."""
    journeys = touchpoints.groupBy("customer_id", "total_touches").agg(
        F.max("initial_mrr").alias("value"), F.max("days_to_conversion").alias("days")
    )
    return (
        journeys.groupBy("total_touches")
        .agg(
            F.count("customer_id").alias("customers"),
            rnd(mean(F.col("value")), 2).alias("avg_customer_value"),
            rnd(mean(F.col("days")), 1).alias("avg_journey_days"),
        )
        .orderBy("total_touches")
    )


def channel_pairs(touchpoints: DataFrame, min_customers: int = 5, top: int = 20) -> DataFrame:
    """Q15: first and last channel combinations by MRR."""
    journeys = touchpoints.groupBy("customer_id").agg(
        F.min(F.when(F.col("is_first_touch"), F.col("channel_name"))).alias("first_channel"),
        F.max(F.when(F.col("is_last_touch"), F.col("channel_name"))).alias("last_channel"),
        F.max("initial_mrr").alias("mrr"),
    )
    return (
        journeys.groupBy("first_channel", "last_channel")
        .agg(
            F.count("customer_id").alias("customers"),
            money(F.sum("mrr")).alias("total_mrr"),
            rnd(mean(F.col("mrr")), 2).alias("avg_mrr"),
        )
        .where(F.col("customers") >= min_customers)
        .orderBy(F.desc_nulls_last("total_mrr"), "first_channel", "last_channel")
        .limit(top)
    )


def channel_segments(dim_customers: DataFrame, min_customers: int = 10, with_industry: bool = False) -> DataFrame:
    """Q16: channels by company size and industry; the industry is shown on request."""
    grouped = (
        dim_customers.groupBy("acquisition_channel", "company_size", "industry")
        .agg(
            F.count("customer_id").alias("customers"),
            rnd(mean(F.col("lifetime_revenue")), 2).alias("avg_ltv"),
            rnd(mean(F.col("current_mrr")), 2).alias("avg_mrr"),
            rnd(share_true(~F.coalesce(F.col("has_churned"), F.lit(False))) * 100.0, 1).alias("retention_rate_pct"),
        )
        .where(F.col("customers") >= min_customers)
        .orderBy("acquisition_channel", F.desc("avg_ltv"), "company_size", "industry")
    )
    return grouped if with_industry else grouped.drop("industry")


def paid_versus_organic(dim_customers: DataFrame) -> DataFrame:
    """Q17."""
    return dim_customers.groupBy(paid_or_organic(F.col("is_paid_acquisition")).alias("channel_type")).agg(
        F.count("customer_id").alias("total_customers"),
        rnd(mean(F.col("lifetime_revenue")), 2).alias("avg_ltv"),
        rnd(mean(F.col("current_mrr")), 2).alias("avg_current_mrr"),
        money(F.sum("lifetime_revenue")).alias("total_revenue"),
        rnd(share_true(F.col("has_churned")) * 100.0, 1).alias("churn_rate"),
        rnd(mean(F.col("upgrade_count")), 2).alias("avg_upgrades"),
        rnd(mean(F.col("days_since_signup"))).alias("avg_tenure_days"),
    )
