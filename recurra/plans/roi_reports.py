"""Q28-Q31: return on acquisition spend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions.numbers import mean, money, pct, ratio, rnd
from recurra.functions.rules import BLENDED, channel_action, paid_or_organic
from recurra.plans.shares import with_share


def _channels_only(economics: DataFrame) -> DataFrame:
    return economics.where(F.col("acquisition_channel") != BLENDED)


def channel_scorecard(economics: DataFrame) -> DataFrame:
    """Q28."""
    return (
        _channels_only(economics)
        .select(
            "acquisition_channel", "acquisition_channel_category", "customers_acquired", "cac", "realized_ltv",
            "predicted_ltv", "ltv_to_cac_ratio", "cac_payback_months", "acquisition_roi_pct",
            "total_acquisition_spend", "total_lifetime_revenue",
            channel_action(F.col("ltv_to_cac_ratio"), F.col("cac_payback_months")).alias("recommended_action"),
        )
        .orderBy(F.desc_nulls_last("ltv_to_cac_ratio"), "acquisition_channel")
    )


def paid_versus_organic_return(economics: DataFrame) -> DataFrame:
    """Q29."""
    spend, revenue, customers = F.col("total_spend"), F.col("total_revenue"), F.col("customers")
    return (
        _channels_only(economics)
        .groupBy(paid_or_organic(F.col("is_paid_acquisition")).alias("channel_type"))
        .agg(
            F.sum("customers_acquired").alias("customers"),
            rnd(F.sum("total_acquisition_spend"), 2).alias("total_spend"),
            money(F.sum("total_lifetime_revenue")).alias("total_revenue"),
        )
        .withColumns(
            {
                "blended_cac": rnd(ratio(spend, customers), 2),
                "blended_ltv": rnd(ratio(revenue, customers), 2),
                "blended_roi_pct": pct(revenue.cast("double") - spend, spend),
            }
        )
    )


def spend_frontier(economics: DataFrame) -> DataFrame:
    """Q30: revenue per unit of spend with each channel's share of both."""
    rows = _channels_only(economics).select(
        "acquisition_channel", "total_acquisition_spend", "total_lifetime_revenue",
        rnd(ratio(F.col("total_lifetime_revenue"), F.col("total_acquisition_spend")), 2).alias("revenue_per_dollar"),
    )
    rows = with_share(rows, "total_lifetime_revenue", "pct_of_total_revenue")
    return with_share(rows, "total_acquisition_spend", "pct_of_total_spend").orderBy(
        F.desc_nulls_last("revenue_per_dollar"), "acquisition_channel"
    )


def channel_by_tier(dim_customers: DataFrame, min_customers: int = 5) -> DataFrame:
    """Q31."""
    return (
        dim_customers.where(F.col("current_plan_tier").isNotNull())
        .groupBy("acquisition_channel", "current_plan_tier")
        .agg(
            F.count("*").alias("customers"),
            rnd(mean(F.col("lifetime_revenue")), 2).alias("avg_ltv"),
            money(F.sum("current_mrr")).alias("current_mrr"),
        )
        .where(F.col("customers") >= min_customers)
        .orderBy("acquisition_channel", F.desc("avg_ltv"), "current_plan_tier")
    )
