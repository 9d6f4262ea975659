"""Acquisition economics per channel, with a blended row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.functions.numbers import dbl, largest, money, pct, ratio, rnd
from recurra.functions.rules import BLENDED
from recurra.settings import Settings


def channel_rollup(dim_customers: DataFrame) -> DataFrame:
    """Customer outcomes per acquisition channel; a repeated id counts as one customer."""
    keys = ["acquisition_channel", "acquisition_channel_category", "is_paid_acquisition"]
    known = F.col("customer_id").isNotNull()
    earning = F.nullif(F.col("current_mrr"), F.lit(0).cast("decimal(18,4)"))
    sums = {"_revenue": F.col("lifetime_revenue"), "_mrr": F.col("current_mrr"), "_earning": earning, "_days": F.col("days_since_signup")}
    each = dim_customers.groupBy(*keys, "customer_id").agg(
        F.max((known & (F.col("customer_status") == "active_paying")).cast("int")).alias("_paying"),
        F.max((known & F.col("has_churned")).cast("int")).alias("_churned"),
        *[F.sum(c).alias(n) for n, c in sums.items()],
        *[F.count(c).alias(f"{n}_n") for n, c in sums.items()],
    )

    def average(name: str) -> Column:
        return ratio(F.sum(name), F.sum(f"{name}_n"))

    return each.groupBy(*keys).agg(
        F.count("customer_id").alias("customers_acquired"),
        F.coalesce(F.sum("_paying"), F.lit(0)).alias("active_paying_customers"),
        F.coalesce(F.sum("_churned"), F.lit(0)).alias("churned_customers"),
        F.sum("_revenue").alias("total_lifetime_revenue"),
        F.sum("_mrr").alias("current_mrr"),
        average("_revenue").alias("avg_lifetime_revenue"),
        average("_earning").alias("arpc"),
        average("_days").alias("avg_tenure_days"),
    )


def _economics(
    settings: Settings,
    acquired: Column, paying: Column, churned: Column,
    cac: Column, arpc: Column, ltv: Column, revenue: Column, mrr: Column, spend: Column, tenure: Column,
) -> list[Column]:
    """The measures of one row, from unrounded parts; churn is over the whole observed life."""
    churn = largest(ratio(churned, acquired), F.lit(settings.min_churn_rate))
    margin = arpc * settings.gross_margin
    return [
        acquired.cast("bigint").alias("customers_acquired"),
        paying.cast("bigint").alias("active_paying_customers"),
        churned.cast("bigint").alias("churned_customers"),
        churn.alias("observed_churn_rate"),
        rnd(cac, 2).alias("cac"),
        money(revenue).alias("total_lifetime_revenue"),
        money(mrr).alias("current_mrr"),
        rnd(arpc, 2).alias("arpc"),
        rnd(ltv, 2).alias("realized_ltv"),
        rnd(spend, 2).alias("total_acquisition_spend"),
        rnd(ratio(margin, churn), 2).alias("predicted_ltv"),
        rnd(ratio(ltv, cac), 2).alias("ltv_to_cac_ratio"),
        rnd(ratio(cac, margin), 1).alias("cac_payback_months"),
        pct(ltv - cac, cac).alias("acquisition_roi_pct"),
        rnd(tenure).alias("avg_tenure_days"),
        pct(paying, acquired).alias("active_rate_pct"),
        pct(churned, acquired).alias("churn_rate_pct"),
    ]


def unit_economics(dim_customers: DataFrame, channels: DataFrame, settings: Settings) -> DataFrame:
    """One row per channel plus a blended row recomputed from the channels' sums."""
    cost = channels.select(F.col("channel_name").alias("acquisition_channel"), dbl("typical_cac").alias("_cac"))
    acquired, cac = F.col("customers_acquired"), F.col("_cac")
    per_channel = (
        channel_rollup(dim_customers)
        .join(cost, "acquisition_channel", "left")
        .select(
            "acquisition_channel", "acquisition_channel_category", "is_paid_acquisition",
            *_economics(
                settings, acquired, F.col("active_paying_customers"), F.col("churned_customers"),
                cac, F.col("arpc"), F.col("avg_lifetime_revenue"), F.col("total_lifetime_revenue"),
                F.col("current_mrr"), dbl(acquired) * cac, F.col("avg_tenure_days"),
            ),
        )
    )
    totals = per_channel.agg(
        *[
            F.sum(c).alias(c)
            for c in (
                "customers_acquired", "active_paying_customers", "churned_customers", "total_lifetime_revenue",
                "current_mrr", "total_acquisition_spend",
            )
        ],
        F.avg("avg_tenure_days").alias("avg_tenure_days"),
    )
    spend, revenue, mrr = F.col("total_acquisition_spend"), F.col("total_lifetime_revenue"), F.col("current_mrr")
    paying = F.col("active_paying_customers")
    blended = totals.select(
        F.lit(BLENDED).alias("acquisition_channel"),
        F.lit("blended").alias("acquisition_channel_category"),
        F.lit(None).cast("boolean").alias("is_paid_acquisition"),
        *_economics(
            settings, acquired, paying, F.col("churned_customers"), ratio(spend, acquired), ratio(mrr, paying),
            ratio(revenue, acquired), revenue, mrr, spend, F.col("avg_tenure_days"),
        ),
    )
    return per_channel.unionByName(blended)


def ranked_economics(economics: DataFrame) -> DataFrame:
    """Channels by LTV:CAC, the blended row last."""
    total_last = F.when(F.col("acquisition_channel") == BLENDED, 1).otherwise(0)
    return economics.orderBy(total_last, F.desc_nulls_last("ltv_to_cac_ratio"), "acquisition_channel")


def cost_per_acquisition(spend: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Acquisition cost per channel from (acquisition_channel, sales_cost, marketing_cost) rows."""
    paid = spend.groupBy("acquisition_channel").agg(
        F.sum(F.coalesce(F.col("sales_cost"), F.lit(0)) + F.coalesce(F.col("marketing_cost"), F.lit(0))).alias(
            "total_cost"
        )
    )
    gained = dim_customers.groupBy("acquisition_channel").agg(F.count("customer_id").alias("new_customers"))
    return paid.join(gained, "acquisition_channel", "left").select(
        "acquisition_channel", "total_cost", "new_customers",
        rnd(ratio(F.col("total_cost"), F.col("new_customers")), 2).alias("cac"),
    )
