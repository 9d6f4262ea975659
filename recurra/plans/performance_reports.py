"""Q23-Q27: snapshot, waterfall, growth efficiency, quarters and plan tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recurra.functions.dates import quarter_key
from recurra.functions.numbers import count_where, mean, money, pct, rnd, sum_where


def latest_snapshot(fct_mrr: DataFrame) -> DataFrame:
    """Q23."""
    return (
        fct_mrr.orderBy(F.desc("month_date"))
        .limit(1)
        .select(
            "month_key", "active_customers", "ending_mrr", "arr", "arpc",
            rnd(F.col("net_revenue_retention_pct"), 1).alias("nrr_pct"),
            rnd(F.col("gross_mrr_churn_rate_pct"), 1).alias("gross_mrr_churn_pct"),
            "quick_ratio",
            rnd(F.col("mrr_growth_rate_pct"), 1).alias("mrr_growth_pct"),
        )
    )


def mrr_waterfall(fct_mrr: DataFrame) -> DataFrame:
    """Q24: monthly MRR with losses as negative amounts."""
    return fct_mrr.orderBy("month_date").select(
        "month_key", "ending_mrr", "new_mrr", "expansion_mrr",
        (-F.col("contraction_mrr")).alias("contraction_mrr"),
        (-F.col("churned_mrr")).alias("churned_mrr"),
        "net_new_mrr",
        rnd(F.col("mrr_growth_rate_pct"), 1).alias("mrr_growth_pct"),
    )


def growth_efficiency(fct_mrr: DataFrame) -> DataFrame:
    """Q25: growth plus (NRR - 100) as a directional rule-of-40 proxy."""
    growth, nrr = F.col("mrr_growth_rate_pct"), F.col("net_revenue_retention_pct")
    return (
        fct_mrr.where(growth.isNotNull())
        .orderBy("month_date")
        .select(
            "month_key", rnd(growth, 1).alias("mrr_growth_pct"), "quick_ratio", rnd(nrr, 1).alias("nrr_pct"),
            rnd(growth + (nrr - 100.0), 1).alias("rule_of_40_proxy"),
        )
    )


def quarter_over_quarter(fct_mrr: DataFrame) -> DataFrame:
    """Q26: the quarter's highest month-end MRR against the previous quarter's."""
    top = F.col("quarter_end_mrr")
    before = F.lag("quarter_end_mrr").over(Window.orderBy("quarter"))
    return (
        fct_mrr.groupBy(quarter_key(F.col("month_date")).alias("quarter"))
        .agg(F.max("ending_mrr").alias("quarter_end_mrr"), F.sum("net_new_mrr").alias("net_new_mrr"))
        .select(
            "quarter", money(top).alias("quarter_end_mrr"), money(top * 12).alias("arr"),
            money("net_new_mrr").alias("net_new_mrr"), pct(top - before, before).alias("qoq_growth_pct"),
        )
        .orderBy("quarter")
    )


def performance_by_tier(dim_subscriptions: DataFrame) -> DataFrame:
    """Q27."""
    return (
        dim_subscriptions.groupBy("plan_tier")
        .agg(
            F.count("subscription_id").alias("subscriptions"),
            count_where(F.col("is_active")).alias("active_subscriptions"),
            money(sum_where(F.col("is_active"), F.col("mrr"))).alias("active_mrr"),
            rnd(mean(F.col("mrr")), 2).alias("avg_mrr"),
            rnd(mean(F.col("subscription_length_days"))).alias("avg_tenure_days"),
            pct(count_where(F.col("is_churned")), F.count("subscription_id")).alias("churn_rate_pct"),
        )
        .orderBy(F.desc("active_mrr"), "plan_tier")
    )
