"""Rules-based churn-risk score per active customer."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions import rules
from recurra.functions.dates import days_between
from recurra.functions.numbers import pct, smallest
from recurra.settings import Settings


def churn_risk(dim_customers: DataFrame, settings: Settings) -> DataFrame:
    """Six capped point components, their sum up to 100, a band and the MRR at risk."""
    mrr, peak, idle = F.col("current_mrr"), F.col("peak_mrr"), F.col("days_since_last_payment")
    ups, downs = F.col("upgrade_count"), F.col("downgrade_count")
    scored = (
        dim_customers.where(F.col("customer_status").isin("active_paying", "active_free"))
        .withColumn("days_since_last_payment", days_between(settings.as_of, F.col("last_payment_date")))
        .withColumns(
            {
                "mrr_erosion_pct": pct(peak - mrr, peak),
                "pts_payment_failures": rules.points_payment_failures(F.col("failed_payments")),
                "pts_stale_payment": rules.points_stale_payment(mrr, idle),
                "pts_downgrades": rules.points_downgrades(ups, downs),
                "pts_mrr_erosion": rules.points_mrr_erosion(peak, mrr),
                "pts_prior_churn": rules.points_prior_churn(F.col("is_resurrected"), F.col("times_churned")),
                "pts_early_tenure": rules.points_early_tenure(F.col("days_since_signup")),
            }
        )
    )
    total = reduce(add, [F.col(c) for c in rules.RISK_POINTS])
    score = F.col("churn_risk_score")
    return scored.withColumn("churn_risk_score", smallest(total, F.lit(100))).select(
        "customer_id", "company_name", "industry", "company_size", "acquisition_channel", "current_plan_tier",
        "customer_status", "signup_cohort_month", "tenure_bucket", "health_status", "current_mrr", "current_arr",
        "peak_mrr", "mrr_erosion_pct", "upgrade_count", "downgrade_count", "failed_payments",
        "successful_payments", "payment_success_rate", "days_since_last_payment", "times_churned",
        "is_resurrected", *rules.RISK_POINTS, "churn_risk_score",
        rules.risk_band(score).alias("risk_band"),
        F.when(score >= 50, mrr).otherwise(F.lit(0).cast("decimal(18,2)")).alias("mrr_at_risk"),
    )


def ranked_risk(risk: DataFrame) -> DataFrame:
    """Highest score first."""
    return risk.orderBy(F.desc("churn_risk_score"), F.desc("current_mrr"), "customer_id")


def health_score(dim_customers: DataFrame, settings: Settings) -> DataFrame:
    """Documented health score; higher means riskier, negative means healthy.

    Unlike the quick score, a downgrade only counts when it is at most 90 days old.
    """
    today = settings.as_of

    def points(cond, n):
        return F.when(cond, n).otherwise(0)

    score = (
        points(F.col("failed_payments") > 0, 15)
        + points(days_between(today, F.col("last_downgrade_date")) <= 90, 20)
        + points(days_between(today, F.col("last_payment_date")) > 45, 25)
        + points(F.col("days_since_signup") < 90, 15)
        - points(F.col("upgrade_count") > 0, 15)
        - points(F.col("current_plan_tier") == "enterprise", 10)
    )
    return dim_customers.select("customer_id", "customer_status", score.alias("health_score")).withColumn(
        "health_category", rules.health_score_label(F.col("health_score"))
    )
