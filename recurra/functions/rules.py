"""Business classifiers and scores as column expressions.

Labels, thresholds and points are fixed values of the metric definitions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recurra.functions.numbers import dbl, ratio, rnd, smallest

# --- fixed values -----------------------------------------------------------

EVENT_CATEGORIES = {
    "subscription_started": "acquisition",
    "subscription_reactivated": "acquisition",
    "subscription_upgraded": "expansion",
    "subscription_downgraded": "contraction",
    "subscription_churned": "churn",
}
MOVEMENT_TYPES = ["new", "resurrection", "expansion", "contraction", "churn", "unchanged"]
CUSTOMER_STATUSES = ["active_paying", "active_free", "churned", "unknown"]
RISK_BANDS = ["low", "medium", "high", "critical"]
PLAN_TIERS = ["free", "professional", "business", "enterprise"]
COMPANY_SIZES = ["1-10", "11-50", "51-200", "201-500", "501-1000", "1000+"]
JOURNEY_STAGES = ["awareness", "consideration_early", "consideration_late", "decision"]
CUSTOMER_TENURE = [(30, "0-30 days"), (90, "31-90 days"), (180, "91-180 days"), (365, "181-365 days")]
CUSTOMER_TENURE_REST = "365+ days"
SUBSCRIPTION_TENURE = [(30, "0-1 month"), (90, "1-3 months"), (180, "3-6 months"), (365, "6-12 months")]
SUBSCRIPTION_TENURE_REST = "12+ months"
PRE_CHURN = [(7, "0-7 days before"), (30, "8-30 days before"), (60, "31-60 days before")]
PRE_CHURN_REST = "61-90 days before"
BLENDED = "ALL CHANNELS"
RISK_POINTS = [
    "pts_payment_failures",
    "pts_stale_payment",
    "pts_downgrades",
    "pts_mrr_erosion",
    "pts_prior_churn",
    "pts_early_tenure",
]


# --- generic shapes -----------------------------------------------------------


def up_to(value: Column, steps: list[tuple[float, str]], rest: str) -> Column:
    """First label whose limit is not exceeded; ``rest`` beyond (and for NULL)."""
    out = F
    for limit, label in steps:
        out = out.when(value <= limit, F.lit(label))
    return out.otherwise(F.lit(rest))


def at_least(value: Column, steps: list[tuple[float, str]], rest: str) -> Column:
    out = F
    for limit, label in steps:
        out = out.when(value >= limit, F.lit(label))
    return out.otherwise(F.lit(rest))


def position(label: Column, ordered: list[str]) -> Column:
    """1-based rank of a label in a fixed order; labels not listed come last."""
    return F.coalesce(
        F.nullif(F.array_position(F.array(*[F.lit(v) for v in ordered]), label), F.lit(0)),
        F.lit(len(ordered) + 1),
    )


# --- lifecycle -----------------------------------------------------------------


def event_category(event_type: Column) -> Column:
    out = F
    for kind, category in EVENT_CATEGORIES.items():
        out = out.when(event_type == kind, F.lit(category))
    return out.otherwise(F.lit("other"))


def movement_type(before: Column, after: Column, first_month: Column) -> Column:
    """Label of one customer-month from last month's and this month's MRR."""
    had = F.coalesce(before, F.lit(0))
    return (
        F.when(first_month & (after > 0), "new")
        .when((had == 0) & (after > 0), "resurrection")
        .when((had > 0) & (after > had), "expansion")
        .when((had > 0) & (after > 0) & (after < had), "contraction")
        .when((had > 0) & (after == 0), "churn")
        .otherwise("unchanged")
    )


def simple_movement(before: Column, after: Column) -> Column:
    """Month-over-month label where a missing predecessor means new."""
    return (
        F.when(before.isNull(), "new")
        .when(after > before, "expansion")
        .when((after < before) & (after > 0), "contraction")
        .when((after == 0) & (before > 0), "churn")
        .otherwise("unchanged")
    )


def customer_status(status: Column, mrr: Column) -> Column:
    active = status == "active"
    return (
        F.when(active & (mrr > 0), "active_paying")
        .when(active & (mrr == 0), "active_free")
        .when(status == "churned", "churned")
        .otherwise("unknown")
    )


def customer_health(
    status: Column, ups: Column, downs: Column, failed: Column, paid: Column, idle_days: Column
) -> Column:
    """Ordered rules; a missing count makes its rule not apply."""
    return (
        F.when(status == "churned", "churned")
        .when(downs > ups, "at_risk")
        .when((failed > 0) & (dbl(failed) >= dbl(paid) * 0.1), "at_risk")
        .when(ups > 0, "healthy")
        .when(idle_days > 45, "at_risk")
        .otherwise("stable")
    )


def trial_converted(is_trial: Column, status: Column, mrr: Column) -> Column:
    return F.coalesce(is_trial & (status == "active") & (mrr > 0), F.lit(False))


def customer_tenure(days: Column) -> Column:
    return up_to(days, CUSTOMER_TENURE, CUSTOMER_TENURE_REST)


def customer_tenure_rank(bucket: Column) -> Column:
    return position(bucket, [label for _, label in CUSTOMER_TENURE])


def subscription_tenure(days: Column) -> Column:
    return up_to(days, SUBSCRIPTION_TENURE, SUBSCRIPTION_TENURE_REST)


def churn_timing(status: Column, days: Column) -> Column:
    return F.when(status == "churned", up_to(days, [(30, "early_churn"), (90, "standard_churn")], "late_churn"))


def pre_churn_bucket(days: Column) -> Column:
    return up_to(days, PRE_CHURN, PRE_CHURN_REST)


def pre_churn_rank(bucket: Column) -> Column:
    return position(bucket, [label for _, label in PRE_CHURN])


def effective_monthly_price(cycle: Column, monthly: Column, annual: Column) -> Column:
    return F.when(cycle == "annual", rnd(dbl(annual) / 12.0, 2)).otherwise(dbl(monthly))


def annual_discount_pct(cycle: Column, monthly: Column, annual: Column) -> Column:
    saved = 1.0 - ratio(dbl(annual) / 12.0, monthly)
    return F.when(cycle == "annual", rnd(saved * 100.0, 1)).otherwise(F.lit(0.0))


def first_paid_conversion(seq: Column, category: Column, plan: Column, previous_plan: Column) -> Column:
    direct = (seq == 1) & (category == "acquisition") & (plan > 1)
    after_free = (seq == 2) & (previous_plan == 1) & (plan > 1)
    return F.coalesce(direct, F.lit(False)) | F.coalesce(after_free, F.lit(False))


# --- attribution -----------------------------------------------------------------


def first_touch(seq: Column) -> Column:
    return (seq == 1).cast("double")


def last_touch(seq: Column, touches: Column) -> Column:
    return (seq == touches).cast("double")


def linear(touches: Column) -> Column:
    return ratio(F.lit(1.0), touches)


def time_decay(days: Column, own: Column, all_powers: Column, touches: Column) -> Column:
    return F.when(days >= 0, ratio(own, all_powers)).otherwise(linear(touches))


def position_based(seq: Column, touches: Column) -> Column:
    """Everything to a single touch, halves to two, else 40 / 20 shared / 40."""
    edge = (seq == 1) | (seq == touches)
    return (
        F.when(touches <= 2, linear(touches))
        .when(edge, F.lit(0.4))
        .otherwise(ratio(F.lit(0.2), touches - 2))
    )


def journey_stage(seq: Column, touches: Column) -> Column:
    return (
        F.when(seq == 1, "awareness")
        .when(seq == touches, "decision")
        .when(seq * 2 <= touches, "consideration_early")
        .otherwise("consideration_late")
    )


# --- churn-risk score -----------------------------------------------------------


def points_payment_failures(failed: Column) -> Column:
    return smallest(failed * 8, F.lit(25))


def points_stale_payment(mrr: Column, idle_days: Column) -> Column:
    """A paying account that never paid has no idle days and gets 15 points."""
    return (
        F.when(mrr == 0, 0)
        .when(idle_days > 60, 20)
        .when(idle_days > 45, 12)
        .when(idle_days.isNull(), 15)
        .otherwise(0)
    )


def points_downgrades(ups: Column, downs: Column) -> Column:
    return F.when(downs > ups, smallest((downs - ups) * 8, F.lit(15))).otherwise(0)


def points_mrr_erosion(peak: Column, mrr: Column) -> Column:
    lost = rnd(ratio(peak - mrr, peak) * 20.0).cast("int")
    return F.when((peak > 0) & (mrr < peak), smallest(lost, F.lit(20))).otherwise(0)


def points_prior_churn(resurrected: Column, times: Column) -> Column:
    return F.when(resurrected, 10).when(times > 0, 6).otherwise(0)


def points_early_tenure(days: Column) -> Column:
    return F.when(days <= 30, 10).when(days <= 90, 6).otherwise(0)


def risk_band(score: Column) -> Column:
    return at_least(score, [(75, "critical"), (50, "high"), (25, "medium")], "low")


# --- report labels -----------------------------------------------------------------


def quick_risk_label(score: Column) -> Column:
    return at_least(score, [(40, "High Risk"), (20, "Medium Risk"), (0, "Low Risk")], "Healthy")


def health_score_label(score: Column) -> Column:
    return at_least(score, [(40, "High Risk"), (20, "Medium Risk"), (0, "Low Risk")], "Healthy")


def engagement_score(ups: Column, downs: Column, status: Column) -> Column:
    paying = status == "active_paying"
    return F.when(ups > 0, 3).when((downs == 0) & paying, 2).when(paying, 1).otherwise(0)


def lifecycle_stage(status: Column, ups: Column) -> Column:
    return (
        F.when(status == "churned", "5_churned")
        .when(ups > 0, "4_expansion")
        .when(status == "active_paying", "3_paying")
        .when(status == "active_free", "2_activated_free")
        .otherwise("1_signed_up")
    )


def channel_action(ltv_to_cac: Column, payback: Column) -> Column:
    return (
        F.when((ltv_to_cac >= 3) & (payback <= 12), "scale").when(ltv_to_cac >= 1, "optimize").otherwise("reduce")
    )


def segment_label(churn_pct: Column, arpu: Column, customers: Column, mrr: Column) -> Column:
    return (
        F.when(churn_pct >= 40, "at_risk")
        .when((arpu >= 50) & (customers < 30), "whitespace")
        .when(mrr >= 1000, "core")
        .otherwise("steady")
    )


def paid_or_organic(is_paid: Column) -> Column:
    return F.when(is_paid, "Paid").otherwise("Organic")


def nrr_status(nrr: Column) -> Column:
    return at_least(nrr, [(1.20, "Excellent"), (1.00, "Good")], "Needs attention")


def ltv_cac_status(value: Column) -> Column:
    return at_least(value, [(3, "Healthy"), (1, "Marginal")], "Unprofitable")


def payback_status(months: Column) -> Column:
    return up_to(months, [(12, "Excellent"), (18, "Good")], "Concerning")


# Benchmark bands of the documented metrics; the gaps between the published
# limits belong to the neutral middle label.


def growth_stage(monthly_pct: Column) -> Column:
    return at_least(monthly_pct, [(15, "early_stage"), (5, "growth_stage"), (2, "mature")], "below_benchmark")


def mrr_churn_band(monthly_pct: Column) -> Column:
    return (
        F.when(monthly_pct < 1, "excellent")
        .when(monthly_pct <= 2, "good")
        .when(monthly_pct <= 3, "watch")
        .when(monthly_pct > 3, "concerning")
    )


def nrr_band(nrr_pct: Column) -> Column:
    return F.when(nrr_pct > 120, "excellent").when(nrr_pct >= 100, "good").when(nrr_pct < 100, "concerning")


def quick_ratio_band(value: Column) -> Column:
    return (
        F.when(value > 4, "excellent")
        .when(value >= 2, "good")
        .when(value >= 1, "watch")
        .when(value < 1, "concerning")
    )


def logo_churn_band(monthly_pct: Column) -> Column:
    return (
        F.when(monthly_pct < 1, "enterprise_typical")
        .when(monthly_pct <= 2, "mid_market_typical")
        .when(monthly_pct <= 5, "smb_typical")
        .when(monthly_pct > 5, "above_typical")
    )


def payback_band(months: Column) -> Column:
    return (
        F.when(months < 12, "excellent")
        .when(months <= 18, "good")
        .when(months <= 24, "watch")
        .when(months > 24, "concerning")
    )
