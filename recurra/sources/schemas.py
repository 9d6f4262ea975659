"""Declared schemas: raw text entities, typed lookups, mart extracts."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


_KINDS = {
    "string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "price": T.DecimalType(18, 2),
}


def _typed(spec: str) -> T.StructType:
    """Schema from "name kind, name kind, …"; needs no running session."""
    pairs = [item.split() for item in spec.split(",")]
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


# Raw tables arrive as text; staging types them.
RAW = {
    "customers": _text(
        "customer_id", "company_name", "industry", "company_size", "country", "signup_date", "email",
        "acquisition_channel_id", "initial_plan_id", "is_trial", "trial_end_date",
    ),
    "subscriptions": _text(
        "subscription_id", "customer_id", "plan_id", "status", "billing_cycle", "mrr", "start_date",
        "end_date", "created_at", "updated_at",
    ),
    "subscription_events": _text(
        "event_id", "subscription_id", "customer_id", "event_type", "event_date", "plan_id", "mrr_change",
        "mrr_after",
    ),
    "payments": _text(
        "payment_id", "subscription_id", "customer_id", "amount", "currency", "payment_date",
        "payment_method", "status", "created_at",
    ),
    "marketing_touches": _text(
        "touch_id", "customer_id", "channel_id", "touch_date", "touch_type", "landing_page", "utm_campaign",
        "conversion_date",
    ),
}

SEEDS = {
    "plan_tiers": _typed(
        "plan_id bigint, plan_name string, plan_tier string, monthly_price price, annual_price price,"
        " storage_gb bigint, max_users bigint, features string"
    ),
    "marketing_channels": _typed(
        "channel_id bigint, channel_name string, channel_category string, is_paid boolean, typical_cac price"
    ),
}

# Extract tables keep their own column names, which differ from the marts in places.
EXTRACTS = {
    "fct_mrr": _typed(
        "month_date date, month_key string, active_customers bigint, new_customers bigint,"
        " churned_customers bigint, ending_mrr double, new_mrr double, expansion_mrr double,"
        " contraction_mrr double, churned_mrr double, net_new_mrr double, nrr_pct double, quick_ratio double,"
        " arpc double"
    ),
    "dim_customers": _typed(
        "customer_id string, company_name string, industry string, company_size string, country string,"
        " acquisition_channel string, current_plan_tier string, customer_status string, current_mrr double,"
        " lifetime_revenue double, health_status string, signup_cohort_month string"
    ),
    "dim_subscriptions": _typed(
        "subscription_id string, customer_id string, plan_name string, plan_tier string, status string,"
        " billing_cycle string, mrr double, subscription_length_days bigint, tenure_bucket string,"
        " is_active boolean, is_churned boolean, churn_timing string"
    ),
    "rpt_unit_economics": _typed(
        "acquisition_channel string, customers_acquired bigint, cac double, realized_ltv double,"
        " predicted_ltv double, ltv_to_cac_ratio double, cac_payback_months double, acquisition_roi_pct double,"
        " total_acquisition_spend double, total_lifetime_revenue double, churn_rate_pct double"
    ),
    "rpt_churn_risk": _typed(
        "customer_id string, company_name string, risk_band string, churn_risk_score bigint, current_mrr double,"
        " mrr_at_risk double"
    ),
    "rpt_cohort_retention": _typed(
        "cohort_month_key string, period_label string, months_since_signup bigint, cohort_size bigint,"
        " active_customers bigint, retention_rate double, mrr_retention_from_m0 double"
    ),
}

# Extract column -> mart column, where the names differ.
EXTRACT_ALIASES = {"fct_mrr": {"nrr_pct": "net_revenue_retention_pct"}}
