"""The datasets behind the report pages."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recurra.functions import rules
from recurra.functions.dates import month_key, month_start, quarter_key, week_start
from recurra.functions.numbers import (
    count_where, dbl, mean, money, money_label, pct, ratio, rnd, trend_arrow,
)
from recurra.plans.kpi import economics_kpis, revenue_kpis


def _labels(spark: SparkSession, column: str, values: list[str]) -> DataFrame:
    return spark.createDataFrame(pa.table({column: values, "position": list(range(1, len(values) + 1))}))


def executive_row(fct_mrr: DataFrame, economics: DataFrame) -> DataFrame:
    """V1: the latest month's headline KPIs with changes since the month before."""
    w = Window.orderBy("month_date")
    costs = economics_kpis(economics)
    ltv, spend = costs.select("ltv_to_cac").scalar(), costs.select("total_acquisition_spend").scalar()
    rows = revenue_kpis(fct_mrr).withColumns(
        {"previous_quick_ratio": F.lag("quick_ratio").over(w), "previous_mrr": F.lag("mrr").over(w)}
    )
    latest = rows.orderBy(F.desc("month_date")).limit(1)
    return latest.select(
        "month_date", "mrr", money_label(F.col("mrr")).alias("mrr_label"),
        "mrr_mom", trend_arrow(F.col("mrr_mom")).alias("mrr_trend"),
        "arr", money_label(F.col("arr")).alias("arr_label"),
        "net_revenue_retention", "nrr_status", "gross_revenue_retention", "logo_churn", "quick_ratio",
        trend_arrow(F.col("quick_ratio") - F.col("previous_quick_ratio")).alias("quick_ratio_trend"),
        "active_customers", "rule_of_40_proxy", ratio(F.col("net_new_mrr") * 12, spend).alias("magic_number"),
        ltv.alias("ltv_to_cac"),
        (F.col("mrr") - F.col("previous_mrr")).alias("mrr_change"),
    )


def mrr_trend(fct_mrr: DataFrame) -> DataFrame:
    """V2."""
    return fct_mrr.select("month_key", "ending_mrr", "active_customers").orderBy("month_key")


def waterfall_steps(fct_mrr: DataFrame) -> DataFrame:
    """V3: bars of the latest month's movement chart with their starting heights."""
    last = fct_mrr.orderBy(F.desc("month_date")).limit(1)
    new, up, down, lost = (F.col(c) for c in ("new_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr"))
    net, zero = F.col("net_new_mrr"), F.lit(0)
    bars = [
        ("New", new, zero), ("Expansion", up, new), ("Contraction", down, new + up - down),
        ("Churn", lost, net), ("Net New", net, zero),
    ]
    structs = [
        F.struct(
            F.lit(i + 1).alias("step"), F.lit(label).alias("label"), dbl(height).alias("height"),
            dbl(bottom).alias("bottom"),
        )
        for i, (label, height, bottom) in enumerate(bars)
    ]
    return last.select("month_key", F.inline(F.array(*structs)))


def arr_by_tier(dim_subscriptions: DataFrame) -> DataFrame:
    """V4: annualised MRR of active subscriptions; every tier keeps a row."""
    tiers = _labels(dim_subscriptions.sparkSession, "plan_tier", rules.PLAN_TIERS)
    active = (
        dim_subscriptions.where(F.col("is_active"))
        .groupBy("plan_tier")
        .agg(F.count("*").alias("n"), F.sum("mrr").alias("mrr"))
    )
    return (
        tiers.join(active, "plan_tier", "left")
        .orderBy("position")
        .select(
            "plan_tier",
            F.coalesce(F.col("n"), F.lit(0)).alias("active_subscriptions"),
            money(F.coalesce(F.col("mrr"), F.lit(0).cast("decimal(18,2)")) * 12).alias("arr"),
        )
    )


def trial_split(dim_customers: DataFrame) -> DataFrame:
    """V5: trial customers that converted and that did not."""
    return dim_customers.where(F.col("is_trial")).groupBy("converted_from_trial").agg(F.count("*").alias("customers"))


def plan_progression_matrix(dim_customers: DataFrame, plan_names: list[str]) -> DataFrame:
    """V6: customers by first plan (rows) and current plan (columns)."""
    return (
        dim_customers.where(F.col("initial_plan_name").isNotNull())
        .groupBy("initial_plan_name")
        .pivot("current_plan_name", plan_names)
        .agg(F.count(F.lit(1)))
        .na.fill(0)
    )


def expansion_versus_contraction(fct_mrr: DataFrame) -> DataFrame:
    """V7."""
    return fct_mrr.select("month_key", "expansion_mrr", "contraction_mrr").orderBy("month_key")


def channel_points(economics: DataFrame) -> DataFrame:
    """V8: one point per channel for the scorecards and the spend scatter."""
    return economics.where(F.col("acquisition_channel") != rules.BLENDED).select(
        "acquisition_channel", "ltv_to_cac_ratio", "cac", "realized_ltv", "cac_payback_months",
        "acquisition_roi_pct",
        rnd(ratio(F.col("total_lifetime_revenue"), F.col("total_acquisition_spend")), 2).alias("revenue_per_spend"),
        "total_acquisition_spend", "total_lifetime_revenue", "customers_acquired",
        (F.col("ltv_to_cac_ratio") >= 3).alias("meets_target"),
        rules.channel_action(F.col("ltv_to_cac_ratio"), F.col("cac_payback_months")).alias("recommended_action"),
    )


def industry_tier_matrix(dim_customers: DataFrame) -> DataFrame:
    """V9: customers by industry (rows) and plan tier (columns)."""
    return (
        dim_customers.groupBy("industry").pivot("current_plan_tier", rules.PLAN_TIERS).agg(F.count(F.lit(1))).na.fill(0)
    )


def market_cards(dim_customers: DataFrame) -> DataFrame:
    """V9: totals and the industry with the most MRR."""
    by_industry = dim_customers.groupBy("industry").agg(
        F.count("*").alias("n"),
        count_where(F.col("customer_status") == "active_paying").alias("paying"),
        F.sum("current_mrr").alias("mrr"),
    )
    return by_industry.agg(
        F.sum("n").alias("total_customers"),
        F.sum("paying").alias("paying_customers"),
        pct(F.sum("paying"), F.sum("n"), 0).alias("paying_pct"),
        F.sum("mrr").alias("total_mrr"),
        rnd(ratio(F.sum("mrr"), F.sum("n")), 2).alias("arpu"),
        # Largest MRR; the alphabetically first industry on a tie.
        F.min_by("industry", F.struct((-F.col("mrr")).alias("m"), "industry")).alias("top_industry"),
        money_label(F.max("mrr")).alias("top_industry_mrr"),
    )


def segment_points(segments: DataFrame) -> DataFrame:
    """Penetration against average revenue, from the segment report."""
    return segments.select("company_size", "industry", "paying_rate_pct", "arpu", "segment_label")


def risk_band_counts(risk: DataFrame) -> DataFrame:
    """All four bands, empty ones included."""
    bands = _labels(risk.sparkSession, "risk_band", rules.RISK_BANDS)
    counts = risk.groupBy("risk_band").agg(F.count("*").alias("n"), F.sum("mrr_at_risk").alias("mrr"))
    return (
        bands.join(counts, "risk_band", "left")
        .orderBy("position")
        .select(
            "risk_band",
            F.coalesce(F.col("n"), F.lit(0)).alias("customers"),
            F.coalesce(F.col("mrr"), F.lit(0).cast("decimal(18,2)")).alias("mrr_at_risk"),
        )
    )


def risk_drivers(risk: DataFrame) -> DataFrame:
    """Mean points per component, one row each."""
    means = risk.agg(*[mean(F.col(p)).alias(p) for p in rules.RISK_POINTS])
    return means.unpivot([], rules.RISK_POINTS, "driver", "avg_points")


def cohort_heatmap(retention: DataFrame, periods: int = 12) -> DataFrame:
    """Retention rate by cohort (rows) and period M0..Mn (columns)."""
    labels = [f"M{i}" for i in range(periods + 1)]
    return retention.groupBy("cohort_month_key").pivot("period_label", labels).agg(F.first("retention_rate"))


def risk_accounts(risk: DataFrame) -> DataFrame:
    """High and critical accounts by score, with the component that weighs most."""
    points = [
        F.struct(F.col(p).cast("int").alias("points"), F.lit(-i).alias("rank"), F.lit(p).alias("driver"))
        for i, p in enumerate(rules.RISK_POINTS)
    ]
    strongest = F.array_max(F.array(*points))
    return (
        risk.where(F.col("risk_band").isin("high", "critical"))
        .select(
            "customer_id", "company_name", "current_mrr", "churn_risk_score", "risk_band",
            strongest["driver"].alias("top_driver"), strongest["points"].alias("top_driver_points"),
        )
        .orderBy(F.desc("churn_risk_score"), F.desc("current_mrr"), "customer_id")
    )


def slicer_values(dim_customers: DataFrame, fct_mrr: DataFrame) -> DataFrame:
    """The values each report slicer offers, from one pass over the customers."""
    slicers = {
        "plan_tier": "current_plan_tier", "channel": "acquisition_channel", "industry": "industry",
        "company_size": "company_size",
    }
    pairs = [F.struct(F.lit(k).alias("slicer"), F.col(c).alias("value")) for k, c in slicers.items()]
    customers = dim_customers.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull()).distinct()
    return customers.unionByName(fct_mrr.select(F.lit("month").alias("slicer"), F.col("month_key").alias("value")))


def stamped(df: DataFrame, at: dt.datetime) -> DataFrame:
    return df.withColumn("_generated_at", F.lit(at))


def last_refresh(ledger: DataFrame) -> DataFrame:
    """Per mart the rows written and the time up to which its facts reach, from the run ledger."""
    return ledger.select(F.col("table").cast("string").alias("table"), "rows", F.col("as_of").alias("last_refresh"))


def date_spine(bounds: DataFrame, part: str = "day") -> DataFrame:
    """M1: every day, Sunday-started week or month between a one-row ``first`` and ``last``."""
    starts = {"day": lambda c: c, "week": week_start, "month": month_start}
    start = starts[part]
    return bounds.select(
        F.explode(
            F.sequence(start(F.col("first")), start(F.col("last")), F.expr(f"interval 1 {part}"))
        ).alias("date_value")
    )


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day with its year, month, month start and quarter."""
    day = F.col("date_value")
    return date_spine(bounds).select(
        day.alias("date"), F.year(day).alias("year"), month_key(day).alias("month"),
        month_start(day).alias("month_start"), quarter_key(day).alias("quarter"),
    )


def star_view(
    events: DataFrame, dim_customers: DataFrame, dim_subscriptions: DataFrame, days: DataFrame
) -> DataFrame:
    """Events with their customer, subscription and calendar attributes, many to one."""
    customer = dim_customers.select("customer_id", "customer_status", "health_status", "current_plan_tier")
    subscription = dim_subscriptions.select(
        "subscription_id", F.col("status").alias("subscription_status"), "billing_cycle", "is_annual"
    )
    date = days.select(F.col("date").alias("event_date"), F.col("quarter").alias("calendar_quarter"))
    facts = events.select("event_id", "customer_id", "subscription_id", "event_type", "event_date", "mrr_change")
    facts = facts.join(customer, "customer_id", "left")
    return facts.join(subscription, "subscription_id", "left").join(date, "event_date", "left")


def feature_adoption(dim_subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """active subscriptions that include each plan feature."""
    per_plan = dim_subscriptions.where(F.col("is_active")).groupBy("plan_id").agg(F.count("*").alias("n"))
    features = plans.select("plan_id", F.explode(F.split("features", ",")).alias("feature"))
    return per_plan.join(features, "plan_id").groupBy("feature").agg(F.sum("n").alias("active_subscriptions"))
