"""The registered queries: name -> (spark, folder of the given tables) -> DataFrame.

Raw entities and models are written once per session and data folder under the
session's checkpoint directory, the way a warehouse keeps its tables. ``d…`` queries
compose their model from the raw entities each time; the others read stored models.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from recurra.functions.numbers import cents_to_dollars, decay, divide_or, rnd
from recurra.operators import attribution, customers, economics, mrr, plan_history, retention, risk, subscriptions
from recurra.plans import (
    channel_reports, checks, churn_reports, cohort_reports, datasets, kpi, lifecycle_reports, market_reports,
    performance_reports, roi_reports, slices,
)
from recurra.plans.build import LAYERS, Warehouse
from recurra.settings import Settings
from recurra.sources import lookups
from recurra.sources.io import (
    coerce_columns, export_marts, fingerprints, plain_types, read_mart_extract, read_raw, register, scratch,
    to_extract, write_mart,
)
from recurra.sources.schemas import EXTRACTS
from recurra.sources.testbed import Testbed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SETTINGS = Settings()

_open: dict[tuple[str, str], Warehouse] = {}


def fresh(w: Warehouse, label: str) -> str:
    """A new folder for each call, so that a DataFrame of an earlier call keeps its files."""
    return f"{w.folder}/{label}-{uuid.uuid4().hex}"


def warehouse(spark: SparkSession, path: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, path)
    if key not in _open:
        folder = f"{scratch(spark)}/recurra-{hashlib.sha1(path.encode()).hexdigest()[:12]}"
        _open[key] = Warehouse(spark, Testbed(spark, path, SETTINGS, folder).entity, SETTINGS, folder=folder)
    return _open[key]


def query(name: str):
    """Register ``build(warehouse)`` under ``name``; results leave in plain types."""

    def keep(build: Callable[[Warehouse], DataFrame]):
        QUERIES[name] = lambda spark, path: plain_types(build(warehouse(spark, path)))
        return build

    return keep


def _register(name: str, build: Callable[[Warehouse], DataFrame]) -> None:
    query(name)(build)


def _rounded(df: DataFrame, names: list[str], places: int = 6) -> DataFrame:
    """Ratios cut to a fixed number of decimals for comparison across engines."""
    return df.withColumns({n: rnd(F.col(n), places) for n in names})


def _kpi_rounded(df: DataFrame) -> DataFrame:
    """Every DOUBLE measure cut to six decimals."""
    return _rounded(df, [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)])


# --- datasets -----------------------------------------------------------------------

for _name, _table in {
    "d01_stg_customers": "stg_customers",
    "d02_stg_subscriptions": "stg_subscriptions",
    "d03_stg_subscription_events": "stg_subscription_events",
    "d04_stg_payments": "stg_payments",
    "d05_stg_marketing_touches": "stg_marketing_touches",
    "d06_customer_subscription_history": "int_customer_subscription_history",
    "d07_mrr_movements": "int_mrr_movements",
    "d09_fct_mrr": "fct_mrr",
    "d09_fct_mrr_filled": "fct_mrr_filled",
    "d10_fct_subscription_events": "fct_subscription_events",
    "d11_dim_customers": "dim_customers",
    "d12_dim_subscriptions": "dim_subscriptions",
    "d13_cohort_retention": "rpt_cohort_retention",
    "d15_churn_risk": "rpt_churn_risk",
    "d24_spine_mrr": "int_spine_filled_mrr",
    "d29_billing_schedule": "billing_schedule",
}.items():
    _register(_name, lambda w, t=_table: w.lazy(t))


@query("d08_attribution_touchpoints")
def _(w: Warehouse) -> DataFrame:
    ratios = [f"{m}_{kind}" for m in attribution.MODELS for kind in ("weight", "revenue")]
    return _rounded(w.lazy("int_attribution_touchpoints"), ratios).drop("hours_to_conversion")


@query("d14_unit_economics")
def _(w: Warehouse) -> DataFrame:
    return _rounded(w.lazy("rpt_unit_economics"), ["observed_churn_rate"])


_register("d16_current_subscription", lambda w: customers.current_subscription(w.lazy("stg_subscriptions")))
_register("d17_subscription_history", lambda w: customers.subscription_history(w.lazy("stg_subscriptions")))
_register("d18_event_metrics", lambda w: customers.event_metrics(w.lazy("stg_subscription_events")))
_register(
    "d19_payment_metrics",
    lambda w: _rounded(customers.payment_metrics(w.lazy("stg_payments")), ["avg_payment_amount"]),
)
_register(
    "d20_subscription_event_metrics",
    lambda w: subscriptions.subscription_event_metrics(w.lazy("stg_subscription_events")),
)
_register("d21_customer_value", lambda w: attribution.customer_value(w.lazy("stg_subscriptions")))
_register("d22_cohort_sizes", lambda w: retention.cohort_sizes(w.lazy("stg_customers")))
_register("d23_month_spine", lambda w: mrr.month_spine(w.lazy("stg_subscription_events")))
_register(
    "d25_channel_rollup",
    lambda w: _rounded(
        economics.channel_rollup(w.lazy("dim_customers")), ["avg_lifetime_revenue", "arpc", "avg_tenure_days"]
    ),
)
_register(
    "d26_first_last_channels",
    lambda w: attribution.first_last_channels(w.lazy("stg_marketing_touches"), w.lazy("marketing_channels")),
)


def _activity(w: Warehouse) -> DataFrame:
    signups = w.lazy("stg_customers").select("customer_id", "signup_date")
    days = w.lazy("stg_subscription_events").select("customer_id", F.col("event_date").alias("activity_date"))
    return days.distinct().join(signups, "customer_id")


_register("d27_activity_retention", lambda w: retention.activity_retention(_activity(w)))


@query("d28_monthly_change_labels")
def _(w: Warehouse) -> DataFrame:
    months = mrr.customer_months(w.lazy("stg_subscription_events")).select(
        "customer_id", F.col("month_date").alias("mrr_month"), F.col("ending_mrr").alias("mrr_amount")
    )
    return mrr.label_monthly_changes(months)


@query("d30_lifecycle_events")
def _(w: Warehouse) -> DataFrame:
    timeline = plan_history.number_subscriptions(*w.raw.__self__.arranged_states())
    return plan_history.lifecycle_events(timeline).select(
        "custkey", "state_id", "state_at", "event_type", "event_plan_id", "mrr", "mrr_change", "subscription_no"
    )


# --- analyses -----------------------------------------------------------------------


def _report(name: str, function, *tables: str, settings: bool = False) -> None:
    def build(w: Warehouse) -> DataFrame:
        args = [w.table(t) for t in tables]
        return function(*args, w.settings) if settings else function(*args)

    _register(name, build)


_report("q01_cohort_retention", cohort_reports.retention_matrix, "dim_customers", "fct_subscription_events")
_report("q02_cohort_revenue_retention", cohort_reports.revenue_retention, "dim_customers", "fct_subscription_events")
_report("q03_cohort_comparison", cohort_reports.cohort_comparison, "dim_customers")
_report("q04_cohort_behaviour", cohort_reports.cohort_behaviour, "dim_customers")
_report("q05_monthly_churn", churn_reports.monthly_churn, "fct_subscription_events", "fct_mrr")
_report("q06_churn_by_segment", churn_reports.churn_by_segment, "dim_customers")
_report("q07_churn_timing", churn_reports.churn_timing, "fct_subscription_events")
_report("q08_pre_churn", churn_reports.events_before_churn, "fct_subscription_events")
_report("q09_at_risk_customers", churn_reports.at_risk_customers, "dim_customers", settings=True)
_report("q10_churned_vs_retained", churn_reports.churned_versus_retained, "dim_customers")
_report("q11_channel_overview", channel_reports.channel_overview, "dim_customers")
_report("q12_attribution_comparison", channel_reports.attribution_comparison, "int_attribution_touchpoints")
_report("q13_journey_positions", channel_reports.journey_positions, "int_attribution_touchpoints")
_report("q14_journeys_by_length", channel_reports.journeys_by_length, "int_attribution_touchpoints")
_report("q15_channel_pairs", channel_reports.channel_pairs, "int_attribution_touchpoints")
_report("q16_channel_segments", channel_reports.channel_segments, "dim_customers")
_report("q17_paid_vs_organic", channel_reports.paid_versus_organic, "dim_customers")
_report("q18_lifecycle_stages", lifecycle_reports.stage_distribution, "dim_customers")
_report("q19_trial_conversion", lifecycle_reports.trial_conversion, "dim_customers")
_report("q20_time_to_value", lifecycle_reports.time_to_value, "int_customer_subscription_history")
_report("q21_plan_progression", lifecycle_reports.plan_progression, "dim_customers")
_report("q22_tenure_survival", lifecycle_reports.tenure_survival, "dim_customers")
_report("q23_latest_snapshot", performance_reports.latest_snapshot, "fct_mrr")
_report("q24_mrr_waterfall", performance_reports.mrr_waterfall, "fct_mrr")
_report("q25_growth_efficiency", performance_reports.growth_efficiency, "fct_mrr")
_report("q26_quarter_over_quarter", performance_reports.quarter_over_quarter, "fct_mrr")
_report("q27_performance_by_tier", performance_reports.performance_by_tier, "dim_subscriptions")
_report("q28_channel_scorecard", roi_reports.channel_scorecard, "rpt_unit_economics")
_report("q29_paid_vs_organic_return", roi_reports.paid_versus_organic_return, "rpt_unit_economics")
_report("q30_spend_frontier", roi_reports.spend_frontier, "rpt_unit_economics")
_report("q31_channel_by_tier", roi_reports.channel_by_tier, "dim_customers")
_report("q32_revenue_by_industry", market_reports.revenue_by_industry, "dim_customers")
_report("q33_penetration_by_size", market_reports.penetration_by_size, "dim_customers")
_report("q34_revenue_by_country", market_reports.revenue_by_country, "dim_customers")
_report("q35_industry_by_tier", market_reports.industry_by_tier, "dim_customers")
_report("q36_segment_health", market_reports.segment_health, "dim_customers")


# --- KPI measures ---------------------------------------------------------------------

_report("k01_k23_revenue_measures", lambda f: _kpi_rounded(kpi.revenue_kpis(f)), "fct_mrr")
_report("k01_k23_revenue_measures_filled", lambda f: _kpi_rounded(kpi.revenue_kpis(f)), "fct_mrr_filled")
_report("k01_k23_scope_measures", lambda f: _kpi_rounded(kpi.scope_kpis(f, dt.date(1999, 1, 1), dt.date(1999, 12, 1))), "fct_mrr")
_report("k24_k25_customer_measures", lambda d: _kpi_rounded(kpi.customer_kpis(d)), "dim_customers")
_report("k26_k33_unit_economics", lambda e: _kpi_rounded(kpi.economics_kpis(e)), "rpt_unit_economics")
_report(
    "k34_k36_efficiency",
    lambda f, e: _kpi_rounded(kpi.efficiency_kpis(kpi.revenue_kpis(f), e)), "fct_mrr_filled", "rpt_unit_economics",
)
_report(
    "k26_k33_by_category", lambda e: _kpi_rounded(kpi.economics_kpis(e, by=["acquisition_channel_category"])),
    "rpt_unit_economics",
)


def _by_channel(w: Warehouse) -> DataFrame:
    by = ["acquisition_channel"]
    return kpi.revenue_kpis(kpi.filled_by(w.table("int_mrr_movements"), w.table("dim_customers"), by, w.settings), by)


@query("k34_k36_by_channel")
def _(w: Warehouse) -> DataFrame:
    return _kpi_rounded(kpi.efficiency_kpis(_by_channel(w), w.table("rpt_unit_economics"), ["acquisition_channel"]))


_report("k37_k40_churn_risk", lambda r, f: _kpi_rounded(kpi.risk_kpis(r, f)), "rpt_churn_risk", "fct_mrr")
_report("k41_k43_cohorts", lambda r: _kpi_rounded(kpi.cohort_kpis(r)), "rpt_cohort_retention")
_report("k41_k43_cohorts_by_period", lambda r: _kpi_rounded(kpi.cohort_kpis(r, ["period_label"])), "rpt_cohort_retention")
_report("k47_customers_by_industry", lambda d: _kpi_rounded(kpi.customer_kpis(d, ["industry"])), "dim_customers")
_report("k48_subscriptions", lambda s: kpi.subscription_kpis(s, ["plan_tier"]), "dim_subscriptions")
_report("k49_k50_stored_measures", lambda f: _kpi_rounded(kpi.stored_kpis(f)), "fct_mrr_filled")
_report("k51_economics_with_total", lambda e: _kpi_rounded(kpi.economics_kpis(e, True)), "rpt_unit_economics")
_report("k52_risk_by_industry", lambda r, f: _kpi_rounded(kpi.risk_kpis(r, f, ["industry"])), "rpt_churn_risk", "fct_mrr")


_register("v15_revenue_by_channel", lambda w: _kpi_rounded(_by_channel(w)))


_register(
    "v15_revenue_by_slicer",
    lambda w: _kpi_rounded(slices.revenue_by_slicer(w.table("int_mrr_movements"), w.table("dim_customers"), w.settings)),
)
_register(
    "v15_accounts_by_slicer",
    lambda w: _kpi_rounded(
        slices.accounts_by_slicer(w.table("dim_customers"), w.table("rpt_churn_risk"), w.table("marketing_channels"), w.settings)
    ),
)


@query("v15_revenue_by_tier_and_size")
def _(w: Warehouse) -> DataFrame:
    by = ["current_plan_tier", "company_size"]
    monthly = kpi.monthly_by(w.table("int_mrr_movements"), w.table("dim_customers"), by)
    return _kpi_rounded(kpi.scope_kpis(monthly, by=by))


# --- documented metrics ---------------------------------------------------------------

_report("n01_point_in_time_mrr", kpi.point_in_time_mrr, "dim_subscriptions")
_report("n02_net_new_both_ways", kpi.net_new_both_ways, "fct_mrr_filled")
_report("n03_simple_ltv", kpi.lifetime_value, "fct_mrr_filled")
_report("n03_historical_ltv", lambda d: kpi.historical_ltv(d, ["acquisition_channel"]), "dim_customers")


@query("n04_cost_per_acquisition")
def _(w: Warehouse) -> DataFrame:
    """Spend stands in for a cost ledger: every touch costs a tenth of the channel's typical cost."""
    channels = w.table("marketing_channels")
    touches = w.table("int_attribution_touchpoints").groupBy("channel_id").agg(F.count("*").alias("n"))
    spend = touches.join(channels, "channel_id").select(
        F.col("channel_name").alias("acquisition_channel"),
        F.lit(0).cast("decimal(18,2)").alias("sales_cost"),
        (F.col("n") * F.col("typical_cac") / 10).cast("decimal(18,2)").alias("marketing_cost"),
    )
    return economics.cost_per_acquisition(spend, w.table("dim_customers"))


_report("n05_benchmark_bands", kpi.benchmark_bands, "fct_mrr")
_report("n05_payback_bands", kpi.payback_bands, "rpt_unit_economics")
_report("n06_health_score", risk.health_score, "dim_customers", settings=True)
_register("n07_weekly_retention", lambda w: kpi.weekly_retention(_activity(w)))
_report("n08_run_rate", kpi.recurring_run_rate, "fct_mrr")

# --- report datasets ------------------------------------------------------------------

_report("v01_executive_row", lambda f, e: _kpi_rounded(datasets.executive_row(f, e)), "fct_mrr_filled", "rpt_unit_economics")
_report("v02_mrr_trend", datasets.mrr_trend, "fct_mrr")
_report("v03_waterfall_steps", datasets.waterfall_steps, "fct_mrr")
_report("v04_arr_by_tier", datasets.arr_by_tier, "dim_subscriptions")
_report("v05_trial_split", datasets.trial_split, "dim_customers")
_report(
    "v06_plan_progression_matrix",
    lambda d: datasets.plan_progression_matrix(d, [p[1] for p in lookups.PLAN_TIERS]), "dim_customers",
)
_report("v07_expansion_vs_contraction", datasets.expansion_versus_contraction, "fct_mrr")
_report("v08_channel_points", datasets.channel_points, "rpt_unit_economics")
_report("v09_industry_tier_matrix", datasets.industry_tier_matrix, "dim_customers")
_report("v09_market_cards", datasets.market_cards, "dim_customers")
_report("v10_segment_points", lambda d: datasets.segment_points(market_reports.segment_health(d)), "dim_customers")
_report("v11_risk_bands", datasets.risk_band_counts, "rpt_churn_risk")
_report("v12_risk_drivers", lambda r: _kpi_rounded(datasets.risk_drivers(r)), "rpt_churn_risk")
_report("v13_cohort_heatmap", datasets.cohort_heatmap, "rpt_cohort_retention")
_report("v14_risk_accounts", datasets.risk_accounts, "rpt_churn_risk")
_report("v15_slicer_values", datasets.slicer_values, "dim_customers", "fct_mrr")
_register("v16_last_refresh", lambda w: datasets.last_refresh(w.ledger()))


def _bounds(w: Warehouse) -> DataFrame:
    return w.lazy("stg_subscription_events").agg(F.min("event_date").alias("first"), F.max("event_date").alias("last"))


_register("v17_calendar", lambda w: datasets.calendar(_bounds(w)))
_register(
    "v18_star_view",
    lambda w: datasets.star_view(
        w.table("fct_subscription_events"), w.table("dim_customers"), w.table("dim_subscriptions"),
        datasets.calendar(_bounds(w)),
    ),
)

# --- building blocks --------------------------------------------------------------------

_register("m01_day_spine", lambda w: datasets.date_spine(_bounds(w), "day"))
_register("m01_week_spine", lambda w: datasets.date_spine(_bounds(w), "week"))
_register("m01_month_spine", lambda w: datasets.date_spine(_bounds(w), "month"))


@query("m02_divide_or_default")
def _(w: Warehouse) -> DataFrame:
    growth = divide_or(F.col("net_new_mrr"), F.col("churned_mrr"), 0.0)
    return w.table("fct_mrr").select("month_key", rnd(growth, 6).alias("net_new_per_churned"))


@query("m03_cents_to_dollars")
def _(w: Warehouse) -> DataFrame:
    cents = (F.col("amount") * 100).cast("bigint")
    return w.lazy("stg_payments").select("payment_id", cents_to_dollars(cents).alias("amount_dollars"))


@query("m07_decay_weight")
def _(w: Warehouse) -> DataFrame:
    weight = rnd(decay(F.col("days_to_conversion"), w.settings.half_life_days), 6)
    return w.lazy("stg_marketing_touches").select("touch_id", weight.alias("decay_weight"))


_report("a09_journey_paths", attribution.journey_paths, "int_attribution_touchpoints")
_report(
    "a10_exact_median", lambda h: lifecycle_reports.time_to_value(h, exact=True).select("median_days_to_paid"),
    "int_customer_subscription_history",
)
_report("f30_feature_adoption", datasets.feature_adoption, "dim_subscriptions", "plan_tiers")


@query("d08_attribution_renormalised")
def _(w: Warehouse) -> DataFrame:
    points = attribution.attribution_touchpoints(
        w.lazy("ordered_marketing_touches"), w.lazy("marketing_channels"), w.lazy("stg_customers"),
        w.lazy("stg_subscriptions"), w.settings, renormalise=True, carried=w.lazy("carried_marketing_touches"),
    )
    return _rounded(points.select("touch_id", "customer_id", "time_decay_weight"), ["time_decay_weight"])


# --- sources and sinks --------------------------------------------------------------------


@query("s01_raw_csv")
def _(w: Warehouse) -> DataFrame:
    """Raw customers written as headed CSV and read back as text."""
    path = fresh(w, "csv-customers")
    w.table("raw_customers").write.mode("overwrite").option("header", True).csv(path, quoteAll=False)
    return read_raw(w.spark, path, "customers")


@query("s03_month_partitions")
def _(w: Warehouse) -> DataFrame:
    """Events stored by month; a month filter reads only its folders."""
    path = fresh(w, "by-month-events")
    write_mart(w.table("fct_subscription_events"), path, month_of="event_date")
    stored = w.spark.read.parquet(path).where(F.col("month_key_part").between("1999-01", "1999-06"))
    return stored.groupBy(F.col("month_key_part").cast("string").alias("month_key")).agg(F.count("*").alias("events"))


@query("s04_sql_view")
def _(w: Warehouse) -> DataFrame:
    register(w.table("fct_mrr"), "fct_mrr")
    return w.spark.sql("SELECT month_key, ending_mrr, active_customers FROM fct_mrr WHERE active_customers > 0")


@query("s05_mart_extracts")
def _(w: Warehouse) -> DataFrame:
    """The monthly fact exported in extract form and imported with declared types."""
    paths = export_marts({"fct_mrr": to_extract(w.table("fct_mrr"), "fct_mrr")}, fresh(w, "extracts"))
    return read_mart_extract(w.spark, paths[0], "fct_mrr")


@query("s05_extract_rows")
def _(w: Warehouse) -> DataFrame:
    """Every column of all six extracts after export and typed import, as fingerprints."""
    extracts = {name: to_extract(w.table(name), name) for name in EXTRACTS}
    paths = dict(zip(extracts, export_marts(extracts, fresh(w, "all-extracts")), strict=True))
    return reduce(DataFrame.unionByName, [fingerprints(plain_types(read_mart_extract(w.spark, paths[n], n)), n) for n in extracts])


@query("s06_coerce_columns")
def _(w: Warehouse) -> DataFrame:
    """Raw payments typed by what their cells hold."""
    return coerce_columns(w.table("raw_payments"))


@query("s07_export_bundle")
def _(w: Warehouse) -> DataFrame:
    """Every column of every exported table, read from the written files, as fingerprints."""
    flat = {n: plain_types(w.table(n)) for n in LAYERS["marts"]}
    paths = dict(zip(flat, export_marts(flat, fresh(w, "bundle")), strict=True))
    return reduce(
        DataFrame.unionByName,
        [fingerprints(w.spark.read.csv(paths[n], header=True, schema=flat[n].schema), n) for n in flat],
    )


# --- checks -------------------------------------------------------------------------------

_register("t01_unique", lambda w: checks.repeated_values(w.table))
_register("t02_not_null", lambda w: checks.quarantine_missing(w.table))
_register("t03_accepted_values", lambda w: checks.unexpected_values(w.table))
_report("t04_relationships", checks.quarantine_orphans, "raw_subscriptions", "raw_customers")
_report("t05_balance", checks.unbalanced_months, "fct_mrr")
_report("t05_balance_filled", checks.unbalanced_months, "fct_mrr_filled")
_report("t06_attribution_weights", checks.quarantine_weights, "int_attribution_touchpoints")
_report("t07_churn_score", checks.quarantine_scores, "rpt_churn_risk")
_report("t08_cohort_retention", checks.invalid_retention, "rpt_cohort_retention")
_report("t09_unit_economics", checks.quarantine_economics, "rpt_unit_economics")
_register("t10_suite", lambda w: checks.run_suite(w.table))


@query("t10_on_write")
def _(w: Warehouse) -> DataFrame:
    """The suite's checks of single rows, counted while the stored tables were written."""
    w.run_all()
    return checks.counted_on_write(w.spark, {name: seen for name, seen in w.written.items() if name in LAYERS["marts"] or name in LAYERS["intermediate"]})
