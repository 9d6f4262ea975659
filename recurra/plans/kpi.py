"""KPI measures over the marts, sliced by any customer attribute.

"Last month" is the latest month in scope and "previous month" the calendar month
before it, absent when that month has no row; the monthly fact, by contrast, compares
with the previous row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.functions import rules
from recurra.functions.numbers import annualised, count_where, dbl, mean, money, ratio, rnd
from recurra.operators.mrr import filled_months, month_changes, monthly_sums
from recurra.operators.retention import activity_retention
from recurra.settings import Settings

FLOWS = ["new_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr", "new_customers", "churned_customers"]
STOCKS = ["ending_mrr", "active_mrr", "active_customers"]


def monthly_by(movements: DataFrame, dim_customers: DataFrame, by: list[str]) -> DataFrame:
    """The monthly figures per slice, restarted from customer-months.

    The monthly fact has no customer grain, so slices join movements to the customer.
    """
    return monthly_sums(movements.join(dim_customers.select("customer_id", *by), "customer_id"), by)


def filled_by(movements: DataFrame, dim_customers: DataFrame, by: list[str], settings: Settings) -> DataFrame:
    """V15 over gap-filled months: slices of the recorded movements' changes, summed up month by month."""
    return filled_months(month_changes(movements.join(dim_customers.select("customer_id", *by), "customer_id"), by), settings, by)


def _revenue_measures() -> dict[str, Column]:
    """Measures from one row's flows, last-month stocks and previous-month stocks."""
    c = F.col
    new, up, down, lost = (dbl(x) for x in FLOWS[:4])
    mrr, begin = dbl("ending_mrr"), dbl("beginning_mrr")
    growth = ratio(mrr - begin, begin)
    nrr = ratio(begin + up - down - lost, begin)
    arpc = ratio(c("active_mrr"), c("active_customers"))
    net = new + up - down - lost
    return {
        "mrr": mrr,
        "arr": mrr * 12,
        "active_mrr": dbl("active_mrr"),
        "new_mrr": new,
        "expansion_mrr": up,
        "contraction_mrr": down,
        "churned_mrr": lost,
        "net_new_mrr": net,
        "gross_new_mrr": new + up,
        "gross_lost_mrr": down + lost,
        "mrr_mom": growth,
        "mrr_annualised_growth": annualised(growth),
        "beginning_mrr": begin,
        "net_revenue_retention": nrr,
        "gross_revenue_retention": ratio(begin - down - lost, begin),
        "gross_mrr_churn": ratio(lost, begin),
        "logo_churn": ratio(c("churned_customers"), c("beginning_customers")),
        "quick_ratio": ratio(new + up, down + lost),
        "active_customers": c("active_customers"),
        "new_customers": c("new_customers"),
        "churned_customers": c("churned_customers"),
        "arpc": arpc,
        "arpa_annual": arpc * 12,
        "rule_of_40_proxy": growth * 12 + (nrr - 1),
        "nrr_status": F.when(nrr.isNotNull(), rules.nrr_status(nrr)),
    }


def revenue_kpis(monthly: DataFrame, by: list[str] | None = None) -> DataFrame:
    """K1-K23, K34, K44 for every month, per slice."""
    by = by or []
    w = Window.partitionBy(*by).orderBy("month_date")
    calendar = F.add_months(F.col("month_date"), -1) == F.lag("month_date").over(w)
    rows = monthly.withColumns(
        {
            "beginning_mrr": F.when(calendar, F.lag("ending_mrr").over(w)),
            "beginning_customers": F.when(calendar, F.lag("active_customers").over(w)),
        }
    )
    return rows.select(*by, "month_date", *[v.alias(k) for k, v in _revenue_measures().items()])


def scope_kpis(
    monthly: DataFrame, start: dt.date | None = None, end: dt.date | None = None, by: list[str] | None = None
) -> DataFrame:
    """The same measures for a span of months: flows add up, stocks are the last month's."""
    by = by or []
    month = F.col("month_date")
    inside = F.lit(True)
    if start is not None:
        inside = inside & (month >= F.lit(start))
    if end is not None:
        inside = inside & (month <= F.lit(end))
    # Monthly rows only: the latest month in scope is a window over a small table.
    last = F.max(F.when(inside, month)).over(Window.partitionBy(*by))
    rows = monthly.withColumns({"_in": inside, "_last": last})
    at_last, before = month == F.col("_last"), month == F.add_months(F.col("_last"), -1)
    picked = rows.groupBy(*by).agg(
        F.max("_last").alias("last_month"),
        *[F.sum(F.when(F.col("_in"), F.col(c))).alias(c) for c in FLOWS],
        *[F.sum(F.when(at_last, F.col(c))).alias(c) for c in STOCKS],
        F.sum(F.when(before, F.col("ending_mrr"))).alias("beginning_mrr"),
        F.sum(F.when(before, F.col("active_customers"))).alias("beginning_customers"),
    )
    return picked.select(*by, "last_month", *[v.alias(k) for k, v in _revenue_measures().items()])


def customer_kpis(dim_customers: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Customers, paying customers, total MRR and average revenue. A repeated id counts once."""
    paying = (F.col("customer_status") == "active_paying").cast("int")
    each = dim_customers.groupBy(*(by or []), "customer_id").agg(
        F.max(paying).alias("_paying"), F.sum("current_mrr").alias("_mrr"), F.count("current_mrr").alias("_rows")
    )
    return each.groupBy(*(by or [])).agg(
        F.count("customer_id").alias("total_customers"),
        F.coalesce(F.sum(F.when(F.col("customer_id").isNotNull(), F.col("_paying"))), F.lit(0)).alias("paying_customers"),
        F.sum("_mrr").alias("total_mrr"),
        ratio(F.sum("_mrr"), F.sum("_rows")).alias("arpu"),
    )


def economics_kpis(economics: DataFrame, include_total: bool = False, by: list[str] | None = None) -> DataFrame:
    """K26-K33, K45, K46, per slice; with ``include_total`` the K51 variant that averages the blended row in."""
    rows = economics if include_total else economics.where(F.col("acquisition_channel") != rules.BLENDED)
    spend = F.sum("total_acquisition_spend")
    out = rows.groupBy(*(by or [])).agg(
        F.avg("cac").alias("cac"),
        F.avg("realized_ltv").alias("realized_ltv"),
        F.avg("predicted_ltv").alias("predicted_ltv"),
        F.avg("ltv_to_cac_ratio").alias("ltv_to_cac"),
        F.avg("cac_payback_months").alias("cac_payback_months"),
        (F.avg("acquisition_roi_pct") / 100.0).alias("acquisition_roi"),
        spend.alias("total_acquisition_spend"),
        ratio(F.sum("total_lifetime_revenue"), spend).alias("revenue_per_spend"),
    )
    return out.withColumns(
        {
            "ltv_cac_status": rules.ltv_cac_status(F.col("ltv_to_cac")),
            "payback_status": rules.payback_status(F.col("cac_payback_months")),
        }
    )


def efficiency_kpis(revenue: DataFrame, economics: DataFrame, by: list[str] | None = None) -> DataFrame:
    """K34-K36 per month and slice: rule of 40, magic number and burn multiple against the slice's own spend."""
    spend, net_new_arr = F.col("total_acquisition_spend"), F.col("net_new_mrr") * 12
    if by:
        rows = revenue.join(economics_kpis(economics, by=by).select(*by, "total_acquisition_spend"), by, "left")
    else:
        rows, spend = revenue, economics_kpis(economics).select("total_acquisition_spend").scalar()
    return rows.select(
        *(by or []), "month_date", "rule_of_40_proxy",
        ratio(net_new_arr, spend).alias("magic_number"),
        ratio(spend, net_new_arr).alias("burn_multiple_proxy"),
    )


def risk_kpis(risk: DataFrame, fct_mrr: DataFrame, by: list[str] | None = None) -> DataFrame:
    """K37-K40 and the K52 customer count."""
    mrr = fct_mrr.agg(F.max_by("ending_mrr", "month_date").alias("mrr")).scalar()
    grouped = risk.groupBy(*(by or [])).agg(
        F.count("*").alias("customer_count"),
        mean(F.col("churn_risk_score")).alias("avg_churn_risk_score"),
        count_where(F.col("risk_band").isin("high", "critical")).alias("customers_at_risk"),
        F.sum("mrr_at_risk").alias("mrr_at_risk"),
    )
    return grouped.withColumn("pct_mrr_at_risk", ratio(F.col("mrr_at_risk"), mrr))


def cohort_kpis(retention: DataFrame, by: list[str] | None = None) -> DataFrame:
    """K41-K43 (and the K52 average retention, the same formula)."""
    return retention.groupBy(*(by or [])).agg(
        (F.avg("retention_rate") / 100.0).alias("cohort_retention"),
        (F.avg("mrr_retention_from_m0") / 100.0).alias("cohort_mrr_retention"),
        F.sum("cohort_size").alias("cohort_size"),
    )


def subscription_kpis(dim_subscriptions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """K48."""
    return dim_subscriptions.groupBy(*(by or [])).agg(
        count_where(F.col("is_active")).alias("active_subscriptions"), F.sum("mrr").alias("subscription_mrr")
    )


def stored_kpis(fct_mrr: DataFrame, by: list[str] | None = None) -> DataFrame:
    """K49, K50, per slice: sums of stored columns and the last month's stored ratios."""
    at = F.col("month_date")
    return fct_mrr.groupBy(*(by or [])).agg(
        F.sum("ending_mrr").alias("mrr_monthly_sum"),
        F.sum("net_new_mrr").alias("net_new_mrr_sum"),
        (F.max_by("net_revenue_retention_pct", at) / 100.0).alias("net_revenue_retention"),
        F.max_by("quick_ratio", at).alias("quick_ratio"),
        F.max_by("arpc", at).alias("arpc"),
    )


# --- metrics defined in the documentation only ---------------------------------------


def point_in_time_mrr(dim_subscriptions: DataFrame) -> DataFrame:
    """MRR of active subscriptions as recorded, and with annual plans at a twelfth of their price."""
    active = dim_subscriptions.where(F.col("is_active"))
    return active.groupBy("billing_cycle").agg(
        F.count("*").alias("active_subscriptions"),
        money(F.sum("mrr")).alias("mrr"),
        rnd(F.sum("effective_monthly_price"), 2).alias("normalised_mrr"),
    )


def net_new_both_ways(fct_mrr: DataFrame) -> DataFrame:
    """Net new MRR from movements and from the change of the ending balance."""
    before = F.coalesce(F.lag("ending_mrr").over(Window.orderBy("month_date")), F.lit(0))
    change = F.col("ending_mrr") - before
    return fct_mrr.select(
        "month_key", "net_new_mrr", change.alias("balance_change"), (F.col("net_new_mrr") - change).alias("gap")
    )


def lifetime_value(fct_mrr: DataFrame) -> DataFrame:
    """N3, simple form: ARPC over the monthly customer churn rate."""
    churn = F.col("gross_customer_churn_rate_pct") / 100.0
    return fct_mrr.select(
        "month_key", "arpc", "gross_customer_churn_rate_pct", rnd(ratio(F.col("arpc"), churn), 2).alias("simple_ltv")
    )


def historical_ltv(dim_customers: DataFrame, by: list[str] | None = None) -> DataFrame:
    """N3, historical form: collected payments per customer."""
    return dim_customers.groupBy(*(by or [])).agg(
        F.count("customer_id").alias("customers"),
        F.sum("lifetime_revenue").alias("collected"),
        rnd(mean(F.col("lifetime_revenue")), 2).alias("historical_ltv"),
    )


def benchmark_bands(fct_mrr: DataFrame) -> DataFrame:
    """Each month's metrics against their published bands."""
    return fct_mrr.select(
        "month_key",
        F.when(F.col("mrr_growth_rate_pct").isNotNull(), rules.growth_stage(F.col("mrr_growth_rate_pct"))).alias(
            "growth_band"
        ),
        rules.mrr_churn_band(F.col("gross_mrr_churn_rate_pct")).alias("mrr_churn_band"),
        rules.nrr_band(F.col("net_revenue_retention_pct")).alias("nrr_band"),
        rules.quick_ratio_band(F.col("quick_ratio")).alias("quick_ratio_band"),
        rules.logo_churn_band(F.col("gross_customer_churn_rate_pct")).alias("logo_churn_band"),
    )


def payback_bands(economics: DataFrame) -> DataFrame:
    return economics.select(
        "acquisition_channel", "cac_payback_months",
        rules.payback_band(F.col("cac_payback_months")).alias("payback_band"),
    )


def weekly_retention(activity: DataFrame) -> DataFrame:
    """N7."""
    return activity_retention(activity, "week")


def recurring_run_rate(fct_mrr: DataFrame) -> DataFrame:
    """Annualised MRR and net new MRR."""
    return fct_mrr.select(
        "month_key", (F.col("ending_mrr") * 12).alias("ending_arr"), "arr", "net_new_arr",
    )
