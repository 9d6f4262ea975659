"""The measures of the reports by every slicer at once, each slice's ratios from its own sums.

Sums are taken once per combination of all slicers; grouping sets then roll these few rows up, so the facts are read and
shuffled once for all slicers. The month is kept as a column of the revenue measures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.functions.numbers import count_where, dbl, largest, ratio
from recurra.operators.mrr import filled_months, month_changes
from recurra.plans.kpi import revenue_kpis
from recurra.settings import Settings

SLICERS = {
    "plan_tier": "current_plan_tier", "channel": "acquisition_channel", "industry": "industry", "company_size": "company_size",
}
SLICE = ["slicer", "value"]


def rolled_up(finest: DataFrame, sums: list[str], also: list[str] | None = None) -> DataFrame:
    """Sums per (slicer, value) and ``also``, and of everything (slicer and value ``all``), from sums per combination."""
    columns, also = list(SLICERS.values()), also or []
    sets = [[c, *also] for c in columns] + [also]
    # A slicer's own value may be NULL; the grouping flags tell that from a slicer that is not in the set.
    slicer = value = F
    for name, c in SLICERS.items():
        slicer = slicer.when(F.grouping(c) == 0, F.lit(name))
        value = value.when(F.grouping(c) == 0, F.col(c))
    out = finest.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns + also]).agg(
        slicer.otherwise(F.lit("all")).alias("slicer"), value.otherwise(F.lit("all")).alias("value"),
        *[F.sum(c).alias(c) for c in sums],
    )
    return out.select(*SLICE, *also, *sums)


def revenue_by_slicer(movements: DataFrame, dim_customers: DataFrame, settings: Settings) -> DataFrame:
    """K1-K23 and K34 of every month and slice, over gap-filled months."""
    who = dim_customers.select("customer_id", *SLICERS.values())
    finest = month_changes(movements.join(who, "customer_id"), list(SLICERS.values()))
    sums = [c for c in finest.columns if c not in SLICERS.values() and c != "month_date"]
    changes = rolled_up(finest, sums, ["month_date"])
    return revenue_kpis(filled_months(changes, settings, SLICE), SLICE)


def accounts_by_slicer(dim_customers: DataFrame, risk: DataFrame, channels: DataFrame, settings: Settings) -> DataFrame:
    """Customer, acquisition and risk measures (K24-K33, K37-K40, K47) of every slice."""
    scored = risk.select("customer_id", "churn_risk_score", "risk_band", "mrr_at_risk")
    cost = channels.select(F.col("channel_name").alias("acquisition_channel"), dbl("typical_cac").alias("_cac"))
    rows = dim_customers.join(scored, "customer_id", "left").join(cost, "acquisition_channel", "left")
    earning = F.nullif(F.col("current_mrr"), F.lit(0).cast("decimal(18,4)"))
    sums: dict[str, Column] = {
        "total_customers": F.count("customer_id"),
        "paying_customers": count_where(F.col("customer_status") == "active_paying"),
        "churned_customers": count_where(F.col("has_churned")),
        "total_mrr": F.sum("current_mrr"), "lifetime_revenue": F.sum("lifetime_revenue"), "acquisition_spend": F.sum("_cac"),
        "customers_at_risk": count_where(F.col("risk_band").isin("high", "critical")), "mrr_at_risk": F.sum("mrr_at_risk"),
        "_earning": F.sum(earning), "_earners": F.count(earning), "_with_mrr": F.count("current_mrr"),
        "_score": F.sum("churn_risk_score"), "_scored": F.count("churn_risk_score"),
    }
    finest = rows.groupBy(*SLICERS.values()).agg(*[c.alias(n) for n, c in sums.items()])
    c = F.col
    ltv, cac = ratio(c("lifetime_revenue"), c("total_customers")), ratio(c("acquisition_spend"), c("total_customers"))
    margin = ratio(c("_earning"), c("_earners")) * settings.gross_margin
    churn = largest(ratio(c("churned_customers"), c("total_customers")), F.lit(settings.min_churn_rate))
    return rolled_up(finest, list(sums)).select(
        *SLICE, *[n for n in sums if not n.startswith("_")],
        ratio(c("total_mrr"), c("_with_mrr")).alias("arpu"), cac.alias("cac"), ltv.alias("realized_ltv"),
        ratio(margin, churn).alias("predicted_ltv"), ratio(ltv, cac).alias("ltv_to_cac"), ratio(cac, margin).alias("cac_payback_months"),
        ratio(ltv - cac, cac).alias("acquisition_roi"), ratio(c("lifetime_revenue"), c("acquisition_spend")).alias("revenue_per_spend"),
        ratio(c("_score"), c("_scored")).alias("avg_churn_risk_score"), ratio(c("mrr_at_risk"), c("total_mrr")).alias("pct_mrr_at_risk"),
    )
