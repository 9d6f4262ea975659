"""Customer-month MRR, its movements and the monthly fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.functions.dates import month_key, month_start
from recurra.functions.numbers import count_where, money, pct, ratio, rnd, sum_where
from recurra.functions.rules import movement_type, simple_movement
from recurra.settings import Settings


def month_spine(events: DataFrame) -> DataFrame:
    """The months in which anything happened."""
    month = month_start(F.col("event_date"))
    return events.select(month.alias("month_date"), month_key(month).alias("month_key")).distinct()


def customer_months(events: DataFrame) -> DataFrame:
    """Last MRR, gross changes and category flags per customer and month with an event.

    A plain aggregate with map-side combine, so no customer gathers in one task.
    """
    change, category = F.col("mrr_change"), F.col("event_category")
    return events.groupBy("customer_id", month_start(F.col("event_date")).alias("month_date")).agg(
        F.max_by("mrr_after", F.struct("event_at", "event_id")).alias("ending_mrr"),
        sum_where(change > 0, change).alias("gross_positive_mrr"),
        sum_where(change < 0, -change).alias("gross_negative_mrr"),
        *[
            F.max((category == c).cast("int")).alias(f"had_{c}")
            for c in ("acquisition", "expansion", "contraction", "churn")
        ],
    )


def _with_movements(months: DataFrame, keep: list[str]) -> DataFrame:
    """Movement amounts against the previous row; at most one row per customer and month."""
    w = Window.partitionBy("customer_id").orderBy("month_date")
    rows = months.withColumns(
        {
            "previous_mrr": F.lag("ending_mrr").over(w),
            "customer_month_number": F.row_number().over(w),
        }
    )
    zero = F.lit(0).cast("decimal(18,4)")
    had, now = F.coalesce(F.col("previous_mrr"), zero), F.col("ending_mrr")
    kind = movement_type(F.col("previous_mrr"), now, F.col("customer_month_number") == 1)
    rows = rows.withColumn("movement_type", kind)
    kind = F.col("movement_type")
    return rows.select(
        "customer_id",
        "month_date",
        month_key(F.col("month_date")).alias("month_key"),
        had.alias("beginning_mrr"),
        "ending_mrr",
        (now - had).alias("net_mrr_change"),
        F.when(kind.isin("new", "resurrection"), now).otherwise(zero).alias("new_mrr"),
        F.when(kind == "resurrection", now).otherwise(zero).alias("resurrection_mrr"),
        F.when(kind == "expansion", now - had).otherwise(zero).alias("expansion_mrr"),
        F.when(kind == "contraction", had - now).otherwise(zero).alias("contraction_mrr"),
        F.when(kind == "churn", had).otherwise(zero).alias("churned_mrr"),
        "movement_type",
        *keep,
        "customer_month_number",
    )


def mrr_movements(events: DataFrame) -> DataFrame:
    """One row per customer and month with an event, as recorded."""
    flags = ["had_acquisition", "had_expansion", "had_contraction", "had_churn"]
    return _with_movements(customer_months(events), flags)


def spine_filled_mrr(events: DataFrame, settings: Settings) -> DataFrame:
    """One row per customer and month from the first event's to today's month.

    Each recorded month is carried forward up to the customer's next one: a look-ahead
    and an explode per row, bounded by the months of the calendar, with no join. Few recorded
    months become many rows, so their partitions are not merged beforehand.
    """
    w = Window.partitionBy("customer_id").orderBy("month_date")
    today = month_start(F.lit(settings.as_of))
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = customer_months(events).select("customer_id", "month_date", "ending_mrr").repartition(tasks, "customer_id")
    upto = F.coalesce(
        F.add_months(F.lead("month_date").over(w), -1), F.greatest(today, F.col("month_date"))
    )
    filled = (
        known.withColumn("upto", upto)
        .withColumn("observed_month", F.col("month_date"))
        .withColumn("month_date", F.explode(F.expr("sequence(month_date, upto, interval 1 month)")))
        .withColumn("has_event", F.col("month_date") == F.col("observed_month"))
    )
    return _with_movements(filled, ["has_event"])


FLOWS = {
    "new_customers": "new", "churned_customers": "churn", "resurrected_customers": "resurrection",
    "expanded_customers": "expansion", "contracted_customers": "contraction",
}
AMOUNTS = ["new_mrr", "resurrection_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr"]
LONGEST = 12 * 9_999  # months of all years that a date can have


def _flows() -> list[Column]:
    """Customers and amounts by kind of movement; months without an event move nothing."""
    kind = F.col("movement_type")
    return [count_where(kind == k).alias(n) for n, k in FLOWS.items()] + [F.sum(c).alias(c) for c in AMOUNTS]


def monthly_sums(movements: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Stocks and flows per month (and slice) of the customer-months at hand.

    Movements are unique on (customer, month), so customers are counted without DISTINCT.
    """
    kind, after = F.col("movement_type"), F.col("ending_mrr")
    return movements.groupBy(*(by or []), "month_date").agg(
        F.count("customer_id").alias("total_customers"), count_where(after > 0).alias("active_customers"),
        F.sum(after).alias("ending_mrr"), sum_where(kind != "churn", after).alias("active_mrr"), *_flows(),
    )


def month_changes(movements: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per month (and slice) the flows, and what the stocks gain in it: the difference array of the gap-filled table.

    ``out_…`` is what leaves after the customers' last recorded month. ``movements`` are the recorded ones (D7); each
    row changes its customer's balance by its ending less its beginning, so no month between two rows is made.
    """
    zero = F.lit(0).cast("decimal(18,4)")
    after, had = F.coalesce("ending_mrr", zero), F.col("beginning_mrr")
    one = lambda c: F.coalesce(c > 0, F.lit(False)).cast("int")
    known = F.col("customer_id").isNotNull().cast("int")
    last = F.lead("month_date").over(Window.partitionBy("customer_id").orderBy("month_date")).isNull()
    return movements.withColumn("_last", last).groupBy(*(by or []), "month_date").agg(
        F.sum(F.when(F.col("customer_month_number") == 1, known).otherwise(0)).alias("in_customers"),
        F.sum(one(after) - one(had)).alias("in_active"), F.sum(after - had).alias("in_mrr"),
        F.sum(F.when(F.col("_last"), known).otherwise(0)).alias("out_customers"),
        F.sum(F.when(F.col("_last"), one(after)).otherwise(0)).alias("out_active"),
        F.sum(F.when(F.col("_last"), after).otherwise(zero)).alias("out_mrr"), *_flows(),
    )


def filled_months(changes: DataFrame, settings: Settings, by: list[str] | None = None) -> DataFrame:
    """Stocks and flows of every month from a slice's first to today's (or its last), by running sums over its changes.

    Only rows per slice and month take part: the grid of months is a range joined to one row per slice.
    """
    by = by or []
    today = month_start(F.lit(settings.as_of))
    span = F.months_between(F.greatest(F.max("month_date"), today), F.min("month_date")).cast("int")
    spans = changes.groupBy(*by).agg(F.min("month_date").alias("_from"), span.alias("_months"))
    months = changes.sparkSession.range(0, LONGEST, 1, 1).withColumnRenamed("id", "_k")
    grid = spans.join(months, F.col("_k") <= F.greatest("_months", F.lit(0))).select(
        *[F.col(c).alias(f"_by_{c}") for c in by], F.add_months("_from", F.col("_k").cast("int")).alias("_month")
    )
    same = [F.col(f"_by_{c}").eqNullSafe(F.col(c)) for c in by] + [F.col("_month") == F.col("month_date")]
    rows = grid.join(changes, reduce(lambda a, b: a & b, same), "left")
    parts = [f"_by_{c}" for c in by]
    upto = Window.partitionBy(*parts).orderBy("_month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*parts).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)

    def stock(what: str) -> Column:
        gone = F.when(F.col("_month") > today, F.coalesce(F.sum(f"out_{what}").over(before), F.lit(0))).otherwise(0)
        return F.sum(f"in_{what}").over(upto) - gone

    zero = F.lit(0).cast("decimal(18,4)")
    return rows.select(
        *[F.col(f"_by_{c}").alias(c) for c in by], F.col("_month").alias("month_date"),
        stock("customers").alias("total_customers"), stock("active").alias("active_customers"),
        stock("mrr").alias("ending_mrr"), stock("mrr").alias("active_mrr"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in FLOWS], *[F.coalesce(c, zero).alias(c) for c in AMOUNTS],
    ).where("total_customers > 0")


def fct_mrr_filled(movements: DataFrame, settings: Settings) -> DataFrame:
    """D9 over the gap-filled months, from the recorded movements."""
    return monthly_fact(filled_months(month_changes(movements), settings))


def fct_mrr(movements: DataFrame) -> DataFrame:
    """One row per month of the recorded movements (D7), or of any customer-months such as D24."""
    return monthly_fact(monthly_sums(movements))


def monthly_fact(monthly: DataFrame) -> DataFrame:
    """Rates and running totals over stocks and flows per month."""
    monthly = monthly.withColumn("month_key", month_key(F.col("month_date")))
    # From here on there is one row per calendar month, so an unpartitioned window is small.
    w = Window.orderBy("month_date")
    new, up, down, lost = (F.col(c) for c in ("new_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr"))
    after, prior, prior_customers = F.col("ending_mrr"), F.col("prior_mrr"), F.col("prior_customers")
    active, active_mrr = F.col("active_customers"), F.col("active_mrr")
    return (
        monthly.withColumns(
            {
                "prior_mrr": F.lag("ending_mrr").over(w),
                "prior_customers": F.lag("active_customers").over(w),
                "cumulative_new_mrr": F.sum("new_mrr").over(w),
                "cumulative_churned_mrr": F.sum("churned_mrr").over(w),
            }
        )
        .select(
            "month_date", "month_key", "total_customers", "active_customers", "new_customers",
            "churned_customers", "resurrected_customers", "expanded_customers", "contracted_customers",
            money("ending_mrr").alias("ending_mrr"),
            money("active_mrr").alias("active_mrr"),
            money("new_mrr").alias("new_mrr"),
            money("resurrection_mrr").alias("resurrection_mrr"),
            money("expansion_mrr").alias("expansion_mrr"),
            money("contraction_mrr").alias("contraction_mrr"),
            money("churned_mrr").alias("churned_mrr"),
            money(new + up).alias("gross_new_mrr"),
            money(down + lost).alias("gross_lost_mrr"),
            money(new + up - down - lost).alias("net_new_mrr"),
            pct(after - prior, prior, 2).alias("mrr_growth_rate_pct"),
            pct(active - prior_customers, prior_customers, 2).alias("customer_growth_rate_pct"),
            pct(lost, prior, 2).alias("gross_mrr_churn_rate_pct"),
            pct(F.col("churned_customers"), prior_customers, 2).alias("gross_customer_churn_rate_pct"),
            pct(prior + up - down - lost, prior, 2).alias("net_revenue_retention_pct"),
            rnd(ratio(new + up, down + lost), 2).alias("quick_ratio"),
            rnd(ratio(active_mrr, active), 2).alias("arpc"),
            money("cumulative_new_mrr").alias("cumulative_new_mrr"),
            money("cumulative_churned_mrr").alias("cumulative_churned_mrr"),
            money(active_mrr * 12).alias("arr"),
            money((new + up - down - lost) * 12).alias("net_new_arr"),
        )
    )


def label_monthly_changes(monthly: DataFrame) -> DataFrame:
    """Label a (customer_id, mrr_month, mrr_amount) table month over month."""
    w = Window.partitionBy("customer_id").orderBy("mrr_month")
    before = F.lag("mrr_amount").over(w)
    return monthly.withColumns(
        {"previous_mrr": before, "first_mrr_month": F.min("mrr_month").over(Window.partitionBy("customer_id"))}
    ).withColumn("mrr_movement_type", simple_movement(F.col("previous_mrr"), F.col("mrr_amount")))
