"""Expected billing schedule of every subscription."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recurra.functions.dates import month_start
from recurra.settings import Settings

ANNUAL_FACTOR = 10


def billing_schedule(subscriptions: DataFrame, events: DataFrame, settings: Settings) -> DataFrame:
    """Amounts due on the start date and each following month start, before the end.

    The MRR in force is the last one recorded at or before the due date. Every event is
    first moved to the due date it takes effect on and reduced to one row per date, so
    the as-of step fills forward over months only, not over events. Annual plans pay
    ten months at once in each anniversary month.
    """
    start = F.col("start_date")
    until = F.coalesce(F.col("end_date"), F.lit(settings.as_of))
    first_month = F.add_months(month_start(start), 1)
    last_month = month_start(F.date_sub(until, 1))
    later = F.when(first_month <= last_month, F.expr("sequence(_first, _last, interval 1 month)"))
    due = (
        subscriptions.select("subscription_id", "customer_id", "billing_cycle", "start_date", "end_date")
        .where(start < until)
        .withColumns({"_first": first_month, "_last": last_month})
        .withColumn(
            "due_date",
            F.explode(F.concat(F.array(start), F.coalesce(later, F.array().cast("array<date>")))),
        )
        .drop("_first", "_last", "end_date")
    )
    at = F.col("event_at")
    month = month_start(F.to_date(at))
    on_boundary = at == month.cast("timestamp")
    takes_effect = F.when(on_boundary, month).otherwise(F.add_months(month, 1))
    known = subscriptions.select("subscription_id", "start_date")
    effective = (
        events.withColumn("_month_due", takes_effect)
        .withColumn("_day", F.to_date(at))
        .withColumn("_midnight", at == F.col("_day").cast("timestamp"))
        .groupBy("subscription_id", "_month_due", "_day", "_midnight")
        .agg(F.max(F.struct("event_at", "event_id", "mrr_after")).alias("_e"))
        .join(known, "subscription_id")
        # At or before the start: in force on the start date; later: on its next month start.
        .withColumn(
            "due_date",
            F.when(
                (F.col("_day") < start) | ((F.col("_day") == start) & F.col("_midnight")), start
            ).otherwise(F.col("_month_due")),
        )
        .groupBy("subscription_id", "due_date")
        .agg(F.max("_e").getField("mrr_after").alias("_mrr"))
    )
    w = Window.partitionBy("subscription_id").orderBy("due_date")
    in_force = F.last("_mrr", ignorenulls=True).over(w)
    anniversary = (F.col("billing_cycle") == "annual") & (F.month("due_date") == F.month("start_date"))
    return (
        due.join(effective, ["subscription_id", "due_date"], "left")
        .withColumn("mrr_in_force", in_force)
        .where(F.col("mrr_in_force") > 0)
        .select(
            "subscription_id", "customer_id", "due_date", "billing_cycle", "mrr_in_force",
            F.when(anniversary, F.col("mrr_in_force") * ANNUAL_FACTOR)
            .otherwise(F.col("mrr_in_force"))
            .cast("decimal(20,2)")
            .alias("amount_due"),
        )
    )
