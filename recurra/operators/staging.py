"""Typed, cleaned entities from text tables. One projection each, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.functions.dates import month_key, parse_date, parse_timestamp, whole_units
from recurra.functions.rules import event_category
from recurra.settings import Settings

AMOUNT = "decimal(18,4)"
TRUE_TEXTS = ("true", "1", "yes")
FALSE_TEXTS = ("false", "0", "no")


def _low(name: str) -> Column:
    return F.lower(F.trim(name))


def _up(name: str) -> Column:
    return F.upper(F.trim(name))


def parse_flag(name: str) -> Column:
    text = F.lower(name)
    return F.when(text.isin(*TRUE_TEXTS), True).when(text.isin(*FALSE_TEXTS), False)


def _rows(raw: DataFrame, key: str, beside: bool, *columns: Column | str) -> DataFrame:
    """Staged columns of the rows with a key; ``beside`` keeps every row and its raw cells as ``raw``, for checks of both."""
    if beside:
        return raw.select(F.struct(*raw.columns).alias("raw"), *columns)
    return raw.where(F.col(key).isNotNull()).select(*columns)


class _Cast:
    def __init__(self, settings: Settings):
        self.strict = settings.strict_casts

    def __call__(self, name: str, kind: str) -> Column:
        c = F.col(name)
        return (c.cast(kind) if self.strict else c.try_cast(kind)).alias(name)


def stg_customers(raw: DataFrame, settings: Settings, beside: bool = False) -> DataFrame:
    cast = _Cast(settings)
    signed_up = parse_timestamp(F.col("signup_date"))
    return _rows(
        raw, "customer_id", beside,
        "customer_id",
        "company_name",
        _up("industry").alias("industry"),
        "company_size",
        _up("country").alias("country"),
        _low("email").alias("email"),
        cast("acquisition_channel_id", "bigint"),
        cast("initial_plan_id", "bigint"),
        parse_flag("is_trial").alias("is_trial"),
        parse_date(F.col("trial_end_date")).alias("trial_end_date"),
        signed_up.alias("signed_up_at"),
        F.to_date(signed_up).alias("signup_date"),
    )


def stg_subscriptions(raw: DataFrame, settings: Settings, beside: bool = False) -> DataFrame:
    cast = _Cast(settings)
    start, end = parse_date(F.col("start_date")), parse_date(F.col("end_date"))
    # The raw text decides: an end date that cannot be parsed leaves the length unknown.
    until = F.when(F.col("end_date").isNull(), F.lit(settings.as_of)).otherwise(end)
    return _rows(
        raw, "subscription_id", beside,
        "subscription_id",
        "customer_id",
        cast("plan_id", "bigint"),
        _low("status").alias("status"),
        _low("billing_cycle").alias("billing_cycle"),
        cast("mrr", AMOUNT),
        start.alias("start_date"),
        end.alias("end_date"),
        F.datediff(until, start).alias("subscription_length_days"),
        parse_timestamp(F.col("created_at")).alias("created_at"),
        parse_timestamp(F.col("updated_at")).alias("updated_at"),
    )


def stg_subscription_events(raw: DataFrame, settings: Settings, beside: bool = False) -> DataFrame:
    cast = _Cast(settings)
    typed = _rows(
        raw, "event_id", beside,
        "event_id",
        "subscription_id",
        "customer_id",
        cast("plan_id", "bigint"),
        _low("event_type").alias("event_type"),
        cast("mrr_change", AMOUNT),
        cast("mrr_after", AMOUNT),
        parse_timestamp(F.col("event_date")).alias("event_at"),
    )
    on = F.to_date("event_at")
    return typed.withColumns(
        {
            "event_category": event_category(F.col("event_type")),
            "event_date": on,
            "event_year": F.year(on),
            "event_month": F.month(on),
            "event_month_key": month_key(on),
        }
    )


def stg_payments(raw: DataFrame, settings: Settings, beside: bool = False) -> DataFrame:
    cast = _Cast(settings)
    status, paid = _low("status"), parse_date(F.col("payment_date"))
    return _rows(
        raw, "payment_id", beside,
        "payment_id",
        "subscription_id",
        "customer_id",
        cast("amount", AMOUNT),
        _up("currency").alias("currency"),
        _low("payment_method").alias("payment_method"),
        status.alias("status"),
        status.eqNullSafe("succeeded").alias("is_successful"),
        status.eqNullSafe("failed").alias("is_failed"),
        paid.alias("payment_date"),
        month_key(paid).alias("payment_month_key"),
        parse_timestamp(F.col("created_at")).alias("created_at"),
    )


def stg_marketing_touches(raw: DataFrame, settings: Settings, beside: bool = False) -> DataFrame:
    cast = _Cast(settings)
    typed = _rows(
        raw, "touch_id", beside,
        "touch_id",
        "customer_id",
        cast("channel_id", "bigint"),
        _low("touch_type").alias("touch_type"),
        _low("landing_page").alias("landing_page"),
        F.nullif(F.trim("utm_campaign"), F.lit("")).alias("utm_campaign"),
        parse_timestamp(F.col("touch_date")).alias("touched_at"),
        parse_timestamp(F.col("conversion_date")).alias("converted_at"),
    )
    start, end = F.col("touched_at"), F.col("converted_at")
    return typed.withColumns(
        {
            "touch_date": F.to_date(start),
            "conversion_date": F.to_date(end),
            "days_to_conversion": whole_units("DAY", start, end),
            "hours_to_conversion": whole_units("HOUR", start, end),
        }
    )
