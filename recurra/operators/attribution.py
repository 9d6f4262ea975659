"""D8, D21, D26 and journey paths: marketing credit under five models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions import rules
from recurra.functions.numbers import dbl, decay, ratio
from recurra.operators.timeline import PART, Steps, sequence
from recurra.settings import Settings

ORDER = ["touched_at", "touch_id"]
MODELS = ["first_touch", "last_touch", "linear", "time_decay", "position_based"]
STEPS = Steps(
    "customer_id", tuple(ORDER),
    number="touch_sequence",
    total={
        "total_touches": ("count", "_one"), "_powers": ("sum", "_power"), "_near": ("sum", "_near_power"),
        "_others": ("sum", "_other"),
    },
    first={"first_touch_at": "touched_at"},
    last={"last_touch_at": "touched_at"},
)


def customer_value(subscriptions: DataFrame) -> DataFrame:
    """First start and peak MRR per customer (named initial_mrr by the report)."""
    return subscriptions.groupBy("customer_id").agg(
        F.min("start_date").alias("first_subscription_date"), F.max("mrr").alias("initial_mrr")
    )


def timeline_rows(touches: DataFrame, settings: Settings) -> DataFrame:
    """Touches with what D8 sums per customer: to be arranged by ``STEPS``."""
    rows = touches.withColumn("_power", decay(F.col("days_to_conversion"), settings.half_life_days))
    before = F.coalesce(F.col("days_to_conversion") >= 0, F.lit(False))
    return rows.withColumns(
        {"_one": F.lit(1), "_near_power": F.when(before, F.col("_power")), "_other": (~before).cast("int")}
    )


def attribution_touchpoints(
    touches: DataFrame,
    channels: DataFrame,
    customers: DataFrame,
    subscriptions: DataFrame,
    settings: Settings,
    renormalise: bool = False,
    carried: DataFrame | None = None,
) -> DataFrame:
    """One row per touch with its weight and revenue under each model.

    ``touches`` are staged touches, or the arranged rows of ``timeline_rows`` with their carries.

    With ``renormalise`` the time-decay weights are scaled to sum to one per customer;
    as recorded they may not when some touches have no or negative distance.
    """
    who = (
        customers.select("customer_id", "company_size", "industry")
        .join(customer_value(subscriptions).select("customer_id", "initial_mrr"), "customer_id", "full")
    )
    rows = touches if PART in touches.columns else timeline_rows(touches, settings)
    rows = sequence(rows, STEPS, carried).drop("_one", "_near_power", "_other").join(who, "customer_id", "left")
    named = channels.select("channel_id", "channel_name", "channel_category", "is_paid", "typical_cac")
    rows = rows.join(named, "channel_id", "left")
    seq, n = F.col("touch_sequence"), F.col("total_touches")
    rows = rows.withColumns(
        {
            "first_touch_weight": rules.first_touch(seq),
            "last_touch_weight": rules.last_touch(seq, n),
            "linear_weight": rules.linear(n),
            "time_decay_weight": rules.time_decay(
                F.col("days_to_conversion"), F.col("_power"), F.col("_powers"), n
            ),
            "position_based_weight": rules.position_based(seq, n),
        }
    )
    if renormalise:
        # What the weights of a customer sum to, from the same totals: touches before the conversion share by power,
        # the others count one part in all.
        decayed = F.coalesce(ratio(F.col("_near"), F.col("_powers")), F.lit(0.0)) + ratio(F.col("_others"), n)
        rows = rows.withColumn("time_decay_weight", ratio(F.col("time_decay_weight"), decayed))
    value = F.coalesce(dbl("initial_mrr"), F.lit(0.0))
    return rows.withColumns(
        {
            **{f"{m}_revenue": value * F.col(f"{m}_weight") for m in MODELS},
            "is_first_touch": seq == 1,
            "is_last_touch": seq == n,
            "journey_stage": rules.journey_stage(seq, n),
        }
    ).drop("_power", "_powers", "_near", "_others")


def first_last_channels(touches: DataFrame, channels: DataFrame) -> DataFrame:
    """First and last channel per customer among touches up to the conversion."""
    at = F.struct(*ORDER)
    return (
        touches.where(F.col("touched_at") <= F.col("converted_at"))
        .join(channels.select("channel_id", "channel_name"), "channel_id", "left")
        .groupBy("customer_id")
        .agg(
            F.min_by("channel_name", at).alias("first_touch_channel"),
            F.max_by("channel_name", at).alias("last_touch_channel"),
        )
    )


def journey_paths(touchpoints: DataFrame, piece: int = 1_000) -> DataFrame:
    """Channels of a journey in order, joined by arrows: one path per customer.

    Concatenated as a tree: pieces of up to ``piece`` neighbouring touches first, wherever they lie, then a customer's pieces in
    order. So no task lists a long journey's touches; only its path comes together, which is one value by definition.
    """
    pieces = (
        touchpoints.groupBy("customer_id", F.floor((F.col("touch_sequence") - 1) / piece).alias("_piece"))
        .agg(F.sort_array(F.collect_list(F.struct("touch_sequence", "channel_name"))).alias("steps"))
        .select(
            "customer_id", "_piece", F.size("steps").cast("bigint").alias("touches"),
            F.array_join(F.col("steps.channel_name"), " → ").alias("path"),
        )
    )
    whole = F.sort_array(F.collect_list(F.struct("_piece", "path")))
    return pieces.groupBy("customer_id").agg(F.sum("touches").alias("touches"), F.array_join(whole["path"], " → ").alias("journey_path"))
