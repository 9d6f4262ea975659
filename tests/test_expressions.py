"""Column expressions on literal rows: every branch and the NULL cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recurra.functions import dates, numbers, rules

D = dt.date


def values(spark, schema, data, *cols):
    df = spark.createDataFrame(data, schema).coalesce(1)
    return [r[0] if len(cols) == 1 else tuple(r) for r in df.select(*cols).collect()]


def test_rounding_ties_use_the_scaled_rule(spark):
    got = values(spark, "x double", [(1.005,), (0.285,), (0.125,), (-0.125,), (None,)], numbers.rnd(F.col("x"), 2))
    assert got == [1.0, 0.28, 0.13, -0.13, None]


def test_ratio_and_defaults(spark):
    data = [(1.0, 4.0), (1.0, 0.0), (1.0, None), (None, 4.0)]
    got = values(spark, "a double, b double", data, numbers.ratio(F.col("a"), F.col("b")), numbers.divide_or(F.col("a"), F.col("b")))
    assert got == [(0.25, 0.25), (None, 0.0), (None, 0.0), (None, None)]


def test_smallest_and_largest_are_null_when_any_input_is(spark):
    got = values(spark, "a int, b int", [(1, 2), (None, 2)], numbers.smallest(F.col("a"), F.col("b")), numbers.largest(F.col("a"), F.col("b")))
    assert got == [(1, 2), (None, None)]


def test_labels(spark):
    got = values(spark, "x double", [(1_140_000.0,), (94_800.0,), (79.0,), (None,)], numbers.money_label(F.col("x")))
    assert got == ["$1.14M", "$94.8K", "$79", None]
    assert values(spark, "x double", [(0.0,), (-1.0,), (None,)], numbers.trend_arrow(F.col("x"))) == ["▲", "▼", None]


def test_decay_and_growth(spark):
    assert values(spark, "d int", [(0,), (7,), (14,), (None,)], numbers.decay(F.col("d"))) == [1.0, 0.5, 0.25, None]
    assert values(spark, "g double", [(0.0,), (1.0,)], numbers.annualised(F.col("g"))) == [0.0, 4095.0]
    assert values(spark, "c long", [(199,), (0,)], numbers.cents_to_dollars(F.col("c"))) == [1.99, 0.0]


def test_month_distance_counts_boundaries(spark):
    data = [(D(2024, 3, 1), D(2024, 1, 31)), (D(2024, 1, 31), D(2024, 1, 1)), (D(2023, 12, 31), D(2024, 1, 1)), (None, D(2024, 1, 1))]
    got = values(spark, "a date, b date", data, dates.months_between_boundaries(F.col("a"), F.col("b")))
    assert got == [2, 0, -1, None]


def test_elapsed_units_are_whole(spark):
    data = [(dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 3, 11))]
    got = values(spark, "a timestamp, b timestamp", data, dates.whole_units("DAY", F.col("a"), F.col("b")), dates.whole_units("HOUR", F.col("a"), F.col("b")))
    assert got == [(1, 47)]


def test_calendar_labels(spark):
    x = F.col("x")
    got = values(spark, "x date", [(D(2024, 5, 8),)], dates.quarter_key(x), dates.weekday_name(x), dates.month_label(x), dates.week_start(x), dates.month_key(x))
    assert got == [("2024-Q2", "Wednesday", "May 2024", D(2024, 5, 5), "2024-05")]
    assert values(spark, "x date", [(D(2024, 5, 5),)], dates.week_start(x)) == [D(2024, 5, 5)]


def test_safe_parsing(spark):
    texts = ["not-a-date", "2024-02-29", "2023-02-29", "2024-2-9", "2024-02-09 x", "2024", "", None]
    got = values(spark, "x string", [(t,) for t in texts], dates.parse_date(F.col("x")))
    assert got == [None, D(2024, 2, 29), None, D(2024, 2, 9), None, None, None, None]
    texts = ["2024-01-31 10:20:30", "2024-01-31", "2024-01-31T10:20:30", "2024-01-31 24:00:00", "2024-1-1 1:2:3", "2024-01-31 10:20:30Z"]
    got = values(spark, "x string", [(t,) for t in texts], dates.parse_timestamp(F.col("x")))
    assert got == [dt.datetime(2024, 1, 31, 10, 20, 30), None, None, None, dt.datetime(2024, 1, 1, 1, 2, 3), None]


def test_event_categories(spark):
    kinds = [(k,) for k in rules.EVENT_CATEGORIES] + [("subscription_renewed",), (None,)]
    got = values(spark, "k string", kinds, rules.event_category(F.col("k")))
    assert got == ["acquisition", "acquisition", "expansion", "contraction", "churn", "other", "other"]


@pytest.mark.parametrize(
    "before, after, first, label",
    [
        (None, 29, True, "new"), (None, 0, True, "unchanged"), (0, 29, False, "resurrection"),
        (29, 79, False, "expansion"), (79, 29, False, "contraction"), (29, 0, False, "churn"),
        (29, 29, False, "unchanged"), (0, 0, False, "unchanged"),
    ],
)
def test_movement_types(spark, before, after, first, label):
    got = values(spark, "b int, a int, f boolean", [(before, after, first)], rules.movement_type(F.col("b"), F.col("a"), F.col("f")))
    assert got == [label]


def test_tenure_edges(spark):
    days = [(d,) for d in (0, 30, 31, 90, 91, 180, 181, 365, 366, None)]
    got = values(spark, "d int", days, rules.customer_tenure(F.col("d")))
    assert got == ["0-30 days"] * 2 + ["31-90 days"] * 2 + ["91-180 days"] * 2 + ["181-365 days"] * 2 + ["365+ days"] * 2
    got = values(spark, "d int", days, rules.subscription_tenure(F.col("d")))
    assert got == ["0-1 month"] * 2 + ["1-3 months"] * 2 + ["3-6 months"] * 2 + ["6-12 months"] * 2 + ["12+ months"] * 2


def test_band_edges(spark):
    got = values(spark, "s int", [(s,) for s in (0, 24, 25, 49, 50, 74, 75, 100)], rules.risk_band(F.col("s")))
    assert got == ["low", "low", "medium", "medium", "high", "high", "critical", "critical"]


def test_position_weights(spark):
    def weights(n):
        data = [(i, n) for i in range(1, n + 1)]
        return values(spark, "s int, n int", data, rules.position_based(F.col("s"), F.col("n")))

    assert weights(1) == [1.0]
    assert weights(2) == [0.5, 0.5]
    assert weights(5) == pytest.approx([0.4, 0.2 / 3, 0.2 / 3, 0.2 / 3, 0.4])


def test_journey_stages(spark):
    data = [(i, 5) for i in range(1, 6)]
    got = values(spark, "s int, n int", data, rules.journey_stage(F.col("s"), F.col("n")))
    assert got == ["awareness", "consideration_early", "consideration_late", "consideration_late", "decision"]


def test_status_and_health(spark):
    got = values(spark, "s string, m int", [("active", 29), ("active", 0), ("churned", 0), (None, None)], rules.customer_status(F.col("s"), F.col("m")))
    assert got == ["active_paying", "active_free", "churned", "unknown"]
    cols = [F.col(c) for c in ("s", "u", "d", "f", "p", "i")]
    data = [
        ("churned", 0, 0, 0, 0, 0), ("active", 0, 1, 0, 1, 0), ("active", 1, 0, 1, 10, 0), ("active", 1, 0, 1, 11, 0),
        ("active", 0, 0, 0, 1, 46), ("active", 0, 0, 0, 1, 45), ("active", None, None, None, None, None),
    ]
    got = values(spark, "s string, u int, d int, f int, p int, i int", data, rules.customer_health(*cols))
    assert got == ["churned", "at_risk", "at_risk", "healthy", "at_risk", "stable", "stable"]


def test_stale_payment_points(spark):
    data = [(0, None), (29, 61), (29, 60), (29, 46), (29, 45), (29, None)]
    got = values(spark, "m int, i int", data, rules.points_stale_payment(F.col("m"), F.col("i")))
    assert got == [0, 20, 12, 12, 0, 15]


def test_score_components_add_up(spark):
    parts = [
        rules.points_payment_failures(F.lit(4)), rules.points_stale_payment(F.lit(29), F.lit(61)),
        rules.points_downgrades(F.lit(0), F.lit(2)), rules.points_mrr_erosion(F.lit(58.0), F.lit(29.0)),
        rules.points_prior_churn(F.lit(True), F.lit(1)), rules.points_early_tenure(F.lit(20)),
    ]
    got = values(spark, "x int", [(1,)], *parts)
    assert got == [(25, 20, 15, 10, 10, 10)]


def test_plan_prices(spark):
    data = [("annual", 29.0, 290.0), ("monthly", 29.0, 290.0), ("annual", 0.0, 0.0)]
    cols = [F.col("c"), F.col("m"), F.col("a")]
    got = values(spark, "c string, m double, a double", data, rules.effective_monthly_price(*cols), rules.annual_discount_pct(*cols))
    assert got == [(24.17, 16.7), (29.0, 0.0), (0.0, None)]


def test_statuses_and_bands(spark):
    assert values(spark, "x double", [(1.2,), (1.0,), (0.99,)], rules.nrr_status(F.col("x"))) == ["Excellent", "Good", "Needs attention"]
    assert values(spark, "x double", [(3.0,), (1.0,), (0.5,)], rules.ltv_cac_status(F.col("x"))) == ["Healthy", "Marginal", "Unprofitable"]
    assert values(spark, "x double", [(12.0,), (18.0,), (18.1,)], rules.payback_status(F.col("x"))) == ["Excellent", "Good", "Concerning"]
    data = [(3.0, 12.0), (3.0, 13.0), (0.9, 1.0), (5.0, None)]
    got = values(spark, "r double, p double", data, rules.channel_action(F.col("r"), F.col("p")))
    assert got == ["scale", "optimize", "reduce", "optimize"]
    assert values(spark, "p boolean", [(True,), (False,), (None,)], rules.paid_or_organic(F.col("p"))) == ["Paid", "Organic", "Organic"]


def test_first_paid_conversion(spark):
    data = [(1, "acquisition", 2, None), (1, "acquisition", 1, None), (2, "expansion", 3, 1), (2, "expansion", 3, 2), (3, "expansion", 3, 1)]
    cols = [F.col(c) for c in ("s", "c", "p", "q")]
    got = values(spark, "s int, c string, p long, q long", data, rules.first_paid_conversion(*cols))
    assert got == [True, False, True, False, False]
