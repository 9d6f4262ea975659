"""Operators on tiny hand-made inputs with hand-computed results."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from core_helpers import rows
from recurra.operators import attribution, billing, customers, economics, mrr, risk, staging
from recurra.plans import checks, churn_reports, kpi
from recurra.settings import Settings
from recurra.sources import lookups
from recurra.sources.schemas import RAW

S = Settings(as_of=dt.date(2024, 6, 30))


def raw(spark, entity, *dicts):
    return spark.createDataFrame([tuple(d.get(c) for c in RAW[entity].names) for d in dicts], RAW[entity])


def event(i, customer, at, after, change=0, kind="subscription_upgraded", sub="s1", plan="2"):
    return dict(event_id=f"e{i:03d}", subscription_id=sub, customer_id=customer, event_type=kind,
                event_date=at, plan_id=plan, mrr_change=str(change), mrr_after=str(after))


def events(spark, *items):
    return staging.stg_subscription_events(raw(spark, "subscription_events", *items), S)


def test_customers_are_cleaned(spark):
    flags = ["TRUE", "1", "yes", "false", "0", "NO", "maybe", None]
    data = [
        dict(customer_id=f"c{i}", industry=" tech ", email=" A@B.C ", is_trial=f, trial_end_date="not-a-date",
             signup_date="2024-01-31 10:00:00", acquisition_channel_id="3", initial_plan_id="2")
        for i, f in enumerate(flags)
    ] + [dict(customer_id=None, signup_date="2024-01-01 00:00:00")]
    got = rows(staging.stg_customers(raw(spark, "customers", *data), S), "customer_id", "is_trial", "trial_end_date", "industry", "email", "signup_date")
    assert [r[1] for r in got] == [True] * 3 + [False] * 3 + [None] * 2
    assert {r[2:] for r in got} == {(None, "TECH", "a@b.c", dt.date(2024, 1, 31))}


def test_subscription_length_follows_the_raw_end_date(spark):
    base = dict(customer_id="c", plan_id="2", status=" ACTIVE ", mrr="29.00", start_date="2024-06-01")
    data = [dict(base, subscription_id="a"), dict(base, subscription_id="b", end_date="x"), dict(base, subscription_id="c", end_date="2024-06-11")]
    got = rows(staging.stg_subscriptions(raw(spark, "subscriptions", *data), S), "subscription_id", "subscription_length_days", "status")
    assert got == [("a", 29, "active"), ("b", None, "active"), ("c", 10, "active")]


def test_casts_fail_or_give_null(spark):
    bad = raw(spark, "payments", dict(payment_id="p", amount="abc", status="Failed", payment_date="2024-01-05"))
    got = rows(staging.stg_payments(bad, S.but(strict_casts=False)), "amount", "is_failed", "is_successful", "payment_month_key")
    assert got == [(None, True, False, "2024-01")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_payments(bad, S).collect()


def test_touch_distances_and_campaign(spark):
    data = dict(touch_id="t", customer_id="c", channel_id="1", touch_date="2024-01-01 12:00:00", conversion_date="2024-01-03 11:00:00", utm_campaign="  ")
    got = rows(staging.stg_marketing_touches(raw(spark, "marketing_touches", data), S), "days_to_conversion", "hours_to_conversion", "utm_campaign")
    assert got == [(1, 47, None)]


def test_every_movement(spark):
    path = [0, 29, 79, 29, 0, 29]
    ev = events(spark, *[event(i, "c", f"2024-0{i + 1}-10 00:00:00", m) for i, m in enumerate(path)])
    got = rows(mrr.mrr_movements(ev), "month_key", "movement_type")
    assert [k for _, k in got] == ["unchanged", "resurrection", "expansion", "contraction", "churn", "resurrection"]
    paid = events(spark, event(1, "c", "2024-01-10 00:00:00", 29))
    assert rows(mrr.mrr_movements(paid), "movement_type", "new_mrr", "resurrection_mrr") == [("new", Decimal("29.0000"), Decimal("0.0000"))]


def test_two_events_in_a_month_keep_the_last(spark):
    ev = events(spark, event(2, "c", "2024-01-10 00:00:00", 79), event(1, "c", "2024-01-10 00:00:00", 29))
    assert rows(mrr.mrr_movements(ev.repartition(3)), "ending_mrr") == [(Decimal("79.0000"),)]


def gap(spark):
    return events(
        spark, event(1, "a", "2024-01-05 00:00:00", 29), event(2, "a", "2024-04-05 00:00:00", 79), event(3, "b", "2024-02-05 00:00:00", 199),
    )


def test_gaps_as_recorded_and_filled(spark):
    april = S.but(as_of=dt.date(2024, 4, 30))
    as_recorded, filled = mrr.mrr_movements(gap(spark)), mrr.spine_filled_mrr(gap(spark), april)
    assert as_recorded.where("customer_id = 'a'").count() == 2
    assert filled.where("customer_id = 'a'").count() == 4
    feb = F.col("month_key") == "2024-02"
    assert rows(mrr.fct_mrr(as_recorded).where(feb), "ending_mrr") == [(Decimal("199.00"),)]
    assert rows(mrr.fct_mrr(filled).where(feb), "ending_mrr") == [(Decimal("228.00"),)]
    assert checks.unbalanced_months(mrr.fct_mrr(as_recorded)).count() > 0
    assert checks.unbalanced_months(mrr.fct_mrr(filled)).count() == 0


@pytest.mark.parametrize("today", [dt.date(2020, 4, 20), dt.date(2020, 1, 2), dt.date(2020, 9, 1)])
def test_running_sums_equal_the_filled_months(spark, today):
    """The filled fact from changes per month, against the one from every customer-month, also where customers go on after today."""
    at, money = lambda m, d=3: dt.datetime(2020, m, d), Decimal
    data = [
        ("a", at(1), "e1", 100, 100), ("a", at(6), "e2", -100, 0), ("b", at(3), "e3", 50, 50), ("b", at(5), "e4", 0, 50),
        ("c", at(2), "e5", 0, 0), ("c", at(8), "e6", 70, 70), ("d", at(1), "e7", 10, None), ("d", at(3), "e8", 20, 20), ("a", at(7), "e9", 30, 30),
    ]
    events = spark.createDataFrame(
        [(k, t, i, money(x), None if y is None else money(y), t.date(), "other") for k, t, i, x, y in data],
        "customer_id string, event_at timestamp, event_id string, mrr_change decimal(18,4), mrr_after decimal(18,4), event_date date, event_category string",
    )
    s = Settings(as_of=today)
    every, sums = mrr.fct_mrr(mrr.spine_filled_mrr(events, s)), mrr.fct_mrr_filled(mrr.mrr_movements(events), s)
    assert set(every.columns) == set(sums.columns)
    assert rows(every) == rows(sums, *every.columns)
    assert "Generate" not in sums._jdf.queryExecution().executedPlan().toString()


def test_first_month_rates_are_null(spark):
    got = mrr.fct_mrr(mrr.mrr_movements(gap(spark))).orderBy("month_date").first()
    assert got["mrr_growth_rate_pct"] is None and got["net_revenue_retention_pct"] is None and got["quick_ratio"] is None


def test_kpis_use_the_calendar_month(spark):
    facts = mrr.fct_mrr(mrr.mrr_movements(gap(spark)))
    got = {r["month_date"]: r["beginning_mrr"] for r in kpi.revenue_kpis(facts).collect()}
    assert got == {dt.date(2024, 1, 1): None, dt.date(2024, 2, 1): 29.0, dt.date(2024, 4, 1): None}
    scope = kpi.scope_kpis(facts, dt.date(2024, 1, 1), dt.date(2024, 2, 29)).first()
    assert (scope["mrr"], scope["new_mrr"], scope["beginning_mrr"]) == (199.0, 228.0, 29.0)


def touches(spark, n, undated=()):
    data = [
        dict(touch_id=f"t{i}", customer_id="c", channel_id="1", touch_date=None if i in undated else f"2024-01-0{i} 00:00:00", conversion_date="2024-01-09 00:00:00")
        for i in range(1, n + 1)
    ]
    return staging.stg_marketing_touches(raw(spark, "marketing_touches", *data), S)


def credit(spark, t, **options):
    subs = staging.stg_subscriptions(raw(spark, "subscriptions", dict(subscription_id="s", customer_id="c", mrr="79", start_date="2024-01-01")), S)
    who = staging.stg_customers(raw(spark, "customers", dict(customer_id="c", signup_date="2024-01-01 00:00:00")), S)
    return attribution.attribution_touchpoints(t, lookups.marketing_channels(spark), who, subs, S, **options)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_weights_sum_to_one(spark, n):
    got = credit(spark, touches(spark, n))
    for m in attribution.MODELS:
        assert got.agg(F.sum(f"{m}_weight")).first()[0] == pytest.approx(1.0)
        assert got.agg(F.sum(f"{m}_revenue")).first()[0] == pytest.approx(79.0)
    assert checks.unbalanced_weights(got).count() == 0


def test_undated_touch_gets_an_equal_share(spark):
    got = {r["touch_id"]: r["time_decay_weight"] for r in credit(spark, touches(spark, 3, undated={1})).collect()}
    assert got["t1"] == pytest.approx(1 / 3) and got["t3"] > got["t2"]
    assert sum(got.values()) == pytest.approx(4 / 3)
    scaled = credit(spark, touches(spark, 3, undated={1}), renormalise=True)
    assert scaled.agg(F.sum("time_decay_weight")).first()[0] == pytest.approx(1.0)


@pytest.mark.parametrize("piece", [1, 2, 100])
def test_paths_come_together_from_pieces(spark, piece):
    kinds = touches(spark, 12)
    got = rows(attribution.journey_paths(credit(spark, kinds), piece=piece), "touches", "journey_path")
    assert got == [(12, " → ".join(["google_ads"] * 12))]


def dim(spark, people, subs=(), pays=(), evs=()):
    c = staging.stg_customers(raw(spark, "customers", *[dict(dict(signup_date="2024-06-10 00:00:00", is_trial="true", acquisition_channel_id="1", initial_plan_id="2"), **p) for p in people]), S)
    s = staging.stg_subscriptions(raw(spark, "subscriptions", *subs), S)
    p = staging.stg_payments(raw(spark, "payments", *pays), S)
    return customers.dim_customers(c, s, events(spark, *evs), p, lookups.marketing_channels(spark), lookups.plan_tiers(spark), S)


def sub(i, who, status, value, created="2024-01-01 00:00:00"):
    return dict(subscription_id=f"s{i}", customer_id=who, plan_id="2", status=status, billing_cycle="monthly", mrr=str(value), start_date="2024-01-01", created_at=created)


def test_customer_without_subscription_is_unknown(spark):
    got = dim(spark, [dict(customer_id="c")]).first()
    assert (got["customer_status"], got["has_churned"], got["is_resurrected"], got["current_mrr"]) == ("unknown", None, None, Decimal("0.00"))
    assert got["converted_from_trial"] is False and got["payment_success_rate"] is None


def test_latest_subscription_wins_and_ties_go_to_the_greater_id(spark):
    got = dim(
        spark, [dict(customer_id="c")],
        [sub(1, "c", "churned", 0), sub(3, "c", "active", 79, "2024-03-01 00:00:00"), sub(2, "c", "active", 29, "2024-03-01 00:00:00")],
    ).first()
    assert (got["current_subscription_id"], got["total_subscriptions"], got["is_resurrected"], got["converted_from_trial"]) == ("s3", 3, True, True)


def test_risk_for_never_paid_and_free_accounts(spark):
    d = dim(spark, [dict(customer_id="a"), dict(customer_id="b")], [sub(1, "a", "active", 29), sub(2, "b", "active", 0)])
    got = rows(risk.churn_risk(d, S), "customer_id", "pts_stale_payment", "pts_early_tenure", "churn_risk_score", "risk_band")
    assert got == [("a", 15, 10, 25, "medium"), ("b", 0, 10, 10, "low")]


def test_channel_without_paying_customers_and_total_row(spark):
    d = dim(spark, [dict(customer_id="a"), dict(customer_id="b", acquisition_channel_id="4")], [sub(1, "a", "active", 29), sub(2, "b", "active", 0)])
    e = economics.unit_economics(d, lookups.marketing_channels(spark), S)
    got = {r["acquisition_channel"]: r for r in e.collect()}
    assert [got["organic_search"][c] for c in ("arpc", "cac_payback_months", "predicted_ltv")] == [None] * 3
    total = got["ALL CHANNELS"]
    assert (total["customers_acquired"], total["cac"], total["arpc"], total["is_paid_acquisition"]) == (2, 50.0, 29.0, None)
    assert [r["acquisition_channel"] for r in economics.ranked_economics(e).collect()][-1] == "ALL CHANNELS"
    assert checks.invalid_economics(e).count() == 0


def test_billing_schedule(spark):
    s = staging.stg_subscriptions(
        raw(spark, "subscriptions", dict(subscription_id="s1", customer_id="c", billing_cycle="annual", mrr="79", start_date="2023-05-15"),
            dict(subscription_id="s2", customer_id="c", billing_cycle="monthly", mrr="0", status="churned", start_date="2024-01-01", end_date="2024-03-01")), S)
    ev = events(
        spark, event(1, "c", "2023-05-15 00:00:00", 29), event(2, "c", "2024-04-01 00:00:00", 79), event(3, "c", "2024-04-20 09:00:00", 0), event(4, "c", "2024-05-02 00:00:00", 79),
        event(5, "c", "2024-01-01 08:00:00", 29, sub="s2"),
    )
    got = rows(billing.billing_schedule(s, ev, S).where("due_date >= '2024-03-01' or subscription_id = 's2' or due_date < '2023-07-01'"), "subscription_id", "due_date", "amount_due")
    assert [(a, str(b), int(c)) for a, b, c in got] == [
        ("s1", "2023-05-15", 290), ("s1", "2023-06-01", 29), ("s1", "2024-03-01", 29), ("s1", "2024-04-01", 79),
        ("s1", "2024-06-01", 79), ("s2", "2024-02-01", 29),
    ]


def test_interval_join_equals_brute_force(spark):
    import random

    rnd = random.Random(3)
    data = []
    for i in range(600):
        who = "hot" if i % 3 == 0 else rnd.choice("abcd")
        kind = rnd.choice(["churn", "expansion", "contraction"])
        data.append((who, f"e{i}", f"subscription_{kind}", kind, dt.date(2023, 1, 1) + dt.timedelta(days=rnd.randrange(400))))
    df = spark.createDataFrame(data, "customer_id string, event_id string, event_type string, event_category string, event_date date").repartition(5)
    want = {}
    for who, _, _, kind, churned in data:
        for who2, _, kind2, _, on in data:
            before = (churned - on).days
            if kind == "churn" and who == who2 and 1 <= before <= 90:
                label = "0-7 days before" if before <= 7 else "8-30 days before" if before <= 30 else "31-60 days before" if before <= 60 else "61-90 days before"
                n, people = want.setdefault((label, kind2), [0, set()])
                want[label, kind2] = [n + 1, people | {who}]
    got = {(r["timing"], r["event_type"]): [r["occurrence_count"], r["unique_customers"]] for r in churn_reports.events_before_churn(df).collect()}
    assert got == {k: [n, len(p)] for k, (n, p) in want.items()}


def test_empty_groups_keep_their_row(spark):
    got = rows(churn_reports.churned_versus_retained(dim(spark, [dict(customer_id="c")])), "segment", "customers")
    assert got == [("Churned", 0), ("Retained", 0)]


def test_a_repeated_customer_counts_once(spark):
    """Distinct customers, whatever the number of rows per id."""
    from recurra.operators import economics, retention
    from recurra.plans import kpi

    columns = (
        "customer_id string, acquisition_channel string, acquisition_channel_category string, is_paid_acquisition boolean,"
        " customer_status string, has_churned boolean, lifetime_revenue decimal(18,2), current_mrr decimal(18,4),"
        " days_since_signup int, signup_date date"
    )
    one = ("c1", "ads", "paid", True, "active_paying", True, 10, 5, 30, dt.date(2024, 1, 5))
    two = ("c2", "ads", "paid", True, "churned", False, 4, 0, 10, dt.date(2024, 1, 9))
    df = spark.createDataFrame([one, one, two], columns.replace("decimal(18,2)", "int").replace("decimal(18,4)", "int"))
    df = df.withColumns({"lifetime_revenue": F.col("lifetime_revenue").cast("decimal(18,2)"), "current_mrr": F.col("current_mrr").cast("decimal(18,4)")})
    roll = economics.channel_rollup(df).first()
    assert (roll["customers_acquired"], roll["active_paying_customers"], roll["churned_customers"]) == (2, 1, 1)
    assert retention.cohort_sizes(df).first()["cohort_size"] == 2
    total = kpi.customer_kpis(df).first()
    assert (total["total_customers"], total["paying_customers"]) == (2, 1)


def test_a_month_filter_reads_only_its_folders(spark, tmp_path):
    from recurra.sources.io import write_mart

    df = spark.createDataFrame([(i, dt.date(2024, 1 + i % 6, 3)) for i in range(60)], "id int, on date")
    write_mart(df, str(tmp_path / "m"), month_of="on")
    stored = spark.read.parquet(str(tmp_path / "m")).where("month_key_part = '2024-02'")
    assert "PartitionFilters: [isnotnull(month_key_part" in stored._jdf.queryExecution().toString()
    assert stored.count() == 10
