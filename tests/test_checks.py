"""Checks find planted violations and count them in one pass per table."""

import datetime as dt

from core_helpers import rows
from recurra.operators import staging
from recurra.plans import checks
from recurra.plans.build import LAYERS
from recurra.plans.catalog import QUERIES, warehouse
from recurra.settings import Settings
from recurra.sources.schemas import RAW


def test_single_column_checks(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z"), (None, None)], "k string, v string")
    assert rows(checks.duplicates(df, "k")) == [("a", 2)]
    assert checks.missing(df, "k").count() == 2
    assert rows(checks.unexpected(df, "v", ["x", "y"])) == [("z", 1)]
    parent = spark.createDataFrame([("b",)], "id string")
    assert rows(checks.orphans(df, "k", parent, "id"), "k", "v") == [("a", "x"), ("a", "y")]


EMPTY = {
    "fct_mrr": "month_date date, ending_mrr double, new_mrr double, expansion_mrr double, contraction_mrr double, churned_mrr double",
    "int_attribution_touchpoints": "touch_id string, customer_id string, " + ", ".join(f"{m}_weight double" for m in checks.WEIGHED),
    "rpt_churn_risk": "customer_id string, churn_risk_score int, risk_band string, customer_status string",
    "rpt_cohort_retention": "cohort_month date, months_since_signup int, cohort_size long, active_customers long, retention_rate double",
    "rpt_unit_economics": "acquisition_channel string, customers_acquired long, active_paying_customers long, churned_customers long, cac double,"
    " total_acquisition_spend double, cac_payback_months double, observed_churn_rate double",
    "int_mrr_movements": "customer_id string, month_date date, movement_type string",
    "dim_customers": "customer_id string, customer_status string", "int_customer_subscription_history": "event_id string, customer_id string",
    "plan_tiers": "plan_id long", "marketing_channels": "channel_id long", "fct_subscription_events": "event_id string", "dim_subscriptions": "subscription_id string",
}
EMPTY["fct_mrr_filled"] = EMPTY["fct_mrr"]


def tables(spark, **given):
    """Empty tables but for ``given`` raw rows and models; raw columns that are not given are NULL."""

    def t(name):
        if name.startswith("beside_"):
            raw = f"raw_{name[7:]}"
            columns = RAW[name[7:]].names
            data = [tuple(r.get(c) for c in columns) for r in given.get(raw, [])]
            return getattr(staging, f"stg_{name[7:]}")(spark.createDataFrame(data, RAW[name[7:]]), Settings(), beside=True)
        return spark.createDataFrame(given.get(name, []), EMPTY[name])

    return t


SUBS = [
    {"subscription_id": "s1", "customer_id": "c", "status": "ACTIVE"}, {"subscription_id": "s1", "status": "active"},
    {"customer_id": "c", "status": "paused"}, {"customer_id": "d"}, {"subscription_id": "s2", "customer_id": "d", "status": "odd"},
    {"subscription_id": "s2", "customer_id": "c", "status": "odd"},
]


def test_suite_counts_every_check(spark):
    touches = [("t1", "a", 1.0, 1.0, 1.0, 1.0), ("t2", "b", 0.5, 0.0, 0.5, 0.5), ("t3", "b", 0.5, 0.0, 0.5, 0.5), ("t3", "a", 0.0, 0.0, 0.0, 0.0)]
    given = {
        "raw_subscriptions": SUBS, "raw_customers": [{"customer_id": "c", "signup_date": "2020-01-01"}, {"signup_date": "2020-01-01"}],
        "int_attribution_touchpoints": touches, "rpt_churn_risk": [("a", 80, "critical", "active_paying"), ("b", 80, "high", "odd")],
    }
    got = {r[:3]: r[3] for r in rows(checks.run_suite(tables(spark, **given)), "table", "check", "column", "failures")}
    wrong = {k: n for k, n in got.items() if n}
    assert wrong == {
        ("raw_subscriptions", "unique", "subscription_id"): 2, ("stg_subscriptions", "unique", "subscription_id"): 2,
        ("raw_subscriptions", "not_null", "subscription_id"): 2, ("raw_subscriptions", "not_null", "customer_id"): 1,
        ("stg_subscriptions", "not_null", "customer_id"): 1, ("stg_subscriptions", "accepted_values", "status"): 2,
        ("raw_subscriptions", "relationships", "customer_id"): 2, ("raw_customers", "not_null", "customer_id"): 1,
        ("int_attribution_touchpoints", "unique", "touch_id"): 1, ("int_attribution_touchpoints", "weights_sum_to_one", "customer_id"): 1,
        ("rpt_churn_risk", "accepted_values", "customer_status"): 1, ("rpt_churn_risk", "score_in_range", "churn_risk_score"): 1,
    }
    assert len(got) == 20 + 31 + 8 + 1 + 6
    assert rows(checks.repeated_values(tables(spark, **given)), "table", "value", "rows") == [
        ("int_attribution_touchpoints", "t3", 2), ("raw_subscriptions", "s1", 2), ("raw_subscriptions", "s2", 2),
        ("stg_subscriptions", "s1", 2), ("stg_subscriptions", "s2", 2),
    ]
    assert rows(checks.unexpected_values(tables(spark, **given))) == [("rpt_churn_risk", "customer_status", "odd", 1), ("stg_subscriptions", "status", "odd", 2)]


def test_suite_reads_each_stored_table_once(spark):
    w = warehouse(spark, "/root/testdata/sf0.001")
    w.run_all()
    plan = checks.run_suite(w.table)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert len(scans) == len({line[line.index("Location") :] for line in scans}) <= 16


def test_counts_on_write_equal_the_suite(spark):
    sf = "/root/testdata/sf0.001"
    suite = {r[:3]: r[3] for r in rows(QUERIES["t10_suite"](spark, sf), "table", "check", "column", "failures")}
    found = {r[:3]: r[3] for r in rows(QUERIES["t10_on_write"](spark, sf), "table", "check", "column", "failures")}
    assert found and all(suite[k] == n for k, n in found.items())
    singles = {k for k in suite if k[0][:4] in ("int_", "fct_", "dim_", "rpt_") and k[1] not in ("unique", "weights_sum_to_one", "relationships")}
    assert singles == set(found)


def test_quarantine_keeps_real_rows(spark):
    subs = spark.createDataFrame([("s1", "c3"), ("s2", "c4"), ("s3", "lost"), ("s4", None)], "subscription_id string, customer_id string")
    who = spark.createDataFrame([("c3",), ("c4",)], "customer_id string")
    assert rows(checks.quarantine_orphans(subs, who), "key", "origin") == [("made_s1", "made"), ("s3", "real")]
    risk = spark.createDataFrame([("a4", 80, "critical"), ("b", 80, "high"), ("c4", 10, "low")], "customer_id string, churn_risk_score int, risk_band string")
    assert rows(checks.quarantine_scores(risk), "key", "origin") == [("b", "real"), ("made_a4", "made"), ("made_c4", "made")]


def test_ledger_has_a_line_per_mart(spark):
    w = warehouse(spark, "/root/testdata/sf0.001")
    lines = {r["table"]: r for r in w.ledger().collect()}
    assert set(lines) == set(LAYERS["marts"])
    for name, line in lines.items():
        assert line["rows"] == w.table(name).count()
        again = w.table(name).select(*[c for c in w.table(name).columns if c != "month_key_part"])
        assert again.agg(checks.watched(again, name)["fingerprint"]).first()[0] == line["fingerprint"]


def test_score_and_retention_checks(spark):
    risk = spark.createDataFrame([("a", 80, "critical"), ("b", 80, "high"), ("c", 101, "critical"), ("d", -1, "low")], "customer_id string, churn_risk_score int, risk_band string")
    assert rows(checks.invalid_scores(risk), "customer_id") == [("b",), ("c",), ("d",)]
    d = dt.date(2024, 1, 1)
    ret = spark.createDataFrame(
        [(d, 0, 10, 10, 100.0), (d, 0, 10, 9, 90.0), (d, 1, 10, 11, 110.0), (d, 2, 10, 5, 50.0)],
        "cohort_month date, months_since_signup int, cohort_size long, active_customers long, retention_rate double",
    )
    assert rows(checks.invalid_retention(ret), "months_since_signup") == [(0,), (1,)]


def test_sixty_column_checks_are_declared():
    uniques = len(checks.UNIQUE)
    required = sum(len(checks.required(t)) for t in checks.TABLES)
    accepted = sum(len(v) for v in checks.ACCEPTED.values())
    assert (uniques, required, accepted, len(checks.RELATIONSHIPS)) == (20, 31, 8, 1)


def test_quarantined_economics_keep_their_figures(spark):
    names = "acquisition_channel string, customers_acquired long, active_paying_customers long, churned_customers long, cac double, total_acquisition_spend double, cac_payback_months double, observed_churn_rate double"
    table = spark.createDataFrame([("ads", 4, 2, 1, 85.0, 340.0, 3.0, 0.25), ("referral", 4, 5, 1, 25.0, 100.0, None, 0.25)], names)
    assert rows(checks.quarantine_economics(table)) == [
        ("rpt_unit_economics", "made_ads", "economics_valid", "made", "made_ads", 4, 2, 1, -85.0, 340.0, 3.0, 0.25),
        ("rpt_unit_economics", "referral", "economics_valid", "real", "referral", 4, 5, 1, 25.0, 100.0, None, 0.25),
    ]
