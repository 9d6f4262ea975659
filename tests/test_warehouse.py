"""What storing a mart reads, deals and leaves in the ledger; the rows are made here."""

import datetime as dt

from pyspark.sql import functions as F

from core_helpers import rows
from recurra.plans import checks
from recurra.plans.build import Warehouse
from recurra.plans.datasets import stamped
from recurra.sources.schemas import RAW

MADE = {
    "customers": [("c1", "Ant", " ab ", "1-10", "fr", "2024-01-31 00:00:00", "A@B.C", "1", "2", "true", None), ("c2", "Bee", "cd", "11-50", "de", "2024-02-01 00:00:00", "b@b.c", "77", "1", "no", None)],
    "subscriptions": [("s1", "c1", "2", "active", "monthly", "29", "2024-02-01", None, "2024-02-01 00:00:00", "2024-02-01 00:00:00")],
    "subscription_events": [
        ("e1", "s1", "c1", "subscription_started", "2024-02-01 10:00:00", "2", "29", "29"),
        ("e2", "s1", "c1", "subscription_upgraded", "2024-03-05 10:00:00", "3", "50", "79"),
        ("e3", "s2", "c2", "subscription_started", "2024-03-09 10:00:00", "1", "0", "0"),
        ("e4", "s2", "c2", "subscription_churned", None, "1", "0", "0"),
    ],
    "payments": [("p1", "s1", "c1", "29", "usd", "2024-02-01", "ach", "succeeded", "2024-04-01 00:00:01"), (None, "s1", "c1", "29", "usd", "2024-02-01", "ach", "succeeded", "2025-01-01 00:00:00")],
    "marketing_touches": [("t1", "c1", "1", "2024-01-01 00:00:00", "click", "/p", None, None)],
}


def warehouse(spark, folder):
    made = {name: spark.createDataFrame(MADE[name], RAW[name]) for name in RAW}
    return Warehouse(spark, made.__getitem__, folder=f"{folder}/w")


def test_a_mart_does_not_store_facts_it_has_no_use_for(spark, tmp_path):
    w = warehouse(spark, tmp_path)
    w.table("fct_mrr")
    assert set(w.written) == {"raw_subscription_events", "int_mrr_movements", "fct_mrr"}
    # Payments without an id are no staged rows.
    assert w.data_as_of() == dt.datetime(2024, 4, 1, 0, 0, 1)
    assert rows(w.spark.read.parquet(f"{w.folder}/_ledger"), "table", "as_of") == [("fct_mrr", w.data_as_of())]


def test_marts_store_a_fact_they_share_once(spark, tmp_path):
    w = warehouse(spark, tmp_path)
    read = []
    made = w.raw
    w.raw = lambda name: (read.append(name), made(name))[1]
    assert w.ledger().count() == 8
    assert sorted(read) == sorted(RAW)


def test_events_are_dealt_by_month_before_they_are_widened(spark, tmp_path):
    w = warehouse(spark, tmp_path)
    composed = w._compose("fct_subscription_events", w.table)
    plan = composed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("RebalancePartitions")  # channels and calendar parts come after it
    stored, lazy = w.table("fct_subscription_events"), w.lazy("fct_subscription_events")
    assert "month_key_part" not in lazy.columns
    assert rows(stored, *lazy.columns) == rows(lazy)
    assert stored.where("NOT month_key_part <=> event_month_key AND event_month_key IS NOT NULL").count() == 0
    counted = checks.watched(stamped(lazy, dt.datetime.combine(w.settings.as_of, dt.time())), "fct_subscription_events")
    assert w.written["fct_subscription_events"]["fingerprint"] == lazy.transform(
        lambda d: stamped(d, dt.datetime.combine(w.settings.as_of, dt.time()))
    ).agg(counted["fingerprint"].alias("f")).first()[0]
    assert stored.agg(F.count("*")).first()[0] == 4
