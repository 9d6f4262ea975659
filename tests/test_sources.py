"""Readers, writers and value-driven typing."""

import datetime as dt
import tempfile

from core_helpers import rows
from recurra.sources import io, lookups
from recurra.sources.schemas import EXTRACTS, RAW


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def test_raw_csv_stays_text(spark):
    path = f"{folder()}/payments.csv"
    with open(path, "w") as f:
        f.write(",".join(RAW["payments"].names) + "\n")
        f.write('p1,s1,c1,29.00,USD,2024-01-05,"card, credit",succeeded,2024-01-05 00:00:00\n')
        f.write("p2,,c1,0,USD,,ach,failed,\n")
    df = io.read_raw(spark, path, "payments")
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    assert rows(df, "payment_id", "subscription_id", "amount", "payment_method") == [
        ("p1", "s1", "29.00", "card, credit"), ("p2", None, "0", "ach"),
    ]
    df.write.parquet(f"{path}.parquet")
    assert rows(io.read_raw(spark, f"{path}.parquet", "payments", "parquet")) == rows(df)


def test_seed_csv_round_trip_keeps_quoted_commas(spark):
    for name, df in {"plan_tiers": lookups.plan_tiers(spark), "marketing_channels": lookups.marketing_channels(spark)}.items():
        path = f"{folder()}/{name}"
        df.coalesce(1).write.option("header", True).csv(path)
        back = io.read_seed(spark, path, name)
        assert rows(back) == rows(df) and back.schema == df.schema


def test_lookups_have_a_known_size(spark):
    plan = lookups.plan_tiers(spark)._jdf.queryExecution().optimizedPlan()
    assert int(plan.stats().sizeInBytes()) < 10_000


def test_mart_by_month_and_view(spark):
    path = f"{folder()}/mart"
    df = spark.createDataFrame([(1, dt.date(2024, 1, 31)), (2, dt.date(2024, 2, 1))], "id int, day date")
    io.write_mart(df, path, month_of="day")
    assert rows(io.read_mart(spark, path).where("month_key_part = '2024-02'"), "id") == [(2,)]
    io.write_mart(df, path)
    io.register(io.read_mart(spark, path), "mart_days")
    assert spark.sql("select max(id) m from mart_days").first()["m"] == 2


def test_columns_take_the_type_of_their_cells(spark):
    df = spark.createDataFrame(
        [("true", "2024-01-31", "12", "1.5", "2024-01", ""), ("False", "", "-3", "2", "C1", None), (None, "2024-02-29", "", "-.5", "x", "")],
        "flag string, day string, n string, ratio string, code string, blank string",
    )
    got = io.coerce_columns(df)
    assert [f.dataType.simpleString() for f in got.schema] == ["boolean", "date", "bigint", "double", "string", "string"]
    assert got.collect()[1] == (False, None, -3, 2.0, "C1", None)
    bad_day = spark.createDataFrame([("2024-02-30",)], "d string")
    assert io.profile_columns(bad_day) == {"d": "string"}


def test_extracts_and_bundle(spark):
    path = folder()
    df = spark.createDataFrame([("2024-07", "M0", 0, 48, 48, 100.0, 100.0)], EXTRACTS["rpt_cohort_retention"])
    io.export_marts({"rpt_cohort_retention": df}, path)
    back = io.read_mart_extract(spark, f"{path}/rpt_cohort_retention", "rpt_cohort_retention")
    assert rows(back) == rows(df) and back.schema == df.schema
    mart = spark.createDataFrame([(98.5,)], "net_revenue_retention_pct double")
    assert set(EXTRACTS) == {"fct_mrr", "dim_customers", "dim_subscriptions", "rpt_unit_economics", "rpt_churn_risk", "rpt_cohort_retention"}
    assert io.EXTRACT_ALIASES["fct_mrr"]["nrr_pct"] in mart.columns
