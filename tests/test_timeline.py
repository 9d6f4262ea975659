"""Timelines in parts give the same rows as one window per key, however skewed the key."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from core_helpers import rows
from recurra.operators import plan_history
from recurra.operators.timeline import PART, Steps, _shared, arrange, carries, sequence
from recurra.sources.testbed import Testbed

SF = "/root/testdata/sf0.001"
ORDER = ["at", "id"]


def skewed(spark, n=3000, seed=5, same_instant=False):
    """A third of the rows on one key, many ties, some NULL instants and values, a NULL key."""
    rnd = random.Random(seed)
    start = dt.datetime(2020, 1, 1)
    data = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", "d", None])
        at = start if same_instant and key == "hot" else start + dt.timedelta(hours=rnd.randrange(200))
        data.append((key, None if rnd.random() < 0.01 else at, f"{i:06d}", rnd.choice([None, 1, 2, 3]), rnd.randrange(9)))
    rnd.shuffle(data)
    return spark.createDataFrame(data, "key string, at timestamp, id string, v int, w long").repartition(7)


def plain(column):
    return (column,), lambda now, before: now(column)


STEPS = Steps(
    "key", ("at", "id"),
    number="n", lag={"lag_v": "v", "lag_at": "at"}, lead={"lead_v": "v", "lead_id": "id"},
    running={"run_w": plain("w"), "run_v": plain("v")},
    total={"count_w": ("count", "w"), "sum_w": ("sum", "w"), "max_v": ("max", "v"), "min_at": ("min", "at")},
    first={"first_id": "id"}, last={"last_id": "id"},
)


def arranged(df, tmp_path, part_rows=70, file_rows=800, steps=STEPS):
    return arrange(df, steps, f"{tmp_path}/{part_rows}-{file_rows}", part_rows, file_rows)


def in_one(df):
    w, whole = Window.partitionBy("key").orderBy(*ORDER), Window.partitionBy("key")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.select(
        "*", F.lag("v").over(w).alias("lag_v"), F.lag("at").over(w).alias("lag_at"), F.lead("v").over(w).alias("lead_v"),
        F.lead("id").over(w).alias("lead_id"), F.sum("w").over(upto).alias("run_w"), F.sum("v").over(upto).alias("run_v"),
        F.count("w").over(whole).alias("count_w"), F.sum("w").over(whole).alias("sum_w"), F.max("v").over(whole).alias("max_v"),
        F.min("at").over(whole).alias("min_at"), F.first("id").over(every).alias("first_id"),
        F.last("id").over(every).alias("last_id"), F.row_number().over(w).alias("n"),
    )


@pytest.mark.parametrize(
    ("part_rows", "file_rows", "same_instant", "codegen"),
    [(70, 800, False, "true"), (70, 800, True, "false"), (1, 10_000, False, "false"), (10_000, 10_000, True, "false")],
)
def test_parts_match_plain_windows(spark, tmp_path, part_rows, file_rows, same_instant, codegen):
    was = spark.conf.get("spark.sql.codegen.wholeStage")
    spark.conf.set("spark.sql.codegen.wholeStage", codegen)
    try:
        df = skewed(spark, n=900 if part_rows == 1 else 3000, same_instant=same_instant).cache()
        whole = in_one(df)
        got = sequence(arranged(df, tmp_path, part_rows, file_rows), STEPS)
        assert set(got.columns) == set(whole.columns)
        assert rows(whole) == rows(got.select(*whole.columns))
    finally:
        spark.conf.set("spark.sql.codegen.wholeStage", was)


def test_rows_that_are_not_arranged(spark):
    df = skewed(spark).cache()
    whole = in_one(df)
    assert rows(whole) == rows(sequence(df, STEPS).select(*whole.columns))


def test_parts_are_equal_and_summaries_few(spark, tmp_path):
    df = arranged(skewed(spark, same_instant=True), tmp_path, 100, 1000)
    sizes = [r["count"] for r in df.groupBy(PART).count().collect()]
    assert max(sizes) == 100 and len(sizes) <= 34
    hot = df.where("key = 'hot'").select(PART).distinct().count()
    assert hot >= 10  # all of its rows lie in one hour
    assert carries(df, STEPS).count() <= len(sizes)


def test_a_query_starts_no_job_while_it_is_built(spark, tmp_path):
    df = arranged(skewed(spark), tmp_path)
    tracker = spark.sparkContext.statusTracker()
    before = tracker.getJobIdsForGroup()
    sequence(df, STEPS, carries(df, STEPS))
    assert tracker.getJobIdsForGroup() == before


def test_the_fact_is_read_and_shuffled_once(spark, tmp_path):
    df = arranged(skewed(spark), tmp_path)
    carries(df, STEPS).write.parquet(f"{tmp_path}/carried")
    got = sequence(df, STEPS, spark.read.parquet(f"{tmp_path}/carried"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    fact = [line for line in plan.split("\n") if "FileScan" in line and "_carry" not in line]
    assert len(fact) == 1
    assert [line for line in plan.split("\n") if "Exchange hashpartitioning" in line and "_part" not in line and "_of" not in line] == []
    assert plan.count("Exchange hashpartitioning(_part") == 1


def test_all_given_rows_are_used(spark):
    bed = Testbed(spark, SF)
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    assert bed.plan_states().count() == read("orders").count()
    assert bed.payments().count() == read("lineitem").count()
    assert bed.marketing_touches().count() == read("events").where("event_type <> 'purchase'").count()


@pytest.mark.parametrize("part_rows", [50, 7])
def test_plan_history_numbers_subscriptions(spark, tmp_path, part_rows):
    states = Testbed(spark, SF).plan_states().cache()
    steps = plan_history.steps("custkey")
    numbered = plan_history.number_subscriptions(arranged(states, tmp_path, part_rows, 400, steps), "custkey")
    w = Window.partitionBy("custkey").orderBy("state_at", "state_id")
    starts = F.col("plan_id").isNotNull() & F.lag("plan_id").over(w).isNull()
    plain_ = states.withColumn("s", starts.cast("int")).withColumn("subscription_no", F.sum("s").over(w))
    assert rows(numbered, "state_id", "subscription_no") == rows(plain_, "state_id", "subscription_no")
    same = plan_history.number_subscriptions(states, "custkey")
    assert rows(numbered, *same.columns) == rows(same)


@pytest.mark.parametrize("same_instant", [False, True])
def test_carries_gather_only_keys_of_several_parts(spark, tmp_path, same_instant):
    df = arranged(skewed(spark, same_instant=same_instant), tmp_path)
    parts = {}
    for r in df.select(PART, "key").distinct().collect():
        parts.setdefault(r["key"], set()).add(r[PART])
    many = sorted(((p, k) for k, ps in parts.items() if len(ps) > 1 for p in ps), key=str)
    assert sorted(((r["_in"], r["_of"]) for r in _shared(df, STEPS).collect()), key=str) == many
    assert "LeftSemi" in carries(df, STEPS)._jdf.queryExecution().executedPlan().toString()
