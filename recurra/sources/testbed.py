"""Raw subscription entities derived from the order-entry and event-stream tables.

The given tables hold no subscriptions, so an order's priority stands for the plan a
customer is on from that day, line items for payments, and the event stream for
marketing touches. Every raw column leaves here as text, so staging does real work.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.functions.rules import COMPANY_SIZES
from recurra.operators.plan_history import lifecycle_events, number_subscriptions, steps, subscriptions_of
from recurra.operators.timeline import arrange, carries
from recurra.settings import Settings
from recurra.sources.io import scratch

# Fixed values of the mapping: priority -> plan and monthly price; no plan for the rest.
PLAN_BY_PRIORITY = {"1-URGENT": (4, 199), "2-HIGH": (3, 79), "3-MEDIUM": (2, 29), "4-NOT SPECIFIED": (1, 0)}
TRIAL_TEXTS = ["true", "0", "YES", "no", "maybe"]
TOUCH_TYPES = {"view": " Visit ", "click": "CLICK", "signup": "form_submit", "error": "demo_request"}
EPOCH = "1995-01-01"


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def _signup(custkey: Column) -> Column:
    return F.date_add(F.lit(EPOCH).cast("date"), (custkey * 7 % 2400).cast("int"))


def _padded(prefix: str, key: Column, width: int = 12) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), width, "0"))


def _stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def _day(ts: Column) -> Column:
    """The day of a stamp, cut from its text: a time whose stamp is also written is formatted once."""
    return F.substring_index(_stamp(ts), " ", 1)


class Testbed:
    """Reads the given tables under ``path`` and maps them to the five raw entities.

    Three entities share one ordered timeline; with a ``folder`` it is written there once.
    """

    __test__ = False

    def __init__(
        self, spark: SparkSession, path: str, settings: Settings | None = None, folder: str | None = None
    ):
        self.spark, self.path, self.settings, self.folder = spark, path, settings or Settings(), folder
        self._kept: DataFrame | None = None
        self._states: tuple[DataFrame, str, DataFrame] | None = None

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        signup = _signup(key)
        return (
            self._table("customer")
            .join(self._table("nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.concat(F.lit("cust_"), key.cast("string")).alias("customer_id"),
                F.col("c_name").alias("company_name"),
                F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")).alias("industry"),
                _pick(COMPANY_SIZES, key % 6).alias("company_size"),
                F.col("n_name").alias("country"),
                F.concat(signup.cast("string"), F.lit(" 00:00:00")).alias("signup_date"),
                F.concat(F.lit(" "), F.upper("c_name"), F.lit("@EXAMPLE.COM ")).alias("email"),
                (key % 10 + 1).cast("string").alias("acquisition_channel_id"),
                (key % 10 % 4 + 1).cast("string").alias("initial_plan_id"),
                _pick(TRIAL_TEXTS, key % 5).alias("is_trial"),
                F.when(key % 97 == 0, "not-a-date")
                .otherwise(F.date_add(signup, 14).cast("string"))
                .alias("trial_end_date"),
            )
        )

    def plan_states(self) -> DataFrame:
        """One row per order: the plan held from then on. Orders before the signup are events with negative tenure."""
        priority = F.col("o_orderpriority")
        plan, price = F, F
        for name, (plan_id, monthly) in PLAN_BY_PRIORITY.items():
            plan = plan.when(priority == name, F.lit(plan_id))
            price = price.when(priority == name, F.lit(monthly))
        return (
            self._table("orders")
            .select(
                F.col("o_custkey").alias("custkey"),
                F.col("o_orderkey").alias("state_id"),
                F.col("o_orderdate").cast("timestamp").alias("state_at"),
                plan.cast("bigint").alias("plan_id"),
                price.otherwise(F.lit(0)).cast("decimal(18,2)").alias("mrr"),
            )
        )

    def arranged_states(self) -> tuple[DataFrame, str, DataFrame]:
        """Plan states arranged by customer and time, their key, and their carries; written once."""
        if self._states is None:
            folder, key = self.folder or f"{scratch(self.spark)}/states-{uuid.uuid4().hex}", "custkey"
            rows = arrange(self.plan_states(), steps(key), f"{folder}/plan_states")
            carries(rows, steps(key)).write.mode("overwrite").parquet(f"{folder}/plan_state_carries")
            self._states = rows, key, self.spark.read.parquet(f"{folder}/plan_state_carries")
        return self._states

    def _timeline(self) -> DataFrame:
        if self._kept is None:
            df = number_subscriptions(*self.arranged_states())
            if self.folder is not None:
                df.write.mode("overwrite").parquet(f"{self.folder}/timeline")
                df = self.spark.read.parquet(f"{self.folder}/timeline")
            self._kept = df
        return self._kept

    def _subscription_id(self) -> Column:
        return F.when(
            F.col("subscription_no") > 0,
            F.concat(
                F.lit("sub_"), F.col("custkey").cast("string"), F.lit("_"),
                F.lpad(F.col("subscription_no").cast("string"), 6, "0"),
            ),
        )

    def _typed_events(self) -> DataFrame:
        return lifecycle_events(self._timeline()).withColumn("subscription_id", self._subscription_id())

    def subscription_events(self) -> DataFrame:
        return self._typed_events().select(
            _padded("evt_", F.col("state_id")).alias("event_id"),
            "subscription_id",
            F.concat(F.lit("cust_"), F.col("custkey").cast("string")).alias("customer_id"),
            "event_type",
            _stamp(F.col("state_at")).alias("event_date"),
            F.col("event_plan_id").cast("string").alias("plan_id"),
            F.col("mrr_change").cast("string").alias("mrr_change"),
            F.col("mrr").cast("string").alias("mrr_after"),
        )

    def subscriptions(self) -> DataFrame:
        return subscriptions_of(self._typed_events(), "custkey").select(
            "subscription_id",
            F.concat(F.lit("cust_"), F.col("custkey").cast("string")).alias("customer_id"),
            F.col("plan_id").cast("string").alias("plan_id"),
            F.upper("status").alias("status"),
            F.when(F.col("custkey") % 10 < 3, "annual").otherwise("monthly").alias("billing_cycle"),
            F.col("mrr").cast("string").alias("mrr"),
            _day(F.col("started_at")).alias("start_date"),
            _day(F.col("ended_at")).alias("end_date"),
            _stamp(F.col("started_at")).alias("created_at"),
            _stamp(F.col("last_event_at")).alias("updated_at"),
        )

    def payments(self) -> DataFrame:
        # One payment per line item; an (order, line) number that occurs twice is a duplicate payment id.
        lines = self._table("lineitem").select(
            "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
            F.col("l_shipdate").cast("timestamp").alias("paid_at"), F.col("l_returnflag").alias("flag"),
        )
        orders = self._timeline().select("custkey", "state_id", self._subscription_id().alias("subscription_id"))
        method = F.element_at(
            F.array(F.lit("credit_card"), F.lit("ACH"), F.lit(" wire ")), (F.col("l_linenumber") % 3 + 1).cast("int")
        )
        return lines.join(orders, F.col("l_orderkey") == F.col("state_id")).select(
            F.concat(_padded("pay_", F.col("l_orderkey")), F.lit("_"), F.col("l_linenumber").cast("string")).alias(
                "payment_id"
            ),
            "subscription_id",
            F.concat(F.lit("cust_"), F.col("custkey").cast("string")).alias("customer_id"),
            F.col("amount").cast("string").alias("amount"),
            F.lit("usd").alias("currency"),
            _day(F.col("paid_at")).alias("payment_date"),
            method.alias("payment_method"),
            F.when((F.col("l_linenumber") == 1) & (F.col("flag") == "R"), "failed")
            .otherwise("succeeded")
            .alias("status"),
            _stamp(F.col("paid_at")).alias("created_at"),
        )

    def marketing_touches(self) -> DataFrame:
        events = self._table("events").select(
            "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
        )
        bought = events.where(F.col("event_type") == "purchase").groupBy("user_id").agg(F.max("ts").alias("converted_at"))
        k = F.col("k")
        channel = F.when(k < 40, 1).when(k < 60, 4).when(k < 75, 5).otherwise(k % 10 + 1)
        kind = F
        for source, touch in TOUCH_TYPES.items():
            kind = kind.when(F.col("event_type") == source, F.lit(touch))
        others = events.where(F.col("event_type") != "purchase")
        return (
            others.join(bought, "user_id", "left")
            .withColumn("channel", channel)
            .select(
                _padded("touch_", F.col("event_id")).alias("touch_id"),
                F.concat(F.lit("cust_"), F.col("user_id").cast("string")).alias("customer_id"),
                F.col("channel").cast("string").alias("channel_id"),
                _stamp(F.col("ts")).alias("touch_date"),
                kind.alias("touch_type"),
                F.concat(F.lit("/P/"), k.cast("string")).alias("landing_page"),
                F.when(F.col("channel").isin(1, 2, 3, 10), F.concat(F.lit("campaign_"), k.cast("string")))
                .otherwise(F.lit("  "))
                .alias("utm_campaign"),
                _stamp(F.col("converted_at")).alias("conversion_date"),
            )
        )

    def entity(self, name: str) -> DataFrame:
        return getattr(self, name)()
