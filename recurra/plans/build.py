"""The models composed from raw entities, layer by layer.

Tables are lazy unless a folder is given; then each stored table is written once as
parquet and read back, so later reads prune columns and lineage stays short.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.plans import checks, datasets
from recurra.operators import (
    attribution, billing, customers, economics, lifecycle, mrr, retention, risk, staging, subscriptions, timeline,
)
from recurra.settings import Settings
from recurra.sources import lookups
from recurra.sources.io import by_month, scratch, write_ledger, write_mart
from recurra.sources.schemas import RAW

LAYERS = {
    "raw": [f"raw_{name}" for name in RAW],
    "seeds": ["plan_tiers", "marketing_channels"],
    "staging": [f"stg_{name}" for name in RAW],
    "ordered": [
        "ordered_subscription_events", "carried_subscription_events", "ordered_marketing_touches", "carried_marketing_touches",
    ],
    "intermediate": [
        "int_customer_subscription_history", "int_mrr_movements", "int_attribution_touchpoints",
        "int_spine_filled_mrr",
    ],
    # The customer dimension first: it stores the payments, whose latest time every mart's line in the ledger needs.
    "marts": [
        "dim_customers", "fct_mrr", "fct_mrr_filled", "fct_subscription_events", "dim_subscriptions",
        "rpt_cohort_retention", "rpt_unit_economics", "rpt_churn_risk",
    ],
}
STORED = {*LAYERS["raw"], *LAYERS["ordered"], *LAYERS["intermediate"], *LAYERS["marts"]}
# Stored by month of this column, in folders that a filter on ``month_key_part`` prunes.
BY_MONTH = {"fct_subscription_events": "event_date", "int_attribution_touchpoints": "touch_date"}


class Warehouse:
    """Named tables over one set of raw entities.

    ``raw`` maps an entity name to its text DataFrame. ``lazy`` composes a table from
    stored raw data only; ``table`` also reads stored models where a folder is set.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: Callable[[str], DataFrame],
        settings: Settings | None = None,
        folder: str | None = None,
        plans: DataFrame | None = None,
        channels: DataFrame | None = None,
    ):
        self.spark, self.raw, self.folder = spark, raw, folder
        self.settings = settings or Settings()
        self._plans, self._channels = plans, channels
        self._kept: dict[str, DataFrame] = {}
        self._composed: dict[str, DataFrame] = {}
        self._data_as_of: dt.datetime | None = None
        self.written: dict[str, dict[str, int]] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._kept:
            df = self._compose(name, self.table)
            if self.folder is not None and name in STORED and not name.startswith("ordered_"):
                path = f"{self.folder}/{name}"
                if name in LAYERS["marts"]:
                    df = datasets.stamped(df, dt.datetime.combine(self.settings.as_of, dt.time()))
                df = self._write(df, name, path)
            self._kept[name] = df
        return self._kept[name]

    def _write(self, df: DataFrame, name: str, path: str) -> DataFrame:
        """Write a table; rows, fingerprint and violations are counted on the way. Marts leave a line in the ledger."""
        columns, watch = df.columns, checks.watched(df, name)
        seen = write_mart(checks.checkable(df, name), path, month_of=BY_MONTH.get(name), watch=watch, columns=columns)
        self.written[name] = seen
        if name in LAYERS["marts"]:
            write_ledger(self.spark, f"{self.folder}/_ledger", name, seen["rows"], seen["fingerprint"], self.data_as_of())
        return self.spark.read.parquet(path)

    def data_as_of(self) -> dt.datetime | None:
        """The latest time that the raw facts hold. A fact that no table needed so far is read by its time column and not stored."""
        if self._data_as_of is None:
            latest = [
                self._staged(entity).agg(F.max(c)).first()[0]
                for entity, c in (("subscription_events", "event_at"), ("payments", "created_at"), ("marketing_touches", "touched_at"))
            ]
            self._data_as_of = max((x for x in latest if x is not None), default=None)
        return self._data_as_of

    def _staged(self, entity: str) -> DataFrame:
        raw = self._kept.get(f"raw_{entity}")
        return getattr(staging, f"stg_{entity}")(self.raw(entity) if raw is None else raw, self.settings)

    def ledger(self) -> DataFrame:
        """One row per stored mart: rows, fingerprint, and the latest time of the facts it was made from."""
        self.run_layer("marts")
        return self.spark.read.parquet(f"{self.folder}/_ledger")

    def lazy(self, name: str) -> DataFrame:
        if name not in self._composed:
            shared = name in LAYERS["raw"] or name in LAYERS["seeds"] or name in LAYERS["ordered"]
            self._composed[name] = self.table(name) if shared else self._compose(name, self.lazy)
        return self._composed[name]

    def _compose(self, name: str, t: Callable[[str], DataFrame]) -> DataFrame:
        s = self.settings
        if name.startswith("raw_"):
            return self.raw(name[4:])
        if name.startswith("beside_"):
            return getattr(staging, f"stg_{name[7:]}")(t(f"raw_{name[7:]}"), s, beside=True)
        if name.startswith("stg_"):
            return getattr(staging, name)(t(f"raw_{name[4:]}"), s)
        if name in LAYERS["ordered"]:
            return self._ordered(*name.split("_", 1), t)
        if name == "plan_tiers":
            return self._plans if self._plans is not None else lookups.plan_tiers(self.spark)
        if name == "marketing_channels":
            return self._channels if self._channels is not None else lookups.marketing_channels(self.spark)
        stg = lambda entity: t(f"stg_{entity}")
        plans, channels = t("plan_tiers"), t("marketing_channels")
        if name == "int_customer_subscription_history":
            return lifecycle.customer_subscription_history(
                stg("customers"), t("ordered_subscription_events"), plans, s, t("carried_subscription_events")
            )
        if name == "int_mrr_movements":
            return mrr.mrr_movements(stg("subscription_events"))
        if name == "int_spine_filled_mrr":
            return mrr.spine_filled_mrr(stg("subscription_events"), s)
        if name == "int_attribution_touchpoints":
            return attribution.attribution_touchpoints(
                t("ordered_marketing_touches"), channels, stg("customers"), stg("subscriptions"), s,
                carried=t("carried_marketing_touches"),
            )
        if name == "fct_mrr":
            return mrr.fct_mrr(t("int_mrr_movements"))
        if name == "fct_mrr_filled":
            return mrr.fct_mrr_filled(t("int_mrr_movements"), s)
        if name == "fct_subscription_events":
            history = t("int_customer_subscription_history")
            if self.folder is not None and t == self.table:
                history = by_month(history, BY_MONTH[name])  # before its rows grow by a half
            return lifecycle.fct_subscription_events(history, channels)
        if name == "dim_customers":
            return customers.dim_customers(
                stg("customers"), stg("subscriptions"), stg("subscription_events"), stg("payments"), channels,
                plans, s,
            )
        if name == "dim_subscriptions":
            return subscriptions.dim_subscriptions(
                stg("subscriptions"), stg("customers"), stg("subscription_events"), plans, s
            )
        if name == "rpt_cohort_retention":
            return retention.cohort_retention(t("int_mrr_movements"), stg("customers"), s)
        if name == "rpt_unit_economics":
            return economics.unit_economics(t("dim_customers"), channels, s)
        if name == "rpt_churn_risk":
            return risk.churn_risk(t("dim_customers"), s)
        if name == "billing_schedule":
            return billing.billing_schedule(stg("subscriptions"), stg("subscription_events"), s)
        raise KeyError(name)

    def _ordered(self, kind: str, entity: str, t: Callable[[str], DataFrame]) -> DataFrame:
        """A fact arranged by customer and time (always written), or its carries."""
        steps = {"subscription_events": lifecycle.STEPS, "marketing_touches": attribution.STEPS}[entity]
        if kind == "carried":
            return timeline.carries(t(f"ordered_{entity}"), steps)
        staged = t(f"stg_{entity}")
        rows = lifecycle.timeline_rows(staged) if entity == "subscription_events" else attribution.timeline_rows(staged, self.settings)
        folder = self.folder or f"{scratch(self.spark)}/ordered-{uuid.uuid4().hex}"
        return timeline.arrange(rows, steps, f"{folder}/ordered_{entity}")

    def run_layer(self, layer: str) -> dict[str, DataFrame]:
        """The tables of one layer (stored where a folder is set)."""
        return {name: self.table(name) for name in LAYERS[layer]}

    def run_all(self) -> dict[str, DataFrame]:
        """Every layer in order."""
        out: dict[str, DataFrame] = {}
        for layer in LAYERS:
            out |= self.run_layer(layer)
        return out
