"""The two lookup tables as typed relations of known size.

Built from Arrow tables, so Spark knows their exact size and broadcasts them on
its own; no join below carries a hint for them.
"""

from __future__ import annotations

from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from recurra.sources.schemas import SEEDS

# Fixed values of the product catalogue: id, name, tier, monthly, annual, storage, users, features.
PLAN_TIERS = [
    (1, "Starter", "free", "0.00", "0.00", 5, 1, "basic_sync"),
    (2, "Pro", "professional", "29.00", "290.00", 100, 5, "basic_sync,advanced_sharing,priority_support"),
    (3, "Team", "business", "79.00", "790.00", 500, 20,
     "basic_sync,advanced_sharing,priority_support,admin_console,sso"),
    (4, "Enterprise", "enterprise", "199.00", "1990.00", 2000, 100,
     "basic_sync,advanced_sharing,priority_support,admin_console,sso,dedicated_support,custom_integrations"),
]

# Fixed values of the channel list: id, name, category, paid, typical acquisition cost.
MARKETING_CHANNELS = [
    (1, "google_ads", "paid_search", True, "85.00"),
    (2, "facebook_ads", "paid_social", True, "65.00"),
    (3, "linkedin_ads", "paid_social", True, "120.00"),
    (4, "organic_search", "organic", False, "15.00"),
    (5, "direct", "direct", False, "10.00"),
    (6, "referral", "referral", False, "25.00"),
    (7, "content_marketing", "organic", False, "35.00"),
    (8, "email_campaign", "owned", False, "20.00"),
    (9, "partner", "partnership", False, "45.00"),
    (10, "webinar", "events", True, "55.00"),
]

_MONEY = {"monthly_price", "annual_price", "typical_cac"}


def _relation(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    schema = SEEDS[name]
    columns = {}
    for i, field in enumerate(schema.fields):
        values = [r[i] for r in rows]
        if field.name in _MONEY:
            columns[field.name] = pa.array([Decimal(v) for v in values], pa.decimal128(18, 2))
        else:
            columns[field.name] = pa.array(values)
    return spark.createDataFrame(pa.table(columns))


def plan_tiers(spark: SparkSession) -> DataFrame:
    return _relation(spark, "plan_tiers", PLAN_TIERS)


def marketing_channels(spark: SparkSession) -> DataFrame:
    return _relation(spark, "marketing_channels", MARKETING_CHANNELS)
