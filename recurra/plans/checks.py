"""Data-quality checks. A check returns its violating rows; none means it passed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recurra.functions import rules
from recurra.functions.numbers import rnd
from recurra.sources.schemas import RAW

TOLERANCE = 0.01
WEIGHED = ["first_touch", "last_touch", "linear", "position_based"]
STATUSES = ["active", "churned"]
# Columns that must be unique, filled, or hold one of a list of values, per table.
UNIQUE = {
    "raw_customers": "customer_id", "raw_subscriptions": "subscription_id", "raw_subscription_events": "event_id",
    "raw_payments": "payment_id", "raw_marketing_touches": "touch_id", "plan_tiers": "plan_id",
    "marketing_channels": "channel_id", "stg_customers": "customer_id", "stg_subscriptions": "subscription_id",
    "stg_subscription_events": "event_id", "stg_payments": "payment_id", "stg_marketing_touches": "touch_id",
    "int_customer_subscription_history": "event_id", "int_attribution_touchpoints": "touch_id",
    "fct_mrr": "month_date", "fct_subscription_events": "event_id", "dim_customers": "customer_id",
    "dim_subscriptions": "subscription_id", "rpt_churn_risk": "customer_id",
    "rpt_unit_economics": "acquisition_channel",
}
# Every unique column is also required; these are required besides.
NOT_NULL = {
    "raw_customers": ["signup_date"], "raw_subscriptions": ["customer_id"], "stg_subscriptions": ["customer_id"],
    "int_customer_subscription_history": ["customer_id"], "int_mrr_movements": ["customer_id", "month_date"],
    "rpt_cohort_retention": ["cohort_month", "months_since_signup"],
    "rpt_churn_risk": ["churn_risk_score", "risk_band"], "rpt_unit_economics": ["customers_acquired"],
}
ACCEPTED = {
    "raw_subscription_events": {"event_type": list(rules.EVENT_CATEGORIES)},
    "raw_payments": {"status": ["succeeded", "failed"]},
    "stg_subscriptions": {"status": STATUSES},
    "stg_subscription_events": {"event_category": ["acquisition", "expansion", "contraction", "churn", "other"]},
    "int_mrr_movements": {"movement_type": rules.MOVEMENT_TYPES},
    "dim_customers": {"customer_status": rules.CUSTOMER_STATUSES},
    "rpt_churn_risk": {"customer_status": ["active_paying", "active_free"], "risk_band": rules.RISK_BANDS},
}
RELATIONSHIPS = [("raw_subscriptions", "customer_id", "raw_customers", "customer_id")]
TABLES = list(dict.fromkeys([*UNIQUE, *NOT_NULL, *ACCEPTED]))


def required(table: str) -> list[str]:
    return ([UNIQUE[table]] if table in UNIQUE else []) + NOT_NULL.get(table, [])


# --- one check at a time --------------------------------------------------------------


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs do not count."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows")).where("rows > 1")


def missing(df: DataFrame, column: str) -> DataFrame:
    """T2."""
    return df.where(F.col(column).isNull())


def unexpected(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    return df.where(~F.col(column).isin(values)).groupBy(column).agg(F.count("*").alias("rows"))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """T4: child rows whose non-NULL key has no parent. Keys meet parents once each; rows meet only keys without one."""
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    lost = child.where(F.col(column).isNotNull()).select(column).distinct().join(known, column, "left_anti")
    return child.join(lost, column, "left_semi")


def with_balance(fct_mrr: DataFrame) -> DataFrame:
    """Each month's expected ending MRR, the previous one plus movements, and how far it is off."""
    before = F.coalesce(F.lag("ending_mrr").over(Window.orderBy("month_date")), F.lit(0))
    expected = before + F.col("new_mrr") + F.col("expansion_mrr") - F.col("contraction_mrr") - F.col("churned_mrr")
    return fct_mrr.withColumn("expected_ending_mrr", expected).withColumn(
        "variance", F.abs(F.col("ending_mrr") - F.col("expected_ending_mrr"))
    )


def unbalanced_months(fct_mrr: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """T5: months whose ending MRR is not the previous one plus movements."""
    off = with_balance(fct_mrr).where(F.col("variance") > tolerance)
    return off.select("month_date", "ending_mrr", "expected_ending_mrr", "variance")


def unbalanced_weights(touchpoints: DataFrame, tolerance: float = TOLERANCE, by: list[str] | None = None) -> DataFrame:
    """Customers whose weights do not sum to one (time decay is exempt)."""
    sums = touchpoints.groupBy(*(by or ["customer_id"])).agg(
        *[rnd(F.sum(f"{m}_weight"), 4).alias(f"{m}_sum") for m in WEIGHED]
    )
    off = reduce(lambda a, b: a | b, [F.abs(F.col(f"{m}_sum") - 1.0) > tolerance for m in WEIGHED])
    return sums.where(off)


def invalid_scores(risk: DataFrame) -> DataFrame:
    """Scores outside 0-100 or with another band than theirs."""
    expected = rules.risk_band(F.col("churn_risk_score"))
    return risk.where(bad_score()).select("customer_id", "churn_risk_score", "risk_band", expected.alias("expected_band"))


def bad_score() -> Column:
    score = F.col("churn_risk_score")
    return ~score.between(0, 100) | (F.col("risk_band") != rules.risk_band(score))


def invalid_retention(retention: DataFrame) -> DataFrame:
    """T8."""
    return retention.where(bad_retention()).select(
        "cohort_month", "months_since_signup", "cohort_size", "active_customers", "retention_rate"
    )


def bad_retention() -> Column:
    rate, active = F.col("retention_rate"), F.col("active_customers")
    return (
        ((F.col("months_since_signup") == 0) & (rate < 95))
        | ~rate.between(0, 100)
        | (active > F.col("cohort_size"))
        | (active < 0)
    )


ECONOMICS = [
    "acquisition_channel", "customers_acquired", "active_paying_customers", "churned_customers", "cac",
    "total_acquisition_spend", "cac_payback_months", "observed_churn_rate",
]


def invalid_economics(economics: DataFrame) -> DataFrame:
    """T9."""
    return economics.where(bad_economics()).select(*ECONOMICS)


def bad_economics() -> Column:
    acquired = F.col("customers_acquired")
    bad = (
        (F.col("active_paying_customers") > acquired)
        | (F.col("churned_customers") > acquired)
        | (F.col("cac") < 0)
        | (F.col("total_acquisition_spend") < 0)
        | (F.col("cac_payback_months") < 0)
        | ~F.col("observed_churn_rate").between(0, 1)
    )
    return (F.col("acquisition_channel") != rules.BLENDED) & bad


# --- checks of single rows ------------------------------------------------------------------


def row_checks(table: str, of: str = "") -> list[tuple[str, str, Column]]:
    """(check, column, violated) for every check of a table that looks at one row; ``of`` prefixes the columns."""
    out = [("not_null", c, F.col(of + c).isNull()) for c in required(table)]
    out += [("accepted_values", c, ~F.col(of + c).isin(v)) for c, v in ACCEPTED.get(table, {}).items()]
    if table in ("fct_mrr", "fct_mrr_filled"):
        out.append(("mrr_movements_balance", "ending_mrr", F.col("variance") > TOLERANCE))
    if table in VALID:
        check, column, bad = VALID[table]
        out.append((check, column, bad()))
    return out


VALID = {
    "rpt_churn_risk": ("score_in_range", "churn_risk_score", bad_score),
    "rpt_cohort_retention": ("retention_valid", "retention_rate", bad_retention),
    "rpt_unit_economics": ("economics_valid", "acquisition_channel", bad_economics),
}


def checkable(df: DataFrame, table: str) -> DataFrame:
    """The table with what its row checks look at."""
    return with_balance(df) if table in ("fct_mrr", "fct_mrr_filled") else df


def watched(df: DataFrame, table: str) -> dict[str, Column]:
    """Aggregates that gather a table's row count, order-free fingerprint and violations while it is written."""
    found = row_checks(table) if table in [*TABLES, "fct_mrr_filled"] else []
    hashed = F.xxhash64(*[c for c in df.columns if c != "month_key_part"]).bitwiseAND((1 << 31) - 1)
    return {"rows": F.count(F.lit(1)), "fingerprint": F.coalesce(F.sum(hashed), F.lit(0))} | {
        f"{check}|{column}": F.count(F.when(bad, 1)) for check, column, bad in found
    }


def counted_on_write(spark: SparkSession, written: dict[str, dict[str, int]]) -> DataFrame:
    """T10 without another read: violations counted while the tables were written."""
    rows = [
        (table, *name.split("|"), int(n)) for table, seen in written.items() for name, n in seen.items() if "|" in name
    ]
    return spark.createDataFrame(rows, "table string, check string, column string, failures long")


# --- the whole suite --------------------------------------------------------------------


@dataclass(frozen=True)
class Space:
    """Rows of one table under one key: keys must be unique (``unique``: the tables and column that say so), and rows of
    ``child`` spaces need a row of the parent space of the same name. ``flags`` count violations, ``sums`` add weights."""

    name: str
    key: Column
    unique: tuple[tuple[str, str], ...] = ()
    child: tuple[str, str] | None = None
    flags: tuple[tuple[str, str, str, Column], ...] = ()
    weights: tuple[str, ...] = ()


FLAGS, SUMS = 7, len(WEIGHED)


def sources(t: Callable[[str], DataFrame]) -> list[tuple[DataFrame, list[Space]]]:
    """Every stored table once, with the spaces its rows take part in. A raw entity also stands for its staged rows."""
    out = []
    staged = {f"raw_{entity}": f"stg_{entity}" for entity in RAW}
    for raw, stg in staged.items():
        key = UNIQUE[raw]
        there = F.col(f"raw.{key}").isNotNull()
        flags = [(raw, check, c, bad) for check, c, bad in row_checks(raw, "raw.")]
        flags += [(stg, check, c, there & bad) for check, c, bad in row_checks(stg)]
        spaces = [Space(raw, F.col(f"raw.{key}"), ((raw, key), (stg, key)), flags=tuple(flags))]
        spaces += [Space(parent, F.col(f"raw.{c}"), child=(child, c)) for child, c, parent, _ in RELATIONSHIPS if child == raw]
        out.append((t(f"beside_{raw[4:]}"), spaces))
    for name in [*TABLES, "fct_mrr_filled"]:
        if name in staged or name in staged.values():
            continue
        flags = tuple((name, check, c, bad) for check, c, bad in row_checks(name))
        key = UNIQUE.get(name)
        own = Space(name, F.col(key) if key else F.lit(None), ((name, key),) if key else (), flags=flags)
        spaces = [own]
        if name == "int_attribution_touchpoints":
            spaces.append(Space("weights", F.col("customer_id"), weights=tuple(f"{m}_weight" for m in WEIGHED)))
        out.append((checkable(t(name), name), spaces))
    return out


def _keyed(df: DataFrame, spaces: list[Space]) -> DataFrame:
    """One row per row and space, all of one form; a table with one space needs no copy of its rows."""
    forms = []
    for s in spaces:
        flags = [F.coalesce(bad.cast("int"), F.lit(0)) for *_, bad in s.flags] + [F.lit(0)] * (FLAGS - len(s.flags))
        sums = [F.col(w) for w in s.weights] or [F.lit(None).cast("double")] * SUMS
        forms.append(
            [F.lit(s.name).alias("space"), s.key.cast("string").alias("key"), F.lit(int(s.child is None)).alias("own"), F.lit(int(s.child is not None)).alias("child")]
            + [f.alias(f"v{i}") for i, f in enumerate(flags)] + [w.cast("double").alias(f"w{i}") for i, w in enumerate(sums)]
        )
    return df.select(*forms[0]) if len(forms) == 1 else df.select(F.inline(F.array(*[F.struct(*f) for f in forms])))


def run_suite(t: Callable[[str], DataFrame]) -> DataFrame:
    """One row per check with its number of violations; ``t`` gives a table by name.

    Each stored table is read once. All rows meet in one aggregate per (space, key), which combines before its only
    exchange; totals per space follow.
    """
    found = sources(t)
    rows = reduce(DataFrame.unionByName, [_keyed(df, spaces) for df, spaces in found])
    per_key = rows.groupBy("space", "key").agg(
        F.sum("own").alias("own"), F.sum("child").alias("child"), *[F.sum(f"v{i}").alias(f"v{i}") for i in range(FLAGS)],
        *[F.sum(f"w{i}").alias(f"w{i}") for i in range(SUMS)],
    )
    known = F.col("key").isNotNull()
    off = reduce(lambda a, b: a | b, [F.abs(rnd(F.col(f"w{i}"), 4) - 1.0) > TOLERANCE for i in range(SUMS)])
    totals = per_key.groupBy("space").agg(
        F.count(F.when(known & (F.col("own") > 1), 1)).alias("unique"),
        F.sum(F.when(known & (F.col("own") == 0), F.col("child")).otherwise(0)).alias("orphans"),
        F.count(F.when(off, 1)).alias("weights"), *[F.sum(f"v{i}").alias(f"v{i}") for i in range(FLAGS)],
    )
    kinds = ["unique", "orphans", "weights", *[f"v{i}" for i in range(FLAGS)]]
    counted = totals.select("space", F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("n")) for k in kinds])))
    return listed(rows.sparkSession, found).join(counted, ["space", "kind"], "left").select(
        "table", "check", "column", F.coalesce("n", F.lit(0)).alias("failures")
    )


def listed(spark: SparkSession, found: list[tuple[DataFrame, list[Space]]]) -> DataFrame:
    """(space, kind, table, check, column): which total answers which check."""
    rows = []
    for _, spaces in found:
        for s in spaces:
            rows += [(s.name, "unique", table, "unique", c) for table, c in s.unique]
            rows += [(s.name, f"v{i}", table, check, c) for i, (table, check, c, _) in enumerate(s.flags)]
            rows += [(s.name, "orphans", s.child[0], "relationships", s.child[1])] if s.child else []
            rows += [(s.name, "weights", "int_attribution_touchpoints", "weights_sum_to_one", "customer_id")] if s.weights else []
    return spark.createDataFrame(rows, "space string, kind string, table string, check string, column string")


def repeated_values(t: Callable[[str], DataFrame]) -> DataFrame:
    """T1 over every table: values that must be unique and are not. One read per stored table, one aggregate."""
    found = [(df, [s for s in spaces if s.unique]) for df, spaces in sources(t)]
    keys = [df.select(F.lit(s.name).alias("space"), s.key.cast("string").alias("value")) for df, spaces in found for s in spaces]
    many = reduce(DataFrame.unionByName, keys).where("value IS NOT NULL").groupBy("space", "value").agg(F.count("*").alias("rows")).where("rows > 1")
    names = listed(many.sparkSession, found).where("kind = 'unique'").select("space", "table", "column")
    return many.join(names, "space").select("table", "column", "value", "rows")


def unexpected_values(t: Callable[[str], DataFrame]) -> DataFrame:
    """T3 over every table: values outside their lists, with row counts. Only violations leave the scan."""
    parts = []
    for df, spaces in sources(t):
        bad = [
            F.struct(F.lit(table).alias("table"), F.lit(c).alias("column"), F.col(f"raw.{c}" if table.startswith("raw_") else c).cast("string").alias("value"), off.alias("off"))
            for s in spaces for table, check, c, off in s.flags if check == "accepted_values"
        ]
        if bad:
            parts.append(df.select(F.inline(F.filter(F.array(*bad), lambda x: F.coalesce(x["off"], F.lit(False))))).drop("off"))
    return reduce(DataFrame.unionByName, parts).groupBy("table", "column", "value").agg(F.count("*").alias("rows"))


# --- quarantine ---------------------------------------------------------------------------


def beside(real: DataFrame, made: DataFrame) -> DataFrame:
    """A whole table with made-up faulty rows added and marked; no real row is changed or left out."""
    return real.withColumn("origin", F.lit("real")).unionByName(made.withColumn("origin", F.lit("made")))


def _quarantined(bad: DataFrame, table: str, key: str, check: str, figures: list[str] | None = None) -> DataFrame:
    return bad.select(
        F.lit(table).alias("table"), F.col(key).cast("string").alias("key"), F.lit(check).alias("check"), "origin", *(figures or [])
    )


def quarantine_missing(t: Callable[[str], DataFrame], ending: str = "7") -> DataFrame:
    """T2 over every table: rows without a required value. Made rows are copies whose required values that end in
    ``ending`` are gone; ``key`` is what they were copied from."""
    parts = []
    for name in TABLES:
        df, columns = t(name), required(name)
        if not columns:
            continue
        df = df.select(*columns).withColumn("_key", F.col(columns[0]).cast("string"))
        hit = {c: F.col(c).cast("string").endswith(ending) for c in columns}
        some = reduce(lambda a, b: a | b, [F.coalesce(h, F.lit(False)) for h in hit.values()])
        made = df.where(some).withColumns({c: F.when(~hit[c], F.col(c)) for c in columns})
        checks = [F.struct(F.lit(f"not_null:{c}").alias("check"), F.col(c).isNull().alias("bad")) for c in columns]
        rows = beside(df, made).select(F.lit(name).alias("table"), F.col("_key").alias("key"), "origin", F.inline(F.array(*checks)))
        parts.append(rows.where("bad").select("table", "key", "check", "origin"))
    return reduce(DataFrame.unionByName, parts)


def quarantine_orphans(child: DataFrame, parent: DataFrame, ending: str = "3") -> DataFrame:
    """T4: subscriptions without their customer. Made rows are copies, with new ids, that name a customer who never was."""
    named = F.col("customer_id").endswith(ending)
    made = child.where(named).withColumns(
        {"subscription_id": F.concat(F.lit("made_"), "subscription_id"), "customer_id": F.concat(F.lit("gone_"), "customer_id")}
    )
    bad = orphans(beside(child, made), "customer_id", parent, "customer_id")
    return _quarantined(bad, "raw_subscriptions", "subscription_id", "relationships")


def quarantine_weights(touchpoints: DataFrame, ending: str = "5") -> DataFrame:
    """Customers whose weights do not sum to one. Made customers are copies of others that lack their last touch."""
    made = touchpoints.where(F.col("customer_id").endswith(ending) & ~F.col("is_last_touch"))
    made = made.withColumn("customer_id", F.concat(F.lit("made_"), "customer_id"))
    bad = unbalanced_weights(beside(touchpoints, made), by=["customer_id", "origin"])
    return _quarantined(bad, "int_attribution_touchpoints", "customer_id", "weights_sum_to_one")


def quarantine_scores(risk: DataFrame, ending: str = "4", by: int = 60) -> DataFrame:
    """Invalid scores or bands. Made rows are copies whose score is too large by ``by`` for their band."""
    made = risk.where(F.col("customer_id").endswith(ending)).withColumns(
        {"customer_id": F.concat(F.lit("made_"), "customer_id"), "churn_risk_score": F.col("churn_risk_score") + by}
    )
    return _quarantined(beside(risk, made).where(bad_score()), "rpt_churn_risk", "customer_id", "score_in_range")


def quarantine_economics(economics: DataFrame, ending: str = "s") -> DataFrame:
    """Impossible channel figures, with all that the check looks at. Made rows are copies whose acquisition cost has the wrong sign."""
    made = economics.where(F.col("acquisition_channel").endswith(ending)).withColumns(
        {"acquisition_channel": F.concat(F.lit("made_"), "acquisition_channel"), "cac": -F.col("cac")}
    )
    bad = beside(economics, made).where(bad_economics())
    return _quarantined(bad, "rpt_unit_economics", "acquisition_channel", "economics_valid", ECONOMICS)
