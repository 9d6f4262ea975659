"""Every registered query against its SQL counterpart, and invariants of the marts."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import compare, connect
from oracle import statements
from recurra.plans.catalog import QUERIES, warehouse

SF = "/root/testdata/sf0.001"
SQL = statements()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert compare(spark, con, SF, name, QUERIES[name], SQL[name]) == ""


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_left_joins_keep_row_counts(spark):
    w = warehouse(spark, SF)
    assert w.table("int_customer_subscription_history").count() == w.table("stg_subscription_events").count()
    assert w.table("int_attribution_touchpoints").count() == w.table("stg_marketing_touches").count()
    assert w.table("dim_customers").count() == w.table("stg_customers").count()
    assert w.table("dim_subscriptions").count() == w.table("stg_subscriptions").count()


def test_each_customer_month_balances(spark):
    w = warehouse(spark, SF)
    for name in ("int_mrr_movements", "int_spine_filled_mrr"):
        off = F.expr("beginning_mrr + new_mrr + expansion_mrr - contraction_mrr - churned_mrr <> ending_mrr")
        assert w.table(name).where(off).count() == 0


def test_layers_compose(spark):
    from recurra.plans.build import LAYERS, Warehouse
    from recurra.sources.testbed import Testbed

    w = Warehouse(spark, Testbed(spark, SF).entity)
    assert set(w.run_layer("marts")) == set(LAYERS["marts"])
    assert set(w.run_all()) == {t for layer in LAYERS.values() for t in layer}
