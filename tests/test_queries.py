"""Registered queries against the oracle, and invariants of the reports."""

from __future__ import annotations

import itertools
import os

import pytest
from conftest import TESTDATA
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as some
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import difference, oracle_connection
from schoolyard.plans import profile, report
from schoolyard.plans.workspace import Workspace
from schoolyard.queries import QUERIES

needs_data = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test data")


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(TESTDATA)


@needs_data
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, oracle, name):
    assert difference(spark, oracle, name, TESTDATA) is None


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@needs_data
def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 150 * 83
    assert "ordered_amount" in df.columns


@needs_data
def test_monthly_rows_are_schools_times_months(star):
    monthly = star.monthly_metrics()
    months = star.active_months().select(F.size("months")).first()[0]
    assert monthly.count() == star.schools.count() * months
    assert monthly.groupBy("school_id", "month").count().filter("count > 1").count() == 0


@needs_data
def test_links_keep_every_row(star):
    assert star.orders.count() == star.orders_unified.count()
    assert star.order_items.count() == star.order_items_unified.count()
    assert star.deliveries.count() == star.deliveries_unified.count()
    assert star.tickets.count() == star.clean["support_ticket"].count()


@needs_data
def test_report_adds_up_to_the_facts_of_known_schools(star):
    totals = star.monthly_metrics().agg(
        F.sum("total_orders").alias("orders"),
        F.sum(F.col("ordered_amount").cast("decimal(18,4)")).alias("amount"),
        F.sum("total_tickets").alias("tickets"),
    )
    known = star.orders.filter("school_id IS NOT NULL")
    bought = star.order_items.join(known.select("order_id"), "order_id", "left_semi")
    got = totals.first()
    assert got.orders == known.count()
    assert got.amount == bought.agg(F.sum(F.col("line_total").cast("decimal(18,4)"))).first()[0]
    assert got.tickets == star.tickets.filter("school_id IS NOT NULL").count()


@needs_data
def test_parts_agree_with_the_whole_report(star):
    whole = star.monthly_metrics()
    for part, column in (
        ("orders", "total_orders"),
        ("items", "ordered_amount"),
        ("deliveries", "quantity_delivered"),
        ("tickets", "total_tickets"),
    ):
        keys = ["school_id", "month", column]
        alone = star.monthly_metrics([part]).select(*keys)
        assert alone.exceptAll(whole.select(*keys)).count() == 0


AMOUNTS = some.sampled_from([0, 50, 99, 100, 149, 150, 199, 200, 250, 301])


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    some.lists(
        some.tuples(some.sampled_from("ab"), some.sampled_from(["c1", "c2", None]), AMOUNTS),
        min_size=1,
        max_size=14,
    )
)
def test_cross_system_duplicates_equal_brute_force(spark, drawn):
    day = "2024-01-01"
    found = [(f"erp_{s}", str(i), c, day, n / 100) for i, (s, c, n) in enumerate(drawn)]
    df = spark.createDataFrame(
        found,
        "source_system string, source_order_id string, contract_id string, order_date string, "
        "total double",
    )
    lines = df.groupBy(*report.ORDER_KEY).agg(
        F.sum(F.col("total").cast("decimal(18,4)")).alias("amount")
    )
    orders = df.withColumn("order_date", F.col("order_date").cast("date"))
    got = {r.contract_id for r in profile.duplicate_orders_across_systems(orders, lines).collect()}
    want = {
        a[1]
        for a, b in itertools.combinations(drawn, 2)
        if a[1] is not None and a[1] == b[1] and a[0] != b[0] and abs(a[2] - b[2]) < 100
    }
    assert got == want


# -- plans -------------------------------------------------------------------


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
def test_no_query_uses_python_or_pairs(spark):
    for name in QUERIES:
        plan = _plan(entry.queries()[name](spark, TESTDATA))
        assert "Python" not in plan, name
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


@needs_data
def test_card_of_tickets_reads_no_line_amounts(spark):
    plan = _plan(entry.queries()["card_monthly_tickets"](spark, TESTDATA))
    assert "l_extendedprice" not in plan
    assert "l_quantity" not in plan


@needs_data
def test_dense_rows_are_made_after_the_last_shuffle(spark):
    plan = _plan(entry.queries()["monthly_school_metrics"](spark, TESTDATA))
    above = plan.split("Generate explode", 1)[0]
    assert "Exchange" not in above


@needs_data
def test_building_a_query_starts_no_job(spark):
    """Registered queries are plans; nothing is computed before they run."""
    raw = Workspace.over_star(spark, TESTDATA).raw
    for build in QUERIES.values():
        build(Workspace(raw))  # reads the schemas of the tables
    context = spark.sparkContext
    context.setJobGroup("building", "queries that are built, not run")
    try:
        for build in QUERIES.values():
            build(Workspace(raw))
        assert not context.statusTracker().getJobIdsForGroup("building")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
