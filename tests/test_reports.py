"""Cards, filters and report steps on literal frames."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from schoolyard import functions as fn
from schoolyard.plans import cards, profile, report

D = dt.date
JAN, FEB, MAR = D(2023, 1, 1), D(2024, 1, 1), D(2024, 3, 1)

MONTHLY = [
    # school, name, state, month, orders, active, cancelled, amount, drops, ok, qty, tickets
    ("s1", "One", "PE", JAN, 2, 1, 1, 10.5, 4, 3, 30, 1),
    ("s1", "One", "PE", FEB, 1, 1, 0, 0.1, 0, 0, 0, 0),
    ("s1", "One", "PE", MAR, 0, 0, 0, 0.2, 0, 0, 0, 2),
    ("s2", "Two", "SP", JAN, 1, 1, 0, 10.8, 1, 1, 30, 0),
    ("s2", "Two", "SP", FEB, 0, 0, 0, 0.0, 0, 0, 0, 0),
    ("s3", "Two", None, JAN, 0, 0, 0, 10.8, 0, 0, 5, 0),
]
SCHEMA = (
    "school_id string, school_name string, state string, month date, total_orders bigint, "
    "active_orders bigint, cancelled_orders bigint, ordered_amount double, "
    "total_deliveries bigint, successful_deliveries bigint, quantity_delivered bigint, "
    "total_tickets bigint"
)


@pytest.fixture(scope="module")
def monthly(spark):
    return spark.createDataFrame(MONTHLY, SCHEMA)


@pytest.fixture(scope="module")
def months(monthly):
    return monthly.select("month").distinct()


@pytest.fixture(scope="module")
def month_row(monthly):
    return monthly.agg(F.array_sort(F.collect_set("month")).alias("months"))


@pytest.fixture(scope="module")
def schools(monthly):
    return monthly.select("school_id", F.col("school_name").alias("name"), "state").distinct()


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_rates_are_null_without_deliveries(monthly, months):
    assert cards.delivery_rate(monthly).first()[0] == 0.8
    by_month = cards.monthly_delivery_rate(monthly, months)
    assert dict(tuples(by_month)) == {JAN: 80.0, FEB: None, MAR: None}
    nothing = cards.delivery_rate(monthly.filter("total_deliveries = 0"))
    assert nothing.first()[0] is None


def test_monthly_cards(monthly, months):
    assert dict(tuples(cards.monthly_amount(monthly, months))) == {JAN: 32.1, FEB: 0.1, MAR: 0.2}
    orders = {m: (a, c) for m, a, c in tuples(cards.monthly_orders(monthly, months))}
    assert orders == {JAN: (2, 1), FEB: (1, 0), MAR: (0, 0)}
    assert dict(tuples(cards.monthly_tickets(monthly, months))) == {JAN: 1, FEB: 0, MAR: 2}


def test_months_without_facts_are_listed(monthly, months):
    january = monthly.filter(F.col("month") == JAN)
    assert dict(tuples(cards.monthly_amount(january, months))) == {JAN: 32.1, FEB: 0.0, MAR: 0.0}
    rates = dict(tuples(cards.monthly_delivery_rate(january, months)))
    assert rates == {JAN: 80.0, FEB: None, MAR: None}


def test_rankings_break_ties_by_key(monthly, schools, month_row):
    volume = cards.state_volume(monthly, schools, month_row)
    assert tuples(volume) == [("PE", 30), ("SP", 30), (None, 5)]
    top = tuples(cards.top_schools(monthly, schools, month_row, 2))
    assert top == [("s1", "One", 10.8), ("s2", "Two", 10.8)]
    idle = cards.top_schools(monthly.filter("false"), schools, month_row, 2)
    assert tuples(idle) == [("s1", "One", 0.0), ("s2", "Two", 0.0)]
    none = month_row.select(F.array().cast("array<date>").alias("months"))
    assert tuples(cards.top_schools(monthly, schools, none)) == []


def test_board_groups_by_every_set_of_keys(monthly, schools, month_row):
    rows = {(r.card, r.key): r for r in cards.board(monthly, schools, month_row).collect()}
    assert rows[("all", None)].ordered_amount == 32.4
    assert rows[("month", str(FEB))].ordered_amount == 0.1
    assert rows[("state", None)].quantity_delivered == 5
    assert rows[("school", "s2")].delivery_rate_pct == 100.0
    assert len(rows) == 3 + 3 + 3 + 1
    idle = {(r.card, r.key) for r in cards.board(monthly.filter("false"), schools, month_row).collect()}
    assert idle == set(rows)


def test_filters_combine_and_default_to_everything(monthly):
    assert cards.filter_metrics(monthly).count() == len(MONTHLY)
    one = cards.filter_metrics(monthly, month_from=FEB, month_to=FEB, state="PE")
    assert [r.school_id for r in one.collect()] == ["s1"]
    named = cards.filter_metrics(monthly, school="Two", month_to=JAN)
    assert {r.school_id for r in named.collect()} == {"s2", "s3"}
    trend = cards.trend(named, named.select("month").distinct())
    assert trend.first().ordered_amount == 21.6


def test_trailing_year_counts_calendar_months(monthly, schools, month_row):
    frame = cards.trailing_year(monthly, schools, month_row)
    got = {(r.school_id, r.month): r for r in frame.collect()}
    assert len(got) == 9  # all schools in all months
    # January 2023 is twelve months before January 2024 and outside its window
    assert got[("s1", FEB)].trailing_amount == 0.1
    assert got[("s1", FEB)].year_ago_amount == 10.5
    assert got[("s1", MAR)].trailing_amount == math.fsum([0.1, 0.2])
    assert got[("s1", MAR)].year_ago_amount is None
    assert got[("s1", JAN)].trailing_orders == 2
    # no fact of its own and nothing left in the window; a year before is no listed month, or is one
    assert tuple(got[("s2", MAR)])[2:] == (0.0, 0.0, 0, None)
    assert tuple(got[("s2", FEB)])[2:] == (0.0, 0.0, 0, 10.8)


def test_ticket_references_match_order_ids_as_text(spark):
    t = "2024-01-01 00:00:00"
    refs = ["12", "0012", " 12", "12.0", "x", None, "99999999999999999999", "12"]
    tickets = spark.createDataFrame(
        [(r, t, "2024-01-01 02:30:00") for r in refs],
        "order_ref string, created_at string, solved_at string",
    ).select(
        "order_ref",
        F.col("created_at").cast("timestamp").alias("created_at"),
        F.col("solved_at").cast("timestamp").alias("solved_at"),
    )
    assert tuples(report.tickets_per_order(tickets)) == [(12, 2, 4, 2)]


def test_orders_and_deliveries_without_school_reach_the_spine_only(spark):
    orders = spark.createDataFrame(
        [("erp_a", "1", None, JAN, False), ("erp_a", "2", "s1", None, False)],
        "source_system string, source_order_id string, school_id string, order_date date, "
        "is_cancelled boolean",
    )
    drops = spark.createDataFrame(
        [(1, FEB, False, 1), (2, MAR, True, 2), (7, D(2024, 5, 1), False, 3)],
        "order_key bigint, delivery_date date, is_cancelled boolean, quantity_delivered bigint",
    )
    none = drops.filter("false")
    lines = spark.createDataFrame([(2, 5.0, 1.0)], "order_key bigint, line_total double, quantity double")
    tickets = spark.createDataFrame(
        [], "organization_id bigint, created_at timestamp, solved_at timestamp"
    )
    by_system = {"erp_a": drops, "erp_b": none}
    months = [
        report.active_months(orders, by_system, tickets, summed).first()[0]
        for summed in (False, True)
    ]
    assert months[0] == months[1] == [JAN, FEB, MAR, D(2024, 5, 1)]
    facts = report.school_month_facts(
        orders,
        {"erp_a": lines, "erp_b": lines.filter("false")},
        by_system,
        tickets,
        spark.createDataFrame([], "organization_id bigint, school_id string"),
    ).collect()
    # order 2 has no date: its lines fall in no month, its delivery still counts
    assert [(r.school_id, r.month, r.total_deliveries, r.total_orders) for r in facts] == [
        ("s1", MAR, 1, None)
    ]


def test_match_rate_with_repeats_and_nulls(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    got = profile.match_rate(left, "k", {"r": right}).first()
    assert (got.n_rows, got.n_matched, got.match_rate) == (4, 2, 0.5)


def test_coverage_thresholds(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (4,)], "k bigint")
    got = profile.coverage(
        {"low": (df, F.col("k").isNotNull(), 0.7), "high": (df, F.col("k").isNotNull(), 0.75)}
    )
    assert {r.check_name: (r.n_passing, r.passed) for r in got.collect()} == {
        "low": (3, True),
        "high": (3, False),
    }


def test_group_checks_name_the_lowest_failing_keys(spark):
    day = D(2024, 1, 1)
    rows = [
        ("erp_a", "1", "c1", day, 100.0), ("erp_b", "2", "c1", day, 100.4),  # within 1.0
        ("erp_a", "3", "c2", day, 100.0), ("erp_b", "4", "c2", day, 101.0),  # exactly 1.0 apart
        ("erp_a", "5", "c3", day, 5.0), ("erp_a", "6", "c3", day, 5.0),  # one system only
        ("erp_a", "7", "c0", day, 7.0), ("erp_b", "8", "c0", day, 6.5),
    ]
    df = spark.createDataFrame(
        rows, "source_system string, source_order_id string, contract_id string, order_date date, total double"
    )
    lines = df.groupBy(*report.ORDER_KEY).agg(fn.exact_total("total").alias("amount"))
    groups = profile.both_system_groups(df)
    close = profile.duplicate_orders_across_systems(df, lines)
    got = profile.group_checks({"strict": (groups, close), "none": (groups, close.filter("false"))}, sample=1)
    assert [tuple(r) for r in got.collect()] == [
        ("strict", 3, 1, 1 / 3, False, f"c0/{day}"),
        ("none", 3, 3, 1.0, True, None),
    ]
