"""Semi-join reduction: what is wanted stays, most of the rest goes, and results do not change."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from schoolyard.operators import reduced
from schoolyard.operators.reduction import key_table


def test_wanted_rows_stay_and_most_others_go(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "k")
    keys = rows.filter("k % 7 = 0").union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    kept = {r.k for r in reduced(rows, "k", keys).collect()}
    wanted = {k for k in range(20_000) if k % 7 == 0}
    assert wanted <= kept and len(kept) < 1.01 * len(wanted)


def test_null_keys_go_and_no_keys_leave_nothing(spark):
    rows = spark.createDataFrame([(1,), (None,), (2,)], "k bigint")
    assert [r.k for r in reduced(rows, "k", rows.filter("k = 2")).collect()] == [2]
    assert reduced(rows, "k", rows.filter("false")).count() == 0


def test_a_full_table_keeps_everything(spark):
    rows = spark.range(2_000).withColumnRenamed("id", "k")
    assert reduced(rows, "k", rows.filter("k < 1900"), log_bits=8).count() == 2_000
    table = key_table(rows, "k", log_bits=8).first().words
    assert len(table) == 4


@pytest.mark.parametrize("width", ["int", "bigint", "string"])
def test_keys_of_any_type(spark, width):
    rows = spark.range(100).select(F.col("id").cast(width).alias("k"))
    assert reduced(rows, "k", rows.filter("k % 10 = 0")).count() == 10


def test_lines_shuffled_follow_the_year(spark, star):
    """The order keys of the year reach the scan of the lines, below their first shuffle."""
    from schoolyard.plans import report

    def shuffled(lines) -> int:
        return sum(report.lines_per_order(df).count() for df in lines.values())

    every = shuffled(star.order_lines)
    of_year = shuffled(star.lines_of(star.orders_of_the_year))
    share = star.orders_of_the_year.count() / star.orders_unified.count()
    assert of_year <= 1.05 * share * every + 5
    plan = star.ytd_portfolio._jdf.queryExecution().optimizedPlan().toString()
    assert "getbit" in plan.lower()
