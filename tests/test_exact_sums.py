"""Exact sums of doubles against math.fsum, in any order and over any grouping."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from schoolyard import functions as fn

DRAWS = {
    "ten decimals": lambda d: [round(d.uniform(-1e3, 1e3), 10) for _ in range(30)],
    "very unlike sizes": lambda d: [d.choice([1e15, -1e15, 0.1, 1e-5, 0.3]) for _ in range(40)],
    "any magnitude": lambda d: [round(d.random() * 10 ** d.randrange(-3, 18), 10) for _ in range(25)],
    "large negatives": lambda d: [-d.random() * 2.0 ** d.randrange(-10, 61) for _ in range(20)],
    "ties": lambda d: [2.0**53, 1.0, d.choice([2.0**-60, -(2.0**-60), 0.0])],
    "cancelling": lambda d: [y for x in (d.gauss(0, 1e6) for _ in range(20)) for y in (x, -x)] + [1e-5],
    "zeros": lambda d: [0.0, -0.0],
}


@pytest.fixture(scope="module")
def drawn():
    draw = random.Random(4)
    names = sorted(DRAWS)
    return {g: DRAWS[names[g % len(names)]](draw) for g in range(40 * len(names))}


def test_sums_equal_fsum_in_any_grouping(spark, drawn):
    rows = [(g, x) for g, values in drawn.items() for x in values]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g int, x double").repartition(13)
    want = {g: math.fsum(values) for g, values in drawn.items()}
    one = df.groupBy("g").agg(fn.exact_sum("x").alias("s"))
    parted = df.groupBy("g", F.pmod(F.xxhash64("x"), F.lit(4)).alias("k")).agg(
        fn.exact_total("x").alias("t")
    )
    two = parted.groupBy("g").agg(fn.rounded(fn.merged("t")).alias("s"))
    assert {r.g: r.s for r in one.collect()} == want
    assert {r.g: r.s for r in two.collect()} == want


def test_nothing_nan_and_infinity(spark):
    inf, nan = float("inf"), float("nan")
    groups = {0: [None, None], 1: [1.0, None], 2: [inf, 1.0], 3: [-inf, 5.0], 4: [inf, -inf], 5: [nan, 1.0],
              6: [1e300, 1e300], 7: [2.0**62, 0.5]}
    df = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs], "g int, x double")
    got = {r.g: r.s for r in df.groupBy("g").agg(fn.exact_sum("x").alias("s")).collect()}
    assert (got[0], got[1], got[2], got[3]) == (None, 1.0, inf, -inf)
    assert math.isnan(got[4]) and math.isnan(got[5])
    assert got[6] == 2e300 and got[7] == 2.0**62


def test_difference_counts_a_missing_side_as_nothing(spark):
    df = spark.createDataFrame([(0.3, 0.1), (0.3, None), (None, 0.1)], "a double, b double")
    left = fn.rounded(fn.difference(fn.exact("a"), fn.exact("b"))).alias("d")
    assert [r.d for r in df.select(left).collect()] == [math.fsum([0.3, -0.1]), 0.3, None]


def test_totals_of_many_groups_are_rounded_by_short_code(spark, drawn):
    """As many groups are, in code that the JVM compiles: its methods stay under 8,000 bytes."""
    inf, nan = float("inf"), float("nan")
    more = {-1: [None], -2: [inf, 1.0], -3: [1e300, 1e300], -4: [2.0**62, 0.5], -5: [-inf, inf], -6: [-0.3],
            -7: [2.0**53, 1.0], -8: [2.0**53, 1.0, 2.0**-60], -9: [-(2.0**28), -(2.0**-25), -(2.0**-60)],
            -10: [2.0**61] * 40 + [0.5], -11: [-(2.0**53), -1.0, -(2.0**-60)], -12: [nan]}
    rows = [(g, x) for g, values in (drawn | more).items() for x in values]
    df = spark.createDataFrame(rows, "g int, x double").repartition(13).cache()
    totals = df.groupBy("g").agg(fn.exact_total("x").alias("s"), fn.exact_total(-F.col("x")).alias("n"))
    frame = fn.with_rounded(totals, "s", "n")
    got = {r.g: (r.s, r.n) for r in frame.collect()}
    for g, values in (drawn | more).items():
        if g == -1:
            want = (None, None)
        elif g in (-5, -12):
            assert all(math.isnan(x) for x in got[g])
            continue
        else:
            want = (math.fsum(values), math.fsum(-x for x in values))
        assert got[g] == want, g
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = fn.with_rounded(totals, "s", "n")
        code = spark._jvm.PythonSQLUtils.explainString(again._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000
