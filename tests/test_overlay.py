"""Manual mappings: chains are closed, cycles and contradictions are reported and not used."""

from __future__ import annotations

from pyspark.sql import functions as F

from schoolyard.operators.overlay import closed_mapping, mapping_problems, overlaid

SEED = [
    ("a", "b"), ("b", "c"), ("c", "d"),  # a chain
    ("a", "b"),  # said twice
    ("p", "q"), ("q", "p"), ("o", "p"), ("s", "s"),  # cycles, and one that leads into it
    ("x", "y"), ("x", "z"), ("w", "x"),  # a contradiction, and one that ends there
    (None, "a"), ("n", None),
]


def problems(spark, rows):
    seed = spark.createDataFrame(rows, "f string, t string")
    return mapping_problems(seed, F.col("f"), F.col("t"))


def test_problems_are_told_apart(spark):
    got = {(r.source_key, r.target_key): r.problem for r in problems(spark, SEED).collect()}
    assert got == {
        ("a", "b"): None, ("b", "c"): None, ("c", "d"): None, ("w", "x"): None,
        ("p", "q"): "cycle", ("q", "p"): "cycle", ("o", "p"): "cycle", ("s", "s"): "cycle",
        ("x", "y"): "contradiction", ("x", "z"): "contradiction",
        (None, "a"): "invalid", ("n", None): "invalid",
    }


def test_chains_lead_to_their_last_key(spark):
    closed = closed_mapping(problems(spark, SEED))
    assert {tuple(r) for r in closed.collect()} == {("a", "d"), ("b", "d"), ("c", "d"), ("w", "x")}


def test_chains_up_to_the_limit_are_closed(spark):
    chain = [(f"k{i:02}", f"k{i + 1:02}") for i in range(16)]
    closed = {r.source_key: r.target_key for r in closed_mapping(problems(spark, chain)).collect()}
    assert closed == {f"k{i:02}": "k16" for i in range(16)}
    longer = [(f"k{i:02}", f"k{i + 1:02}") for i in range(17)]
    assert {r.problem for r in problems(spark, longer).filter("source_key = 'k00'").collect()} == {"cycle"}


def test_records_keep_their_rows(spark):
    records = spark.createDataFrame([(1, "a"), (2, "d"), (3, None), (4, "q"), (5, "a")], "id int, key string")
    closed = closed_mapping(problems(spark, SEED))
    got = {r.id: r.key for r in overlaid(records, "key", closed, ["id"]).collect()}
    assert got == {1: "d", 2: "d", 3: None, 4: "q", 5: "d"}
    assert overlaid(records, "key", closed.limit(0), ["id"]).exceptAll(records).count() == 0
