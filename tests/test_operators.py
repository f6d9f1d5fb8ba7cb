"""Operators on literal frames, with hot keys, copies and missing keys."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as some
from pyspark.sql import functions as F

from schoolyard.operators import (
    Check,
    Lookup,
    conform_union,
    dense_months,
    directory,
    joined_tags,
    link,
    month_list,
    resolve_entity,
    run_checks,
)

KEYS = some.one_of(some.none(), some.sampled_from(["a", "b", "hot", "k", ""]))


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    children=some.lists(KEYS, min_size=1, max_size=40),
    parents=some.lists(some.tuples(KEYS, some.sampled_from(["x", "y", None])), max_size=8),
)
def test_link_equals_a_plain_lookup(spark, children, parents):
    child = spark.createDataFrame(list(enumerate(children)), "id bigint, key string")
    parent = spark.createDataFrame(parents or [(None, None)], "pk string, name string")
    got = link(child, Lookup(F.col("key"), parent, F.col("pk"), {"name": "name"}), row_id=["id"])
    lowest = defaultdict(list)
    for k, v in parents:
        if k is not None:
            lowest[k].append(v)
    want = {
        (i, k, min(lowest[k], key=lambda v: (v is not None, v)) if k in lowest else None)
        for i, k in enumerate(children)
    }
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(children)
    assert set(rows) == want


def _without_broadcast(spark):
    old = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "32",
    }
    saved = {k: spark.conf.get(k, None) for k in old}
    for k, v in old.items():
        spark.conf.set(k, v)
    return saved


def _restore(spark, saved):
    for k, v in saved.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_link_splits_a_hot_key_and_spreads_missing_keys(spark):
    """A third of the rows share one key and a third have none."""
    saved = _without_broadcast(spark)
    try:
        n = 600_000
        key = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, 7)
        child = spark.range(0, n, 1, 16).select(
            "id", key.otherwise(F.col("id") % 5000).alias("k"), F.md5(F.col("id").cast("string")).alias("payload")
        )
        parent = spark.range(5000).select(
            F.col("id").alias("pk"), F.concat(F.lit("P"), F.col("id")).alias("name")
        )
        linked = link(child, Lookup(F.col("k"), parent, F.col("pk"), {"name": "name"}), row_id=["id"])
        summed = linked.agg(
            F.count("*").alias("n"),
            F.count("name").alias("found"),
            F.count_if(F.col("name") != F.concat(F.lit("P"), F.col("k"))).alias("wrong"),
        )
        row = summed.first()
        assert (row.n, row.found, row.wrong) == (n, n - n // 3, 0)
        per_task = linked.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count("*").alias("n"), F.max("name"), F.max("payload")
        )
        assert max(r.n for r in per_task.collect()) < n // 6
        plan = per_task._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        _restore(spark, saved)


def test_link_does_not_multiply_on_copies_of_a_parent(spark):
    child = spark.createDataFrame([(i, "hot") for i in range(500)], "id bigint, key string")
    parent = spark.createDataFrame([("hot", "same")] * 500, "pk string, name string")
    got = link(child, Lookup(F.col("key"), parent, F.col("pk"), {"name": "name"}), row_id=["id"])
    assert got.count() == 500
    assert got.filter(F.col("name") == "same").count() == 500


def test_filters_pass_below_a_link(spark, tmp_path):
    spark.range(100).withColumn("key", F.col("id") % 7).write.parquet(f"{tmp_path}/c")
    child = spark.read.parquet(f"{tmp_path}/c")
    parent = spark.range(5).select(F.col("id").alias("pk"), F.col("id").alias("name"))
    linked = link(child, Lookup(F.col("key"), parent, F.col("pk"), {"name": "name"}), row_id=["id"])
    plan = linked.filter("id >= 50")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,50)" in plan
    assert "cast(key" not in plan  # numbers are compared as numbers


def test_conform_union_keeps_every_row(spark):
    a = spark.createDataFrame([(1, "x")], "id bigint, v string")
    b = spark.createDataFrame([("x", 1)], "v string, id bigint")
    rows = conform_union({"left": a, "right": b}).collect()
    assert sorted((r.id, r.v, r.source_system) for r in rows) == [
        (1, "x", "left"),
        (1, "x", "right"),
    ]


RECORDS = [
    # source, id, key, name, city
    ("crm", "A1", "11111111111111", "crm one", None),
    ("erp_a", "C1", "11111111111111", "a one", "a city"),
    ("erp_b", "2", "22222222222222", "b two", "b city"),
    ("support", "9", "22222222222222", "s two", None),
    ("erp_a", "C3", "123", "too short", "x"),
    ("erp_a", "C4", None, "no key", "x"),
    ("erp_b", "5", "11111111111111", "b one", "b city"),
]
RECORD_SCHEMA = "source_system string, source_id string, cnpj string, name string, city string"
SOURCES = {"crm": "crm_id", "erp_a": "a_id", "erp_b": "b_id", "support": "s_id"}


def _resolve(df):
    return resolve_entity(
        df, "cnpj", F.length("cnpj") == 14, SOURCES, "crm", "NCRM-", "school_id", ["name", "city"]
    )


def test_resolve_entity_precedence_and_synthetic_ids(spark):
    df = spark.createDataFrame(RECORDS, RECORD_SCHEMA)
    rows = {r.cnpj: r for r in _resolve(df).collect()}
    assert set(rows) == {"11111111111111", "22222222222222"}
    one, two = rows["11111111111111"], rows["22222222222222"]
    assert (one.school_id, one.name, one.city) == ("A1", "crm one", "a city")
    assert (one.crm_id, one.a_id, one.b_id, one.s_id) == ("A1", "C1", "5", None)
    assert (two.school_id, two.name, two.city) == ("NCRM-22222222222222", "b two", "b city")
    assert (two.crm_id, two.b_id, two.s_id) == (None, "2", "9")


def test_resolve_entity_repeated_key_gives_one_entity_and_directory_finds_all(spark):
    copies = [("erp_a", f"C{i:03}", "11111111111111", f"n{i}", None) for i in range(300)]
    df = spark.createDataFrame(RECORDS + copies, RECORD_SCHEMA)
    resolved = _resolve(df)
    assert resolved.count() == 2
    assert resolved.filter("school_id = 'A1'").first().a_id == "C000"
    found = directory(df, "cnpj", F.length("cnpj") == 14, "crm", "NCRM-", "school_id")
    rows = found.filter("source_system = 'erp_a'").collect()
    assert len(rows) == 301
    assert {r.school_id for r in rows} == {"A1"}


def test_joined_tags_sorts_repeats_and_skips_null(spark):
    tags = [(1, "b"), (1, "a"), (1, None), (1, "b"), (2, None), (3, "x")]
    df = spark.createDataFrame(tags, "t bigint, tag string")
    got = {r.t: r.tags for r in joined_tags(df, "t", "tag", "tags").collect()}
    assert got == {1: "a,b,b", 3: "x"}


def test_dense_months_fills_every_entity_and_month(spark):
    jan, feb, mar = (dt.date(2024, m, 1) for m in (1, 2, 3))
    entities = spark.createDataFrame([("s1", "one"), ("s2", "two")], "id string, name string")
    facts = spark.createDataFrame(
        [("s1", jan, 5), ("s1", mar, 7), (None, feb, 9), ("gone", jan, 1)],
        "id string, month date, n bigint",
    )
    months = month_list(facts, facts.filter("month is null"))
    got = {
        (r.id, r.month): r.n for r in dense_months(entities, facts, months, "id", ["n"]).collect()
    }
    assert got == {
        ("s1", jan): 5,
        ("s1", feb): None,
        ("s1", mar): 7,
        ("s2", jan): None,
        ("s2", feb): None,
        ("s2", mar): None,
    }


def test_dense_months_without_months_has_no_rows(spark):
    entities = spark.createDataFrame([("s1",)], "id string")
    facts = spark.createDataFrame([], "id string, month date, n bigint")
    assert dense_months(entities, facts, month_list(facts), "id", ["n"]).count() == 0


CHECKS = [
    Check("child", "id", "unique"),
    Check("child", "id", "not_null"),
    Check("child", "parent", "not_null"),
    Check("child", "status", "accepted_values", values=("open", "closed")),
    Check("child", "parent", "relationships", parent="parent", parent_column="id"),
]


def _run(spark, children):
    tables = {
        "child": spark.createDataFrame(children, "id bigint, status string, parent bigint"),
        "parent": spark.createDataFrame([(1,), (2,), (2,)], "id bigint"),
    }
    rows = run_checks(tables.__getitem__, CHECKS).collect()
    return {(r.column_name, r.check_name): r.failures for r in rows}


def test_checks_pass_on_clean_rows(spark):
    clean = [(1, "open", 1), (2, "closed", 2), (3, None, 1)]
    assert set(_run(spark, clean).values()) == {0}


def test_checks_count_planted_faults(spark):
    faulty = [
        (1, "open", 1),
        (1, "odd", 9),
        (1, "odd", 9),
        (None, "strange", None),
        (2, "open", 2),
        (2, "open", 8),
    ]
    assert _run(spark, faulty) == {
        ("id", "unique"): 2,
        ("id", "not_null"): 1,
        ("parent", "not_null"): 1,
        ("status", "accepted_values"): 2,
        ("parent", "relationships"): 3,
    }
