"""Manual mappings of keys, closed over chains and laid over records before resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schoolyard.operators.link import Lookup, link

#: Each round doubles the steps a key is followed; chains of up to 16 mappings are closed.
ROUNDS = 4


def mapping_problems(seed: DataFrame, source: Column, target: Column) -> DataFrame:
    """(source_key, target_key, problem) of every mapping, NULL where it can be used.

    ``invalid``: a key that is missing after normalisation. ``contradiction``: one source with
    several targets; none of them is used. ``cycle``: following the mappings from here never
    ends, or not within the steps that are followed. A repeated mapping is one.
    """
    pairs = seed.select(source.alias("source_key"), target.alias("target_key")).distinct()
    invalid = F.col("source_key").isNull() | F.col("target_key").isNull()
    usable = pairs.filter(~invalid)
    single = usable.groupBy("source_key").agg(
        F.count(F.lit(1)).alias("n"), F.min("target_key").alias("target_key")
    )
    sound = single.filter("n = 1").select("source_key", "target_key")
    ends = _followed(sound)
    going_on = sound.select(F.col("source_key").alias("on"))
    endless = ends.join(going_on, F.col("end") == F.col("on"), "left_semi").select(
        F.col("source_key").alias("endless")
    )
    named = single.select(F.col("source_key").alias("of"), "n")
    return (
        pairs.join(named, F.col("source_key") == F.col("of"), "left")
        .join(endless, F.col("source_key") == F.col("endless"), "left")
        .select(
            "source_key",
            "target_key",
            F.when(invalid, "invalid")
            .when(F.col("n") > 1, "contradiction")
            .when(F.col("endless").isNotNull(), "cycle")
            .alias("problem"),
        )
    )


def _followed(sound: DataFrame) -> DataFrame:
    """(source_key, end): where each key is led by its mapping and those after it."""
    hops = sound.select("source_key", F.col("target_key").alias("end"))
    for _ in range(ROUNDS):
        onward = hops.select(F.col("source_key").alias("at"), F.col("end").alias("beyond"))
        hops = hops.join(onward, F.col("end") == F.col("at"), "left").select(
            "source_key", F.coalesce("beyond", "end").alias("end")
        )
    return hops


def closed_mapping(problems: DataFrame) -> DataFrame:
    """(source_key, target_key): every usable mapping with the last key of its chain."""
    return _followed(problems.filter("problem IS NULL").select("source_key", "target_key")).select(
        "source_key", F.col("end").alias("target_key")
    )


def overlaid(records: DataFrame, key: str, mapping: DataFrame, row_id: list[str]) -> DataFrame:
    """Records with their key replaced where the mapping has another; all rows stay."""
    found = link(
        records,
        Lookup(F.col(key), mapping, F.col("source_key"), {"_mapped": "target_key"}, unique=True),
        row_id=row_id,
    )
    return found.withColumn(key, F.coalesce("_mapped", key)).drop("_mapped")
