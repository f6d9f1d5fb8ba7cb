"""Timelines: versions of an entity from dated snapshots, and the version valid at a date.

Snapshots are first reduced to one a day and entity, map-side: the last of a day speaks for it.
What an entity then has is bounded by the calendar, however many snapshots it had, and so is what
a task sorts for one entity or gathers for one of its months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from schoolyard.operators.link import Lookup, link


def versions(
    snapshots: DataFrame,
    entity: str,
    at: str,
    state: Sequence[str],
    order: str,
    ends: str | None = None,
) -> DataFrame:
    """(entity, version, state, valid_from, valid_to, is_current) from dated snapshots.

    A version begins with a snapshot whose state differs from the one before, told by a hash of
    the state's columns (NULL is a value), or that follows a gap.  It ends, exclusively, where
    the next begins or, if ``ends`` names the last day a snapshot speaks for, the day after it;
    a snapshot without one is open.  Of a day's snapshots the one that sorts last by ``order``
    counts.  Snapshots without entity or date, or that end before they begin, take no part.
    """
    dated = snapshots.filter(F.col(entity).isNotNull() & F.col(at).isNotNull())
    if ends is not None:
        dated = dated.filter(F.col(ends).isNull() | (F.col(ends) >= F.col(at)))
    until = F.date_add(F.col(ends), 1) if ends is not None else F.lit(None).cast("date")
    facts = F.struct(*[F.col(c) for c in state], until.alias("_end"))
    daily = dated.groupBy(entity, F.col(at).alias("valid_from")).agg(
        F.max_by(facts, F.col(order)).alias("_facts")
    )
    by_day = Window.partitionBy(entity).orderBy("valid_from")
    digest = F.xxhash64(*[F.coalesce(F.col(f"_facts.{c}").cast("string"), F.lit("\0")) for c in state])
    seen = daily.withColumn("_hash", digest).select(
        entity,
        "valid_from",
        "_facts",
        "_hash",
        F.least(F.lead("valid_from").over(by_day), F.col("_facts._end")).alias("_until"),
    )
    begins = (
        F.lag("_hash").over(by_day).isNull()
        | (F.lag("_hash").over(by_day) != F.col("_hash"))
        | (F.lag("_until").over(by_day) < F.col("valid_from"))
    )
    numbered = seen.withColumn("_begins", begins).withColumn(
        "version", F.count_if("_begins").over(by_day.rowsBetween(Window.unboundedPreceding, 0))
    )
    # the snapshots of a version follow each other without a gap
    whole = numbered.groupBy(entity, "version").agg(
        F.min("valid_from").alias("valid_from"),
        F.max_by("_until", "valid_from").alias("valid_to"),
        F.min_by("_facts", "valid_from").alias("_facts"),
    )
    return whole.select(
        entity,
        F.col("version").cast("int").alias("version"),
        *[F.col(f"_facts.{c}").alias(c) for c in state],
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def _key(entity: Column, month: Column) -> Column:
    """Entity and month as one join key; NULL if either is."""
    return F.concat(month.cast("string"), F.lit(":"), entity.cast("string"))


def as_of(
    facts: DataFrame, entity: str, at: str, timeline: DataFrame, take: Sequence[str], row_id: Sequence[str]
) -> DataFrame:
    """``facts`` with the columns of the version valid on their date, NULLs where none is.

    No pairs are formed.  Versions are folded by entity and month of their beginning, at most
    one entry a day; a month in which facts fall but no version begins inherits the last one
    before it.  Facts look up their entity and month and pick the last entry that has begun.
    """
    month = F.trunc(F.col(at), "month")
    entry = F.struct("valid_from", "valid_to", *take)
    begun = timeline.groupBy(entity, F.trunc("valid_from", "month").alias("month")).agg(
        F.sort_array(F.collect_list(entry)).alias("entries")
    )
    asked = facts.filter(F.col(entity).isNotNull() & F.col(at).isNotNull()).select(
        entity, month.alias("month")
    )
    none_type = begun.schema["entries"].dataType
    none = F.lit(None).cast(none_type)
    # one row per entity and month: those that versions begin in and those that are asked for
    months = (
        begun.unionByName(asked.distinct().withColumn("entries", none))
        .groupBy(entity, "month")
        .agg(F.max_by("entries", F.col("entries").isNotNull()).alias("entries"))
    )
    before = Window.partitionBy(entity).orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    inherited = F.last(F.try_element_at("entries", F.lit(-1)), ignorenulls=True).over(before)
    own = F.coalesce(F.col("entries"), F.array().cast(none_type))
    offered = months.select(
        _key(F.col(entity), F.col("month")).alias("of"),
        F.concat(F.array_compact(F.array(inherited)), own).alias("offer"),
    )
    found = link(
        facts.withColumn("_asked", _key(F.col(entity), month)),
        Lookup(F.col("_asked"), offered, F.col("of"), {"_offer": "offer"}, unique=True),
        row_id=row_id,
    )
    begun_by = F.filter("_offer", lambda e: e["valid_from"] <= F.col(at))
    valid = F.try_element_at(begun_by, F.lit(-1))
    held = F.when(valid["valid_to"].isNull() | (valid["valid_to"] > F.col(at)), valid)
    return found.withColumn("_valid", held).select(
        *facts.columns, *[F.col(f"_valid.{c}").alias(c) for c in take], F.col("_valid.valid_from").alias("valid_from")
    )
