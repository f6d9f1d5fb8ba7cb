"""Dense entity x month rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def month_list(*months: DataFrame) -> DataFrame:
    """One row holding the sorted distinct months of all inputs (column ``month``).

    The size is bounded by the calendar: DATE has 9999 x 12 months, under 0.5 MB.
    """
    distinct = reduce(DataFrame.union, [m.select("month").distinct() for m in months])
    return distinct.filter(F.col("month").isNotNull()).agg(
        F.array_sort(F.collect_set("month")).alias("months")
    )


def dense_months(
    entities: DataFrame,
    facts: DataFrame,
    months: DataFrame,
    entity_id: str,
    measures: Sequence[str],
) -> DataFrame:
    """Every entity in every month of the list, with its measures or NULLs.

    ``facts`` has at most one row per (entity, month).  The facts of an entity are
    folded into one map, at most one entry per calendar month, and joined at
    entity grain; the dense rows come out of an explode after the last shuffle.
    Joining the dense spine with the facts instead would shuffle and sort
    entities x months rows, most of which are empty.
    """
    row = F.struct(*[F.col(m) for m in measures])
    folded = (
        facts.filter(F.col(entity_id).isNotNull() & F.col("month").isNotNull())
        .groupBy(entity_id)
        .agg(F.map_from_entries(F.collect_list(F.struct("month", row.alias("row")))).alias("_facts"))
    )
    spine = (
        entities.join(folded, entity_id, "left")
        .withColumn("month", F.explode(months.scalar()))
        .withColumn("_row", F.try_element_at("_facts", "month"))
    )
    return spine.select(*entities.columns, "month", *[F.col(f"_row.{m}") for m in measures])
