"""Left lookup of parents that keeps a child's rows one to one and its tasks even.

A plain left join has three weak spots on large, uneven data:

* a parent key that repeats multiplies the children; here the parents of a key are
  reduced to one row first, map-side, so copies neither travel nor multiply;
* every child without a key lands in the one task that NULL hashes to; here such
  rows get a key that spreads them over all tasks and matches nothing;
* a key held by a third of the children makes one task run long; adaptive
  execution splits such a partition and hands each piece the same parents.

The last point depends on the shape of the plan: a partition is split only if both
sides of the join come straight out of a shuffle.  The reduced parents are already
partitioned by their key, which would let the join skip that shuffle, so the join
uses a second column, and the parents, the smaller side, are shuffled once more.
That column is a hash of the key wherever there is one, and of the child's own id where
there is none; it follows from the row alone, so filters pass below the join.  It comes
first in the join, so rows are sorted by a number: keys are texts that begin alike
(``CT-2017-0000``), and sorting those compares them whole.  For the same reason parents
are reduced by hash and key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lookup:
    """Parent columns wanted for a key of the child.

    ``key`` is a column of the child, NULL where the row cannot have a parent.
    ``take`` maps new child columns to parent columns; a child row without a
    parent gets NULLs.  Should a parent key repeat, the row that sorts lowest on
    the taken columns is used; ``unique`` says that keys cannot repeat, as in the
    result of a grouping by the key, and saves that step.
    """

    key: Column
    parent: DataFrame
    parent_key: Column
    take: Mapping[str, str]
    unique: bool = False


def _parents(lookup: Lookup, native: bool) -> DataFrame:
    """One row per parent key."""
    row = F.struct(*[F.col(p).alias(c) for c, p in lookup.take.items()])
    key = lookup.parent_key if native else lookup.parent_key.cast("string")
    keyed = lookup.parent.select(key.alias("_parent"), row.alias("_row")).filter(
        F.col("_parent").isNotNull()
    )
    if not lookup.unique:
        by_hash = F.xxhash64("_parent").alias("_hash")
        keyed = keyed.groupBy(by_hash, "_parent").agg(F.min("_row").alias("_row"))
    return keyed.select("_parent", F.xxhash64("_parent").alias("_at"), "_row")


def _type(df: DataFrame, column: Column):
    return df.select(column).schema[0].dataType


def link(child: DataFrame, *lookups: Lookup, row_id: Sequence[str]) -> DataFrame:
    """Add the columns of every lookup to the child.

    ``row_id`` are child columns that tell its rows apart.  Keys of the same type are
    compared as they are, others as text.
    """
    out = child
    for lookup in lookups:
        native = _type(out, lookup.key) == _type(lookup.parent, lookup.parent_key)
        key = lookup.key if native else lookup.key.cast("string")
        spread = F.when(key.isNull(), F.xxhash64(*row_id)).otherwise(F.xxhash64(key))
        out = (
            out.withColumns({"_key": key, "_spread": spread})
            .join(
                _parents(lookup, native),
                (F.col("_spread") == F.col("_at")) & (F.col("_key") == F.col("_parent")),
                "left",
            )
            .withColumns({c: F.col(f"_row.{c}") for c in lookup.take})
            .drop("_key", "_spread", "_parent", "_at", "_row")
        )
    return out
