"""Ordered text aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def joined_tags(df: DataFrame, key: str, value: str, out: str, sep: str = ",") -> DataFrame:
    """Values of each key, sorted and joined; repeats stay, NULL values do not count.

    Repeats are counted map-side first and written out again at the end, so that a
    value copied many times does not travel many times.  A key with NULL values
    only is absent, which a left join turns into NULL (and not into '').
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(key, value).count()
    again = F.repeat(F.concat(F.lit(sep), F.col(value)), F.col("count").cast("int") - 1)
    return (
        counted.select(key, value, F.concat(F.col(value), again).alias("_run"))
        .groupBy(key)
        .agg(F.expr(f"listagg(_run, '{sep}') WITHIN GROUP (ORDER BY {value})").alias(out))
    )
