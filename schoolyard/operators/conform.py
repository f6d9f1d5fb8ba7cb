"""Union of sources that share one column list."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def conform_union(sources: Mapping[str, DataFrame], tag: str = "source_system") -> DataFrame:
    """Stack conformed sources by column name, each row tagged with its source.

    Nothing is de-duplicated: the same contract may have orders in two systems
    and both count.
    """
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in sources.items()]
    return reduce(DataFrame.unionByName, tagged)
