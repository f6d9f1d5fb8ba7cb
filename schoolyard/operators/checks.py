"""Declarative checks: one row per check with the number of failures."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A statement about one column of one table.

    kind is ``unique`` (failures: values that occur more than once), ``not_null``
    (rows), ``accepted_values`` (distinct values outside ``values``) or
    ``relationships`` (rows whose value is missing from ``parent.parent_column``).
    NULLs only fail ``not_null``.
    """

    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""


def _label(check: Check) -> list[Column]:
    return [
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_name"),
    ]


def _row_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All not_null checks of a table in one pass."""
    nulls = df.agg(
        F.array(
            *[
                F.struct(*_label(c), F.count_if(F.col(c.column).isNull()).alias("failures"))
                for c in checks
            ]
        ).alias("_checks")
    )
    return nulls.select(F.inline("_checks"))


def _value_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All unique and accepted_values checks of a table in one pass.

    A row gives a (check, value) pair per check, without the values that a check accepts.
    Pairs are counted once, map-side first, and each check counts its bad values.
    """

    def suspect(c: Check) -> Column:
        v = F.col(c.column)
        return (v if c.kind == "unique" else F.when(~v.isin(*c.values), v)).cast("string")

    pairs = F.array(
        *[F.struct(F.lit(i).alias("check"), suspect(c).alias("value")) for i, c in enumerate(checks)]
    )
    counted = (
        df.select(F.inline(pairs)).filter("value IS NOT NULL").groupBy("check", "value").count()
    )

    def bad(i: int, c: Check) -> Column:
        found = F.col("check") == i
        return found & (F.col("count") > 1) if c.kind == "unique" else found

    failed = F.array(
        *[
            F.struct(*_label(c), F.count_if(bad(i, c)).alias("failures"))
            for i, c in enumerate(checks)
        ]
    )
    return counted.agg(failed.alias("_checks")).select(F.inline("_checks"))


def _relationship(df: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    """Child rows without a parent; children are counted by key before the join."""
    keys = df.filter(F.col(check.column).isNotNull()).groupBy(
        F.col(check.column).alias("_key")
    ).agg(F.count(F.lit(1)).alias("_rows"))
    known = parent.select(F.col(check.parent_column).alias("_key")).distinct()
    orphans = keys.join(known, "_key", "left_anti")
    failures = F.coalesce(F.sum("_rows"), F.lit(0).cast("bigint"))
    return orphans.agg(failures.alias("failures")).select(*_label(check), "failures")


def run_checks(table: Callable[[str], DataFrame], checks: Iterable[Check]) -> DataFrame:
    """(table_name, column_name, check_name, failures) for every check.

    not_null checks of one table share a pass, and so do its unique and accepted_values
    checks.  Values are counted map-side first; no group is collected.
    """
    out: list[DataFrame] = []
    passes: dict[tuple[str, bool], list[Check]] = {}
    for c in checks:
        if c.kind == "relationships":
            out.append(_relationship(table(c.table), table(c.parent), c))
        elif c.kind in ("unique", "accepted_values", "not_null"):
            passes.setdefault((c.table, c.kind == "not_null"), []).append(c)
        else:
            raise ValueError(f"unknown check {c.kind!r}")
    for (name, by_row), group in passes.items():
        out.append((_row_checks if by_row else _value_checks)(table(name), group))
    return reduce(DataFrame.unionByName, out)
