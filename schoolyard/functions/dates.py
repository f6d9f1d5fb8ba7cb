"""Date and time expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last year accepted for a delivery date, both included.
FIRST_YEAR, LAST_YEAR = 2010, 2030


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_year(c: Column | str, lo: int = FIRST_YEAR, hi: int = LAST_YEAR) -> Column:
    """True for dates inside the years ``lo``..``hi``; NULL dates do not pass.

    Written as a range on the bare column, not on ``year(c)``, so that the
    filter reaches the Parquet reader and can skip row groups.
    """
    c = _col(c)
    return (c >= F.lit(dt.date(lo, 1, 1))) & (c < F.lit(dt.date(hi + 1, 1, 1)))


def in_year(c: Column | str, year: Column) -> Column:
    """True when the date or timestamp falls in the given (bigint) year.

    A range on the bare column, like ``valid_year``.
    """
    first, c = year.cast("int"), _col(c)
    return (c >= F.make_date(first, F.lit(1), F.lit(1))) & (
        c < F.make_date(first + 1, F.lit(1), F.lit(1))
    )


def month_of(c: Column | str) -> Column:
    """First day of the month, as DATE, for a date or a timestamp."""
    return F.trunc(F.to_date(_col(c)), "MM")


def elapsed_hours(start: Column | str, end: Column | str) -> Column:
    """Whole elapsed hours, truncated toward zero; NULL while not ended."""
    return F.timestamp_diff("HOUR", _col(start), _col(end))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar days from start to end."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start))).cast("bigint")


def date_or_null(c: Column | str) -> Column:
    """Cast text to DATE with the empty string read as NULL."""
    c = _col(c)
    return F.nullif(c, F.lit("")).cast("date")
