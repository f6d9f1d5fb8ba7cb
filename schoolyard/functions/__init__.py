"""Column expressions; all of them stay inside the JVM."""

from schoolyard.functions.amounts import (
    TOTAL,
    as_double,
    difference,
    exact,
    exact_sum,
    exact_total,
    merged,
    rounded,
    running_difference,
    summed,
    with_rounded,
)
from schoolyard.functions.dates import (
    date_or_null,
    days_between,
    elapsed_hours,
    in_year,
    month_of,
    valid_year,
)
from schoolyard.functions.keys import digits, norm_code, scoped, surrogate_key, valid_digits
from schoolyard.functions.status import map_status

__all__ = [
    "TOTAL",
    "as_double",
    "date_or_null",
    "days_between",
    "difference",
    "digits",
    "elapsed_hours",
    "exact",
    "exact_sum",
    "exact_total",
    "in_year",
    "map_status",
    "merged",
    "month_of",
    "norm_code",
    "rounded",
    "running_difference",
    "scoped",
    "summed",
    "surrogate_key",
    "valid_digits",
    "valid_year",
    "with_rounded",
]
