"""Reusable operators over DataFrames."""

from schoolyard.operators.calendar import dense_months, month_list
from schoolyard.operators.checks import Check, run_checks
from schoolyard.operators.conform import conform_union
from schoolyard.operators.link import Lookup, link
from schoolyard.operators.reduction import reduced
from schoolyard.operators.resolve import directory, resolve_entity
from schoolyard.operators.text import joined_tags
from schoolyard.operators.timeline import as_of, versions

__all__ = [
    "Check",
    "Lookup",
    "as_of",
    "conform_union",
    "dense_months",
    "directory",
    "joined_tags",
    "link",
    "month_list",
    "reduced",
    "resolve_entity",
    "run_checks",
    "versions",
]
