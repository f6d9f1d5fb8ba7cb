"""Loads that go on past bad lines: what cannot be read lands in a rejects table.

A line is read by itself, so a quoted line break is two bad lines here; tables that have some are
read by ``read_csv(..., multiline=True)``, which fails on the first bad record instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from schoolyard.sources.raw import RAW_COLUMNS, RAW_TABLES
from schoolyard.sources.tables import Store

_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}

#: Why a line is not read.
OPEN_QUOTE, TOO_FEW, TOO_MANY = "open quote", "too few values", "too many values"


class LoadRejected(ValueError):
    """More lines than allowed cannot be read."""


@dataclass(frozen=True)
class Load:
    """What one load gave; the frames read written tables."""

    rows: DataFrame
    rejects: DataFrame
    report: DataFrame


def _quotes(line: str) -> Column:
    return F.length(line) - F.length(F.replace(F.col(line), F.lit('"'), F.lit("")))


def parsed(lines: DataFrame, table: str) -> DataFrame:
    """``lines`` (file, line) with the reason why a line is not read, null where it is, and its
    values as the struct ``values``.

    A line is read when its quotes are closed and it has as many values as the table has columns.
    A blank or null line is no row and no reject.
    """
    n_columns = len(RAW_COLUMNS[table].split())
    # what separates values: the commas outside quotes
    outside = F.regexp_replace("line", '"[^"]*"', "")
    commas = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit("")))
    reason = (
        F.when(_quotes("line") % 2 != 0, OPEN_QUOTE)
        .when(commas < n_columns - 1, TOO_FEW)
        .when(commas > n_columns - 1, TOO_MANY)
    )
    values = F.from_csv("line", ", ".join(f"`{c}` string" for c in RAW_COLUMNS[table].split()), _OPTIONS)
    read = lines.filter(F.trim("line") != "")
    return read.select("file", "line", reason.alias("reason"), values.alias("values"))


def report_of(parsed_lines: DataFrame) -> DataFrame:
    """A row per file: its lines, those read, and those rejected by reason."""
    return parsed_lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("reason").isNull()).alias("n_read"),
        *[
            F.count_if(F.col("reason") == why).alias(f"n_{why.replace(' ', '_')}")
            for why in (OPEN_QUOTE, TOO_FEW, TOO_MANY)
        ],
    )


def csv_lines(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """(file, line) of ``<folder>/<table>.csv``, a file or a folder of part files, without headers.

    The files are split like any large text. A header that is not the declared one stays among
    the lines, so that ``load_csv`` sees that the file lacks its own.
    """
    path = f"{folder.rstrip('/')}/{table}.csv"
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.regexp_replace("value", "^\ufeff", "").alias("line"),
    )


def load_csv(
    spark: SparkSession, folder: str, table: str, store: Store, max_rejected_share: float = 0.001
) -> Load:
    """Load a table from its extract, past bad lines, unless too many of them are bad.

    Lines are parsed once, into a table aside. When a file lacks the declared header, or more than
    ``max_rejected_share`` of the lines are rejected, ``LoadRejected`` is raised and the table of
    the load before stays; the rejects of this load are written either way. Written are
    ``raw.<table>``, ``raw.<table>__rejects`` (file, reason, line) and ``raw.<table>__report``
    (a row per file).
    """
    header = ",".join(RAW_COLUMNS[table].split())
    lines = csv_lines(spark, folder, table)
    is_header = F.replace(F.col("line"), F.lit('"'), F.lit("")) == header
    marked = parsed(lines, table).withColumn("header", is_header)
    staged = store.replace(marked, "raw", f"{table}__aside")

    body = staged.filter(~F.col("header"))
    headers = staged.groupBy("file").agg(F.count_if("header").alias("n_headers"))
    report = headers.join(report_of(body), "file", "left").na.fill(0)
    report = store.replace(report, "raw", f"{table}__report")
    rejects = body.filter("reason IS NOT NULL").select("file", "reason", "line")
    rejects = store.replace(rejects, "raw", f"{table}__rejects")

    total = report.agg(
        F.sum("n_lines").alias("n_lines"),
        F.sum(F.col("n_lines") - F.col("n_read")).alias("n_rejected"),
        F.min(F.when(F.col("n_headers") == 0, F.col("file"))).alias("bare"),
    ).first()
    if total.bare is not None:
        raise LoadRejected(f"{table}: no header of the declared columns in {total.bare}")
    if total.n_rejected and total.n_rejected > max_rejected_share * total.n_lines:
        raise LoadRejected(f"{table}: {total.n_rejected} of {total.n_lines} lines cannot be read")
    rows = body.filter("reason IS NULL").select("values.*")
    return Load(store.replace(rows, "raw", table), rejects, report)


def load_all(
    spark: SparkSession, folder: str, store: Store, max_rejected_share: float = 0.001
) -> dict[str, DataFrame]:
    """All extracts loaded, as written; the first table with too many bad lines ends the run."""
    return {t: load_csv(spark, folder, t, store, max_rejected_share).rows for t in RAW_TABLES}
