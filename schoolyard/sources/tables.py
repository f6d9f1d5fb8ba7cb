"""Written tables: replace-all, month-partitioned, month-wise refresh, and clustering by range."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Collection

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the load stamp every written entity and report carries.
STAMP = "dbt_updated_at"
#: Rows of a file of a clustered table: about 128 MB of orders.
FILE_ROWS = 2_000_000


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn(STAMP, F.current_timestamp())


def _aside(name: str) -> str:
    """Where the new months of a refresh wait."""
    return f"{name}__aside"


def _listed(name: str) -> str:
    """The months of a refresh that is committed but not in place; empty otherwise."""
    return f"{name}__months"


class Store:
    """Tables in a catalog (``layer.name``), or in folders below ``root``.

    On a cluster ``root`` is shared storage; nothing is kept on one machine.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self._spark = spark
        self._root = root.rstrip("/") if root else None

    def _path(self, layer: str, name: str) -> str:
        return f"{self._root}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        """The table; a refresh that was cut short is finished first."""
        self._finish(layer, name)
        return self._table(layer, name)

    def _table(self, layer: str, name: str) -> DataFrame:
        if self._root is None:
            return self._spark.table(f"{layer}.{name}")
        return self._spark.read.parquet(self._path(layer, name))

    def _exists(self, layer: str, name: str) -> bool:
        if self._root is None:
            return self._spark.catalog.tableExists(f"{layer}.{name}")
        try:
            self._spark.read.parquet(self._path(layer, name))
        except AnalysisException:  # no such folder, or nothing written to it
            return False
        return True

    def replace(self, df: DataFrame, layer: str, name: str) -> DataFrame:
        """Overwrite the whole table and return it as read back."""
        self._save(df.write.mode("overwrite"), layer, name)
        return self.read(layer, name)

    def replace_months(
        self, df: DataFrame, layer: str, name: str, month: str, cluster_by: str
    ) -> DataFrame:
        """Overwrite the table, one folder per month, rows near by ``cluster_by``."""
        self._save(self._by_month(df, month, cluster_by), layer, name)
        return self.read(layer, name)

    def refresh_months(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        month: str,
        cluster_by: str,
        months: Collection[dt.date | None],
    ) -> DataFrame:
        """Overwrite exactly the given months (None: rows without one); the others stay.

        ``df`` holds all rows of those months. A month that has none any more is emptied.

        The new months are first written aside, and then the list of months. That list is the
        commit: before it is there, the table is as it was; once it is, the months are put in
        place, and a run that fails on the way is finished by the next read or refresh. Putting
        them in place twice gives the same table.
        """
        self._finish(layer, name)
        columns = self._table(layer, name).columns
        self._save(self._by_month(df.select(*columns), month, cluster_by), layer, _aside(name))
        self._list(layer, name, [(m, month, cluster_by, None) for m in months])
        return self.read(layer, name)

    def cluster_months(
        self,
        layer: str,
        name: str,
        month: str,
        cluster_by: str,
        months: Collection[dt.date | None] | None = None,
        file_rows: int = FILE_ROWS,
    ) -> DataFrame:
        """Lay the given months (all by default) out anew: files hold ranges of ``cluster_by``.

        Rows are dealt by range of month and ``cluster_by``, about ``file_rows`` to a file, so a
        filter on ``cluster_by`` meets one or two files a month by the ranges in their footers, and
        Parquet's bloom filters spare those as well that do not hold the value. A value with very
        many rows goes on over several files. The ranges are found on the two columns of the
        written table; what the table is made from is not computed again. Rows stay as they are,
        and a run that fails leaves the table whole, as for a refresh.
        """
        table = self.read(layer, name)
        if months is not None:
            dated = [m for m in months if m is not None]
            wanted = F.col(month).isin(dated)
            table = table.filter(wanted | F.col(month).isNull() if None in months else wanted)
        found = [r[0] for r in table.select(month).distinct().collect()]  # bounded by the calendar
        if found:
            # put aside first: a table cannot be read and overwritten at once
            self._save(table.write.mode("overwrite"), layer, _aside(name))
            self._list(layer, name, [(m, month, cluster_by, file_rows) for m in found])
        return self.read(layer, name)

    def _list(self, layer: str, name: str, plan: list[tuple]) -> None:
        """Commit the months that wait aside; an empty list says that all are in place."""
        listed = self._spark.createDataFrame(
            plan, "m date, month string, cluster string, file_rows long"
        )
        self._save(listed.coalesce(1).write.mode("overwrite"), layer, _listed(name))

    def _finish(self, layer: str, name: str) -> None:
        """Put in place what a refresh has committed; nothing to do otherwise."""
        if not self._exists(layer, _listed(name)):
            return
        plan = self._table(layer, _listed(name)).collect()  # bounded by the calendar
        if not plan:
            return
        staged = self._table(layer, _aside(name))
        column, cluster_by, file_rows = (plan[0][c] for c in ("month", "cluster", "file_rows"))
        self._put(staged, layer, name, column, cluster_by, [r["m"] for r in plan], file_rows)
        self._list(layer, name, [])

    def _put(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        month: str,
        cluster_by: str,
        months: Collection[dt.date | None],
        file_rows: int | None,
    ) -> None:
        if self._root is None:
            table = f"{layer}.{name}"
            df = df.select(*self._table(layer, name).columns)
            # insertInto takes the overwrite mode from the session only
            mode = "spark.sql.sources.partitionOverwriteMode"
            before = self._spark.conf.get(mode)
            self._spark.conf.set(mode, "dynamic")
            try:
                arranged = self._arranged(df, month, cluster_by, file_rows)
                arranged.write.mode("overwrite").insertInto(table)
            finally:
                self._spark.conf.set(mode, before)
        else:
            self._by_month(df, month, cluster_by, file_rows).option(
                "partitionOverwriteMode", "dynamic"
            ).save(self._path(layer, name))
        written = self._table(layer, name)
        # only the months themselves come here, which the calendar bounds
        filled = {r[0] for r in df.select(month).distinct().collect()}
        empty = written.drop(month).limit(0)
        for gone in set(months) - filled:
            self._empty(empty, layer, name, month, gone)

    def _empty(
        self, empty: DataFrame, layer: str, name: str, month: str, gone: dt.date | None
    ) -> None:
        if self._root is None:
            value = "NULL" if gone is None else f"DATE'{gone.isoformat()}'"
            columns = ", ".join(f"CAST(NULL AS {t}) AS `{c}`" for c, t in empty.dtypes)
            self._spark.sql(
                f"INSERT OVERWRITE TABLE {layer}.{name} PARTITION ({month} = {value}) "
                f"SELECT {columns} WHERE false"
            )
        else:
            folder = "__HIVE_DEFAULT_PARTITION__" if gone is None else gone.isoformat()
            # built from the schema: the rows to be overwritten are not read
            bare = self._spark.createDataFrame([], empty.schema)
            bare.write.mode("overwrite").parquet(f"{self._path(layer, name)}/{month}={folder}")

    def _arranged(
        self, df: DataFrame, month: str, cluster_by: str, file_rows: int | None = None
    ) -> DataFrame:
        if file_rows is None:
            # Rebalancing gathers a month in few files, yet splits a month that holds
            # much of the data; a plain repartition would give it to one task.
            dealt = df.hint("rebalance", F.col(month))
        else:
            files = max(1, math.ceil(df.count() / file_rows))  # from the footers
            # the hash of the row lets a value with many rows go on in the next file
            dealt = df.repartitionByRange(files, month, cluster_by, F.xxhash64(*df.columns))
        return dealt.sortWithinPartitions(month, cluster_by)

    def _by_month(self, df: DataFrame, month: str, cluster_by: str, file_rows: int | None = None):
        arranged = self._arranged(df, month, cluster_by, file_rows)
        return (
            arranged.write.mode("overwrite")
            .partitionBy(month)
            .option(f"parquet.bloom.filter.enabled#{cluster_by}", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
        )

    def _save(self, writer, layer: str, name: str) -> None:
        if self._root is None:
            self._spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
            writer.saveAsTable(f"{layer}.{name}")
        else:
            writer.save(self._path(layer, name))
