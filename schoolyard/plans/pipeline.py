"""The full run: entities and reports written in the order they depend on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schoolyard import functions as fn
from schoolyard.plans import curated
from schoolyard.plans.workspace import Workspace
from schoolyard.sources.names import clean_name, curated_name, report_name
from schoolyard.sources.tables import STAMP, Store, stamped

# Tables that grow with every day are laid out by month, rows sorted by school.
MONTH = "partition_month"
_MONTHLY = {"order": ("order_date", "school_id"), "delivery": ("delivery_date", "order_id")}


def clean_views(ws: Workspace) -> dict[str, str]:
    """Register every clean table as a temporary view; nothing is computed."""
    names = {}
    for table in ws.clean:
        names[table] = clean_name(table)
        ws.clean[table].createOrReplaceTempView(names[table])
    return names


def _build(ws: Workspace, entity: str) -> DataFrame:
    return {
        "school": lambda: ws.schools,
        "account_manager": lambda: ws.account_managers,
        "contract": lambda: ws.contracts,
        "order": lambda: ws.orders,
        "order_item": lambda: ws.order_items,
        "delivery": lambda: ws.deliveries,
        "ticket": lambda: ws.tickets,
    }[entity]()


def run(raw, store: Store) -> Workspace:
    """Build and write everything; each entity is read back by its dependants.

    The clean layer is registered as views.
    """
    clean_views(Workspace(raw))
    stored: dict[str, DataFrame] = {}
    entities = ("school", "account_manager", "contract", "order", "order_item", "delivery", "ticket")
    for entity in entities:
        df = stamped(_build(Workspace(raw, stored), entity))
        name = curated_name(entity)
        if entity in _MONTHLY:
            day, cluster = _MONTHLY[entity]
            df = df.withColumn(MONTH, fn.month_of(day))
            written = store.replace_months(df, "curated", name, MONTH, cluster)
        else:
            written = store.replace(df, "curated", name)
        stored[entity] = written.drop(MONTH, STAMP)
    ws = Workspace(raw, stored)
    monthly = store.replace(stamped(ws.monthly_metrics()), "report", report_name("monthly"))
    ytd = store.replace(stamped(ws.ytd_portfolio), "report", report_name("ytd"))
    stored |= {"monthly": monthly.drop(STAMP), "ytd": ytd.drop(STAMP)}
    return Workspace(raw, stored)


def _refresh(
    store: Store,
    entity: str,
    unified: DataFrame,
    row_key: str,
    build: Callable[[DataFrame], DataFrame],
    since: dt.date,
) -> DataFrame:
    """Rebuild the months from ``since`` on, what has no date, and what has moved.

    A row that is, or was when the table was written, in the refreshed months may have come
    from another month or gone to one; those months are rebuilt with it. The months are applied
    to the unified rows before anything is joined, so only they are read and linked.
    """
    day, cluster = _MONTHLY[entity]
    name = curated_name(entity)
    start = F.lit(since.replace(day=1))
    keys = ["source_system", row_key]
    before = store.read("curated", name).select(*keys, F.col(MONTH).alias("month"))
    now = unified.select(*keys, fn.month_of(day).alias("month"))

    def refreshed(df: DataFrame) -> DataFrame:
        return df.filter(F.col("month").isNull() | (F.col("month") >= start))

    touched = refreshed(before).select(*keys).union(refreshed(now).select(*keys)).distinct()
    places = before.union(now).join(touched, keys, "left_semi").select("month").distinct()
    months = [r["month"] for r in places.collect()]  # bounded by the calendar
    dated = [m for m in months if m is not None]
    wanted = fn.month_of(day).isin(dated)
    if None in months:
        wanted = wanted | F.col(day).isNull()
    if dated:  # a range on the bare column, which reaches the files
        in_range = F.col(day) >= F.lit(min(dated))
        wanted = wanted & (in_range | F.col(day).isNull())
    fresh = stamped(build(unified.filter(wanted))).withColumn(MONTH, fn.month_of(day))
    return store.refresh_months(fresh, "curated", name, MONTH, cluster, months)


def refresh_orders(ws: Workspace, store: Store, since: dt.date) -> DataFrame:
    """The order table as a full rebuild would leave it, given that what changed is dated
    ``since`` or later now, was so before, or has no date."""
    return _refresh(
        store,
        "order",
        ws.orders_unified,
        "source_order_id",
        lambda recent: curated.orders(recent, ws.contracts, ws.school_directory),
        since,
    )


def refresh_deliveries(ws: Workspace, store: Store, since: dt.date) -> DataFrame:
    """The delivery table, likewise."""
    return _refresh(
        store,
        "delivery",
        ws.deliveries_unified,
        "source_delivery_id",
        lambda recent: curated.deliveries(recent, ws.order_keys),
        since,
    )


def cluster(store: Store, months: Collection[dt.date | None] | None = None) -> None:
    """Lay the monthly tables out by range of their keys: orders by school, deliveries by order.

    Meant for months that have settled; a refresh rewrites its months in the plain layout."""
    for entity, (_, key) in _MONTHLY.items():
        store.cluster_months("curated", curated_name(entity), MONTH, key, months)
