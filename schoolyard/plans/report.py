"""Report layer: dense school x month metrics and the year-to-date portfolio."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schoolyard import functions as fn
from schoolyard.operators import Lookup, dense_months, link, month_list, reduced

ORDER_KEY = ["source_system", "source_order_id"]

# Facts of each ERP's orders, keyed by that ERP's own order number (``order_key``).
BySystem = Mapping[str, DataFrame]

# The facts a school-month row is made of.  A query that needs only some of them
# names them, and the others are neither read nor shuffled.
PARTS = ("orders", "items", "deliveries", "tickets")


@dataclass(frozen=True)
class Scope:
    """The dashboard's global filters: first and last month, and the schools (``school_id``)."""

    first: dt.date | None = None
    last: dt.date | None = None
    schools: DataFrame | None = None

    @property
    def bounded(self) -> bool:
        return self.first is not None or self.last is not None

    def holds(self, date: str) -> Column:
        """Whether a date or timestamp lies in the months; filters sink to the scan."""
        test = F.lit(True)
        if self.first is not None:
            test &= F.col(date) >= F.lit(self.first)
        if self.last is not None:
            test &= F.col(date) < F.add_months(F.lit(self.last), 1)
        return test


EVERYTHING = Scope()


def in_scope(rows: DataFrame, scope: Scope) -> DataFrame:
    """School-month rows of the months and schools in scope."""
    if scope.schools is not None:
        rows = rows.join(scope.schools.select("school_id"), "school_id", "left_semi")
    return rows.filter(scope.holds("month"))


_MEASURES = {
    "total_orders": "bigint",
    "active_orders": "bigint",
    "cancelled_orders": "bigint",
    "ordered_amount": fn.TOTAL,
    "ordered_quantity": fn.TOTAL,
    "total_deliveries": "bigint",
    "successful_deliveries": "bigint",
    "quantity_delivered": "bigint",
    "total_tickets": "bigint",
    "resolution_hours": "bigint",
    "resolved_tickets": "bigint",
}


def _contribution(month: Column, **values: Column) -> list[Column]:
    """One school-month contribution; measures not given are NULL."""
    measures = [
        values.get(m, F.lit(None)).cast(kind).alias(m) for m, kind in _MEASURES.items()
    ]
    return [month.alias("month"), *measures]


def _entry(month: Column, **values: Column) -> Column:
    return F.struct(*_contribution(month, **values))


def facts_of(facts: BySystem, orders: DataFrame) -> dict[str, DataFrame]:
    """Rows of each system's facts whose order may be among the given ones."""
    return {
        system: reduced(
            df,
            "order_key",
            orders.filter(F.col("source_system") == system).select(
                F.col("source_order_id").cast("bigint").alias("order_key")
            ),
        )
        for system, df in facts.items()
    }


def lines_per_order(lines: DataFrame) -> DataFrame:
    """Line totals summed to order grain before anything is joined to them."""
    return lines.groupBy("order_key").agg(
        fn.exact_total("line_total").alias("amount"),
        fn.exact_total("quantity").alias("quantity"),
    )


def drops_per_order(drops: DataFrame) -> DataFrame:
    """Deliveries of each order by month: a list with at most one entry per month."""
    monthly = drops.groupBy("order_key", fn.month_of("delivery_date").alias("month")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col("is_cancelled")).alias("ok"),
        F.sum("quantity_delivered").alias("quantity"),
    )
    return monthly.groupBy("order_key").agg(
        F.collect_list(F.struct("month", "n", "ok", "quantity")).alias("drops")
    )


def tickets_per_order(tickets: DataFrame) -> DataFrame:
    """Tickets and their resolution hours by the order they name."""
    hours = fn.elapsed_hours("created_at", "solved_at")
    number = F.col("order_ref").try_cast("bigint")
    # the reference is text; it names an order if it is that order's id as text
    named = tickets.withColumn(
        "order_key", F.when(number.cast("string") == F.col("order_ref"), number)
    )
    return (
        named.filter(F.col("order_key").isNotNull())
        .groupBy("order_key")
        .agg(
            F.count(F.lit(1)).alias("tickets"),
            F.sum(hours).alias("hours"),
            F.count(hours).alias("solved"),
        )
    )


def activity_per_order(facts: Mapping[str, Sequence[DataFrame]]) -> DataFrame:
    """What was summed up per order, by system, as one row per order.

    The frames of a system are grouped by its own order key, a number, so they
    combine without moving; ids become text only here, once per order.
    """
    systems = []
    for system, frames in facts.items():
        combined = reduce(lambda a, b: a.join(b, "order_key", "full"), frames)
        systems.append(
            combined.select(
                F.lit(system).alias("source_system"),
                F.col("order_key").cast("string").alias("source_order_id"),
                *[c for c in combined.columns if c != "order_key"],
            )
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), systems)


def with_activity(orders: DataFrame, activity: DataFrame) -> DataFrame:
    """Orders with their activity; nothing found means NULLs."""
    key = fn.scoped(*ORDER_KEY)
    wanted = {c: c for c in activity.columns if c not in ORDER_KEY}
    return link(orders, Lookup(key, activity, key, wanted, unique=True), row_id=ORDER_KEY)


def _order_facts(
    orders: DataFrame,
    lines: BySystem,
    drops: BySystem,
    parts: Collection[str],
    scope: Scope = EVERYTHING,
) -> DataFrame:
    """School-month contributions of orders, their lines and their deliveries.

    Orders, lines and deliveries meet once, on the order key, with the two large
    facts already at order grain.  Each order then lists its contributions: one in
    the month it was placed and one per month it was delivered in.
    """
    joined = orders.select(*ORDER_KEY, "school_id", "order_date", "is_cancelled").filter(
        F.col("school_id").isNotNull()
    )
    if scope.schools is not None:
        joined = joined.join(scope.schools.select("school_id"), "school_id", "left_semi")
    if "deliveries" not in parts:
        joined = joined.filter(F.col("order_date").isNotNull() & scope.holds("order_date"))
    facts: dict[str, list[DataFrame]] = {system: [] for system in lines}
    month = fn.month_of("order_date")
    placed: dict[str, Column] = {}
    if "orders" in parts:
        placed |= {
            "total_orders": F.lit(1),
            "active_orders": (~F.col("is_cancelled")).cast("bigint"),
            "cancelled_orders": F.col("is_cancelled").cast("bigint"),
        }
    if "items" in parts:
        for system, df in lines.items():
            facts[system].append(lines_per_order(df))
        placed |= {
            "ordered_amount": F.col("amount"),
            "ordered_quantity": F.col("quantity"),
        }
    if "deliveries" in parts:
        entries = F.when(F.col("order_date").isNotNull(), F.array(_entry(month, **placed)))
        for system, df in drops.items():
            facts[system].append(drops_per_order(df.filter(scope.holds("delivery_date"))))
        delivered = F.transform(
            "drops",
            lambda d: _entry(
                d["month"],
                total_deliveries=d["n"],
                successful_deliveries=d["ok"],
                quantity_delivered=d["quantity"],
            ),
        )
        none = F.array().cast(f"array<{_entry_type()}>")
        entries = F.concat(F.coalesce(entries, none), F.coalesce(delivered, none))
    if any(facts.values()):
        joined = with_activity(joined, activity_per_order(facts))
    if "deliveries" in parts:
        contributed = joined.select("school_id", F.inline(entries))
    else:  # one each
        contributed = joined.select("school_id", *_contribution(month, **placed))
    return contributed.filter(scope.holds("month"))


def _entry_type() -> str:
    return "struct<month:date," + ",".join(f"{m}:{k}" for m, k in _MEASURES.items()) + ">"


def _ticket_facts(tickets: DataFrame, org_schools: DataFrame) -> DataFrame:
    """Tickets summed per organisation and month, then moved to the school."""
    hours = fn.elapsed_hours("created_at", "solved_at")
    monthly = (
        tickets.filter(F.col("organization_id").isNotNull())
        .groupBy("organization_id", fn.month_of("created_at").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(hours).alias("hours"),
            F.count(hours).alias("solved"),
        )
    )
    # unique like the organisation id itself; copies would multiply the sums
    schools = org_schools.groupBy("organization_id").agg(F.min("school_id").alias("school_id"))
    entry = _entry(
        F.col("month"),
        total_tickets=F.col("n"),
        resolution_hours=F.col("hours"),
        resolved_tickets=F.col("solved"),
    )
    return (
        monthly.join(schools, "organization_id")
        .filter(F.col("school_id").isNotNull() & F.col("month").isNotNull())
        .select("school_id", F.inline(F.array(entry)))
    )


def school_month_facts(
    orders: DataFrame,
    lines: BySystem,
    drops: BySystem,
    tickets: DataFrame,
    org_schools: DataFrame,
    parts: Collection[str] = PARTS,
    scope: Scope = EVERYTHING,
) -> DataFrame:
    """Sparse facts: one row per school and month in which something happened.

    A scope is applied to orders, deliveries and tickets before they are joined.
    """
    stacked = []
    if set(parts) & {"orders", "items", "deliveries"}:
        stacked.append(_order_facts(orders, lines, drops, parts, scope))
    if "tickets" in parts:
        asked = tickets.filter(scope.holds("created_at"))
        if scope.schools is not None:
            wanted = scope.schools.select("school_id")
            org_schools = org_schools.join(wanted, "school_id", "left_semi")
        stacked.append(_ticket_facts(asked, org_schools))
    facts = reduce(DataFrame.unionByName, stacked)
    added = facts.groupBy("school_id", "month").agg(
        *[
            (fn.merged(m) if kind == fn.TOTAL else F.sum(m).cast(kind)).alias(m)
            for m, kind in _MEASURES.items()
        ]
    )
    return fn.with_rounded(added, *[m for m, kind in _MEASURES.items() if kind == fn.TOTAL])


def active_months(
    orders: DataFrame, drops: BySystem, tickets: DataFrame, summed: bool = False
) -> DataFrame:
    """Months with any order, delivery or ticket, linked to a school or not.

    The months do not depend on links, so plain column scans are enough.  With
    ``summed`` the deliveries are taken as the report sums them up, and the two then
    share one scan and shuffle.
    """
    if summed:
        dropped = [
            drops_per_order(df).select(F.explode("drops.month").alias("month"))
            for df in drops.values()
        ]
    else:
        dropped = [
            df.select(fn.month_of("delivery_date").alias("month")) for df in drops.values()
        ]
    return month_list(
        orders.select(fn.month_of("order_date").alias("month")),
        *dropped,
        tickets.select(fn.month_of("created_at").alias("month")),
    )


def monthly_metrics(schools: DataFrame, facts: DataFrame, months: DataFrame) -> DataFrame:
    """Every school in every active month; counts and sums 0, averages NULL if none.

    ``ordered_amount`` includes cancelled orders.
    """
    dense = dense_months(
        schools.select("school_id", F.col("name").alias("school_name"), "cnpj", "city", "state"),
        facts,
        months,
        "school_id",
        list(_MEASURES),
    )

    def filled(m: str, kind: str) -> Column:
        return F.coalesce(F.col(m).cast(kind), F.lit(0).cast(kind)).alias(m)

    return dense.select(
        "school_id",
        "school_name",
        "cnpj",
        "city",
        "state",
        "month",
        filled("total_orders", "bigint"),
        filled("active_orders", "bigint"),
        filled("cancelled_orders", "bigint"),
        filled("ordered_amount", "double"),
        filled("ordered_quantity", "double"),
        filled("total_deliveries", "bigint"),
        filled("successful_deliveries", "bigint"),
        filled("quantity_delivered", "bigint"),
        filled("total_tickets", "bigint"),
        mean_hours("resolution_hours", "resolved_tickets").alias("avg_resolution_hours"),
    )


def mean_hours(total: str, n: str) -> Column:
    """Mean of whole hours from its two sums; NULL when nothing was resolved."""
    return F.when(F.col(n) > 0, F.col(total).cast("double") / F.col(n))


# -- year to date ----------------------------------------------------------


def reference_year(orders: DataFrame) -> DataFrame:
    """Latest order year in the data, cancelled orders included (one row)."""
    return orders.agg(F.year(F.max("order_date")).cast("bigint").alias("year"))


def owner_totals(per_order: DataFrame, owner: str, sums: Sequence[str]) -> DataFrame:
    """(owner, orders, schools, sums): distinct orders and schools of the orders that are
    ``sold``, and sums over all rows.

    Rows meet by order first, where an order that occurs more than once becomes one, and by
    (owner, school) next, so an owner with a third of all orders is spread over many groups.
    An order with several schools counts with its first.
    """
    once = per_order.groupBy(owner, *ORDER_KEY).agg(
        F.bool_or("sold").alias("sold"),
        F.array_sort(F.collect_set(F.when(F.col("sold"), F.col("school_id")))).alias("schools"),
        *[fn.summed(per_order, c).alias(c) for c in sums],
    )
    parts = once.select(
        owner, "sold", *sums, F.posexplode_outer("schools").alias("nth", "school_id")
    )
    first = F.coalesce(F.col("nth"), F.lit(0)) == 0
    per_school = parts.groupBy(owner, "school_id").agg(
        F.count_if(first & F.col("sold")).alias("orders"),
        *[fn.summed(parts, c, where=first).alias(c) for c in sums],
    )
    return per_school.groupBy(owner).agg(
        F.sum("orders").alias("orders"),
        F.count("school_id").alias("schools"),
        *[fn.summed(per_school, c).alias(c) for c in sums],
    )


def ytd_portfolio(
    managers: DataFrame,
    contracts: DataFrame,
    orders: DataFrame,
    lines: BySystem,
    tickets: DataFrame,
    year: DataFrame,
) -> DataFrame:
    """Portfolio of every account manager in the reference year.

    ``tickets`` are clean tickets; a ticket belongs to the manager of the ERP B
    order it names.  Orders, lines and tickets meet once at order grain.
    """
    ref = year.scalar()
    signed = (
        contracts.filter(~F.col("is_cancelled") & fn.in_year("start_date", ref))
        .groupBy("account_manager_id", "contract_id")
        .agg(fn.exact_total("grand_total").alias("total"))
        .groupBy("account_manager_id")
        .agg(
            F.count("contract_id").alias("total_contracts"),
            fn.rounded(fn.merged("total")).alias("total_contracted_amount"),
        )
    )
    asked = tickets_per_order(tickets.filter(fn.in_year("created_at", ref)))
    facts = {system: [lines_per_order(df)] for system, df in lines.items()}
    facts["erp_b"].append(asked)
    sold = ~F.col("is_cancelled") & fn.in_year("order_date", ref)
    per_order = (
        orders.filter(F.col("account_manager_id").isNotNull())
        .select(*ORDER_KEY, "account_manager_id", "school_id", sold.alias("sold"))
    )
    per_order = with_activity(per_order, activity_per_order(facts))
    per_order = per_order.withColumn("amount", F.when(F.col("sold"), F.col("amount")))
    activity = owner_totals(
        per_order, "account_manager_id", ["amount", "tickets", "hours", "solved"]
    ).select(
        "account_manager_id",
        F.col("orders").alias("total_orders"),
        F.col("schools").alias("total_schools_served"),
        fn.rounded("amount").alias("ordered_amount"),
        F.col("tickets").alias("total_tickets"),
        "hours",
        "solved",
    )

    def zero(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0)).alias(c)

    return (
        managers.join(signed, "account_manager_id", "left")
        .join(activity, "account_manager_id", "left")
        .select(
            "account_manager_id",
            F.col("name").alias("account_manager_name"),
            "email",
            "profile_name",
            ref.alias("year"),
            zero("total_contracts"),
            zero("total_contracted_amount"),
            zero("total_orders"),
            zero("total_schools_served"),
            zero("ordered_amount"),
            zero("total_tickets"),
            mean_hours("hours", "solved").alias("avg_resolution_hours"),
        )
    )
