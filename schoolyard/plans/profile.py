"""Profiling queries: how well systems match, how well fields are filled."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schoolyard import functions as fn
from schoolyard.functions.dates import FIRST_YEAR, LAST_YEAR
from schoolyard.plans.report import (
    BySystem,
    activity_per_order,
    facts_of,
    lines_per_order,
    owner_totals,
    with_activity,
)


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part).cast("double") / F.col(whole))


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def match_rate(left: DataFrame, key: str, others: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of ``left`` whose key occurs in each other system.

    Rows are counted by key on the left and keys made distinct on the right, so the
    join is one to one whatever the repeats.
    """
    counted = left.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    out = []
    for name, df in others.items():
        known = df.select(F.col(key).alias("_key"), F.lit(True).alias("_hit")).distinct()
        out.append(
            counted.join(known, "_key", "left")
            .agg(
                F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"),
                F.coalesce(F.sum(F.when(F.col("_hit"), F.col("_rows"))), F.lit(0)).alias(
                    "n_matched"
                ),
            )
            .select(F.lit(name).alias("target"), "n_rows", "n_matched")
        )
    return _stack(out).withColumn("match_rate", _share("n_matched", "n_rows"))


def contract_overlap(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Contract numbers with orders in both ERPs: counts and amounts per system.

    ``lines`` holds one amount per order.
    """
    a, b = F.col("source_system") == "erp_a", F.col("source_system") == "erp_b"
    numbered = orders.filter(F.col("contract_number").isNotNull()).select(
        "source_system", "source_order_id", "contract_number"
    )
    per_contract = (
        with_activity(numbered, lines)
        .groupBy("contract_number")
        .agg(
            F.count_if(a).alias("erp_a_orders"),
            F.count_if(b).alias("erp_b_orders"),
            fn.merged(F.when(a, F.col("amount"))).alias("erp_a_amount"),
            fn.merged(F.when(b, F.col("amount"))).alias("erp_b_amount"),
        )
    )
    both = per_contract.filter((F.col("erp_a_orders") > 0) & (F.col("erp_b_orders") > 0))
    return both.withColumns(
        {
            c: F.coalesce(fn.rounded(c), F.lit(0.0))
            for c in ("erp_a_amount", "erp_b_amount")
        }
    )


def order_status_map(sales_order_raw: DataFrame, pedido_raw: DataFrame) -> DataFrame:
    """Orders per source spelling and harmonised status."""
    from schoolyard.functions import status as st

    a = sales_order_raw.select(
        F.lit("erp_a").alias("source_system"),
        F.concat_ws("/", "Cancelled", "DocStatus").alias("raw_status"),
        st.erp_a_status(F.col("Cancelled"), F.col("DocStatus")).alias("status"),
    )
    b = pedido_raw.select(
        F.lit("erp_b").alias("source_system"),
        F.col("status").alias("raw_status"),
        st.erp_b_status(F.col("status")).alias("status"),
    )
    return (
        a.unionByName(b)
        .groupBy("source_system", "raw_status", "status")
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )


def status_profile(status_map: DataFrame) -> DataFrame:
    """Distinct spellings behind each harmonised status."""
    return status_map.groupBy("source_system", "status").agg(
        F.count("raw_status").alias("n_spellings"), F.sum("n_orders").alias("n_orders")
    )


def delivery_status_map(note: DataFrame) -> DataFrame:
    return note.groupBy("delivery_status", "delivery_status_normalized").agg(
        F.count(F.lit(1)).alias("n_notes")
    )


def delivery_coverage(orders: DataFrame, drops: BySystem) -> DataFrame:
    """Share of the non-cancelled orders with at least one delivery, per ERP."""
    delivered = activity_per_order(
        {
            system: [df.groupBy("order_key").agg(F.count(F.lit(1)).alias("drops"))]
            for system, df in drops.items()
        }
    )
    live = orders.filter(~F.col("is_cancelled")).select("source_system", "source_order_id")
    return (
        with_activity(live, delivered)
        .groupBy("source_system")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.count("drops").alias("n_delivered"))
        .withColumn("coverage", _share("n_delivered", "n_orders"))
    )


def contracts_by_profile(contract: DataFrame, user: DataFrame) -> DataFrame:
    """Contracts per profile of their owner; counted per owner before the join."""
    per_owner = contract.groupBy("owner_id").agg(F.count(F.lit(1)).alias("n"))
    profiles = user.groupBy(F.col("crm_user_id").alias("owner_id")).agg(
        F.min("profile_name").alias("profile_name")
    )
    return (
        per_owner.join(profiles, "owner_id", "left")
        .groupBy("profile_name")
        .agg(F.sum("n").alias("n_contracts"))
    )


def fill_rate(df: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    """One row per field: rows filled, rows, share; one pass for all fields."""
    filled = [
        F.struct(F.lit(name).alias("field"), F.count_if(test).alias("n_filled"))
        for name, test in fields.items()
    ]
    return (
        df.agg(F.array(*filled).alias("_f"), F.count(F.lit(1)).alias("n_rows"))
        .select("n_rows", F.inline("_f"))
        .select("field", "n_filled", "n_rows", _share("n_filled", "n_rows").alias("fill_rate"))
    )


def invalid_dates(df: DataFrame, column: str) -> DataFrame:
    """Rows whose date lies outside the accepted years, per year."""
    c = F.col(column)
    outside = (c < F.lit(dt.date(FIRST_YEAR, 1, 1))) | (c >= F.lit(dt.date(LAST_YEAR + 1, 1, 1)))
    return (
        df.filter(outside)
        .groupBy(F.year(c).cast("bigint").alias("year"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def duplicate_orders_across_systems(
    orders: DataFrame, lines: DataFrame, tolerance: int = 1
) -> DataFrame:
    """(contract_id, order_date) with orders of both ERPs whose amounts differ by
    less than ``tolerance``.

    No pairs are formed.  Amounts fall into buckets as wide as the tolerance; only
    the lowest and highest amount per system and bucket are kept, map-side too.
    Two amounts in one bucket are close enough; otherwise the closest pair is the
    highest of one bucket and the lowest of the next.
    """
    group = ["contract_id", "order_date"]
    a, b = F.col("source_system") == "erp_a", F.col("source_system") == "erp_b"
    amount = F.col("amount")
    dated = orders.filter(F.col("contract_id").isNotNull() & F.col("order_date").isNotNull())
    paid = with_activity(dated.select("source_system", "source_order_id", *group), lines)
    priced = (
        paid.withColumn("amount", fn.as_double(paid, "amount"))
        .filter(amount.isNotNull())
        .withColumn("bucket", F.floor(amount / tolerance).cast("bigint"))
    )
    buckets = priced.groupBy(*group, "bucket").agg(
        F.min(F.when(a, amount)).alias("low_a"),
        F.max(F.when(a, amount)).alias("high_a"),
        F.min(F.when(b, amount)).alias("low_b"),
        F.max(F.when(b, amount)).alias("high_b"),
    )
    # every bucket is seen once as itself and once as the one below the next
    here = F.struct(F.lit(0).alias("step"), "low_a", "high_a", "low_b", "high_b")
    below = F.struct(F.lit(1).alias("step"), "low_a", "high_a", "low_b", "high_b")
    seen = buckets.select(*group, "bucket", F.inline(F.array(here, below)))
    is_here = F.col("step") == 0
    neighbours = seen.groupBy(*group, (F.col("bucket") + F.col("step")).alias("bucket")).agg(
        F.min(F.when(is_here, F.col("low_a"))).alias("low_a"),
        F.min(F.when(is_here, F.col("low_b"))).alias("low_b"),
        F.max(F.when(~is_here, F.col("high_a"))).alias("below_a"),
        F.max(F.when(~is_here, F.col("high_b"))).alias("below_b"),
    )
    close = (
        (F.col("low_a").isNotNull() & F.col("low_b").isNotNull())
        | (F.col("low_a") - F.col("below_b") < tolerance)
        | (F.col("low_b") - F.col("below_a") < tolerance)
    )
    return neighbours.filter(close).select(*group).distinct()


def delivered_sales(
    schools: DataFrame, orders: DataFrame, unified: DataFrame, lines: BySystem, drops: BySystem
) -> DataFrame:
    """Confirmed sales per school and month of the last 12 months of data.

    An order counts as delivered if at least one of its deliveries is; deciding
    that per order keeps several deliveries from multiplying the line totals.
    The window ends at the latest order date in the data, not today.  ``unified`` are the orders
    before any link.
    """
    key = ["source_system", "source_order_id"]
    since = orders.agg(F.add_months(F.max("order_date"), -12).alias("since")).scalar()
    recent = ~F.col("is_cancelled") & (F.col("order_date") >= since)
    confirmed = orders.filter(recent & F.col("school_id").isNotNull())
    # lines and deliveries of other orders are left out before they are shuffled
    wanted = unified.filter(recent)
    lines, drops = facts_of(lines, wanted), facts_of(drops, wanted)
    status = F.coalesce("delivery_status_normalized", "status")
    facts = {
        system: [
            lines_per_order(lines[system]).withColumn("has_lines", F.lit(True)),
            df.filter(status == "delivered")
            .groupBy("order_key", "delivery_key")
            .agg(F.count(F.lit(1)))
            .groupBy("order_key")
            .agg(F.count(F.lit(1)).alias("drops")),
        ]
        for system, df in drops.items()
    }
    per_order = with_activity(
        confirmed.select(*key, "school_id", fn.month_of("order_date").alias("year_month")),
        activity_per_order(facts),
    ).filter("has_lines")
    # an order that occurs more than once is one order with the same deliveries
    per_order = per_order.groupBy("school_id", "year_month", *key).agg(
        fn.merged("amount").alias("amount"), F.max("drops").alias("drops")
    )
    names = schools.select("school_id", F.col("name").alias("school_name"))
    return (
        per_order.groupBy("school_id", "year_month")
        .agg(
            fn.merged("amount").alias("ordered"),
            fn.merged(F.when(F.col("drops") > 0, F.col("amount"))).alias("delivered"),
            F.count(F.lit(1)).alias("order_count"),
            F.coalesce(F.sum("drops"), F.lit(0)).alias("delivered_order_count"),
        )
        .transform(fn.with_rounded, "ordered", "delivered")
        .join(names, "school_id")
        .select(
            "school_id",
            "school_name",
            "year_month",
            F.col("ordered").alias("ordered_amount"),
            F.coalesce("delivered", F.lit(0.0)).alias("delivered_amount"),
            "order_count",
            "delivered_order_count",
        )
    )


def manager_sales(
    managers: DataFrame, contracts: DataFrame, orders: DataFrame, lines: DataFrame, year: DataFrame
) -> DataFrame:
    """Confirmed sales of the reference year under active contracts, per manager."""
    key = ["source_system", "source_order_id"]
    ref = year.scalar()
    active = contracts.filter(~F.col("is_cancelled")).select("contract_id").distinct()
    confirmed = orders.filter(
        ~F.col("is_cancelled")
        & F.col("account_manager_id").isNotNull()
        & fn.in_year("order_date", ref)
    )
    sold = with_activity(
        confirmed.select(*key, "contract_id", "school_id", "account_manager_id"),
        lines.withColumn("has_lines", F.lit(True)),
    ).filter("has_lines")
    sold = sold.join(active, "contract_id", "left_semi").withColumn("sold", F.lit(True))
    per_manager = owner_totals(sold, "account_manager_id", ["amount"]).select(
        "account_manager_id",
        fn.rounded("amount").alias("ytd_ordered_amount"),
        F.col("schools").alias("school_count"),
        F.col("orders").alias("order_count"),
    )
    return per_manager.join(managers, "account_manager_id").select(
        "account_manager_id",
        F.col("name").alias("am_name"),
        ref.alias("year"),
        "ytd_ordered_amount",
        "school_count",
        "order_count",
    )


def both_system_groups(orders: DataFrame) -> DataFrame:
    """(contract_id, order_date) with orders of both ERPs: where duplicates can be."""
    dated = orders.filter(F.col("contract_id").isNotNull() & F.col("order_date").isNotNull())
    systems = dated.groupBy("contract_id", "order_date").agg(
        F.min("source_system").alias("low"), F.max("source_system").alias("high")
    )
    return systems.filter("low <> high").select("contract_id", "order_date")


def group_checks(checks: Mapping[str, tuple[DataFrame, DataFrame]], sample: int = 5) -> DataFrame:
    """Checks over groups, each given as (all groups, failing groups); one that fails fails it.

    The row names up to ``sample`` failing keys, the lowest ones, columns joined by ``/``.
    """
    out = []
    for name, (groups, failing) in checks.items():
        keys = F.concat_ws("/", *[F.col(c).cast("string") for c in failing.columns])
        lowest = failing.select(keys.alias("key")).orderBy("key").limit(sample)
        failures = failing.agg(F.count(F.lit(1)).alias("n")).scalar()
        named = lowest.agg(F.array_join(F.sort_array(F.collect_list("key")), ", ").alias("s")).scalar()
        counted = groups.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
            "n_passing", F.col("n_rows") - failures
        )
        out.append(
            counted.select(
                F.lit(name).alias("check_name"),
                "n_rows",
                "n_passing",
                _share("n_passing", "n_rows").alias("share"),
                (F.col("n_passing") == F.col("n_rows")).alias("passed"),
                F.when(F.col("n_passing") < F.col("n_rows"), named).alias("failing_keys"),
            )
        )
    return _stack(out)


def coverage(checks: Mapping[str, tuple[DataFrame, Column, float]]) -> DataFrame:
    """Share of rows that pass, against a threshold it has to exceed."""
    out = []
    for name, (df, test, threshold) in checks.items():
        out.append(
            df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(test).alias("n_passing")).select(
                F.lit(name).alias("check_name"),
                "n_rows",
                "n_passing",
                _share("n_passing", "n_rows").alias("share"),
                (_share("n_passing", "n_rows") > threshold).alias("passed"),
            )
        )
    return _stack(out)
