"""Reports that the modelled project plans for later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from schoolyard import functions as fn
from schoolyard.functions import status as st
from schoolyard.operators import Lookup, as_of, link
from schoolyard.plans.report import ORDER_KEY, activity_per_order, lines_per_order, with_activity


def _per_order(orders: DataFrame, lines: DataFrame, *columns: str) -> DataFrame:
    """Orders that are not cancelled with the sum of their lines; a repeated order is one."""
    confirmed = orders.filter(~F.col("is_cancelled")).select(*ORDER_KEY, *columns)
    return (
        with_activity(confirmed, lines)
        .groupBy(*ORDER_KEY, *columns)
        .agg(fn.merged("amount").alias("amount"))
    )


def contract_reconciliation(
    contracts: DataFrame, orders: DataFrame, lines: DataFrame
) -> DataFrame:
    """Every contract's total beside what was ordered under it, without cancelled orders."""
    per_order = _per_order(
        orders.filter(F.col("contract_id").isNotNull()), lines, "contract_id"
    )
    ordered = per_order.groupBy("contract_id").agg(
        F.count(F.lit(1)).alias("orders"), fn.merged("amount").alias("amount")
    )
    found = link(
        contracts.select("contract_id", "contract_number", "school_id", "grand_total"),
        Lookup(
            F.col("contract_id"),
            ordered,
            F.col("contract_id"),
            {"orders": "orders", "amount": "amount"},
            unique=True,
        ),
        row_id=["contract_id"],
    )
    left = found.withColumn("granted", fn.exact("grand_total"))
    left = left.withColumn("open_amount", fn.difference(F.col("granted"), F.col("amount")))
    return fn.with_rounded(left, "amount", "open_amount").select(
        "contract_id",
        "contract_number",
        "school_id",
        "grand_total",
        F.coalesce("orders", F.lit(0)).alias("total_orders"),
        F.coalesce("amount", F.lit(0.0)).alias("ordered_amount"),
        "open_amount",
    )


def network_rollup(accounts: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders of the schools of a network, added up for its parent account.

    Schools are summed up before they meet their network, so a large network is many rows of
    schools and not of orders.
    """
    per_order = _per_order(orders.filter(F.col("school_id").isNotNull()), lines, "school_id")
    per_school = per_order.groupBy("school_id").agg(
        F.count(F.lit(1)).alias("orders"), fn.merged("amount").alias("amount")
    )
    members = accounts.filter(~F.col("is_deleted") & F.col("parent_account_id").isNotNull())
    with_orders = link(
        members.select("crm_account_id", "parent_account_id"),
        Lookup(
            F.col("crm_account_id"),
            per_school,
            F.col("school_id"),
            {"orders": "orders", "amount": "amount"},
            unique=True,
        ),
        row_id=["crm_account_id"],
    )
    networks = with_orders.groupBy("parent_account_id").agg(
        F.count(F.lit(1)).alias("members"),
        F.count("orders").alias("ordering_members"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
        fn.merged("amount").alias("amount"),
    )
    networks = fn.with_rounded(networks, "amount").withColumn(
        "ordered_amount", F.coalesce("amount", F.lit(0.0))
    )
    named = link(
        networks,
        Lookup(
            F.col("parent_account_id"),
            accounts,
            F.col("crm_account_id"),
            {"network_name": "name"},
        ),
        row_id=["parent_account_id"],
    )
    return named.select(
        F.col("parent_account_id").alias("network_id"),
        "network_name",
        "members",
        "ordering_members",
        "total_orders",
        "ordered_amount",
    )


def manager_brands(
    contracts: DataFrame, orders: DataFrame, lines: DataFrame, year: DataFrame
) -> DataFrame:
    """The reference year of each manager by the brand of the contract."""
    ref = year.scalar()
    brands = contracts.select("contract_id", "brand")
    signed = (
        contracts.filter(
            ~F.col("is_cancelled")
            & fn.in_year("start_date", ref)
            & F.col("account_manager_id").isNotNull()
        )
        .groupBy("account_manager_id", "brand")
        .agg(
            F.count(F.lit(1)).alias("total_contracts"),
            fn.exact_total("grand_total").alias("signed"),
        )
    )
    sold = orders.filter(
        F.col("account_manager_id").isNotNull() & fn.in_year("order_date", ref)
    )
    per_order = _per_order(sold, lines, "account_manager_id", "contract_id")
    branded = link(
        per_order,
        Lookup(F.col("contract_id"), brands, F.col("contract_id"), {"brand": "brand"}),
        row_id=ORDER_KEY,
    )
    ordered = branded.groupBy("account_manager_id", "brand").agg(
        F.count(F.lit(1)).alias("total_orders"), fn.merged("amount").alias("amount")
    )
    # what was signed and what was ordered, one below the other and added up
    both = signed.unionByName(ordered, allowMissingColumns=True)
    added = both.groupBy("account_manager_id", "brand").agg(
        F.coalesce(F.sum("total_contracts"), F.lit(0)).alias("total_contracts"),
        fn.merged("signed").alias("signed"),
        F.coalesce(F.sum("total_orders"), F.lit(0)).alias("total_orders"),
        fn.merged("amount").alias("amount"),
    )
    return fn.with_rounded(added, "signed", "amount").select(
        "account_manager_id",
        "brand",
        "total_contracts",
        F.coalesce("signed", F.lit(0.0)).alias("contracted_amount"),
        "total_orders",
        F.coalesce("amount", F.lit(0.0)).alias("ordered_amount"),
    )


def _share(delivered: Column, ordered: Column) -> Column:
    """What part of a quantity was delivered, between 0 and 1."""
    part = F.coalesce(delivered.cast("double"), F.lit(0.0)) / ordered.cast("double")
    return F.when(ordered > 0, F.least(part, F.lit(1.0))).otherwise(0.0)


def proportional_delivery(
    orders: DataFrame, item_a: DataFrame, item_b: DataFrame, note: DataFrame
) -> DataFrame:
    """Ordered and proportionally delivered amounts per school.

    ERP A tells the delivered quantity of every line. ERP B does not: an order counts with the
    share of its quantity that its finance notes deliver, without cancelled notes.
    """
    delivered = F.col("line_total") * _share(F.col("delivered_quantity"), F.col("quantity"))
    lines_a = item_a.groupBy(F.col("doc_entry").alias("order_key")).agg(
        fn.exact_total("line_total").alias("amount"), fn.exact_total(delivered).alias("delivered")
    )
    lines_b = lines_per_order(
        item_b.select(F.col("pedido_id").alias("order_key"), "line_total", "quantity")
    )
    notes = (
        note.filter(~F.coalesce(F.col("delivery_status").isin(*st.FIN_CANCELLED), F.lit(False)))
        .groupBy(F.col("pedido_id").alias("order_key"))
        .agg(F.sum("quantity_delivered").alias("noted"))
    )
    noted = lines_b.join(notes, "order_key", "left").withColumn("sum", F.col("amount"))
    noted = fn.with_rounded(noted, "sum", "quantity").withColumn(
        "part", F.col("sum") * _share(F.col("noted"), F.col("quantity"))
    )
    lines_b = noted.select("order_key", "amount", fn.exact("part").alias("delivered"))
    activity = activity_per_order({"erp_a": [lines_a], "erp_b": [lines_b]})
    sold = orders.filter(~F.col("is_cancelled") & F.col("school_id").isNotNull())
    per_order = (
        with_activity(sold.select(*ORDER_KEY, "school_id"), activity)
        .groupBy(*ORDER_KEY, "school_id")
        .agg(fn.merged("amount").alias("amount"), fn.merged("delivered").alias("delivered"))
    )
    per_school = per_order.groupBy("school_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        fn.merged("amount").alias("amount"),
        fn.merged("delivered").alias("delivered"),
    )
    return fn.with_rounded(per_school, "amount", "delivered").select(
        "school_id",
        "total_orders",
        F.coalesce("amount", F.lit(0.0)).alias("ordered_amount"),
        F.coalesce("delivered", F.lit(0.0)).alias("delivered_amount"),
    )


def manager_timeline(contracts: DataFrame) -> DataFrame:
    """Versions of the manager of each school, from the starts of its contracts.

    A version begins with the contract that changes the manager (no manager is a value too) and
    ends when the next one begins; the last is open. Contracts that start on the same day
    follow each other by id. A task sorts the contracts of one school.
    """
    dated = contracts.filter(F.col("school_id").isNotNull() & F.col("start_date").isNotNull())
    by_start = Window.partitionBy("school_id").orderBy("start_date", "contract_id")
    manager = F.col("account_manager_id")
    seen = dated.select(
        "school_id",
        "account_manager_id",
        "start_date",
        "contract_id",
        F.row_number().over(by_start).alias("nth"),
        F.lag(manager).over(by_start).alias("before"),
    )
    begun = seen.filter((F.col("nth") == 1) | ~manager.eqNullSafe(F.col("before")))
    until = F.lead("start_date").over(by_start)
    return begun.select(
        "school_id",
        F.row_number().over(by_start).alias("version"),
        "account_manager_id",
        F.col("start_date").alias("valid_from"),
        until.alias("valid_to"),
        until.isNull().alias("is_current"),
    )


def manager_at_date(orders: DataFrame, timeline: DataFrame) -> DataFrame:
    """Every order with the manager and brand its school had on the day, beside its contract's."""
    dated = orders.select(
        "order_id", "school_id", "order_date", F.col("account_manager_id").alias("contract_manager_id")
    )
    return as_of(
        dated, "school_id", "order_date", timeline, ["account_manager_id", "brand"], row_id=["order_id"]
    )
