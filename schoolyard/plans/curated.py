"""Curated layer: conformed sources and the seven entities.

Functions take clean DataFrames and other entities and return the entity without
the load stamp, which is added when a table is written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schoolyard import functions as fn
from schoolyard.functions import status as st
from schoolyard.operators import (
    Lookup,
    conform_union,
    directory,
    joined_tags,
    link,
    resolve_entity,
)

# Sources of a school in order of precedence, and their id columns.
SCHOOL_SOURCES = {
    "crm": "crm_account_id",
    "erp_a": "erp_a_customer_code",
    "erp_b": "erp_b_escola_id",
    "support": "support_org_id",
}
SCHOOL_MASTER = "crm"
SYNTHETIC_PREFIX = "NCRM-"

# Who may be an account manager.
MANAGER_PROFILES = ("Account Manager", "CS Manager", "Sales Rep")


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _id(c: str) -> Column:
    return F.col(c).cast("string")


def _valid_tax_id() -> Column:
    return F.length("cnpj") == fn.keys.TAX_ID_DIGITS


# -- school ----------------------------------------------------------------


def _school_row(source_id: str, razao: bool = False, place: bool = True):
    return [
        _id(source_id).alias("source_id"),
        F.col("name"),
        (F.col("razao_social") if razao else _null("string")).alias("razao_social"),
        F.col("cnpj"),
        (F.col("city") if place else _null("string")).alias("city"),
        (F.col("state") if place else _null("string")).alias("state"),
    ]


def school_from_crm(account: DataFrame) -> DataFrame:
    schools = account.filter((F.col("account_type") == "School") & ~F.col("is_deleted"))
    return schools.select(*_school_row("crm_account_id", razao=True))


def school_from_erp_a(customer: DataFrame) -> DataFrame:
    return customer.select(*_school_row("customer_code"))


def school_from_erp_b(escola: DataFrame) -> DataFrame:
    return escola.select(*_school_row("escola_id"))


def school_from_support(organization: DataFrame) -> DataFrame:
    known = organization.filter(F.col("cnpj").isNotNull())
    return known.select(*_school_row("organization_id", place=False))


def schools(records: DataFrame) -> DataFrame:
    """One school per tax id known to any system, CRM values first."""
    resolved = resolve_entity(
        records,
        key="cnpj",
        valid=_valid_tax_id(),
        sources=SCHOOL_SOURCES,
        master=SCHOOL_MASTER,
        prefix=SYNTHETIC_PREFIX,
        entity_id="school_id",
        attributes=("name", "razao_social", "city", "state"),
    )
    return resolved


def school_directory(records: DataFrame) -> DataFrame:
    """(source_system, source_id, cnpj, school_id) for every source record."""
    return directory(
        records,
        key="cnpj",
        valid=_valid_tax_id(),
        master=SCHOOL_MASTER,
        prefix=SYNTHETIC_PREFIX,
        entity_id="school_id",
    )


# -- account manager -------------------------------------------------------


def account_managers(user: DataFrame, contract: DataFrame, account: DataFrame) -> DataFrame:
    """Active users with an eligible profile who own a contract or an account."""
    eligible = user.filter(F.col("profile_name").isin(*MANAGER_PROFILES) & F.col("is_active"))
    owners = (
        contract.filter(~F.col("is_deleted"))
        .select("owner_id")
        .union(account.filter(~F.col("is_deleted")).select("owner_id"))
        .distinct()
    )
    return eligible.join(owners, F.col("crm_user_id") == F.col("owner_id"), "left_semi").select(
        F.col("crm_user_id").alias("account_manager_id"),
        "name",
        "email",
        "profile_name",
        "is_active",
    )


# -- contract --------------------------------------------------------------


def contracts(contract: DataFrame, school_dir: DataFrame, managers: DataFrame) -> DataFrame:
    """Contracts that are not deleted, with their school and eligible manager."""
    crm_schools = school_dir.filter(F.col("source_system") == SCHOOL_MASTER)
    linked = link(
        contract.filter(~F.col("is_deleted")),
        Lookup(
            F.col("crm_account_id"), crm_schools, F.col("source_id"), {"school_id": "school_id"}
        ),
        # the owner is kept as manager only if that manager exists
        Lookup(
            F.col("owner_id"),
            managers,
            F.col("account_manager_id"),
            {"account_manager_id": "account_manager_id"},
        ),
        row_id=["crm_contract_id"],
    )
    return linked.select(
        F.col("crm_contract_id").alias("contract_id"),
        "contract_number",
        "school_id",
        "crm_account_id",
        "account_manager_id",
        F.col("owner_id").alias("owner_crm_user_id"),
        "status",
        "is_cancelled",
        "start_date",
        "end_date",
        "brand",
        "grand_total",
        "total_price",
        "discount",
        "marketing_model",
        "created_at",
        "updated_at",
    )


# -- order -----------------------------------------------------------------


def order_from_erp_a(sales_order: DataFrame) -> DataFrame:
    return sales_order.select(
        _id("doc_entry").alias("source_order_id"),
        _id("doc_num").alias("source_order_num"),
        "contract_number",
        F.col("customer_code").alias("source_customer_id"),
        "order_date",
        "due_date",
        "status",
        "is_cancelled",
        _id("salesperson_code").alias("salesperson_code"),
        F.col("created_date").alias("created_at"),
        F.col("updated_date").alias("updated_at"),
    )


def order_from_erp_b(pedido: DataFrame) -> DataFrame:
    return pedido.select(
        _id("pedido_id").alias("source_order_id"),
        _id("pedido_id").alias("source_order_num"),
        "contract_number",
        _id("escola_id").alias("source_customer_id"),
        "order_date",
        F.col("expected_delivery_date").alias("due_date"),
        "status",
        "is_cancelled",
        _id("vendedor_id").alias("salesperson_code"),
        F.to_date("created_at").alias("created_at"),
        F.to_date("updated_at").alias("updated_at"),
    )


def orders_unified(sales_order: DataFrame, pedido: DataFrame) -> DataFrame:
    return conform_union(
        {"erp_a": order_from_erp_a(sales_order), "erp_b": order_from_erp_b(pedido)}
    )


def link_orders(unified: DataFrame, contract: DataFrame, school_dir: DataFrame) -> DataFrame:
    """Orders with contract, manager and school.

    The contract's school comes first, then the school of the ordering customer.
    One lookup serves both ERPs: a customer id is looked up within its system.
    """
    return link(
        unified,
        Lookup(
            F.col("contract_number"),
            contract,
            F.col("contract_number"),
            {
                "contract_id": "contract_id",
                "account_manager_id": "account_manager_id",
                "_contract_school": "school_id",
            },
        ),
        Lookup(
            fn.scoped("source_system", "source_customer_id"),
            school_dir,
            fn.scoped("source_system", "source_id"),
            {"_customer_school": "school_id"},
        ),
        row_id=["source_system", "source_order_id"],
    ).withColumn("school_id", F.coalesce("_contract_school", "_customer_school"))


def orders(unified: DataFrame, contract: DataFrame, school_dir: DataFrame) -> DataFrame:
    return link_orders(unified, contract, school_dir).select(
        fn.surrogate_key("source_system", "source_order_id").alias("order_id"),
        "source_order_id",
        "source_order_num",
        "source_system",
        "contract_number",
        "contract_id",
        "school_id",
        "account_manager_id",
        "order_date",
        "due_date",
        "status",
        "is_cancelled",
        "salesperson_code",
        "created_at",
        "updated_at",
    )


def order_keys(unified: DataFrame) -> DataFrame:
    """Existing orders with their surrogate key; ids depend on the source key only."""
    return unified.select(
        "source_system",
        "source_order_id",
        fn.surrogate_key("source_system", "source_order_id").alias("order_id"),
    )


def _with_order_id(
    df: DataFrame, system: Column, keys: DataFrame, row_id: Sequence[str]
) -> DataFrame:
    """The order's surrogate key, if the order exists."""
    return link(
        df,
        Lookup(
            fn.scoped(system, "source_order_id"),
            keys,
            fn.scoped("source_system", "source_order_id"),
            {"order_id": "order_id"},
        ),
        row_id=row_id,
    )


# -- order item ------------------------------------------------------------


def order_item_from_erp_a(item: DataFrame) -> DataFrame:
    return item.select(
        _id("doc_entry").alias("source_order_id"),
        _id("line_num").alias("source_line_id"),
        "sku",
        "description",
        "quantity",
        "delivered_quantity",
        "unit_price",
        "line_total",
    )


def order_item_from_erp_b(item: DataFrame) -> DataFrame:
    return item.select(
        _id("pedido_id").alias("source_order_id"),
        _id("item_id").alias("source_line_id"),
        "sku",
        "description",
        F.col("quantity").cast("double").alias("quantity"),
        _null("double").alias("delivered_quantity"),
        "unit_price",
        "line_total",
    )


def order_items_unified(item_a: DataFrame, item_b: DataFrame) -> DataFrame:
    return conform_union(
        {"erp_a": order_item_from_erp_a(item_a), "erp_b": order_item_from_erp_b(item_b)}
    )


def order_items(unified: DataFrame, keys: DataFrame) -> DataFrame:
    row_id = ["source_system", "source_line_id"]
    return _with_order_id(unified, F.col("source_system"), keys, row_id).select(
        fn.surrogate_key("source_system", "source_order_id", "source_line_id").alias(
            "order_item_id"
        ),
        "order_id",
        "source_order_id",
        "source_line_id",
        "source_system",
        "sku",
        "description",
        "quantity",
        "delivered_quantity",
        "unit_price",
        "line_total",
    )


def order_lines(item_a: DataFrame, item_b: DataFrame) -> dict[str, DataFrame]:
    """Amounts of each ERP's lines by its own order number, for summing up."""
    columns = ["line_total", "quantity"]
    return {
        "erp_a": item_a.select(F.col("doc_entry").alias("order_key"), *columns),
        "erp_b": item_b.select(F.col("pedido_id").alias("order_key"), *columns),
    }


# -- delivery --------------------------------------------------------------


def _delivery_facts_erp_a() -> list[Column]:
    return [
        F.col("delivery_date"),
        F.col("status"),
        F.col("is_cancelled"),
        _null("bigint").alias("quantity_delivered"),
        _null("string").alias("delivery_status_normalized"),
    ]


def _delivery_facts_fin() -> list[Column]:
    return [
        F.coalesce("actual_delivery_date", "emissao_date").alias("delivery_date"),
        F.col("delivery_status").alias("status"),
        F.col("delivery_status").isin(*st.FIN_CANCELLED).alias("is_cancelled"),
        F.col("quantity_delivered"),
        F.col("delivery_status_normalized"),
    ]


def delivery_from_erp_a(delivery: DataFrame) -> DataFrame:
    return delivery.select(
        _id("doc_entry").alias("source_delivery_id"),
        _id("base_order_entry").alias("source_order_id"),
        F.col("customer_code").alias("source_customer_id"),
        *_delivery_facts_erp_a(),
    )


def delivery_from_fin(note: DataFrame) -> DataFrame:
    return note.select(
        _id("nota_fiscal_id").alias("source_delivery_id"),
        _id("pedido_id").alias("source_order_id"),
        F.col("cnpj_cliente").alias("source_customer_id"),
        *_delivery_facts_fin(),
    )


def deliveries_unified(delivery: DataFrame, note: DataFrame) -> DataFrame:
    """Deliveries of both mechanisms with a plausible date."""
    both = conform_union({"erp_a": delivery_from_erp_a(delivery), "fin": delivery_from_fin(note)})
    return both.filter(fn.valid_year("delivery_date"))


def order_drops(delivery: DataFrame, note: DataFrame) -> dict[str, DataFrame]:
    """Plausibly dated deliveries of each ERP's orders by its own order number."""
    by_system = {
        "erp_a": delivery.select(
            F.col("base_order_entry").alias("order_key"),
            F.col("doc_entry").alias("delivery_key"),
            *_delivery_facts_erp_a(),
        ),
        "erp_b": note.select(
            F.col("pedido_id").alias("order_key"),
            F.col("nota_fiscal_id").alias("delivery_key"),
            *_delivery_facts_fin(),
        ),
    }
    return {s: df.filter(fn.valid_year("delivery_date")) for s, df in by_system.items()}


def order_system_of_delivery() -> Column:
    """Finance notes belong to ERP B orders."""
    return F.when(F.col("source_system") == "erp_a", "erp_a").when(
        F.col("source_system") == "fin", "erp_b"
    )


def deliveries(unified: DataFrame, keys: DataFrame) -> DataFrame:
    row_id = ["source_system", "source_delivery_id"]
    return _with_order_id(unified, order_system_of_delivery(), keys, row_id).select(
        fn.surrogate_key("source_system", "source_delivery_id").alias("delivery_id"),
        "source_delivery_id",
        "source_order_id",
        "source_system",
        "order_id",
        "delivery_date",
        "status",
        "is_cancelled",
        "quantity_delivered",
        "delivery_status_normalized",
    )


# -- ticket ----------------------------------------------------------------


def organization_schools(school_dir: DataFrame) -> DataFrame:
    """(organization_id, school_id) of the organisations with a valid tax id."""
    return school_dir.filter(F.col("source_system") == "support").select(
        F.col("source_id").cast("bigint").alias("organization_id"), "school_id"
    )


def tickets(
    ticket: DataFrame, tag: DataFrame, org_schools: DataFrame, keys: DataFrame
) -> DataFrame:
    """Tickets with school, ERP B order, sorted tags and whole hours to resolve."""
    linked = link(
        ticket,
        Lookup(
            F.col("organization_id"),
            org_schools,
            F.col("organization_id"),
            {"school_id": "school_id"},
        ),
        Lookup(
            F.col("order_ref"),
            keys.filter(F.col("source_system") == "erp_b"),
            F.col("source_order_id"),
            {"order_id": "order_id"},
        ),
        Lookup(
            F.col("ticket_id"),
            joined_tags(tag, "ticket_id", "tag", "tags"),
            F.col("ticket_id"),
            {"tags": "tags"},
            unique=True,
        ),
        row_id=["ticket_id"],
    )
    return linked.select(
        "ticket_id",
        "subject",
        "status",
        "priority",
        "requester_id",
        "assignee_id",
        "organization_id",
        "order_ref",
        "cnpj_cliente",
        "school_id",
        "order_id",
        "tags",
        "created_at",
        "updated_at",
        "solved_at",
        fn.elapsed_hours("created_at", "solved_at").alias("resolution_hours"),
    )


def school_records(clean: Mapping[str, DataFrame]) -> DataFrame:
    return conform_union(
        {
            "crm": school_from_crm(clean["crm_account"]),
            "erp_a": school_from_erp_a(clean["erp_a_customer"]),
            "erp_b": school_from_erp_b(clean["erp_b_escola"]),
            "support": school_from_support(clean["support_organization"]),
        }
    )
