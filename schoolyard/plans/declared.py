"""The 130 declared checks and the thresholds, as data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schoolyard.operators import Check
from schoolyard.plans import curated, profile
from schoolyard.plans.workspace import Workspace
from schoolyard.sources.names import clean_name, curated_name, report_name, staging_name

# Accepted vocabularies.
ACCOUNT_TYPES = ("School", "Network")
PROFILES = ("Account Manager", "CS Manager", "Admin", "Sales Rep")
ERP_A_STATUS = ("open", "closed", "cancelled")
ERP_B_STATUS = ("in_progress", "delivered", "cancelled")
DELIVERY_STATUS = ("delivered", "in_transit", "lost", "returned", "awaiting_pickup")
TICKET_STATUS = ("new", "open", "pending", "hold", "solved", "closed")
TICKET_PRIORITY = ("low", "normal", "high", "urgent")
ORDER_SOURCES = ("erp_a", "erp_b")
DELIVERY_SOURCES = ("erp_a", "fin")

U, N, UN = ("unique",), ("not_null",), ("unique", "not_null")

# Table -> column -> checks.  A tuple of words after the check names
# is the accepted vocabulary; a pair of names is the parent table and column.
_KEYED = {
    "crm_account": {"crm_account_id": UN, "cnpj": N, "is_deleted": N},
    "crm_user": {"crm_user_id": UN, "email": N},
    "crm_product": {"crm_product_id": UN},
    "crm_service_contract": {
        "crm_contract_id": UN,
        "contract_number": N,
        "crm_account_id": N,
        "is_cancelled": N,
    },
    "crm_contract_line_item": {"crm_line_item_id": UN, "crm_contract_id": N},
    "erp_a_customer": {"customer_code": UN, "cnpj": N},
    "erp_a_salesperson": {"salesperson_code": UN, "is_active": N},
    "erp_a_sales_order": {"doc_entry": UN, "is_cancelled": N},
    "erp_a_sales_order_item": {"doc_entry": N, "line_num": N},
    "erp_a_delivery": {"doc_entry": UN, "is_cancelled": N},
    "erp_a_invoice": {"doc_entry": UN, "is_cancelled": N},
    "erp_b_escola": {"escola_id": UN, "cnpj": N},
    "erp_b_vendedor": {"vendedor_id": UN, "is_active": N},
    "erp_b_pedido": {"pedido_id": UN, "escola_id": N, "is_cancelled": N},
    "erp_b_item_pedido": {"item_id": UN, "pedido_id": N},
    "fin_nota_fiscal": {"nota_fiscal_id": UN, "pedido_id": N, "cnpj_cliente": N},
    "support_organization": {"organization_id": UN},
    "support_user": {"support_user_id": UN, "email": N},
    "support_ticket": {"ticket_id": UN},
    "support_ticket_tag": {"ticket_id": N, "tag": N},
    "account_manager": {"account_manager_id": UN, "email": UN, "is_active": N},
    "contract": {"contract_id": UN, "contract_number": UN, "is_cancelled": N},
    "delivery": {"delivery_id": UN, "source_system": N, "is_cancelled": N},
    "delivery/erp_a": {"source_delivery_id": UN},
    "delivery/fin": {"source_delivery_id": UN},
    "order": {"order_id": UN, "source_system": N, "source_order_id": N, "is_cancelled": N},
    "order/erp_a": {"source_order_id": UN},
    "order/erp_b": {"source_order_id": UN},
    "order_item": {"order_item_id": UN, "order_id": N, "unit_price": N},
    "order_item/erp_a": {"source_order_id": N},
    "order_item/erp_b": {"source_order_id": N},
    "school": {"school_id": UN, "cnpj": UN},
    "school/crm": {"source_id": UN, "cnpj": N},
    "school/erp_a": {"source_id": UN},
    "school/erp_b": {"source_id": UN},
    "school/support": {"source_id": UN, "cnpj": N},
    "ticket": {"ticket_id": UN, "created_at": N},
    "monthly": {"school_id": N, "month": N, "total_orders": N, "ordered_amount": N},
    "ytd": {"account_manager_id": UN, "year": N, "total_contracts": N},
}

_VOCABULARIES = {
    ("crm_account", "account_type"): ACCOUNT_TYPES,
    ("crm_user", "profile_name"): PROFILES,
    ("erp_a_sales_order", "status"): ERP_A_STATUS,
    ("erp_b_pedido", "status"): ERP_B_STATUS,
    ("fin_nota_fiscal", "delivery_status_normalized"): DELIVERY_STATUS,
    ("support_ticket", "status"): TICKET_STATUS,
    ("support_ticket", "priority"): TICKET_PRIORITY,
    ("ticket", "status"): TICKET_STATUS,
    ("order", "source_system"): ORDER_SOURCES,
    ("delivery", "source_system"): DELIVERY_SOURCES,
}

_PARENTS = {
    ("contract", "account_manager_id"): ("account_manager", "account_manager_id"),
    ("order_item", "order_id"): ("order", "order_id"),
}

CHECKS: tuple[Check, ...] = (
    *(
        Check(table, column, kind)
        for table, columns in _KEYED.items()
        for column, kinds in columns.items()
        for kind in kinds
    ),
    *(Check(t, c, "accepted_values", values=v) for (t, c), v in _VOCABULARIES.items()),
    *(
        Check(t, c, "relationships", parent=p, parent_column=pc)
        for (t, c), (p, pc) in _PARENTS.items()
    ),
)


def checks_of(kind: str) -> list[Check]:
    return [c for c in CHECKS if c.kind == kind]


def table_of(ws: Workspace) -> Callable[[str], DataFrame]:
    """Short table names, as used in the checks, to DataFrames."""
    clean = ws.clean
    stagings = {
        "school/crm": lambda: curated.school_from_crm(clean["crm_account"]),
        "school/erp_a": lambda: curated.school_from_erp_a(clean["erp_a_customer"]),
        "school/erp_b": lambda: curated.school_from_erp_b(clean["erp_b_escola"]),
        "school/support": lambda: curated.school_from_support(clean["support_organization"]),
        "order/erp_a": lambda: curated.order_from_erp_a(clean["erp_a_sales_order"]),
        "order/erp_b": lambda: curated.order_from_erp_b(clean["erp_b_pedido"]),
        "order_item/erp_a": lambda: curated.order_item_from_erp_a(
            clean["erp_a_sales_order_item"]
        ),
        "order_item/erp_b": lambda: curated.order_item_from_erp_b(clean["erp_b_item_pedido"]),
        "delivery/erp_a": lambda: curated.delivery_from_erp_a(clean["erp_a_delivery"]),
        "delivery/fin": lambda: curated.delivery_from_fin(clean["fin_nota_fiscal"]),
    }
    entities = {
        "school": lambda: ws.schools,
        "account_manager": lambda: ws.account_managers,
        "contract": lambda: ws.contracts,
        "order": lambda: ws.orders,
        "order_item": lambda: ws.order_items,
        "delivery": lambda: ws.deliveries,
        "ticket": lambda: ws.tickets,
        "monthly": lambda: ws.monthly_metrics(),
        "ytd": lambda: ws.ytd_portfolio,
    }
    named = stagings | entities

    def table(name: str) -> DataFrame:
        return named[name]() if name in named else clean[name]

    return table


def full_name(short: str) -> str:
    """The written name of a table, for reports on checks."""
    if "/" in short:
        return staging_name(*short.split("/"))
    if short in ("monthly", "ytd"):
        return report_name(short)
    try:
        return clean_name(short)
    except KeyError:
        return curated_name(short)


def duplicate_checks(ws: Workspace) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Groups in which the ERPs may repeat an order, and those where amounts are that close."""
    groups = profile.both_system_groups(ws.orders)

    def close(tolerance: int) -> DataFrame:
        return profile.duplicate_orders_across_systems(ws.orders, ws.line_activity, tolerance)

    return {
        "no_cross_erp_duplicate_order": (groups, close(1)),
        "no_cross_erp_similar_order": (groups, close(100_000)),
    }


def thresholds(ws: Workspace) -> dict[str, tuple[DataFrame, Column, float]]:
    """Coverage checks: rows, what a row has to satisfy, share to exceed."""
    return {
        "order_contract_coverage": (ws.orders, F.col("contract_id").isNotNull(), 0.70),
        "school_cross_system_match": (
            ws.schools,
            F.col("erp_a_customer_code").isNotNull() | F.col("erp_b_escola_id").isNotNull(),
            0.60,
        ),
    }
