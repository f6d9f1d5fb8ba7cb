"""Names of the written tables: layer__domain__type__entity."""

from __future__ import annotations

# Type and entity of every clean table.
CLEAN_KINDS = {
    "crm_account": ("crm", "current", "account"),
    "crm_product": ("crm", "current", "product"),
    "crm_user": ("crm", "current", "user"),
    "crm_service_contract": ("crm", "event", "service_contract"),
    "crm_contract_line_item": ("crm", "event", "contract_line_item"),
    "erp_a_customer": ("erp_a", "current", "customer"),
    "erp_a_salesperson": ("erp_a", "current", "salesperson"),
    "erp_a_sales_order": ("erp_a", "event", "sales_order"),
    "erp_a_sales_order_item": ("erp_a", "event", "sales_order_item"),
    "erp_a_delivery": ("erp_a", "event", "delivery"),
    "erp_a_invoice": ("erp_a", "event", "invoice"),
    "erp_b_escola": ("erp_b", "current", "escola"),
    "erp_b_vendedor": ("erp_b", "current", "vendedor"),
    "erp_b_pedido": ("erp_b", "event", "pedido"),
    "erp_b_item_pedido": ("erp_b", "event", "item_pedido"),
    "fin_nota_fiscal": ("fin", "event", "nota_fiscal"),
    "support_organization": ("support", "current", "organization"),
    "support_user": ("support", "current", "user"),
    "support_ticket": ("support", "event", "ticket"),
    "support_ticket_tag": ("support", "event", "ticket_tag"),
}

# The one domain of the curated and report layers.
DOMAIN = "school_operations"

CURATED_KINDS = {
    "school": "current",
    "account_manager": "current",
    "contract": "event",
    "order": "event",
    "order_item": "event",
    "delivery": "event",
    "ticket": "event",
}

REPORTS = {
    "monthly": ("monthly", "school_order_metrics"),
    "ytd": ("ytd", "am_portfolio_metrics"),
}


def table_name(layer: str, domain: str, kind: str, entity: str) -> str:
    return "__".join((layer, domain, kind, entity))


def clean_name(table: str) -> str:
    return table_name("clean", *CLEAN_KINDS[table])


def curated_name(entity: str) -> str:
    return table_name("curated", DOMAIN, CURATED_KINDS[entity], entity)


def staging_name(entity: str, source: str) -> str:
    return f"staging__{curated_name(entity)}__{source}"


def report_name(report: str) -> str:
    return table_name("report", DOMAIN, *REPORTS[report])
