"""The declared checks, written out by kind; the statements do not read the library's own list."""

from __future__ import annotations

# Columns whose values occur once.
UNIQUE = {
    "crm_account": ["crm_account_id"],
    "crm_user": ["crm_user_id"],
    "crm_product": ["crm_product_id"],
    "crm_service_contract": ["crm_contract_id"],
    "crm_contract_line_item": ["crm_line_item_id"],
    "erp_a_customer": ["customer_code"],
    "erp_a_salesperson": ["salesperson_code"],
    "erp_a_sales_order": ["doc_entry"],
    "erp_a_delivery": ["doc_entry"],
    "erp_a_invoice": ["doc_entry"],
    "erp_b_escola": ["escola_id"],
    "erp_b_vendedor": ["vendedor_id"],
    "erp_b_pedido": ["pedido_id"],
    "erp_b_item_pedido": ["item_id"],
    "fin_nota_fiscal": ["nota_fiscal_id"],
    "support_organization": ["organization_id"],
    "support_user": ["support_user_id"],
    "support_ticket": ["ticket_id"],
    "account_manager": ["account_manager_id", "email"],
    "contract": ["contract_id", "contract_number"],
    "delivery": ["delivery_id"],
    "delivery/erp_a": ["source_delivery_id"],
    "delivery/fin": ["source_delivery_id"],
    "order": ["order_id"],
    "order/erp_a": ["source_order_id"],
    "order/erp_b": ["source_order_id"],
    "order_item": ["order_item_id"],
    "school": ["school_id", "cnpj"],
    "school/crm": ["source_id"],
    "school/erp_a": ["source_id"],
    "school/erp_b": ["source_id"],
    "school/support": ["source_id"],
    "ticket": ["ticket_id"],
    "ytd": ["account_manager_id"],
}

# Columns without NULLs.
NOT_NULL = {
    "crm_account": ["crm_account_id", "cnpj", "is_deleted"],
    "crm_user": ["crm_user_id", "email"],
    "crm_product": ["crm_product_id"],
    "crm_service_contract": ["crm_contract_id", "contract_number", "crm_account_id", "is_cancelled"],
    "crm_contract_line_item": ["crm_line_item_id", "crm_contract_id"],
    "erp_a_customer": ["customer_code", "cnpj"],
    "erp_a_salesperson": ["salesperson_code", "is_active"],
    "erp_a_sales_order": ["doc_entry", "is_cancelled"],
    "erp_a_sales_order_item": ["doc_entry", "line_num"],
    "erp_a_delivery": ["doc_entry", "is_cancelled"],
    "erp_a_invoice": ["doc_entry", "is_cancelled"],
    "erp_b_escola": ["escola_id", "cnpj"],
    "erp_b_vendedor": ["vendedor_id", "is_active"],
    "erp_b_pedido": ["pedido_id", "escola_id", "is_cancelled"],
    "erp_b_item_pedido": ["item_id", "pedido_id"],
    "fin_nota_fiscal": ["nota_fiscal_id", "pedido_id", "cnpj_cliente"],
    "support_organization": ["organization_id"],
    "support_user": ["support_user_id", "email"],
    "support_ticket": ["ticket_id"],
    "support_ticket_tag": ["ticket_id", "tag"],
    "account_manager": ["account_manager_id", "email", "is_active"],
    "contract": ["contract_id", "contract_number", "is_cancelled"],
    "delivery": ["delivery_id", "source_system", "is_cancelled"],
    "delivery/erp_a": ["source_delivery_id"],
    "delivery/fin": ["source_delivery_id"],
    "order": ["order_id", "source_system", "source_order_id", "is_cancelled"],
    "order/erp_a": ["source_order_id"],
    "order/erp_b": ["source_order_id"],
    "order_item": ["order_item_id", "order_id", "unit_price"],
    "order_item/erp_a": ["source_order_id"],
    "order_item/erp_b": ["source_order_id"],
    "school": ["school_id", "cnpj"],
    "school/crm": ["source_id", "cnpj"],
    "school/erp_a": ["source_id"],
    "school/erp_b": ["source_id"],
    "school/support": ["source_id", "cnpj"],
    "ticket": ["ticket_id", "created_at"],
    "monthly": ["school_id", "month", "total_orders", "ordered_amount"],
    "ytd": ["account_manager_id", "year", "total_contracts"],
}

# The words a column may hold.
ACCEPTED = {
    ("crm_account", "account_type"): ["School", "Network"],
    ("crm_user", "profile_name"): ["Account Manager", "CS Manager", "Admin", "Sales Rep"],
    ("erp_a_sales_order", "status"): ["open", "closed", "cancelled"],
    ("erp_b_pedido", "status"): ["in_progress", "delivered", "cancelled"],
    ("fin_nota_fiscal", "delivery_status_normalized"): [
        "delivered",
        "in_transit",
        "lost",
        "returned",
        "awaiting_pickup",
    ],
    ("support_ticket", "status"): ["new", "open", "pending", "hold", "solved", "closed"],
    ("support_ticket", "priority"): ["low", "normal", "high", "urgent"],
    ("ticket", "status"): ["new", "open", "pending", "hold", "solved", "closed"],
    ("order", "source_system"): ["erp_a", "erp_b"],
    ("delivery", "source_system"): ["erp_a", "fin"],
}

# Fixed values: (table, column) -> (parent table, parent column).
PARENTS = {
    ("contract", "account_manager_id"): ("account_manager", "account_manager_id"),
    ("order_item", "order_id"): ("order", "order_id"),
}


def failures(part) -> dict[str, list[tuple[str, str, str]]]:
    """kind -> (table, column, scalar query); ``part`` names a table's sub-query."""
    return {
        "unique": [
            (t, c, f"SELECT count(*) FROM (SELECT {c} FROM {part(t)} WHERE {c} IS NOT NULL "
                   f"GROUP BY {c} HAVING count(*) > 1)")
            for t, columns in UNIQUE.items() for c in columns
        ],
        "not_null": [
            (t, c, f"SELECT count(*) FROM {part(t)} WHERE {c} IS NULL")
            for t, columns in NOT_NULL.items() for c in columns
        ],
        "accepted_values": [
            (t, c, f"SELECT count(DISTINCT {c}) FROM {part(t)} WHERE {c} NOT IN "
                   f"({', '.join(repr(w) for w in words)})")
            for (t, c), words in ACCEPTED.items()
        ],
        "relationships": [
            (t, c, f"SELECT count(*) FROM {part(t)} x WHERE {c} IS NOT NULL AND NOT EXISTS "
                   f"(FROM {part(p)} y WHERE y.{pc} = x.{c})")
            for (t, c), (p, pc) in PARENTS.items()
        ],
    }
