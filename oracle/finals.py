"""The final SELECT of every registered query."""

from __future__ import annotations

from oracle.checks import failures
from oracle.entities import NONE, UNIT, double, units


def _all(table: str, dates: str) -> str:
    """Every column, the named ones as text."""
    casts = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in dates.split())
    return f"SELECT * REPLACE ({casts}) FROM {table}" if casts else f"SELECT * FROM {table}"


_CLEAN_DATES = {
    "crm_user": "created_at updated_at",
    "crm_account": "created_at updated_at",
    "crm_product": "created_at",
    "crm_service_contract": "start_date end_date created_at updated_at",
    "crm_contract_line_item": "created_at",
    "erp_a_salesperson": "",
    "erp_a_customer": "created_date updated_date",
    "erp_a_sales_order": "order_date due_date created_date updated_date",
    "erp_a_sales_order_item": "ship_date",
    "erp_a_delivery": "delivery_date created_date",
    "erp_a_invoice": "invoice_date created_date",
    "erp_b_vendedor": "",
    "erp_b_escola": "created_date updated_date",
    "erp_b_pedido": "order_date expected_delivery_date created_at updated_at",
    "erp_b_item_pedido": "created_at",
    "fin_nota_fiscal": "emissao_date expected_delivery_date actual_delivery_date created_at",
    "support_organization": "created_at updated_at",
    "support_user": "created_at updated_at",
    "support_ticket": "created_at updated_at solved_at",
    "support_ticket_tag": "",
}

# Rows of each raw table, counted on the star tables.
_RAW_COUNTS = {
    "crm_user": "SELECT count(*) FROM nation",
    "crm_account": "SELECT count(*) FROM customer WHERE c_custkey % 10 < 7",
    "crm_product": "SELECT count(*) FROM part",
    "crm_service_contract": "SELECT count(DISTINCT (o_custkey, year(o_orderdate))) FROM orders "
    "WHERE o_custkey % 10 < 7",
    "crm_contract_line_item": "SELECT count(*) FROM orders WHERE o_custkey % 10 < 7",
    "erp_a_salesperson": "SELECT count(*) FROM supplier",
    "erp_a_customer": "SELECT count(*) FROM customer WHERE c_custkey % 3 <> 1",
    "erp_a_sales_order": "SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0",
    "erp_a_sales_order_item": "SELECT count(*) FROM lineitem WHERE l_orderkey % 2 = 0",
    "erp_a_delivery": "SELECT count(DISTINCT l_orderkey) FROM lineitem "
    "WHERE l_orderkey % 2 = 0 AND l_linestatus = 'F'",
    "erp_a_invoice": "SELECT count(DISTINCT l_orderkey) FROM lineitem "
    "WHERE l_orderkey % 2 = 0 AND l_linestatus = 'F'",
    "erp_b_vendedor": "SELECT count(*) FROM supplier",
    "erp_b_escola": "SELECT count(*) FROM customer WHERE c_custkey % 3 <> 0",
    "erp_b_pedido": "SELECT count(*) FROM orders WHERE o_orderkey % 2 = 1",
    "erp_b_item_pedido": "SELECT count(*) FROM lineitem WHERE l_orderkey % 2 = 1",
    "fin_nota_fiscal": "SELECT count(DISTINCT l_orderkey) FROM lineitem "
    "WHERE l_orderkey % 2 = 1 AND l_linestatus = 'F'",
    "support_organization": "SELECT count(*) FROM customer WHERE c_custkey % 2 = 0",
    "support_user": "SELECT count(*) FROM customer",
    "support_ticket": "SELECT count(*) FROM events",
    "support_ticket_tag": "SELECT count(*) + count(*) FILTER (event_id % 2 = 0) FROM events",
}

_ENTITY = {
    "school": "e_school",
    "account_manager": "e_manager",
    "contract": "e_contract",
    "order": "e_order",
    "order_item": "e_item",
    "delivery": "e_delivery",
    "ticket": "e_ticket",
    "monthly": "r_monthly",
    "ytd": "r_ytd",
}


def _part(table: str) -> str:
    if "/" in table:
        return "s_" + table.replace("/", "_")
    return _ENTITY.get(table, f"c_{table}")


def _checks(kind: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS check_name, "
        f"({query}) AS failures"
        for table, column, query in failures(_part)[kind]
    )


def _matches(left: str, key: str, targets: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS target, count(*) AS n_rows, count(*) FILTER (hit) AS n_matched, "
        f"CAST(count(*) FILTER (hit) AS DOUBLE) / count(*) AS match_rate "
        f"FROM (SELECT {key} IN (SELECT {key} FROM {t} WHERE {key} IS NOT NULL) AS hit FROM {left})"
        for name, t in targets.items()
    )


_DRESSED_TAX = (
    "substr(tax,1,2)||'.'||substr(tax,3,3)||'.'||substr(tax,6,3)||'/'||substr(tax,9,4)||'-'"
    "||substr(tax,13,2)"
)
_SPACED_TAX = (
    "substr(tax,1,2)||' '||substr(tax,3,3)||' '||substr(tax,6,3)||' '||substr(tax,9,4)||' '"
    "||substr(tax,13,2)"
)
_MISSING_KEY = "md5(source_system || '-_dbt_utils_surrogate_key_null_')"
_RATE = "CAST(sum(successful_deliveries) AS DOUBLE)"


def _sum(x: str, rest: str = "", none: bool = False) -> str:
    """The exact sum of doubles; `rest` may filter, and no value may count as 0."""
    total = f"sum({units(x)}){rest}"
    return double(f"coalesce({total}, 0)" if none else total)


def _month_card(columns: str) -> str:
    return f"SELECT CAST(month AS VARCHAR) AS month, {columns} FROM r_monthly GROUP BY month"


def _close_orders(tolerance: int) -> str:
    return f"""
SELECT DISTINCT a.contract_id, CAST(a.order_date AS VARCHAR) AS order_date
FROM x_priced a JOIN x_priced b ON a.contract_id = b.contract_id AND a.order_date = b.order_date
 AND a.source_system <> b.source_system AND abs(a.total - b.total) < {tolerance}"""


_DUPLICATE_CHECKS = (("no_cross_erp_duplicate_order", 1), ("no_cross_erp_similar_order", 100_000))


def _group_check(name: str, tolerance: int) -> str:
    return f"""
UNION ALL SELECT '{name}', g.n, g.n - f.n, CAST(g.n - f.n AS DOUBLE) / nullif(g.n, 0), f.n = 0, f.keys
FROM (SELECT count(*) AS n FROM (SELECT 1 FROM e_order
      WHERE contract_id IS NOT NULL AND order_date IS NOT NULL
      GROUP BY contract_id, order_date HAVING count(DISTINCT source_system) > 1)) g,
     (SELECT count(*) AS n, array_to_string(list_sort(list(contract_id || '/' || order_date))[:5], ', ') AS keys
      FROM ({_close_orders(tolerance)})) f"""


def finals() -> dict[str, str]:
    money = _sum("ordered_amount")
    counts = ", ".join(
        f"('{t}', ({_RAW_COUNTS[t]}), (SELECT count(*) FROM c_{t}))" for t in _CLEAN_DATES
    )
    return {
        **{f"clean_{t}": _all(f"c_{t}", _CLEAN_DATES[t]) for t in _CLEAN_DATES},
        "normalize_keys": f"""
SELECT 'crm' AS source_system, 'A' || k AS source_id, {_DRESSED_TAX} AS raw_value, tax AS digits,
       tax AS tax_id FROM x_cust WHERE k % 10 < 7
UNION ALL SELECT 'erp_a', 'C' || k, tax, tax, tax FROM x_cust WHERE k % 3 <> 1
UNION ALL SELECT 'erp_b', k::VARCHAR, CASE WHEN k % 2 = 1 THEN {_SPACED_TAX} ELSE tax END, tax, tax
FROM x_cust WHERE k % 3 <> 0
UNION ALL SELECT 'support', organization_id::VARCHAR, external_id_raw,
       regexp_replace(external_id_raw, '[^0-9]', '', 'g'), cnpj FROM c_support_organization""",
        "normalize_codes": """
SELECT 'crm' AS source_system, contract_number, count(*) AS n_rows
FROM c_crm_service_contract GROUP BY ALL
UNION ALL SELECT 'erp_a', contract_number, count(*) FROM c_erp_a_sales_order GROUP BY ALL
UNION ALL SELECT 'erp_b', contract_number, count(*) FROM c_erp_b_pedido GROUP BY ALL""",
        "surrogate_keys": f"""
SELECT 'order' AS entity, source_system, source_order_id, CAST(NULL AS VARCHAR) AS source_line_id,
       md5(source_system || '-' || source_order_id) AS surrogate_key,
       {_MISSING_KEY} AS key_of_missing_id FROM x_all_orders
UNION ALL SELECT 'order_item', source_system, source_order_id, source_line_id,
       md5(source_system || '-' || source_order_id || '-' || source_line_id), {_MISSING_KEY}
FROM x_all_items""",
        "typed_casts": """
SELECT nota_fiscal_id::VARCHAR AS id_text, nota_fiscal_id AS as_bigint, total_value AS as_double,
       emissao_date::VARCHAR AS as_date, created_at::VARCHAR AS as_timestamp,
       created_at::DATE::VARCHAR AS timestamp_as_date, delivery_status = 'entregue' AS as_boolean,
       actual_delivery_date::VARCHAR AS guarded_date, CAST(NULL AS VARCHAR) AS null_text,
       CAST(NULL AS BIGINT) AS null_bigint, CAST(NULL AS DOUBLE) AS null_double
FROM c_fin_nota_fiscal""",
        "month_truncation": """
SELECT 'order' AS kind, source_system || ':' || source_order_id AS id, order_date::VARCHAR AS day,
       strftime(order_date, '%Y-%m-01') AS month FROM x_all_orders
UNION ALL SELECT 'ticket', ticket_id::VARCHAR, created_at::DATE::VARCHAR,
       strftime(created_at, '%Y-%m-01') FROM c_support_ticket""",
        "elapsed_hours": """
SELECT ticket_id, date_sub('hour', created_at, solved_at) AS resolution_hours,
       -date_sub('hour', created_at, solved_at) AS reversed_hours FROM c_support_ticket""",
        "days_between": """
SELECT nota_fiscal_id, actual_delivery_date - emissao_date AS days_to_delivery,
       actual_delivery_date - expected_delivery_date AS days_late FROM c_fin_nota_fiscal""",
        "line_totals": """
SELECT source_system, source_order_id, source_line_id, quantity, unit_price, line_total
FROM x_all_items""",
        "order_status_map": """
SELECT 'erp_a' AS source_system,
       CASE WHEN prio = '5-LOW' THEN 'Y' ELSE 'N' END || '/' ||
       CASE WHEN ostatus = 'O' THEN 'O' ELSE 'C' END AS raw_status,
       CASE WHEN prio = '5-LOW' THEN 'cancelled' WHEN ostatus = 'O' THEN 'open'
            ELSE 'closed' END AS status, count(*) AS n_orders
FROM x_ord WHERE o % 2 = 0 GROUP BY ALL
UNION ALL SELECT 'erp_b', spelling, status, count(*)
FROM x_pedido JOIN c_erp_b_pedido ON pedido_id = o GROUP BY ALL""",
        "status_profile": """
SELECT 'erp_a' AS source_system, status, count(DISTINCT (is_cancelled, ostatus = 'O'))
       AS n_spellings, count(*) AS n_orders
FROM c_erp_a_sales_order JOIN x_ord ON o = doc_entry GROUP BY status
UNION ALL SELECT 'erp_b', status, count(DISTINCT spelling), count(*)
FROM c_erp_b_pedido JOIN x_pedido ON o = pedido_id GROUP BY status""",
        "delivery_status_map": """
SELECT delivery_status, delivery_status_normalized, count(*) AS n_notes
FROM c_fin_nota_fiscal GROUP BY ALL""",
        "delivery_valid_dates": _all("x_all_deliveries", "delivery_date"),
        "invalid_dates": """
SELECT CAST(year(dd) AS BIGINT) AS year, count(*) AS n_rows FROM x_delivery_a
WHERE year(dd) NOT BETWEEN 2010 AND 2030 GROUP BY ALL""",
        "school_records": "SELECT * EXCLUDE (rank) FROM x_record",
        "resolve_school": "SELECT * FROM e_school",
        "school_directory": """
SELECT r.source_system, r.source_id, r.cnpj, s.school_id
FROM x_record r JOIN e_school s USING (cnpj)""",
        "account_managers": "SELECT * FROM e_manager",
        "contract_links": _all("e_contract", "start_date end_date created_at updated_at"),
        "orders_unified": _all("x_all_orders", "order_date due_date created_at updated_at"),
        "order_school_link": _all("e_order", "order_date due_date created_at updated_at"),
        "order_items_unified": "SELECT * FROM e_item",
        "delivery_order_link": _all("e_delivery", "delivery_date"),
        "ticket_tags": "SELECT * FROM x_tags",
        "ticket_enriched": _all("e_ticket", "created_at updated_at solved_at"),
        "month_spine": """
SELECT school_id, CAST(month AS VARCHAR) AS month FROM e_school CROSS JOIN x_months""",
        "monthly_school_metrics": _all("r_monthly", "month"),
        "ytd_am_portfolio": "SELECT * FROM r_ytd",
        "rfc_school_month_sales": f"""
SELECT s.school_id, s.name AS school_name, ym AS year_month,
       {double('sum(amount)')} AS ordered_amount,
       {double('sum(CASE WHEN drops > 0 THEN amount ELSE 0 END)')} AS delivered_amount,
       count(*) AS order_count, CAST(sum(drops) AS BIGINT) AS delivered_order_count
FROM (SELECT o.school_id, strftime(o.order_date, '%Y-%m-01') AS ym,
             (SELECT sum({units('line_total')}) FROM e_item i
              WHERE i.order_id = o.order_id) AS amount,
             (SELECT count(DISTINCT delivery_id) FROM e_delivery d WHERE d.order_id = o.order_id
              AND coalesce(d.delivery_status_normalized, d.status) = 'delivered') AS drops
      FROM e_order o
      WHERE NOT o.is_cancelled AND o.order_id IN (SELECT order_id FROM e_item)
        AND o.order_date >= (SELECT max(order_date) - INTERVAL 12 MONTH FROM e_order))
JOIN e_school s USING (school_id)
GROUP BY ALL""",
        "rfc_am_ytd_sales": f"""
SELECT m.account_manager_id, any_value(m.name) AS am_name, any_value(ref) AS year,
       {_sum('line_total')} AS ytd_ordered_amount,
       count(DISTINCT o.school_id) AS school_count, count(DISTINCT o.order_id) AS order_count
FROM e_manager m
JOIN e_contract c ON c.account_manager_id = m.account_manager_id AND NOT c.is_cancelled
JOIN e_order o ON o.contract_id = c.contract_id AND NOT o.is_cancelled
JOIN x_year ON year(o.order_date) = ref
JOIN e_item i ON i.order_id = o.order_id
GROUP BY m.account_manager_id""",
        "contract_reconciliation": f"""
SELECT c.contract_id, any_value(c.contract_number) AS contract_number,
       any_value(c.school_id) AS school_id, any_value(c.grand_total) AS grand_total,
       count(DISTINCT o.order_id) AS total_orders,
       {_sum('i.line_total', none=True)} AS ordered_amount,
       {double(units('any_value(c.grand_total)') + ' - coalesce(sum(' + units('i.line_total') + '), 0)')}
           AS open_amount
FROM e_contract c
LEFT JOIN e_order o ON o.contract_id = c.contract_id AND NOT o.is_cancelled
LEFT JOIN e_item i ON i.order_id = o.order_id
GROUP BY c.contract_id""",
        "network_rollup": f"""
SELECT m.parent_account_id AS network_id,
       (SELECT any_value(name) FROM c_crm_account n WHERE n.crm_account_id = m.parent_account_id)
           AS network_name,
       count(DISTINCT m.crm_account_id) AS members,
       count(DISTINCT o.school_id) AS ordering_members, count(DISTINCT o.order_id) AS total_orders,
       {_sum('i.line_total', none=True)} AS ordered_amount
FROM c_crm_account m
LEFT JOIN e_order o ON o.school_id = m.crm_account_id AND NOT o.is_cancelled
LEFT JOIN e_item i ON i.order_id = o.order_id
WHERE NOT m.is_deleted AND m.parent_account_id IS NOT NULL
GROUP BY m.parent_account_id""",
        "proportional_delivery": f"""
SELECT school_id, count(*) AS total_orders,
       {double('coalesce(sum(amount), 0)')} AS ordered_amount,
       {double("coalesce(sum(CASE WHEN source_system = 'erp_a' THEN by_line WHEN quantity > 0 THEN "
           + units('(' + double('amount') + ') * least(CAST(coalesce(noted, 0) AS DOUBLE) / ('
                   + double('quantity') + '), 1.0)') + ' ELSE 0 END), 0)')} AS delivered_amount
FROM (
  SELECT o.order_id, o.school_id, o.source_system,
         any_value(o.source_order_id) AS source_order_id,
         sum({units('line_total')}) AS amount, sum({units('quantity')}) AS quantity,
         sum(CAST(CASE WHEN quantity > 0
             THEN line_total * least(coalesce(delivered_quantity, 0) / quantity, 1.0) ELSE 0 END
             * {UNIT} AS HUGEINT)) AS by_line
  FROM e_order o LEFT JOIN e_item i ON i.order_id = o.order_id
  WHERE NOT o.is_cancelled AND o.school_id IS NOT NULL
  GROUP BY o.order_id, o.school_id, o.source_system
) per_order
LEFT JOIN (
  SELECT pedido_id::VARCHAR AS source_order_id, sum(quantity_delivered) AS noted
  FROM c_fin_nota_fiscal
  WHERE coalesce(delivery_status NOT IN ('devolvido', 'extraviado'), true) GROUP BY pedido_id
) noted ON source_system = 'erp_b' AND noted.source_order_id = per_order.source_order_id
GROUP BY school_id""",
        "manager_timeline": """
SELECT school_id, CAST(row_number() OVER w AS INTEGER) AS version, account_manager_id,
       CAST(start_date AS VARCHAR) AS valid_from,
       CAST(lead(start_date) OVER w AS VARCHAR) AS valid_to,
       lead(start_date) OVER w IS NULL AS is_current
FROM (SELECT *, row_number() OVER v AS nth, lag(account_manager_id) OVER v AS before
      FROM e_contract WHERE school_id IS NOT NULL AND start_date IS NOT NULL
      WINDOW v AS (PARTITION BY school_id ORDER BY start_date, contract_id))
WHERE nth = 1 OR account_manager_id IS DISTINCT FROM before
WINDOW w AS (PARTITION BY school_id ORDER BY start_date, contract_id)""",
        "school_timeline": """
SELECT school_id, CAST(v AS INTEGER) AS version, account_manager_id, brand,
       CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
       valid_to IS NULL AS is_current FROM x_version""",
        "order_manager_at_date": """
SELECT o.order_id, o.school_id, CAST(o.order_date AS VARCHAR) AS order_date,
       o.account_manager_id AS contract_manager_id,
       CASE WHEN holds THEN v.account_manager_id END AS account_manager_id,
       CASE WHEN holds THEN v.brand END AS brand,
       CASE WHEN holds THEN CAST(v.valid_from AS VARCHAR) END AS valid_from
FROM e_order o ASOF LEFT JOIN (SELECT *, true AS held FROM x_version) v
  ON v.school_id = o.school_id AND o.order_date >= v.valid_from,
LATERAL (SELECT held AND (v.valid_to IS NULL OR v.valid_to > o.order_date) AS holds)""",
        "mapping_conflicts": """
SELECT src AS source_key, dst AS target_key, CASE WHEN dst IS NULL THEN 'invalid'
       WHEN src NOT IN (SELECT src FROM x_sound) THEN 'contradiction' ELSE 'cycle' END AS problem
FROM x_seed WHERE dst IS NULL OR src NOT IN (SELECT src FROM x_sound)
   OR src IN (SELECT src FROM x_walk WHERE steps = 40)""",
        "mapped_schools": """
SELECT coalesce(max(source_id) FILTER (rank = 1), 'NCRM-' || cnpj) AS school_id, cnpj,
       arg_min(name, rank) AS name, arg_min(razao_social, rank) AS razao_social,
       arg_min(city, rank) AS city, arg_min(state, rank) AS state,
       max(source_id) FILTER (rank = 1) AS crm_account_id,
       max(source_id) FILTER (rank = 2) AS erp_a_customer_code,
       max(source_id) FILTER (rank = 3) AS erp_b_escola_id,
       max(source_id) FILTER (rank = 4) AS support_org_id
FROM (SELECT * FROM x_mapped_record WHERE length(cnpj) = 14
      QUALIFY row_number() OVER (PARTITION BY cnpj, rank ORDER BY source_id) = 1) GROUP BY cnpj""",
        "manager_brands": f"""
SELECT account_manager_id, brand, count(DISTINCT signed_id) AS total_contracts,
       {double('coalesce(sum(signed), 0)')} AS contracted_amount,
       count(DISTINCT order_id) AS total_orders,
       {double('coalesce(sum(sold), 0)')} AS ordered_amount
FROM (SELECT account_manager_id, brand, contract_id AS signed_id,
             {units('grand_total')} AS signed, NULL AS order_id, {NONE} AS sold
      FROM e_contract, x_year WHERE NOT is_cancelled AND year(start_date) = ref
      UNION ALL
      SELECT o.account_manager_id, c.brand, NULL, NULL, o.order_id,
             {units('i.line_total')}
      FROM x_year, e_order o LEFT JOIN e_contract c ON c.contract_id = o.contract_id
      LEFT JOIN e_item i ON i.order_id = o.order_id
      WHERE NOT o.is_cancelled AND year(o.order_date) = ref)
WHERE account_manager_id IS NOT NULL
GROUP BY account_manager_id, brand""",
        "cross_erp_duplicate_orders": _close_orders(1),
        "cross_erp_similar_orders": _close_orders(100_000),
        "dq_unique": _checks("unique"),
        "dq_not_null": _checks("not_null"),
        "dq_accepted_values": _checks("accepted_values"),
        "dq_relationships": _checks("relationships"),
        "dq_coverage": """
SELECT 'order_contract_coverage' AS check_name, count(*) AS n_rows,
       count(contract_id) AS n_passing, CAST(count(contract_id) AS DOUBLE) / count(*) AS share,
       CAST(count(contract_id) AS DOUBLE) / count(*) > 0.70 AS passed,
       CAST(NULL AS VARCHAR) AS failing_keys FROM e_order
UNION ALL SELECT 'school_cross_system_match', count(*), count(coalesce(erp_a_customer_code,
       erp_b_escola_id)), CAST(count(coalesce(erp_a_customer_code, erp_b_escola_id)) AS DOUBLE)
       / count(*), CAST(count(coalesce(erp_a_customer_code, erp_b_escola_id)) AS DOUBLE)
       / count(*) > 0.60, NULL FROM e_school"""
        + "".join(_group_check(*c) for c in _DUPLICATE_CHECKS),
        "row_count_reconciliation": f"""
SELECT table_name, n_rows, n_clean_rows, n_rows = n_clean_rows AS matches
FROM (VALUES {counts}) v(table_name, n_rows, n_clean_rows)""",
        "load_report": """
SELECT 'support_ticket-' || e % 16 || '.csv' AS file, count(*) AS n_lines,
       count(*) FILTER (e % 97 NOT IN (5, 7, 11)) AS n_read,
       count(*) FILTER (e % 97 = 11) AS n_open_quote,
       count(*) FILTER (e % 97 = 5) AS n_too_few_values,
       count(*) FILTER (e % 97 = 7) AS n_too_many_values
FROM x_event GROUP BY e % 16""",
        "load_rejects": """
SELECT 'support_ticket-' || e % 16 || '.csv' AS file, e::VARCHAR AS ticket,
       CASE e % 97 WHEN 5 THEN 'too few values' WHEN 7 THEN 'too many values'
                   ELSE 'open quote' END AS reason
FROM x_event WHERE e % 97 IN (5, 7, 11)""",
        "loaded_tickets": f"""
SELECT * FROM ({_all("c_support_ticket", _CLEAN_DATES["support_ticket"])})
WHERE ticket_id % 97 NOT IN (5, 7, 11)""",
        "key_match_rate": _matches(
            "c_crm_account", "cnpj", {"erp_a": "c_erp_a_customer", "erp_b": "c_erp_b_escola"}
        ),
        "contract_match_rate": _matches(
            "c_crm_service_contract",
            "contract_number",
            {"erp_a": "c_erp_a_sales_order", "erp_b": "c_erp_b_pedido"},
        ),
        "contract_overlap": f"""
SELECT contract_number, count(DISTINCT source_order_id) FILTER (source_system = 'erp_a')
       AS erp_a_orders, count(DISTINCT source_order_id) FILTER (source_system = 'erp_b')
       AS erp_b_orders,
       {_sum('line_total', " FILTER (source_system = 'erp_a')", none=True)} AS erp_a_amount,
       {_sum('line_total', " FILTER (source_system = 'erp_b')", none=True)} AS erp_b_amount
FROM x_all_orders LEFT JOIN x_all_items USING (source_system, source_order_id)
WHERE contract_number IS NOT NULL GROUP BY contract_number
HAVING count(DISTINCT source_system) = 2""",
        "delivery_coverage": """
SELECT source_system, count(*) AS n_orders, count(*) FILTER (hit) AS n_delivered,
       CAST(count(*) FILTER (hit) AS DOUBLE) / count(*) AS coverage
FROM (SELECT source_system, order_id IN (SELECT order_id FROM e_delivery
                                         WHERE order_id IS NOT NULL) AS hit
      FROM e_order WHERE NOT is_cancelled)
GROUP BY source_system""",
        "contracts_by_profile": """
SELECT profile_name, count(*) AS n_contracts
FROM c_crm_service_contract LEFT JOIN c_crm_user ON crm_user_id = owner_id GROUP BY ALL""",
        "fill_rate": """
SELECT field, count(v) AS n_filled, count(*) AS n_rows, CAST(count(v) AS DOUBLE) / count(*)
       AS fill_rate
FROM (SELECT 'organization_id' AS field, organization_id::VARCHAR AS v FROM c_support_ticket
      UNION ALL SELECT 'order_ref', order_ref FROM c_support_ticket
      UNION ALL SELECT 'cnpj_cliente', nullif(cnpj_cliente, '') FROM c_support_ticket)
GROUP BY field""",
        "card_kpis": f"""
SELECT {money} AS ordered_amount, CAST(sum(total_schools_served) AS BIGINT) AS schools_served,
       CAST(sum(total_contracts) AS BIGINT) AS active_contracts FROM r_ytd""",
        "card_delivery_rate": f"""
SELECT {_RATE} / nullif(sum(total_deliveries), 0) AS delivery_success_rate FROM r_monthly""",
        "card_monthly_amount": _month_card(f"{money} AS ordered_amount"),
        "card_monthly_orders": _month_card(
            "CAST(sum(active_orders) AS BIGINT) AS active_orders, "
            "CAST(sum(cancelled_orders) AS BIGINT) AS cancelled_orders"
        ),
        "card_monthly_delivery_rate": _month_card(
            f"{_RATE} * 100 / nullif(sum(total_deliveries), 0) AS delivery_rate_pct"
        ),
        "card_state_volume": """
SELECT state, CAST(sum(quantity_delivered) AS BIGINT) AS quantity_delivered
FROM r_monthly GROUP BY state ORDER BY 2 DESC, 1""",
        "card_monthly_tickets": _month_card("CAST(sum(total_tickets) AS BIGINT) AS total_tickets"),
        "card_resolution_time": """
SELECT avg(resolution_hours) AS avg_resolution_hours FROM e_ticket, x_year
WHERE year(created_at) = ref""",
        "card_portfolio": """
SELECT account_manager_name AS account_manager, total_schools_served AS escolas_atendidas,
       ordered_amount AS valor_pedido_brl, total_orders AS pedidos, total_contracts AS contratos,
       total_tickets AS tickets, avg_resolution_hours AS resolucao_media_horas FROM r_ytd""",
        "card_am_ranking": """
SELECT account_manager_id, account_manager_name, ordered_amount FROM r_ytd
ORDER BY ordered_amount DESC, account_manager_id""",
        "card_top_schools": f"""
SELECT school_id, school_name, {money} AS ordered_amount FROM r_monthly GROUP BY ALL
ORDER BY ordered_amount DESC, school_id LIMIT 10""",
        "card_board": f"""
SELECT CASE WHEN grouping(month) = 0 THEN 'month' WHEN grouping(state) = 0 THEN 'state'
            WHEN grouping(school_id) = 0 THEN 'school' ELSE 'all' END AS card,
       coalesce(CAST(month AS VARCHAR), state, school_id) AS key, {money} AS ordered_amount,
       CAST(sum(active_orders) AS BIGINT) AS active_orders,
       CAST(sum(cancelled_orders) AS BIGINT) AS cancelled_orders,
       CAST(sum(quantity_delivered) AS BIGINT) AS quantity_delivered,
       CAST(sum(total_tickets) AS BIGINT) AS total_tickets,
       {_RATE} * 100 / nullif(sum(total_deliveries), 0) AS delivery_rate_pct
FROM r_monthly GROUP BY GROUPING SETS ((month), (state), (school_id), ())
HAVING count(*) > 0""",
        "school_trailing_year": f"""
SELECT m.school_id, CAST(m.month AS VARCHAR) AS month, any_value(m.ordered_amount)
       AS ordered_amount,
       {_sum('p.ordered_amount', ' FILTER (p.month > m.month - INTERVAL 12 MONTH)')} AS trailing_amount,
       CAST(sum(p.total_orders) FILTER (p.month > m.month - INTERVAL 12 MONTH) AS BIGINT)
            AS trailing_orders,
       {_sum('p.ordered_amount', ' FILTER (p.month = m.month - INTERVAL 12 MONTH)')} AS year_ago_amount
FROM r_monthly m JOIN r_monthly p ON p.school_id = m.school_id
 AND p.month BETWEEN m.month - INTERVAL 12 MONTH AND m.month
GROUP BY m.school_id, m.month""",
        "filtered_trend": f"""
SELECT CAST(month AS VARCHAR) AS month, {money} AS ordered_amount,
       CAST(sum(active_orders) AS BIGINT) AS active_orders,
       CAST(sum(cancelled_orders) AS BIGINT) AS cancelled_orders,
       {_RATE} * 100 / nullif(sum(total_deliveries), 0) AS delivery_rate_pct,
       CAST(sum(total_tickets) AS BIGINT) AS total_tickets
FROM r_monthly WHERE month BETWEEN DATE '2017-01-01' AND DATE '2019-12-01' AND state = 'ASIA'
GROUP BY month""",
    }
