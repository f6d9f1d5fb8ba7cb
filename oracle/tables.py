"""Clean tables, straight from the star tables (names start with c_)."""

# The spellings ERP B uses, in the order the order keys cycle through.
_SPELLINGS = (
    "['C','cancelado','cancelled','CANCELLED','A','P','pending','PENDING','pendente',"
    "'em_andamento','IN_PROGRESS','E','entregue','delivered','DELIVERED']"
)
_FIN = "['entregue','em_transito','extraviado','devolvido','aguardando_coleta']"

TABLES = {
    "x_place": """
SELECT n_nationkey AS nation, n_name AS city, r_name AS state
FROM nation LEFT JOIN region ON r_regionkey = n_regionkey""",
    "x_cust": """
SELECT c_custkey AS k, c_name AS cname, c_acctbal AS bal, c_mktsegment AS seg, city, state,
       lpad(c_custkey::VARCHAR, 14, '0') AS tax,
       DATE '2012-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS since
FROM customer LEFT JOIN x_place ON nation = c_nationkey""",
    "x_ord": """
SELECT o, k, d, y, ostatus, total, prio,
       'CT-' || y || '-' || lpad(k::VARCHAR, 12, '0') AS number
FROM (SELECT o_orderkey AS o, o_custkey AS k, o_orderstatus AS ostatus, o_totalprice AS total,
             o_orderpriority AS prio, CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) AS d,
             CAST(year(o_orderdate) + 20 AS BIGINT) AS y
      FROM orders)""",
    "x_line": """
SELECT l_orderkey AS o, l_partkey AS part, l_suppkey AS supp, l_quantity AS q,
       l_extendedprice AS price, l_tax AS taxrate, l_linestatus = 'F' AS shipped, d,
       CAST(l_linenumber AS BIGINT) + (d - DATE '2010-01-01') * 8 + l_partkey * 524288 AS line,
       floor(l_extendedprice * 100 / l_quantity) / CAST(100 AS DOUBLE) AS unit
FROM (SELECT *, CAST(l_shipdate + INTERVAL 20 YEAR AS DATE) AS d FROM lineitem)""",
    "x_ship": """
SELECT o, min(d) AS d1, max(d) AS d2, CAST(sum(CAST(q AS BIGINT)) AS BIGINT) AS q,
       CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total,
       CAST(sum(CAST(price * taxrate AS DECIMAL(18,4))) AS DOUBLE) AS tax, max(supp) AS supp
FROM x_line WHERE shipped GROUP BY o""",
    "x_event": """
SELECT event_id AS e, user_id AS u, event_type AS kind, props,
       ts - INTERVAL 3 YEAR AS t0,
       CASE WHEN event_type IN ('view','purchase')
            THEN ts - INTERVAL 3 YEAR + to_minutes(CAST(floor(value * 60) AS BIGINT)) END AS t1
FROM events""",
    "c_crm_user": """
SELECT 'U' || n_nationkey AS crm_user_id, n_name AS name, lower(n_name) || '@crm.example' AS email,
       ['Account Manager','CS Manager','Admin','Sales Rep'][n_nationkey % 4 + 1] AS profile_name,
       n_nationkey % 5 <> 4 AS is_active,
       CAST(DATE '2012-01-01' + n_nationkey % 1000 AS TIMESTAMP) AS created_at,
       CAST(DATE '2012-01-01' + n_nationkey % 1000 AS TIMESTAMP) AS updated_at
FROM nation""",
    "c_crm_account": """
SELECT 'A' || k AS crm_account_id, cname AS name, cname || ' SA' AS razao_social, tax AS cnpj,
       CASE WHEN k % 8 = 0 THEN 'Network' ELSE 'School' END AS account_type,
       CASE WHEN k % 8 <> 0 THEN 'A' || (k - k % 8) END AS parent_account_id,
       '+55 ' || k AS phone, city, state,
       CASE WHEN bal >= 0 THEN 'direct' ELSE 'partner' END AS sales_modality, seg AS segment,
       'U' || k % 20 AS owner_id, k % 25 = 1 AS is_deleted,
       CAST(since AS TIMESTAMP) AS created_at, CAST(since AS TIMESTAMP) AS updated_at
FROM x_cust WHERE k % 10 < 7""",
    "c_crm_product": """
SELECT 'P' || p_partkey AS crm_product_id, p_partkey::VARCHAR AS sku, p_name AS name,
       p_brand AS brand, p_type AS material_type, p_size % 2 = 0 AS is_active,
       CAST(DATE '2012-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS TIMESTAMP) AS created_at
FROM part""",
    "c_crm_service_contract": """
SELECT 'K' || k || '-' || y AS crm_contract_id, any_value(number) AS contract_number,
       'Contract ' || y AS name, 'A' || k AS crm_account_id, 'U' || k % 18 AS owner_id,
       CASE WHEN (k + y) % 11 = 0 THEN 'Cancelled' ELSE 'Activated' END AS status,
       (k + y) % 11 = 0 AS is_cancelled, make_date(y, 1, 15) AS start_date,
       make_date(y, 12, 31) AS end_date, 'Brand#' || k % 25 AS brand,
       CAST(sum(CAST(total AS DECIMAL(18,2))) AS DOUBLE) AS grand_total,
       CAST(sum(CAST(total AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
       CAST(0 AS DOUBLE) AS discount,
       CASE WHEN k % 2 = 0 THEN 'full' ELSE 'basic' END AS marketing_model,
       (k + y) % 29 = 0 AS is_deleted, CAST(make_date(y, 1, 15) AS TIMESTAMP) AS created_at,
       CAST(make_date(y, 1, 15) AS TIMESTAMP) AS updated_at
FROM x_ord WHERE k % 10 < 7 GROUP BY k, y""",
    "c_crm_contract_line_item": """
SELECT 'L' || o AS crm_line_item_id, 'K' || k || '-' || y AS crm_contract_id,
       'P' || o % 200 AS crm_product_id, ['book','kit','digital'][o % 3 + 1] AS material_type,
       'grade ' || (o % 9 + 1) AS school_grade, prio AS segment, o % 5 + 1 AS quantity,
       floor(total * 100 / CAST(o % 5 + 1 AS DOUBLE)) / CAST(100 AS DOUBLE) AS unit_price,
       CAST(0 AS DOUBLE) AS discount, total AS total_price, CAST(d AS TIMESTAMP) AS created_at
FROM x_ord WHERE k % 10 < 7""",
    "c_erp_a_salesperson": """
SELECT s_suppkey AS salesperson_code, s_name AS name, state AS region, s_acctbal >= 0 AS is_active
FROM supplier LEFT JOIN x_place ON nation = s_nationkey""",
    "c_erp_a_customer": """
SELECT 'C' || k AS customer_code, cname || ' A' AS name, tax AS cnpj, city, state,
       '+55 ' || k AS phone, 'a' || k || '@school.example' AS email, k % 100 AS salesperson_code,
       since AS created_date, since AS updated_date
FROM x_cust WHERE k % 3 <> 1""",
    "c_erp_a_sales_order": """
SELECT o AS doc_entry, o + 1000000 AS doc_num, 'C' || k AS customer_code,
       CASE WHEN o % 5 <> 0 THEN number END AS contract_number, d AS order_date,
       d + 30 AS due_date, prio = '5-LOW' AS is_cancelled,
       CASE WHEN prio = '5-LOW' THEN 'cancelled' WHEN ostatus = 'O' THEN 'open'
            ELSE 'closed' END AS status,
       prio AS comments, k % 100 AS salesperson_code, d AS created_date, d AS updated_date
FROM x_ord WHERE o % 2 = 0""",
    "c_erp_a_sales_order_item": """
SELECT o AS doc_entry, line AS line_num, part::VARCHAR AS sku, 'Item ' || part AS description,
       q AS quantity, CASE WHEN shipped THEN q ELSE 0 END AS delivered_quantity,
       CASE WHEN shipped THEN 0 ELSE q END AS open_quantity, d AS ship_date,
       CASE WHEN shipped THEN 'C' ELSE 'O' END AS line_status, unit AS unit_price,
       price AS line_total
FROM x_line WHERE o % 2 = 0""",
    "x_delivery_a": """
SELECT o, supp, d1, CASE WHEN o % 97 = 0 THEN CAST(d2 + INTERVAL 200 YEAR AS DATE) ELSE d2 END AS dd
FROM x_ship WHERE o % 2 = 0""",
    "c_erp_a_delivery": """
SELECT o AS doc_entry, o + 2000000 AS doc_num, 'C' || supp AS customer_code,
       o AS base_order_entry, dd AS delivery_date,
       CASE WHEN o % 4 = 0 THEN 'O' ELSE 'C' END AS status, o % 13 = 0 AS is_cancelled,
       d1 AS created_date
FROM x_delivery_a WHERE year(dd) BETWEEN 2010 AND 2030""",
    "c_erp_a_invoice": """
SELECT o AS doc_entry, o + 3000000 AS doc_num, 'C' || supp AS customer_code,
       o AS base_order_entry, d2 AS invoice_date, total, tax AS tax_amount,
       o % 13 = 0 AS is_cancelled, d1 AS created_date
FROM x_ship WHERE o % 2 = 0""",
    "c_erp_b_vendedor": """
SELECT s_suppkey AS vendedor_id, s_name AS name, 'v' || s_suppkey || '@erp.example' AS email,
       city AS region, s_suppkey % 3 <> 0 AS is_active
FROM supplier LEFT JOIN x_place ON nation = s_nationkey""",
    "c_erp_b_escola": """
SELECT k AS escola_id, cname || ' B' AS name, tax AS cnpj, city, state,
       'b' || k || '@school.example' AS email, k % 100 AS vendedor_id,
       since AS created_date, since AS updated_date
FROM x_cust WHERE k % 3 <> 0""",
    "x_pedido": f"""
SELECT *, {_SPELLINGS}[o % 15 + 1] AS spelling FROM x_ord WHERE o % 2 = 1""",
    "c_erp_b_pedido": """
SELECT o AS pedido_id, k AS escola_id, CASE WHEN o % 7 <> 0 THEN number END AS contract_number,
       d AS order_date, d + 45 AS expected_delivery_date, upper(spelling) AS status_raw,
       CASE lower(spelling) WHEN 'c' THEN 'cancelled' WHEN 'cancelado' THEN 'cancelled'
            WHEN 'cancelled' THEN 'cancelled' WHEN 'e' THEN 'delivered'
            WHEN 'entregue' THEN 'delivered' WHEN 'delivered' THEN 'delivered'
            ELSE 'in_progress' END AS status,
       o % 15 < 4 AS is_cancelled, k % 100 AS vendedor_id,
       CAST(d AS TIMESTAMP) AS created_at, CAST(d AS TIMESTAMP) AS updated_at
FROM x_pedido""",
    "c_erp_b_item_pedido": """
SELECT line AS item_id, o AS pedido_id, part::VARCHAR AS sku, 'Item ' || part AS description,
       CAST(q AS BIGINT) AS quantity, unit AS unit_price, q * unit AS line_total,
       CAST(d AS TIMESTAMP) AS created_at
FROM x_line WHERE o % 2 = 1""",
    "c_fin_nota_fiscal": f"""
SELECT o AS nota_fiscal_id, 'NF-' || o AS numero, '1' AS serie, o AS pedido_id,
       lpad(supp::VARCHAR, 14, '0') AS cnpj_cliente, 'Client ' || supp AS nome_cliente,
       d1 AS emissao_date, total AS total_value, tax AS tax_value,
       lpad(supp::VARCHAR, 14, '0') AS cnpj_transportadora, 'Carrier ' || supp AS transportadora,
       'TRK' || o AS tracking_code, d1 + 10 AS expected_delivery_date,
       CASE WHEN o % 3 <> 0 THEN d2 END AS actual_delivery_date,
       {_FIN}[o % 5 + 1] AS delivery_status,
       ['delivered','in_transit','lost','returned','awaiting_pickup'][o % 5 + 1]
           AS delivery_status_normalized,
       q AS quantity_delivered, CAST(d1 AS TIMESTAMP) AS created_at
FROM x_ship WHERE o % 2 = 1""",
    "c_support_organization": """
SELECT k AS organization_id, cname || ' S' AS name, CASE WHEN k % 4 = 0 THEN tax END AS cnpj,
       CASE WHEN k % 4 = 0 THEN tax WHEN k % 8 = 2 THEN 'n/a' END AS external_id_raw,
       CAST(since AS TIMESTAMP) AS created_at, CAST(since AS TIMESTAMP) AS updated_at
FROM x_cust WHERE k % 2 = 0""",
    "c_support_user": """
SELECT k AS support_user_id, cname AS name, 's' || k || '@school.example' AS email,
       k - k % 2 AS organization_id, ['end-user','agent','admin'][k % 3 + 1] AS role,
       k % 6 <> 0 AS is_active, CAST(since AS TIMESTAMP) AS created_at,
       CAST(since AS TIMESTAMP) AS updated_at
FROM x_cust""",
    "c_support_ticket": """
SELECT e AS ticket_id, 'About ' || kind AS subject, props AS description,
       CASE kind WHEN 'view' THEN 'closed' WHEN 'purchase' THEN 'solved' WHEN 'click' THEN 'open'
            WHEN 'signup' THEN 'new' WHEN 'error' THEN 'pending' END AS status,
       ['low','normal','high','urgent'][e % 4 + 1] AS priority, u AS requester_id,
       u % 10 AS assignee_id, CASE WHEN e % 10 <> 0 THEN u END AS organization_id,
       CASE WHEN e % 5 < 2 THEN e::VARCHAR END AS order_ref,
       CASE WHEN e % 3 = 0 THEN lpad(u::VARCHAR, 14, '0') ELSE '' END AS cnpj_cliente,
       t0 AS created_at, coalesce(t1, t0) AS updated_at, t1 AS solved_at
FROM x_event""",
    "c_support_ticket_tag": """
SELECT e AS ticket_id, kind AS tag FROM x_event
UNION ALL SELECT e, 'even' FROM x_event WHERE e % 2 = 0""",
}
