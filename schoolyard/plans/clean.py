"""Clean layer: one function per raw table, same grain, renamed and typed.

A cast of a column that already has the type disappears during analysis, so the
same functions serve all-text CSV extracts and typed Parquet extracts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schoolyard import functions as fn
from schoolyard.functions import status as st


def _as(kind: str | None) -> Callable[[str, str | None], Column]:
    def column(raw: str, out: str | None = None) -> Column:
        c = F.col(raw)
        return (c.cast(kind) if kind else c).alias(out or raw)

    return column


same = _as(None)
text = _as("string")
whole = _as("bigint")
number = _as("double")
flag = _as("boolean")
day = _as("date")
instant = _as("timestamp")


def yes(raw: str, value: str, out: str) -> Column:
    """True when the code equals ``value``; an unknown code stays NULL."""
    return (F.col(raw) == value).alias(out)


# -- CRM -------------------------------------------------------------------


def crm_user(raw: DataFrame) -> DataFrame:
    return raw.select(
        same("Id", "crm_user_id"),
        same("Name", "name"),
        same("Email", "email"),
        same("ProfileName", "profile_name"),
        flag("IsActive", "is_active"),
        instant("CreatedDate", "created_at"),
        instant("LastModifiedDate", "updated_at"),
    )


def crm_account(raw: DataFrame) -> DataFrame:
    return raw.select(
        same("Id", "crm_account_id"),
        same("Name", "name"),
        same("RazaoSocial__c", "razao_social"),
        fn.digits("CNPJ__c").alias("cnpj"),
        same("Type", "account_type"),
        same("ParentId", "parent_account_id"),
        same("Phone", "phone"),
        same("BillingCity", "city"),
        same("BillingState", "state"),
        same("SalesModality__c", "sales_modality"),
        same("Segment__c", "segment"),
        same("OwnerId", "owner_id"),
        flag("IsDeleted", "is_deleted"),
        instant("CreatedDate", "created_at"),
        instant("LastModifiedDate", "updated_at"),
    )


def crm_product(raw: DataFrame) -> DataFrame:
    return raw.select(
        same("Id", "crm_product_id"),
        same("ProductCode", "sku"),
        same("Name", "name"),
        same("Brand__c", "brand"),
        same("MaterialType__c", "material_type"),
        flag("IsActive", "is_active"),
        instant("CreatedDate", "created_at"),
    )


def crm_service_contract(raw: DataFrame) -> DataFrame:
    return raw.select(
        same("Id", "crm_contract_id"),
        fn.norm_code("ContractNumber").alias("contract_number"),
        same("Name", "name"),
        same("AccountId", "crm_account_id"),
        same("OwnerId", "owner_id"),
        same("Status", "status"),
        yes("Status", "Cancelled", "is_cancelled"),
        day("StartDate", "start_date"),
        day("EndDate", "end_date"),
        same("Brand__c", "brand"),
        number("GrandTotal", "grand_total"),
        number("TotalPrice", "total_price"),
        number("Discount", "discount"),
        same("MarketingModel__c", "marketing_model"),
        flag("IsDeleted", "is_deleted"),
        instant("CreatedDate", "created_at"),
        instant("LastModifiedDate", "updated_at"),
    )


def crm_contract_line_item(raw: DataFrame) -> DataFrame:
    return raw.select(
        same("Id", "crm_line_item_id"),
        same("ServiceContractId", "crm_contract_id"),
        same("ProductId", "crm_product_id"),
        same("MaterialType__c", "material_type"),
        same("SchoolGrade__c", "school_grade"),
        same("Segment__c", "segment"),
        whole("Quantity", "quantity"),
        number("UnitPrice", "unit_price"),
        number("Discount", "discount"),
        number("TotalPrice", "total_price"),
        instant("CreatedDate", "created_at"),
    )


# -- ERP A -----------------------------------------------------------------


def erp_a_customer(raw: DataFrame) -> DataFrame:
    return raw.select(
        same("CardCode", "customer_code"),
        same("CardName", "name"),
        fn.digits("CNPJ").alias("cnpj"),
        same("City", "city"),
        same("State", "state"),
        same("Phone1", "phone"),
        same("E_Mail", "email"),
        whole("SlpCode", "salesperson_code"),
        day("CreateDate", "created_date"),
        day("UpdateDate", "updated_date"),
    )


def erp_a_salesperson(raw: DataFrame) -> DataFrame:
    return raw.select(
        whole("SlpCode", "salesperson_code"),
        same("SlpName", "name"),
        same("Memo", "region"),
        yes("Active", "Y", "is_active"),
    )


def erp_a_sales_order(raw: DataFrame) -> DataFrame:
    return raw.select(
        whole("DocEntry", "doc_entry"),
        whole("DocNum", "doc_num"),
        same("CardCode", "customer_code"),
        fn.norm_code("NumAtCard").alias("contract_number"),
        day("DocDate", "order_date"),
        day("DocDueDate", "due_date"),
        yes("Cancelled", "Y", "is_cancelled"),
        st.erp_a_status(F.col("Cancelled"), F.col("DocStatus")).alias("status"),
        same("Comments", "comments"),
        whole("SlpCode", "salesperson_code"),
        day("CreateDate", "created_date"),
        day("UpdateDate", "updated_date"),
    )


def erp_a_sales_order_item(raw: DataFrame) -> DataFrame:
    return raw.select(
        whole("DocEntry", "doc_entry"),
        whole("LineNum", "line_num"),
        same("ItemCode", "sku"),
        same("ItemName", "description"),
        number("Quantity", "quantity"),
        number("DelivrdQty", "delivered_quantity"),
        number("OpenQty", "open_quantity"),
        day("ShipDate", "ship_date"),
        same("LineStatus", "line_status"),
        number("Price", "unit_price"),
        number("LineTotal", "line_total"),
    )


def erp_a_delivery(raw: DataFrame) -> DataFrame:
    return raw.select(
        whole("DocEntry", "doc_entry"),
        whole("DocNum", "doc_num"),
        same("CardCode", "customer_code"),
        whole("BaseEntry", "base_order_entry"),
        day("DocDate", "delivery_date"),
        same("DocStatus", "status"),
        yes("Cancelled", "Y", "is_cancelled"),
        day("CreateDate", "created_date"),
    ).filter(fn.valid_year("delivery_date"))


def erp_a_invoice(raw: DataFrame) -> DataFrame:
    return raw.select(
        whole("DocEntry", "doc_entry"),
        whole("DocNum", "doc_num"),
        same("CardCode", "customer_code"),
        whole("BaseEntry", "base_order_entry"),
        day("DocDate", "invoice_date"),
        number("DocTotal", "total"),
        number("VatSum", "tax_amount"),
        yes("Cancelled", "Y", "is_cancelled"),
        day("CreateDate", "created_date"),
    )


# -- ERP B -----------------------------------------------------------------


def erp_b_escola(raw: DataFrame) -> DataFrame:
    return raw.select(
        whole("id_escola", "escola_id"),
        same("nome_escola", "name"),
        fn.digits("cnpj").alias("cnpj"),
        same("cidade", "city"),
        same("estado", "state"),
        same("email"),
        whole("id_vendedor", "vendedor_id"),
        day("dt_cadastro", "created_date"),
        day("dt_atualizacao", "updated_date"),
    )


def erp_b_vendedor(raw: DataFrame) -> DataFrame:
    return raw.select(
        whole("id_vendedor", "vendedor_id"),
        same("nome", "name"),
        same("email"),
        same("regiao", "region"),
        yes("ativo", "S", "is_active"),
    )


def erp_b_pedido(raw: DataFrame) -> DataFrame:
    status_raw = F.upper("status")
    return raw.select(
        whole("id_pedido", "pedido_id"),
        whole("id_escola", "escola_id"),
        fn.norm_code("num_contrato").alias("contract_number"),
        day("dt_pedido", "order_date"),
        day("dt_entrega_prevista", "expected_delivery_date"),
        status_raw.alias("status_raw"),
        st.erp_b_status(F.col("status")).alias("status"),
        status_raw.isin(*st.ERP_B_CANCELLED).alias("is_cancelled"),
        whole("id_vendedor", "vendedor_id"),
        instant("dt_criacao", "created_at"),
        instant("dt_atualizacao", "updated_at"),
    )


def erp_b_item_pedido(raw: DataFrame) -> DataFrame:
    total = F.col("qtd_pedida").cast("double") * F.col("preco_unitario").cast("double")
    return raw.select(
        whole("id_item", "item_id"),
        whole("id_pedido", "pedido_id"),
        same("cod_produto", "sku"),
        same("desc_produto", "description"),
        whole("qtd_pedida", "quantity"),
        number("preco_unitario", "unit_price"),
        total.alias("line_total"),
        instant("dt_criacao", "created_at"),
    )


# -- finance ---------------------------------------------------------------


def fin_nota_fiscal(raw: DataFrame) -> DataFrame:
    return raw.select(
        whole("id_nf", "nota_fiscal_id"),
        same("numero_nf", "numero"),
        same("serie_nf", "serie"),
        whole("id_pedido_erp_b", "pedido_id"),
        fn.digits("cnpj_cliente").alias("cnpj_cliente"),
        same("nome_cliente"),
        day("dt_emissao", "emissao_date"),
        number("valor_total", "total_value"),
        number("valor_impostos", "tax_value"),
        same("cnpj_transportadora"),
        same("nome_transportadora", "transportadora"),
        same("codigo_rastreio", "tracking_code"),
        day("dt_prevista_entrega", "expected_delivery_date"),
        fn.date_or_null("dt_entrega_real").alias("actual_delivery_date"),
        same("status_entrega", "delivery_status"),
        st.fin_delivery_status(F.col("status_entrega")).alias("delivery_status_normalized"),
        whole("qtd_entregue", "quantity_delivered"),
        instant("dt_criacao", "created_at"),
    )


# -- support ---------------------------------------------------------------


def support_organization(raw: DataFrame) -> DataFrame:
    return raw.select(
        whole("id", "organization_id"),
        same("name"),
        fn.valid_digits("external_id").alias("cnpj"),
        same("external_id", "external_id_raw"),
        instant("created_at"),
        instant("updated_at"),
    )


def support_user(raw: DataFrame) -> DataFrame:
    return raw.select(
        whole("id", "support_user_id"),
        same("name"),
        same("email"),
        whole("organization_id"),
        same("role"),
        flag("is_active"),
        instant("created_at"),
        instant("updated_at"),
    )


def support_ticket(raw: DataFrame) -> DataFrame:
    return raw.select(
        whole("id", "ticket_id"),
        same("subject"),
        same("description"),
        same("status"),
        same("priority"),
        whole("requester_id"),
        whole("assignee_id"),
        whole("organization_id"),
        text("custom_field_order_ref", "order_ref"),
        # here a missing tax id is the empty string, unlike everywhere else
        fn.digits(F.coalesce("custom_field_cnpj", F.lit(""))).alias("cnpj_cliente"),
        instant("created_at"),
        instant("updated_at"),
        instant("solved_at"),
    )


def support_ticket_tag(raw: DataFrame) -> DataFrame:
    return raw.select(whole("ticket_id"), same("tag"))


CLEAN: dict[str, Callable[[DataFrame], DataFrame]] = {
    f.__name__: f
    for f in (
        crm_user,
        crm_account,
        crm_product,
        crm_service_contract,
        crm_contract_line_item,
        erp_a_salesperson,
        erp_a_customer,
        erp_a_sales_order,
        erp_a_sales_order_item,
        erp_a_delivery,
        erp_a_invoice,
        erp_b_vendedor,
        erp_b_escola,
        erp_b_pedido,
        erp_b_item_pedido,
        fin_nota_fiscal,
        support_organization,
        support_user,
        support_ticket,
        support_ticket_tag,
    )
}
