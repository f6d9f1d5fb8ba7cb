"""Raw extracts: explicit all-text schemas, CSV scan, load reconciliation."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The raw tables and their columns.  Every column is read as text:
# inferring types would turn a tax id such as 01438889937567 into a number and
# lose its leading zero.
RAW_COLUMNS = {
    "crm_user": "Id Name Email ProfileName IsActive CreatedDate LastModifiedDate",
    "crm_account": "Id Name RazaoSocial__c CNPJ__c Type ParentId Phone BillingCity BillingState "
    "SalesModality__c Segment__c OwnerId IsDeleted CreatedDate LastModifiedDate",
    "crm_product": "Id ProductCode Name Brand__c MaterialType__c IsActive CreatedDate",
    "crm_service_contract": "Id ContractNumber Name AccountId OwnerId Status StartDate EndDate "
    "Brand__c GrandTotal TotalPrice Discount MarketingModel__c IsDeleted CreatedDate "
    "LastModifiedDate",
    "crm_contract_line_item": "Id ServiceContractId ProductId MaterialType__c SchoolGrade__c "
    "Segment__c Quantity UnitPrice Discount TotalPrice CreatedDate",
    "erp_a_salesperson": "SlpCode SlpName Memo Active",
    "erp_a_customer": "CardCode CardName CNPJ City State Phone1 E_Mail SlpCode CreateDate "
    "UpdateDate",
    "erp_a_sales_order": "DocEntry DocNum CardCode NumAtCard DocDate DocDueDate Cancelled "
    "DocStatus Comments SlpCode CreateDate UpdateDate",
    "erp_a_sales_order_item": "DocEntry LineNum ItemCode ItemName Quantity DelivrdQty OpenQty "
    "ShipDate LineStatus Price LineTotal",
    "erp_a_delivery": "DocEntry DocNum CardCode BaseEntry DocDate DocStatus Cancelled CreateDate",
    "erp_a_invoice": "DocEntry DocNum CardCode BaseEntry DocDate DocTotal VatSum Cancelled "
    "CreateDate",
    "erp_b_vendedor": "id_vendedor nome email regiao ativo",
    "erp_b_escola": "id_escola nome_escola cnpj cidade estado email id_vendedor dt_cadastro "
    "dt_atualizacao",
    "erp_b_pedido": "id_pedido id_escola num_contrato dt_pedido dt_entrega_prevista status "
    "id_vendedor dt_criacao dt_atualizacao",
    "erp_b_item_pedido": "id_item id_pedido cod_produto desc_produto qtd_pedida preco_unitario "
    "dt_criacao",
    "fin_nota_fiscal": "id_nf numero_nf serie_nf id_pedido_erp_b cnpj_cliente nome_cliente "
    "dt_emissao valor_total valor_impostos cnpj_transportadora nome_transportadora "
    "codigo_rastreio dt_prevista_entrega dt_entrega_real status_entrega qtd_entregue dt_criacao",
    "support_organization": "id name details external_id domain_names created_at updated_at",
    "support_user": "id name email organization_id role is_active created_at updated_at",
    "support_ticket": "id subject description status priority requester_id assignee_id "
    "organization_id custom_field_order_ref custom_field_cnpj created_at updated_at solved_at",
    "support_ticket_tag": "ticket_id tag",
}

RAW_TABLES = tuple(RAW_COLUMNS)


def raw_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table].split()])


def read_csv(
    spark: SparkSession, folder: str, table: str, multiline: bool = False
) -> DataFrame:
    """Scan ``<folder>/<table>.csv`` (a file or a folder of part files) as text.

    Quoted line breaks need ``multiline``, which reads each file in one task; leave
    it off for large files, which are then split.

    The header is checked against the declared columns: a moved or renamed column
    fails the load instead of shifting values into the wrong place.
    """
    return (
        spark.read.schema(raw_schema(table))
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("multiLine", multiline)
        .csv(f"{folder.rstrip('/')}/{table}.csv")
    )


def read_csv_all(
    spark: SparkSession, folder: str, multiline: Collection[str] = ()
) -> dict[str, DataFrame]:
    """All extracts; ``multiline`` names the tables whose texts may hold quoted line breaks."""
    unknown = set(multiline) - set(RAW_TABLES)
    if unknown:
        raise ValueError(f"no such tables: {sorted(unknown)}")
    return {t: read_csv(spark, folder, t, t in multiline) for t in RAW_TABLES}


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows, sorted by table name."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted).orderBy("table_name")


def reconcile(tables: Mapping[str, DataFrame], expected: Mapping[str, int]) -> DataFrame:
    """Row counts beside the expected ones, with a match flag."""
    pairs = [x for name, n in expected.items() for x in (F.lit(name), F.lit(n).cast("bigint"))]
    want = F.create_map(*pairs)[F.col("table_name")]
    return (
        row_counts(tables)
        .withColumn("expected_rows", want)
        .withColumn("matches", F.col("n_rows").eqNullSafe(F.col("expected_rows")))
        .orderBy("table_name")
    )
