"""The 20 raw tables, derived from a TPC-H-like star and an event stream.

Every rule is row-local, except that a contract is one row per customer and year
and a delivery is one row per order; those two aggregate before anything joins.
The share of rows each system receives is a rule on the key, and the shares add
up to the whole: every order is in ERP A or ERP B, every line is an item of one
of them, every event is a ticket, every customer is in at least one system.

Numbers, dates and timestamps keep their types, so the casts of the clean step
fold away; what the source systems hold as text (tax ids, flags, codes, statuses,
the empty-string date) is text here too.

Dates are moved by 20 years and events back by 3, which puts both inside the
delivery window 2010..2030 and the events into the last order year.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Vocabularies of the source systems.
PROFILES = ("Account Manager", "CS Manager", "Admin", "Sales Rep")
ERP_B_SPELLINGS = (
    "C", "cancelado", "cancelled", "CANCELLED",
    "A", "P", "pending", "PENDING", "pendente", "em_andamento", "IN_PROGRESS",
    "E", "entregue", "delivered", "DELIVERED",
)
FIN_STATES = ("entregue", "em_transito", "extraviado", "devolvido", "aguardando_coleta")
PRIORITIES = ("low", "normal", "high", "urgent")
TICKET_STATES = {
    "view": "closed",
    "purchase": "solved",
    "click": "open",
    "signup": "new",
    "error": "pending",
}

CODE_DIGITS = 12


def _pick(options: tuple[str, ...], index: Column) -> Column:
    return F.array(*[F.lit(o) for o in options])[index.cast("int")]


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _tag(prefix: str, key: Column | str) -> Column:
    return F.concat(F.lit(prefix), _text(key))


def _padded(key: Column | str, digits: int) -> Column:
    """At least so many digits; a longer key keeps all of its own."""
    text = _text(key)
    return F.lpad(text, F.greatest(F.length(text), F.lit(digits)), F.lit("0"))


def _tax_id(key: Column | str) -> Column:
    return _padded(key, 14)


def _split(d: Column) -> list[Column]:
    return [d.substr(1, 2), d.substr(3, 3), d.substr(6, 3), d.substr(9, 4), d.substr(13, 2)]


def _dotted(d: Column) -> Column:
    a, b, c, e, f = _split(d)
    return F.concat(a, F.lit("."), b, F.lit("."), c, F.lit("/"), e, F.lit("-"), f)


def _spaced(d: Column) -> Column:
    return F.concat_ws(" ", *_split(d))


def _day(c: str) -> Column:
    return F.add_months(F.to_date(F.col(c)), 240)


def _cents(amount: Column, by: Column) -> Column:
    return F.floor(amount * 100 / by) / F.lit(100.0)


def _flag(test: Column, yes: str, no: str) -> Column:
    return F.when(test, F.lit(yes)).otherwise(F.lit(no))


def _since(key: str) -> Column:
    """A registration day that varies with the key."""
    return F.date_add(F.lit("2012-01-01").cast("date"), (F.col(key) % 1000).cast("int"))


def _contract_number(key: Column, year: Column) -> Column:
    return F.concat(
        F.lit("CT-"), _text(year), F.lit("-"), _padded(key, CODE_DIGITS)
    )


class StarSource:
    """Lazy raw tables over one folder of star-schema Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder.rstrip("/")
        self._rules: dict[str, Callable[[], DataFrame]] = {
            name: getattr(self, name)
            for name in dir(type(self))
            if not name.startswith("_")
        }
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._built:
            self._built[table] = self._rules[table]()
        return self._built[table]

    def __iter__(self):
        return iter(self._rules)

    def _read(self, table: str) -> DataFrame:
        # listing files and reading footers once per table, not once per use
        if table not in self._built:
            self._built[table] = self._spark.read.parquet(f"{self._folder}/{table}.parquet")
        return self._built[table]

    def _places(self, df: DataFrame, nation_key: str) -> DataFrame:
        # Grouping by the key shows Catalyst that a nation cannot multiply rows, so
        # the join goes away wherever city and state are not asked for.
        places = (
            self._read("nation")
            .join(self._read("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .groupBy("n_nationkey")
            .agg(F.min("n_name").alias("n_name"), F.min("r_name").alias("r_name"))
        )
        return df.join(places, F.col(nation_key) == F.col("n_nationkey"), "left")

    def _school_mapping(self) -> DataFrame:
        """Manual mappings of tax ids, as people write them: chains, cycles, contradictions."""
        k = F.col("c_custkey")

        def to(rule: Column, key: Column) -> Column:
            return F.when(rule, _tax_id(key))

        targets = F.array(
            to((k % 40 == 1) | (k % 80 == 2) | (k % 60 == 9), k + 1),
            to((k % 90 == 5) | (k % 60 == 9), k + 2),
            to(k % 90 == 7, k - 2),
            F.when(k % 100 == 14, "n/a"),
        )
        return self._read("customer").select(
            _dotted(_tax_id(k)).alias("source_tax_id"),
            F.explode(F.array_compact(targets)).alias("target_tax_id"),
        )

    # -- CRM ---------------------------------------------------------------

    def crm_user(self) -> DataFrame:
        k = F.col("n_nationkey")
        return self._read("nation").select(
            _tag("U", k).alias("Id"),
            F.col("n_name").alias("Name"),
            F.concat(F.lower("n_name"), F.lit("@crm.example")).alias("Email"),
            _pick(PROFILES, k % 4).alias("ProfileName"),
            (k % 5 != 4).alias("IsActive"),
            _since("n_nationkey").cast("timestamp").alias("CreatedDate"),
            _since("n_nationkey").cast("timestamp").alias("LastModifiedDate"),
        )

    def crm_account(self) -> DataFrame:
        k = F.col("c_custkey")
        in_crm = self._read("customer").filter(k % 10 < 7)
        return self._places(in_crm, "c_nationkey").select(
            _tag("A", k).alias("Id"),
            F.col("c_name").alias("Name"),
            F.concat(F.col("c_name"), F.lit(" SA")).alias("RazaoSocial__c"),
            _dotted(_tax_id(k)).alias("CNPJ__c"),
            _flag(k % 8 == 0, "Network", "School").alias("Type"),
            F.when(k % 8 != 0, _tag("A", k - k % 8)).alias("ParentId"),
            _tag("+55 ", k).alias("Phone"),
            F.col("n_name").alias("BillingCity"),
            F.col("r_name").alias("BillingState"),
            _flag(F.col("c_acctbal") >= 0, "direct", "partner").alias("SalesModality__c"),
            F.col("c_mktsegment").alias("Segment__c"),
            _tag("U", k % 20).alias("OwnerId"),
            (k % 25 == 1).alias("IsDeleted"),
            _since("c_custkey").cast("timestamp").alias("CreatedDate"),
            _since("c_custkey").cast("timestamp").alias("LastModifiedDate"),
        )

    def crm_product(self) -> DataFrame:
        return self._read("part").select(
            _tag("P", "p_partkey").alias("Id"),
            _text("p_partkey").alias("ProductCode"),
            F.col("p_name").alias("Name"),
            F.col("p_brand").alias("Brand__c"),
            F.col("p_type").alias("MaterialType__c"),
            (F.col("p_size") % 2 == 0).alias("IsActive"),
            _since("p_partkey").cast("timestamp").alias("CreatedDate"),
        )

    def crm_service_contract(self) -> DataFrame:
        yearly = (
            self._read("orders")
            .filter(F.col("o_custkey") % 10 < 7)
            .groupBy(
                F.col("o_custkey").alias("k"), F.year(_day("o_orderdate")).cast("bigint").alias("y")
            )
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
        )
        k, y, total = F.col("k"), F.col("y"), F.col("total").cast("double")
        start = F.make_date(y.cast("int"), F.lit(1), F.lit(15))
        return yearly.select(
            F.concat(_tag("K", k), F.lit("-"), _text(y)).alias("Id"),
            F.concat(F.lit(" "), F.lower(_contract_number(k, y))).alias("ContractNumber"),
            F.concat(F.lit("Contract "), _text(y)).alias("Name"),
            _tag("A", k).alias("AccountId"),
            _tag("U", k % 18).alias("OwnerId"),
            _flag((k + y) % 11 == 0, "Cancelled", "Activated").alias("Status"),
            start.alias("StartDate"),
            F.make_date(y.cast("int"), F.lit(12), F.lit(31)).alias("EndDate"),
            _tag("Brand#", k % 25).alias("Brand__c"),
            total.alias("GrandTotal"),
            total.alias("TotalPrice"),
            F.lit(0.0).alias("Discount"),
            _flag(k % 2 == 0, "full", "basic").alias("MarketingModel__c"),
            ((k + y) % 29 == 0).alias("IsDeleted"),
            start.cast("timestamp").alias("CreatedDate"),
            start.cast("timestamp").alias("LastModifiedDate"),
        )

    def crm_contract_line_item(self) -> DataFrame:
        o, k = F.col("o_orderkey"), F.col("o_custkey")
        in_crm = self._read("orders").filter(k % 10 < 7)
        quantity = o % 5 + 1
        return in_crm.select(
            _tag("L", o).alias("Id"),
            F.concat(_tag("K", k), F.lit("-"), _text(F.year(_day("o_orderdate")))).alias(
                "ServiceContractId"
            ),
            _tag("P", o % 200).alias("ProductId"),
            _pick(("book", "kit", "digital"), o % 3).alias("MaterialType__c"),
            _tag("grade ", o % 9 + 1).alias("SchoolGrade__c"),
            F.col("o_orderpriority").alias("Segment__c"),
            quantity.alias("Quantity"),
            _cents(F.col("o_totalprice"), quantity.cast("double")).alias("UnitPrice"),
            F.lit(0.0).alias("Discount"),
            F.col("o_totalprice").alias("TotalPrice"),
            _day("o_orderdate").cast("timestamp").alias("CreatedDate"),
        )

    # -- ERP A: even order keys --------------------------------------------

    def erp_a_salesperson(self) -> DataFrame:
        return self._places(self._read("supplier"), "s_nationkey").select(
            F.col("s_suppkey").alias("SlpCode"),
            F.col("s_name").alias("SlpName"),
            F.col("r_name").alias("Memo"),
            _flag(F.col("s_acctbal") >= 0, "Y", "N").alias("Active"),
        )

    def erp_a_customer(self) -> DataFrame:
        k = F.col("c_custkey")
        return self._places(self._read("customer").filter(k % 3 != 1), "c_nationkey").select(
            _tag("C", k).alias("CardCode"),
            F.concat(F.col("c_name"), F.lit(" A")).alias("CardName"),
            _tax_id(k).alias("CNPJ"),
            F.col("n_name").alias("City"),
            F.col("r_name").alias("State"),
            _tag("+55 ", k).alias("Phone1"),
            F.concat(_tag("a", k), F.lit("@school.example")).alias("E_Mail"),
            (k % 100).alias("SlpCode"),
            _since("c_custkey").alias("CreateDate"),
            _since("c_custkey").alias("UpdateDate"),
        )

    def erp_a_sales_order(self) -> DataFrame:
        o, k = F.col("o_orderkey"), F.col("o_custkey")
        day = _day("o_orderdate")
        return (
            self._read("orders")
            .filter(o % 2 == 0)
            .select(
                o.alias("DocEntry"),
                (o + 1_000_000).alias("DocNum"),
                _tag("C", k).alias("CardCode"),
                F.when(o % 5 != 0, _contract_number(k, F.year(day))).alias("NumAtCard"),
                day.alias("DocDate"),
                F.date_add(day, 30).alias("DocDueDate"),
                _flag(F.col("o_orderpriority") == "5-LOW", "Y", "N").alias("Cancelled"),
                _flag(F.col("o_orderstatus") == "O", "O", "C").alias("DocStatus"),
                F.col("o_orderpriority").alias("Comments"),
                (k % 100).alias("SlpCode"),
                day.alias("CreateDate"),
                day.alias("UpdateDate"),
            )
        )

    def _line_number(self) -> Column:
        # (order, line number) repeats in the star; ship day and part complete it.
        ship_day = F.datediff(_day("l_shipdate"), F.lit("2010-01-01").cast("date"))
        return (
            F.col("l_linenumber").cast("bigint")
            + ship_day.cast("bigint") * 8
            + F.col("l_partkey") * (8 * 65536)
        )

    def erp_a_sales_order_item(self) -> DataFrame:
        shipped = F.col("l_linestatus") == "F"
        quantity = F.col("l_quantity")
        return (
            self._read("lineitem")
            .filter(F.col("l_orderkey") % 2 == 0)
            .select(
                F.col("l_orderkey").alias("DocEntry"),
                self._line_number().alias("LineNum"),
                _text("l_partkey").alias("ItemCode"),
                F.concat(F.lit("Item "), _text("l_partkey")).alias("ItemName"),
                quantity.alias("Quantity"),
                F.when(shipped, quantity).otherwise(F.lit(0.0)).alias("DelivrdQty"),
                F.when(shipped, F.lit(0.0)).otherwise(quantity).alias("OpenQty"),
                _day("l_shipdate").alias("ShipDate"),
                _flag(shipped, "C", "O").alias("LineStatus"),
                _cents(F.col("l_extendedprice"), quantity).alias("Price"),
                F.col("l_extendedprice").alias("LineTotal"),
            )
        )

    def _shipped_orders(self, remainder: int) -> DataFrame:
        """Shipped lines of one system, summed up per order."""
        return (
            self._read("lineitem")
            .filter((F.col("l_orderkey") % 2 == remainder) & (F.col("l_linestatus") == "F"))
            .groupBy(F.col("l_orderkey").alias("o"))
            .agg(
                F.min(_day("l_shipdate")).alias("first_day"),
                F.max(_day("l_shipdate")).alias("last_day"),
                F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
                F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("total"),
                F.sum((F.col("l_extendedprice") * F.col("l_tax")).cast("decimal(18,4)")).alias(
                    "tax"
                ),
                F.max("l_suppkey").alias("carrier"),
            )
        )

    def erp_a_delivery(self) -> DataFrame:
        o, day = F.col("o"), F.col("last_day")
        return self._shipped_orders(0).select(
            o.alias("DocEntry"),
            (o + 2_000_000).alias("DocNum"),
            _tag("C", "carrier").alias("CardCode"),
            o.alias("BaseEntry"),
            # a planted typo in the year: 22xx for 20xx
            F.when(o % 97 == 0, F.add_months(day, 2400)).otherwise(day).alias("DocDate"),
            _flag(o % 4 == 0, "O", "C").alias("DocStatus"),
            _flag(o % 13 == 0, "Y", "N").alias("Cancelled"),
            F.col("first_day").alias("CreateDate"),
        )

    def erp_a_invoice(self) -> DataFrame:
        o = F.col("o")
        return self._shipped_orders(0).select(
            o.alias("DocEntry"),
            (o + 3_000_000).alias("DocNum"),
            _tag("C", "carrier").alias("CardCode"),
            o.alias("BaseEntry"),
            F.col("last_day").alias("DocDate"),
            F.col("total").cast("double").alias("DocTotal"),
            F.col("tax").cast("double").alias("VatSum"),
            _flag(o % 13 == 0, "Y", "N").alias("Cancelled"),
            F.col("first_day").alias("CreateDate"),
        )

    # -- ERP B: odd order keys ---------------------------------------------

    def erp_b_vendedor(self) -> DataFrame:
        return self._places(self._read("supplier"), "s_nationkey").select(
            F.col("s_suppkey").alias("id_vendedor"),
            F.col("s_name").alias("nome"),
            F.concat(_tag("v", "s_suppkey"), F.lit("@erp.example")).alias("email"),
            F.col("n_name").alias("regiao"),
            _flag(F.col("s_suppkey") % 3 != 0, "S", "N").alias("ativo"),
        )

    def erp_b_escola(self) -> DataFrame:
        k = F.col("c_custkey")
        d = _tax_id(k)
        return self._places(self._read("customer").filter(k % 3 != 0), "c_nationkey").select(
            k.alias("id_escola"),
            F.concat(F.col("c_name"), F.lit(" B")).alias("nome_escola"),
            F.when(k % 2 == 1, _spaced(d)).otherwise(d).alias("cnpj"),
            F.col("n_name").alias("cidade"),
            F.col("r_name").alias("estado"),
            F.concat(_tag("b", k), F.lit("@school.example")).alias("email"),
            (k % 100).alias("id_vendedor"),
            _since("c_custkey").alias("dt_cadastro"),
            _since("c_custkey").alias("dt_atualizacao"),
        )

    def erp_b_pedido(self) -> DataFrame:
        o, k = F.col("o_orderkey"), F.col("o_custkey")
        day = _day("o_orderdate")
        number = F.lower(_contract_number(k, F.year(day)))
        padded = F.when(o % 4 == 1, F.concat(F.lit("\t "), number, F.lit("  "))).otherwise(number)
        return (
            self._read("orders")
            .filter(o % 2 == 1)
            .select(
                o.alias("id_pedido"),
                k.alias("id_escola"),
                F.when(o % 7 != 0, padded).alias("num_contrato"),
                day.alias("dt_pedido"),
                F.date_add(day, 45).alias("dt_entrega_prevista"),
                _pick(ERP_B_SPELLINGS, o % 15).alias("status"),
                (k % 100).alias("id_vendedor"),
                day.cast("timestamp").alias("dt_criacao"),
                day.cast("timestamp").alias("dt_atualizacao"),
            )
        )

    def erp_b_item_pedido(self) -> DataFrame:
        quantity = F.col("l_quantity")
        return (
            self._read("lineitem")
            .filter(F.col("l_orderkey") % 2 == 1)
            .select(
                self._line_number().alias("id_item"),
                F.col("l_orderkey").alias("id_pedido"),
                _text("l_partkey").alias("cod_produto"),
                F.concat(F.lit("Item "), _text("l_partkey")).alias("desc_produto"),
                quantity.cast("bigint").alias("qtd_pedida"),
                _cents(F.col("l_extendedprice"), quantity).alias("preco_unitario"),
                _day("l_shipdate").cast("timestamp").alias("dt_criacao"),
            )
        )

    # -- finance -----------------------------------------------------------

    def fin_nota_fiscal(self) -> DataFrame:
        o, first, last = F.col("o"), F.col("first_day"), F.col("last_day")
        carrier = F.col("carrier")
        return self._shipped_orders(1).select(
            o.alias("id_nf"),
            _tag("NF-", o).alias("numero_nf"),
            F.lit("1").alias("serie_nf"),
            o.alias("id_pedido_erp_b"),
            _dotted(_tax_id(carrier)).alias("cnpj_cliente"),
            _tag("Client ", carrier).alias("nome_cliente"),
            first.alias("dt_emissao"),
            F.col("total").cast("double").alias("valor_total"),
            F.col("tax").cast("double").alias("valor_impostos"),
            _tax_id(carrier).alias("cnpj_transportadora"),
            _tag("Carrier ", carrier).alias("nome_transportadora"),
            _tag("TRK", o).alias("codigo_rastreio"),
            F.date_add(first, 10).alias("dt_prevista_entrega"),
            F.when(o % 3 == 0, F.lit("")).otherwise(_text(last)).alias("dt_entrega_real"),
            _pick(FIN_STATES, o % 5).alias("status_entrega"),
            F.col("quantity").alias("qtd_entregue"),
            first.cast("timestamp").alias("dt_criacao"),
        )

    # -- support -----------------------------------------------------------

    def support_organization(self) -> DataFrame:
        k = F.col("c_custkey")
        return (
            self._read("customer")
            .filter(k % 2 == 0)
            .select(
                k.alias("id"),
                F.concat(F.col("c_name"), F.lit(" S")).alias("name"),
                F.lit(None).cast("string").alias("details"),
                F.when(k % 4 == 0, _tax_id(k)).when(k % 8 == 2, "n/a").alias("external_id"),
                F.lit(None).cast("string").alias("domain_names"),
                _since("c_custkey").cast("timestamp").alias("created_at"),
                _since("c_custkey").cast("timestamp").alias("updated_at"),
            )
        )

    def support_user(self) -> DataFrame:
        k = F.col("c_custkey")
        return self._read("customer").select(
            k.alias("id"),
            F.col("c_name").alias("name"),
            F.concat(_tag("s", k), F.lit("@school.example")).alias("email"),
            (k - k % 2).alias("organization_id"),
            _pick(("end-user", "agent", "admin"), k % 3).alias("role"),
            (k % 6 != 0).alias("is_active"),
            _since("c_custkey").cast("timestamp").alias("created_at"),
            _since("c_custkey").cast("timestamp").alias("updated_at"),
        )

    def support_ticket(self) -> DataFrame:
        e, u = F.col("event_id"), F.col("user_id")
        opened = F.expr("ts - INTERVAL '3' YEAR").cast("timestamp")
        minutes = F.floor(F.col("value") * 60)
        solved = F.when(
            F.col("event_type").isin("view", "purchase"),
            F.timestamp_add("MINUTE", minutes, opened),
        )
        status = F.create_map(*[F.lit(x) for pair in TICKET_STATES.items() for x in pair])
        return self._read("events").select(
            e.alias("id"),
            F.concat(F.lit("About "), F.col("event_type")).alias("subject"),
            F.col("props").alias("description"),
            status[F.col("event_type")].alias("status"),
            _pick(PRIORITIES, e % 4).alias("priority"),
            u.alias("requester_id"),
            (u % 10).alias("assignee_id"),
            F.when(e % 10 != 0, u).alias("organization_id"),
            F.when(e % 5 < 2, _text(e)).alias("custom_field_order_ref"),
            F.when(e % 3 == 0, _dotted(_tax_id(u))).alias("custom_field_cnpj"),
            opened.alias("created_at"),
            F.coalesce(solved, opened).alias("updated_at"),
            solved.alias("solved_at"),
        )

    def support_ticket_tag(self) -> DataFrame:
        e, kind = F.col("event_id"), F.col("event_type")
        tags = F.when(e % 2 == 0, F.array(kind, F.lit("even"))).otherwise(F.array(kind))
        return self._read("events").select(e.alias("ticket_id"), F.explode(tags).alias("tag"))
