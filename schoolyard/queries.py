"""The registered queries: name -> (Workspace -> DataFrame)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schoolyard import functions as fn
from schoolyard.operators import dense_months, joined_tags, run_checks
from schoolyard.plans import cards, declared, extensions, profile
from schoolyard.plans.clean import CLEAN
from schoolyard.plans.report import PARTS, Scope
from schoolyard.plans.workspace import Workspace
from schoolyard.sources.load import parsed, report_of
from schoolyard.sources.raw import RAW_TABLES, row_counts


def portable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text, so that clients agree on the value."""
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _clean(table: str) -> Callable[[Workspace], DataFrame]:
    return lambda ws: ws.clean[table]


# -- single operators ------------------------------------------------------


def normalize_keys(ws: Workspace) -> DataFrame:
    """Tax ids as written and as compared, for every record of four systems."""

    def side(system: str, table: str, key: str, raw: str) -> DataFrame:
        return ws.raw[table].select(
            F.lit(system).alias("source_system"),
            F.col(key).cast("string").alias("source_id"),
            F.col(raw).alias("raw_value"),
            fn.digits(raw).alias("digits"),
            fn.valid_digits(raw).alias("tax_id"),
        )

    return reduce(
        DataFrame.unionByName,
        [
            side("crm", "crm_account", "Id", "CNPJ__c"),
            side("erp_a", "erp_a_customer", "CardCode", "CNPJ"),
            side("erp_b", "erp_b_escola", "id_escola", "cnpj"),
            side("support", "support_organization", "id", "external_id"),
        ],
    )


def normalize_codes(ws: Workspace) -> DataFrame:
    """Contract numbers of three systems after normalisation, with their uses."""

    def side(system: str, table: str, raw: str) -> DataFrame:
        return ws.raw[table].select(
            F.lit(system).alias("source_system"), fn.norm_code(raw).alias("contract_number")
        )

    return (
        side("crm", "crm_service_contract", "ContractNumber")
        .unionByName(side("erp_a", "erp_a_sales_order", "NumAtCard"))
        .unionByName(side("erp_b", "erp_b_pedido", "num_contrato"))
        .groupBy("source_system", "contract_number")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def surrogate_keys(ws: Workspace) -> DataFrame:
    """Keys of all orders and order items; orders have no line part."""
    orders = ws.orders_unified.select(
        F.lit("order").alias("entity"),
        "source_system",
        "source_order_id",
        F.lit(None).cast("string").alias("source_line_id"),
        fn.surrogate_key("source_system", "source_order_id").alias("surrogate_key"),
        fn.surrogate_key("source_system", F.lit(None)).alias("key_of_missing_id"),
    )
    items = ws.order_items_unified.select(
        F.lit("order_item").alias("entity"),
        "source_system",
        "source_order_id",
        "source_line_id",
        fn.surrogate_key("source_system", "source_order_id", "source_line_id").alias(
            "surrogate_key"
        ),
        fn.surrogate_key("source_system", F.lit(None)).alias("key_of_missing_id"),
    )
    return orders.unionByName(items)


def typed_casts(ws: Workspace) -> DataFrame:
    """Every cast of the clean layer, from text, over all finance notes."""
    note = ws.raw["fin_nota_fiscal"]
    as_text = note.select(*[F.col(c).cast("string").alias(c) for c in note.columns])
    return as_text.select(
        F.col("id_nf").alias("id_text"),
        F.col("id_nf").cast("bigint").alias("as_bigint"),
        F.col("valor_total").cast("double").alias("as_double"),
        F.col("dt_emissao").cast("date").alias("as_date"),
        F.col("dt_criacao").cast("timestamp").alias("as_timestamp"),
        F.to_date(F.col("dt_criacao").cast("timestamp")).alias("timestamp_as_date"),
        F.when(F.col("status_entrega") == "entregue", "true")
        .otherwise("false")
        .cast("boolean")
        .alias("as_boolean"),
        fn.date_or_null("dt_entrega_real").alias("guarded_date"),
        F.lit(None).cast("string").alias("null_text"),
        F.lit(None).cast("bigint").alias("null_bigint"),
        F.lit(None).cast("double").alias("null_double"),
    )


def month_truncation(ws: Workspace) -> DataFrame:
    """Month and day of order dates and of ticket timestamps."""
    orders = ws.orders_unified.select(
        F.lit("order").alias("kind"),
        F.concat("source_system", F.lit(":"), "source_order_id").alias("id"),
        F.col("order_date").alias("day"),
        fn.month_of("order_date").alias("month"),
    )
    tickets = ws.clean["support_ticket"].select(
        F.lit("ticket").alias("kind"),
        F.col("ticket_id").cast("string").alias("id"),
        F.to_date("created_at").alias("day"),
        fn.month_of("created_at").alias("month"),
    )
    return orders.unionByName(tickets)


def elapsed_hours(ws: Workspace) -> DataFrame:
    return ws.clean["support_ticket"].select(
        "ticket_id",
        fn.elapsed_hours("created_at", "solved_at").alias("resolution_hours"),
        fn.elapsed_hours("solved_at", "created_at").alias("reversed_hours"),
    )


def days_between(ws: Workspace) -> DataFrame:
    return ws.clean["fin_nota_fiscal"].select(
        "nota_fiscal_id",
        fn.days_between("emissao_date", "actual_delivery_date").alias("days_to_delivery"),
        fn.days_between("expected_delivery_date", "actual_delivery_date").alias("days_late"),
    )


def line_totals(ws: Workspace) -> DataFrame:
    return ws.order_items_unified.select(
        "source_system", "source_order_id", "source_line_id", "quantity", "unit_price", "line_total"
    )


def month_spine(ws: Workspace) -> DataFrame:
    """Every school in every month with any activity."""
    schools = ws.schools.select("school_id")
    return schools.select("school_id", F.explode(ws.active_months().scalar()).alias("month"))


# -- checks ----------------------------------------------------------------


def _declared(kind: str) -> Callable[[Workspace], DataFrame]:
    return lambda ws: run_checks(declared.table_of(ws), declared.checks_of(kind))


def row_count_reconciliation(ws: Workspace) -> DataFrame:
    """Rows of each raw table beside the rows its clean table keeps."""
    raw = row_counts({t: ws.raw[t] for t in RAW_TABLES})
    clean = row_counts({t: ws.clean[t] for t in RAW_TABLES}).withColumnRenamed(
        "n_rows", "n_clean_rows"
    )
    return (
        raw.join(clean, "table_name")
        .withColumn("matches", F.col("n_rows") == F.col("n_clean_rows"))
        .orderBy("table_name")
    )


def _ticket_lines(ws: Workspace) -> DataFrame:
    """Tickets as the lines of 16 extracts, some of them damaged as transfers damage them."""
    tickets = ws.raw["support_ticket"]
    keep = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false"}
    keep["ignoreTrailingWhiteSpace"] = "false"
    written = F.to_csv(F.struct(*[F.col(c).cast("string").alias(c) for c in tickets.columns]), keep)
    damage = F.col("id") % 97
    line = (
        F.when(damage == 5, F.regexp_replace(written, ",[^,]*$", ""))
        .when(damage == 7, F.concat(written, F.lit(",x")))
        .when(damage == 11, F.concat(F.lit('"'), written))
        .otherwise(written)
    )
    file = F.concat(F.lit("support_ticket-"), (F.col("id") % 16).cast("string"), F.lit(".csv"))
    return parsed(tickets.select(file.alias("file"), line.alias("line")), "support_ticket")


def load_rejects(ws: Workspace) -> DataFrame:
    """The lines of the ticket extracts that a load sets aside, and why."""
    return (
        _ticket_lines(ws)
        .filter("reason IS NOT NULL")
        .select("file", "reason", F.regexp_extract("line", '^"?([0-9]+)', 1).alias("ticket"))
    )


def loaded_tickets(ws: Workspace) -> DataFrame:
    """Clean tickets from the lines that a load reads."""
    return CLEAN["support_ticket"](_ticket_lines(ws).filter("reason IS NULL").select("values.*"))


# -- profiles --------------------------------------------------------------


def key_match_rate(ws: Workspace) -> DataFrame:
    return profile.match_rate(
        ws.clean["crm_account"],
        "cnpj",
        {"erp_a": ws.clean["erp_a_customer"], "erp_b": ws.clean["erp_b_escola"]},
    )


def contract_match_rate(ws: Workspace) -> DataFrame:
    return profile.match_rate(
        ws.clean["crm_service_contract"],
        "contract_number",
        {"erp_a": ws.clean["erp_a_sales_order"], "erp_b": ws.clean["erp_b_pedido"]},
    )


def order_status_map(ws: Workspace) -> DataFrame:
    return profile.order_status_map(ws.raw["erp_a_sales_order"], ws.raw["erp_b_pedido"])


def fill_rate(ws: Workspace) -> DataFrame:
    return profile.fill_rate(
        ws.clean["support_ticket"],
        {
            "organization_id": F.col("organization_id").isNotNull(),
            "order_ref": F.col("order_ref").isNotNull(),
            "cnpj_cliente": F.col("cnpj_cliente") != "",
        },
    )


# -- cards -----------------------------------------------------------------


def _card(build: Callable, *parts: str) -> Callable[[Workspace], DataFrame]:
    """A card by month over what happened; the list of months comes last."""
    return lambda ws: build(ws.school_month_facts(parts), ws.card_months(parts))


def filtered_trend(ws: Workspace) -> DataFrame:
    scope = Scope(
        dt.date(2017, 1, 1), dt.date(2019, 12, 1), ws.schools.filter(F.col("state") == "ASIA")
    )
    return cards.trend(ws.school_month_facts(PARTS, scope), ws.card_months(PARTS, scope))


QUERIES: dict[str, Callable[[Workspace], DataFrame]] = {
    **{f"clean_{t}": _clean(t) for t in CLEAN},
    "normalize_keys": normalize_keys,
    "normalize_codes": normalize_codes,
    "surrogate_keys": surrogate_keys,
    "typed_casts": typed_casts,
    "month_truncation": month_truncation,
    "elapsed_hours": elapsed_hours,
    "days_between": days_between,
    "line_totals": line_totals,
    "order_status_map": order_status_map,
    "status_profile": lambda ws: profile.status_profile(order_status_map(ws)),
    "delivery_status_map": lambda ws: profile.delivery_status_map(ws.clean["fin_nota_fiscal"]),
    "delivery_valid_dates": lambda ws: ws.deliveries_unified,
    "invalid_dates": lambda ws: profile.invalid_dates(
        ws.raw["erp_a_delivery"].select(F.col("DocDate").cast("date").alias("delivery_date")),
        "delivery_date",
    ),
    "school_records": lambda ws: ws.school_records,
    "resolve_school": lambda ws: ws.schools,
    "school_directory": lambda ws: ws.school_directory,
    "account_managers": lambda ws: ws.account_managers,
    "contract_links": lambda ws: ws.contracts,
    "orders_unified": lambda ws: ws.orders_unified,
    "order_school_link": lambda ws: ws.orders,
    "order_items_unified": lambda ws: ws.order_items,
    "delivery_order_link": lambda ws: ws.deliveries,
    "ticket_tags": lambda ws: joined_tags(
        ws.clean["support_ticket_tag"], "ticket_id", "tag", "tags"
    ),
    "ticket_enriched": lambda ws: ws.tickets,
    "month_spine": month_spine,
    "monthly_school_metrics": lambda ws: ws.monthly_metrics(),
    "ytd_am_portfolio": lambda ws: ws.ytd_portfolio,
    "rfc_school_month_sales": lambda ws: profile.delivered_sales(
        ws.schools, ws.orders, ws.orders_unified, ws.order_lines, ws.order_drops
    ),
    "rfc_am_ytd_sales": lambda ws: profile.manager_sales(
        ws.account_managers,
        ws.contracts,
        ws.orders,
        ws.activity_of(ws.lines_of(ws.orders_of_the_year)),
        ws.reference_year,
    ),
    "cross_erp_duplicate_orders": lambda ws: profile.duplicate_orders_across_systems(
        ws.orders, ws.line_activity
    ),
    "cross_erp_similar_orders": lambda ws: profile.duplicate_orders_across_systems(
        ws.orders, ws.line_activity, tolerance=100_000
    ),
    "contract_reconciliation": lambda ws: extensions.contract_reconciliation(
        ws.contracts, ws.orders, ws.line_activity
    ),
    "network_rollup": lambda ws: extensions.network_rollup(
        ws.clean["crm_account"], ws.orders, ws.line_activity
    ),
    "proportional_delivery": lambda ws: extensions.proportional_delivery(
        ws.orders,
        ws.clean["erp_a_sales_order_item"],
        ws.clean["erp_b_item_pedido"],
        ws.clean["fin_nota_fiscal"],
    ),
    "manager_timeline": lambda ws: extensions.manager_timeline(ws.contracts),
    "school_timeline": lambda ws: ws.school_timeline,
    "order_manager_at_date": lambda ws: extensions.manager_at_date(ws.orders, ws.school_timeline),
    "mapped_schools": lambda ws: ws.mapped_schools,
    "mapping_conflicts": lambda ws: ws.mapping_problems.filter("problem IS NOT NULL"),
    "manager_brands": lambda ws: extensions.manager_brands(
        ws.contracts,
        ws.orders,
        ws.activity_of(ws.lines_of(ws.orders_of_the_year)),
        ws.reference_year,
    ),
    "dq_unique": _declared("unique"),
    "dq_not_null": _declared("not_null"),
    "dq_accepted_values": _declared("accepted_values"),
    "dq_relationships": _declared("relationships"),
    "dq_coverage": lambda ws: profile.coverage(declared.thresholds(ws)).unionByName(
        profile.group_checks(declared.duplicate_checks(ws)), allowMissingColumns=True
    ),
    "row_count_reconciliation": row_count_reconciliation,
    "load_report": lambda ws: report_of(_ticket_lines(ws)),
    "load_rejects": load_rejects,
    "loaded_tickets": loaded_tickets,
    "key_match_rate": key_match_rate,
    "contract_match_rate": contract_match_rate,
    "contract_overlap": lambda ws: profile.contract_overlap(ws.orders_unified, ws.line_activity),
    "delivery_coverage": lambda ws: profile.delivery_coverage(ws.orders_unified, ws.order_drops),
    "contracts_by_profile": lambda ws: profile.contracts_by_profile(
        ws.clean["crm_service_contract"], ws.clean["crm_user"]
    ),
    "fill_rate": fill_rate,
    "card_kpis": lambda ws: cards.kpis(ws.ytd_portfolio),
    "card_delivery_rate": lambda ws: cards.delivery_rate(ws.school_month_facts(["deliveries"])),
    "card_monthly_amount": _card(cards.monthly_amount, "items"),
    "card_monthly_orders": _card(cards.monthly_orders, "orders"),
    "card_monthly_delivery_rate": _card(cards.monthly_delivery_rate, "deliveries"),
    "card_state_volume": lambda ws: cards.state_volume(
        ws.school_month_facts(["deliveries"]), ws.schools, ws.active_months(summed=True)
    ),
    "card_monthly_tickets": _card(cards.monthly_tickets, "tickets"),
    "card_resolution_time": lambda ws: cards.resolution_time(
        ws.clean["support_ticket"], ws.reference_year
    ),
    "card_portfolio": lambda ws: cards.portfolio(ws.ytd_portfolio),
    "card_am_ranking": lambda ws: cards.manager_ranking(ws.ytd_portfolio),
    "card_top_schools": lambda ws: cards.top_schools(
        ws.school_month_facts(["items"]), ws.schools, ws.active_months()
    ),
    "card_board": lambda ws: cards.board(
        ws.school_month_facts(), ws.schools, ws.active_months(summed=True)
    ),
    "filtered_trend": filtered_trend,
    "school_trailing_year": lambda ws: cards.trailing_year(
        ws.school_month_facts(["orders", "items"]), ws.schools, ws.active_months()
    ),
}
