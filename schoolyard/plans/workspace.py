"""Wires raw tables to clean tables, entities and reports, lazily."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schoolyard import functions as fn
from schoolyard.operators import versions
from schoolyard.operators.overlay import closed_mapping, mapping_problems, overlaid
from schoolyard.plans import curated, report
from schoolyard.plans.clean import CLEAN
from schoolyard.session import prepare
from schoolyard.sources.star import StarSource


class _Clean(Mapping):
    def __init__(self, raw):
        self._raw = raw
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._built:
            self._built[table] = CLEAN[table](self._raw[table])
        return self._built[table]

    def __iter__(self):
        return iter(CLEAN)

    def __len__(self) -> int:
        return len(CLEAN)


class Workspace:
    """Every table of the model as a DataFrame over one set of raw tables.

    ``stored`` replaces entities by tables already written, which is how the full
    run keeps each entity from being computed again by its readers.
    """

    def __init__(
        self,
        raw,
        stored: Mapping[str, DataFrame] | None = None,
        mapping: DataFrame | None = None,
    ):
        if isinstance(raw, Mapping):  # a StarSource comes with a prepared session
            for df in raw.values():
                prepare(df.sparkSession)
                break
        self.raw = raw
        self.clean = _Clean(raw)
        self.stored = dict(stored or {})
        self.mapping = mapping

    @classmethod
    def over_star(cls, spark: SparkSession, folder: str) -> Workspace:
        source = StarSource(prepare(spark), folder)
        return cls(source, mapping=source._school_mapping())

    # -- school

    @cached_property
    def school_records(self) -> DataFrame:
        return curated.school_records(self.clean)

    @cached_property
    def mapping_problems(self) -> DataFrame:
        """Manual mappings of tax ids (source_tax_id, target_tax_id) with what is wrong."""
        seed = self.mapping
        if seed is None:  # none were made
            pair = [F.col("cnpj").alias("source_tax_id"), F.col("cnpj").alias("target_tax_id")]
            seed = self.school_records.select(*pair).filter(F.lit(False))
        return mapping_problems(
            seed, fn.valid_digits("source_tax_id"), fn.valid_digits("target_tax_id")
        )

    @cached_property
    def mapped_schools(self) -> DataFrame:
        """Schools after the manual mappings; records without a mapping are as before."""
        row_id = ["source_system", "source_id"]
        records = overlaid(
            self.school_records, "cnpj", closed_mapping(self.mapping_problems), row_id
        )
        return curated.schools(records)

    @cached_property
    def school_timeline(self) -> DataFrame:
        """Manager and brand of each school over time, from the terms of its contracts."""
        return versions(
            self.contracts.filter(~F.col("is_cancelled")),
            "school_id",
            "start_date",
            ["account_manager_id", "brand"],
            order="contract_id",
            ends="end_date",
        )

    @cached_property
    def school_directory(self) -> DataFrame:
        return curated.school_directory(self.school_records)

    @cached_property
    def schools(self) -> DataFrame:
        return self._entity("school", lambda: curated.schools(self.school_records))

    # -- manager, contract

    @cached_property
    def account_managers(self) -> DataFrame:
        return self._entity(
            "account_manager",
            lambda: curated.account_managers(
                self.clean["crm_user"],
                self.clean["crm_service_contract"],
                self.clean["crm_account"],
            ),
        )

    @cached_property
    def contracts(self) -> DataFrame:
        return self._entity(
            "contract",
            lambda: curated.contracts(
                self.clean["crm_service_contract"], self.school_directory, self.account_managers
            ),
        )

    # -- order and what hangs on it

    @cached_property
    def orders_unified(self) -> DataFrame:
        return curated.orders_unified(self.clean["erp_a_sales_order"], self.clean["erp_b_pedido"])

    @cached_property
    def order_keys(self) -> DataFrame:
        return curated.order_keys(self.orders_unified)

    @cached_property
    def orders(self) -> DataFrame:
        return self._entity(
            "order",
            lambda: curated.orders(self.orders_unified, self.contracts, self.school_directory),
        )

    @cached_property
    def order_items_unified(self) -> DataFrame:
        return curated.order_items_unified(
            self.clean["erp_a_sales_order_item"], self.clean["erp_b_item_pedido"]
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self._entity(
            "order_item", lambda: curated.order_items(self.order_items_unified, self.order_keys)
        )

    @cached_property
    def deliveries_unified(self) -> DataFrame:
        return curated.deliveries_unified(
            self.clean["erp_a_delivery"], self.clean["fin_nota_fiscal"]
        )

    @cached_property
    def deliveries(self) -> DataFrame:
        return self._entity(
            "delivery", lambda: curated.deliveries(self.deliveries_unified, self.order_keys)
        )

    # -- ticket

    @cached_property
    def organization_schools(self) -> DataFrame:
        return curated.organization_schools(self.school_directory)

    @cached_property
    def tickets(self) -> DataFrame:
        return self._entity(
            "ticket",
            lambda: curated.tickets(
                self.clean["support_ticket"],
                self.clean["support_ticket_tag"],
                self.organization_schools,
                self.order_keys,
            ),
        )

    # -- reports

    def active_months(self, summed: bool = False) -> DataFrame:
        return report.active_months(
            self.orders_unified, self.order_drops, self.clean["support_ticket"], summed
        )

    @cached_property
    def order_lines(self) -> dict[str, DataFrame]:
        """Lines of each ERP under that ERP's own order number."""
        return curated.order_lines(
            self.clean["erp_a_sales_order_item"], self.clean["erp_b_item_pedido"]
        )

    @cached_property
    def order_drops(self) -> dict[str, DataFrame]:
        """Deliveries of each ERP's orders under that ERP's own order number."""
        return curated.order_drops(self.clean["erp_a_delivery"], self.clean["fin_nota_fiscal"])

    def lines_of(self, orders: DataFrame) -> dict[str, DataFrame]:
        """The lines that may belong to some of the orders, left out before any shuffle."""
        return report.facts_of(self.order_lines, orders)

    def activity_of(self, lines: Mapping[str, DataFrame]) -> DataFrame:
        """Amount and quantity of every order that has lines."""
        return report.activity_per_order(
            {system: [report.lines_per_order(df)] for system, df in lines.items()}
        )

    @cached_property
    def line_activity(self) -> DataFrame:
        return self.activity_of(self.order_lines)

    @cached_property
    def orders_of_the_year(self) -> DataFrame:
        """Orders of the reference year that are not cancelled, before any link."""
        of_year = fn.in_year("order_date", self.reference_year.scalar())
        return self.orders_unified.filter(~F.col("is_cancelled") & of_year)

    def school_month_facts(
        self, parts: Collection[str] = report.PARTS, scope: report.Scope = report.EVERYTHING
    ) -> DataFrame:
        """What happened, by school and month; a written report serves as well."""
        if "monthly" in self.stored:
            return report.in_scope(self.stored["monthly"], scope)
        lines = self.order_lines
        if scope.bounded and "items" in parts:
            lines = self.lines_of(self.orders_unified.filter(scope.holds("order_date")))
        return report.school_month_facts(
            self.orders,
            lines,
            self.order_drops,
            self.clean["support_ticket"],
            self.organization_schools,
            parts,
            scope,
        )

    def card_months(self, parts: Collection[str], scope: report.Scope = report.EVERYTHING):
        """The months a card lists: all active ones in scope, if there is a school at all."""
        months = self.active_months(summed="deliveries" in parts)
        listed = months.select(F.explode("months").alias("month")).filter(scope.holds("month"))
        some = scope.schools if scope.schools is not None else self.school_directory
        return listed.filter(some.limit(1).agg(F.count(F.lit(1))).scalar() > 0)

    def monthly_metrics(self, parts: Collection[str] = report.PARTS) -> DataFrame:
        if "monthly" in self.stored:
            return self.stored["monthly"]
        return report.monthly_metrics(
            self.schools,
            self.school_month_facts(parts),
            self.active_months(summed="deliveries" in parts),
        )

    @cached_property
    def reference_year(self) -> DataFrame:
        return report.reference_year(self.orders_unified)

    @cached_property
    def ytd_portfolio(self) -> DataFrame:
        return self._entity(
            "ytd",
            lambda: report.ytd_portfolio(
                self.account_managers,
                self.contracts,
                self.orders,
                self.lines_of(self.orders_of_the_year),
                self.clean["support_ticket"],
                self.reference_year,
            ),
        )

    def _entity(self, name: str, build) -> DataFrame:
        return self.stored[name] if name in self.stored else build()
