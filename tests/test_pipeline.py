"""CSV extracts to written tables: every layer, with hand-computed results."""

from __future__ import annotations

import datetime as dt

import extracts
import pytest
from pyspark.sql import functions as F

from schoolyard.functions import surrogate_key
from schoolyard.plans import declared, pipeline
from schoolyard.plans.clean import CLEAN
from schoolyard.plans.workspace import Workspace
from schoolyard.sources.names import clean_name, curated_name, report_name
from schoolyard.sources.raw import (
    RAW_COLUMNS,
    RAW_TABLES,
    raw_schema,
    read_csv,
    read_csv_all,
    reconcile,
)
from schoolyard.sources.tables import STAMP, Store

D = dt.date
ONE, TWO = "A1", "A2"
FOUR, SIX, SEVEN, NINE = ("NCRM-" + str(n) * 14 for n in (4, 6, 7, 9))


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return read_csv_all(spark, extracts.write(str(tmp_path_factory.mktemp("extracts"))))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    return Store(spark, str(tmp_path_factory.mktemp("tables")))


@pytest.fixture(scope="module")
def ws(raw, store):
    return pipeline.run(raw, store)


def rows(df, key, *columns):
    return {
        (r[key] if isinstance(key, str) else tuple(r[k] for k in key)): tuple(r[c] for c in columns)
        for r in df.collect()
    }


def test_raw_columns_are_text_and_keep_leading_zeros(raw):
    assert all(df.schema == raw_schema(t) for t, df in raw.items())
    assert raw["erp_a_customer"].filter("CardCode = 'C1'").first().CNPJ == "01438889937567"


def test_csv_with_moved_columns_fails(spark, tmp_path):
    (tmp_path / "support_ticket_tag.csv").write_text("tag,ticket_id\nx,1\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_csv(spark, str(tmp_path), "support_ticket_tag").collect()


def test_csv_with_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "support_ticket_tag.csv").write_text('ticket_id,tag\n1,"a\nb"\n')
    got = read_csv(spark, str(tmp_path), "support_ticket_tag", multiline=True).collect()
    assert [tuple(r) for r in got] == [("1", "a\nb")]


def test_reconcile_flags_missing_rows(raw):
    expected = {t: len(extracts.ROWS[t]) for t in RAW_TABLES} | {"crm_user": 40}
    got = reconcile(raw, expected).collect()
    assert [r.table_name for r in got] == sorted(RAW_TABLES)
    assert {r.table_name for r in got if not r.matches} == {"crm_user"}


def test_clean_views_carry_the_layer_names(spark, ws):
    names = pipeline.clean_views(ws)
    assert names["crm_account"] == clean_name("crm_account")
    assert spark.table(names["erp_a_delivery"]).count() == 3
    assert len(names) == len(CLEAN) == len(RAW_COLUMNS) == 20


def test_clean_types_from_text(ws):
    types = {t: dict(ws.clean[t].dtypes) for t in CLEAN}
    assert types["crm_user"]["is_active"] == "boolean"
    assert types["crm_contract_line_item"] | {"quantity": "bigint", "unit_price": "double"} == types[
        "crm_contract_line_item"
    ]
    assert types["erp_a_sales_order"]["order_date"] == "date"
    assert types["support_ticket"]["solved_at"] == "timestamp"


def test_clean_tables_that_feed_no_entity(ws):
    item = ws.clean["crm_contract_line_item"].first()
    assert (item.quantity, item.unit_price, item.discount, item.total_price) == (3, 10.5, 0.1, 31.4)
    assert rows(ws.clean["erp_a_salesperson"], "salesperson_code", "is_active") == {
        1: (True,),
        2: (False,),
        3: (None,),
    }
    assert rows(ws.clean["erp_b_vendedor"], "vendedor_id", "is_active") == {1: (True,), 2: (False,)}
    invoice = ws.clean["erp_a_invoice"].first()
    assert (invoice.total, invoice.tax_amount, invoice.is_cancelled) == (23.5, 1.2, False)
    assert ws.clean["crm_product"].first().sku == "SKU-1"
    assert ws.clean["support_user"].first().organization_id == 1


def test_schools(ws):
    got = rows(
        ws.schools,
        "school_id",
        "name",
        "city",
        "state",
        "crm_account_id",
        "erp_a_customer_code",
        "erp_b_escola_id",
        "support_org_id",
    )
    assert got == {
        ONE: ("Escola, Um", "Recife", "PE", "A1", "C1", "1", "1"),
        TWO: ("Dois", None, "SP", "A2", None, None, None),
        FOUR: ("Quatro A", "Natal", "RN", None, "C4", None, None),
        SIX: ("Seis B", "Belem", "PA", None, None, "6", "2"),
        SEVEN: ("Sete S", None, None, None, None, None, "3"),
        NINE: ("Rede A", "Rio", "RJ", None, "C9", None, None),
    }


def test_account_managers(ws):
    assert set(rows(ws.account_managers, "account_manager_id")) == {"U1", "U4"}


def test_contracts(ws):
    columns = ("school_id", "account_manager_id", "owner_crm_user_id", "contract_number")
    assert rows(ws.contracts, "contract_id", *columns) == {
        "K1": (ONE, "U1", "U1", "CT-2024-001"),
        "K2": (TWO, None, "U2", "CT-2024-002"),
        "K4": (None, "U4", "U4", "CT-2023-004"),
    }


def test_orders(ws):
    got = rows(
        ws.orders,
        ("source_system", "source_order_id"),
        "contract_id",
        "school_id",
        "account_manager_id",
        "status",
        "is_cancelled",
    )
    assert got == {
        ("erp_a", "10"): ("K1", ONE, "U1", "open", False),
        ("erp_a", "11"): (None, FOUR, None, "closed", False),
        ("erp_a", "12"): (None, ONE, None, "cancelled", True),
        ("erp_a", "13"): (None, None, None, "closed", False),
        ("erp_b", "10"): ("K1", ONE, "U1", "delivered", False),
        ("erp_b", "11"): (None, SIX, None, "in_progress", False),
        ("erp_b", "12"): (None, SIX, None, "cancelled", True),
        ("erp_b", "13"): (None, SIX, None, "in_progress", None),
    }


def test_items_and_deliveries_point_at_orders(spark, ws):
    order = {k: v[0] for k, v in rows(ws.orders, ("source_system", "source_order_id"), "order_id").items()}
    items = rows(ws.order_items, ("source_system", "source_order_id", "source_line_id"), "order_id")
    assert items[("erp_a", "99", "1")] == (None,)
    assert items[("erp_b", "10", "1")] == (order[("erp_b", "10")],)
    assert len(items) == 7
    got = rows(
        ws.deliveries,
        ("source_system", "source_delivery_id"),
        "order_id",
        "delivery_date",
        "is_cancelled",
        "quantity_delivered",
        "delivery_status_normalized",
    )
    assert got == {
        ("erp_a", "500"): (order[("erp_a", "10")], D(2024, 3, 31), False, None, None),
        ("erp_a", "501"): (order[("erp_a", "10")], D(2024, 4, 1), True, None, None),
        ("erp_a", "503"): (None, D(2024, 6, 1), False, None, None),
        ("fin", "800"): (order[("erp_b", "10")], D(2024, 3, 12), False, 3, "delivered"),
        ("fin", "801"): (order[("erp_b", "11")], D(2024, 4, 10), True, 2, "lost"),
        ("fin", "802"): (order[("erp_b", "12")], D(2024, 4, 11), False, None, "estranho"),
    }
    key = spark.range(1).select(surrogate_key(F.lit("erp_b"), F.lit("10"))).first()[0]
    assert order[("erp_b", "10")] == key


def test_tickets(ws):
    order = {k: v[0] for k, v in rows(ws.orders, ("source_system", "source_order_id"), "order_id").items()}
    columns = ("school_id", "order_id", "tags", "resolution_hours", "cnpj_cliente")
    assert rows(ws.tickets, "ticket_id", *columns) == {
        1: (ONE, order[("erp_b", "10")], "alfa,zeta", 1, "01438889937567"),
        2: (ONE, None, None, 3, ""),
        3: (SEVEN, order[("erp_b", "11")], "x", None, ""),
        4: (None, order[("erp_b", "12")], None, None, ""),
        5: (None, None, None, None, ""),
    }


MEASURES = (
    "total_orders",
    "active_orders",
    "cancelled_orders",
    "ordered_amount",
    "ordered_quantity",
    "total_deliveries",
    "successful_deliveries",
    "quantity_delivered",
    "total_tickets",
    "avg_resolution_hours",
)
NOTHING = (0, 0, 0, 0.0, 0.0, 0, 0, 0, 0, None)


def test_monthly_report(ws):
    got = rows(ws.monthly_metrics(), ("school_id", "month"), *MEASURES)
    assert len(got) == 6 * 6
    busy = {k: v for k, v in got.items() if v != NOTHING}
    assert busy == {
        (ONE, D(2024, 3, 1)): (2, 2, 0, 53.8, 6.5, 2, 2, 3, 2, 2.0),
        (ONE, D(2024, 4, 1)): (1, 0, 1, 40.0, 4.0, 1, 0, 0, 0, None),
        (FOUR, D(2024, 3, 1)): (1, 1, 0, 0.0, 0.0, 0, 0, 0, 0, None),
        (SIX, D(2024, 4, 1)): (3, 1, 1, 14.5 + 9.99, 3.0, 2, 1, 2, 0, None),
        (SEVEN, D(2024, 7, 1)): (0, 0, 0, 0.0, 0.0, 0, 0, 0, 1, None),
    }


def test_ytd_report(ws):
    got = rows(
        ws.ytd_portfolio,
        "account_manager_id",
        "year",
        "total_contracts",
        "total_contracted_amount",
        "total_orders",
        "total_schools_served",
        "ordered_amount",
        "total_tickets",
        "avg_resolution_hours",
    )
    assert got == {
        "U1": (2024, 1, 100.5, 2, 1, 53.8, 1, 1.0),
        "U4": (2024, 0, 0.0, 0, 0, 0.0, 0, None),
    }


def test_written_tables_have_the_declared_columns(store, ws):
    monthly = store.read("report", report_name("monthly"))
    assert monthly.columns == [
        "school_id", "school_name", "cnpj", "city", "state", "month", *MEASURES, STAMP,
    ]
    contract = store.read("curated", curated_name("contract"))
    assert contract.columns == (
        "contract_id contract_number school_id crm_account_id account_manager_id "
        "owner_crm_user_id status is_cancelled start_date end_date brand grand_total total_price "
        "discount marketing_model created_at updated_at"
    ).split() + [STAMP]
    assert monthly.filter(F.col(STAMP).isNull()).count() == 0


def test_declared_checks_report_the_planted_faults(ws):
    from schoolyard.operators import run_checks

    got = run_checks(declared.table_of(ws), declared.CHECKS).collect()
    assert len(got) == 130
    failed = {(r.table_name, r.column_name, r.check_name): r.failures for r in got if r.failures}
    assert failed == {
        ("erp_a_salesperson", "is_active", "not_null"): 1,
        ("erp_b_pedido", "is_cancelled", "not_null"): 1,
        ("order", "is_cancelled", "not_null"): 1,
        ("order_item", "order_id", "not_null"): 1,
        ("support_ticket_tag", "tag", "not_null"): 1,
        ("fin_nota_fiscal", "delivery_status_normalized", "accepted_values"): 1,
    }


# -- writes; these replace the files the workspace above reads


def test_running_again_replaces_the_tables(raw, store, ws):
    pipeline.run(raw, store)
    assert store.read("curated", curated_name("order")).count() == 8
    assert store.read("report", report_name("ytd")).count() == 2


def test_refresh_rewrites_recent_months_only(spark, raw, store, ws):
    name = curated_name("order")
    before = rows(store.read("curated", name), "order_id", STAMP)
    pipeline.refresh_orders(Workspace(raw), store, D(2024, 4, 15))
    after = rows(store.read("curated", name), "order_id", STAMP, "order_date")
    assert set(before) == set(after)
    for key, (stamp, day) in after.items():
        assert (stamp > before[key][0]) == (day >= D(2024, 4, 1))
    pipeline.refresh_deliveries(Workspace(raw), store, D(2024, 6, 1))
    assert store.read("curated", curated_name("delivery")).count() == 6


def _with_orders(raw, changes):
    """The raw tables with other dates for some ERP A orders (None: no date)."""
    order = raw["erp_a_sales_order"]
    day = F.col("DocDate")
    for key, date in changes.items():
        day = F.when(F.col("DocEntry") == key, F.lit(date or None).cast("string")).otherwise(day)
    return {**raw, "erp_a_sales_order": order.withColumn("DocDate", day)}


@pytest.mark.parametrize(
    "changes",
    [
        {"13": "2024-01-05"},  # moved out of the refreshed months, which leaves one empty
        {"10": "2024-05-30", "13": "2024-02-01"},  # moved into them, and out
        {"12": ""},  # lost its date
        {"12": "", "13": ""},
    ],
)
def test_refresh_equals_a_full_rebuild(raw, spark, tmp_path, changes):
    store, whole = Store(spark, f"{tmp_path}/a"), Store(spark, f"{tmp_path}/b")
    pipeline.run(raw, store)
    changed = _with_orders(raw, changes)
    pipeline.run(changed, whole)
    pipeline.refresh_orders(Workspace(changed), store, D(2024, 4, 10))
    pipeline.refresh_deliveries(Workspace(changed), store, D(2024, 4, 10))
    for entity in ("order", "delivery"):
        got, want = (
            sorted(map(str, s.read("curated", curated_name(entity)).drop(STAMP).collect()))
            for s in (store, whole)
        )
        assert got == want
    # and back again
    pipeline.refresh_orders(Workspace(raw), store, D(2024, 4, 10))
    pipeline.run(raw, whole)
    got, want = (
        sorted(map(str, s.read("curated", curated_name("order")).drop(STAMP).collect()))
        for s in (store, whole)
    )
    assert got == want


def test_repeated_order_counts_once(raw, ws):
    """An order that the source delivers twice is one order of its manager."""
    order = raw["erp_a_sales_order"]
    twice = {**raw, "erp_a_sales_order": order.unionByName(order)}
    once, again = (
        {r.account_manager_id: r for r in Workspace(x).ytd_portfolio.collect()} for x in (raw, twice)
    )
    assert set(once) == set(again)
    for manager, r in once.items():
        assert again[manager].total_orders == r.total_orders
        assert again[manager].total_schools_served == r.total_schools_served


def test_catalog_tables(spark, tmp_path):
    store = Store(spark)
    layer = "curated_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{tmp_path}/{layer}'")
    df = spark.createDataFrame([(1, D(2024, 1, 1), "s"), (2, D(2024, 2, 1), "s")], "id int, m date, s string")
    store.replace_months(df, layer, "t", "m", "s")
    store.refresh_months(df.filter("id = 2").withColumn("id", F.lit(3)), layer, "t", "m", "s", [D(2024, 2, 1)])
    assert {r.id for r in store.read(layer, "t").collect()} == {1, 3}
    moved = df.filter("id = 2").withColumn("m", F.lit(None).cast("date"))
    store.refresh_months(moved, layer, "t", "m", "s", [D(2024, 2, 1), None])
    assert {(r.id, r.m) for r in store.read(layer, "t").collect()} == {(1, D(2024, 1, 1)), (2, None)}
    store.refresh_months(df.filter("id = 2"), layer, "t", "m", "s", [D(2024, 2, 1), None])
    assert {(r.id, r.m) for r in store.read(layer, "t").collect()} == {(1, D(2024, 1, 1)), (2, D(2024, 2, 1))}
    store.replace(df.limit(1), layer, "t2")
    assert store.read(layer, "t2").count() == 1
    spark.sql(f"DROP DATABASE {layer} CASCADE")


@pytest.mark.parametrize("cut", ["aside", "listed", "put", "empty"])
def test_a_refresh_cut_short_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, cut):
    store = Store(spark, f"{tmp_path}/t")
    df = spark.createDataFrame(
        [(1, D(2024, 1, 1), "s"), (2, D(2024, 2, 1), "s"), (3, D(2024, 3, 1), "s")], "id int, m date, s string"
    )
    store.replace_months(df, "curated", "t", "m", "s")
    old = {(1, D(2024, 1, 1)), (2, D(2024, 2, 1)), (3, D(2024, 3, 1))}
    new = {(1, D(2024, 1, 1)), (9, D(2024, 3, 1))}  # February is emptied, March has another row
    fresh = df.filter("id = 3").withColumn("id", F.lit(9))

    class Lost(Exception):
        pass

    def lost(*args, **kwargs):
        raise Lost

    saves = []
    save = Store._save

    def counted(self, writer, layer, name):
        if cut == ("aside", "listed", "")[min(len(saves), 2)]:
            raise Lost
        saves.append(name)
        save(self, writer, layer, name)

    with monkeypatch.context() as patch:
        if cut in ("put", "empty"):
            patch.setattr(Store, "_put" if cut == "put" else "_empty", lost)
        else:
            patch.setattr(Store, "_save", counted)
        with pytest.raises(Lost):
            store.refresh_months(fresh, "curated", "t", "m", "s", [D(2024, 2, 1), D(2024, 3, 1)])
    found = {(r.id, r.m) for r in Store(spark, f"{tmp_path}/t").read("curated", "t").collect()}
    assert found == (old if cut in ("aside", "listed") else new)
    # and the same refresh again ends in the new table
    store.refresh_months(fresh, "curated", "t", "m", "s", [D(2024, 2, 1), D(2024, 3, 1)])
    assert {(r.id, r.m) for r in store.read("curated", "t").collect()} == new


def test_clustered_tables_keep_their_rows(ws, store):
    names = [curated_name(e) for e in ("order", "delivery")]
    before = [sorted(map(str, store.read("curated", n).collect())) for n in names]
    pipeline.cluster(store)
    assert [sorted(map(str, store.read("curated", n).collect())) for n in names] == before
