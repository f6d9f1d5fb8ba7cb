"""Column functions on literal values."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from schoolyard import functions as fn
from schoolyard.functions import status as st


def test_digits_keeps_leading_zeros_and_null(values):
    rows = [("60.480.589/2583-20",), (" 10 433 218 1960 01",), ("01438889937567",), (None,), ("",)]
    assert values(rows, "c string", d=fn.digits("c")) == [
        "60480589258320",
        "10433218196001",
        "01438889937567",
        None,
        "",
    ]


def test_valid_digits_needs_exactly_fourteen(values):
    rows = [("1234567890123",), ("12345678901234",), ("123456789012345",), ("n/a",), (None,)]
    got = values(rows, "c string", d=fn.valid_digits("c"))
    assert got == [None, "12345678901234", None, None, None]


@pytest.mark.parametrize(
    "raw",
    [
        " Ct-2023-00055 ",
        "\tct-2023-00055\r\n",
        " CT-2023-00055 ",
        "ct-2023-00055",
    ],
)
def test_norm_code_strips_all_whitespace(values, raw):
    assert values([(raw,)], "c string", d=fn.norm_code("c")) == ["CT-2023-00055"]


def test_norm_code_keeps_inner_whitespace_and_null(values):
    assert values([("a \t b",), (None,)], "c string", d=fn.norm_code("c")) == ["A \t B", None]


def test_surrogate_key_marks_null_parts(values):
    got = values([("erp_a", None)], "s string, i string", k=fn.surrogate_key("s", "i"))
    assert got == ["d8a330910c5b66f5389035150c142c47"]


def test_surrogate_key_is_the_same_for_text_and_number(values):
    a = values([("erp_a", "7")], "s string, i string", k=fn.surrogate_key("s", "i"))
    b = values([("erp_a", 7)], "s string, i bigint", k=fn.surrogate_key("s", "i"))
    assert a == b


def test_erp_a_status(values):
    rows = [("Y", "O"), ("N", "O"), ("N", "C"), ("N", None), (None, "O"), (None, None)]
    got = values(rows, "c string, d string", s=st.erp_a_status(F.col("c"), F.col("d")))
    assert got == ["cancelled", "open", "closed", "closed", "open", "closed"]


@pytest.mark.parametrize(
    ("spellings", "status"),
    [
        (("C", "cancelado", "cancelled", "CANCELLED"), "cancelled"),
        (("E", "entregue", "delivered", "DELIVERED"), "delivered"),
        (
            ("A", "P", "pending", "PENDING", "pendente", "em_andamento", "IN_PROGRESS"),
            "in_progress",
        ),
        ((" C ", None, "other"), "in_progress"),
    ],
)
def test_erp_b_status(values, spellings, status):
    got = values([(s,) for s in spellings], "s string", m=st.erp_b_status(F.col("s")))
    assert got == [status] * len(spellings)


def test_fin_status_passes_unknown_values_through(values):
    rows = [("entregue",), ("em_transito",), ("extraviado",), ("devolvido",)]
    rows += [("aguardando_coleta",), ("novo",), (None,)]
    got = values(rows, "s string", m=st.fin_delivery_status(F.col("s")))
    assert got == ["delivered", "in_transit", "lost", "returned", "awaiting_pickup", "novo", None]


def test_empty_date_is_null(values):
    got = values([("",), ("2024-02-29",), (None,)], "c string", d=fn.date_or_null("c"))
    assert got == [None, dt.date(2024, 2, 29), None]


def test_valid_year_bounds(values):
    days = ["2009-12-31", "2010-01-01", "2030-12-31", "2031-01-01", "2204-12-31", None]
    got = values([(d,) for d in days], "d string", v=fn.valid_year(F.col("d").cast("date")))
    assert got == [False, True, True, False, False, None]


def test_elapsed_hours_truncates_toward_zero(values):
    rows = [
        ("2024-01-01 10:00:00", "2024-01-01 10:59:59"),
        ("2024-01-01 10:59:00", "2024-01-01 11:01:00"),
        ("2024-01-01 10:00:00", "2024-01-01 07:30:00"),
        ("2024-01-01 10:00:00", "2024-01-03 10:00:00"),
        ("2024-01-01 10:00:00", None),
    ]
    hours = fn.elapsed_hours(F.col("a").cast("timestamp"), F.col("b").cast("timestamp"))
    assert values(rows, "a string, b string", h=hours) == [0, 0, -2, 48, None]


def test_month_and_days(values):
    rows = [("2024-02-29 23:59:59", "2024-03-01 00:00:00")]
    got = values(
        rows,
        "a string, b string",
        m=fn.month_of(F.col("a").cast("timestamp")),
        n=fn.month_of(F.col("b").cast("date")),
        d=fn.days_between(F.col("a").cast("timestamp"), F.col("b").cast("timestamp")),
    )
    assert got == [(dt.date(2024, 2, 1), dt.date(2024, 3, 1), 1)]


def test_exact_sum_does_not_depend_on_row_order(spark):
    cents = [0.1, 0.2, 0.3, 1e9, 7.77, -1e9] * 50
    for order in (cents, list(reversed(cents)), sorted(cents)):
        df = spark.createDataFrame([(c,) for c in order], "c double").repartition(7)
        assert df.agg(fn.exact_sum("c").alias("s")).first().s == 418.5


def test_style_guide_comparison_flag_keeps_null(values):
    rows = [("Y",), ("N",), (None,)]
    assert values(rows, "c string", f=F.col("c") == "Y") == [True, False, None]
