"""Status vocabularies and the harmoniser."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ERP B spellings, compared after upper-casing and without trimming.
ERP_B_CANCELLED = ("C", "CANCELLED", "CANCELADO")
ERP_B_DELIVERED = ("E", "DELIVERED", "ENTREGUE")

# Delivery states of the finance system and their common names.
FIN_DELIVERY = {
    "delivered": ("entregue",),
    "in_transit": ("em_transito",),
    "lost": ("extraviado",),
    "returned": ("devolvido",),
    "awaiting_pickup": ("aguardando_coleta",),
}

# Finance states that count as a cancelled delivery.
FIN_CANCELLED = ("devolvido", "extraviado")


def map_status(c: Column, groups: dict[str, tuple[str, ...]], default: Column) -> Column:
    """Map many spellings to few names; NULL and unlisted values take ``default``."""
    out = None
    for name, spellings in groups.items():
        test = c.isin(*spellings)
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return out.otherwise(default)


def erp_a_status(cancelled: Column, doc_status: Column) -> Column:
    """The cancelled flag wins, then 'O' is open, anything else is closed."""
    return F.when(cancelled == "Y", "cancelled").when(doc_status == "O", "open").otherwise("closed")


def erp_b_status(status: Column) -> Column:
    return map_status(
        F.upper(status),
        {"cancelled": ERP_B_CANCELLED, "delivered": ERP_B_DELIVERED},
        F.lit("in_progress"),
    )


def fin_delivery_status(status: Column) -> Column:
    return map_status(status, FIN_DELIVERY, status)
