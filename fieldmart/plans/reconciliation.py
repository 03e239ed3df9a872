"""Order status in the document store against the warehouse."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import stamp_text
from ..functions.text import digits_only
from ..operators.aggregates import outcome_counts
from ..operators.filters import filled, since_hours
from ..operators.joins import reconcile
from ..operators.nested import explode_items, slim_items


@dataclass(frozen=True)
class Reconciliation:
    compared: DataFrame
    diverging: DataFrame
    missing: DataFrame
    counters: DataFrame


def document_orders(docs: DataFrame, as_of=None, hours: int = 1) -> DataFrame:
    """``nro_os, status_mongo, created_at`` of every order with a number and a status."""
    if as_of is not None:
        docs = docs.filter(since_hours("createdAt", as_of, hours))
    services = slim_items("services", number="serviceOrder.number", status="serviceOrder.status")
    items = explode_items(docs.select("createdAt", services.alias("services")), "services", "s")
    kept = items.filter(filled("s.number", "s.status"))
    return kept.select(digits_only("s.number").alias("nro_os"), F.col("s.status").alias("status_mongo"),
                       stamp_text("createdAt", "NULL").alias("created_at"))


def compare_status(orders: DataFrame, warehouse: DataFrame, order: tuple[str, ...] = ("status_sql",),
                   recent_only: bool = True) -> DataFrame:
    """The orders with ``status_sql`` of the first warehouse row and the outcome."""
    known = warehouse.withColumnsRenamed({"service_order_number": "nro_os", "service_order_status": "status_sql"})
    return reconcile(orders, known, "nro_os", "status_mongo", "status_sql", order, recent_only)


def reconcile_status(docs: DataFrame, warehouse: DataFrame, as_of, hours: int = 1,
                     order: tuple[str, ...] = ("status_sql",), recent_only: bool = True) -> Reconciliation:
    """Orders of the last hours, split by outcome. ``order`` decides which of several warehouse rows
    of one number counts; ``recent_only`` says that the orders are few against the warehouse."""
    compared = compare_status(document_orders(docs, as_of, hours), warehouse, order, recent_only)
    return Reconciliation(
        compared,
        compared.filter(F.col("outcome") == "diverges").select("nro_os", "status_mongo", "status_sql", "created_at"),
        compared.filter(F.col("outcome") == "missing").select("nro_os", "status_mongo", "created_at"),
        outcome_counts(compared, ["diverges", "missing"]),
    )
