"""Reconciliation of arriving documents with the warehouse."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators.joins import only_keys
from ..plans.reconciliation import compare_status, document_orders


def reconcile_sink(warehouse: Callable[[], DataFrame], out: str,
                   order: tuple[str, ...] = ("status_sql",)) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer: every micro-batch is compared with the warehouse as it is then.

    Stream offsets take the place of the trailing hour, so no document is seen twice or never; a
    repeated batch overwrites its own folder. The numbers of a small batch reach the warehouse's scan as a list, so it
    reads only what can hold them; the first rows are then picked from these alone.
    """
    def write(batch: DataFrame, number: int) -> None:
        orders = document_orders(batch).persist()
        known = only_keys(warehouse(), "service_order_number", orders, "nro_os")
        compared = compare_status(orders, known, order, recent_only=False)
        compared.write.mode("overwrite").parquet(f"{out}/batch_no={number}")
        orders.unpersist()

    return write
